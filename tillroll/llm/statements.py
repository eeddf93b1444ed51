"""DuckDB statements for the queries that SQL can express.

The others are not there on purpose: connected classes, dependent rounding, packing, token ids, model scores,
fingerprints, linked spans, the host prior and orders by Spark's hash have no equal in SQL. ``tests/llm`` compares
them with plain Python. The statement for spelling variants spells out the checksum bit by bit.
"""

from __future__ import annotations

from collections.abc import Sequence

from tillroll.llm.url_filters import MIN_SOFT, RULES, SOFT, STRICT

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _hits(terms: Sequence[str]) -> str:
    found = (
        f"(regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}]){t}([^\\p{{L}}\\p{{N}}]|$)'))::integer" for t in terms
    )
    return f"case when low is null then 0 else {' + '.join(found)} end"


def _rule(value: str) -> str:
    rules = sorted(RULES, key=lambda r: -len(r.text))
    whens = (
        f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')"
        f" then '{getattr(r, value)}'"
        for r in rules
    )
    return f"case {' '.join(whens)} end"


URL_FILTERS = f"""
with cut as (
    select page_id, translate(url, '{_UPPER}', '{_LOWER}') as low,
           case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) end as rest
    from pages
), split as (
    select *, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}'), '') as host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
    from cut
), judged as (
    select page_id, host, path, {_rule("text")} as rule, {_rule("action")} as action,
           {_hits(STRICT)} as n_strict, {_hits(SOFT)} as n_soft
    from split
)
select page_id, host, path, rule, n_strict::integer as n_strict, n_soft::integer as n_soft,
       coalesce(action, case when n_strict >= 1 or n_soft >= {MIN_SOFT} then 'block' else 'allow' end) as verdict
from judged
"""

TOP_K = """
with quantized as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id,
           coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::bigint as score
    from quantized q join quantized c on q.vec_id <> c.vec_id
    where q.vec_id % 50 = 0
)
select query_id, rank::integer as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 5
"""

PHRASES = f"""
with pieces as (
    select coalesce(lang, 'und') as lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                        '[.,;:!?\\x0A-\\x0D]')) as piece
    from documents
), worded as (
    select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces
), totals as (
    select lang, sum(len(w)) as n from worded group by lang
), lengths as (
    select lang, w, unnest(range(1, 6)) as k from worded
), grams as (
    select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' ')))
           as phrase
    from lengths where len(w) >= k
), frequent as (
    select lang, k, phrase, count(*) as f from grams group by all having count(*) >= 100
), longer as (
    select lang, unnest([array_to_string(string_split(phrase, ' ')[1 : k - 1], ' '),
                         array_to_string(string_split(phrase, ' ')[2 : k], ' ')]) as phrase, f
    from frequent where k >= 3
), candidates as (
    select c.lang, c.phrase, c.k, c.f as a from frequent c
    where c.k >= 2 and not exists (
        select 1 from longer x where x.lang = c.lang and x.phrase = c.phrase and x.f >= c.f)
), cuts as (
    select *, unnest(range(1, k)) as cut from candidates
), scored as (
    select c.lang, c.phrase, c.a, l.f as l, r.f as r, t.n, c.cut,
           ((1000::hugeint * c.a * t.n) // (l.f::hugeint * r.f))::bigint as score
    from cuts c
    join frequent l on l.lang = c.lang and l.phrase = array_to_string(string_split(c.phrase, ' ')[1 : c.cut], ' ')
    join frequent r on r.lang = c.lang and r.phrase = array_to_string(string_split(c.phrase, ' ')[c.cut + 1 : c.k], ' ')
    join totals t on t.lang = c.lang
), best as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1
)
select lang, rank::integer as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best)
where rank <= 2000
"""

_LATIN = "".join(map(chr, range(0xC0, 0x100)))
# As many letters of one byte that no word holds, so that distances by byte are distances by letter.
_ONE_BYTE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalpha() and chr(c) != "'")
_ONE_BYTE = (_UPPER + _ONE_BYTE)[: len(_LATIN)]

SPELLING = f"""
with table_ as (
    select list(list_reduce(list_prepend(b::bigint, range(8)),
                lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) order by b) as t
    from range(256) x(b)
), runs as (
    select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), '{_UPPER}', '{_LOWER}') as run
    from documents
), counted as (
    select doc_id, run, count(*) as n from runs group by all
), marked as (
    select run, n, doc_id is not null as named,
           xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
                   string_split(coalesce(doc_id, 0) || ':' || run, ''),
                   lambda ch: case when unicode(ch) < 128 then [unicode(ch)::bigint]
                                   else [195::bigint, unicode(ch)::bigint - 64] end))),
               lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])), 4294967295) as h
    from counted, table_
), slipped as (
    select case when named and h % 31 = 0
                then substr(run, 1, (h % length(run))::integer) || substr(run, (h % length(run))::integer + 2)
                else run end as word, n
    from marked
), words as (
    select word, sum(n)::bigint as n, translate(word, '{_LATIN}', '{_ONE_BYTE.replace("'", "''")}') as code
    from slipped where length(word) >= 7 group by word having sum(n) >= 2
), less as (
    select word, n, code, unnest(list_append(list_transform(range(1, length(code) + 1),
               lambda i: substr(code, 1, i - 1) || substr(code, i + 1)), code)) as variant
    from words
), near as (
    select distinct a.word, a.n, b.word as other, b.n as m
    from less a join less b on a.variant = b.variant and a.word <> b.word
    where levenshtein(a.code, b.code) = 1
), judged as (
    select w.word, w.n, count(x.other) as n_near,
           (array_agg(x.other order by x.m desc, x.other) filter (where x.other is not null))[1] as best, max(x.m) as m
    from words w left join near x on x.word = w.word group by w.word, w.n
), formed as (
    select word, n, n_near, case when m >= 10 * n then best end as form, case when m >= 10 * n then m end as form_n
    from judged
), recursive_ as (
    with recursive chain as (
        select word, word as here, form as next from formed
        union all
        select c.word, f.word, f.form from chain c join formed f on f.word = c.next
    )
    select word, here as root from chain where next is null
)
select f.word, f.form, r.root, f.n, f.n_near::bigint as n_near, f.form_n::bigint as form_n
from formed f join recursive_ r on r.word = f.word
"""

STATEMENTS: dict[str, str] = {
    "op7_url_filters": URL_FILTERS,
    "op11_top_k_search": TOP_K,
    "op12_spelling_variants": SPELLING,
    "op13_phrase_collocations": PHRASES,
}
