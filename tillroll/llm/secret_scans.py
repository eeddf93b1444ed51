"""Secret scans that link the parts of a credential.

Strong spans (``assign``, ``access``, ``hex``) are reported wherever they occur. Parts that say little on
their own are *weak candidates*: user or client identifiers (``id``), random-looking keys (``key``) and
service addresses (``endpoint``). A weak candidate is reported only where complementary parts lie within its
scope, the stretch of text up to ``reach`` code points around it:

    id        next to a secret (assign, hex or key)
    key       next to an identifier (access or id)
    endpoint  next to an identifier and a secret

and only where it does not overlap a strong span. Candidates are linked by an interval join: parts and
scopes are dealt to bins of the text, joined on (text, bin), and compared there. A bin is as short as a
scope, so it holds few parts, however many a text has.

Everything runs inside the JVM. Equal texts are scanned and linked once.

Defined cases: a missing or empty text has no spans. Repeated rows and rows without id get their own row.
An empty table gives an empty result. Extra columns pass through; one with the name of the added column is
replaced. A long text with many matches takes time in proportion to both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.text import let, own, read, whole
from tillroll.operators.sizes import broadcast_if_small
from tillroll.scratch import pin

ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\x22']?\x20*[:=]\x20*[\x22']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_MIN = 8
# The shorter matches that the base rule finds and drops cannot hold a longer one, so asking for the
# least length at once finds the same spans.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ID = r"(?i:user(?:name)?|login|account|client_?id)[\x22']?\x20*[:=]\x20*[\x22']?[A-Za-z0-9@._-]{3,}"
# Also directly after '=', and whole with its padding, however long it is.
KEY = (
    r"(?<![A-Za-z0-9+/_.-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])"
    r"[A-Za-z0-9+/]{32,}+={0,2}(?![A-Za-z0-9+/_.-])"
)
ENDPOINT = r"(?i:https?|postgres|mysql|mongodb|redis|amqps?|jdbc:[a-z]+)://[^\s\x22'<>]{4,}"

KINDS = ("assign", "access", "hex", "id", "key", "endpoint")
STRONG = 3  # the first kinds
PATTERNS = (ASSIGN, ACCESS, HEX, ID, KEY, ENDPOINT)
REACH = 200
# Matches folded at once, and code points that a piece of a text is looked for in.
_BLOCK = 64
_CHUNK = 4096
MASK = "[SECRET]"


def _running(values: Column, start: Column, step, out_type: str) -> Column:
    """``values`` folded from the left: each one's ``out`` of ``step(at, value) -> (at, out)``, in order.

    A list that grows by one is copied each time. So values are folded in blocks of ``_BLOCK``: first only what each
    block leaves behind, then, knowing what each starts from, the blocks on their own.
    """
    empty = F.array().cast(f"array<{out_type}>")

    def over(blocks: Column) -> Column:
        at_start = F.aggregate(
            blocks,
            F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, block: F.struct(
                F.aggregate(block, acc["at"], lambda at, v: step(at, v)[0]).alias("at"),
                F.array_append(acc["out"], acc["at"]).alias("out"),
            ),
            lambda acc: acc["out"],
        )

        def fold(block: Column, at: Column) -> Column:
            return F.aggregate(
                block,
                F.struct(at.alias("at"), empty.alias("out")),
                lambda acc, v: F.struct(
                    step(acc["at"], v)[0].alias("at"), F.array_append(acc["out"], step(acc["at"], v)[1]).alias("out")
                ),
                lambda acc: acc["out"],
            )

        return F.flatten(F.zip_with(blocks, at_start, fold))

    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(values) / F.lit(_BLOCK)).cast("int") - 1),
        lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)),
    )
    return F.when(F.size(values) > 0, let(blocks, over)).otherwise(empty)


def _spans(text: Column, kind: int) -> Column:
    """``array<struct<s, k, e>>`` of the leftmost non-overlapping matches, in code points.

    The gaps between matches and the matches themselves come from the same pattern, so their
    lengths add up to the places.
    """
    pattern = PATTERNS[kind]

    def place(found: Column) -> Column:
        # One gap more than hits: the text behind the last one is not asked for.
        lengths = F.transform(
            found["hits"],
            lambda hit, i: F.struct(F.length(F.get(found["gaps"], i)).alias("g"), F.length(hit).alias("h")),
        )

        def step(at: Column, x: Column) -> tuple[Column, Column]:
            end = at + x["g"] + x["h"]
            return end, F.struct((at + x["g"]).alias("s"), F.lit(kind).alias("k"), end.alias("e"))

        ends = let(lengths, lambda values: _running(values, F.lit(0), step, "struct<s:int,k:int,e:int>"))
        if kind == 0:  # drop assignments whose value is short
            values = F.transform(found["values"], F.length)
            return let(values, lambda of: F.filter(ends, lambda _, i: F.get(of, i) >= ASSIGN_MIN))
        return ends

    parts = [
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
    ]
    if kind == 0:
        parts.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("values"))
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), let(F.struct(*parts), place)).otherwise(none)


def _linked(parts: DataFrame, reach: int) -> DataFrame:
    """The weak candidates of ``parts(key, s, k, e)`` that have their complements in scope."""
    bin_of = lambda c: F.floor(c / reach)
    other = parts.select(
        "key",
        F.col("s").alias("os"),
        F.col("k").alias("ok"),
        F.col("e").alias("oe"),
        F.explode(F.sequence(bin_of(F.col("s")), bin_of(F.col("e")))).alias("bin"),
    )
    weak = parts.where(F.col("k") >= STRONG).select(
        "key",
        "s",
        "k",
        "e",
        F.explode(
            F.sequence(bin_of(F.col("s") - reach), bin_of(F.col("e") + reach))
        ).alias("bin"),
    )
    in_scope = (F.col("os") < F.col("e") + reach) & (F.col("oe") > F.col("s") - reach)
    overlaps = (F.col("ok") < STRONG) & (F.col("os") < F.col("e")) & (F.col("oe") > F.col("s"))
    is_id = F.col("ok").isin(1, 3)
    is_secret = F.col("ok").isin(0, 2, 4)
    linked = (
        weak.join(other, ["key", "bin"])
        .where(in_scope)
        .groupBy("key", "s", "k", "e")
        .agg(
            F.max(overlaps).alias("overlaps"),
            F.max(is_id).alias("ids"),
            F.max(is_secret).alias("secrets"),
        )
    )
    complete = (
        F.when(F.col("k") == 3, F.col("secrets"))
        .when(F.col("k") == 4, F.col("ids"))
        .otherwise(F.col("ids") & F.col("secrets"))
    )
    return linked.where(~F.col("overlaps") & complete).select("key", "s", "k", "e")


def find_secrets(
    docs: DataFrame,
    text: str = "text",
    reach: int = REACH,
) -> DataFrame:
    """``key, spans`` per different text with a span: ``spans`` is ``array<struct<s, k, e>>`` in order,
    ``k`` the place of the kind in ``KINDS``, ``key`` as by ``text_key``."""
    found = docs.select(
        text_key(text).alias("key"),
        F.flatten(F.array(*(_spans(whole(text), k) for k in range(len(PATTERNS))))).alias("spans"),
    ).where(F.size("spans") > 0)
    # Spans are few and short; they are written once, as scopes and parts both come from them.
    parts = pin(
        found.select("key", F.explode("spans").alias("p")).select("key", "p.*").distinct(), "parts"
    )
    reported = parts.where(F.col("k") < STRONG).unionByName(_linked(parts, reach))
    return reported.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("s", "k", "e"))).alias("spans")
    )


def _between(chunks: Column, low: Column, high: Column) -> Column:
    """The code points from ``low`` to ``high`` of a text cut into ``chunks`` of ``_CHUNK``. A piece of a long text
    would be looked for from its start each time."""
    first, last = F.floor(low / _CHUNK).cast("int"), F.floor(high / _CHUNK).cast("int")
    head, tail = F.coalesce(F.get(chunks, first), F.lit("")), F.coalesce(F.get(chunks, last), F.lit(""))
    inside = F.substring(head, low % _CHUNK + 1, high - low)
    across = F.concat(
        F.substring(head, low % _CHUNK + 1, F.lit(_CHUNK)),
        F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
        F.substring(tail, F.lit(1), high % _CHUNK),
    )
    return F.when(first == last, inside).otherwise(across)


def text_key(text: Column | str) -> Column:
    return F.sha2(whole(text), 256)


def with_secrets(
    docs: DataFrame, text: str = "text", reach: int = REACH, name: str = "spans"
) -> DataFrame:
    """The documents with their reported spans; empty where there are none."""
    key, reported = own("key"), own("reported")
    found = find_secrets(docs, text, reach).select(F.col("key").alias(key), F.col("spans").alias(reported))
    found = _broadcast_if_few(pin(found, "secrets"), reported)
    kept = [c for c in docs.columns if c != name]
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")
    return (
        docs.withColumn(key, text_key(text))
        .join(found, key, "left")
        .select(*kept, F.coalesce(reported, none).alias(name))
    )


def _broadcast_if_few(found: DataFrame, name: str) -> DataFrame:
    """Spans are arrays, which the size check does not see: judged by their number."""
    rows, spans = found.agg(F.count(F.lit(1)), F.sum(F.size(name))).first()
    small = rows <= 100_000 and (spans or 0) <= 1_000_000
    return F.broadcast(found) if small else found


def mask_secrets(docs: DataFrame, text: str = "text", reach: int = REACH, mask: str = MASK) -> DataFrame:
    """The documents with every reported span replaced by ``mask``; overlapping spans become one mask."""
    spans = own("spans")

    def masked(rows: Column) -> Column:
        # Spans are in order of their start. How far those before each one reach: one that starts inside them only
        # extends them, any other opens a mask.
        reached = _running(rows, F.lit(0), lambda at, x: (F.greatest(at, x["e"]), at), "int")

        def pieces(before: Column, chunks: Column) -> Column:
            opened = F.transform(
                rows,
                lambda x, i: F.when(
                    x["s"] >= F.get(before, i),
                    F.concat(_between(chunks, F.get(before, i), x["s"]), F.lit(mask)),
                ).otherwise(F.lit("")),
            )
            last = F.greatest(F.element_at(before, -1), F.element_at(rows, -1)["e"])
            return F.concat(F.array_join(opened, ""), _between(chunks, last, F.lit(2**31 - 1 - _CHUNK)))

        chunks = F.regexp_extract_all(F.col(text), F.lit("(?s).{1,%d}" % _CHUNK), F.lit(0))
        return let(reached, lambda before: let(chunks, lambda parts: pieces(before, parts)))

    changed = F.when(F.size(spans) > 0, masked(F.col(spans))).otherwise(F.col(text))
    return with_secrets(docs, text, reach, spans).select(
        *[changed.alias(c) if c == text else c for c in docs.columns]
    )


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(
                ":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string")
            ),
        ),
        ",",
    )


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    count = lambda k: F.size(F.filter(spans, lambda x: x["k"] == k)).cast("long")
    docs = read(spark, sf_dir, "documents")
    return with_secrets(docs.select("doc_id", "text")).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.filter(spans, lambda x: x["k"] < STRONG)), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )
