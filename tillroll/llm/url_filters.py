"""URL filters: host and path rules first, then a weighted vocabulary.

A rule fits its host and all subdomains where the url's path starts with the rule's path; the longest
fitting rule decides. Urls without a rule are searched for the vocabulary by one Aho-Corasick automaton
per task, which finds all terms in one pass over the url. A hit counts only between boundaries: no
letter or digit may stand directly before or after it. One strict term rejects; soft terms reject
when several different ones occur.

Defined cases: a missing url or one without ``://`` has empty host and path and no rule; a missing one has no term
and is allowed, any other is searched whole. A very long url is one string in one task. Repeated rows are judged each on their own. An empty table gives an empty result. Extra columns
pass through; a column with the name of an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.text import LOWER_ASCII, read

_UPPER, _LOWER = "".join(map(chr, LOWER_ASCII)), "".join(map(chr, LOWER_ASCII.values()))


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

STRICT = (
    "adult", "bestiality", "camgirl", "camgirls", "casino", "cheap-pills", "escort", "escorts",
    "hardcore", "hentai", "malware", "milf", "nude", "nudes", "onlyfans", "phishing", "porn", "porno",
    "pornhub", "pornstar", "sex", "sexcam", "spam-farm", "spamfarm", "viagra", "warez", "webcamsex",
    "xvideos", "xxx",
)
SOFT = (
    "babes", "bet", "betting", "bonus", "cams", "cash", "cheap", "click", "coupon", "crack", "dating",
    "deals", "earn", "fast", "free", "gambling", "girls", "hot", "jackpot", "keygen", "loan", "loans",
    "lottery", "money", "offer", "pills", "poker", "prize", "promo", "sexy", "singles", "slots",
    "spam", "torrent", "win", "winner",
)
MIN_SOFT = 2


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host up to ``/``, ``?``, ``#``; the path from there to ``?``, ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits; null where none does."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.text).otherwise(name)
        action = F.when(fits, rule.action).otherwise(action)
    return name, action


def vocabulary_hits(url: Column, strict: Sequence[str], soft: Sequence[str]) -> Column:
    """``struct(strict, soft)``: how many different terms of each kind the url holds."""
    terms = {**{t: False for t in soft}, **{t: True for t in strict}}

    @F.pandas_udf("strict int, soft int")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for term, is_strict in terms.items():
            automaton.add_word(term, (term, is_strict))
        automaton.make_automaton()

        def count(url: str | None) -> tuple[int, int]:
            if not url:
                return 0, 0
            low = url.translate(LOWER_ASCII)
            found = set()
            for end, (term, is_strict) in automaton.iter(low):
                start = end - len(term) + 1
                before = low[start - 1] if start else "/"
                after = low[end + 1] if end + 1 < len(low) else "/"
                if not (before.isalnum() or after.isalnum()):
                    found.add((term, is_strict))
            n_strict = sum(is_strict for _, is_strict in found)
            return n_strict, len(found) - n_strict

        for urls in batches:
            yield pd.DataFrame([count(u) for u in urls], columns=["strict", "soft"])

    return hits(url)


def judge_urls(
    pages: DataFrame,
    url: str = "url",
    rules: Sequence[Rule] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    min_soft: int = MIN_SOFT,
) -> DataFrame:
    """The pages with ``host, path, rule, n_strict, n_soft, verdict``."""
    added = ("host", "path", "rule", "n_strict", "n_soft", "verdict")
    passed = [c for c in pages.columns if c not in added]
    host, path = host_and_path(F.col(url))
    split = pages.select(*passed, host.alias("host"), path.alias("path"), F.col(url).alias("_searched"))
    rule, action = fitting_rule(F.col("host"), F.col("path"), rules)
    found = split.withColumns({"rule": rule, "_action": action}).withColumn(
        "_hits", vocabulary_hits(F.col("_searched"), strict, soft)
    )
    bad = (F.col("_hits.strict") >= 1) | (F.col("_hits.soft") >= min_soft)
    return found.select(
        *passed,
        "host",
        "path",
        "rule",
        F.col("_hits.strict").alias("n_strict"),
        F.col("_hits.soft").alias("n_soft"),
        F.coalesce("_action", F.when(bad, "block").otherwise("allow")).alias("verdict"),
    )


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft"
    )
