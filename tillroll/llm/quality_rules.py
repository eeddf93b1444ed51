"""Quality rules by host: rule failures are pooled per host, and a host's verdict sets how strictly
its documents are judged.

1. Every document is measured inside the JVM and checked against the rules. The ``base`` rules are
   final. The ``soft`` rules are signs that only count where the host as a whole looks bad.
2. Failures are summed per host (map-side combined, so a hot host costs one row per task).
3. The failure rate of a host is shrunk towards the rate of all hosts: a beta prior is fitted to the
   hosts by moments, and the posterior mean ``(failed + a) / (documents + a + b)`` is compared with
   the limit. Hosts with few documents stay near the overall rate.
4. Verdicts are joined back. A document goes if a base rule rejects it, or if its host is strict and
   it fails a soft rule itself. A document that passes every rule is always kept.

Defined cases: a missing or empty text has no words and fails the base rule. A missing host is a host
of its own. Repeated rows are judged each on their own and count each in their host. An empty table
gives an empty result. Extra columns pass through; a column with the name of an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.text import let, own, read, whole, words_of
from tillroll.operators.sizes import broadcast_if_small
from tillroll.scratch import pin

WINDOW_WORDS = 3
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Limits:
    """Where the rules and the host verdict draw their lines."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbols_percent: int = 10  # symbols per 100 words
    max_dup_lines_percent: int = 30  # repeated lines per 100 lines with a word
    word_chars: tuple[int, int] = (3, 10)  # mean length of a word
    strict_rate: float = 0.3  # shrunk failure rate from which a host is strict


def _repeated_words(words: Column) -> Column:
    """How many words lie in a window of three that occurs twice or more in the text.

    Window hashes (64 bits) are sorted once as plain longs. Only texts where two neighbours agree
    go on: there, windows are sorted with their place, those equal to a neighbour are marked, and
    the union of the marked stretches is counted.
    """
    last = F.size(words) - WINDOW_WORDS
    starts = F.sequence(F.lit(0), last)

    def window_hash(ws: Column, i: Column) -> Column:
        return F.xxhash64(*(F.get(ws, i + k) for k in range(WINDOW_WORDS)))

    def any_pair(sorted_hashes: Column) -> Column:
        return F.size(F.array_distinct(sorted_hashes)) < F.size(sorted_hashes)

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def marked(rows: Column) -> Column:
            twice = F.filter(
                rows,
                lambda r, k: (F.get(rows, k - 1)["h"] == r["h"]) & (k > 0)
                | F.coalesce(F.get(rows, k + 1)["h"] == r["h"], F.lit(False)),
            )
            return F.sort_array(F.transform(twice, lambda r: r["i"]))

        def union(at: Column) -> Column:
            reach = F.transform(
                at,
                lambda p, k: F.least(
                    F.lit(WINDOW_WORDS), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW_WORDS))
                ),
            )
            return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

        return let(let(placed, marked), union)

    counted = let(
        F.transform(starts, lambda i: window_hash(words, i)),
        lambda hashes: F.when(any_pair(hashes), covered(hashes)).otherwise(F.lit(0)),
    )
    return F.when(last >= 1, counted).otherwise(F.lit(0)).cast("long")


def measures(text: Column | str) -> Column:
    """One struct with all measures of a text."""
    lines = F.filter(F.split(whole(text), "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeated_words(words).alias("n_repeat_words"),
        )

    def of_lines(rows: Column) -> Column:
        return F.struct(
            F.size(rows).cast("long").alias("n_lines"),
            (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines"),
        )

    return F.struct(
        let(words_of(text), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.regexp_count(whole(text), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )


def _host_verdicts(judged: DataFrame, host: str, limits: Limits) -> DataFrame:
    """One row per host: documents, failures, shrunk rate and verdict."""
    per_host = judged.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("_documents"),
        F.count_if(F.col("base_failed") | F.col("soft_failed")).alias("_failed"),
    )
    per_host = pin(per_host, "hosts")
    rate = F.col("_failed") / F.col("_documents")
    n, total, failed, mean, spread, inverse = per_host.agg(
        F.count(F.lit(1)),
        F.sum("_documents"),
        F.sum("_failed"),
        F.avg(rate),
        F.var_samp(rate),
        F.avg(1 / F.col("_documents")),
    ).first()
    a, b = beta_prior(n, total or 0, failed or 0, mean, spread, inverse)
    shrunk = (F.col("_failed") + a) / (F.col("_documents") + a + b)
    return per_host.select(
        "_host",
        shrunk.alias("host_rate"),
        F.when(shrunk > limits.strict_rate, "strict").otherwise("normal").alias("host_verdict"),
    )


def beta_prior(
    hosts: int,
    documents: int,
    failed: int,
    mean: float | None,
    spread: float | None,
    inverse: float | None,
) -> tuple[float, float]:
    """Moments of the host rates, less the noise of counting, as a beta distribution.

    Where hosts do not differ beyond that noise (or there are too few to tell), the prior has the
    pooled rate and the weight of an average host.
    """
    if not documents:
        return 1.0, 1.0
    pooled = (failed + 1) / (documents + 2)
    if mean is not None and spread is not None and 0 < mean < 1:
        between = spread - mean * (1 - mean) * inverse
        if between > 0:
            weight = max(mean * (1 - mean) / between - 1, 2.0)
            return mean * weight, (1 - mean) * weight
    weight = max(documents / hosts, 2.0)
    return pooled * weight, (1 - pooled) * weight


def judge(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    limits: Limits = Limits(),
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The documents with their measures, ``base_failed``, ``soft_failed``, the host's verdict and
    ``kept``. ``carry`` names the input columns to keep (default: all); leave out the text where only
    the verdicts are wanted. The judged rows are written once, as they are read twice: for the host
    sums and for the join."""
    added = [
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        "base_failed", "soft_failed", "host_rate", "host_verdict", "kept",
    ]
    carry = [c for c in (docs.columns if carry is None else carry) if c not in added]
    m, key = own("m"), own("host")
    measured = docs.select(*carry, F.col(host).alias(key), measures(text).alias(m)).select(
        *carry, key, f"{m}.w.*", f"{m}.l.*", f"{m}.n_symbols"
    )
    n = F.col("n_words")
    short, long = limits.word_chars
    judged = pin(
        measured.withColumns(
            {
                "base_failed": (n < limits.min_words)
                | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * n),
                "soft_failed": (100 * F.col("n_symbols") > limits.max_symbols_percent * n)
                | (100 * F.col("n_dup_lines") > limits.max_dup_lines_percent * F.col("n_lines"))
                | ~F.col("word_chars").between(short * n, long * n),
            }
        ),
        "judged",
    )
    verdicts = broadcast_if_small(_host_verdicts(judged, key, limits))
    return judged.join(verdicts, F.col(key).eqNullSafe(F.col("_host")), "left").select(
        *[c for c in judged.columns if c != key],
        "host_rate",
        "host_verdict",
        (
            ~F.col("base_failed")
            & ~((F.col("host_verdict") == "strict") & F.col("soft_failed"))
        ).alias("kept"),
    )


def keep(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that the rules keep, with their own columns only, also such as share the name of
    an added one."""
    names = {c: own(f"c{i}") for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(names[c]) for c in docs.columns])
    judged = judge(renamed, names[text], names[host])
    return judged.where("kept").select(*[F.col(names[c]).alias(c) for c in docs.columns])


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "soft_failed",
        "host_verdict",
    )
