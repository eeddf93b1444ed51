"""Token counts of the sections of a document, by the tokens' places.

A document is encoded once, as a whole, so counts are those of the tokens a model would see. Tokens are
byte strings that follow each other, so their ends are the running sum of their lengths. Sections are given
as character spans, turned into byte spans, and joined with the tokens as intervals by binary search on
their sorted ends.

A token that crosses a boundary goes, whole, to the section that holds most of its bytes, at a tie to the
earlier one. Every token goes to exactly one section, so counts add up to those of the document.

Sections are lines by default, each with its line feed. Defined cases: a missing or empty text is one
empty section without tokens. Repeated rows are counted each on their own. An empty table gives an empty
result. Extra columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.text import read

VOCABULARY = "byte_bpe_50k.tiktoken"
_SLICE = 128


def line_ends(text: str) -> list[int]:
    """The end of each section in code points; a section starts where the one before ends."""
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return ends


def byte_ends(text: str, data: bytes, ends: Sequence[int]) -> np.ndarray:
    """The same ends in bytes of the encoded text."""
    ends = np.asarray(ends, dtype=np.int64)
    if len(data) == len(text):
        return ends
    octets = np.frombuffer(data, dtype=np.uint8)
    first_bytes = np.flatnonzero((octets & 0xC0) != 0x80)  # where each code point begins
    return np.append(first_bytes, len(data))[ends]


def attribute(token_ends: np.ndarray, section_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token its section, and whether it crosses a boundary."""
    token_starts = np.concatenate(([0], token_ends[:-1])) if len(token_ends) else token_ends
    first = np.searchsorted(section_ends, token_starts, side="right")
    last = np.searchsorted(section_ends, token_ends - 1, side="right")
    section, crossing = first.copy(), last > first
    for t in np.flatnonzero(crossing):
        spans = np.arange(first[t], last[t] + 1)
        low = np.maximum(token_starts[t], np.concatenate(([0], section_ends))[spans])
        high = np.minimum(token_ends[t], section_ends[spans])
        section[t] = spans[np.argmax(high - low)]  # the first of equals
    return section, crossing


class ByteTokens:
    """A byte-level vocabulary and the byte length of each of its tokens."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self._encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._length = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self._length[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        return np.cumsum(self._length[self._encoding.encode_ordinary(text)])


def count_tokens(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    sections: Callable[[str], list[int]] = line_ends,
) -> DataFrame:
    """``carry..., section, start, end, n_tokens, n_crossing`` per section; places in code points.

    ``n_crossing`` counts those of the section's tokens that reach into another one.
    """
    rows = docs.select(*carry, F.col(text).alias("_text"))
    added = T.StructType.fromDDL("section int, start long, end long, n_tokens long, n_crossing long")
    schema = T.StructType([*rows.schema.fields[:-1], *added.fields])
    names, kept = schema.names, len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokens(vocabulary_path, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, _SLICE):
                part = batch.slice(low, _SLICE)
                parts: list[tuple[np.ndarray, ...]] = []
                for k, value in enumerate(part.column(kept).to_pylist()):
                    value = value or ""
                    ends = np.asarray(sections(value), dtype=np.int64)
                    limits = byte_ends(value, value.encode(), ends)
                    section, crossing = attribute(tokens.ends(value), limits)
                    n = len(ends)
                    parts.append(
                        (
                            np.full(n, k),
                            np.arange(n),
                            np.concatenate(([0], ends[:-1])),
                            ends,
                            np.bincount(section, minlength=n),
                            np.bincount(section[crossing], minlength=n),
                        )
                    )
                row, *columns = (np.concatenate(c) for c in zip(*parts))
                arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.int64()] * 4))]
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(row)) for c in part.columns[:kept]), *arrays], names=names
                )

    return rows.mapInArrow(run, schema)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(
        read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    )
