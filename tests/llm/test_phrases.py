"""Phrase collocations against plain counting, and the trie on its own."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.plain import _LOWER
from tillroll.llm import phrases
from tillroll.llm.phrases import HatTrie, chunks, collocations

SCHEMA = "doc_id long, text string, lang string, rank string, n string"


def plain(rows, least, top, longest=5):
    counts = defaultdict(Counter)
    total = Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rated = []
        for p, a in candidates.items():
            inside = any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            )
            if inside:
                continue
            cuts = [(1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rated.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rated)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def rows():
    dice = random.Random(5)
    words = ["the", "The", "of", "new", "york", "city", "hall", "a", "straße", "é", "x\x1cy", "Ä"]
    out = []
    for k in range(300):
        parts = [dice.choice(words) for _ in range(dice.randrange(40))]
        if k % 3 == 0:
            parts[5:5] = ["new", "york", "city", "hall", "park"]
        text = "".join(p + dice.choice([" ", " ", " ", " ", "\t", ", ", ".", "\n", "\x0b", "  "]) for p in parts)
        out.append((k, text, dice.choice(["en", "en", "fr", None, "und"]), "r", "n"))
    return [*out, (None, None, "en", None, None), (1, "", None, None, None), out[0], out[0]]


@pytest.mark.parametrize(("least", "top"), [(5, 50), (20, 2000)])
def test_equals_plain_counting(spark, least, top):
    table = rows()
    found = collocations(spark.createDataFrame(table, SCHEMA).repartition(3), least, top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == plain([(r[1], r[2]) for r in table], least, top)


def rows_of(batches):
    return [r for batch in batches for r in batch.to_pylist()]


def test_early_spills_change_nothing(monkeypatch):
    small = dict(TRIE_ENTRIES=30, BURST_ENTRIES=3, KNOWN_WORDS=5, FLUSH_TOKENS=50, CHUNK_BYTES=40)
    for name, value in small.items():
        monkeypatch.setattr(phrases, name, value)
    batch = [(t, la) for _, t, la, _, _ in rows()]
    table = pa.RecordBatch.from_pydict({"lang": [la for _, la in batch], "text": [t for t, _ in batch]})
    everything = phrases.Frequent(np.full(phrases.FILTER_BITS // 8, 255, dtype=np.uint8))
    got = Counter()
    for r in rows_of(phrases._count_words(iter([table]))):
        got[r["lang"], r["phrase"]] += r["n"]
    runs = [*phrases._count_phrases(phrases.Pass(everything, counted=(2, 3), parts=7))(iter([table]))]
    part_of = {}
    for r in rows_of(runs):
        assert r["phrases"] == sorted(r["phrases"], key=str.encode) and 0 <= r["part"] < 7
        for phrase, n in zip(r["phrases"], r["counts"], strict=True):
            got[r["lang"], phrase] += n
            prefix = (r["lang"], *phrase.split(" ")[:2])
            assert part_of.setdefault(prefix, r["part"]) == r["part"]
    assert len(runs) > 2 and len(set(part_of.values())) > 1
    want = Counter()
    for text, lang in batch:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOWER)):
            found = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                want.update((lang or "und", " ".join(found[i : i + n])) for i in range(len(found) - n + 1))
    assert got == want


@pytest.mark.parametrize("buckets", [1 << 24, 1 << 13])
def test_full_buckets_never_lose_a_phrase(spark, monkeypatch, buckets):
    """Few buckets clash often: more is counted, the result is the same. (Workers see the module's own number.)"""
    monkeypatch.setattr(phrases, "BUCKETS", buckets)
    dice = np.random.default_rng(4)
    parts = []
    total = np.zeros(buckets, dtype=np.int64)
    for _ in range(5):
        counters = (dice.random(buckets) < 0.01).astype(np.int32) * dice.integers(1, 9, buckets)
        total += np.minimum(counters, 12)
        parts += rows_of(phrases._bucket_rows(counters.astype(np.int32), 12))
    table = pa.Table.from_pylist(sorted(parts, key=lambda r: r["place"]), schema=phrases._BUCKETS_ARROW)
    bits = np.zeros(buckets, dtype=bool)
    for r in rows_of(phrases._added(12)(iter(table.to_batches()))):
        part = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        bits[r["place"] * phrases.BUCKETS_A_ROW :][: len(part)] = part
    assert (bits == (total >= 12)).all() and bits.any()


def test_trie_bursts_and_gives_all_back():
    trie = HatTrie(burst=2, depth=3)
    dice = random.Random(1)
    want = Counter()
    for _ in range(4000):
        phrase = tuple(dice.randrange(1, 6) for _ in range(dice.randrange(1, 6)))
        count = dice.randrange(1, 4)
        trie.add(phrase, count)
        want[phrase] += count
    got = Counter()
    for word in trie.largest():
        for phrase, count in trie.take(word):
            assert phrase not in got
            got[phrase] = count
    assert got == want
    assert not trie.root and not trie.entries


def test_chunks_break_at_separators_only():
    text = "Ab c,d\te\x0bf é. " * 200_000
    whole = [w for part in chunks(text) for w in part]
    assert len([*chunks(text)]) > 1
    assert [w for w in whole if w != b"\xff"] == re.sub(r"[,.\x0b]", " ", text).translate(_LOWER).encode().split()


def test_empty_table(spark):
    assert collocations(spark.createDataFrame([], SCHEMA)).collect() == []
