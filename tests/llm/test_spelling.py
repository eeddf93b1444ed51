"""Spelling variants against plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.plain import _LOWER
from tillroll.llm import spelling
from tillroll.llm.spelling import Index, near_words, variants, vocabulary

SCHEMA = "doc_id long, text string, n string, word string"


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced letter lies between the two."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_words(rows):
    counts = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            if ident is not None:
                h = zlib.crc32(f"{ident}:{run}".encode())
                if h % 31 == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {
        (w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()
    }


def some_words(count, letters, seed):
    dice = random.Random(seed)
    words = set()
    while len(words) < count:
        word = "".join(dice.choice(letters) for _ in range(dice.randrange(7, 13)))
        words.add(word)
        for _ in range(dice.randrange(4)):
            at, kind = dice.randrange(len(word)), dice.randrange(3)
            word = word[:at] + ["", dice.choice(letters), word[at] + dice.choice(letters)][kind] + word[at + 1 :]
            if len(word) >= 7:
                words.add(word)
    return sorted(words)


@pytest.mark.parametrize("letters", ["ab", "abcdé", "aßx"])
def test_index_finds_exactly_one_edit(letters):
    words = [w for w in some_words(300, letters, 2)]
    for n in range(7, 13):
        block = [w for w in words if len(w) == n]
        index = Index(block)
        for word in words:
            find = {n: index.replaced, n - 1: index.longer, n + 1: index.shorter}.get(len(word))
            if find:
                assert [block[i] for i in spelling._places(find(word))] == [v for v in block if one_edit(word, v)]


@pytest.mark.parametrize("block", [4096, 16])
def test_near_words_and_roots_equal_plain_ones(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    dice = random.Random(3)
    counts = {w: dice.choice([2, 2, 3, 30, 400, 5000, 60000]) for w in some_words(500, "abc", 4)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = variants(words).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(found) == len(counts)
    assert set(map(tuple, found)) == plain_variants(counts)
    assert len({r.root for r in found if r.form}) < len([r for r in found if r.form])


def test_vocabulary_of_odd_rows(spark):
    base = ["Maßstab straße ÉCOLIER écolier Hamburg hamburg", "hamburg's hamburg HAMBURGer", "", None, "12345 ,,, \n"]
    rows = [(k, base[k % 5], "n", "w") for k in range(400)] + [(None, "hamburg hamburgers écoliers", "n", "w")] * 3
    found = vocabulary(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert {(r.word, r.n) for r in found.collect()} == set(plain_words([r[:2] for r in rows]).items())
    assert len(plain_words([r[:2] for r in rows])) > 6


def test_empty(spark):
    words = vocabulary(spark.createDataFrame([], SCHEMA))
    assert variants(words).collect() == []
    assert near_words(words).collect() == []
