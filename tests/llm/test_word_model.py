"""Words of the head are read and predicted as themselves, not by their spelling alone."""

import math

import numpy as np
from tests.llm.conftest import SCHEMA
from tillroll.llm import lm_network as network
from tillroll.llm import lm_scoring
from tillroll.llm.lm_data import END, Lookup, Vocabulary, Words, count_words, tokens


def _own_network(n=30):
    spelling = n + np.arange(n) % 2
    return network.initial(np.linspace(40, 1, n + 2), spelling=spelling)


def test_probabilities_of_symbols_add_up():
    params = _own_network()
    rng = np.random.default_rng(0)
    params["word_out"] += rng.standard_normal(params["word_out"].shape).astype(np.float32)
    first = rng.integers(0, 32, 5).astype(np.int32)
    start = network.score(params, [first])[0]
    texts = [np.append(first, k).astype(np.int32) for k in range(32)]
    assert math.isclose(np.exp(network.score(params, texts) - start).sum(), 1, rel_tol=1e-3)


def test_classes_and_groups_are_squares_of_ranks():
    of = network.layout(62, 30 + np.arange(30) % 32)
    groups, classes, words = of.levels
    assert words.starts.tolist() == [0, 1, 4, 9, 16, 25, 30, 62]
    assert classes.starts.tolist() == [0, 1, 4, 7] and groups.starts.tolist() == [0, 3]
    assert classes.row_of[[0, 1, 29, 61]].tolist() == [0, 1, 5, 6]
    assert groups.row_of[[0, 1, 29, 61]].tolist() == [0, 1, 2, 2]
    params = _own_network()
    again = network.unflatten(network.flatten(params), params["layout"])
    assert all((again[k] == params[k]).all() for k in params if k != "layout")


def _shaken(symbols=40, own=30, seed=5):
    """A network whose every weight matters."""
    rng = np.random.default_rng(seed)
    spelling = own + rng.integers(0, symbols - own, own)
    params = network.initial(rng.uniform(1, 50, symbols), spelling=spelling)
    for name in ("bias", *network._LEVELS):
        params[name] += rng.standard_normal(params[name].shape).astype(np.float32) * 0.3
    return params


def _plain_score(p, text):
    """The log-likelihood of one text by the definition, a number at a time."""
    of, h = p["layout"], network.HIDDEN
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    state, before, total = [0.0] * h, 0, 0.0
    for target in text:
        vector = [float(x) for x in p["embed"][before]]
        if before < len(of.base):
            vector = [x + float(y) for x, y in zip(vector, p["embed"][of.base[before]], strict=True)]
        gx = [float(b) + sum(x * float(w) for x, w in zip(vector, col, strict=True)) for b, col in zip(p["bias"], p["wx"].T, strict=True)]
        gh = [sum(x * float(w) for x, w in zip(state, col, strict=True)) for col in p["wh"].T]
        z = [sigmoid(gx[k] + gh[k]) for k in range(h)]
        r = [sigmoid(gx[h + k] + gh[h + k]) for k in range(h)]
        c = [math.tanh(gx[2 * h + k] + r[k] * gh[2 * h + k]) for k in range(h)]
        state = [(1 - z[k]) * state[k] + z[k] * c[k] for k in range(h)]
        for name, level in zip(network._LEVELS, of.levels, strict=True):
            row = level.row_of[target]
            node = level.node_of[row]
            scores = [
                float(w[-1]) + sum(x * float(y) for x, y in zip(state, w, strict=False))
                for w in p[name][level.starts[node] : level.starts[node + 1]]
            ]
            total += scores[row - level.starts[node]] - math.log(sum(map(math.exp, scores)))
        before = int(target)
    return total


def test_whole_documents_equal_the_plain_definition():
    """Also over windows, lanes and texts of very different lengths."""
    params, rng = _shaken(), np.random.default_rng(1)
    texts = [rng.integers(0, 40, n).astype(np.int32) for n in (1, 100, 3, 41, 0, 700, 16, 17)]
    for got, text in zip(network.score(params, texts), texts, strict=True):
        assert math.isclose(got, _plain_score(params, text), rel_tol=1e-4, abs_tol=1e-6)


def test_gradients_equal_differences():
    """After one step from nothing, the sums of squares show each number's gradient."""
    params, rng = _shaken(), np.random.default_rng(2)
    texts = [rng.integers(0, 40, 9).astype(np.int32) for _ in range(3)]
    (window,) = network.windows(texts, 3)
    lanes = window.inputs.shape[1]
    start = (0.1 * rng.standard_normal((network.HIDDEN, lanes))).astype(np.float32)

    def loss(p):
        after, *_ = network.forward(p, network._vectors(p), window.inputs, window.fresh * 0, start)
        logs = network.log_probabilities(p, after, window.targets.ravel(), window.real.ravel())
        return -logs.sum() / window.real.sum()

    moved = {k: v if k == "layout" else v.copy() for k, v in params.items()}
    memory = network.new_memory(params)
    window.fresh[:] = 0
    network.train_window(moved, memory, window, start, 1e-3)
    for name in network._SHAPES:
        scale = 0.01 if name in network._DENSE else 1.0
        grad = np.sqrt(memory[name] / scale) * np.sign(params[name] - moved[name])
        for place in np.argsort(-np.abs(grad).ravel())[:8]:
            at = np.unravel_index(place, grad.shape)
            sides = []
            for step in (1e-2, -1e-2):
                p = {k: v if k == "layout" else v.copy() for k, v in params.items()}
                p[name][at] += step
                sides.append(loss(p))
            difference = (sides[0] - sides[1]) / 2e-2
            assert math.isclose(difference, grad[at], rel_tol=0.03, abs_tol=2e-4), (name, at)


def test_a_very_long_text_takes_little_memory():
    import tracemalloc

    params, rng = _shaken(), np.random.default_rng(3)
    texts = [rng.integers(0, 40, 50).astype(np.int32) for _ in range(400)]
    texts.append(rng.integers(0, 40, 200_000).astype(np.int32))
    tracemalloc.start()
    alone = network.score(params, texts[-1:])[0]
    together = network.score(params, texts)
    network.train(params, network.new_memory(params), texts, 0.01)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert math.isclose(alone, together[-1], rel_tol=1e-5)
    assert most < 120e6


def test_learning_reads_long_texts_in_stretches():
    heads = network.windows([np.arange(1, 6), np.arange(6, 9)], 2, heads=[0, 5])
    window = next(heads)
    assert window.inputs[:5, 0].tolist() == [0, 1, 2, 3, 4] and window.inputs[:3, 1].tolist() == [5, 6, 7]
    assert window.real.sum() == 8 and window.fresh[0].tolist() == [1, 1]


def test_rounds_grow_with_the_corpus():
    assert [r[:2] for r in lm_scoring.rounds(1000)] == [(0, 1), (1, 4), (4, 16)]
    assert [r[:2] for r in lm_scoring.rounds(10**9)] == [(0, 1), (1, 4), (4, 16), (16, 64), (64, 256)]


def test_next_word_is_known_from_the_last(spark):
    # All words end alike, so they had the same input and the same class before.
    rng = np.random.default_rng(3)
    pair = lambda a, b: f"k{a}xaaa v{b}xaaa"
    rows = []
    for ident in range(600):
        rows.append((ident, " ".join(pair(k, k) for k in rng.integers(0, 30, 100)), "en", "s", 1))
    order = rng.integers(0, 30, 400)
    held = [i for i in range(1000, 2000) if _held_out(i)][:2]
    rows.append((held[0], " ".join(pair(k, k) for k in order), "en", "s", 1))
    rows.append((held[1], " ".join(pair(k, (k + 7) % 30) for k in order), "en", "s", 1))
    frame = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    got = {r.doc_id: r for r in lm_scoring.score_documents(frame).collect()}
    right, wrong = (got[i] for i in held)
    assert right.held_out and wrong.held_out
    print("per token", right.score / 801, wrong.score / 801, right.base_score / 801)
    assert right.score > wrong.score + 20


def _held_out(ident):
    import zlib

    return zlib.crc32(str(ident).encode()) % 10 == 0


def test_vocabulary_keeps_rare_words_by_spelling():
    words = Vocabulary(7, 3, {b"a": 5, END: 2, b"b": 1}, {END: 0, b"a": 1}, np.ones(34))
    assert (words.symbol_of(END), words.symbol_of(b"a")) == (0, 1)
    assert words.symbol_of(b"b") >= 2 and (words.spelling() >= 2).all()


def test_lookup_remembers_endings_only():
    words = Vocabulary(7, 3, {b"a": 5, END: 2, b"b": 1}, {END: 0, b"a": 1}, np.ones(258))
    lookup, rare = Lookup(words), [b"w%dend" % k for k in range(1000)]
    found = [b"a", *rare, b"b", END]
    symbols, counts = lookup(found)
    assert symbols.tolist() == [words.symbol_of(w) for w in found]
    assert counts.tolist() == [5, *[-1] * 1000, 1, 2]
    assert set(lookup._endings) == {b"end"}
    unlearned = Lookup(Vocabulary(0, 0, {}, {END: 0}, np.ones(257)))
    assert unlearned([b"x", END])[1].tolist() == [-1, -1]


def test_scores_beyond_the_range_of_exponentials():
    params, rng = _shaken(), np.random.default_rng(4)
    text = rng.integers(0, 40, 60).astype(np.int32)
    for name in network._LEVELS:
        params[name] *= 400
    assert all(len(network._wild(params[n], of)) for n, of in zip(network._LEVELS, params["layout"].levels))
    assert math.isclose(network.score(params, [text])[0], _plain_score(params, text), rel_tol=1e-3)
    network.train(params, network.new_memory(params), [text], 0.01)
    assert all(np.isfinite(params[n]).all() for n in network._SHAPES)


def test_learning_fills_its_windows(monkeypatch):
    """Lanes end together, also beside texts much longer than the others."""
    filled, step = [], network.train_window

    def noted(p, memory, window, state, rate):
        filled.append(window.real.sum())
        return step(p, memory, window, state, rate)

    monkeypatch.setattr(network, "train_window", noted)
    params, rng = _shaken(), np.random.default_rng(6)
    texts = [rng.integers(0, 40, n).astype(np.int32) for n in [100] * 1000 + [2500] * 20]
    assert network.train(params, network.new_memory(params), texts, 0.01) == sum(filled) == 150_000
    assert np.mean(filled) > 0.9 * max(filled)


def test_words_are_looked_up_together():
    """Short and long ones, with zero bytes and without, as one at a time."""
    texts = ["Ab  aB\tverylongword", None, "", " \x0b", "a\0 a \0 ninebytes EIGHTBYT Äb a\x1cb", "x" * 20, "verylongword a"]
    found = [tokens(text) for text in texts]
    head = {END: 7, b"a": 5, b"ab": 3, b"verylongword": 2, b"a\0": 2, b"eightbyt": 1}
    for words in (
        Vocabulary(30, 9, head, {END: 0, b"a": 1, b"verylongword": 2}, np.ones(259)),
        Vocabulary(0, 0, {}, {END: 0}, np.ones(257)),
    ):
        lookup = Lookup(words)
        symbols, counts, begins, unknown, spelled = lookup.of_words(Words([t and t.encode() for t in texts]))
        each = [lookup(f) for f in found]
        assert symbols.tolist() == np.concatenate([s for s, _ in each]).tolist()
        assert counts.tolist() == np.concatenate([c for _, c in each]).tolist()
        assert np.diff(np.append(begins, len(symbols))).tolist() == [len(f) for f in found]
        flat = [word for f in found for word in f]
        assert spelled == [flat[k] for k in unknown]


def test_words_are_counted_whole(spark):
    rows = [("Ab ab a\0 a\0 a ninebytes NINEBYTES",), (None,), ("",), ("eightbyt ab",)]
    counted = {bytes(r.word): r.c for r in count_words(spark.createDataFrame(rows, "text string"), "text").collect()}
    assert counted == {b"ab": 3, b"a\0": 2, b"a": 1, b"ninebytes": 2, b"eightbyt": 1, END: 4}
