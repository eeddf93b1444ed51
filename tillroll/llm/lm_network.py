"""A gated recurrent network over symbols, in numpy: truncated backpropagation, many texts side by side.

Output is class-factored, in three levels, each a softmax on the state: ``P(symbol | state) = P(group | state) *
P(class | group, state) * P(symbol | class, state)``. Own symbols come most frequent first, and class ``k`` holds those
of rank ``k * k`` up to the next square; groups hold classes in the same way. So with ``n`` of them there are about
``sqrt(n)`` classes of at most ``2 * sqrt(n)``, and frequent symbols are in small classes and small groups. The symbols
after the own ones follow in classes of ``SPELLING_TOGETHER``. An own symbol's input vector is its own one plus that of
its spelling.

Texts are dealt to *lanes*; a lane reads one text after the other. At the start of a text the state is zero,
otherwise it is carried on, also from one window to the next; gradients end at the window. Arrays have the lanes
last, so that each operation runs over long rows, and classes are met in one sorted run of the window's tokens.

Learning cuts a text into stretches that are read side by side, each from a zero state; a stretch has ``STRETCH``
tokens at most and fits its lane, so that all lanes end together and windows stay full. Scoring reads every text from
its start to its end. Memory is that of the tokens given and of one window, however long
a single text is; where few texts are left, windows in scoring get longer instead of wider.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

EMBED, HIDDEN = 8, 12
WINDOW = 16
LANES = 2048
LEARNED_LANES = 1536  # at most in learning: wider windows cost less a token, but make fewer steps
STEPS = 64  # windows that learning makes of a few texts, at least
STRETCH = 2048
SCORED_AT_ONCE = 1 << 15  # tokens in a window of scoring
SPELLING_TOGETHER = 32
PART = 1500  # tokens in one matrix product
MOST_SCORE = 60.0  # up to which exponentials, and sums and quotients of them, are safe in single precision
_COUNT = np.arange(PART)
_ONES = np.ones(PART, dtype=np.float32)
_LEVELS = ("group_out", "class_out", "word_out")  # a row is the weights of the state, then the bias
_SHAPES = ("embed", "wx", "wh", "bias", *_LEVELS)
_DENSE = ("wx", "wh", "bias")
_NO_WORDS = np.empty(0, dtype=np.int64)


@dataclass(frozen=True)
class Level:
    """Rows of one level in nodes; a softmax goes over the rows of a node."""

    starts: np.ndarray  # first row of each node, then the end
    row_of: np.ndarray  # of each symbol
    node_of: np.ndarray  # of each row

    @property
    def rows(self) -> int:
        return len(self.node_of)

    def behind(self, times: np.ndarray) -> np.ndarray:
        """How many of the symbols' occurrences each row has taken part in."""
        by_row = np.bincount(self.row_of, weights=times, minlength=self.rows)
        return np.add.reduceat(by_row, self.starts[:-1])[self.node_of]


def _level(starts: np.ndarray, row_of: np.ndarray) -> Level:
    return Level(starts, row_of, np.repeat(np.arange(len(starts) - 1), np.diff(starts)))


@dataclass(frozen=True)
class Layout:
    """Which symbols there are, and the tree that their probabilities are factored by."""

    base: np.ndarray  # for each own symbol, the symbol of its spelling
    levels: tuple[Level, Level, Level]  # groups, classes, symbols

    @property
    def symbols(self) -> int:
        return self.levels[-1].rows


def _squares(n: int) -> np.ndarray:
    """0, 1, 4, ... below ``n``."""
    return np.arange(math.isqrt(n - 1) + 1 if n else 0, dtype=np.int64) ** 2


def layout(symbols: int, spelling: np.ndarray = _NO_WORDS) -> Layout:
    """The first ``len(spelling)`` symbols are own ones."""
    own = len(spelling)
    words = np.concatenate([_squares(own), np.arange(own, symbols, SPELLING_TOGETHER), [symbols]])
    word_level = _level(words, np.arange(symbols))
    class_of = word_level.node_of
    groups = np.append(_squares(len(words) - 1), len(words) - 1)
    class_level = _level(groups, class_of)
    group_level = _level(np.array([0, len(groups) - 1]), class_level.node_of[class_of])
    return Layout(spelling, (group_level, class_level, word_level))


def shapes(of: Layout) -> dict[str, tuple[int, ...]]:
    return {
        "embed": (of.symbols, EMBED),
        "wx": (EMBED, 3 * HIDDEN),
        "wh": (HIDDEN, 3 * HIDDEN),
        "bias": (3 * HIDDEN,),
        **{name: (level.rows, HIDDEN + 1) for name, level in zip(_LEVELS, of.levels, strict=True)},
    }


def initial(mass: np.ndarray, seed: int = 1, spelling: np.ndarray = _NO_WORDS) -> dict:
    """Small weights; the output starts as the symbols' share of the corpus. Frequent own symbols start with input
    vectors of their own, the rarer the closer to their spelling."""
    rng = np.random.default_rng(seed)
    of = layout(len(mass), spelling)
    made: dict = {"layout": of}
    for name, shape in shapes(of).items():
        scale = 1.0 if name == "embed" else shape[0] ** -0.5 if name in ("wx", "wh") else 0.0
        made[name] = (rng.standard_normal(shape) * scale).astype(np.float32)
    own = len(spelling)
    made["embed"][:own] *= np.minimum(1.0, 4.0 / np.sqrt(1.0 + np.arange(own)))[:, None].astype(np.float32)
    for name, level in zip(_LEVELS, of.levels, strict=True):
        by_row = np.bincount(level.row_of, weights=mass, minlength=level.rows)
        made[name][:, -1] = np.log(by_row / level.behind(mass))
        # Groups and classes start with small weights, words with none: few of them are seen at once.
        if name != "word_out":
            made[name][:, :-1] = rng.standard_normal((level.rows, HIDDEN)) * 0.03
    return made


def flatten(params: dict) -> np.ndarray:
    return np.concatenate([params[n].ravel() for n in _SHAPES])


def unflatten(flat: np.ndarray, of: Layout) -> dict:
    out, at = {"layout": of}, 0
    for name, shape in shapes(of).items():
        size = int(np.prod(shape))
        out[name] = np.array(flat[at : at + size], dtype=np.float32).reshape(shape)
        at += size
    return out


def spread(inputs: np.ndarray, times: np.ndarray, of: Layout) -> np.ndarray:
    """Per parameter the tokens that are behind it: for a symbol's input vector and for the rows of a node,
    those that touched it. ``times`` says how often each symbol was predicted."""
    behind = {"embed": inputs}
    behind |= {name: level.behind(times) for name, level in zip(_LEVELS, of.levels, strict=True)}
    seen = times.sum()
    parts = []
    for name, shape in shapes(of).items():
        rows = behind.get(name, np.full(shape[0], seen))
        parts.append(np.repeat(rows, int(np.prod(shape[1:]))))
    return np.concatenate(parts)


def _vectors(p: dict) -> np.ndarray:
    """The input vector of each symbol."""
    base = p["layout"].base
    out = p["embed"].copy()
    out[: len(base)] += p["embed"][base]
    return out


@dataclass
class Window:
    """What the network reads at once; arrays are ``[steps, lanes]``."""

    inputs: np.ndarray
    targets: np.ndarray
    fresh: np.ndarray  # 1 where a text starts
    real: np.ndarray  # 0 beyond the end of a lane
    place: np.ndarray  # the number of the text


def forward(p: dict, vectors: np.ndarray, inputs: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: bool = True):
    """Run a window on from ``state [hidden, lanes]``. Returns the states after each step and, for learning
    (``keep``), the states before, the gates and the inner product of the candidate; each ``[steps, .., lanes]``."""
    steps, lanes = inputs.shape
    h = HIDDEN
    # The update and reset gates are met with the opposite sign, as their exponentials need it.
    sign = np.repeat(np.float32([-1, 1]), [2 * h, h])[:, None]
    wh, bias = np.ascontiguousarray(p["wh"].T * sign), p["bias"][:, None] * sign
    gates = np.matmul(p["wx"].T * sign, vectors[inputs].transpose(0, 2, 1))
    gates += bias
    after = np.empty((steps, h, lanes), dtype=np.float32)
    before = np.empty((steps, h, lanes), dtype=np.float32) if keep else None
    inner = np.empty((steps if keep else 1, 3 * h, lanes), dtype=np.float32)
    for t, starting in enumerate(fresh.any(axis=1)):
        start = state * (1 - fresh[t]) if starting else state
        gh = np.matmul(wh, start, out=inner[t if keep else 0])
        zr, c = gates[t, : 2 * h], gates[t, 2 * h :]
        zr += gh[: 2 * h]
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        c += zr[h:] * gh[2 * h :]
        np.tanh(c, out=c)
        state = np.subtract(c, start, out=after[t])
        state *= zr[:h]
        state += start
        if keep:
            before[t] = start
    return after, (before, gates, inner[:, 2 * h :]) if keep else None, state


class Sorted:
    """The tokens of a window in the order of their targets' classes, so that each node's tokens are one run on every
    level; runs that are long are met in parts, which small matrix products are fastest with."""

    def __init__(self, of: Layout, after: np.ndarray, targets: np.ndarray, real: np.ndarray):
        class_of = of.levels[-1].node_of.astype(np.int16 if len(of.levels[-1].starts) < 1 << 15 else np.int64)
        order = np.argsort(class_of[targets], kind="stable")
        # Ordered by class is ordered by group as well. What is not real is left out.
        self.order = order[real[order] > 0]
        self.targets = targets[self.order]
        # [steps, hidden, lanes] to [hidden, tokens], and a constant one that meets the bias
        states = after.transpose(1, 0, 2).reshape(after.shape[1], -1)[:, self.order]
        self.states = np.concatenate([states, np.ones((1, len(self.order)), dtype=np.float32)])

    def runs(self, level: Level) -> Iterator[tuple]:
        """``first row, end, low, high, places`` for each part of a node of several rows: those of the targets in an
        array of a row for each of the node's and a column for each token."""
        rows = level.row_of[self.targets]
        sizes = np.bincount(level.node_of[rows], minlength=len(level.starts) - 1)
        ends = np.cumsum(sizes)
        several = np.diff(level.starts) > 1
        for node in np.flatnonzero(several & (sizes > 0)):
            first, end = int(level.starts[node]), int(level.starts[node + 1])
            at = rows[ends[node] - sizes[node] : ends[node]] - first
            for low in range(0, len(at), PART):
                part = at[low : low + PART]
                begin = int(ends[node] - sizes[node]) + low
                yield first, end, begin, begin + len(part), part * len(part) + _COUNT[: len(part)]


def _wild(weights: np.ndarray, level: Level) -> np.ndarray:
    """The first rows of the nodes whose scores could leave the range of exponentials. No number of a state is beyond
    1, so a row's weights bound its scores."""
    reach = np.maximum.reduceat(np.abs(weights).sum(axis=1), level.starts[:-1])
    return level.starts[:-1][~(reach < MOST_SCORE)]


def _scores(weights: np.ndarray, states: np.ndarray, wild: bool) -> np.ndarray:
    """Of each row in each state; in a wild node the greatest of each column as 0."""
    scores = weights @ states
    if wild:
        scores -= scores.max(axis=0)
    return scores


def _exponentials(scores: np.ndarray) -> np.ndarray:
    """In place; returns the sums of the columns."""
    np.exp(scores, out=scores)
    return _ONES[: len(scores)] @ scores if len(scores) <= PART else scores.sum(axis=0)


def _adapt(p: dict, memory: dict, name: str, grad: np.ndarray, rate: float) -> None:
    """A step of its own size for each number, by all gradients so far; without a gradient there is none."""
    memory[name] += grad * grad
    step = np.sqrt(memory[name])
    step += 1e-4
    np.divide(grad, step, out=step)
    step *= rate
    p[name] -= step


def _learn_output(p: dict, memory: dict, after: np.ndarray, targets: np.ndarray, real: np.ndarray, rate: float):
    """Steps of all outputs; the gradient of the states ``[steps, hidden, lanes]``."""
    share = np.float32(1.0 / max(real.sum(), 1.0))
    tokens = Sorted(p["layout"], after, targets, real)
    d_sorted = np.zeros((HIDDEN, len(tokens.order)), dtype=np.float32)
    for name, level in zip(_LEVELS, p["layout"].levels, strict=True):
        weights, grad = p[name], np.zeros_like(p[name])
        backward, wild = np.ascontiguousarray(weights[:, :-1].T), set(_wild(weights, level).tolist())
        for first, end, low, high, wanted in tokens.runs(level):
            states = tokens.states[:, low:high]
            e = _scores(weights[first:end], states, first in wild)
            e *= share / _exponentials(e)
            e.reshape(-1)[wanted] -= share
            d_sorted[:, low:high] += backward[:, first:end] @ e
            grad[first:end] += e @ states.T
        _adapt(p, memory, name, grad, rate)
    steps, hidden, lanes = after.shape
    d_after = np.zeros((hidden, steps * lanes), dtype=np.float32)
    d_after[:, tokens.order] = d_sorted
    return d_after.reshape(hidden, steps, lanes).transpose(1, 0, 2)


def _learn_inputs(p: dict, memory: dict, read: np.ndarray, d_read: np.ndarray, rate: float) -> None:
    """Steps of the input vectors: what an own symbol is moved by, its spelling is moved by as well."""
    base, symbols = p["layout"].base, len(p["embed"])
    grad = np.stack([np.bincount(read, weights=d, minlength=symbols) for d in d_read], axis=1)
    if len(base):
        grad += np.stack([np.bincount(base, weights=g, minlength=symbols) for g in grad[: len(base)].T], axis=1)
    _adapt(p, memory, "embed", grad.astype(np.float32), rate)


def train_window(p: dict, memory: dict, window: Window, state: np.ndarray, rate: float) -> np.ndarray:
    """One step of truncated backpropagation with normalised (RMS) steps; returns the carried state."""
    steps, lanes = window.inputs.shape
    h = HIDDEN
    vectors = _vectors(p)
    after, (before, gates, inner), last = forward(p, vectors, window.inputs, window.fresh, state)
    d_states = _learn_output(p, memory, after, window.targets.ravel(), window.real.ravel(), rate)
    carried = np.zeros((h, lanes), dtype=np.float32)
    d_gates = np.empty((steps, 3 * h, lanes), dtype=np.float32)
    d_inner = np.empty((steps, 3 * h, lanes), dtype=np.float32)
    starting = window.fresh.any(axis=1)
    for t in range(steps - 1, -1, -1):
        ds = carried
        ds += d_states[t]
        z, r, c, start = gates[t, :h], gates[t, h : 2 * h], gates[t, 2 * h :], before[t]
        dz, dr, dc = d_gates[t, :h], d_gates[t, h : 2 * h], d_gates[t, 2 * h :]
        by_z = ds * z
        np.multiply(c, c, out=dc)
        np.subtract(1, dc, out=dc)
        dc *= by_z
        np.multiply(dc, r, out=d_inner[t, 2 * h :])
        np.subtract(c, start, out=dz)
        dz *= by_z
        np.subtract(1, r, out=dr)
        dr *= d_inner[t, 2 * h :]
        dr *= inner[t]
        dz *= 1 - z
        d_inner[t, : 2 * h] = d_gates[t, : 2 * h]
        carried = p["wh"] @ d_inner[t]
        carried += ds
        carried -= by_z
        if starting[t]:
            carried *= 1 - window.fresh[t]
    g = {
        "wh": np.matmul(before, d_inner.transpose(0, 2, 1)).sum(axis=0),
        "wx": np.matmul(d_gates, vectors[window.inputs]).sum(axis=0).T,
        "bias": d_gates.sum(axis=2).sum(axis=0),
    }
    d_read = np.matmul(p["wx"], d_gates).transpose(1, 0, 2)
    _learn_inputs(p, memory, window.inputs.ravel(), d_read.reshape(EMBED, -1), rate)
    for name, grad in g.items():
        memory[name] = 0.99 * memory[name] + 0.01 * grad * grad
        p[name] -= rate * grad / (np.sqrt(memory[name] / (1 - 0.99 ** memory["steps"])) + 1e-4)
    memory["steps"] += 1
    return last


def new_memory(p: dict) -> dict:
    return {"steps": 1, **{n: np.zeros_like(p[n]) for n in _SHAPES}}


def windows(
    texts: Sequence[np.ndarray], lanes: int, at_once: int = 0, heads: Sequence[int] | None = None
) -> Iterator[Window]:
    """Deal symbol sequences to lanes and cut the lanes into windows.

    The longest texts are dealt first, each to the shortest lane. The input of a text's first token is its head: the
    end, 0, where none is given. A window has ``WINDOW`` steps, or more as long as it stays within ``at_once`` tokens.
    """
    lanes = max(1, min(lanes, len(texts)))
    filled: list[list[int]] = [[] for _ in range(lanes)]
    free = [(0, lane) for lane in range(lanes)]
    for k in sorted(range(len(texts)), key=lambda k: -len(texts[k])):
        used, lane = heapq.heappop(free)
        filled[lane].append(k)
        heapq.heappush(free, (used + len(texts[k]), lane))
    # Longer lanes first: the lanes that still have something to read are then always the first ones.
    filled.sort(key=lambda members: -sum(len(texts[k]) for k in members))
    order = [k for members in filled for k in members]
    lengths = np.array([len(texts[k]) for k in order], dtype=np.int64)
    targets = np.concatenate([texts[k] for k in order]).astype(np.int32)
    place = np.repeat(np.array(order, dtype=np.int32), lengths)
    starts = np.cumsum(lengths) - lengths
    inputs = np.empty_like(targets)
    inputs[1:] = targets[:-1]
    starting = starts[lengths > 0]
    inputs[starting] = 0 if heads is None else np.array(heads, dtype=np.int32)[order][lengths > 0]
    fresh = np.zeros(len(targets), dtype=np.float32)
    fresh[starting] = 1
    length = np.array([sum(len(texts[k]) for k in members) for members in filled], dtype=np.int64)
    begin = np.cumsum(length) - length
    t = 0
    while t < length[0]:
        active = int((length > t).sum())
        steps = min(max(WINDOW, at_once // active), int(length[0]) - t)
        along = t + np.arange(steps)[:, None]
        within = along < length[:active]
        at = begin[:active] + np.minimum(along, length[:active] - 1)
        real = within.astype(np.float32)
        yield Window(
            np.where(within, inputs[at], 0), np.where(within, targets[at], 0), np.where(within, fresh[at], 1), real, place[at]
        )
        t += steps


def train(p: dict, memory: dict, texts: list[np.ndarray], rate: float) -> int:
    """All tokens of the texts once; the number of tokens learned from."""
    total = sum(map(len, texts))
    # Few tokens: fewer lanes and so more steps. A window that only some lanes are left in steps less far.
    lanes = min(LEARNED_LANES, max(16, total // (STEPS * WINDOW)))
    stretch = min(STRETCH, max(STEPS * WINDOW, -(-total // lanes)))
    parts = [(k, at) for k, text in enumerate(texts) for at in range(0, len(text), stretch)]
    if not parts:
        return 0
    stretches = [texts[k][at : at + stretch] for k, at in parts]
    heads = [int(texts[k][at - 1]) if at else 0 for k, at in parts]
    lanes = min(lanes, len(parts))
    state, n = np.zeros((HIDDEN, lanes), dtype=np.float32), 0
    for window in windows(stretches, lanes, heads=heads):
        share = float(window.real.sum()) / (lanes * WINDOW)
        state = train_window(p, memory, window, state[:, : window.inputs.shape[1]], rate * min(share, 1.0))
        n += int(window.real.sum())
    return n


def log_probabilities(p: dict, after: np.ndarray, targets: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Of the target after each state of ``after [steps, hidden, lanes]``; 0 where it is not real."""
    tokens = Sorted(p["layout"], after, targets, real)
    picked = np.zeros(len(tokens.order), dtype=np.float32)
    for name, level in zip(_LEVELS, p["layout"].levels, strict=True):
        wild = set(_wild(p[name], level).tolist())
        for first, end, low, high, wanted in tokens.runs(level):
            scores = _scores(p[name][first:end], tokens.states[:, low:high], first in wild)
            chosen = scores.reshape(-1)[wanted]
            picked[low:high] += chosen - np.log(_exponentials(scores))
    logs = np.zeros(len(targets), dtype=np.float64)
    logs[tokens.order] = picked
    return logs


def score(p: dict, texts: list[np.ndarray]) -> np.ndarray:
    """The natural log-likelihood of each whole symbol sequence."""
    sums = np.zeros(len(texts), dtype=np.float64)
    if not sum(map(len, texts)):
        return sums
    vectors = _vectors(p)
    state = np.zeros((HIDDEN, min(LANES, len(texts))), dtype=np.float32)
    for window in windows(texts, LANES, SCORED_AT_ONCE):
        lanes = window.inputs.shape[1]
        after, _, state = forward(p, vectors, window.inputs, window.fresh, state[:, :lanes], keep=False)
        logs = log_probabilities(p, after, window.targets.ravel(), window.real.ravel())
        sums += np.bincount(window.place.ravel(), weights=logs, minlength=len(texts))
    return sums
