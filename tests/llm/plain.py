"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def quality(text):
    ws = words(text)
    text = text or ""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    return {
        "n_words": len(ws),
        "word_chars": sum(map(len, ws)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(ws) < 50 or 100 * len(covered) > 50 * len(ws),
    }


def shingles(text, k=4):
    ws = words((text or "").translate(_LOWER))
    if not ws:
        return frozenset()
    k = min(k, len(ws))
    return frozenset(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))


def classes(rows, percent=85, k=4):
    """``{id: (size, least id reachable)}`` for rows of (id, text)."""
    sets = {i: shingles(t, k) for i, t in rows}
    owners = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            owners[g].append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    common = Counter()
    for ids in owners.values():
        for x, a in enumerate(ids):
            for b in ids[x + 1 :]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def base_secrets(text):
    text = text or ""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    order = ("assign", "access", "hex")
    return sorted(spans, key=lambda s: (s[1], order.index(s[0])))


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(data: bytes):
    return zlib.crc32(data)
