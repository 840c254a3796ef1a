"""Plain Python versions of the operators that SQL cannot express."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLANK = " \t\n\x0b\f\r"


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


class Union:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def suffix_dedup(docs: list[tuple[int, str]], k: int = 50) -> dict:
    first: dict[bytes, int] = {}
    for i, text in sorted(docs):
        raw = text.encode()
        for j in range(len(raw) - k + 1):
            first.setdefault(raw[j : j + k], i)
    out = {}
    for i, text in docs:
        raw = text.encode()
        gone = bytearray(len(raw))
        for j in range(len(raw) - k + 1):
            if first[raw[j : j + k]] < i:
                gone[j : j + k] = b"\1" * k
        spans = sum(1 for j in range(len(raw)) if gone[j] and (j == 0 or not gone[j - 1]))
        out[i] = (len(raw), sum(gone), spans, sha(bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return out


def substring_dedup(docs: list[tuple[int, str]], k: int = 13) -> dict:
    words = {i: WORD.findall(t) for i, t in docs}
    first: dict[tuple, int] = {}
    for i in sorted(words):
        for j in range(len(words[i]) - k + 1):
            first.setdefault(tuple(words[i][j : j + k]), i)
    out = {}
    for i, ws in words.items():
        gone = [False] * len(ws)
        for j in range(len(ws) - k + 1):
            if first[tuple(ws[j : j + k])] < i:
                gone[j : j + k] = [True] * k
        out[i] = (len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone, strict=True) if not g))
    return out


def fingerprint(text: str, n: int = 3) -> int:
    ws = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    parts = [" ".join(ws[j : j + n]) for j in range(len(ws) - n + 1)] if len(ws) >= n else [" ".join(ws)] * bool(ws)
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(docs: list[tuple[int, str]], radius: int = 2) -> dict:
    ids = sorted(i for i, _ in docs)
    prints = {i: fingerprint(t) for i, t in docs}
    values = np.array([prints[i] for i in ids], np.uint64)
    groups = Union(ids)
    for n, i in enumerate(ids):
        for m in np.flatnonzero(np.bitwise_count(values[n + 1 :] ^ values[n]) <= radius):
            groups.join(i, ids[n + 1 + m])
    return {i: (f"{prints[i]:016x}", groups.find(i)) for i in ids}


def line_dedup(docs: list[tuple[int, str]], n: int = 9, least: float = 0.8) -> dict:
    place: dict[str, tuple[int, int]] = {}
    for i, text in sorted(docs):
        for j, line in enumerate(text.split("\n")):
            if line.strip(_BLANK):
                place.setdefault(line, (i, j))
    names = sorted(place)
    groups, index, sets = Union(range(len(names))), {}, []
    for x, line in enumerate(names):
        own = {line[j : j + n] for j in range(max(len(line) - n, 0) + 1)}
        sets.append(own)
        for y, both in Counter(y for g in own for y in index.get(g, ())).items():
            if both >= least * (len(own) + len(sets[y]) - both):
                groups.join(x, y)
        for g in own:
            index.setdefault(g, []).append(x)
    best: dict[int, tuple[int, int]] = {}
    for x, line in enumerate(names):
        root = groups.find(x)
        best[root] = min(best.get(root, place[line]), place[line])
    kept_at = {line: best[groups.find(x)] for x, line in enumerate(names)}
    out = {}
    for i, text in docs:
        lines = text.split("\n")
        solid = [bool(line.strip(_BLANK)) for line in lines]
        stay = [line for j, line in enumerate(lines) if not solid[j] or kept_at[line] == (i, j)]
        out[i] = (sum(solid), len(lines) - len(stay), "\n".join(stay))
    return out


def token_counts(docs, path, limit=2048):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    out = {}
    for i, text in docs:
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        out[i] = (len(text.encode()), n, n > limit)
    return out


def merkle(rows, fanout=8):
    """(id, group, leaf, altered leaf) rows -> per row subroot, root, joined siblings, folded root."""

    def h(text):
        return hashlib.sha256(text.encode()).hexdigest()

    def tree(nodes):
        """The root, and for each node the siblings left and right of every step."""
        ways = [[] for _ in nodes]
        held = [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            above, below = [], []
            for b in range(0, len(nodes), fanout):
                run = nodes[b : b + fanout]
                for s in range(len(run)):
                    for leaf in held[b + s]:
                        ways[leaf].append(("".join(run[:s]), "".join(run[s + 1 :])))
                above.append(h("".join(run)))
                below.append([x for part in held[b : b + fanout] for x in part])
            nodes, held = above, below
        return nodes[0] if nodes else None, ways

    groups = {}
    for row in sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(row[1], []).append(row)
    lower = {g: tree([r[2] for r in own]) for g, own in groups.items()}
    root, upper = tree([top for top, _ in lower.values()])
    out = []
    for (g, own), up in zip(groups.items(), upper, strict=True):
        subroot, ways = lower[g]
        for (i, _, leaf, altered), way in zip(own, ways, strict=True):
            node = altered
            for left, right in way + up:
                node = h(left + node + right)
            out.append((i, leaf, subroot, root, "".join(a + b for a, b in way + up), node))
    return out


def whitening(vectors, components=16):
    """Rows of finite floats -> n, exact deviations, whitened, explained shares."""
    import math
    from fractions import Fraction

    import numpy as np

    xs = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    fit = sorted({tuple(x) for x in xs})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit, strict=True)]
    dims = range(len(sums))
    centred = [[n * x[j] - sums[j] for j in dims] for x in fit]
    v = np.array([[float(Fraction(sum(c[i] * c[j] for c in centred), n**3)) for j in dims] for i in dims])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviations = [[n * x[j] - sums[j] for j in dims] for x in xs]
    whitened = np.array(deviations, float) / n @ vectors / np.sqrt(values)
    return n, [sum(d * d for d in row) for row in deviations], whitened, values / np.trace(v)
