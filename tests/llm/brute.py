"""Plain re-statements of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words10(text):
    return WORD.findall((text or "").translate(UPPER))


def contamination(docs, bench, span=10):
    windows = {}
    for item, text in bench:
        w = words10(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, items = words10(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i : i + n]))
                if got:
                    items |= got
                    hit.update(range(i, i + n))
        out.append((doc, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def simhash(text, shingle=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not w:
        return 0
    grams = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(ids, linked):
    """Smallest id reachable, for positions 0..n-1 with ids; linked(i, j)."""
    n = len(ids)
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                up[root(i)] = root(j)
    groups = {}
    for i in range(n):
        groups.setdefault(root(i), []).append(i)
    out = [None] * n
    for members in groups.values():
        known = [ids[i] for i in members if ids[i] is not None]
        for i in members:
            out[i] = min(known) if known else None
    return out
