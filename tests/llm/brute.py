"""Plain single-process versions of the operators, for comparison in tests."""

import hashlib
import re
import zlib

WORD10 = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD6 = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def contamination(docs, items):
    """{doc_id: row} for docs {id: text}, items [(id, text)]."""
    windows = {}
    for item, text in items:
        w = WORD10.findall((text or "").encode().lower())
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = sorted({len(k) for k in windows})
    out = {}
    for d, text in docs:
        w = WORD10.findall((text or "").encode().lower())
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i:i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        ids = sorted(str(x) for x in found if x is not None)
        out[d] = (len(w), len(hit), len(ids), sha(",".join(ids).encode()), bool(hit))
    return out


def lines(docs, min_docs=10):
    """{doc_id: (n_lines, n_dropped, sha)}."""
    def key(line):
        return line.strip(b" \t\n\x0b\x0c\r").lower()

    seen = {}
    for d, text in docs:
        for line in (text or "").encode().split(b"\n"):
            seen.setdefault(key(line), set()).add(d)
    out = {}
    for d, text in docs:
        all_lines = (text or "").encode().split(b"\n")
        kept = [x for x in all_lines if not key(x) or len(seen[key(x)]) < min_docs]
        out[d] = (len(all_lines), len(all_lines) - len(kept), sha(b"\n".join(kept)))
    return out


def shingles(text):
    w = WORD6.findall((text or "").encode().lower())
    if not w:
        return frozenset()
    if len(w) < 5:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def components(docs):
    """{doc_id: (n_shingles, component)} by comparing every pair."""
    sets = [(d, shingles(t)) for d, t in docs]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = {}
    for i, (_, s) in enumerate(sets):
        for g in s:
            index.setdefault(g, []).append(i)
    for i, (d, s) in enumerate(sets):
        for j in {j for g in s for j in index[g] if j < i}:
            e, t = sets[j]
            if 100 * len(s & t) >= 75 * len(s | t):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets}


def crc(text):
    return zlib.crc32((text or "").encode())
