"""What the contracts say, row by row."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {k: k + 32 for k in range(65, 91)}
BLANKS = " \t\n\x0b\x0c\r"


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def ids_file(docs, encode):
    """docs: (doc_id, text) of unique ids."""
    out, start = {}, 0
    for d, t in sorted(docs):
        ids = [*encode(t or ""), 1]
        out[d] = (start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)
    return out


def repeated_bytes(docs, length):
    seen, out = set(), {}
    for d, t in sorted(docs):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if (s := raw[p : p + length]) in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[d] = (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept))
    return out


def shingles(text, width):
    words = WORD.findall((text or "").translate(FOLD))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1)))


def jaccard(docs, width, num, den):
    sets = {d: shingles(t, width) for d, t in docs}
    ids, parent = sorted(sets), {d: d for d in sets}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                p, q = top(a), top(b)
                parent[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), top(d)) for d in ids}


def lines(docs, least_chars, least_docs):
    def key(line):
        return line.strip(BLANKS).translate(FOLD)

    owners = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            owners[key(line)].add(d)
    out = {}
    for d, t in docs:
        every = (t or "").split("\n")
        kept = [x for x in every if not (len(key(x)) >= least_chars and len(owners[key(x)]) >= least_docs and max(owners[key(x)]) != d)]
        out[d] = (len(every), len(every) - len(kept), sha("\n".join(kept)))
    return out


def exact(docs):
    norm = {d: (t or "").translate(FOLD) for d, t in docs}
    last, size = {}, Counter(norm.values())
    for d, t in norm.items():
        last[t] = max(d, last.get(t, d))
    return {d: (last[t], size[t], last[t] == d, sha(t)) for d, t in norm.items()}
