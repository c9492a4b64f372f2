"""Plain versions of the text operators, for small tables."""

from __future__ import annotations

import hashlib
import re

import xxhash

SCHEMA = "doc_id long, text string, kept string, row int, fp long, line string, sequence_id string"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, "x", 1, 2, "y", "z") for d, t in rows], SCHEMA)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text: str) -> int:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n: int, linked) -> list[int]:
    """The smallest reachable place of each place."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def later_lines(rows, min_words=1):
    """``(row, line)`` of lines with an earlier line of Jaccard similarity 0.8 or more; the row decides between equal
    ids and line numbers."""
    lines = [
        (r, (d is None, d or 0, k, r), frozenset(x.lower().split()))
        for r, (d, t) in enumerate(rows)
        for k, x in enumerate((t or "").split("\n"))
    ]
    lines = [x for x in lines if len(x[2]) >= min_words]
    return {
        (r, o[2])
        for r, o, w in lines
        if any(o2 < o and 5 * len(w & w2) >= 4 * len(w | w2) for _, o2, w2 in lines)
    }


def shingle_set(text, length=5) -> frozenset:
    """The distinct shingles of a text in ASCII lower case; a shorter text is one shingle."""
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1)))


def dissimilar(texts) -> list[int]:
    """The places of texts without an earlier one of Jaccard similarity 0.8 or more."""
    sets = [shingle_set(t) for t in texts]
    return [i for i, s in enumerate(sets) if not any(5 * len(s & o) >= 4 * len(s | o) for o in sets[:i])]
