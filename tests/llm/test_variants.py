"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

from tests.llm import brute
from veil.llm import variants


def vocabulary(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 199 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            count[w] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def near_words(counted):
    """By words equal after one deletion; checked against all pairs below."""
    shared = {}
    for w in counted:
        for part in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            shared.setdefault(part, []).append(w)
    near = {w: set() for w in counted}
    for group in shared.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    return near


def expected(counted):
    near = near_words(counted)
    form = {}
    for w, n in counted.items():
        best = min(near[w], key=lambda x: (-counted[x], x), default=None)
        form[w] = best if best and counted[best] >= 5 * n else None
    rows = []
    for w, n in counted.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counted.get(form[w])))
    return sorted(rows)


def got(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def odd_rows(seed, n_docs):
    """Words over few letters, many one edit apart, some frequent."""
    rng = random.Random(seed)
    base = ["".join(rng.choices("abéÿ", k=rng.randrange(5, 13))) for _ in range(60)] + ["ABABABAB", "abababa", "aaaaaa", "aaaaaaa", "Straße", "naïve×ly"]
    rows = []
    for i in range(n_docs):
        out = []
        for _ in range(40):
            w = rng.choice(base[:: rng.choice([1, 1, 7])])
            if rng.random() < 0.4:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("ab") + w[k:], w[:k] + rng.choice("ab") + w[k + 1 :]])
            out.append(w)
        rows.append((rng.choice([i, i, 5, None]), rng.choice([None, "", " ".join(out), "_".join(out), ".\n".join(out)])))
    return rows


def test_brute_force_by_deletion_is_all_pairs():
    counted = vocabulary(odd_rows(3, 60))
    near = near_words(counted)
    assert all((b in near[a]) == one_edit(a, b) for a in counted for b in counted)


def test_odd_documents(spark):
    rows = odd_rows(1, 600) + [(9000, " ".join(["chainlink"] * 300 + ["chainlinks"] * 40 + ["chainlinksy"] * 6))]
    counted = vocabulary(rows)
    wanted = expected(counted)
    assert len(wanted) > 150 and any(r[1] and r[2] != r[1] for r in wanted)
    assert got(variants.spelling_variants(brute.frame(spark, rows).repartition(4))) == wanted


def test_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    wanted = expected(vocabulary([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    assert got(variants.spelling_variants(docs)) == wanted


def test_bounds_hold_for_every_edit():
    """Words one edit apart share at least as many grams as the bounds of both say."""
    rng = random.Random(7)
    frequency = {}
    sample = ["".join(rng.choices("abc", [5, 3, 1], k=rng.randrange(6, 14))) for _ in range(400)]
    for w in sample:
        for p in range(len(w)):
            for q in range(2, 6):
                if p + q <= len(w):
                    frequency[w[p : p + q]] = frequency.get(w[p : p + q], 0) + 1
    frequency = {g: n for g, n in frequency.items() if len(g) == 2 or rng.random() < 0.4}
    grams = variants.Grams(frequency)
    for w in sample:
        own = grams.decompose(w)
        for _ in range(12):
            k = rng.randrange(len(w))
            v = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abc") + w[k:], w[:k] + rng.choice("abc") + w[k + 1 :]])
            if v == w or len(v) < 6:
                continue
            other = grams.decompose(v)
            shift = {0} if len(v) == len(w) else {0, len(v) - len(w)}
            kept = sum(any(w[p:e] == v[x:y] and x - p in shift for x, y in other) for p, e in own)
            assert kept >= len(own) - grams.affected(w, own)


def test_few_words_and_empty_tables(spark):
    rows = [(i, "Lonely") for i in range(9)]
    one = brute.frame(spark, rows)
    assert got(variants.spelling_variants(one)) == expected(vocabulary(rows)) != []
    for rows in ([(1, None), (2, ""), (3, "short")], [(1, "seldom")]):
        assert got(variants.spelling_variants(brute.frame(spark, rows))) == []
    assert variants.spelling_variants(one.limit(0)).count() == 0
