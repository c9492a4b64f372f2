"""Exact, near and line dedup against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm import brute
from veil.llm import exact_dedup, graph, line_dedup, simhash

LONG = "word " * 60_000
EDGES = [
    (3, "a  b\tc"), (1, "a b c"), (2, None), (4, ""), (None, "a b c"), (None, None), (7, LONG), (9, LONG + "x"),
    (8, LONG), (5, " "), (6, "\n\n"), (1, "a b c"), (10, "Ünïcode 中文 "), (11, "ünïcode 中文 "), (12, "A B C"),
]


def test_exact_dedup(spark):
    got = exact_dedup.exact_dedup(brute.frame(spark, EDGES)).collect()
    clean = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in EDGES]
    size = Counter(clean)
    least = {c: min((d for (d, _), k in zip(EDGES, clean) if k == c and d is not None), default=None) for c in clean}
    expected = sorted((str(d), str(least[c]), size[c], brute.sha(c)) for (d, _), c in zip(EDGES, clean))
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == expected
    # one row of each group stays, also where rows repeat
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(brute.sha(c) for c in size)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_of_many_copies(spark):
    rows = spark.range(30_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same', concat('t', id)) AS text")
    got = exact_dedup.exact_dedup(rows)
    assert got.where("kept").count() == 20_001
    assert got.where("group_size = 10000 AND keep_id = 0").count() == 10_000


def test_exact_dedup_is_native(spark):
    plan = exact_dedup.exact_dedup(brute.frame(spark, EDGES))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExternalRDD", plan)


@pytest.mark.parametrize("text", ["", " ", "one", "Two words", "three Ä words", "a b c d a b c", LONG[:600], "x\x0by\x0cz\xa0w"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute.fingerprint(text)


def test_fingerprint_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "_PART", 7)
    assert simhash.fingerprint(text.encode()) == whole


def test_simhash_dedup(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 40))) for _ in range(30)]
    rows = EDGES + [(100 + i, rng.choice(base) + rng.choice(["", " x", " y z"])) for i in range(120)]
    fps = [brute.fingerprint(t or "") for _, t in rows]
    root = brute.components(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    least = {}
    for (d, _), r in zip(rows, root):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    got = simhash.simhash_dedup(brute.frame(spark, rows)).collect()
    expected = sorted((str(d), f"{fp:016x}", str(least.get(r))) for (d, _), fp, r in zip(rows, fps, root))
    assert sorted((str(x.doc_id), x.fingerprint, str(x.component_id)) for x in got) == expected


def test_one_of_each_group_stays(spark):
    docs = brute.frame(spark, EDGES)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    fps = [brute.fingerprint(t or "") for _, t in EDGES]
    root = brute.components(len(EDGES), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    assert kept.count() == len(set(root))


def test_pigeonhole_finds_every_close_pair(spark):
    rng = random.Random(5)
    fps = {0, 2**64 - 1}
    for _ in range(60):
        x = rng.getrandbits(64)
        fps |= {x, x ^ 1 << rng.randrange(64), x ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)}
    fps = sorted(fps)
    root = brute.components(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    nodes = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = {(r.a, r.b) for r in simhash.close_links(nodes).collect()}
    place = {s: i for i, s in enumerate(signed)}
    linked = {tuple(sorted((place[a], place[b]))) for a, b in links}
    assert brute.components(len(fps), lambda i, j: (j, i) in linked) == root


def test_large_groups_are_linked_like_small_ones():
    rng = np.random.default_rng(1)
    fps = np.unique(rng.integers(0, 1 << 22, 600).astype(np.uint64) << np.uint64(3))
    near = lambda i, j: int(fps[i] ^ fps[j]).bit_count() <= 2
    labels = simhash.group_labels(fps, [(3, 11), (14, 11)], 2)
    assert labels.tolist() == brute.components(len(fps), near)


def test_components_of_a_path_a_star_and_nothing(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 400)]
    edges = spark.createDataFrame([*path, *star, (5, 5)], "a long, b long")
    got = {r.node: r.root for r in graph.connected_components(edges).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 400)]}
    assert graph.connected_components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup(spark, monkeypatch, seed):
    rng = random.Random(seed)
    # small limits take every way: more rounds, split cells, block-wise pairing
    monkeypatch.setattr(line_dedup, "LIMIT", seed)
    words = [f"w{i}" for i in range(60)]
    base = [rng.choices(words, k=rng.randint(3, 25)) for _ in range(25)]
    rows = list(EDGES)
    for i in range(100):
        lines = []
        for _ in range(rng.randint(1, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                line[rng.randrange(len(line))] = rng.choice([*words, f"new{rng.randint(0, 999)}"])
            lines.append(" ".join(line) if rng.random() > 0.1 else "")
        rows.append((20 + i // 2 if rng.random() < 0.1 else 200 + i, "\n".join(lines)))
    gone = brute.later_lines(rows)
    expected = [
        (str(d), None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (r, k) not in gone))
        for r, (d, t) in enumerate(rows)
    ]
    got = line_dedup.line_dedup(brute.frame(spark, rows)).collect()
    assert sorted([(str(r.doc_id), r.text) for r in got], key=str) == sorted(expected, key=str)
    assert sum(r.n_removed for r in got) == len(gone)


def test_later_lines_names_what_line_dedup_removes(spark):
    rows = [(1, "a b c d e\nx"), (2, None), (3, "A b c d e f\n\ne d c b a"), (None, "a b c d e"), (4, "a b c d e\na b c d e")]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.removed) for r in line_dedup.later_lines(brute.frame(spark, rows)).collect()}
    assert got == {1: (2, 0, []), 2: (0, 0, []), 3: (3, 2, [0, 2]), 4: (2, 2, [0, 1]), None: (1, 1, [0])}


def _entries(rng, n, words):
    rows = np.zeros(n, line_dedup._ENTRY)
    rows["word"], rows["doc"] = rng.integers(0, words, n), rng.permutation(n)
    rows["size"], rows["sig"] = rng.integers(8, 16, n), rng.integers(0, 16, n)
    return rows


@pytest.mark.parametrize("paired", [0, 4, 10_000])
@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_candidate_pairs_of_a_cell(monkeypatch, paired, limit):
    monkeypatch.setattr(line_dedup, "_PAIRED", paired)
    rng = np.random.default_rng(limit)
    rows = _entries(rng, 300, 12)
    role = rng.integers(1, 4, 300)
    x, y, more = line_dedup.cell_pairs(rows, role, limit)

    def fits(i, j):
        small, large = sorted((int(rows["size"][i]), int(rows["size"][j])))
        need = -(-4 * (small + large) // 9)
        bits = int(rows["sig"][i] ^ rows["sig"][j]).bit_count()
        return 5 * small >= 4 * large and bits <= small + large - 2 * need and small >= need

    every = {
        j: {i for i in range(300) if rows["word"][i] == rows["word"][j] and rows["doc"][i] < rows["doc"][j] and role[i] & 1 and fits(i, j)}
        for j in range(300)
        if role[j] & 2
    }
    got = {}
    for i, j in zip(x.tolist(), y.tolist()):
        got.setdefault(j, []).append(i)
    assert all(len(set(i)) == len(i) == min(limit, len(every[j])) and set(i) <= every[j] for j, i in got.items())
    assert set(got) == {j for j, i in every.items() if i}
    # whoever has more candidates is named
    assert {j for j, i in every.items() if len(i) > limit} <= set(more.tolist()) <= {j for j, i in every.items() if len(i) >= limit}


def test_frequent_words_are_split_into_cells(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "_CHUNK_LINES", 4)
    docs = spark.createDataFrame([(i, f"one two three four five six seven eight nine w{i}") for i in range(40)], "doc_id long, text string")
    _, counts = line_dedup.line_table(docs)
    packed = line_dedup.packed_entries(docs, counts, 2)
    assert packed.where("i > 0").count() > 0
    found = line_dedup.candidates(packed, 1000).where("x.line >= 0")
    assert found.count() == 40 * 39 // 2


def test_empty_tables(spark):
    none = brute.frame(spark, []).limit(0)
    assert exact_dedup.exact_dedup(none).count() == 0
    assert simhash.simhash_dedup(none).count() == 0
    assert simhash.keep_one_of_each(none).count() == 0
    assert line_dedup.line_dedup(none).count() == 0
