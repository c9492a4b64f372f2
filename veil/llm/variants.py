"""Spelling variants: words one edit apart, found through an index of grams of variable length.

A dictionary holds grams of up to ``LONGEST`` characters. A longer gram is in it only if the gram without
its last character is frequent in the words, so that a frequent gram is replaced by rarer, longer ones;
rare longer grams are pruned again. Its size is bounded by ``DIVISOR`` whatever the number of words.

A word is decomposed into the longest dictionary grams that begin at its characters, without those that
lie inside an earlier one. For every place of an edit, the grams that it can change are counted: those
across the place, those before it that a gram growing across it could swallow, and those behind it
that a gram reaching over from it could swallow. The largest count is the word's affected-gram bound:
two words one edit apart share all but that many of the grams of either. So they also share one of the
bound + 1 rarest grams of each word, and only the lists of those are merged, by gram, length and place.
The whole bound is tested on signatures before a pair is verified. A word whose every gram can be changed
by one edit uses all its grams; pairs of two such words are found by deleting each of their characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.llm.common import column, partitions, stored, text_of

RUNS = r"[a-zÀ-ÿ]+"
DAMAGE = 199
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
SHORTEST, LONGEST = 2, 3
# A gram is frequent above this share of all grams; a longer gram is kept above an eighth of that.
DIVISOR = 4096
_KEPT = 8
# Following forms, n grows by RATIO at each step, so a chain of a 64-bit count has fewer steps than 2 ** 5.
_DOUBLINGS = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of the words that take part: long enough and frequent enough after the damage.

    A run in lower case loses a character where the checksum of its document and itself says so.
    """
    lower = F.translate(text_of(text), _UPPER, _LOWER)
    runs = docs.select(
        F.coalesce(column(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lower, F.lit(RUNS), 0)).alias("run")
    ).where(F.length("run") >= MIN_LENGTH)
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    damaged = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    result = hashed.select(F.when(F.col("h") % DAMAGE == 0, damaged).otherwise(F.col("run")).alias("word"))
    counted = result.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def gram_dictionary(vocabulary: DataFrame) -> tuple[dict[str, int], int]:
    """The grams of the dictionary, with those of the shortest length, and how often each occurs in the words.

    At most ``_KEPT * DIVISOR`` grams of each length, and all of the shortest, of which there are fewer than
    pairs of letters.
    """
    at = F.explode(F.sequence(F.lit(1), F.length("word") - SHORTEST + 1))
    places = vocabulary.select("word", at.alias("at"))
    lengths = F.explode(F.array(*[F.lit(q) for q in range(SHORTEST, LONGEST + 1)]))
    grams = places.select("word", "at", lengths.alias("q")).where(F.col("at") + F.col("q") - 1 <= F.length("word"))
    counts = stored(grams.select(F.substring("word", F.col("at"), F.col("q")).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "grams")
    total = counts.where(F.length("gram") == SHORTEST).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    known = counts.where((F.length("gram") == SHORTEST) | (F.col("n") * (_KEPT * DIVISOR) > total))
    frequency = {r.gram: r.n for r in known.collect()}
    kept = {g: n for g, n in frequency.items() if len(g) == SHORTEST or frequency[g[:-1]] * DIVISOR > total}
    return kept, total


class Grams:
    """Decomposes words by a dictionary of grams with their frequencies."""

    def __init__(self, frequency: dict[str, int]):
        self.frequency = frequency
        self.known = {g for g in frequency if len(g) > SHORTEST}
        self.longest = max(map(len, self.known), default=SHORTEST)
        self.heads = {g[:i] for g in self.known for i in range(1, len(g))}
        self.tails = {g[i:] for g in self.known for i in range(1, len(g))}

    def decompose(self, word: str) -> list[tuple[int, int]]:
        """Start and end of the word's grams."""
        found, reach, n = [], 0, len(word)
        for p in range(n - SHORTEST + 1):
            for e in range(min(n, p + self.longest), p + SHORTEST, -1):
                if word[p:e] in self.known:
                    break
            else:
                e = p + SHORTEST
            if e > reach:
                found.append((p, e))
                reach = e
        return found

    def affected(self, word: str, found: list[tuple[int, int]]) -> int:
        """How many of the grams one edit can change at most."""
        n, most = len(word), 0
        for a in range(n + 1):
            # an edit between word[:a] and word[b:]: b = a inserts, b = a + 1 replaces or deletes
            first = next((p for p in range(max(0, a - self.longest + 1), a) if word[p:a] in self.heads), a)
            for b in (a, a + 1) if a < n else (a,):
                last = next((e for e in range(min(n, b + self.longest - 1), b, -1) if word[b:e] in self.tails), b)
                changed = sum(1 for p, e in found if (e > a and p < b) or (p < a < e) or (e <= a and p >= first) or (p >= b and e <= last))
                most = max(most, changed)
        return most


def signature(codes: np.ndarray) -> int:
    """64 bits in which each gram flips one: two words' differ in no more bits than their grams do."""
    return int(np.bitwise_xor.reduce(np.uint64(1) << (codes & np.uint64(63)), initial=np.uint64(0)).astype(np.int64))


_INDEX = "word string, n long, size int, shared int, sig long, lists array<struct<gram:string,at:int>>"


def gram_index(vocabulary: DataFrame, frequency: dict[str, int]) -> DataFrame:
    """Per word its number of grams, how many of them one edit leaves, their signature, and the lists it is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(frequency)
        rank = frequency.get
        for batch in batches:
            sizes, shared, sigs, lists = [], [], [], []
            for word in batch.column("word").to_pylist():
                found = grams.decompose(word)
                bound = grams.affected(word, found)
                times: dict[str, int] = {}
                codes = []
                for p, e in found:
                    g = word[p:e]
                    times[g] = times.get(g, 0) + 1
                    codes.append(xxhash.xxh64_intdigest(f"{times[g]}{g}"))
                # a gram that occurs more often is later; equal ones in the order of their text
                order = sorted(found, key=lambda x: (rank(word[x[0] : x[1]], 0), word[x[0] : x[1]]))
                sizes.append(len(found))
                shared.append(len(found) - bound)
                sigs.append(signature(np.array(codes, np.uint64)))
                lists.append([{"gram": word[p:e], "at": p} for p, e in (order[: bound + 1] if bound < len(found) else order)])
            columns = [batch.column("word"), batch.column("n"), pa.array(sizes, pa.int32()), pa.array(shared, pa.int32())]
            columns += [pa.array(sigs, pa.int64()), pa.array(lists, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "size", "shared", "sig", "lists"])

    kind = pa.list_(pa.struct([("gram", pa.string()), ("at", pa.int32())]))
    # a stored vocabulary is small in bytes and dear to decompose
    spread = vocabulary.repartition(partitions(vocabulary.sparkSession), "word")
    return stored(spread.mapInArrow(run, _INDEX), "gram-index")


def _one_edit(a: str, b: str) -> Column:
    return F.levenshtein(F.col(a), F.col(b), 1) == 1


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """``a, b, n_a, n_b``: all pairs of words that differ by one inserted, deleted or replaced character, each once."""
    frequency, _ = gram_dictionary(vocabulary)
    index = gram_index(vocabulary, frequency)
    entries = index.withColumn("list", F.explode("lists")).select(
        "word", "n", "size", "shared", "sig", F.length("word").alias("len"), F.col("list.gram").alias("gram"), F.col("list.at").alias("at")
    )
    # a word of the same length has a shared gram at the same place, a longer one there or one place on
    reach = F.array(*[F.struct((F.col("len") + l).alias("len"), (F.col("at") + p).alias("at")) for l, p in ((0, 0), (1, 0), (1, 1))])
    probes = entries.withColumn("to", F.explode(reach)).select(
        F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("size").alias("size_a"), F.col("shared").alias("shared_a"), F.col("sig").alias("sig_a"),
        "gram", F.col("to.len").alias("len"), F.col("to.at").alias("at"), F.col("len").alias("len_a"),
    )
    found = probes.join(entries.withColumnRenamed("word", "b"), ["gram", "len", "at"])
    differ = F.bit_count(F.col("sig_a").bitwiseXOR(F.col("sig"))) <= F.col("size_a") + F.col("size") - 2 * F.greatest("shared_a", "shared")
    once = (F.col("len_a") < F.col("len")) | (F.col("a") < F.col("b"))
    pairs = found.where(once & differ & _one_edit("a", "b")).select("a", "b", "n_a", F.col("n").alias("n_b"))

    weak = index.where("shared <= 0").select("word", "n")
    k = F.explode(F.sequence(F.lit(0), F.length("word")))
    cut = F.concat(F.substring("word", F.lit(1), F.col("k")), F.substring("word", F.col("k") + 2, F.length("word")))
    parts = weak.select("word", "n", k.alias("k")).select("word", "n", cut.alias("part")).distinct()
    left = parts.select(F.col("word").alias("a"), F.col("n").alias("n_a"), "part")
    others = left.join(parts.select(F.col("word").alias("b"), F.col("n").alias("n_b"), "part"), "part").where((F.col("a") < F.col("b")) & _one_edit("a", "b"))
    ordered = pairs.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
        F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"),
    )
    return ordered.unionByName(others.select("a", "b", "n_a", "n_b")).distinct()


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    A word's form is the most frequent of its near words (ties: the first in code-point order) if that is
    at least ``RATIO`` times as frequent as the word; its root is the last word reached by following forms.
    A null text has no words and a null doc_id hashes like an empty one; rows that repeat an id or a text
    count as often as they occur. No words give no rows. Other columns are ignored.
    """
    vocabulary = stored(words(docs, doc_id, text), "words")
    pairs = stored(near_pairs(vocabulary), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("n"), F.col("b").alias("near")).alias("best")).unionByName(
        pairs.select(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("n"), F.col("a").alias("near")).alias("best"))
    )
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best"))
    joined = vocabulary.join(near, "word", "left")
    follows = -F.col("best.n") >= RATIO * F.col("n")
    formed = stored(
        joined.select(
            "word", F.when(follows, F.col("best.near")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(follows, -F.col("best.n")).alias("form_n"),
        ),
        "forms",
    )
    steps = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for k in range(_DOUBLINGS):
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = stored(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots-{k}")
        moved = not steps.where("moved").isEmpty()
        steps = steps.drop("moved")
        if not moved:
            break
    return formed.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
