"""Exact dedup: sorted runs of digests, merged by a tree.

Documents are dealt into ``FANIN ** LEVELS`` runs. A run is sorted by digest and cut into ranges of digests, so that
its parts lie in different partitions. In each round the runs of ``FANIN`` neighbours, three binomial
rounds at once, are exchanged range by range, merged in order, and the entries of one digest, now next to
each other, become one: the smallest identifier and the number of rows. After the last round every digest
has one entry, and the answer travels back down the same tree: each level joins the level above, so an
entry is asked for by ``FANIN`` entries at most, however many copies a text has. Only the last step touches
single rows, and the rows of one frequent text are spread over all runs there.

A digest stands for its text only together with a second, independent hash and the length; both are
part of the key at every level, so an entry that disagrees in either is never merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.llm.common import column, partitions, stored, text_of

FANIN, LEVELS = 8, 3
WHITE = r"[\x20\x09-\x0D]+"
# A run is cut into so many ranges of digests.
_RANGES = 1 << 16
_KEY = ["range", "digest", "check", "length"]


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space."""
    return F.regexp_replace(text, WHITE, " ")


def digest_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, row, run, digest, check, length``; no text leaves this step."""
    clean = normalised(text_of(text))
    return docs.select(
        column(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(clean, 256)).alias("digest"),
        F.xxhash64(clean).alias("check"),
        F.octet_length(clean).alias("length"),
    ).withColumns(
        {
            "run": F.pmod(F.xxhash64("row"), F.lit(FANIN**LEVELS)).cast("int"),
            "range": F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(_RANGES)).cast("int"),
        }
    )


def merged_runs(entries: DataFrame, fanin: int, first: Column, size: Column) -> DataFrame:
    """Exchange runs by range, ``fanin`` neighbours becoming one, in the order of their digests, and merge equal entries."""
    moved = entries.withColumn("run", F.floor(F.col("run") / fanin).cast("int"))
    runs = moved.repartition(max(partitions(entries.sparkSession), 1), "range", "run").sortWithinPartitions("range", "run", *_KEY[1:])
    return runs.groupBy("range", "run", *_KEY[1:]).agg(F.min(first).alias("first"), F.sum(size).alias("size"))


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are so after replacing runs of white space by one space; null is
    the empty text. ``keep_id`` is the smallest doc_id of the equal texts; a null doc_id is larger than
    any other. Of rows that repeat the same smallest doc_id, one is kept. Other columns are ignored.
    """
    rows = stored(digest_runs(docs, doc_id, text), "digests")
    # null ids after all others, rows with the same id by their place
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    levels = [merged_runs(rows, 1, first, F.lit(1).cast("long"))]
    for _ in range(LEVELS):
        levels.append(merged_runs(levels[-1], FANIN, F.col("first"), F.col("size")))
    answer = levels.pop()
    while levels:
        asked = levels.pop().select("run", *_KEY).withColumn("up", F.floor(F.col("run") / FANIN).cast("int"))
        answer = asked.join(answer.withColumnRenamed("run", "up"), ["up", *_KEY]).drop("up")
    return rows.join(answer, ["run", *_KEY]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
