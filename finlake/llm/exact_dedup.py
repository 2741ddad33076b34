"""Exact duplicates with a heavy-hitter split.

Misra-Gries summaries of each partition, merged, name the digests that may be frequent. One exact pass over the
named digests verifies their counts and winners; those few rows are broadcast, and copies of frequent texts are
settled where they are read. All other digests go through an ordinary shuffle of (id, place, digest) rows, in which no
group is large: a digest on more than 2 / (counters + 1) of the rows is always among the named ones.

Rows are told apart by where they stand (file and place in it), so null and repeated ids need no care.

Defined results: null counts as the empty text. Of equal texts the row with the largest id stays (null ids rank
lowest; of rows with the same text and id the last by file and place stays). Texts are equal when their SHA-256 digests
are; a very long text is hashed where it is read. An empty table gives no rows. Extra columns pass through `drop_copies`,
whatever their names.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.common import arrow, cut, named, per_batch, placed, whole

#: Counters of a Misra-Gries summary, and so the most frequent digests that are ever broadcast.
COUNTERS = 1000
#: Copies (their places, 16 bytes each) up to which `drop_copies` broadcasts them; beyond, places are joined in a shuffle.
FEW = 200_000
_COUNTS = "text_sha256 string, n long"


def digest(text: Column) -> Column:
    return F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)


def misra_gries(batches: Iterator[pa.RecordBatch], counters: int = COUNTERS) -> Iterator[pa.RecordBatch]:
    """A summary of `counters` digests at most, from (text_sha256) batches of one partition.

    Adding a batch's counts and then taking the (counters + 1)-th largest count from all of them is the merge of
    two summaries; it keeps the bound of n / (counters + 1) on what any count lacks."""
    held: Counter[str] = Counter()
    for batch in batches:
        for x in batch.column(0).value_counts().to_pylist():
            held[x["values"]] += x["counts"]
        if len(held) > counters:
            less = heapq.nlargest(counters + 1, held.values())[-1]
            held = Counter({k: n - less for k, n in held.items() if n > less})
    yield arrow(_COUNTS, text_sha256=list(held), n=list(held.values()))


def winners(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified winners of the frequent digests: text_sha256, top (id and place that stay), group_size; `counters` rows at most."""
    candidates = (
        per_batch(digests.select("text_sha256"), lambda it: misra_gries(it, counters), _COUNTS)
        .groupBy("text_sha256")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "text_sha256")
        .limit(counters)
        .where("n > 1")
        .select("text_sha256")
    )
    exact = digests.join(F.broadcast(cut(candidates)), "text_sha256", "left_semi")
    return cut(exact.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "file", "row")).alias("top"), F.count("*").alias("group_size")))


def decided(digests: DataFrame, counters: int) -> DataFrame:
    """Every row of `digests` with top and group_size of its text."""
    top = winners(digests, counters)
    frequent = digests.join(F.broadcast(top), "text_sha256")
    same = Window.partitionBy("text_sha256")
    rest = digests.join(F.broadcast(top), "text_sha256", "left_anti")
    rest = rest.withColumns({"top": F.max(F.struct("doc_id", "file", "row")).over(same), "group_size": F.count("*").over(same)})
    kept = (F.col("file") == F.col("top.file")) & (F.col("row") == F.col("top.row"))
    return frequent.unionByName(rest).withColumn("kept", kept)


def exact_dedup(df: DataFrame, text: str = "text", doc_id: str = "doc_id", counters: int = COUNTERS) -> DataFrame:
    """One row for each row of `df`: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = cut(placed(df, named(doc_id).alias("doc_id"), digest(named(text)).alias("text_sha256")))
    return decided(digests, counters).select("doc_id", F.col("top.doc_id").alias("keep_id"), "group_size", "kept", "text_sha256")


def drop_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id", counters: int = COUNTERS, few: int = FEW) -> DataFrame:
    """The rows of `df` that stay, with its columns. What stays is decided on ids, places and digests alone."""
    rows = placed(df, named(doc_id).alias("doc_id"), digest(named(text)).alias("text_sha256"), whole(df))
    digests = cut(rows.select("file", "row", "doc_id", "text_sha256"))
    gone = cut(decided(digests, counters).where("not kept").select("file", "row"))
    gone = F.broadcast(gone) if gone.count() <= few else gone
    return rows.select("file", "row", "whole").join(gone, ["file", "row"], "left_anti").select("whole.*")
