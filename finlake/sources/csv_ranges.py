"""CSV files whose cells may hold line breaks, read in byte ranges.

Spark splits such a file only if cells hold no breaks: a range that begins inside a quoted cell can't tell. Here the file is
read as lines, in whatever ranges Spark makes. A first pass gives each range's parity of quotes and how many records would
begin in it, were it to begin outside or inside a cell. The parities' prefix xor says which of the two holds, the counts'
prefix sums number the records. A second pass puts records together: those that lie in one range go straight on, and only
the pieces of those that cross a range's edge are brought together. Nothing is shuffled besides these pieces.

Defined results: a quote inside a cell is doubled, and a cell with quotes, commas or breaks is quoted; blank lines between
records are none; a cell that is never closed is a `CsvError`; so are ranges that changed between the passes (another number
of cores), never wrong rows; records may end in a line feed or a carriage return and a line feed, and cells keep theirs; an
empty file has no records; a record may span any number of ranges. The driver holds one short row per range, as Spark does.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: A range: its file (a hash of the path), first byte and length; parity of its quotes; records that begin in it if it
#: begins outside of a cell, or inside one.
RANGES = "file long, begins long, size long, odd int, outside long, inside long"
PIECES = "file long, record long, begins long, whole boolean, text string"


class CsvError(ValueError):
    """A file that isn't CSV of whole records."""


def lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the files at `path`, in the order of each range, with their range, parity of quotes and whether blank."""
    frame = spark.read.text(path, lineSep="\n")
    about = frame.metadataColumn("_metadata")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return frame.select(
        F.xxhash64(about["file_path"]).alias("file"),
        about["file_block_start"].alias("begins"),
        about["file_block_length"].alias("size"),
        (quotes % 2).cast("int").alias("odd"),
        F.col("value").isin("", "\r").cast("int").alias("blank"),
        F.col("value").alias("text"),
    )


def _counted():
    # Made here, not a module's function: workers need not have this package.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per range, when its last line has gone by."""
        import numpy as np

        names, held, out = ("file", "begins", "size", "odd", "outside", "inside"), None, []
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            where = np.stack(columns[:3])
            edges = [0, *(np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                key = where[:, a].tolist()
                if held is None or held[:3] != key:
                    out += [held] if held else []
                    held = [*key, 0, 0, 0]
                odd, real = columns[3][a:b], columns[4][a:b] == 0
                before = (held[3] + np.cumsum(odd) - odd) & 1
                held[4] += int(np.count_nonzero((before == 0) & real))
                held[5] += int(np.count_nonzero((before == 1) & real))
                held[3] = int(held[3] + odd.sum()) & 1
        out += [held] if held else []
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=list(names))

    return run


def ranges(rows: list) -> dict[tuple[int, int], tuple[int, int, int]]:
    """Of each range by (file, begins): its length, whether it begins inside a cell (1), and how many records begin before it."""
    found, inside, before, last = {}, 0, 0, None
    for file, begins, size, odd, outside, within in sorted(map(tuple, rows)):
        if file != last:
            if inside:
                raise CsvError("a quoted cell is never closed")
            last, before = file, 0
        found[file, begins] = (size, inside, before)
        before += within if inside else outside
        inside ^= odd
    if inside:
        raise CsvError("a quoted cell is never closed")
    return found


def _assembled(known: dict[tuple[int, int], tuple[int, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        names = ["file", "record", "begins", "whole", "text"]
        here, parity, record, opened = None, 0, 0, None  # opened: record, its lines so far, whether it began in this range

        def some(rows: list) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            columns, text = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)], batch.column(5)
            where = np.stack(columns[:3])
            edges = [0, *(np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                key = tuple(where[:2, a].tolist())
                if key != here:
                    if opened:
                        yield some([(here[0], opened[0], here[1], False, "\n".join(opened[1]))])
                    if key not in known or known[key][0] != int(where[2, a]):
                        raise RuntimeError("CSV_RANGES_CHANGED: the file's ranges aren't those of the first pass; run it again")
                    here = key
                    _, parity, record = known[key]
                    opened = (record - 1, [], False) if parity else None
                odd, blank = columns[3][a:b], columns[4][a:b]
                after = (parity + np.cumsum(odd)) & 1
                before = after ^ (odd & 1)
                starts = (before == 0) & (blank == 0)
                number = record + np.cumsum(starts) - 1
                done, slow = np.flatnonzero(starts & (after == 0)), []
                n = len(done)
                whole = [pa.array(np.full(n, here[0])), pa.array(number[done]), pa.array(np.full(n, here[1])), pa.array(np.ones(n, bool)), pc.take(text, pa.array(done + a)).cast(pa.string())]
                for i in np.flatnonzero((before == 1) | (after == 1)).tolist():
                    if starts[i]:
                        opened = (int(number[i]), [], True)
                    opened[1].append(text[a + i].as_py())
                    if not after[i]:
                        slow.append((here[0], opened[0], here[1], opened[2], "\n".join(opened[1])))
                        opened = None
                if slow:  # in their places among the others
                    whole = [pa.concat_arrays(pair) for pair in zip(whole, some(slow).columns, strict=True)]
                    order = pa.array(np.argsort(whole[1].to_numpy(), kind="stable"))
                    whole = [pc.take(c, order) for c in whole]
                yield pa.RecordBatch.from_arrays(whole, names=names)
                parity, record = int(after[-1]), int(record + starts.sum())
        if opened:
            yield some([(here[0], opened[0], here[1], False, "\n".join(opened[1]))])

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, record (0, 1, ... in each file) and text of all records of the files at `path`; those of a range are in its order."""
    found = lines(spark, path)
    known = ranges(found.drop("text").mapInArrow(_counted(), RANGES).collect())  # one row per range
    pieces = found.mapInArrow(_assembled(known), PIECES)
    out = pieces.where("whole").select("file", "record", "text")
    if any(inside for _, inside, _ in known.values()):
        parts = pieces.where("not whole").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("begins", "text"))).alias("parts"))
        out = out.unionByName(parts.select("file", "record", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text")))
    return out.withColumn("text", F.regexp_replace("text", "\r$", ""))


def read(spark: SparkSession, path: str, columns: list[str], null: str = "\x00", numbered: str | None = None) -> DataFrame:
    """All-string rows of the CSV files at `path`, whose first records are headers; with a column named `numbered`, if that is
    given, that numbers the rows of each file from 1."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    options = {"multiLine": "true", "escape": '"', "mode": "FAILFAST", "nullValue": null, "emptyValue": ""}
    rows = records(spark, path).where("record > 0")
    parsed = rows.select(F.from_csv("text", F.lit(schema.toDDL()), options).alias("row"), F.col("record").cast("int").alias("number"))
    return parsed.select("row.*", *([F.col("number").alias(numbered)] if numbered else []))


def header(spark: SparkSession, path: str) -> list[str]:
    """The cells of a file's first line, which the driver reads, wherever Spark reads the file."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        first = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return [] if first is None else first.split(",")
