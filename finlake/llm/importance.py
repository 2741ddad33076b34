"""Target-distribution importance resampling on hashed n-grams, with CRC combination algebra.

Features of a text are all runs of 1 to `grams` consecutive words, joined by one space; a feature's bucket is the CRC-32 of its
UTF-8 bytes modulo `buckets`. The CRC of each word is computed once, for all words of an Arrow batch together, a byte of each
at a time. No n-gram is ever made as a string: the CRC of A, a space and B is that of A moved on by the length of what follows,
xor that of the rest; moving on by n bytes is a matrix over GF(2), and those of 1, 2, 4, ... bytes are kept as tables.

Passes over the rows: one counts buckets (a task sends its own sums, at most `buckets` of them), the others weigh, for the
bounds of the ranking's parts and then for the parts; weighing is cheaper than storing. The log ratio
of the target's and the corpus' share of a bucket is its gain, a text's weight is the sum of its features' gains, and weights
with Gumbel noise from a hash of the id, ranked, draw without replacement in proportion to exp(weight). Ranks come from a range
partitioning by score with offsets of its parts, so no task sees more than its part.

Defined results: null and empty texts have no features and weight 0; a null id's noise is that of the empty id; ids that repeat
get the same noise and rank by their place in the files; ties of score go to the smaller id, null last; an empty corpus or
target has counts of 0 everywhere; a very long text is one row's work, in time and space proportional to its length; extra
columns pass, and those that have the name of an added one are replaced.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finlake.llm.common import arrow, cut, named, no_clash, per_batch, placed, settled, whole

#: Longest feature in words, number of buckets, least words of a text that may be drawn, share drawn in percent.
GRAMS, BUCKETS, LEAST, PERCENT, SEED = 1, 10_000, 20, 10, "2024"
#: Parts of the ranking, each sorted on its own, that are written into one file.
PARTS_A_FILE = 8
#: The reflected polynomial of CRC-32, and the words whose CRC is computed byte by byte with all others.
POLYNOMIAL, SHORT = 0xEDB88320, 64
ADDED = "n_features long, n_words long, weight long"


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


_TABLE = _byte_table()
#: A byte of a word as its feature has it (A-Z in lower case), 0 for a byte that separates words.
LETTERS = np.zeros(256, np.uint8)
LETTERS[0x30:0x3A], LETTERS[0x61:0x7B], LETTERS[0x80:] = np.arange(0x30, 0x3A), np.arange(0x61, 0x7B), np.arange(0x80, 0x100)
LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)


@functools.cache
def _moves(bit: int) -> np.ndarray:
    """The matrix that moves a CRC on by 2 ** bit bytes, as four tables of what each byte of a CRC gives."""
    if bit == 0:
        columns = np.uint32(1) << np.arange(32, dtype=np.uint32)
        columns = _TABLE[columns & 255] ^ (columns >> np.uint32(8))
    else:
        half = _moves(bit - 1)
        columns = _moved_once(half, _moved_once(half, np.uint32(1) << np.arange(32, dtype=np.uint32)))
    tables = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for b in range(8):
            tables[k] ^= np.where(np.arange(256) >> b & 1, columns[8 * k + b], np.uint32(0)).astype(np.uint32)
    return tables


def _moved_once(tables: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    return tables[0][crcs & 255] ^ tables[1][crcs >> 8 & 255] ^ tables[2][crcs >> 16 & 255] ^ tables[3][crcs >> 24]


def moved(crcs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRCs moved on by so many bytes each."""
    out = crcs.copy()
    for bit in range(int(sizes.max(initial=0)).bit_length()):
        at = np.flatnonzero(sizes >> bit & 1)
        out[at] = _moved_once(_moves(bit), out[at])
    return out


def word_crcs(letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The CRC-32 of each word: the k-th bytes of all words that have one together."""
    crcs = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    active = np.flatnonzero(sizes <= SHORT)
    k = 0
    while len(active):
        now = crcs[active]
        crcs[active] = _TABLE[(now ^ letters[starts[active] + k]) & 255] ^ (now >> np.uint32(8))
        k += 1
        active = active[sizes[active] > k]
    crcs ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes > SHORT).tolist():
        crcs[i] = zlib.crc32(letters[starts[i] : starts[i] + sizes[i]].tobytes())
    return crcs


def hashed(texts: pa.Array, grams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of every feature of a batch, and each row's number of words."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    if texts.buffers()[2] is None or bounds[-1] == bounds[0]:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(n, np.int64)
    letters = LETTERS[np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]]
    bounds = bounds - bounds[0]
    inside = letters != 0
    first = np.zeros(len(letters) + 1, bool)
    first[bounds] = True  # a row's first byte begins a word of its own
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside
    ends[:-1] &= ~ends[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    sizes = np.flatnonzero(ends) + 1 - starts
    del inside, ends, begins, first
    rows = np.searchsorted(bounds, starts, "right") - 1
    words = word_crcs(letters, starts, sizes)
    found, of = [words], [rows]
    # A space and a word, as one piece to put after another.
    space = np.uint32(zlib.crc32(b" "))
    spaced = moved(np.full(len(words), space, np.uint32), sizes) ^ words if grams > 1 else words
    now = words
    for k in range(1, grams):
        if len(now) < 2:
            break
        now = moved(now[:-1], sizes[k:] + 1) ^ spaced[k:]
        inside = rows[k:] == rows[:-k]
        found.append(now[inside])
        of.append(rows[k:][inside])
    crcs = np.concatenate(found)
    return np.concatenate(of), crcs.astype(np.int64) % buckets, np.bincount(rows, minlength=n)


def bucket_counts(df: DataFrame, text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """bucket and n of all features of `df`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(hashed(batch.column(0), grams, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield arrow("bucket long, n long", bucket=at, n=total[at])

    return per_batch(df.select(named(text)), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, in thousandths, rounded down."""
    has, wants = float(sum(corpus.values()) + buckets), float(sum(target.values()) + buckets)
    ratio = ((target.get(b, 0) + 1.0) * has / ((corpus.get(b, 0) + 1.0) * wants) for b in range(buckets))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def fitted(df: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Gains from all rows of both tables. At most `buckets` sums of each come to the driver."""
    counts = (bucket_counts(f, t, grams, buckets).collect() for f, t in ((df, text), (target, target_text)))
    return gains(*({r["bucket"]: r["n"] for r in c} for c in counts), buckets)


def weighed(df: DataFrame, gain: np.ndarray, text: str = "text", grams: int = GRAMS) -> DataFrame:
    """`df` without its text, with n_features, n_words and weight."""
    new = StructType.fromDDL(ADDED)
    rest = no_clash(df, *new.names, text)
    out = StructType(rest.schema.fields + new.fields)
    frame = df.select(*[named(c) for c in rest.columns], named(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, buckets, n_words = hashed(batch.column(batch.num_columns - 1), grams, len(gain))
            sums = np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, rows, gain[buckets])
            mine = (np.bincount(rows, minlength=batch.num_rows), n_words, sums)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(x, pa.int64()) for x in mine)], names=out.names)

    return per_batch(frame, run, out)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(df: DataFrame, eligible: Column, score: Column, ties: list[Column], percent: int) -> DataFrame:
    """`df` with rank: 1, 2, 3, ... of the floor(percent * n / 100) highest scores among the n eligible rows, null elsewhere.
    Rows are sorted in parts by range, whose offsets follow from their counts."""
    order = [F.col("drawable").desc(), F.col("by").desc_nulls_last(), *ties]
    spread = df.withColumns({"drawable": F.coalesce(eligible, F.lit(False)), "by": score})
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = spread.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # Part and place of a row, settled by writing them; rows are short, so several parts go into one file.
    kept = cut(ordered.withColumn("at", F.monotonically_increasing_id()).coalesce(max(1, parts // PARTS_A_FILE)))
    part, place = F.shiftright("at", 33).cast("int"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = {r["part"]: r["n"] for r in kept.where("drawable").groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # one row a part
    before, total = {}, 0
    for p in sorted(counts):
        before[p], total = total, total + counts[p]
    if not before:
        return kept.withColumn("rank", F.lit(None).cast("long")).drop("at", "drawable", "by")
    offsets = F.broadcast(df.sparkSession.createDataFrame(list(before.items()), "part int, before long"))  # one row a part
    rank = F.when(F.col("drawable"), F.col("before") + place + 1)
    found = kept.withColumn("part", part).join(offsets, "part", "left")
    return found.withColumn("rank", F.when(rank <= percent * total // 100, rank).cast("long")).drop("at", "drawable", "by", "part", "before")


def resample(
    df: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text",
    grams: int = GRAMS, buckets: int = BUCKETS, least: int = LEAST, percent: int = PERCENT, seed: str = SEED,
) -> DataFrame:
    """Every row of `df` without its text, with n_features, n_words, weight, score and rank (null: not drawn)."""
    gain = fitted(df, target, text, target_text, grams, buckets)
    rest = no_clash(df, text, "n_features", "n_words", "weight", "score", "rank")
    frame = placed(df, named(doc_id).alias("id"), whole(rest), named(text).alias("body"))
    scores = weighed(frame, gain, "body", grams).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    out = ranked(scores, F.col("n_words") >= least, F.col("score"), [F.col("id").asc_nulls_last(), F.col("file"), F.col("row")], percent)
    return out.select("whole.*", "n_features", "n_words", "weight", "score", "rank")


def draw(df: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """The drawn rows of `df` as they are, texts too, with weight, score and rank. Texts are joined by place."""
    df = settled(no_clash(df, "weight", "score", "rank"))
    bodies = placed(df, whole(df))
    names = placed(df, named(doc_id).alias("doc"), named(text).alias("body"))
    drawn = resample(names, target, "body", "doc", **settings).where(F.col("rank").isNotNull())
    return bodies.join(drawn.select("file", "row", "weight", "score", "rank"), ["file", "row"]).select("whole.*", "weight", "score", "rank")
