"""Mixing sources to target weights.

Each source's texts are packed, in a hashed order, into a stream of words cut into fixed-length blocks. Output
shards draw their source counts from a multinomial over what each source's quota has left, so that the counts add up
to the quotas. A source's slots, numbered over all shards, walk through a pseudorandom permutation of its blocks,
a new one for each pass; blocks and texts are then joined by block index.

`takings` is that join: one row for each piece of a text that a slot of a shard takes. `mix_blocks` gives the shards' blocks,
`mix_texts` the pieces with their texts' columns, shard by shard and slot by slot, and `mix_counts` what each text gave.

Defined results: null texts and texts without words have size 0 and are never taken; a null source is a source of its
own, last in order; an empty table gives no rows. Repeated rows are rows of their own, whose place in the order goes by file
and place in it. A very long text is cut into its blocks where it is read. Extra columns pass through `mix_texts`, whatever
their names. What is collected is one row per source, which is the size of the mixture's own definition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.common import arrow, cut, let, n_words_of, named, per_batch, placed, settled, whole, words_of

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
BLOCK = 128
SHARDS = 256
SEED = 20240607
#: Sources up to which their targets are broadcast; beyond, they are joined in a shuffle.
FEW = 20_000
#: Slots numbered in one go, and by one row of the plan.
_SLOTS, _RUN = 1 << 16, 1 << 20
_PLAN, _SLOT = "shard int, source int, first long, n long, blocks long", "source int, block long, shard int, slot long"


def targets(sizes: Sequence[int], weights: Sequence[int], most: int = MAX_REPEAT) -> list[Fraction]:
    """What each source gives: the total shared by weight, none above `most` times its size, the excess reshared."""
    total, out, open_ = sum(sizes), [Fraction(0)] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        share = Fraction(left, sum(weights[i] for i in open_))
        above = {i for i in open_ if share * weights[i] > most * sizes[i]}
        for i in above or open_:
            out[i] = Fraction(most * sizes[i]) if above else share * weights[i]
        open_ = open_ - above if above else set()
    return out


def draws(quotas: Sequence[int], shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """Slots for each shard (row) and source (column): multinomial draws over the open quotas, never above them."""
    left, rng = np.asarray(quotas, dtype="int64").copy(), np.random.default_rng(seed)
    out = np.zeros((shards, len(left)), dtype="int64")
    for k in range(shards):
        n = -(-int(left.sum()) // (shards - k))
        while n:
            got = np.minimum(rng.multinomial(n, left / left.sum()), left)
            out[k] += got
            left -= got
            n -= int(got.sum())
    return out


def permuted(at: np.ndarray, n: int, key: int) -> np.ndarray:
    """Places 0..n-1 under the pseudorandom permutation `key`: a four-round Feistel network, walked until inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, mix = np.uint64((1 << half) - 1), np.uint64(0x9E3779B97F4A7C15)
    out, todo = at.astype("uint64"), np.ones(len(at), dtype=bool)
    while todo.any():
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            f = (right + np.uint64((key * 4 + r + 1) & ((1 << 63) - 1))) * mix
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = out >= np.uint64(n)
    return out.astype("int64")


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, source, first, n, blocks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for at in range(first, first + n, _SLOTS):
                slot = np.arange(at, min(at + _SLOTS, first + n), dtype="int64")
                block = np.empty_like(slot)
                for turn in range(int(slot[0] // blocks), int(slot[-1] // blocks) + 1):
                    here = slot // blocks == turn
                    block[here] = permuted(slot[here] % blocks, blocks, SEED + 1000 * source + turn)
                yield arrow(_SLOT, source=np.full(len(slot), source, "int32"), block=block, shard=np.full(len(slot), shard, "int32"), slot=slot)


def mixture(df: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", block: int = BLOCK, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(texts, takings). texts: file, row, doc_id, size, source_size, target for each row of `df`. takings: shard, slot (of
    the source, counted over all shards), source (its number in order), block, at (where in the block), and file, row, first
    word and words of the piece, for each piece of a text that a slot takes."""
    spark = df.sparkSession
    name = F.when(named(source).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), named(source).cast("string")))
    key = F.xxhash64(named(doc_id), named(text), F.lit(SEED))
    sized = cut(placed(df, named(doc_id).alias("doc_id"), name.alias("name"), key.alias("key"), n_words_of(named(text)).alias("size")))
    # A source's order is computed in parts, so that a hot source isn't one task's: as many parts as a part has rows.
    parts = math.isqrt(sized.count()) + 1
    sized = sized.withColumn("part", F.pmod("key", F.lit(parts)))
    by_part = cut(sized.groupBy("name", "part").agg(F.sum("size").alias("n")))
    found = sorted(((r["name"] == "", r["name"], r["n"]) for r in by_part.groupBy("name").agg(F.sum("n").alias("n")).collect()))
    sizes = [n for *_, n in found]
    goal = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(found))])
    blocks = [-(-n // block) for n in sizes]
    quotas = [round(g * b / n) if n else 0 for g, b, n in zip(goal, blocks, sizes, strict=True)]
    plan = draws(quotas, shards)
    firsts = np.cumsum(plan, axis=0) - plan
    k, s = np.nonzero(plan)
    rows = arrow(_PLAN, shard=k.astype("int32"), source=s.astype("int32"), first=firsts[k, s], n=plan[k, s], blocks=np.array(blocks, dtype="int64")[s])
    dealt = spark.createDataFrame(pa.Table.from_batches([rows]), _PLAN).withColumn("begin", F.explode(F.expr(f"sequence(first, first + n - 1, {_RUN})")))
    dealt = dealt.select("shard", "source", F.col("begin").alias("first"), F.expr(f"least(first + n - begin, {_RUN})").alias("n"), "blocks")
    slots = per_batch(dealt.repartition("shard", "source", "first"), _slots, _SLOT)
    each = spark.createDataFrame([(nm, i, sizes[i], float(goal[i])) for i, (_, nm, _) in enumerate(found)], "name string, source int, source_size long, target double")
    each = F.broadcast(each) if len(found) <= FEW else each

    before = F.sum("n").over(Window.partitionBy("name").orderBy("part")) - F.col("n")
    starts = by_part.select("name", "part", before.alias("start"))
    within = F.sum("size").over(Window.partitionBy("name", "part").orderBy("key", "doc_id", "file", "row")) - F.col("size")
    texts = sized.withColumn("within", within).join(starts, ["name", "part"]).join(each, "name")
    texts = cut(texts.select("file", "row", "doc_id", "size", "source_size", "target", "source", (F.col("start") + F.col("within")).alias("at")))
    ranges = texts.where("size > 0").select("file", "row", "source", "at", "size", F.explode(F.expr(f"sequence(at div {block}, (at + size - 1) div {block})")).alias("block"))
    pieces = ranges.select(
        "file",
        "row",
        "source",
        "block",
        F.expr(f"greatest(at - block * {block}, 0)").alias("at"),
        F.expr(f"greatest(at, block * {block}) - at").alias("first"),
        F.expr(f"least(at + size, (block + 1) * {block}) - greatest(at, block * {block})").alias("words"),
    )
    # Slots are made from few rows, by which they would look small enough to broadcast; they grow with the texts.
    return texts.drop("source", "at"), pieces.join(slots.hint("merge"), ["source", "block"])


def mix_counts(df: DataFrame, **names: str | int) -> DataFrame:
    """One row for each row of `df`: doc_id, size, source_size, target, taken."""
    texts, takings = mixture(df, **names)
    taken = takings.groupBy("file", "row").agg(F.sum("words").alias("taken"))
    return texts.join(taken, ["file", "row"], "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def _pieces(df: DataFrame, text: str, **names: str | int) -> DataFrame:
    """The takings with whole (the columns of `df`) and piece (the words taken, with single spaces; a whole text as it is)."""
    df = settled(df)
    texts, takings = mixture(df, text=text, **names)
    taken = takings.groupBy("file", "row").agg(F.collect_list(F.struct("shard", "slot", "source", "block", "at", "first", "words")).alias("taken"))
    rows = placed(df, whole(df)).join(taken.join(texts.select("file", "row", "size"), ["file", "row"]), ["file", "row"])
    body = F.col("whole").getField(text)

    def cut_out(words):
        part = lambda x: F.array_join(F.slice(words, (x["first"] + 1).cast("int"), x["words"].cast("int")), " ")
        return F.transform("taken", lambda x: F.struct(x.alias("taking"), F.when(x["words"] == F.col("size"), body).otherwise(part(x)).alias("piece")))

    return rows.select("whole", F.inline(let(words_of(body), cut_out))).select("whole", "taking.*", "piece")


def mix_texts(df: DataFrame, text: str = "text", **names: str | int) -> DataFrame:
    """The mix as rows with the columns of `df`: for each piece of a text that a slot takes, one whose text is the piece.
    Partitions hold whole shards; in a shard, the sources' slots stand in a hashed order."""
    made = _pieces(df, text, **names).repartition("shard").sortWithinPartitions("shard", F.xxhash64("source", "slot", F.lit(SEED)), "source", "slot", "at")
    return made.select(*[F.col("piece").alias(c) if c == text else F.col("whole").getField(c).alias(c) for c in df.columns])


def mix_blocks(df: DataFrame, text: str = "text", doc_id: str = "doc_id", **names: str | int) -> DataFrame:
    """The mix as blocks: shard, source (its number in order), slot, block, n_words (`block`, but for a source's last one), text,
    and pieces (doc_id, first word, words)."""
    made = _pieces(df, text, doc_id=doc_id, **names)
    each = F.struct("at", "piece", F.col("whole").getField(doc_id).alias("doc_id"), "first", "words")
    made = made.groupBy("shard", "source", "slot", "block").agg(F.sum("words").alias("n_words"), F.sort_array(F.collect_list(each)).alias("all"))
    joined = F.array_join(F.transform("all", lambda x: F.array_join(words_of(x["piece"]), " ")), " ")
    return made.select("shard", "source", "slot", "block", "n_words", joined.alias("text"), F.transform("all", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["first"].alias("first"), x["words"].alias("words"))).alias("pieces"))
