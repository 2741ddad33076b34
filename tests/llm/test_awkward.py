"""All operators on rows with awkward ids and columns, on files that are split anew between passes, and on long inputs."""

import random
import time

import pytest
from pyspark.sql import functions as F

from finlake.llm import bpe, byte_bpe, chat, common, exact_dedup, html_extract, importance, langid, mixing, ngram_join, quality, queries, runs, secrets, substring_dedup

IDS = [None, None, 2**53 + 1, 2**53 + 2, 2**63 - 1, 1152921504606846977, 0, -5, 7, 7]
#: Names that operators use inside, with values that must come through.
CLASH = ["row", "row_", "file", "size", "size_", "col", "keep_", "kept", "whole", "body", "w", "each", "taken", "block", "shard", "slot", "spans", "found", "piece", "digest", "id", "set", "name", "key", "part", "_metadata"]


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    body = [words(rng, 60) for _ in range(6)]
    return [(i, body[k % 6] + (" " + words(rng, 3) if k % 3 == 0 else ""), ["en", "de", None][k % 3], [None, "a", "b"][k % 3]) for k, i in enumerate(IDS)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return frame.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id"), F.lit(-1))).alias(c) for c in CLASH if c != "row"], F.lit(2**53 + 1).alias("row"), F.lit(None).cast("string").alias("html"))


def ids_of(frame):
    return sorted((r["doc_id"] for r in frame.select("doc_id").collect()), key=lambda x: (x is None, x or 0))


def passed(frame, columns):
    """The callers' columns came through, with their values."""
    for r in frame.collect():
        for c in columns:
            assert r[c] == (2**53 + 1 if c == "row" else f"{c}:{-1 if r['doc_id'] is None else r['doc_id']}"), c


OPERATORS = {
    "1": lambda d: quality.quality_rules(d),
    "2": lambda d: exact_dedup.exact_dedup(d),
    "2 drop": lambda d: exact_dedup.drop_copies(d, few=0),
    "3": lambda d: mixing.mix_counts(d, block=16, shards=3),
    "3 texts": lambda d: mixing.mix_texts(d, block=16, shards=3),
    "5": lambda d: secrets.scan_secrets(d),
    "6": lambda d: langid.predict(d, langid.fit([("abc def", "x"), ("xyz uvw", "y")])),
    "7": lambda d: ngram_join.link_components(d),
    "7 one": lambda d: ngram_join.one_of_each(d),
    "8": lambda d: bpe.encode_texts(d, queries.VOCABULARY),
    "9": lambda d: substring_dedup.dedup_substrings(d),
    "10": lambda d: html_extract.extract_text(d.withColumnRenamed("source", "url"), html="text", url="url"),
    "11": lambda d: runs.mark_runs(d),
    "12": lambda d: importance.resample(d, d),
    "12 draw": lambda d: importance.draw(d, d, percent=50),
    "13": lambda d: byte_bpe.encode_texts(d, queries.BYTE_RANKS, queries.BYTE_PATTERN),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_ids_and_columns_come_through(docs, name):
    found = OPERATORS[name](docs)
    left = ids_of(found)
    everything = sorted(IDS, key=lambda x: (x is None, x or 0))
    if name in ("2 drop", "7 one", "3 texts", "12 draw"):
        added = ["weight", "score", "rank"] if name == "12 draw" else []
        assert set(left) <= set(everything) and found.columns == docs.columns + added
        passed(found, CLASH)
    else:
        assert left == everything
    if name in ("1", "5", "6", "8", "10", "11", "12", "13"):
        passed(found, [c for c in CLASH if c not in quality.ADDED])


def test_chat_ids(spark):
    frame = spark.createDataFrame([(i, 0, "user", f"hello {k}") for k, i in enumerate(IDS)], "conv_id long, turn long, role string, text string")
    found = chat.read_back(*chat.format_chat(frame.withColumn("row", F.lit(1)).withColumn("at", F.lit("x"))))
    assert {r["conv_id"]: r["n_turns"] for r in found.collect()} == {i: IDS.count(i) for i in IDS}


def test_repeated_rows_and_unnamed_ones(spark):
    """One of all rows with the same text stays, whatever their ids."""
    frame = spark.createDataFrame([(None, "a b c d")] * 40 + [(3, "a b c d")] * 3 + [(None, "x y z")] * 5, "doc_id long, text string").repartition(4)
    for counters in (1, 1000):
        kept = exact_dedup.drop_copies(frame, counters=counters).collect()
        assert sorted((r["text"], r["doc_id"]) for r in kept) == [("a b c d", 3), ("x y z", None)]
        assert exact_dedup.exact_dedup(frame, counters=counters).where("kept").count() == 2
    assert ngram_join.one_of_each(frame).count() == 2
    assert ngram_join.link_components(frame).where("first").count() == 2
    long = spark.createDataFrame([(None, "word " * 40)] * 6 + [(5, "word " * 40)], "doc_id long, text string")
    assert substring_dedup.dedup_substrings(long).where("n_removed = 200").count() == 6


@pytest.mark.parametrize("name", ["2 drop", "3 texts", "7 one", "9", "10", "12 draw"])
def test_rows_keep_their_texts_when_splits_change(spark, tmp_path, rows, name):
    """Files are split by how many cores there are when a pass is planned; that may change between passes."""
    rng = random.Random(2)
    for part in range(4):
        made = [(part * 100 + i, words(rng, 40 + 3 * part) if i % 4 else "copy " * 50, "en", "s") for i in range(25)]
        spark.createDataFrame(made, "doc_id long, text string, lang string, source string").coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    frame = spark.read.parquet(str(tmp_path / "docs"))
    wanted = sorted(map(str, OPERATORS[name](frame).collect()))
    made = OPERATORS[name](frame)
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "32")
        assert sorted(map(str, made.collect())) == wanted
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_placed_names_rows_of_files_only(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "r"))
    plain = spark.read.parquet(str(tmp_path / "r"))
    assert common._plain_read(plain.where("id > 1").select("id")) and not common._plain_read(plain.union(plain))
    assert not common._plain_read(plain.select(F.explode(F.array("id", "id")).alias("id"))) and not common._plain_read(plain.where(F.rand() > 0.5))
    for frame in (plain, plain.union(plain), plain.crossJoin(plain.limit(2).withColumnRenamed("id", "b"))):
        found = common.placed(frame, F.col("id"))
        assert found.select("file", "row").distinct().count() == frame.count()


def test_written_folders_go(spark):
    made = common.cut(spark.range(3).toDF("id"))
    assert made.count() == 3
    common.forget(made)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FileNotFound"):
        spark.read.parquet(made._cut_path).count()


def test_a_cluster_needs_a_shared_folder():
    class Nowhere:
        class sparkContext:  # noqa: N801
            master = "spark://machine:7077"

            @staticmethod
            def getConf():
                return {}

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="share"):
        common.shared_dir(Nowhere)


def test_very_long_texts(spark):
    """A megabyte in one word, in one line, and in repeated lines, beside a short text."""
    rng = random.Random(3)
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1 << 20))
    texts = [word, "word " * 200_000, (words(rng, 30) + ".\n") * 4000, "short", None, ""]
    frame = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").repartition(2)
    began = time.time()
    for name in OPERATORS:
        if name != "10":
            assert OPERATORS[name](frame).count() > 0, name
    deep = "<div>" * 20_000 + "".join(f"x{i}</div>" for i in range(20_000))
    pages = spark.createDataFrame([(1, "http://h/", deep), (2, "http://h/", "<p>" + "word " * 200_000), (3, "http://h/", None)], "doc_id long, url string, html string")
    assert sorted(r["n_chars"] for r in html_extract.extract_text(pages).collect())[0] == 0
    turns = spark.createDataFrame([(1, 0, "user", word), (1, 1, "assistant", "word " * 200_000), (1, 2, "user", None)], "conv_id long, turn long, role string, text string")
    assert chat.read_back(*chat.format_chat(turns)).first()["n_turns"] == 3
    assert time.time() - began < 300
