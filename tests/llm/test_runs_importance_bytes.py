"""Periodic runs, importance resampling and byte-level BPE against brute force and the library."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from finlake.llm import byte_bpe, importance, queries, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FEATURE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string"
sha = lambda x: hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = [prose(rng, rng.randint(1, 90)) for _ in range(60)] + ["a b c " * 30, "x " * 40 + "y " * 23 + "z " * 24, "Ünï\tcödé 漢字 👍 " * 9, "A1-b2_C3 Zß" * 4, "é" * 300]
    out += [None, "", " \n\t", "one", *["same text of five words " * 6] * 3, "mid " + "p q r s t u v w " * 12 + "end"]
    return [(i, t) for i, t in enumerate(out)] + [(None, "no id here " * 10), (None, None), (2**63 - 1, prose(rng, 50)), (-3, prose(rng, 50)), (7, "twice " * 30)]


@pytest.fixture(scope="module")
def tables(spark, rows, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(i, t, "en", "s") for i, t in rows], DOCS).repartition(3).write.parquet(str(path / "documents.parquet"))
    rng = random.Random(12)
    spark.createDataFrame([(i, t) for i, t in enumerate([prose(rng, 200), None, "", "a b c same text " * 20])], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


# 11


def brute_runs(words, length=24, exponent=3):
    """Each period on its own: stretches of places whose word comes again a period on."""
    ends = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(length, exponent * q):
                ends.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in ends.items())


@pytest.mark.parametrize("length,exponent", [(24, 3), (6, 3), (10, 4), (1, 3), (25, 5)])
def test_runs_against_brute_force(length, exponent):
    rng = random.Random(length)
    for _ in range(400):
        words, letters = [], rng.choice([1, 2, 3, 50])
        while len(words) < rng.randint(0, 160):
            if rng.random() < 0.6:
                words += ([str(rng.randrange(letters)) for _ in range(rng.randint(1, 12))] * 20)[: rng.randint(1, 60)]
            else:
                words += [str(rng.randrange(1000)) for _ in range(rng.randint(1, 8))]
        assert runs.runs_of(words, length, exponent) == brute_runs(words, length, exponent)


def test_stretches_lose_no_run():
    """Halving whole texts finds what halving the narrowed stretches does."""
    rng = random.Random(5)
    for _ in range(100):
        words = [str(rng.randrange(2)) for _ in range(rng.randint(24, 120))] * rng.randint(1, 4)
        ids = np.array(list(map(int, words)))
        whole, kept = runs.runs_of_ids(ids), runs.narrowed
        try:
            runs.narrowed = lambda ids, start, window: [(0, len(ids))]
            assert runs.runs_of_ids(ids) == whole
        finally:
            runs.narrowed = kept


def test_a_long_period_and_a_long_text():
    words = [str(i % 5000) for i in range(20_000)]
    assert runs.runs_of(words) == [(0, 20_000, 5000)]
    assert runs.runs_of(["w"] * 50_000) == [(0, 50_000, 1)]


def planted(doc_id, words):
    if doc_id is None or not words or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_runs_query(spark, tables, rows):
    wanted = []
    for doc_id, text in rows:
        words = planted(doc_id, WORD.findall(text or ""))
        found = brute_runs(words)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        tail = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        wanted.append((doc_id, len(found), *tail, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, tables).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert sum(w[1] > 0 for w in wanted) > 8


def test_runs_operator_keeps_columns_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, "a b " * 20 + "c", "mine"), (2, None, "x")], "Runs long, text string, n_words string")
    found = runs.mark_runs(frame).orderBy("n_words").collect()
    assert [(r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found] == [(0, [], ""), (41, [(0, 40, 2)], "a b c")]
    assert runs.mark_runs(frame.where("false")).collect() == []
    with pytest.raises(ValueError, match="three"):
        runs.mark_runs(frame, exponent=2)


# 12


def features(text, grams):
    words = FEATURE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + k]) for k in range(1, grams + 1) for i in range(len(words) - k + 1)]


def brute_draw(rows, target, grams, buckets=10_000, least=20, percent=10):
    bucket = lambda x: zlib.crc32(x.encode()) % buckets
    s, t = (Counter(bucket(x) for text in texts for x in features(text, grams)[1]) for texts in ([r[1] for r in rows], target))
    has, wants = float(s.total() + buckets), float(t.total() + buckets)
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * has / ((s[b] + 1.0) * wants))) for b in s}
    out = []
    for doc_id, text in rows:
        words, found = features(text, grams)
        h = int(sha(f"2024:{'' if doc_id is None else doc_id}")[:8], 16)
        weight = sum(gain[bucket(x)] for x in found)
        out.append([doc_id, len(found), len(words), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    drawable = sorted((r for r in out if r[2] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, [r[0] for r in drawable[: percent * len(drawable) // 100]]


def test_resampling_query(spark, tables, rows):
    target = [r["text"] for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    wanted, drawn = brute_draw(rows, target, 1)
    got = queries.op12_importance_resampling(spark, tables).collect()
    assert sorted(map(str, ([r["doc_id"], r["n_features"], r["weight"], r["score"]] for r in got))) == sorted(str([r[0], r[1], r[3], r[4]]) for r in wanted)
    assert [r["doc_id"] for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == drawn
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(drawn) + 1)) and len(drawn) >= 5


@pytest.mark.parametrize("parts", ["1", "7"])
def test_resampling_of_trigrams(spark, rows, parts):
    """The CRCs of n-grams are composed; brute force takes them from strings."""
    target = [prose(random.Random(1), 300), "same text of five words"]
    frame = spark.createDataFrame([(i, t, "kept") for i, t in rows], "doc_id long, text string, weight string")
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    wanted, drawn = brute_draw(rows, target, 3, buckets=97, least=5, percent=40)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = importance.resample(frame, aim, grams=3, buckets=97, least=5, percent=40).collect()
        texts = importance.draw(frame, aim, grams=3, buckets=97, least=5, percent=40).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(str, ([r[c] for c in ("doc_id", "n_features", "n_words", "weight", "score")] for r in got))) == sorted(map(str, wanted))
    assert [r["doc_id"] for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == drawn
    assert [r["doc_id"] for r in sorted(texts, key=lambda r: r["rank"])] == drawn
    assert {(r["doc_id"], r["text"]) for r in texts} <= set(rows)


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame([(i, "w " * 30, None, None) for i in range(20)], DOCS)
    assert importance.resample(none, some).collect() == [] and importance.draw(none, none).collect() == []
    found = importance.resample(some, none).collect()
    assert len(found) == 20 and sum(r["rank"] is not None for r in found) == 2


def test_crc_algebra():
    rng = random.Random(2)
    for _ in range(300):
        a, b = rng.randbytes(rng.randint(0, 40)), rng.randbytes(rng.choice([0, 1, 7, 300, 70_000]) or rng.randint(0, 9))
        joined = importance.moved(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)]))[0] ^ np.uint32(zlib.crc32(b))
        assert int(joined) == zlib.crc32(a + b)


def test_features_of_sliced_batches_and_long_words():
    texts = [None, "Ab cd", "", "x" * 500 + " é-É", None, "Ab", "last"]
    array = pa.array(["before", *texts])[1:]
    found, bucket, n_words = importance.hashed(array, 2, 1 << 32)
    wanted = [(i, zlib.crc32(x.encode())) for i, t in enumerate(texts) for x in features(t, 2)[1]]
    assert sorted(zip(found.tolist(), bucket.tolist(), strict=True)) == sorted(wanted)
    assert n_words.tolist() == [len(features(t, 1)[0]) for t in texts]
    assert [len(x) for x in importance.hashed(pa.array([None, ""]), 1, 10)] == [0, 0, 2]


# 13


@pytest.fixture(scope="module")
def library():
    with open(queries.BYTE_RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(queries.BYTE_RANKS, queries.BYTE_PATTERN)


def test_byte_bpe_query(spark, tables, rows, library):
    wanted = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        wanted.append((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode())))
    assert sorted(map(tuple, queries.op13_byte_bpe(spark, tables).collect()), key=str) == sorted(wanted, key=str)
    ids = byte_bpe.encode_texts(spark.createDataFrame([("hello wörld", 1)], "text string, Ids long"), queries.BYTE_RANKS, queries.BYTE_PATTERN).first()
    assert ids["ids"] == library.encode_ordinary("hello wörld") and "text" not in ids


def test_byte_bpe_odd_characters(bpe, library):
    rng = random.Random(4)
    pool = [chr(c) for c in range(0x21, 0x3000)] + [*" \n\t\r\x00\x1c\x85\xa0　漢字👍𝒳ſK꟎\U00016ea0\U0001246f"] * 30 + list("abcdefghij'sldtrevm0123  ") * 60 + [chr(c) for c in range(0x10000, 0x1F000)]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(1500)]
    texts += ["", "a" * 5000, "ab" * 3000 + " " + "漢字" * 2000, " " * 3000 + "x", "\n" * 100 + " x", "it's we'll I'D", "<|endoftext|>", "".join(rng.choices("abcdefghijklmnop", k=60_000))]
    for text, ids in zip(texts, bpe.groups(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text), repr(text)
        assert bpe.decode(ids.tolist()) == text.encode()


def test_groups_and_memory_bounds(bpe, library, monkeypatch):
    rng = random.Random(6)
    texts = [prose(rng, rng.randint(0, 40)) for _ in range(200)]
    wanted = [library.encode_ordinary(t) for t in texts]
    for name, value in (("GROUP", 50), ("PIECES", 7), ("CACHE", 4), ("CACHED", 3)):
        monkeypatch.setattr(byte_bpe, name, value)
        assert [x.tolist() for x in bpe.groups(texts)] == wanted


def test_perfect_hash():
    """Every key has a slot of its own, no slot stays empty, and no other string is taken for a key."""
    rng = random.Random(7)
    for n in (1, 2, 5, 300, 5000):
        keys = list({rng.randbytes(rng.choice([1, 2, 3, 7, 8, 9, 16, 17, 40])) for _ in range(n)})
        perfect = byte_bpe.PerfectHash(keys)
        assert sorted(perfect.ids.tolist()) == list(range(len(keys)))
        assert [perfect.get(k) for k in keys] == list(range(len(keys)))
        others = {rng.randbytes(rng.choice([1, 2, 8, 9, 41, 60])) for _ in range(500)} | {k + b"\0" for k in keys[:50]} | {k[:-1] for k in keys[:50] if len(k) > 1}
        assert all(perfect.get(x) == (keys.index(x) if x in keys else -1) for x in list(others)[:200])
        data, at = b"".join(keys), np.cumsum([0, *map(len, keys)])
        found = perfect.find(np.frombuffer(data + bytes(8 * perfect.chunks + 8), np.uint8), at[:-1], np.diff(at))
        assert found.tolist() == list(range(len(keys)))
    with pytest.raises(ValueError, match="twice"):
        byte_bpe.PerfectHash([b"a", b"a"])


def test_a_text_longer_than_a_batch(spark, library):
    """Over the eight megabytes of an Arrow batch."""
    rng = random.Random(8)
    some = [prose(rng, 1) for _ in range(3000)]
    text = " ".join(rng.choices(some, k=1_900_000))
    frame = spark.createDataFrame([(1, text), (2, "short one")], "doc_id long, text string")
    assert len(text) > 9 << 20
    found = byte_bpe.encode_texts(frame, queries.BYTE_RANKS, queries.BYTE_PATTERN, keep_ids=False).where("doc_id = 1").first()
    assert found["n_tokens"] == len(library.encode_ordinary(text)) and found["decoded_sha256"] == sha(text)
    assert runs.mark_runs(frame).where("doc_id = 1").select(F.size("runs"), "n_words").first() == (0, 1_900_000)
    assert importance.resample(frame, frame).where("doc_id = 1").first()["n_features"] == 1_900_000
