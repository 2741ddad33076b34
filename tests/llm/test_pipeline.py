"""The stages against brute force on a small table."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from finlake.llm import langid, queries
from finlake.llm.common import cut

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def linked(texts, words=5, percent=80):
    """The least index that each text reaches by links."""
    sets = []
    for t in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(zip(*(w[i:] for i in range(words)), strict=False)) if len(w) >= words else frozenset([tuple(w)] if w else []))
    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    label = list(range(len(sets)))
    for i, s in enumerate(sets):
        shared = collections.Counter(j for x in s for j in holders[x] if j < i)
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The rows after each stage, of the test table with a null text, one without letters, and near copies added."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rng = random.Random(5)
    more = []
    for k, r in enumerate(docs.where("length(text) > 600").orderBy("doc_id").limit(6).collect()):
        words = r["text"].split(" ")
        words[rng.randrange(len(words))] = "changed"
        more.append((900_000 + k, " ".join(words), r["lang"], r["source"], r["n_chars"]))
    more += [(900_100, None, "en", "s", 0), (900_101, "12 34 --", "en", "s", 8), (None, "Un texte sans nom, mais avec des mots de la langue.", None, None, 1)]
    now = cut(docs.unionByName(spark.createDataFrame(more, docs.schema)))
    out = [now]
    for _, stage in corpus_pipeline.STAGES:
        now = cut(stage(spark, now, sf))
        out.append(now)
    return out


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_language_stage(stages):
    docs, left, *_ = stages
    model = langid.train(docs)
    kept = []
    for r in docs.collect():
        lang, score = model.predict([r["text"] or ""])[0]
        if lang != langid.UNKNOWN and score >= corpus_pipeline.MIN_SCORE:
            kept.append(tuple(r))
    assert rows_of(left) == sorted(kept, key=str) and left.columns == docs.columns
    gone = set(r["doc_id"] for r in docs.collect()) - set(r["doc_id"] for r in left.collect())
    assert {900_100, 900_101} <= gone and len(gone) < 0.03 * docs.count()


def test_exact_stage(stages):
    _, docs, left, *_ = stages
    last = {}
    for r in sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        last[r["text"]] = tuple(r)
    assert rows_of(left) == sorted(last.values(), key=str) and left.columns == docs.columns


def test_near_stage(stages):
    _, _, docs, left, *_ = stages
    rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    label = linked([r["text"] for r in rows])
    assert rows_of(left) == sorted((tuple(rows[i]) for i in set(label)), key=str) and left.columns == docs.columns
    assert len(set(label)) < len(rows)


def test_mixing_stage(stages):
    _, _, _, docs, mixed, _ = stages
    assert mixed.columns == docs.columns
    of = {r["doc_id"]: r for r in docs.collect()}
    size, taken, given = collections.Counter(), collections.Counter(), collections.Counter()
    for r in of.values():
        size[r["source"]] += len(WORD.findall(r["text"]))
    for r in mixed.collect():
        found, whole = WORD.findall(r["text"]), of[r["doc_id"]]
        assert (r["lang"], r["source"], r["n_chars"]) == (whole["lang"], whole["source"], whole["n_chars"])
        assert 0 < len(found) and f" {' '.join(found)} " in f" {' '.join(WORD.findall(whole['text']))} "
        taken[r["source"]] += len(found)
        given[r["doc_id"]] += len(found)
    assert all(n <= 3 * len(WORD.findall(of[k]["text"])) for k, n in given.items())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    total, low, high = sum(size.values()), 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        low, high = (low, level) if sum(min((1 + i % 3) * level, 3 * size[s]) for i, s in enumerate(order)) > total else (level, high)
    for i, s in enumerate(order):
        goal = min((1 + i % 3) * low, 3 * size[s])
        assert abs(taken[s] - goal) <= 4 * 128, (s, taken[s], goal)  # blocks of 128, the last of them shorter


def test_encoding_stage(stages):
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(queries.VOCABULARY)
    mixed, out = stages[4], stages[5]
    wanted = collections.Counter()
    for r in mixed.collect():
        ids = tokenizer.encode(r["text"], add_special_tokens=False).ids
        digests = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        wanted[r["doc_id"], r["source"], len(ids), *digests] += 1
    assert collections.Counter((r["doc_id"], r["source"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out.collect()) == wanted


def test_awkward_rows_pass_through(spark, sf):
    """Null and repeated ids, ties, and columns with the stages' own names."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    texts = [" ".join(word() for _ in range(60)) for _ in range(4)]
    rows = [(i, texts[k % 4], "en", None if k % 2 else "s", 1) for k, i in enumerate([None, None, 7, 7, 2**63 - 1, 2**53 + 1, None, 7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({"row": F.lit("mine"), "whole": F.lit(1), "_metadata": F.lit(2)})
    now = cut(docs)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = cut(stage(spark, now, sf))
        assert now.columns == docs.columns and {(r["row"], r["whole"], r["_metadata"]) for r in now.collect()} == {("mine", 1, 2)}
    assert {r["text"] for r in now.collect()} and corpus_pipeline.STAGES[-1][1](spark, now, sf).where("n_tokens > 0").count() == now.count()


def test_empty_table(spark, sf):
    now = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = cut(stage(spark, now, sf))
    assert now.count() == 0


def test_near_copies_against_brute_force(spark, sf):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    texts = []
    for _ in range(8):
        base = [word() for _ in range(100)]
        two, apart = list(base), list(base)
        two[30], two[60] = word(), word()
        for i in range(10, 90, 8):
            apart[i] = word()
        texts += [base, two, base[:40] + base[51:], base + [word() for _ in range(18)], apart]
    texts += [["one", "two"], ["one", "two"], []]
    label = linked([" ".join(t) for t in texts])
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    left = corpus_pipeline.drop_near_copies(spark, docs, sf)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(label))
    assert len(set(label)) == 18  # a base with its three copies, and the text with ten changes
