"""Each operator on awkward rows, and against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from finlake.llm import bpe, chat, exact_dedup, html_extract, langid, mixing, ngram_join, quality, queries, secrets, substring_dedup
from finlake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def prose(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Texts with exact and near copies, shared passages, repeats, nulls, blanks, a long one and odd characters."""
    rng = random.Random(3)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    passage = prose(rng, 60)
    out = base + base[:6] + base[:2]
    for t in base[5:15]:
        w = t.split(" ")
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    out += [prose(rng, 30) + "\n" + passage + " " + prose(rng, 20) for _ in range(6)]
    out += [None, None, "", "", " \t\n", "x", "a b", "a b", "A B", "é" * 150, "é" * 150 + "x", "z" * 500, prose(rng, 4000), " ", "Ünï   cödé 漢字 👍"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i * 3 % 1000, t, "en" if i % 2 else None, None if i % 7 == 0 else f"s{i % 3}", 5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).withColumns({"kept": F.lit("mine"), "ROW": F.lit(1), "Digest": F.lit(2), "n_words": F.lit("old")}).repartition(3).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def as_dict(frame, key="doc_id"):
    return {r[key]: r for r in frame.collect()}


# 1


def repeated(words):
    seen, marked = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7)), set()
    for i in range(len(words) - 7):
        if seen[tuple(words[i : i + 8])] > 1:
            marked.update(range(i, i + 8))
    return len(marked)


def test_quality_base_against_brute_force(spark, docs, rows):
    more = {-1: "one two three four five six seven eight nine " * 6, -2: "line a\nline a\n\nline b\nline a", -3: "a # | b"}
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(more.items()), "doc_id long, text string"))
    found = as_dict(quality.quality_rules(frame))
    for k, t in (rows | more).items():
        words, r = WORD.findall(t or ""), found[k]
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        wanted = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), repeated(words))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == wanted
        assert r["base_failed"] == (len(words) < 20 or 100 * wanted[4] > 30 * len(words))
        assert not (r["base_failed"] and r["kept"])


def bad(line, rules=quality.LineRules()):
    """The line rules, word for word, over Python strings."""
    words, dense = WORD.findall(line), re.sub(r"[\x20\x09-\x0D]", "", line)
    symbols, letters = sum(c in "#*$%&|<>" for c in dense), sum(c.isalpha() for c in dense)
    if symbols > rules.max_symbols * len(dense) or letters < rules.min_letters * len(dense):
        return True
    if len(words) >= rules.long_line and not any(c in ".!?…。！？" for c in line):
        return True
    if (any(c in "|»›•·" for c in line) or " > " in line or " / " in line) and sum(not w.strip("|»›•·>/") for w in words) > rules.max_separators * len(words):
        return True
    if ("://" in line or "www." in line) and sum("://" in w or "www." in w for w in words) > rules.max_links * len(words):
        return True
    low = line.lower()
    if len(dense) < 20 and low.strip(" ").rstrip(" .:>»") in {x for words in quality.MENU.values() for x in words}:
        return True
    return bool(re.match(r"\s*(©|\(c\)|&copy;|copyright\b)", low)) or any(p in low for phrases in quality.BOILERPLATE.values() for p in phrases)


def test_quality_lines_against_brute_force(spark):
    rng = random.Random(21)
    bits = ["Home", "|", "»", "News", "the river runs past.", "a  b  c  d  e  f  g h", "and the road follows it", "Impressum", "Startseite", "Accueil >", "© 2024 The Site", "https://a.example/x", "#", "***", "12 34 56", "Datenschutzerklärung", "/", "•", "x", "One. Two.", "tous droits réservés", "\t", "Copyrighted works are fine here.", "(c) us"]
    rows = [(i, "\n".join(" ".join(rng.choices(bits, k=rng.randint(0, 7))) for _ in range(rng.randint(0, 12)))) for i in range(300)]
    found = as_dict(quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")))
    for i, text in rows:
        lines = [x for x in text.split("\n") if WORD.search(x)]
        size = lambda x: len(re.sub(r"[\x20\x09-\x0D]", "", x))
        lost = [x for x in lines if bad(x)]
        r = found[i]
        assert (r["n_lines"], r["n_bad_lines"], r["lost_chars"]) == (len(lines), len(lost), sum(map(size, lost))), text
        assert r["clean_text"] == "\n".join(x for x in text.split("\n") if not WORD.search(x) or not bad(x))
        assert r["kept"] == (not r["base_failed"] and sum(map(size, lost)) <= 0.5 * r["word_chars"])


def test_quality_lines(spark, empty, docs):
    clean = "The river runs past the old mill, and the road follows it. People walk there in the evening, when the air is cool and still."
    menu = "Home | News | Sport | Weather | Contact | Login | Register | Help"
    found = as_dict(quality.quality_rules(spark.createDataFrame([(1, clean), (2, f"{menu}\n{clean}\nAll rights reserved."), (3, f"{menu}\n" * 9 + clean[:20]), (4, "a  b  c  d  e  f  g h"), (5, "word " * 400_000)], "doc_id long, text string")))
    assert found[1]["kept"] and found[1]["n_bad_lines"] == 0 and found[1]["clean_text"] == clean
    assert found[2]["kept"] and found[2]["n_bad_lines"] == 2 and found[2]["clean_text"] == clean
    assert not found[3]["kept"] and found[4]["n_bad_lines"] == 0
    assert found[5]["n_words"] == 400_000 and found[5]["n_repeat_words"] == 400_000
    assert quality.quality_rules(empty).count() == 0
    assert dict(quality.quality_rules(docs).dtypes)["n_words"] == "bigint" and quality.quality_rules(docs).count() == docs.count()


# 2


@pytest.mark.parametrize("counters", [1, 1000])
def test_exact_dedup(docs, rows, empty, counters):
    found = as_dict(exact_dedup.exact_dedup(docs, counters=counters))
    groups = collections.defaultdict(list)
    for k, t in rows.items():
        groups[t or ""].append(k)
    for t, ks in groups.items():
        for k in ks:
            r = found[k]
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (max(ks), len(ks), k == max(ks), hashlib.sha256(t.encode()).hexdigest())
    kept = exact_dedup.drop_copies(docs, counters=counters)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(max(ks) for ks in groups.values())
    assert exact_dedup.exact_dedup(empty).count() == exact_dedup.drop_copies(empty).count() == 0


def test_exact_dedup_of_repeated_and_unnamed_rows(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b")], "doc_id long, text string")
    found = exact_dedup.exact_dedup(frame).collect()
    assert sorted((r["text_sha256"][:2], r["kept"]) for r in found).count((hashlib.sha256(b"a").hexdigest()[:2], True)) == 1
    assert exact_dedup.drop_copies(frame).count() == 2


# 3


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    assert mixing.targets([590, 10], [1, 2]) == [570, 30]
    assert mixing.targets([0, 0], [1, 2]) == [0, 0]
    found = mixing.targets([7, 1000, 3, 40], [1, 2, 3, 1])
    assert sum(found) == 1050 and all(x <= 3 * n for x, n in zip(found, [7, 1000, 3, 40], strict=True))


def water(sizes, weights):
    """Targets by bisection for the level at which weight x level, at most 3 sizes, adds up to the total."""
    total, low, high = sum(sizes), 0.0, 1e9
    for _ in range(300):
        level = (low + high) / 2
        low, high = (low, level) if sum(min(w * level, 3 * n) for w, n in zip(weights, sizes, strict=True)) > total else (level, high)
    return [min(w * low, 3 * n) for w, n in zip(weights, sizes, strict=True)]


def test_targets_against_bisection():
    rng = random.Random(17)
    for _ in range(200):
        sizes = [rng.choice([0, rng.randint(1, 50), rng.randint(1, 10_000)]) for _ in range(rng.randint(1, 9))]
        weights = [1 + i % 3 for i in range(len(sizes))]
        assert [float(x) for x in mixing.targets(sizes, weights)] == pytest.approx(water(sizes, weights), abs=1e-3)


def test_permutations_and_draws():
    for n in (1, 2, 3, 100, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 5)) == list(range(n))
    plan = mixing.draws([10, 0, 200], 7)
    assert plan.sum(axis=0).tolist() == [10, 0, 200] and (plan >= 0).all()
    assert (mixing.draws([0, 0], 3) == 0).all()


def test_draws_are_multinomial():
    """Over many seeds a shard's counts have the mean and the variance of draws without return."""
    quotas, shards = np.array([600, 300, 100]), 10
    made = np.array([mixing.draws(quotas, shards, seed) for seed in range(400)])[:, 0]
    n, share = made.sum(axis=1)[0], quotas / quotas.sum()
    assert (made.sum(axis=1) == 100).all()
    assert made.mean(axis=0) == pytest.approx(n * share, rel=0.03)
    assert made.var(axis=0) == pytest.approx(n * share * (1 - share), rel=0.25)


def test_shards_slots_and_blocks(docs, rows):
    """The mix, made again from its definition: blocks of each source's stream, taken by the permutation of each pass."""
    block, shards = 8, 5
    texts, takings = mixing.mixture(docs, block=block, shards=shards)
    at = {(r["file"], r["row"]): r["doc_id"] for r in texts.collect()}
    found = takings.collect()
    slots = collections.defaultdict(set)
    for r in found:
        slots[r["source"], r["slot"]].add((r["shard"], r["block"]))
    assert all(len(x) == 1 for x in slots.values())
    sizes = collections.Counter()
    names = {r["doc_id"]: r["source"] for r in docs.collect()}
    order = sorted(set(names.values()), key=lambda s: (s is None, s or ""))
    for k, t in rows.items():
        sizes[order.index(names[k])] += len(WORD.findall(t or ""))
    n_blocks = {s: -(-n // block) for s, n in sizes.items()}
    goal = water([sizes[s] for s in range(len(order))], [1 + s % 3 for s in range(len(order))])
    plan = mixing.draws([round(g * n_blocks[s] / sizes[s]) for s, g in enumerate(goal)], shards)
    for s in range(len(order)):
        mine = sorted((slot, *next(iter(x))) for (source, slot), x in slots.items() if source == s)
        assert [slot for slot, *_ in mine] == list(range(plan[:, s].sum()))
        assert [shard for _, shard, _ in mine] == [k for k in range(shards) for _ in range(plan[k, s])]
        for slot, _, b in mine:
            assert b == mixing.permuted(np.array([slot % n_blocks[s]]), n_blocks[s], mixing.SEED + 1000 * s + slot // n_blocks[s])[0]
    # A block holds the same words whenever it is taken, and as many as fit.
    held = collections.defaultdict(set)
    for r in found:
        held[r["source"], r["block"], r["slot"]].add((r["at"], at[r["file"], r["row"]], r["first"], r["words"]))
    by_block = collections.defaultdict(set)
    for (s, b, _), x in held.items():
        by_block[s, b].add(frozenset(x))
        assert sum(n for *_, n in x) == min(block, sizes[s] - b * block)
    assert all(len(x) == 1 for x in by_block.values())
    made = {(r["shard"], r["source"], r["slot"]): r for r in mixing.mix_blocks(docs, block=block, shards=shards).collect()}
    assert len(made) == len(slots)
    for r in made.values():
        assert r["text"].split(" ") == [w for p in r["pieces"] for w in WORD.findall(rows[p["doc_id"]])[p["first"] : p["first"] + p["words"]]]
        assert r["n_words"] == len(r["text"].split(" "))


def test_mixing(docs, rows, empty):
    found = mixing.mix_counts(docs, block=4, shards=5).collect()
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix_counts(docs, block=4, shards=5).collect()))
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    total, taken, goal = collections.Counter(), collections.Counter(), {}
    for r in found:
        s = source[r["doc_id"]]
        assert r["size"] == len(WORD.findall(rows[r["doc_id"]] or "")) and 0 <= r["taken"] <= 3 * r["size"]
        total[s] += r["size"]
        taken[s] += r["taken"]
        goal[s] = (r["target"], r["source_size"])
    order = sorted(total, key=lambda s: (s is None, s or ""))
    wanted = mixing.targets([total[s] for s in order], [1, 2, 3, 1][: len(order)])
    for s, w in zip(order, wanted, strict=True):
        assert goal[s] == (pytest.approx(float(w)), total[s]) and abs(taken[s] - w) <= 12
    assert mixing.mix_counts(empty).count() == mixing.mix_texts(empty).count() == 0


def test_mixed_texts_hold_what_is_counted(docs, rows):
    mixed = mixing.mix_texts(docs, block=16, shards=5)
    assert mixed.columns == docs.columns and {(r["ROW"], r["kept"], r["n_words"]) for r in mixed.collect()} == {(1, "mine", "old")}
    words = collections.Counter()
    for r in mixed.collect():
        found = WORD.findall(r["text"])
        words[r["doc_id"]] += len(found)
        assert " ".join(found) in " ".join(WORD.findall(rows[r["doc_id"]]))
    assert {r["doc_id"]: r["taken"] for r in mixing.mix_counts(docs, block=16, shards=5).collect() if r["taken"]} == dict(words)


# 4


def test_chat_round_trip():
    rng = random.Random(1)
    bits = ["\\", "###", "#", "</turn>", "<", ":", "\n", " ", "assistant", "é", "\\### x: </turn>\n", "### user: "]
    for _ in range(200):
        turns = [(rng.choice(["user", "assistant", "system", "a:b\\", ""]), "".join(rng.choices(bits, k=rng.randint(0, 40)))) for _ in range(rng.randint(0, 14))]
        made = chat.windows(turns, chat.Budget(window=40, history=12))
        back, learned = chat.read_windows(made)
        assert back == turns and learned == [t for r, t in turns if r == "assistant"]


def test_chat_windows_keep_the_system_turn_and_the_budget():
    turns = [("system", "be kind")] + [(r, "w " * 10) for _ in range(6) for r in ("user", "assistant")]
    made = chat.windows(turns, chat.Budget(window=60, history=15))
    assert len(made) > 1 and all(w["text"].startswith("### system: be kind</turn>") for w in made)
    assert sum(len(w["loss"]) for w in made) == 6 and all(w["history"] >= 2 for w in made[1:])


def turns_of(rows):
    """Digests of each conversation's turns, from (conv_id, turn, role, text) rows."""
    out = {}
    for c in {r[0] for r in rows}:
        mine = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c)
        turns, loss = "".join(f"{role}\n{text}\n" for *_, role, text in mine), "".join(text for *_, role, text in mine if role == "assistant")
        out[c] = (len(mine), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize(("size", "budget"), [(chat.SEGMENT, chat.Budget()), (300, chat.Budget(window=60, history=15))])
def test_chat_frame(spark, size, budget):
    rng = random.Random(3)
    rows = [(1, 0, "user", None), (1, 1, "assistant", "hi"), (1, 1, "assistant", "hi"), (None, None, None, None), (2, 0, "assistant", "w " * 20_000)]
    rows += [(None, rng.choice([None, 0, 1]), rng.choice(["user", "assistant", "system", None]), rng.choice([None, "", "a b " * 5, "\\### x: </turn>\n"])) for _ in range(800)]
    rows += [(7, t, "user" if t % 2 else "assistant", f"turn {t} " * 9) for t in range(60)] + [(7, 3, "system", "be kind")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"window": F.lit(1), "ROW": F.lit(2), "segment": F.lit("s")}).repartition(5)
    made = chat.chat_windows(frame, budget, size)
    found = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(*chat.format_chat(frame, budget, size)).collect()}
    assert found == turns_of(rows)
    kept = sorted((r["segment"], r["window"], r["text"]) for r in made.where("conv_id = 7").collect())
    if size == 300:
        assert kept[-1][0] > 1 and all(text.startswith("### system: be kind</turn>") for *_, text in kept[2:])
    assert chat.chat_windows(frame.limit(0)).count() == chat.read_back(*chat.format_chat(frame.limit(0))).count() == 0


# 5

RULES = (
    ("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def base_spans(text):
    found = [(m.start(), i, m.end(), kind) for i, (kind, p, ok) in enumerate(RULES) for m in p.finditer(text) if ok(m)]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def test_secret_base_against_brute_force(spark, docs, rows, empty):
    rng = random.Random(5)
    bits = ["token", "=", " ", '"', "Password", ":", "abcdef", "AKIA", "ABCDEFGH01234567", "deadbeef" * 4, "👍é", "x", "api_key", "-", "secret", "\n", "KEY"]
    more = {-i: "".join(rng.choices(bits, k=30)) for i in range(1, 60)}
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(more.items()), "doc_id long, text string")).withColumn("secrets", F.lit(1))
    keep = F.filter("secrets", lambda s: s["kind"] != "random")
    found = as_dict(secrets.scan_secrets(frame).select("doc_id", secrets.span_list(keep).alias("spans")))
    for k, t in (rows | more).items():
        assert found[k]["spans"] == base_spans(t or ""), t
    assert secrets.scan_secrets(empty).count() == 0


BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
PARTS = "parser release order invoice backup daily report module import error account user service customer shipment tracking network packet buffer status handler request archive monthly country budget geschwindigkeit bestellung kunden rechnung voiture maison commande facture cliente pedido entrega".split()


def identifier(rng):
    """An ordinary name with digits, of 20 characters or more, most of the time."""
    words, day = [rng.choice(PARTS) for _ in range(rng.randint(3, 5))], f"{rng.randint(2000, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
    shapes = ["-".join(words) + "-" + day, "".join(w.capitalize() for w in words) + str(rng.randint(1, 999)), "_".join(words) + f"_{rng.randint(1, 9999):04}"]
    shapes += ["/".join(words) + f"/{rng.randint(1, 99)}", "-".join(w.upper() for w in words) + f"-{rng.randint(100, 99999)}", day.replace("-", "") + "".join(words)]
    return rng.choice(shapes)


def test_random_tokens_are_told_from_names(spark):
    rng = random.Random(10)
    groups = lambda letters, *sizes: "-".join("".join(rng.choices(letters, k=n)) for n in sizes)
    made = {
        "name": lambda: "PRIVATE_KEY=" + groups(BASE64, 44),
        "query": lambda: f"https://a.example/b?sig={groups(BASE64, 44)}&x=1",
        "padded": lambda: f"auth={groups(BASE64, 44)}==",
        "uuid": lambda: "id " + groups("0123456789abcdef", 8, 4, 4, 4, 12),
        "upper uuid": lambda: "id=" + groups("0123456789ABCDEF", 8, 4, 4, 4, 12),
        "base36": lambda: "key " + groups(BASE64[26:62], 32),
        "product key": lambda: "key " + groups(BASE64[:26] + BASE64[52:62], 5, 5, 5, 5, 5),
    }
    rows = [(k, f()) for k, f in made.items() for _ in range(40)] + [("plain", f"see {identifier(rng)} or {identifier(rng)}.") for _ in range(600)]
    rows += [("plain", "zzzzzzzzzzzzzzzzzzzzzzzzz1"), ("plain", "name=thisIsAPlainIdentifierName0001AndMoreOfIt"), (None, None)]
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string").repartition(3)
    found = as_dict(secrets.scan_secrets(frame))
    hits = collections.Counter(k for i, (k, _) in enumerate(rows) if any(x["kind"] == "random" for x in found[i]["secrets"]))
    assert hits["plain"] <= 0.02 * sum(hits.values())
    for kind, least in (("name", 34), ("query", 34), ("padded", 34), ("uuid", 32), ("upper uuid", 32), ("base36", 24), ("product key", 12)):
        assert hits[kind] >= least, hits


def test_battery_against_brute_force(spark):
    """The three tests' statistics and the names' exact tails, over numpy."""
    rng = random.Random(12)
    plain = [identifier(rng) for _ in range(60)] + ["".join(rng.choices(BASE64, k=rng.randint(20, 60))) for _ in range(60)]
    names = [x for x in plain if len(x) >= 20]
    got = {r["t"]: r for r in spark.createDataFrame([(x,) for x in names], "t string").select("t", secrets.ordinary_p(F.col("t")).alias("p"), secrets.token_p(F.col("t")).alias("u")).collect()}

    def tail(k, n, rate):
        return 1.0 if k <= n * rate else float(sum(Fraction(math.comb(n, i)) * Fraction(rate) ** i * (1 - Fraction(rate)) ** (n - i) for i in range(k, n + 1)))

    for t in names:
        letters = [c for c in t if c.isalpha()]
        pairs = [(a, b) for a, b in zip(t, t[1:], strict=False) if a.isalnum() and b.isalnum()]
        change = lambda a, b: a.islower() and b.isupper() or a.isdigit() != b.isdigit()
        within = [(a, b) for a, b in pairs if not change(a, b) and a.isalpha()]
        vowels = "aeiouAEIOU"
        if re.fullmatch("[0-9a-f]+|[0-9A-F]+", t.replace("-", "")):
            continue
        ps = [tail(sum(c in "jkqvwxyzJKQVWXYZ" for c in letters), len(letters), secrets.RARE), tail(sum(change(a, b) for a, b in pairs), len(pairs), secrets.CHANGE), tail(sum(a not in vowels and b not in vowels for a, b in within), len(within), secrets.CONSONANTS)]
        x = -sum(math.log(p) for p in ps)
        assert got[t]["p"] == pytest.approx(math.exp(-x) * (1 + x + x * x / 2), rel=1e-6), t
    values = spark.createDataFrame([([float(rng.randrange(64)) for _ in range(rng.randint(20, 80))],) for _ in range(500)], "v array<double>")
    for r in values.select("v", secrets.p_value(F.col("v"), 64, 8).alias("p")).limit(50).collect():
        v = np.array(r["v"])
        n, high = len(v), v >= 32
        chi = ((np.bincount((v // 8).astype(int), minlength=8) - n / 8) ** 2 / (n / 8)).sum()
        q = lambda z: math.erfc(z / math.sqrt(2)) / 2
        chi_p = q(((chi / 7) ** (1 / 3) - (1 - 2 / 63)) / math.sqrt(2 / 63))
        h = int(high.sum())
        mean = 2 * h * (n - h) / n + 1
        runs_p = 2 * q(abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt((mean - 1) * (mean - 2) / (n - 1)))
        d = v - v.mean()
        serial = 2 * q(abs((d[1:] * d[:-1]).sum() / (d * d).sum() + 1 / n) * math.sqrt(n))
        assert r["p"] == pytest.approx(min(1, 3 * min(chi_p, runs_p, serial)), rel=0.01)
    passed = values.where(secrets.p_value(F.col("v"), 64, 8) >= secrets.GATE).count()
    assert passed >= 0.98 * 500


def test_threshold_is_benjamini_hochberg(spark):
    rng = random.Random(31)
    rows = [(i, f"{identifier(rng)} {''.join(rng.choices(BASE64, k=40)) if i % 5 == 0 else ''}") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    each = [(r["x"]["p"], len(r["x"]["s"]["token"])) for r in frame.select(F.explode(secrets.tokens(F.col("text"))).alias("x")).collect()]
    m, mean = len(each), sum(n for _, n in each) / len(each)
    ranked = sorted(p for p, _ in each)
    exact = max((p for i, p in enumerate(ranked, 1) if m * p * mean <= secrets.FDR * i), default=-1)
    assert exact > 0 and exact / 10**0.11 <= secrets.threshold(frame) <= exact * 10**0.11
    assert secrets.threshold(frame.limit(0)) == -1 and secrets.scan_secrets(frame.limit(0)).count() == 0


def test_fixed_patterns_are_no_discoveries(spark):
    """Hex keys, access keys and assignments beside the same names change neither the threshold nor what the battery adds."""
    rng = random.Random(32)
    rows = [(i, f"{identifier(rng)} {''.join(rng.choices(BASE64, k=40)) if i % 5 == 0 else ''}") for i in range(200)]
    made = [lambda: "%032x" % rng.getrandbits(128), lambda: "AKIA" + "".join(rng.choices(BASE64[:26] + BASE64[52:62], k=16)), lambda: "api_key=" + "".join(rng.choices(BASE64, k=40)), lambda: "mysecret: x9" + "".join(rng.choices(BASE64, k=30)) + "." + "".join(rng.choices(BASE64, k=30))]
    based = [(1000 + i, f"see {rng.choice(made)()} {rng.choice(made)()}") for i in range(150)]
    frame, more = (spark.createDataFrame(x, "doc_id long, text string") for x in (rows, rows + based))
    assert secrets.threshold(frame) == secrets.threshold(more) > 0
    assert secrets.threshold(more.where("doc_id >= 1000")) == -1
    added = lambda f: {(k, x["start"]) for k, r in as_dict(secrets.scan_secrets(f)).items() for x in r["secrets"] if x["kind"] == "random"}
    assert added(more) == added(frame) and all(k < 1000 for k, _ in added(more))


def test_many_spans_in_one_text(spark):
    """Spans at the edges of blocks, and a text whose spans are many: a time that their square would not be."""
    rng = random.Random(33)
    made = [lambda: "%032x" % rng.getrandbits(128), lambda: "token=" + "".join(rng.choices(BASE64, k=9)), lambda: "aBcDeFgH0123456789xyz-" + str(rng.randint(10, 99))]
    rows = {n: " ".join(rng.choice(made)() for _ in range(n)) for n in (1, 255, 256, 257, 511, 512, 513, 700)}
    found = as_dict(secrets.scan_secrets(spark.createDataFrame(list(rows.items()), "doc_id long, text string")))
    for n, t in rows.items():
        assert ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in found[n]["secrets"] if x["kind"] != "random") == base_spans(t)
    long = " ".join("%032x token=%06x" % (rng.getrandbits(128), rng.getrandbits(24)) for _ in range(30000))
    began = time.monotonic()
    r = secrets.scan_secrets(spark.createDataFrame([(1, long)], "doc_id long, text string")).select(F.size("secrets").alias("n")).first()
    assert r["n"] == 60000 and time.monotonic() - began < 30


# 6


def test_language_id(spark, docs, empty):
    rng = random.Random(2)
    made = []
    for i in range(400):
        lang, letters = (("aa", "abcde"), ("bb", "cdefg"), ("cc", "pqrst"))[i % 3]
        made.append((i, prose(rng, rng.randint(20, 60), letters), lang))
    frame = spark.createDataFrame(made, "doc_id long, text string, lang string")
    model = langid.train(frame, sample=60)
    found = as_dict(langid.predict(frame.withColumns({"lang_pred": F.lit(1), "Score": F.lit(2)}), model))
    out = [i for i, _, _ in made if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(found[i]["lang_pred"] == made[i][2] for i in out) >= 0.95 * len(out)
    assert all(0 <= r["score"] <= 1 for r in found.values())
    mixed = [w for w, _ in zip((prose(rng, 20, "abcde") + " " + prose(rng, 20, "pqrst")).split(), range(40), strict=False)]
    mass = model.posteriors(model.scored(mixed)[0].astype("float64"), np.array([40])).argmax(axis=1)
    assert (mass[:18] == 0).mean() > 0.8 and (mass[22:] == 2).mean() > 0.8
    odd = as_dict(langid.predict(docs, model))
    assert all(odd[r["doc_id"]]["lang_pred"] == "und" for r in docs.where("text is null or not text rlike '\\\\p{L}'").collect())
    assert langid.predict(empty, langid.train(empty)).count() == 0
    held = as_dict(frame.select("doc_id", langid.held_out(F.col("doc_id")).alias("h")))
    assert {i for i, r in held.items() if r["h"]} == set(out)


def small_crf(rng, n_labels=3):
    return langid.Crf([f"l{i}" for i in range(n_labels)], {"": 0}, np.zeros((1, n_labels)), rng.normal(size=(n_labels, n_labels)))


def paths(model, scores):
    """Every label path of a chain with its weight."""
    k = range(len(model.labels))
    return [(p, math.exp(sum(scores[i, y] for i, y in enumerate(p)) + sum(model.moves[a, b] for a, b in zip(p, p[1:], strict=False)))) for p in itertools.product(k, repeat=len(scores))]


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(5)
    model = small_crf(rng)
    sizes = np.array([6, 4, 4, 1])
    scores = rng.normal(size=(sizes.sum(), 3))
    post = model.posteriors(scores, sizes)
    total, n = langid._pairs(scores, model.moves, sizes)
    wanted, moves, at = np.zeros_like(scores), np.zeros((3, 3)), 0
    for size in sizes:
        every = paths(model, scores[at : at + size])
        z = sum(w for _, w in every)
        for p, w in every:
            for i, y in enumerate(p):
                wanted[at + i, y] += w / z
            for a, b in zip(p, p[1:], strict=False):
                moves[a, b] += w / z
        at += size
    assert np.allclose(post, wanted) and np.allclose(total, moves) and n == sizes.sum() - len(sizes)


def test_runs_carry_the_messages(monkeypatch):
    rng = np.random.default_rng(6)
    model = small_crf(rng, 4)
    monkeypatch.setattr(langid, "RUN", 1)  # runs of 16 labels' words
    found = [(rng.normal(size=(n, 4)).astype("float32"), rng.integers(1, 9, n)) for n in (1, 63, 64, 65, 300, 5)]
    for (scores, sizes), mass in zip(found, model.masses(found), strict=True):
        post = model.posteriors(scores.astype("float64"), np.array([len(scores)]))
        assert np.allclose(mass, (post * sizes[:, None]).sum(axis=0))


def test_gradient_raises_the_likelihood():
    """A model that is fitted gives its chains, code-switched ones among them, more than chance."""
    rng = random.Random(4)
    rows = [(prose(rng, 30, letters), lang) for _ in range(60) for lang, letters in (("aa", "abcde"), ("bb", "pqrst"))]
    model = langid.fit(rows)
    words = prose(rng, 20, "abcde").split() + prose(rng, 20, "pqrst").split() + prose(rng, 20, "abcde").split()
    scores, _ = model.scored(words)
    best = model.posteriors(scores.astype("float64"), np.array([60])).argmax(axis=1)
    assert (best == np.repeat([0, 1, 0], 20)).mean() > 0.95
    assert model.moves[0, 0] > model.moves[0, 1] and abs(model.moves[0, 1]) < 3  # switches are learned, not ruled out


def test_long_texts_are_predicted_piece_by_piece(monkeypatch):
    rng = random.Random(8)
    model = langid.fit([(prose(rng, 30, letters), lang) for _ in range(60) for lang, letters in (("aa", "abcde"), ("bb", "pqrst"))])
    texts = [prose(rng, 900, "abcde") + " " + prose(rng, 100, "pqrst"), "", "12 34", prose(rng, 5, "pqrst")]
    whole = model.predict(texts)
    monkeypatch.setattr(langid, "LONG", 10)
    monkeypatch.setattr(langid, "AT_ONCE", 7)
    pieces = model.predict(texts)
    assert [x for x, _ in whole] == [x for x, _ in pieces] == ["aa", "und", "und", "bb"]
    assert [s for _, s in whole] == pytest.approx([s for _, s in pieces], abs=1e-5)


# 7


def brute_components(rows, percent=90):
    sets, ids = {}, sorted(rows)
    for k, t in rows.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[k] = frozenset(zip(w, w[1:], w[2:], strict=False)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])
    label = {k: k for k in ids}
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    return {k: (len(sets[k]), label[k]) for k in ids}


@pytest.mark.parametrize("block", [512, 3])
def test_ngram_join_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "LEADERS", 1)
    rng = random.Random(11)
    rows, k = {}, 0
    for _ in range(12):
        words = prose(rng, rng.randint(8, 90)).split()
        for _ in range(rng.randint(1, 8)):
            mine = list(words)
            for _ in range(rng.randint(0, 2)):
                mine[rng.randrange(len(mine))] = prose(rng, 1)
            rows[k] = " ".join(mine if rng.random() < 0.8 else [w.upper() for w in mine])
            k += 1
    rows |= {k: None, k + 1: "", k + 2: "a b", k + 3: "A b", k + 4: "a"}
    frame = spark.createDataFrame([(i, t) for i, t in rows.items()], "doc_id long, text string").withColumn("row", F.lit(0)).repartition(4)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_components(frame, count=False, block=block, local=3 if block == 3 else 64).collect()}
    assert found == brute_components(rows)


def test_ngram_join_of_awkward_rows(docs, rows, empty):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_components(docs).collect()}
    wanted = brute_components(rows)
    assert found == wanted
    left = ngram_join.one_of_each(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == sorted({c for _, c in wanted.values()})
    assert ngram_join.link_components(empty).count() == 0


@pytest.mark.parametrize("block", [512, 3])
def test_ngram_join_counts_every_link(spark, block):
    rng = random.Random(12)
    texts = [None, "", "a b", "A b"]
    for size in (9, 5, 1):
        words = prose(rng, 70).split()
        for i in range(size):
            mine = list(words)
            if i:
                mine[i * 7] = prose(rng, 1)
            texts += [" ".join(mine)] * rng.randint(1, 3)
    sets = [frozenset(zip(w, w[1:], w[2:], strict=False)) if len(w) >= 3 else frozenset([tuple(w)] if w else []) for w in (WORD.findall((t or "").lower()) for t in texts)]
    wanted = {i: sum(i != j and bool(a & b) and 100 * len(a & b) >= 90 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)}
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: (r["n_links"], r["component_id"]) for r in ngram_join.link_components(frame, block=block, local=3 if block == 3 else 64).collect()}
    assert {k: n for k, (n, _) in found.items()} == wanted and max(wanted.values()) > 5
    without = {r["doc_id"]: r["component_id"] for r in ngram_join.link_components(frame, count=False, block=block).collect()}
    assert {k: c for k, (_, c) in found.items()} == without


def test_divide_skip_finds_all_partners():
    rng = np.random.default_rng(1)
    common = rng.integers(1, 1 << 60, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(common)[: rng.integers(150, 200)], rng.integers(1, 1 << 60, rng.integers(0, 30), dtype=np.uint64)])) for _ in range(60)]
    search = ngram_join.Search(sets)
    for q in range(len(sets)):
        wanted = [p for p in range(len(sets)) if p != q and ngram_join.linked(len(np.intersect1d(sets[p], sets[q])), len(sets[p]), len(sets[q]))]
        assert sorted(search.partners(q, np.ones(len(sets), dtype=bool)).tolist()) == wanted


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 30)] + [(50, 51), (60, 51), (70, 70)]
    found = {r[0]: r[1] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {i: 1 for i in range(1, 31)} | {50: 50, 51: 50, 60: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# 8


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(queries.VOCABULARY)


def test_bpe_against_the_library(docs, rows, empty, tokenizer):
    found = as_dict(bpe.encode_texts(docs.withColumn("ids", F.lit(1)), queries.VOCABULARY))
    for k, t in rows.items():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert found[k]["ids"] == ids and found[k]["n_tokens"] == len(ids)
        assert found[k]["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert found[k]["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
    assert bpe.encode_texts(empty, queries.VOCABULARY).count() == 0


def test_bpe_of_long_words(tokenizer):
    own, rng = bpe.WordBpe(queries.VOCABULARY), random.Random(6)
    words = ["".join(rng.choices("abcdeinorst", k=n)) for n in (2, 3, 50, 255, 256, 257, 300, 2000)] + ["a" * 1000, "ab" * 700, "漢字" * 300]
    for w in words:
        raw = w.encode()
        parts = [own.inner[b] for b in raw[:-1]] + [own.last[raw[-1]]]
        assert own.heaped(list(parts)) == own.merged(list(parts)), w[:40]
        assert own.encode(w) == tokenizer.encode(w, add_special_tokens=False).ids
    long = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200_000))
    assert own.encode(long) == tokenizer.encode(long, add_special_tokens=False).ids


def test_bpe_odd_characters(tokenizer):
    own = bpe.WordBpe(queries.VOCABULARY)
    for text in [chr(i) + "a" + chr(i) for i in range(0x3000) if not 0xD800 <= i < 0xE000] + ["ΑΣ Σ", "<|startoftext|>don't<|endoftext|>!!", "İ ß ﬁ"]:
        assert own.encode(text) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


# 9


def brute_substrings(rows):
    seen, out = set(), {}
    for k in sorted(rows):
        raw = (rows[k] or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            w = raw[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        runs = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[k] = (len(raw), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("bounds", [{}, {"hot": 2, "local": 3}, {"hot": 3, "local": 1 << 20, "piece": 3000}, {"local": 2, "piece": 1000, "route": 500}])
def test_substrings_against_brute_force(spark, docs, rows, empty, bounds):
    rng = random.Random(15)
    passages = [prose(rng, rng.randint(15, 60)) for _ in range(5)]
    more = {}
    for i in range(2000, 2060):
        parts = [prose(rng, rng.randint(1, 30))]
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            parts += [p[rng.randint(0, len(p) // 3) : rng.randint(2 * len(p) // 3, len(p))], prose(rng, rng.randint(0, 9))]
        more[i] = " ".join(parts)
    more |= {2100: "ab" * 700, 2101: "é" * 300 + "z" * 200, 2**53 + 1: "z" * 400, 2**63 - 1: passages[0]}
    frame = docs.select("doc_id", "text", "row").unionByName(spark.createDataFrame([(k, v, 1) for k, v in more.items()], "doc_id long, text string, ROW int"))
    found = as_dict(substring_dedup.dedup_substrings(frame, bounds=substring_dedup.Bounds(**bounds)))
    assert {k: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for k, r in found.items()} == brute_substrings(rows | more)
    assert substring_dedup.dedup_substrings(empty).count() == 0


def test_suffix_sort_and_neighbours():
    rng = random.Random(4)
    raw = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(1500)) * 2, dtype=np.uint8)
    at = np.arange(0, len(raw) - 100, 7)
    group = np.searchsorted([100, 150], np.arange(len(at)), "right")
    size = np.array([rng.randint(0, 100) for _ in at])
    key = lambda i: (int(group[i]), raw[at[i] : at[i] + size[i]].tobytes())
    wanted = sorted(range(len(at)), key=key)
    order, shared = substring_dedup.neighbours(raw, at, size, group)
    assert order.tolist() == wanted
    for i, j, n in zip(order[:-1], order[1:], shared[1:], strict=True):
        a, b = key(i), key(j)
        assert n == (-1 if a[0] != b[0] else next((k for k, (x, y) in enumerate(zip(a[1], b[1], strict=False)) if x != y), min(len(a[1]), len(b[1]))))


def test_wrong_hashes_are_seen(monkeypatch):
    """With hashes that always agree the bytes still decide."""
    monkeypatch.setattr(substring_dedup.Suffixes, "hashes", lambda self, at, size: np.zeros(len(at), dtype=np.uint64))
    raws = [b"x" * 40 + b"anchor" + bytes([c]) * 120 for c in (1, 2, 1)]
    gone = substring_dedup.repeats(raws, np.array([20] * 3), np.array([40] * 3), np.zeros(3, dtype=int))
    assert not gone[0].any() and not gone[1].any() and gone[2].sum() == 20


def test_a_text_over_several_pieces():
    rng = random.Random(9)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(1_300_000))
    raw = np.frombuffer(text * 2, dtype=np.uint8)
    anchor, doc, start, n, lead = substring_dedup.fragments(raw, np.array([len(text)] * 2))
    assert n.sum() == 2 * (len(text) - 99) and (lead >= 0).all() and (lead < substring_dedup.WIDE).all()
    for k in rng.sample(range(len(anchor)), 50):
        p = len(text) * doc[k] + start[k] + lead[k]
        assert substring_dedup.gram_hashes(raw[p : p + substring_dedup.GRAM])[0] == anchor[k]


# 10


def test_html(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>x</p>";</script></head><body><nav><ul><li>Home</li></ul></nav>
    <div class="cookie-notice">We use cookies</div><header>Site</header><article><h1>Head &amp; more</h1><p><b>One\n  two<br>three<p>Four&nbsp;&#8212; <a href="/">five</a></p>
    <!-- hidden --><div class="ad">Buy</div><ul><li>a<li>b</ul><blockquote>q</blockquote><form>Name</form></article><div id="comments"><p>First!</p></div><footer>&copy;</footer></body></html>"""
    same = "<body><div class='x1'>Welcome to the site of all sites</div><div><p>Own text {}</p></div></body>"
    rows = [(1, "http://a.example/1", page), (2, None, None), (3, "x", ""), (4, "http://A.example/2", "<p>cut off <b>here &lt;"), (5, "u", "5 < 6 and <notclosed")]
    rows += [(10 + i, f"http://h.example/{i}", same.format(i)) for i in range(12)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("old"), "Host": F.lit(1)})
    found = as_dict(html_extract.extract_text(frame), "page_id")
    assert found[1]["text"] == "Head & more\nOne two three\nFour — five\na\nb\nq"
    assert found[2]["text"] == found[3]["text"] == "" and found[2]["n_chars"] == 0
    assert found[4]["text"] == "cut off here <" and found[4]["n_chars"] == 14
    assert all(found[10 + i]["text"] == f"Own text {i}" for i in range(12))
    assert html_extract.extract_text(frame.limit(0)).count() == 0


def extracted(spark, pages):
    frame = spark.createDataFrame([(i, f"http://h.example/{i}", x) for i, x in enumerate(pages)], "page_id long, url string, html string")
    return {k: r["text"] for k, r in as_dict(html_extract.extract_text(frame), "page_id").items()}


def test_html_copies_of_an_article_keep_it(spark):
    rng = random.Random(6)
    parts = [prose(rng, 40) for _ in range(3)]
    body = "".join(f"<p>{t}</p>" for t in parts)
    wanted = "\n".join(parts)
    shapes = [
        "<body><div id=wrap><article>{}</article></div></body>",
        "<body><article><div class=body>{}</div></article></body>",
        "<body><div class=body>{}</div></body>",
        "<body>{}</body>",
        "<body><main><section><div>{}</div></section></main></body>",
    ]
    for shape in shapes:
        for own in ("", "<div><p>seen {} times</p></div>"):  # copies as they are, and copies that differ elsewhere
            page = shape.format(body).replace("</body>", own + "</body>")
            found = extracted(spark, [page.replace("{}", str(i)) for i in range(12)])
            assert all(t.startswith(wanted) for t in found.values()), shape


def test_html_counts_pages_that_differ(spark):
    rng = random.Random(7)
    box = "<div class=z>Welcome to this site</div>"
    few = [f"<body>{box}<section><p>{prose(rng, 30)}</p></section></body>" for _ in range(4)]
    assert all("Welcome" in t for t in extracted(spark, few * 3).values())
    many = [f"<body>{box}<section><p>{prose(rng, 30)}</p></section></body>" for _ in range(5)]
    assert not any("Welcome" in t for t in extracted(spark, many).values())


def test_html_keeps_the_text_of_the_page(spark):
    rng = random.Random(13)
    a, b, c = (prose(rng, 40) for _ in range(3))
    cases = [
        (f"<article><p>{a}</p><figure><img src=x><figcaption>{b}</figcaption></figure><figure><table><tr><td>{c}</td></tr></table></figure></article>", [a, b, c]),
        ("<article><p>if <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> then</p></article>", ["if x=2 then"]),
        (f"<article><p>{a}</p></article><article><p>{b}</p></article><p>{'z' * 20}</p>", [a, b]),
        (f"<article><p>short</p></article><div class=c><p>{a}</p><p>{b}</p></div>", ["short", a, b]),
        (f"<div class='content has-sidebar'><article><p>{a}</p></article></div>", [a]),
        (f"<div class='no-sidebar'><p>{a}</p></div>", [a]),
        (f"<div class='widget-area'><main><p>{a}</p></main></div><p>more</p>", [a]),
        (f"<div class='social page'><p>{a}</p><p>{b}</p></div><p>more</p>", [a, b, "more"]),
        (f"<article><h1>Head</h1><div class='share box'><p>{a}</p></div><div class=ad>Buy</div></article>", ["Head", a]),
        (f"<article><p>{a}</p></article><div class=comments><p>{b}</p><p>{c}</p></div>", [a]),
        (f"<div><p>{a}</p><p>{b}</p></div><div class=related><article>one</article><article>two</article></div>", [a, b]),
    ]
    found = extracted(spark, [f"<body>{page}</body>" for page, _ in cases])
    for i, (page, wanted) in enumerate(cases):
        assert found[i] == "\n".join(wanted), page
    box = "<div class=z><p>Welcome to this site</p></div>"
    pages = [f"<body><div class=wrap>{box}<div class=c><p>{prose(rng, 60)}</p></div></div></body>" for _ in range(6)]
    assert not any("Welcome" in t for t in extracted(spark, pages).values())


def test_html_templates_do_not_depend_on_the_size_of_the_host(spark):
    rng = random.Random(15)
    box = "<div class=z>Welcome to this site</div>"
    pages = [f"<body>{box * (k < 5)}<section><p>{prose(rng, 12)}</p></section></body>" for k in range(400)]
    assert not any("Welcome" in t for t in extracted(spark, pages).values())


def test_html_templates_against_brute_force(spark):
    """Subtrees of pages built from known ones, counted one by one: what recurs on 5 pages or more that differ outside it goes."""
    rng = random.Random(16)
    boxes = [f"<section><div>{prose(rng, rng.randint(1, 9))}</div><ul><li>{prose(rng, 2)}</li><li>{prose(rng, 3)}</li></ul></section>" for _ in range(8)]
    pages, used, uses = [], [], collections.defaultdict(set)
    for k in range(60):
        mine = [i for i in range(8) if rng.random() < (i + 1) / 30]
        body = prose(rng, 80)
        host = k % 3
        for i in mine:
            uses[host, i].add(k)
        used.append(mine)
        around = [boxes[i] for i in mine]
        rng.shuffle(around)
        pages.append((k, f"https://h{host}.example/{k}", f"<body>{''.join(around)}<div class=c><p>{body}</p></div></body>"))
    for k in (3, 4):  # recrawled: the same page again and again counts once
        pages += [(100 + 10 * k + j, pages[k][1], pages[k][2]) for j in range(6)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_extract.extract_text(frame).collect()}
    text = lambda box: re.sub(r"\s*\n+\s*", "\n", re.sub("<[^>]+>", "\n", box)).strip()
    gone = 0
    for k, _, _ in pages:
        source = k if k < 60 else 3 if k < 140 else 4
        for i in used[source]:
            template = len(uses[source % 3, i]) >= html_extract.MIN_PAGES
            gone += template
            assert (text(boxes[i]) in found[k]) == (not template), (k, i)
    assert gone > 20
    whole = {r["page_id"]: r["text"] for r in html_extract.extract_text(frame, few=0).collect()}
    assert whole == found and html_extract.templates(html_extract.parsed(frame)).count() > 5


def test_html_templates_inside_articles(spark):
    """Boxes that recur inside articles go; sentences that many articles share stay, and so do copies with changes."""
    rng = random.Random(17)
    follow, box = "<p>Follow the paper on every channel.</p>", "<div class=z><span>Follow us</span></div>"
    pages = [f"<body><article><h1>{prose(rng, 5)}</h1><p>{prose(rng, 40)}</p>{box}{follow}</article></body>" for _ in range(40)]
    assert all(t.endswith("\nFollow the paper on every channel.") and "Follow us" not in t for t in extracted(spark, pages).values())
    parts = [prose(rng, 30).split() for _ in range(5)]
    copies = []
    for k in range(20):
        mine = [list(p) for p in parts]
        mine[1][k] = mine[3][k] = f"own{k}"
        copies.append("<body><article>" + "".join(f"<p>{' '.join(p)}</p>" for p in mine) + "</article></body>")
    assert all(len(t.split("\n")) == 5 for t in extracted(spark, copies).values())


def test_html_class_words_and_hidden_parts(spark):
    rng = random.Random(18)
    body = prose(rng, 40)
    cases = [
        (f"<div class='post-content has-sidebar'><p>{body}</p></div>", body),
        (f"<div class='related-work'><article><p>{body}</p></article></div>", body),
        (f"<article><p>{body}</p><p>a<span hidden>x<span>y</span>z</span>b</p></article>", f"{body}\nab"),
        (f"<article><p>{body}</p></article><article><p>{prose(random.Random(1), 9)}</p></article>", f"{body}\n{prose(random.Random(1), 9)}"),
    ]
    found = extracted(spark, [f"<body>{page}</body>" for page, _ in cases])
    assert [found[i] for i in range(len(cases))] == [text for _, text in cases]
    page = f"<body><div><h1>{prose(rng, 4)}</h1><p>{body}</p></div></body>"
    assert set(extracted(spark, [page] * 6).values()) == {"\n".join(re.findall(r">([^<]+)<", page))}


def test_fractions_stay_exact():
    assert isinstance(mixing.targets([1], [1])[0], Fraction)


def test_queries_have_the_contract_columns(spark, sf):
    found = queries.op2_exact_dedup(spark, sf)
    assert {"doc_id", "keep_id", "group_size", "kept", "text_sha256"} <= set(found.columns)
    assert as_dict(queries.op4_chat_format(spark, sf), "conv_id")[-7]["loss_chars"] == len("\\### Assistant: </turn> ok")


@pytest.mark.parametrize("name", queries.QUERIES)
def test_queries_run_with_generated_code(spark, sf, name):
    """The other tests do without code generation, which clusters use."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    try:
        rows = queries.QUERIES[name](spark, sf).count()
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", "false")
    table = {"op4_chat_format": "conversations", "op10_html_extract": "pages"}.get(name, "documents")
    source = spark.read.parquet(f"{sf}/{table}.parquet")
    assert rows == (source.select("conv_id").distinct().count() + 1 if table == "conversations" else source.count())


# What names and attributes say, and letters by category


def main_text_of(page):
    blocks, nodes = html_extract.parsed_page(page)
    return html_extract.main_text(blocks, nodes, [False] * len(nodes))


def test_html_attributes_say_what_is_hidden_only_by_name():
    body = "The body of the article goes on for several sentences, so that it is its page's main text. " * 5
    said = "Earlier work looked at many of the same questions, and found answers that we discuss below in some depth."
    for mark in ('title="the hidden cost of x"', 'data-x="very hidden thing"', "data-hidden=1", 'data-style="display:none"', 'alt="display: none"', 'data-class="sidebar"'):
        assert main_text_of(f"<article {mark}><p>{body}</p><p {mark}>{said}</p></article>") == f"{body.strip()}\n{said}"
    for mark in ("hidden", "HIDDEN=''", 'aria-hidden="true"', 'style="color:red; display : none"'):
        assert main_text_of(f"<article><p>{body}</p><p {mark}>{said}</p></article>") == body.strip()
    for name, stays in (("related-work", True), ("social-history", True), ("notice-of-terms", True), ("related", False), ("sidebar", False), ("ad-slot", False), ("comments-area", False)):
        assert (said in main_text_of(f'<article><p>{body}</p><section class="{name}"><p>{said}</p></section></article>')) == stays, name
    assert main_text_of(f'<article><p>{body}</p><div class="related-posts"><a href="/x">{said}</a></div><div id=share-bar>Share</div></article>') == body.strip()


def test_html_hidden_elements_that_are_never_closed():
    page = "<article><p>" + "<span hidden>word " * 30000
    start = time.monotonic()
    assert main_text_of(page).split() == ["word"] * 30000
    assert time.monotonic() - start < 5
    assert main_text_of("<p>a<b hidden>x<b>y</b>z</b>c<b hidden>d</p>") == "acd"


def test_language_of_texts_of_numbers_and_of_many_languages(spark):
    model = langid.fit([("the cat sat on the mat", "en"), ("der hund und die katze", "de")])
    assert model.predict(["½ ² ③ Ⅷ", "", "12 34"]) == [("und", 0.0)] * 3
    rng = random.Random(3)
    words = {f"l{i:03d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(4)] for i in range(300)}
    rows = [(4 * i + k, " ".join(rng.choice(w) for _ in range(8)), lang) for i, (lang, w) in enumerate(words.items()) for k in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(langid.train(frame).labels) == 300
    assert len(langid.train(frame, labels=5).labels) == 5
