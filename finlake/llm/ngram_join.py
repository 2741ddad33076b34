"""N-gram Jaccard join by T-occurrence search, and the components of its links.

A document's set is its distinct 3-word shingles (64-bit hashes). Sets link when their Jaccard similarity reaches
PERCENT. All steps before the search only leave out pairs that can't link:

1. Equal sets are one class, which its first document stands for.
2. Two sets that link share at least c shingles among their first 0.1 n + c in hash order. A text of whose first
   shingles too many are its own is done, whatever passages it shares.
3. The same rule over all shingles of the sets that are left, the rarest first: two sets that link share one of their
   first 0.1 n + 1. Sets that share such a shingle form clusters.
4. Clusters are cut into blocks, all of which hold the cluster's leaders. In a block each set is searched by
   DivideSkip: its short inverted lists are merged by a heap, the sets that occur often enough there are probed for in
   its long lists by binary search, and those that reach the overlap link. Sets that are in one component already need
   no search.
5. In clusters of several blocks, sets outside the largest component search all blocks for what is still apart.

Where links are counted, steps 4 and 5 are one: all pairs of a cluster's blocks are searched for every link, so the work
in a cluster of m sets grows with m squared.

Steps 2 and 3 compare 40 bits of the hashes and the route; where two shingles agree in those, a set is searched for nothing.
There are as many routes as the corpus needs, and a task holds one at a time. A shingle that a batch holds twice is known to be
shared: its sets are counted where they are, and only a mark goes to the route. One that LOCAL sets of a batch hold is
common, and sorts after all that aren't. So a shingle in a third of all texts is nobody's list.

Defined results: null and blank texts have empty sets and link with nothing; with fewer than three words the sequence is
the one shingle; null ids come last and are never a component's id unless all are null; of rows with equal ids the first by
file and place is first; a very long text is one set; an empty table gives no rows; extra columns, whatever their names,
aren't used by the join and pass through `one_of_each`.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import WORD, arrow, cut, named, per_batch, placed, released, settled, whole
from finlake.llm.components import components

PERCENT, WORDS = 90, 3
BLOCK, LEADERS = 512, 8
#: Bytes of text whose shingles are one route's, and sets of a batch that make a shingle a common one.
ROUTE, LOCAL = 32 << 20, 64
#: Sorts common shingles after all others.
COMMON = (1 << 31) - 1
#: DivideSkip's weight of a probe against a merge step.
MU = 0.02
_WORD = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    found = _WORD.findall((text or "").translate(_LOWER))
    if not found:
        return np.zeros(0, dtype=np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh64_intdigest("\x00".join(found), 1)], dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, found), dtype=np.uint64, count=len(found))
    n = len(h) - words + 1
    out = h[:n].copy()
    for k in range(1, words):
        out = (out ^ (out >> np.uint64(31))) * _M1 + h[k : k + n]
    out = (out ^ (out >> np.uint64(29))) * _M2
    return np.unique(out ^ (out >> np.uint64(32)))


def slack(n: int, percent: int = PERCENT) -> int:
    """How many of n shingles a linked set may lack."""
    return n - -(-percent * n // 100)


def first_part(n: int, percent: int = PERCENT) -> int:
    """Shingles in hash order that are looked up: two linked sets share slack + 1 of them, by the smaller's slack."""
    return min(n, 2 * slack(n, percent) + 1)


def linked(overlap, a, b, percent: int = PERCENT):
    return 100 * overlap >= percent * (a + b - overlap)


_PACKED = "spot int, route int, kind int, file long, base long, packed binary"


class Packer:
    """Records of a batch's tokens, for their routes: 40 bits of each token above 24 bits of its set's number. kind 0: tokens;
    1: tokens that are common; 2: marks, of tokens that the batch holds more often."""

    def __init__(self, routes: int):
        self.routes = routes
        self.out: list[tuple] = []

    def add(self, kind: int, token: np.ndarray, file: np.ndarray, number: np.ndarray) -> None:
        mixed = token * _M1
        word = ((mixed >> np.uint64(14)) << np.uint64(24)) | (number & ((1 << 24) - 1)).astype(np.uint64)
        route = ((mixed >> np.uint64(54)) ^ (mixed & np.uint64((1 << 14) - 1)) * np.uint64(1021)).astype(np.int64) % self.routes
        high = number >> 24
        order = np.lexsort((route, high, file))
        word, route, high, file = word[order], route[order], high[order], file[order]
        first = np.flatnonzero(np.concatenate([[True], (route[1:] != route[:-1]) | (high[1:] != high[:-1]) | (file[1:] != file[:-1])])) if len(word) else np.zeros(0, int)
        for a, x in zip(first.tolist(), np.split(word, first[1:]), strict=False):
            # What is settled needn't meet at its route.
            spot = int(route[a]) if kind != 1 else int((route[a] * 31 + number[0]) % self.routes)
            self.out.append((spot, int(route[a]), kind, int(file[a]), int(high[a]), x.tobytes()))

    def columns(self) -> dict[str, tuple]:
        return dict(zip(("spot", "route", "kind", "file", "base", "packed"), zip(*self.out, strict=True), strict=True))


def _tokens(packer: Packer, sets: list[np.ndarray], file: np.ndarray, number: np.ndarray, local: int, common: bool) -> np.ndarray:
    """Packs the tokens of a batch's sets; how many of each set's the batch holds `local` times or more. These go along
    only as marks, or also as `common` tokens."""
    token = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    each, code, count = np.unique(token, return_inverse=True, return_counts=True)
    often = count[code] >= local
    packer.add(0, token[~often], file[owner[~often]], number[owner[~often]])
    marks = each[count >= local]
    packer.add(2, marks, np.zeros(len(marks), np.int64), np.zeros(len(marks), np.int64))
    if common:
        packer.add(1, token[often], file[owner[often]], number[owner[often]])
    return np.bincount(owner[often], minlength=len(sets))


_SETS = "file long, row long, doc_id long, n int, digest binary, k int, spot int, route int, kind int, base long, packed binary"


def _sets(percent: int, words: int, routes: int):
    """Step 2: size and digest of each set, how many of its first shingles the batch shares, and the others, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            file, row = (batch.column(i).to_numpy() for i in range(2))
            sets = [shingles(t, words) for t in batch.column(3).to_pylist()]
            packer = Packer(routes)
            k = _tokens(packer, [s[: first_part(len(s), percent)] for s in sets], file, row, 2, False)
            none = lambda kind, n=len(batch): pa.nulls(n, kind)
            yield arrow(
                _SETS, file=batch.column(0), row=batch.column(1), doc_id=batch.column(2), n=[len(s) for s in sets],
                digest=[xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], k=k.astype("int32"),
                spot=none(pa.int32()), route=none(pa.int32()), kind=none(pa.int32()), base=none(pa.int64()), packed=none(pa.binary()),
            )
            if packer.out:
                got = packer.columns()
                none = lambda kind, n=len(packer.out): pa.nulls(n, kind)
                yield arrow(_SETS, row=none(pa.int64()), doc_id=none(pa.int64()), n=none(pa.int32()), digest=none(pa.binary()), k=none(pa.int32()), **got)

    return run


def _routes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """From records sorted by route: (route, kind, word, file, number) of each route's tokens and marks, as arrays; tokens that are
    common at once, record by record."""

    def whole_route(route: int, held: list[tuple]) -> tuple:
        sizes = [len(x[3]) for x in held]
        kind, file, base = (np.repeat(np.array([x[i] for x in held], dtype=np.int64), sizes) for i in range(3))
        word = np.concatenate([x[3] for x in held])
        return route, kind, word >> np.uint64(24), file, (base << 24) | (word & np.uint64((1 << 24) - 1)).astype(np.int64)

    now, held = -1, []
    for batch in batches:
        for route, kind, file, base, raw in zip(*(batch.column(i).to_pylist() for i in range(1, 6)), strict=True):
            record = (kind, file, base, np.frombuffer(raw, dtype="<u8"))
            if kind == 1:
                yield whole_route(route, [record])
                continue
            if route != now and held:
                yield whole_route(now, held)
                held = []
            now = route
            held.append(record)
    if held:
        yield whole_route(now, held)


def _held_twice(kind: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of a route's tokens (no marks) that two or more sets hold, how many here do, and whether there is a mark."""
    order = np.argsort(token, kind="stable")
    token, mark = token[order], kind[order] == 2
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    size = np.diff(np.concatenate([first, [len(token)]]))
    marked = np.repeat(np.logical_or.reduceat(mark, first), size)
    size = np.repeat(size, size)
    pick = (size > 1) & ~mark
    return order[pick], size[pick], marked[pick]


def _shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of a row's tokens on a route are in other batches' sets too."""
    for _, kind, token, file, row in _routes(batches):
        at, _, _ = _held_twice(kind, token)
        if len(at):
            each, k = np.unique(np.stack([file[at], row[at]]), axis=1, return_counts=True)
            yield arrow("file long, row long, k long", file=each[0], row=each[1], k=k)


def _with_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingles(t, words).tobytes() for t in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(made, pa.binary())], names=["file", "row", "n", "size", "set"])

    return run


def _all_tokens(routes: int, local: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, packer = batch.column(0).to_numpy(), Packer(routes)
            _tokens(packer, [np.frombuffer(x, dtype="<u8") for x in batch.column(1).to_pylist()], np.zeros(len(ids), np.int64), ids, local, True)
            if packer.out:
                yield arrow(_PACKED, **packer.columns())

    return run


_SHARED = "id long, df int, token long"


def _shared_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens that two or more sets hold, with their number of sets, or COMMON."""
    for route, kind, token, _, ids in _routes(batches):
        if kind[0] == 1:
            at, df = np.arange(len(ids)), np.full(len(ids), COMMON)
        else:
            at, df, marked = _held_twice(kind, token)
            df = np.where(marked, COMMON, df)
        for a in range(0, len(at), 1 << 15):
            z = at[a : a + (1 << 15)]
            yield arrow(_SHARED, id=ids[z], df=df[a : a + (1 << 15)].astype("int32"), token=token[z].astype(np.int64) | (route << 40))


class Search:
    """DivideSkip over the inverted lists of some sets."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.sets, self.percent = sets, percent
        self.size = np.array([len(s) for s in sets])
        token = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.size)
        self.tokens, code = np.unique(token, return_inverse=True)
        order = np.lexsort((owner, code))
        self.owner = owner[order]
        #: List and member as one ascending number, for binary probes.
        self.keys = code[order].astype(np.int64) * len(sets) + self.owner
        self.bounds = np.searchsorted(code[order], np.arange(len(self.tokens) + 1))
        self.codes = np.split(code, np.cumsum(self.size)[:-1])

    def needed(self, n: int) -> int:
        """The least overlap with any set that a set of n can link with."""
        small = -(-self.percent * n // 100)
        return -(-self.percent * (n + small) // (100 + self.percent))

    def partners(self, q: int, apart: np.ndarray) -> np.ndarray:
        """The sets, of those `apart` marks, that link with set q."""
        lists, n = self.codes[q], int(self.size[q])
        length = self.bounds[lists + 1] - self.bounds[lists]
        need = self.needed(n)
        by = np.argsort(length, kind="stable")
        longest = int(length.max())
        n_long = min(need - 1, max(n - need, int(need / (MU * math.log2(longest + 1) + 1))))
        short, long = lists[by[: n - n_long]], lists[by[n - n_long :]]
        merged = heapq.merge(*(self.owner[self.bounds[x] : self.bounds[x + 1]].tolist() for x in short if self.bounds[x + 1] - self.bounds[x] > 1))
        found, counts, last = [], [], -1
        for member in merged:
            if member == last:
                counts[-1] += 1
            else:
                found.append(member)
                counts.append(1)
                last = member
        at, count = np.array(found, dtype=np.int64), np.array(counts, dtype=np.int64)
        if not len(at):
            return at
        other = self.size[at]
        fits = apart[at] & (at != q) & (count >= need - n_long) & (100 * np.minimum(other, n) >= self.percent * np.maximum(other, n))
        at, count = at[fits], count[fits]
        if len(at) and len(long):
            probe = long[:, None].astype(np.int64) * len(self.sets) + at[None, :]
            place = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
            count = count + (self.keys[place] == probe).sum(axis=0)
        return at[linked(count, n, self.size[at], self.percent)]


def find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def forest(sets: list[np.ndarray], queries: list[int], label: list[int] | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links, as few as hold together what all links of the queries hold together. `label`: components known before."""
    parent = list(range(len(sets)))
    first: dict[int, int] = {}
    for i, x in enumerate(label or []):
        parent[i] = first.setdefault(x, i)
    out, search = [], Search(sets, percent)
    roots = np.array([find(parent, i) for i in range(len(sets))])
    for q in queries:
        root = roots[q]
        apart = roots != root
        if not apart.any():
            continue
        for p in search.partners(q, apart).tolist():
            if (a := find(parent, p)) != (b := find(parent, q)):
                out.append((q, p))
                parent[max(a, b)] = min(a, b)
                roots[(roots == a) | (roots == b)] = min(a, b)
    return out


def all_links(sets: list[np.ndarray], weight: np.ndarray, far: np.ndarray | None = None, percent: int = PERCENT) -> tuple[list[tuple[int, int]], np.ndarray]:
    """A forest of the links, and the weight of each set's partners. `far`: only links between its sets and the others."""
    parent = list(range(len(sets)))
    out, counts, search = [], np.zeros(len(sets), dtype=np.int64), Search(sets, percent)
    at = np.arange(len(sets))
    for q in range(len(sets)):
        if far is not None and far[q]:
            continue
        found = search.partners(q, at > q if far is None else far)
        counts[q] += weight[found].sum()
        counts[found] += weight[q]
        for p in found.tolist():
            if (a := find(parent, p)) != (b := find(parent, q)):
                out.append((q, p))
                parent[max(a, b)] = min(a, b)
    return out, counts


def _counted(percent: int):
    """Links, and for each set with partners (id, id, k): how many documents its partners stand for."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, dtype="<u8") for x in rows["set"]]
        ids, far = rows["id"].to_numpy(), None
        if rows["block"].iloc[0] != rows["other"].iloc[0]:
            far = (rows["at"] == rows["other"]).to_numpy()
        pairs, counts = all_links(sets, rows["size"].to_numpy(), far, percent)
        made = [(ids[a], ids[b], 0) for a, b in pairs] + [(ids[i], ids[i], counts[i]) for i in np.flatnonzero(counts)]
        if len(rows) > 64:
            released()
        return pd.DataFrame(made, columns=["a", "b", "k"], dtype="int64")

    return run


def _links(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["query", "id"], ascending=[False, True]).drop_duplicates("id")
        sets = [np.frombuffer(x, dtype="<u8") for x in rows["set"]]
        ids = rows["id"].tolist()
        label = rows["label"].tolist() if rows["label"].iloc[0] >= 0 else None
        pairs = forest(sets, [i for i, q in enumerate(rows["query"]) if q], label, percent)
        if len(rows) > 64:
            released()
        return pd.DataFrame([(ids[a], ids[b]) for a, b in pairs], columns=["a", "b"], dtype="int64")

    return run


def link_components(df: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT, words: int = WORDS, count: bool = True, block: int = BLOCK, local: int = LOCAL) -> DataFrame:
    """One row per row of `df`: file, row (where it stands), doc_id, n_shingles, component_id and first (whether it is its
    component's first row); with `count`, n_links: how many other rows link with it."""
    docs = placed(df, named(doc_id).cast("long").alias("doc_id"), named(text).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    routes = max(64, -(-int(total) // ROUTE))
    made = cut(per_batch(docs, _sets(percent, words, routes), _SETS))
    meta = made.where("row is not null").select("file", "row", "doc_id", "n", "digest", "k")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "file", "row", "k")
    classes = cut(meta.where("n > 0").groupBy("digest").agg(F.min(order).alias("rep"), F.first("n").alias("n"), F.count("*").alias("size")).select("digest", "rep.*", "n", "size"))

    packed = made.where("route is not null").select("spot", "route", "kind", "file", "base", "packed")
    shared = per_batch(packed.repartition("spot").sortWithinPartitions("route"), _shared_counts, "file long, row long, k long")
    shared = shared.groupBy("file", "row").agg(F.sum("k").alias("more"))
    n = F.col("n")
    least = F.ceil(n * percent / 100)  # what a set that links with n has at least
    lack, lack_least = n - least, least - F.ceil(least * percent / 100)
    # The first part less what two sets share of it, by the smaller's lack, plus one; own shingles fill it first.
    able = classes.select("file", "row", "n", "size", "k").join(shared, ["file", "row"], "left").where(F.col("k") + F.coalesce("more", F.lit(0)) > lack_least)
    loaded = docs.join(able.select("file", "row", "n", "size"), ["file", "row"]).select("file", "row", "n", "size", "text")
    sets = per_batch(loaded, _with_sets(words), "file long, row long, n int, size long, set binary")
    sets = cut(sets.select(F.monotonically_increasing_id().alias("id"), "file", "row", "n", "size", "set"))
    tokens = per_batch(sets.select("id", "set"), _all_tokens(routes, local), _PACKED).repartition("spot").sortWithinPartitions("route")
    tokens = per_batch(tokens, _shared_tokens, _SHARED)
    firsts = tokens.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens")).join(sets.select("id", "n"), "id")
    firsts = firsts.withColumn("take", (lack + 1 - (n - F.size("tokens"))).cast("int")).where("take > 0")
    parts = cut(firsts.select("id", F.explode(F.slice("tokens", F.lit(1), F.col("take"))["token"]).alias("token")))
    pivots = cut(parts.groupBy("token").agg(F.min("id").alias("pivot"), F.count("*").alias("m")).where("m > 1").select("token", "pivot"))
    clusters = components(parts.join(pivots, "token").select(F.col("id").alias("a"), F.col("pivot").alias("b")))
    sizes = clusters.groupBy("label").agg(F.count("*").alias("m"))
    members = cut(clusters.join(sizes, "label").select(F.col("node").alias("id"), F.col("label").alias("cluster"), "m"))
    blocks = F.ceil(F.col("m") / block).cast("int")
    spread = F.pmod(F.xxhash64("id", F.lit(11)), F.greatest(blocks, F.lit(1))).cast("int")
    if count:
        other = F.explode(F.sequence(F.lit(0), F.greatest(blocks, F.lit(1)) - 1))
        paired = members.select("cluster", "id", spread.alias("at"), other.alias("with"))
        paired = paired.select("cluster", "id", "at", F.least("at", "with").alias("block"), F.greatest("at", "with").alias("other"))
        every = cut(paired.join(sets.select("id", "size", "set"), "id").groupBy("cluster", "block", "other").applyInPandas(_counted(percent), "a long, b long, k long"))
        links = every.where("a != b").select("a", "b")
        partners = every.where("a = b").groupBy(F.col("a").alias("id")).agg(F.sum("k").alias("k"))
    else:
        bodies, schema = sets.select("id", "set"), "a long, b long"
        # A cluster's leaders are about LEADERS of its sets, by a hash, and stand in all of its blocks.
        leader = (F.col("m") > block) & (F.pmod(F.xxhash64("id", F.lit(12)), F.col("m")) < LEADERS)
        dealt = members.withColumn("block", F.explode(F.when(leader, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(spread))))
        with_set = dealt.join(bodies, "id").select("cluster", "block", "id", "set", F.lit(-1).cast("long").alias("label"), F.lit(True).alias("query"))
        links = cut(with_set.groupBy("cluster", "block").applyInPandas(_links(percent), schema))

        large = members.where(F.col("m") > block)
        if large.limit(1).count():
            known = components(links)
            now = cut(large.join(known.select(F.col("node").alias("id"), "label"), "id", "left").withColumn("label", F.coalesce("label", "id")))
            per = now.groupBy("cluster", "label").agg(F.count("*").alias("k"))
            most = per.groupBy("cluster").agg(F.max(F.struct("k", "label")).alias("most"), F.count("*").alias("parts"), F.sum("k").alias("total")).where("parts > 1")
            most = cut(most.select("cluster", F.col("most.label").alias("main"), (F.col("total") - F.col("most.k")).alias("outside")))
            left = now.join(most, "cluster").withColumn("query", F.col("label") != F.col("main"))
            n_query, n_all = F.ceil(F.col("outside") / block).cast("int"), F.ceil(F.col("m") / block).cast("int")
            at_query, at_all = F.pmod(F.xxhash64("id", F.lit(13)), n_query).cast("int"), F.pmod(F.xxhash64("id", F.lit(14)), n_all).cast("int")
            as_query = left.where("query").select("cluster", "id", "label", "query", at_query.alias("block"), F.explode(F.sequence(F.lit(0), n_all - 1)).alias("other"))
            as_set = left.select("cluster", "id", "label", F.lit(False).alias("query"), F.explode(F.sequence(F.lit(0), n_query - 1)).alias("block"), at_all.alias("other"))
            again = as_query.unionByName(as_set).join(bodies, "id").select("cluster", "block", "other", "id", "set", "label", "query")
            links = cut(links.unionByName(again.groupBy("cluster", "block", "other").applyInPandas(_links(percent), schema)))

    labels = components(links)
    # A class's component is named by the least (id, place) among its classes' representatives.
    tied = sets.select("id", "file", "row").join(labels.select(F.col("node").alias("id"), "label"), "id").join(classes, ["file", "row"])
    head = F.struct("unknown", "doc_id", "file", "row")
    names = tied.groupBy("label").agg(F.min(head).alias("head"))
    found = cut(tied.join(names, "label").select("id", "digest", "head"))
    heads = classes.join(found.select("digest", "head"), "digest", "left")
    if count:
        counted = sets.select("id", "file", "row").join(partners, "id").select("file", "row", F.col("k").alias("partners"))
        heads = heads.join(counted, ["file", "row"], "left").withColumn("n_links", F.col("size") - 1 + F.coalesce("partners", F.lit(0)))
    heads = cut(heads.select("digest", F.coalesce("head", head).alias("head"), *["n_links"] * count))
    mine = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "file", "row")
    out = meta.join(heads, "digest", "left").withColumn("head", F.coalesce("head", mine))
    links_of = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] * count
    first = (F.col("head.file") == F.col("file")) & (F.col("head.row") == F.col("row"))
    return out.select("file", "row", "doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("head.doc_id").alias("component_id"), first.alias("first"), *links_of)


def one_of_each(df: DataFrame, **names) -> DataFrame:
    """The rows of `df` that are their component's first, with its columns."""
    df = settled(df)
    first = link_components(df, count=False, **names).where("first").select("file", "row")
    return placed(df, whole(df)).join(first, ["file", "row"], "left_semi").select("whole.*")
