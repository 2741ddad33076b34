"""Duplicate substrings across documents, by a hash-compared suffix sort of candidate fragments.

A byte goes if a window of LENGTH bytes around it also starts earlier (smaller document, or same document, earlier
start). Every window names an anchor: the least hashed GRAM-byte gram inside it, of equal ones the first. Equal windows
have equal anchors at equal places, so windows need comparing only where an anchor occurs twice. The stages:

0. Of equal whole texts only the first is searched; the others go entirely.
1. Each batch cuts its texts into fragments (the windows that share an anchor occurrence), settles fragments that the
   batch itself repeats, and sends anchors, packed by route; there are as many routes as the corpus needs. Where a batch
   alone has `local` different fragments of an anchor, these are a group of their own, and only a mark is sent: so
   however hot an anchor is, a route gets fewer than `local` of its occurrences from a batch.
2. Anchors that occur twice or more anywhere make their fragments candidates. An anchor with more than `hot` candidates, or
   with a mark, is dealt over several groups.
3. Candidate fragments travel with their bytes to their anchor's group. There, equal fragments collapse; the others'
   suffixes from the anchor on, and their prefixes before it read backwards, are each sorted by mergesort, where prefix
   polynomial hashes and binary search find how far two agree; what neighbours have in common is then compared byte by
   byte. Windows at one distance from the anchor are equal if both sorts run through between them with enough in common.
   All but a class's first window go.
4. Windows that stay first in one of several groups of an anchor meet again under their digest, one of each group.
5. Spans join their texts.

Nothing is sampled or capped: each step keeps every window that may have an equal. A task holds one batch, one route, or
`piece` bytes of groups at a time; a very long text takes memory in proportion to its own length.

Defined results: null is the empty text; texts under LENGTH bytes lose nothing; null ids come last, equal ids go by file
and place in it; of repeated rows all but one lose everything; an empty table gives no rows; extra columns, whatever their
names, aren't used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.common import arrow, cut, named, per_batch, placed

LENGTH, GRAM = 100, 24
WIDE = LENGTH - GRAM + 1
#: Bits for a place in a piece.
PLACE = 20
#: A fragment: its anchor, its text's row, first window, number of windows, and bytes from there to the anchor. With no
#: windows it is a mark, and `row` the number of fragments that it stands for.
_FRAGMENT = np.dtype([("anchor", "<u8"), ("row", "<u4"), ("start", "<u4"), ("n", "u1"), ("lead", "u1")])
_SPAN = np.dtype([("row", "<u4"), ("start", "<u4"), ("end", "<u4")])
_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
#: kind 0: fragments; 1: fragments of the group `salt`; 2: spans that are settled.
_PACKED = "route int, file long, kind int, salt long, packed binary"
#: lead -1: a span of n bytes that is settled.
_FOUND = "file long, row long, start int, n int, lead int, anchor long, salt long"


@dataclass(frozen=True)
class Bounds:
    """piece: bytes worked on at a time (under 2 ** PLACE). route: bytes of text whose anchors are one route's. hot:
    fragments from which an anchor is dealt over several groups. local: fragments of an anchor that make a batch's
    own group."""

    piece: int = 1 << 19
    route: int = 32 << 20
    hot: int = 4096
    local: int = 64


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place on."""
    x = raw.astype(np.uint64)
    for k in (1, 2, 4):
        x = x[:-k] | (x[k:] << np.uint64(8 * k))
    h = x[:-16] * _C1
    for more, c in ((x[8:-8], _C2), (x[16:], _C3)):
        h ^= h >> np.uint64(29)
        h += more
        h *= c
    h ^= h >> np.uint64(32)
    h *= _C1
    h ^= h >> np.uint64(29)
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    rows = np.full((-(-len(x) // width), width), np.iinfo(np.uint64).max, dtype=np.uint64)
    rows.ravel()[: len(x)] = x
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def fragments(raw: np.ndarray, sizes: np.ndarray, piece: int = Bounds.piece) -> tuple[np.ndarray, ...]:
    """Anchor hash, text number, first window, number of windows and bytes to the anchor of every fragment, in order, of
    texts that lie one after another in `raw`. Fragments end where a piece of `raw` does, too."""
    ends = np.cumsum(sizes)
    out: list[tuple[np.ndarray, ...]] = []
    low = np.uint64((1 << PLACE) - 1)
    for a in range(0, len(raw) - LENGTH + 1, piece):
        part = raw[a : a + piece + LENGTH - 1]
        hashes = gram_hashes(part)
        least = sliding_min((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), WIDE)
        where = (least & low).astype(np.int32)
        place = np.arange(a, a + len(where))
        doc = np.searchsorted(ends, place, "right")
        inside = place + LENGTH <= ends[doc]
        where, place, doc = where[inside], place[inside], doc[inside]
        if len(where):
            first = np.flatnonzero(np.concatenate([[True], (where[1:] != where[:-1]) | (doc[1:] != doc[:-1])]))
            n = np.diff(np.concatenate([first, [len(where)]]))
            at = where[first]
            out.append((hashes[at], doc[first], place[first] - (ends - sizes)[doc[first]], n, at + a - place[first]))
    if not out:
        return tuple(np.zeros(0, dtype=d) for d in ("u8", "i8", "i8", "i8", "i8"))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each document, overlapping and touching ones made one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order].astype(np.int64), end[order].astype(np.int64)
    _, code = np.unique(doc, return_inverse=True)
    wide = int(end.max()) + 2
    reach = np.maximum.accumulate(code * wide + end)
    new = np.concatenate([[True], code[1:] * wide + start[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(doc)]]) - 1
    return doc[first], start[first], reach[last] - code[last] * wide


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A string column's bytes, one text after another, with their starts and sizes; null is empty."""
    column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets[:-1] - offsets[0], np.diff(offsets)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False)


def _cut_batches(routes: int, bounds: Bounds):
    """Stage 1: packed anchors, groups of the batch's own, and spans that the batch settles by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            file, row, ids = (_numbers(batch.column(i)) for i in range(3))
            raw, begin, sizes = texts_of(batch.column(3))
            anchor, doc, start, n, lead = fragments(raw, sizes, bounds.piece)
            if not len(anchor):
                continue
            unknown = batch.column(2).is_null().to_numpy(zero_copy_only=False)
            rank = np.empty(len(file), dtype=np.int64)
            rank[np.lexsort((row, file, ids, unknown))] = np.arange(len(file))
            _, inverse, count = np.unique(anchor, return_inverse=True, return_counts=True)
            again = np.zeros(len(anchor), dtype=bool)
            repeated = np.flatnonzero(count[inverse] > 1)
            repeated = repeated[np.lexsort((start[repeated], rank[doc[repeated]]))]
            body, seen = raw.tobytes(), set()
            at = begin[doc[repeated]] + start[repeated]
            size = n[repeated] + LENGTH - 1
            for i, code, a, z in zip(repeated.tolist(), inverse[repeated].tolist(), at.tolist(), size.tolist(), strict=True):
                key = (code, body[a : a + z])
                if key in seen:
                    again[i] = True
                else:
                    seen.add(key)
            del seen, body
            out: list[tuple] = []

            def add(of: int, kind: int, salt: int, packed: np.ndarray, route: np.ndarray, out: list[tuple] = out) -> None:
                order = np.argsort(route, kind="stable")
                each, first = np.unique(route[order], return_index=True)
                packed = packed[order]
                out += [(r, of, kind, salt, x.tobytes()) for r, x in zip(each.tolist(), np.split(packed, first[1:]), strict=True)]

            left = np.bincount(inverse[~again], minlength=len(count))
            own = ~again & (left[inverse] >= bounds.local)
            for of in np.unique(file).tolist():
                mine = file[doc] == of
                if (mine & again).any():
                    pick = np.flatnonzero(mine & again)
                    d, a, b = merged(doc[pick], start[pick], start[pick] + n[pick] + LENGTH - 1)
                    spans = np.zeros(len(d), dtype=_SPAN)
                    spans["row"], spans["start"], spans["end"] = row[d], a, b
                    add(of, 2, 0, spans, row[d] % routes)
                for which, kind, salt in ((mine & ~again & ~own, 0, 0), (mine & own, 1, int(xxhash.xxh64_intdigest(f"{of} {row.min()} {len(row)}") >> 2) + 1)):
                    pick = np.flatnonzero(which)
                    if len(pick):
                        made = np.zeros(len(pick), dtype=_FRAGMENT)
                        made["anchor"], made["row"], made["start"], made["n"], made["lead"] = anchor[pick], row[doc[pick]], start[pick], n[pick], lead[pick]
                        add(of, kind, salt, made, (made["row"] if kind else (made["anchor"] >> np.uint64(16)) % np.uint64(routes)).astype(np.int64) % routes)
            marks, at = np.unique(anchor[own], return_index=True)
            if len(marks):
                made = np.zeros(len(marks), dtype=_FRAGMENT)
                made["anchor"], made["row"] = marks, left[inverse[own][at]]
                add(0, 0, 0, made, ((marks >> np.uint64(16)) % np.uint64(routes)).astype(np.int64))
            if out:
                route, of, kind, salt, packed = zip(*out, strict=True)
                yield arrow(_PACKED, route=route, file=of, kind=kind, salt=salt, packed=packed)

    return run


def _as_found(file, x: np.ndarray, salt) -> pa.RecordBatch:
    wide = lambda v: np.broadcast_to(np.asarray(v, dtype=np.int64), len(x))
    return arrow(_FOUND, file=wide(file), row=x["row"].astype("int64"), start=x["start"].astype("int32"), n=x["n"].astype("int32"), lead=x["lead"].astype("int32"), anchor=x["anchor"].astype("int64"), salt=wide(salt))


def _of_route(files: list[int], held: list[np.ndarray], hot: int) -> Iterator[pa.RecordBatch]:
    """The candidates among the fragments of one route, with their groups."""
    every, file = np.concatenate(held), np.repeat(np.array(files, dtype=np.int64), [len(x) for x in held])
    order = np.argsort(every["anchor"], kind="stable")
    key = every["anchor"][order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    mark = every["n"][order] == 0
    total = np.add.reduceat(np.where(mark, every["row"][order], 1).astype(np.int64), first)
    dealt = np.logical_or.reduceat(mark, first) | (total > hot)
    size = np.diff(np.concatenate([first, [len(key)]]))
    total, dealt = np.repeat(total, size), np.repeat(dealt, size)
    pick = (total > 1) & ~mark
    order, total, dealt = order[pick], total[pick], dealt[pick]
    for a in range(0, len(order), 1 << 15):
        at = order[a : a + (1 << 15)]
        x, of = every[at], file[at]
        mixed = ((x["row"].astype(np.uint64) ^ of.astype(np.uint64)) * _C1 + x["start"]) * _C2
        salt = np.where(dealt[a : a + (1 << 15)], 1 + (mixed >> np.uint64(33)).astype(np.int64) % -(-total[a : a + (1 << 15)] // hot), 0)
        yield _as_found(of, x, salt)


def _candidates(hot: int):
    """Stage 2, from rows sorted by route: fragments whose anchor occurs twice or more; settled spans pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, files, held = -1, [], []
        for batch in batches:
            for route, file, kind, salt, packed in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if kind == 2:
                    s = np.frombuffer(packed, dtype=_SPAN)
                    n = (s["end"] - s["start"]).astype("int32")
                    zero = np.zeros(len(s), dtype=np.int64)
                    yield arrow(_FOUND, file=zero + file, row=s["row"].astype("int64"), start=s["start"].astype("int32"), n=n, lead=np.full(len(s), -1, "int32"), anchor=zero, salt=s["row"].astype("int64"))
                    continue
                x = np.frombuffer(packed, dtype=_FRAGMENT)
                if kind == 1:
                    yield _as_found(file, x, salt)
                    continue
                if route != now and held:
                    yield from _of_route(files, held, hot)
                    files, held = [], []
                now = route
                files.append(file)
                held.append(x)
        if held:
            yield from _of_route(files, held, hot)

    return run


_SHIPPED = "file long, row long, doc_id long, start int, n int, lead int, anchor long, salt long, raw binary"


def _with_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stage 3, first half: candidates take their bytes along; settled spans pass."""
    for batch in batches:
        raw, begin, _ = texts_of(batch.column(3))
        found = batch.column(4)
        offsets = found.offsets.to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(found)), np.diff(offsets))
        each = found.values.slice(int(offsets[0]), len(owner))
        start, n, lead = (each.field(i).to_numpy() for i in range(3))
        body = raw.tobytes()
        for k in range(0, len(owner), 1 << 14):
            z = slice(k, k + (1 << 14))
            of = pa.array(owner[z])
            at = (begin[owner[z]] + start[z]).tolist()
            end = [a + m + LENGTH - 1 if x >= 0 else a for a, m, x in zip(at, n[z].tolist(), lead[z].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(of) for i in range(3)), *(each.field(i).slice(k, len(of)) for i in range(5)), pa.array([body[a:b] for a, b in zip(at, end, strict=True)], pa.binary())],
                names=["file", "row", "doc_id", "start", "n", "lead", "anchor", "salt", "raw"],
            )


class Suffixes:
    """Suffixes of a text, each up to its own size, compared by prefix polynomial hashes."""

    BASE = 0xD1342543DE82EF95
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self, raw: np.ndarray):
        self.raw = raw
        n = len(raw)
        letters = (np.arange(1, 257, dtype=np.uint64) * _C2) ^ ((np.arange(1, 257, dtype=np.uint64) * _C1) >> np.uint64(31))
        self.up = np.full(n + 1, self.BASE, np.uint64)
        down = np.full(n + 1, self.INVERSE, np.uint64)
        self.up[0] = down[0] = 1
        np.multiply.accumulate(self.up, out=self.up)
        np.multiply.accumulate(down, out=down)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(letters[raw] * down[:n], out=self.sums[1:])

    def hashes(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.up[at]

    def agree(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many bytes, up to `most`, the suffixes at i and j have in common: binary search over hashed prefixes."""
        n = np.zeros(len(i), dtype=np.int64)
        step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
        while step:
            fits = n + step <= most
            skip, size = np.where(fits, n, 0), np.where(fits, step, 0)
            same = self.hashes(i + skip, size) == self.hashes(j + skip, size)
            n += step * (fits & same)
            step >>= 1
        return n

    def below(self, i: np.ndarray, j: np.ndarray, size_i: np.ndarray, size_j: np.ndarray) -> np.ndarray:
        """-1, 0 or 1: how the suffix at i compares with the one at j; a suffix comes before its continuations."""
        most = np.minimum(size_i, size_j)
        n = self.agree(i, j, most)
        inside = n < most
        a, b = self.raw[np.where(inside, i + n, 0)], self.raw[np.where(inside, j + n, 0)]
        return np.where(inside, np.sign(a.astype(np.int16) - b), np.sign(size_i - size_j))

    def sorted(self, at: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes `at` within their groups (`group` ascends): bottom-up mergesort, all merges of a level
        at once; each suffix finds its rank in the other run by binary search. Equals keep their order."""
        order = np.arange(len(at))
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(at) else order
        count = np.diff(np.concatenate([first, [len(at)]]))
        first, count = np.repeat(first, count), np.repeat(count, count)
        inside = np.arange(len(at)) - first
        width = 1
        while len(at) and width < count.max():
            run = inside // width
            right = run % 2 == 1
            other = np.where(right, (run - 1) * width, (run + 1) * width)
            lo = first + np.minimum(other, count)
            hi = first + np.minimum(other + width, count)
            begin = lo.copy()
            me, long = at[order], size[order]
            todo = np.flatnonzero(lo < hi)
            while len(todo):
                mid = (lo[todo] + hi[todo]) >> 1
                side = self.below(me[mid], me[todo], long[mid], long[todo])
                before = (side < 0) | ((side == 0) & right[todo])  # the left run's equals come first
                lo[todo] = np.where(before, mid + 1, lo[todo])
                hi[todo] = np.where(before, hi[todo], mid)
                todo = todo[lo[todo] < hi[todo]]
            place = first + (run - right) * width + (inside - run * width) + (lo - begin)
            new = np.empty_like(order)
            new[place] = order
            order = new
            width *= 2
        return order


def neighbours(raw: np.ndarray, at: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes' order within their groups, and what each has in common with the one before it (-1: none there).
    Hashes propose both; the bytes decide, and where a hash was wrong, the bytes sort."""
    text = Suffixes(raw)
    order = text.sorted(at, size, group)

    def common() -> np.ndarray:
        i, j = at[order[:-1]], at[order[1:]]
        most = np.where(group[order[:-1]] == group[order[1:]], np.minimum(size[order[:-1]], size[order[1:]]), 0)
        return np.concatenate([[0], text.agree(i, j, most)])

    shared = common()
    k = np.flatnonzero(shared)
    for a in range(0, len(k), 1 << 12):
        x = k[a : a + (1 << 12)]
        across = np.arange(int(shared[x].max()))
        i, j = at[order[x - 1]][:, None] + across, at[order[x]][:, None] + across
        differs = (raw[np.minimum(i, len(raw) - 1)] != raw[np.minimum(j, len(raw) - 1)]) & (across < shared[x][:, None])
        if differs.any():
            body = raw.tobytes()
            keys = [(int(g), body[p : p + z]) for g, p, z in zip(group, at, size, strict=True)]
            order = np.array(sorted(range(len(at)), key=keys.__getitem__))
            pairs = zip(order[:-1].tolist(), order[1:].tolist(), strict=True)
            same = [next((n for n, (c, d) in enumerate(zip(keys[p][1], keys[q][1], strict=False)) if c != d), min(len(keys[p][1]), len(keys[q][1]))) for p, q in pairs]
            shared = np.array([0, *same])
            break
    shared[np.concatenate([[True], group[order[1:]] != group[order[:-1]]])] = -1
    return order, shared


def repeats(raws: list[bytes], n: np.ndarray, lead: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which windows (fragment x distance from the anchor: 0 is the farthest before it) aren't the first of their class,
    of fragments that lie in order within their groups."""
    size = np.array([len(x) for x in raws], dtype=np.int64)
    raw = np.frombuffer(b"".join(raws), dtype=np.uint8)
    anchor = np.cumsum(size) - size + lead
    after, in_after = neighbours(raw, anchor, size - lead, group)
    before, in_before = neighbours(raw[::-1].copy(), len(raw) - anchor, lead, group)
    gone = np.zeros((len(raws), WIDE), dtype=bool)
    run_after, run_before = np.empty(len(raws), dtype=np.int64), np.empty(len(raws), dtype=np.int64)
    for far in range(WIDE):  # windows that begin `far` bytes before the anchor
        has = np.flatnonzero((far <= lead) & (far > lead - n))
        if len(has) < 2:
            continue
        run_after[after] = np.cumsum(in_after < LENGTH - far)
        run_before[before] = np.cumsum(in_before < far)
        key = run_after[has] * (len(raws) + 1) + run_before[has]
        _, first = np.unique(key, return_index=True)
        again = np.ones(len(has), dtype=bool)
        again[first] = False
        gone[has[again], WIDE - 1 - far] = True
    return gone


_SPANS = "file long, row long, doc_id long, start int, end int, digest binary"


def _settled(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Stage 3, second half: removed spans of whole groups, and the digests of first windows of dealt-out groups."""
    raws = rows.column("raw").to_pylist()
    file, row, start, n, lead, anchors, salts = (rows.column(c).to_numpy().astype(np.int64) for c in ("file", "row", "start", "n", "lead", "anchor", "salt"))
    new = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (salts[1:] != salts[:-1])])
    group = np.cumsum(new) - 1
    seen: set[tuple[int, int, bytes]] = set()
    again = np.zeros(len(raws), dtype=bool)
    for i, key in enumerate(zip(group.tolist(), lead.tolist(), raws, strict=True)):
        if key in seen:
            again[i] = True
        else:
            seen.add(key)
    del seen
    spans = [(np.flatnonzero(again), start[again], start[again] + n[again] + LENGTH - 1)]
    left = np.flatnonzero(~again)
    several = np.bincount(group[left], minlength=group[-1] + 1)[group[left]] > 1
    pick = left[several | (salts[left] > 0)]
    if len(pick):
        gone = repeats([raws[i] for i in pick], n[pick], lead[pick], group[pick])
        edge = np.diff(np.pad(gone.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        (f, a), (_, b) = np.nonzero(edge == 1), np.nonzero(edge == -1)
        begin = start[pick][f] + lead[pick][f] - (WIDE - 1)
        spans.append((pick[f], begin + a, begin + b - 1 + LENGTH))
        dealt = np.flatnonzero(salts[pick] > 0)
        if len(dealt):
            column = np.arange(WIDE)[None, :]
            far = WIDE - 1 - column
            open_ = ~gone[dealt] & (far <= lead[pick][dealt][:, None]) & (far > (lead - n)[pick][dealt][:, None])
            f, a = np.nonzero(open_)
            f = pick[dealt[f]]
            inside = lead[f] - (WIDE - 1) + a
            for k in range(0, len(f), 1 << 14):
                z = slice(k, k + (1 << 14))
                of, at = f[z], inside[z]
                digests = [xxhash.xxh3_128_digest(raws[i][p : p + LENGTH]) for i, p in zip(of.tolist(), at.tolist(), strict=True)]
                yield arrow(_SPANS, file=file[of], row=row[of], doc_id=rows.column("doc_id").combine_chunks().take(pa.array(of)), start=(start[of] + at).astype("int32"), end=(start[of] + at + LENGTH).astype("int32"), digest=digests)
    f, a, b = (np.concatenate(x) for x in zip(*spans, strict=True))
    if len(f):
        # Fragments of one text overlap: one number for each text of these groups.
        _, text = np.unique(np.stack([file[f], row[f]]), axis=1, return_inverse=True)
        text = text.ravel()
        one = np.zeros(text.max() + 1, dtype=np.int64)
        one[text] = f
        d, a, b = merged(text, a, b)
        of = one[d]
        yield arrow(_SPANS, file=file[of], row=row[of], doc_id=pa.nulls(len(of), pa.int64()), start=a.astype("int32"), end=b.astype("int32"), digest=pa.nulls(len(of), pa.binary()))


def _groups(piece: int):
    """Whole groups of about `piece` bytes at a time, from rows sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            settled = pc.less(batch.column(5), 0)
            passed = batch.filter(settled)
            if len(passed):
                end = pc.add(passed.column(3), passed.column(4))
                yield pa.RecordBatch.from_arrays([*(passed.column(i) for i in (0, 1)), pa.nulls(len(passed), pa.int64()), passed.column(3), end, pa.nulls(len(passed), pa.binary())], names=["file", "row", "doc_id", "start", "end", "digest"])
            batch = batch.filter(pc.invert(settled))
            for k in range(0, len(batch), 1024):
                part = pa.Table.from_batches([batch.slice(k, 1024)])
                held.append(part)
                size += part.column("raw").nbytes
                if size >= piece:
                    rows = pa.concat_tables(held).combine_chunks()
                    anchors, salts = rows.column("anchor").to_numpy(), rows.column("salt").to_numpy()
                    whole = int(np.flatnonzero((anchors != anchors[-1]) | (salts != salts[-1])).max(initial=-1)) + 1
                    if whole:
                        yield from _settled(rows.slice(0, whole))
                    held = [rows.slice(whole)]
                    size = held[0].column("raw").nbytes
        if held and len(rows := pa.concat_tables(held)):
            yield from _settled(rows.combine_chunks())

    return run


def _removed(keep_bytes: bool, schema: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, begin, sizes = texts_of(batch.column(1))
            body, spans = raw.tobytes(), batch.column(2)
            out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for first, size, found in zip(begin.tolist(), sizes.tolist(), spans, strict=True):
                kept, at, runs = [], 0, 0
                for a, b in sorted((s["start"], s["end"]) for s in found.as_py() or []):
                    if a > at or not runs:
                        kept.append(body[first + at : first + a])
                        runs += 1
                    at = max(at, b)
                kept.append(body[first + at : first + size])
                rest = b"".join(kept)
                for c, v in zip(out, (size, size - len(rest), runs, hashlib.sha256(rest).hexdigest(), rest if keep_bytes else None), strict=True):
                    out[c].append(v)
            made = arrow(schema, doc_id=batch.column(0), **out)
            yield made

    return run


def dedup_substrings(df: DataFrame, text: str = "text", doc_id: str = "doc_id", keep_bytes: bool = True, bounds: Bounds = Bounds()) -> DataFrame:
    """One row per row of `df`: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that stay)."""
    docs = placed(df, named(doc_id).cast("long").alias("doc_id"), named(text).alias("text"))
    # Of equal texts all but the first go as a whole, and needn't be searched.
    whole = docs.select("file", "row", "doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("digest"), F.octet_length("text").alias("end"))
    groups = cut(whole.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "file", "row")).alias("first"), F.count("*").alias("n"), F.max("end").alias("end")))
    total = groups.agg(F.sum(F.col("n") * F.col("end"))).first()[0] or 0
    firsts = groups.where((F.col("n") > 1) & (F.col("end") >= LENGTH)).select("digest", F.col("first.file").alias("of"), F.col("first.row").alias("at"))
    copies = cut(whole.join(firsts, "digest").where("file != of or row != at").select("file", "row", F.lit(0).alias("start"), "end"))

    packed = per_batch(docs, _cut_batches(max(64, -(-int(total) // bounds.route)), bounds), _PACKED).repartition("route").sortWithinPartitions("route")
    found = per_batch(packed, _candidates(bounds.hot), _FOUND)
    found = found.groupBy("file", "row").agg(F.collect_list(F.struct("start", "n", "lead", "anchor", "salt")).alias("found"))
    loaded = docs.join(found.join(copies.select("file", "row"), ["file", "row"], "left_anti"), ["file", "row"]).select("file", "row", "doc_id", "text", "found")
    grouped = per_batch(loaded, _with_bytes, _SHIPPED).repartition("anchor", "salt").sortWithinPartitions("anchor", "salt", F.col("doc_id").asc_nulls_last(), "file", "row", "start")
    spans = per_batch(grouped, _groups(bounds.piece), _SPANS)
    # Of an open window's groups all but the first lose it. A digest has a row for each of its groups at most.
    alone = [F.when(F.col("digest").isNull(), F.col(c)) for c in ("file", "row")]
    meet = Window.partitionBy("digest", *alone).orderBy(F.col("doc_id").asc_nulls_last(), "file", "row", "start")
    spans = spans.withColumn("nth", F.row_number().over(meet)).where("digest is null or nth > 1").select("file", "row", "start", "end").unionByName(copies)
    spans = spans.groupBy("file", "row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    out = docs.join(spans, ["file", "row"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    return per_batch(out, _removed(keep_bytes, schema), schema)
