"""Byte-level BPE encoding and decoding in two tiers.

The vocabulary file is a parameter: one line a token, its bytes in base 64 and its rank, which is its id. Texts are cut by a
pattern; the pieces are all the text. Tier one: a minimal perfect hash has a slot for every token and none besides; all pieces
of some texts are hashed and compared with the tokens in their slots at once, eight bytes at a time, and a piece that is a
token is done. Tier two: any other piece is a chain of linked bytes, and a heap gives the adjacent parts whose join has the
least rank, of equal ranks the leftmost, until no join is a token. The hash answers both tiers; there is no other vocabulary.

Defined results: null is the empty text, which has no ids; there are no special tokens, their strings are ordinary text; rows
are encoded alone, so ties and repeated rows need nothing; an empty table gives no rows; a very long text is one row's work,
a piece of it of m bytes takes time m log m; extra columns pass through the operator, and those that have the name of an added
one are replaced.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import regex
import tiktoken
from pyspark.sql import DataFrame

from finlake.llm.common import added, named

#: Pieces of tier two, and joins of parts, that a worker remembers, and the longest piece that it does.
CACHE, CACHED = 600_000, 64
#: Characters of texts that are encoded at once; pieces that are looked up at once.
GROUP, PIECES = 1 << 20, 1 << 18
_MASK, _PLACE = (1 << 64) - 1, (1 << 32) - 1
#: The finalizer of a public 64-bit hash (MurmurHash3), and an odd constant that sets displacements apart.
_M1, _M2, _STEP = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9E3779B97F4A7C15
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(_M1)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(_M2)
    return x ^ (x >> np.uint64(33))


def mixed_one(x: int) -> int:
    x = (x ^ x >> 33) * _M1 & _MASK
    x = (x ^ x >> 33) * _M2 & _MASK
    return x ^ x >> 33


class PerfectHash:
    """A minimal perfect hash of different, non-empty byte strings: n of them, at least one, have the slots 0 to n - 1, one each.

    Buckets of keys, the largest first, each get the least displacement under which all their keys fall into free slots;
    a bucket of one key gets a free slot outright, written as a negative displacement, so that no slot stays empty."""

    def __init__(self, keys: list[bytes]):
        self.keys, n = keys, len(keys)
        self.chunks = -(-max(map(len, keys), default=1) // 8)
        sizes = np.fromiter(map(len, keys), np.int64, n)
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(keys) + bytes(8 * self.chunks + 8), np.uint8)
        for self.seed in range(64):
            hashes = self._hashes(data, starts, sizes)
            if len(np.unique(hashes)) == n:
                break
        else:
            raise ValueError("a token stands twice in the vocabulary")
        self.n, self.buckets = n, max(1, n // 2)
        self.displaced = np.zeros(self.buckets, np.int64)
        self.ids = self._settle(hashes)
        self.sizes = sizes[self.ids]
        words = self._words(data)
        self.parts = []
        for k in range(self.chunks):
            left = np.clip(sizes - 8 * k, 0, 8)
            at = np.where(left > 0, starts + 8 * k, 0)
            self.parts.append((words[at] & _LOW[left])[self.ids])
        self._one = (self.displaced.tolist(), self.ids.tolist())

    @staticmethod
    def _words(data: np.ndarray) -> np.ndarray:
        """The eight bytes from each place on, as a number, without a copy."""
        return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))

    def _hashes(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        words = self._words(data)
        found = mixed((sizes + (self.seed << 32)).astype(np.uint64) ^ (words[starts] & _LOW[np.minimum(sizes, 8)]))
        for k in range(1, self.chunks):
            more = np.flatnonzero(sizes > 8 * k)
            if not len(more):
                break
            found[more] = mixed(found[more] ^ (words[starts[more] + 8 * k] & _LOW[np.minimum(sizes[more] - 8 * k, 8)]))
        return found

    def _settle(self, hashes: np.ndarray) -> np.ndarray:
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self.buckets)
        first = np.cumsum(counts) - counts
        ids, n = np.full(self.n, -1, np.int64), np.uint64(self.n)
        free = np.ones(self.n, bool)
        tries = np.arange(1, 65, dtype=np.uint64) * np.uint64(_STEP)
        for b in np.argsort(-counts, kind="stable")[: np.count_nonzero(counts > 1)]:
            keys = order[first[b] : first[b] + counts[b]]
            base = 0
            while True:
                slots = (mixed(hashes[keys][:, None] + (tries + np.uint64(base * _STEP & _MASK))[None, :]) % n).astype(np.int64)
                good = free[slots].all(axis=0)
                ranked = np.sort(slots, axis=0)
                good &= (ranked[1:] != ranked[:-1]).all(axis=0)
                if good.any():
                    at = int(good.argmax())
                    self.displaced[b] = base + at + 1
                    ids[slots[:, at]], free[slots[:, at]] = keys, False
                    break
                base += len(tries)
        single = np.flatnonzero(counts == 1)
        slots = np.flatnonzero(free)
        ids[slots] = order[first[single]]
        self.displaced[single] = -slots - 1
        return ids

    def find(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The numbers of the keys that stand in `data` at `starts`, -1 where none does. `data` goes on for 8 * (chunks + 1)
        bytes after the last."""
        hashes = self._hashes(data, starts, sizes)
        moved = self.displaced[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        slots = (mixed(hashes + moved.astype(np.uint64) * np.uint64(_STEP)) % np.uint64(self.n)).astype(np.int64)
        slots = np.where(moved < 0, -moved - 1, slots)
        same, words = self.sizes[slots] == sizes, self._words(data)
        for k in range(self.chunks):
            more = np.flatnonzero(same & (sizes > 8 * k))
            if not len(more):
                break
            same[more] = self.parts[k][slots[more]] == words[starts[more] + 8 * k] & _LOW[np.minimum(sizes[more] - 8 * k, 8)]
        return np.where(same, self.ids[slots], -1)

    def get(self, key: bytes) -> int:
        """The number of one key, or -1."""
        found = mixed_one(len(key) + (self.seed << 32) ^ int.from_bytes(key[:8], "little"))
        for k in range(8, min(len(key), 8 * self.chunks), 8):
            found = mixed_one(found ^ int.from_bytes(key[k : k + 8], "little"))
        moved, ids = self._one
        at = moved[found % self.buckets]
        at = ids[-at - 1 if at < 0 else mixed_one(found + at * _STEP & _MASK) % self.n]
        return at if self.keys[at] == key else -1


class Joins(dict):
    """What the hash said of byte strings: the number shifted by 32 bits, or -1."""

    def __init__(self, perfect: PerfectHash):
        self.perfect = perfect

    def __missing__(self, raw: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        found = self.perfect.get(raw)
        self[raw] = found = found << 32 if found >= 0 else -1
        return found


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = sorted((int(b), base64.b64decode(a)) for a, b in map(bytes.split, f))
        self.numbers = np.array([r for r, _ in ranks], np.int64)
        self.hash = PerfectHash([t for _, t in ranks])
        self.tokens = dict(ranks)
        if ranks[-1][0] < 2 * len(ranks):  # a list is quicker
            self.tokens = [self.tokens.get(i, b"") for i in range(ranks[-1][0] + 1)]
        self.pattern_text, self.pattern = pattern, regex.compile(pattern)
        # The hash's answers at hand: single bytes, joins of two, and longer ones as they are asked for.
        both = np.frombuffer(b"".join(bytes([a, b]) for a in range(256) for b in range(256)) + bytes(8 * self.hash.chunks + 8), np.uint8)
        pairs = self.hash.find(both, np.arange(0, 1 << 17, 2), np.full(1 << 16, 2, np.int64))
        self.pairs: list[int] = np.where(pairs < 0, -1, pairs << 32).tolist()
        self.bytes = [self.hash.get(bytes([b])) for b in range(256)]
        if -1 in self.bytes:
            raise ValueError("the vocabulary lacks a byte")
        self.joins = Joins(self.hash)
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    @functools.cached_property
    def newer(self) -> regex.Pattern:
        """Letters and numbers that the pattern's tables know but the library's don't yet: it is asked whether they stand in
        one piece with another letter or number. Only characters beyond this Python's Unicode version can be such."""
        every = "".join(chr(c) for c in range(0x530, 0x110000) if not 0xD800 <= c < 0xE000)
        odd = []
        for lead, kind in (("a", r"\p{L}"), ("1", r"\p{N}")):
            chars = [c for c in regex.findall(kind, every) if unicodedata.category(c) == "Cn"]
            ranks = {bytes([b]): b for b in range(256)}
            for raw in ((lead + c).encode() for c in chars):
                for k in range(2, len(raw) + 1):
                    ranks.setdefault(raw[:k], len(ranks))
            library = tiktoken.Encoding("asked", pat_str=self.pattern_text, mergeable_ranks=ranks, special_tokens={})
            odd += [c for c in chars if len(library.encode_ordinary(lead + c)) > 1]
        return regex.compile("[" + "".join(map(regex.escape, odd)) + "]" if odd else r"(?!)")

    def ends(self, text: str) -> np.ndarray:
        """Where the pieces of a text end, in characters."""
        if not text.isascii() and max(text) >= "\u0530":
            text = self.newer.sub("\ue000", text)  # in no class, as the library has them
        if len(text) > GROUP:
            return np.fromiter((m.end() for m in self.pattern.finditer(text)), np.int64)
        found = self.pattern.findall(text)
        return np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))

    def merged(self, raw: bytes) -> list[int]:
        """The parts of a piece after all merges: part i reaches from byte i to after[i], and the heap holds rank and place (as
        one number) of the join of each part and the next. An entry whose join has changed since is passed over."""
        joins, pairs, n, push, pop = self.joins, self.pairs, len(raw), heapq.heappush, heapq.heappop
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        near = [r + i if (r := pairs[a << 8 | b]) >= 0 else -1 for i, (a, b) in enumerate(zip(raw, raw[1:], strict=False))]
        heap = [e for e in near if e >= 0]
        heapq.heapify(heap)
        near.append(-1)
        ids = [self.bytes[b] for b in raw]
        while heap:
            entry = pop(heap)
            at = entry & _PLACE
            if near[at] != entry:
                continue
            ids[at] = entry >> 32
            gone = after[at]
            after[at] = end = after[gone]
            near[gone] = near[at] = -1
            if end < n:
                before[end] = at
                rank = joins[raw[at : after[end]]]
                if rank >= 0:
                    near[at] = rank = rank + at
                    push(heap, rank)
            left = before[at]
            if left >= 0:
                near[left] = rank = joins[raw[left:end]]
                if rank >= 0:
                    near[left] = rank = rank + left
                    push(heap, rank)
        out, at = [], 0
        while at < n:
            out.append(ids[at])
            at = after[at]
        return out

    def missed(self, raw: bytes) -> bytes:
        """The numbers of a piece's parts, as 32-bit integers. What was met lately stays at hand when the memory is full."""
        found = self.older.get(raw) or np.array(self.merged(raw), "<u4").tobytes()
        if len(raw) <= CACHED:
            if len(self.cache) >= CACHE // 2:
                self.older, self.cache = self.cache, {}
            self.cache[raw] = found
        return found

    def _looked_up(self, padded: bytes, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of pieces, and how many each has."""
        found = self.hash.find(data, starts, ends - starts)
        counts = np.ones(len(found), np.int64)
        out = np.flatnonzero(found < 0)
        if not len(out):
            return found, counts
        missed, parts = self.missed, []
        for a, b in zip(starts[out].tolist(), ends[out].tolist(), strict=True):
            word = padded[a:b]
            parts.append(self.cache.get(word) or missed(word))
        counts[out] = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        of_missed = np.repeat(found < 0, counts)
        every = np.empty(len(of_missed), np.int64)
        every[~of_missed] = found[found >= 0]
        every[of_missed] = np.frombuffer(b"".join(parts), "<u4")
        return every, counts

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, all looked up together."""
        raw = "".join(texts).encode()
        padded = raw + bytes(8 * self.hash.chunks + 8)
        data = np.frombuffer(padded, np.uint8)
        pieces = [self.ends(t) for t in texts]
        n_pieces = np.fromiter(map(len, pieces), np.int64, len(pieces))
        shift = np.cumsum([0, *map(len, texts)])[:-1]
        ends = np.concatenate([p + s for p, s in zip(pieces, shift, strict=True)]) if pieces else np.empty(0, np.int64)
        if len(raw) != sum(map(len, texts)):  # from characters to bytes
            begins = np.append(np.flatnonzero((data[: len(raw)] & 0xC0) != 0x80), len(raw))
            ends = begins[ends]
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        found = [self._looked_up(padded, data, starts[k : k + PIECES], ends[k : k + PIECES]) for k in range(0, len(ends), PIECES)]
        if not found:
            return [np.empty(0, np.int64) for _ in texts]
        ids = self.numbers[np.concatenate([f for f, _ in found])]
        before = np.concatenate([[0], np.cumsum(np.concatenate([c for _, c in found]))])
        bounds = before[np.cumsum(n_pieces)]
        return np.split(ids, bounds[:-1])

    def groups(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; so many texts at once as GROUP characters hold."""
        held, size = [], 0
        for text in texts:
            if held and size + len(text) > GROUP:
                yield from self.encoded(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        yield from self.encoded(held)

    def encode(self, text: str) -> list[int]:
        return self.encoded([text])[0].tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> ByteBpe:
    """One a worker process, which outlives its tasks."""
    return ByteBpe(path, pattern)


def encode_texts(df: DataFrame, path: str, pattern: str, text: str = "text", keep_ids: bool = True) -> DataFrame:
    """`df` without its text, with ids (if wanted), n_tokens, ids_sha256 and decoded_sha256."""

    def make():
        bpe = vocabulary(path, pattern)

        def run(texts: list) -> dict[str, list]:
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for ids in bpe.groups([t or "" for t in texts]):
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids.tolist())).hexdigest())
                if keep_ids:
                    out["ids"].append(ids)
            return out

        return run

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return added(df, named(text), make, schema, drop=(text,))
