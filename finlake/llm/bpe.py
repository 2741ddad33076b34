"""BPE encoding and decoding with a contiguous rank array per word.

The vocabulary file is a parameter: a JSON file of a byte-level BPE with a word-end suffix (NFC, lower case, white
space dropped). Words are cut by the file's pattern; a word's part boundaries and the ranks of its adjacent parts stand
in two arrays, which are scanned for the least rank; that boundary goes and the two neighbouring ranks are made anew.
The scan takes a word's length squared, so a word of more than LONG bytes (a text in a script without spaces is one)
keeps the same ranks in a heap instead, with the same merges in the same order.

Defined results: null is the empty text, which has no ids; special tokens inside a text keep their ids; rows are
encoded alone, so ties and repeated rows need nothing; an empty table gives no rows; a very long text is one row's work,
in time proportional to its length (times its logarithm in one long word); extra columns pass through the operator, and
those that have the name of an added one are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from finlake.llm.common import added, named

#: Words whose ids a task remembers, and the longest that it does; beyond that it starts anew.
CACHE, CACHED = 100_000, 64
#: Bytes from which a word's ranks are kept in a heap.
LONG = 256
_NONE, _ID = 1 << 60, (1 << 20) - 1


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself where printable, else the next of U+0100 onwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.vocab | self.special).items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        # Rank and id of what two parts merge to, as one number, by both parts' ids as one number.
        self.ranks = {self.vocab[a] << 20 | self.vocab[b]: r << 20 | self.vocab[a + b] for r, (a, b) in enumerate(pairs)}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # White space as the file's pattern has it: U+001C to U+001F are none.
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"))
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        letters = byte_letters()
        self.inner = [self.vocab[letters[b]] for b in range(256)]
        self.last = [self.vocab[letters[b] + self.end] for b in range(256)]
        self.byte = {x: b for b, x in letters.items()}
        self.library = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}

    def merged(self, parts: list[int]) -> list[int]:
        """The parts of a word after all merges, least rank first, of equal ranks the leftmost."""
        get = self.ranks.get
        near = [get(a << 20 | b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while near:
            least = min(near)
            if least == _NONE:
                break
            at = near.index(least)
            parts[at] = least & _ID
            del near[at], parts[at + 1]
            if at:
                near[at - 1] = get(parts[at - 1] << 20 | parts[at], _NONE)
            if at < len(near):
                near[at] = get(parts[at] << 20 | parts[at + 1], _NONE)
        return parts

    def heaped(self, parts: list[int]) -> list[int]:
        """As `merged`: boundaries are links between parts, and a heap holds (rank, place) of every adjacent pair. An
        entry whose pair has changed since is passed over."""
        get, n = self.ranks.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        near = [get(a << 20 | b, _NONE) for a, b in zip(parts, parts[1:], strict=False)] + [_NONE]
        heap = [(r, i) for i, r in enumerate(near) if r != _NONE]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            if near[at] != rank:
                continue
            gone = after[at]
            parts[at] = rank & _ID
            near[gone] = _NONE
            after[at] = after[gone]
            if after[at] < n:
                before[after[at]] = at
            for i in (before[at], at):
                if i >= 0:
                    near[i] = get(parts[i] << 20 | parts[after[i]], _NONE) if after[i] < n else _NONE
                    if near[i] != _NONE:
                        heapq.heappush(heap, (near[i], i))
        out, at = [], 0
        while at < n:
            out.append(parts[at])
            at = after[at]
        return out

    def word(self, word: str) -> bytes:
        raw, inner = word.encode("utf-8", "replace"), self.inner
        parts = [inner[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        ids = np.array(self.merged(parts) if len(parts) <= LONG else self.heaped(parts), dtype="<u4").tobytes()
        if len(word) <= CACHED:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = ids
        return ids

    def cut(self, piece: str) -> list[str]:
        """The normalised words of a text without special tokens. Scripts that newer Unicode versions add to are
        cut by the library's own tables, so that both know the same letters."""
        if piece.isascii():
            return self.words.findall(piece.lower())
        if max(piece) < "\u0530":
            return self.words.findall(unicodedata.normalize("NFC", piece).replace("\u03a3", "\u03c3").lower())
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(piece))
        return [bytes([self.byte[x] for x in w]).decode("utf-8") for w, _ in found]

    def packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        get, word = self.cache.get, self.word
        for k, piece in enumerate(self.cuts.split(text) if self.cuts else [text]):
            if k % 2:
                out.append(self.special[piece].to_bytes(4, "little"))
            else:
                out += [get(w) or word(w) for w in self.cut(piece)]
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The file has no decoder: tokens as they stand, a space between them."""
        return " ".join(map(self.names.__getitem__, ids))


def encode_texts(df: DataFrame, path: str, text: str = "text", keep_ids: bool = True) -> DataFrame:
    """`df` without its text, with ids (if wanted), n_tokens, ids_sha256 and decoded_sha256."""

    def make():
        bpe = WordBpe(path)

        def run(texts: list) -> dict[str, list]:
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for body in texts:
                raw = bpe.packed(body or "")
                ids = np.frombuffer(raw, dtype="<u4").tolist()
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(raw).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
                if keep_ids:
                    out["ids"].append(ids)
            return out

        return run

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return added(df, named(text), make, schema, drop=(text,))
