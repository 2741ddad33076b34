"""Language identification with a linear-chain conditional random field over words.

Affix, character n-gram and lexicon features score each word for each language; learned transitions tie neighbouring
words, so that code-switched text is labelled word by word. Forward-backward gives each word's posteriors; a text's
language is the one with the most posterior mass over its letters, and its score is that share.

The model is fitted on a bounded sample: about SAMPLE rows a language, CHUNKS pieces of CHUNK words of each, spread over
the whole text. A share MIXED of the pieces is joined with one of another language, so that the transitions between
languages are learned from texts that have them. Prediction reads whole texts: a text is cut into runs of RUN words,
whose products of transfer matrices carry the messages from run to run, so a very long text takes no more steps than
a short one and a worker holds its words' scores only.

Defined results: a null text, or one without a letter, is `und` with score 0, as are all texts when nothing can be
learned (an empty table, no label); rows are predicted alone, so ties and repeated rows need nothing; of languages with
equal mass the first by name is predicted; rows with a null id are never held out and may be learned from; extra columns
pass through; columns that have the name of an added one are replaced.
"""

from __future__ import annotations

from collections import Counter
from itertools import islice

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import added, named

UNKNOWN = "und"
#: The sample: rows of a language, pieces of a row, and words of a piece.
SAMPLE, CHUNKS, CHUNK = 200, 6, 60
PASSES, BATCH, RATE, DECAY, MIXED = 3, 256, 0.2, 1e-5, 0.1
#: Words whose scores a task remembers, words scored in one go, words of a run, characters of a long text, and numbers (a
#: word's for each label) worked on in one go.
CACHE, AT_ONCE, RUN, LONG, CELLS = 200_000, 200_000, 256, 1 << 20, 1 << 20
#: Letters by category: fractions and Roman numerals are word characters, but no letters.
_LETTERS = regex.compile(r"\p{L}+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def features(word: str) -> list[str]:
    """Affixes of 1 to 3 letters, 2- and 3-grams with the word's edges, and the word for the lexicon."""
    edged = f"<{word}>"
    n = len(word)
    out = ["=" + word]
    out += [edged[: k + 1] for k in range(1, 4) if k <= n]
    out += [edged[-k - 1 :] for k in range(1, 4) if k <= n]
    out += [edged[i : i + 2] for i in range(1, n)]
    out += [edged[i : i + 3] for i in range(1, n - 1)]
    return out


class Crf:
    """labels, index of features, weights (feature x label) and transitions (label x label)."""

    def __init__(self, labels: list[str], index: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.labels, self.index, self.weights, self.moves = labels, index, weights, moves
        self.known: dict[str, int] = {}
        self.scores = np.zeros((1024, len(labels)))

    def __getstate__(self) -> tuple:
        return self.labels, self.index, self.weights, self.moves

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def rows(self, words: list[str]) -> np.ndarray:
        """Each word's row in `scores`, which grows by the words that are new."""
        known = self.known
        new = list(dict.fromkeys(w for w in words if w not in known))
        if len(known) + len(new) > CACHE and known:
            known.clear()
            return self.rows(words)
        if new:
            get = self.index.get
            each = [[i for f in features(w) if (i := get(f)) is not None] or [0] for w in new]
            size = np.fromiter(map(len, each), "int64", len(each))
            flat = self.weights[np.fromiter((i for x in each for i in x), "int64", int(size.sum()))]
            a, b = len(known), len(known) + len(new)
            if b > len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros((max(b, 2 * len(self.scores)) - len(self.scores), len(self.labels)))])
            self.scores[a:b] = np.add.reduceat(flat, np.cumsum(size) - size, axis=0) / np.sqrt(size)[:, None]
            known.update(zip(new, range(a, b), strict=True))
        return np.fromiter(map(known.__getitem__, words), "int64", len(words))

    def scored(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores and lengths of words, in order."""
        rows = self.rows(words)  # may replace the scores
        return self.scores[rows].astype("float32"), np.fromiter(map(len, words), "int32", len(words))

    def posteriors(self, scores: np.ndarray, sizes: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Forward-backward over chains that lie one after another in `scores`; sizes descend. first and last: what
        comes to each chain from the words before and after it (by its labels), where it is a run of a longer one."""
        emit = np.exp(scores - scores.max(axis=1, keepdims=True))
        moves = np.exp(self.moves - self.moves.max())
        starts = np.cumsum(sizes) - sizes
        ahead = np.empty_like(emit)
        active = np.searchsorted(-sizes, -np.arange(sizes[0]) - 1, "right")  # chains longer than t
        now = None
        for t, n in enumerate(active):
            at = starts[:n] + t
            now = (emit[at] if first is None else first * emit[at]) if now is None else (now[:n] @ moves) * emit[at]
            now = now / now.sum(axis=1, keepdims=True)
            ahead[at] = now
        back = np.ones((len(sizes), emit.shape[1])) if last is None else last.copy()
        ends = starts + sizes - 1
        ahead[ends] *= back
        for t in range(int(sizes[0]) - 2, -1, -1):
            n = active[t + 1]
            at = starts[:n] + t
            b = (back[:n] * emit[at + 1]) @ moves.T
            back[:n] = b / b.sum(axis=1, keepdims=True)
            ahead[at] *= back[:n]
        return ahead / ahead.sum(axis=1, keepdims=True)

    def through(self, runs: list[np.ndarray], begins: np.ndarray) -> np.ndarray:
        """Each run's product of transfers, from the label before it to its last; sizes descend. A run that `begins` a chain
        has no label before it, and its rows are those of its first word."""
        k, sizes = len(self.labels), np.array([len(x) for x in runs])
        scores = np.concatenate(runs).astype("float64")
        emit = np.exp(scores - scores.max(axis=1, keepdims=True))
        moves, starts = np.exp(self.moves - self.moves.max()), np.cumsum(sizes) - sizes
        out = np.where(begins[:, None, None], np.eye(k), moves)
        for t in range(int(sizes[0])):
            n = int(np.searchsorted(-sizes, -t, "left"))
            step = (out[:n] @ moves if t else out) * emit[starts[:n] + t][:, None, :]
            out[:n] = step / step.sum(axis=(1, 2), keepdims=True)
        return out

    def masses(self, found: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """Posterior mass over the letters by label, of each text with words, from its words' scores and lengths."""
        k = len(self.labels)
        run = max(RUN, 16 * k)  # a run's product is k x k: with many labels, runs are longer
        step = max(1, CELLS // (run * k))
        moves = np.exp(self.moves - self.moves.max())
        runs = [(len(scores[a : a + run]), i, a, len(scores) > run) for i, (scores, _) in enumerate(found) for a in range(0, len(scores), run)]
        runs.sort(key=lambda x: (-x[0], x[1], x[2]))
        first, last = {}, {}
        many, moved = [x for x in runs if x[3]], {}
        for a in range(0, len(many), step):
            now = many[a : a + step]
            for (_, i, at, _), m in zip(now, self.through([found[i][0][at : at + n] for n, i, at, _ in now], np.array([at == 0 for _, _, at, _ in now])), strict=True):
                moved[i, at] = m
        for i in {x[1] for x in many}:
            places = range(0, len(found[i][0]), run)
            now = back = np.ones(k)
            for at in places[:-1]:
                now = now @ moved[i, at]
                now = now / now.sum()
                first[i, at + run] = now @ moves
            for at in places[:0:-1]:
                back = moved[i, at] @ back
                back = back / back.sum()
                last[i, at - run] = back
        out, ones = [np.zeros(k) for _ in found], np.ones(k)
        for a in range(0, len(runs), step):
            now = runs[a : a + step]
            sizes = np.array([x[0] for x in now])
            scores = np.concatenate([found[i][0][at : at + n] for n, i, at, _ in now]).astype("float64")
            weight = np.concatenate([found[i][1][at : at + n] for n, i, at, _ in now])
            ends = [np.array([messages.get((i, at), ones) for _, i, at, _ in now]) for messages in (first, last)]
            post = self.posteriors(scores, sizes, *ends)
            for (_, i, _, _), m in zip(now, np.add.reduceat(post * weight[:, None], np.cumsum(sizes) - sizes, axis=0), strict=True):
                out[i] += m
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        out, held = [(UNKNOWN, 0.0)] * len(texts), []

        def settle(found: list[tuple[int, tuple[np.ndarray, np.ndarray]]]) -> None:
            for (i, _), m in zip(found, self.masses([x for _, x in found]), strict=True):
                out[i] = (self.labels[int(m.argmax())], float(min(1.0, m.max() / m.sum())))

        def settle_held() -> None:
            scores, sizes = self.scored([w for _, words in held for w in words])
            ends = np.cumsum([len(words) for _, words in held])
            settle([(i, (scores[b - len(words) : b], sizes[b - len(words) : b])) for (i, words), b in zip(held, ends.tolist(), strict=True)])
            held.clear()

        total = 0
        for i, text in enumerate(texts):
            if len(text) > LONG:  # its words are never held all at once
                words, parts = (m[0] for m in _LETTERS.finditer(text.lower())), []
                while part := list(islice(words, AT_ONCE)):
                    parts.append(self.scored(part))
                if parts:
                    settle([(i, (np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])))])
                continue
            if words := _LETTERS.findall(text.lower()):
                held.append((i, words))
                total += len(words)
            if total >= AT_ONCE:
                settle_held()
                total = 0
        if held:
            settle_held()
        return out


def fit(rows: list[tuple[str, str]], seed: int = 7, pieces: int = CHUNKS) -> Crf | None:
    """A CRF from `pieces` pieces of each of (text, language) rows, by AdaGrad on the chains' log-likelihood; None if there is nothing to learn."""
    labels = sorted({lang for _, lang in rows})
    chains: list[tuple[list[int], list[str]]] = []
    for text, lang in rows:
        words = _LETTERS.findall(text.lower())
        starts = np.unique(np.linspace(0, max(0, len(words) - CHUNK), pieces).astype(int)) if words else []
        for a in starts:
            words_of = words[a : a + CHUNK]
            chains.append(([labels.index(lang)] * len(words_of), words_of))
    if not chains:
        return None
    rng = np.random.default_rng(seed)
    # Code-switched chains: halves of two chains of different languages.
    for i, j in rng.integers(0, len(chains), (int(MIXED * len(chains)) if len(labels) > 1 else 0, 2)).tolist():
        (y, a), (z, b) = chains[i], chains[j]
        if y[0] != z[0]:
            m, n = (len(a) + 1) // 2, len(b) // 2
            chains.append((y[:m] + z[n:], a[:m] + b[n:]))
    seen = Counter(f for _, words in chains for w in set(words) for f in features(w))
    index = {"": 0} | {f: i for i, f in enumerate((f for f, n in sorted(seen.items()) if n > 1), 1)}
    types = sorted({w for _, words in chains for w in words})
    place = {w: i for i, w in enumerate(types)}
    each = [[i for f in features(w) if (i := index.get(f)) is not None] or [0] for w in types]
    size = np.array([len(x) for x in each])
    first = np.cumsum(size) - size
    flat = np.concatenate([np.array(x) for x in each])
    n_labels = len(labels)
    weights, moves = np.zeros((len(index), n_labels)), np.zeros((n_labels, n_labels))
    sums, move_sums = np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)
    for _ in range(PASSES):
        order = rng.permutation(len(chains))
        for a in range(0, len(order), BATCH):
            batch = sorted((chains[i] for i in order[a : a + BATCH]), key=lambda x: -len(x[1]))
            sizes = np.array([len(w) for _, w in batch])
            gold = np.array([y for each_y, _ in batch for y in each_y])
            which, row = np.unique(np.array([place[w] for _, words in batch for w in words]), return_inverse=True)
            parts = np.concatenate([np.arange(first[i], first[i] + size[i]) for i in which])
            norm = np.sqrt(size[which])[:, None]
            emit = np.add.reduceat(weights[flat[parts]], np.cumsum(size[which]) - size[which], axis=0) / norm
            model = Crf(labels, index, weights, moves)
            miss = -model.posteriors(emit[row], sizes)
            here, there = _pairs(emit[row], moves, sizes)
            miss[np.arange(len(gold)), gold] += 1
            by_type = np.zeros_like(emit)
            np.add.at(by_type, row, miss)
            grad = np.zeros_like(weights)
            np.add.at(grad, flat[parts], np.repeat(by_type / norm, size[which], axis=0))
            grad = grad / len(gold) * 100 - DECAY * weights
            sums += grad**2
            weights = weights + RATE * grad / np.sqrt(sums)
            same = np.zeros_like(moves)
            inner = np.ones(len(gold) - 1, dtype=bool)
            inner[np.cumsum(sizes)[:-1] - 1] = False
            np.add.at(same, (gold[:-1][inner], gold[1:][inner]), 1)
            move_grad = (same - here) / max(1, there) - 0.01 * moves
            move_sums += move_grad**2
            moves = moves + 0.05 * move_grad / np.sqrt(move_sums)
    return Crf(labels, index, weights, moves)


def _pairs(scores: np.ndarray, moves: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, int]:
    """Expected transitions over all chains, and how many there are."""
    emit, step = np.exp(scores - scores.max(axis=1, keepdims=True)), np.exp(moves - moves.max())
    starts, total = np.cumsum(sizes) - sizes, np.zeros_like(moves)
    ahead, back = np.empty_like(emit), np.ones_like(emit)
    for t in range(int(sizes[0])):
        at = starts[sizes > t] + t
        now = emit[at] if t == 0 else (ahead[at - 1] @ step) * emit[at]
        ahead[at] = now / now.sum(axis=1, keepdims=True)
    for t in range(int(sizes[0]) - 2, -1, -1):
        at = starts[sizes > t + 1] + t
        b = (back[at + 1] * emit[at + 1]) @ step.T
        back[at] = b / b.sum(axis=1, keepdims=True)
        both = ahead[at][:, :, None] * step[None] * (emit[at + 1] * back[at + 1])[:, None, :]
        total += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return total, int((sizes - 1).sum())


def train(df: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE, labels: int | None = None) -> Crf | None:
    """A CRF from about `sample` rows of each language (of the `labels` commonest, if given), chosen by a hash of their id and text among
    rows that aren't held out; repeated rows are one. Of each, CHUNKS pieces spread over the text come to the driver."""
    body = named(text)
    usable = df.where(~held_out(named(doc_id)) & named(lang).isNotNull() & body.isNotNull())
    counts = usable.groupBy(named(lang).alias("lang")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    counts = (counts if labels is None else counts.limit(labels)).collect()  # one row a language
    if not counts:
        return None
    share = F.element_at(F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, sample / r["n"])))]), named(lang))
    place = F.pmod(F.xxhash64(named(doc_id).cast("string"), body, F.lit("sample")), F.lit(1 << 30))
    letters = 16 * CHUNK  # more than CHUNK words take
    last = F.greatest(F.length(body) - letters, F.lit(0))
    starts = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(CHUNKS - 1)), lambda k: (last * k / max(1, CHUNKS - 1)).cast("int")))
    pieces = F.transform(starts, lambda a: F.substr(body, a + 1, F.lit(letters)))
    chosen = usable.where(place / float(1 << 30) < share).select(named(lang).alias("lang"), place.alias("place"), pieces.alias("pieces")).dropDuplicates(["lang", "place"])
    rows = []
    for r in chosen.select("lang", "pieces").collect():
        # A piece from inside a text may begin inside a word.
        rows += [(x if k == 0 else x.partition(" ")[2] or x, r["lang"]) for k, x in enumerate(r["pieces"])]
    return fit(sorted(rows), pieces=1)


def predict(df: DataFrame, model: Crf | None, text: str = "text") -> DataFrame:
    """`df` with lang_pred and score."""

    def make():
        def run(texts: list) -> dict[str, list]:
            made = model.predict([x or "" for x in texts]) if model else [(UNKNOWN, 0.0)] * len(texts)
            return {"lang_pred": [x for x, _ in made], "score": [x for _, x in made]}

        return run

    return added(df, named(text), make, "lang_pred string, score double")
