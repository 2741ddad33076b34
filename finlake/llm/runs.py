"""Periodic runs of words, by Main-Lorentz divide and conquer on interned word ids, and texts with their repeats taken out.

A run is a stretch of consecutive words with smallest period q and a length of at least max(length, exponent * q) that no
neighbouring word extends with period q. A stretch is halved again and again; the runs across a midpoint have, for each period,
the period's words just before or just behind it, and Z-functions of both halves, read outwards from the midpoint, say how
far either goes on to the left and right. So every run is met whole at the first midpoint inside it. A find that a
neighbour would extend belongs to a wider stretch, and of finds with the same ends the smallest period stays.

Only stretches that can hold a run are halved: in a run each window of `window_of(...)` words occurs again in the run, a period
on or back, so where no hash of such a window comes twice there is none. Equal windows have equal hashes, so nothing is lost.

Defined results: null, empty and blank texts have no runs and collapse to the empty text; rows are judged alone, so ties and
repeated rows need nothing; an empty table gives no rows; a text of n words is one row's work, in time n log n and space n;
extra columns pass through the operator, and those that have the name of an added one are replaced.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import WORD, added, named

#: Least words of a run, and least multiple of its period.
LENGTH, EXPONENT = 24, 3
#: Passes that narrow stretches down before they are halved.
NARROW = 4
_WORDS = re.compile(WORD)
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
ADDED = f"n_words long, runs {RUNS}, collapsed string"

Run = tuple[int, int, int]


def window_of(length: int, exponent: int) -> int:
    """How many words a window may have so that each window of a run occurs in it a period on or back."""
    return min(max(length, exponent * q) - 2 * q + 1 for q in range(1, length + 1))


def z_function(s: list[int], upto: int) -> list[int]:
    """For each place before `upto` how many words from there on are those that `s` begins with."""
    n, z, left, right = len(s), [0] * upto, 0, 0
    for i in range(1, upto):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


def crossing(u: list[int], v: list[int], length: int, exponent: int) -> list[Run]:
    """The repetitions in u + v that have a whole period on one side of the midpoint, as far as they go in u + v: start,
    end and period."""
    n, m = len(u), len(v)
    most = min((n + m) // exponent, n, m)
    behind = z_function([*v, -1, *u[n - most :], *v], m + 1 + most)
    back = u[::-1]
    ahead = z_function([*back, -1, *v[:most][::-1], *back], n + 1 + most)
    found = []
    for p in range(1, most + 1):
        least = max(length, exponent * p) - p
        # The period's words stand just before the midpoint, or just behind it.
        before, after = (ahead[p] if p < n else 0), behind[m + 1 + most - p]
        if before + after >= least:
            found.append((n - p - before, n + after, p))
        before, after = ahead[n + 1 + most - p], (behind[p] if p < m else 0)
        if before + after >= least:
            found.append((n - before, n + p + after, p))
    return found


def narrowed(ids: np.ndarray, start: int, window: int) -> list[tuple[int, int]]:
    """The stretches (start, end) of `ids`, which begins at word `start`, that can hold a run."""
    todo, done = [(0, len(ids), NARROW)], []
    keys = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    keys ^= keys >> np.uint64(32)
    hashes = np.zeros(max(0, len(ids) - window + 1), np.uint64)
    for k in range(window):
        hashes = hashes * np.uint64(0x94D049BB133111EB) + keys[k : k + len(hashes)]
    while todo:
        a, b, left = todo.pop()
        mine = hashes[a : b - window + 1]
        order = np.argsort(mine)
        same = mine[order[1:]] == mine[order[:-1]]
        twice = np.zeros(len(mine) + 2, np.int8)
        twice[order[1:][same] + 1] = twice[order[:-1][same] + 1] = 1
        edges = np.flatnonzero(np.diff(twice))
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            x, y = a + i, a + j + window - 1
            if left and y - x < b - a:
                todo.append((x, y, left - 1))
            else:
                done.append((start + x, start + y))
    return done


def runs_of(words: list[str], length: int = LENGTH, exponent: int = EXPONENT) -> list[Run]:
    """(start, length, period) of all runs, by start and then period."""
    if len(words) < length:
        return []
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return runs_of_ids(np.fromiter(map(known.__getitem__, words), np.int64, len(words)), length, exponent)


def runs_of_ids(ids: np.ndarray, length: int = LENGTH, exponent: int = EXPONENT) -> list[Run]:
    length = max(length, exponent)
    if len(ids) < length:
        return []
    found: dict[tuple[int, int], int] = {}
    all_words: list[int] | None = None
    todo = [x for x in narrowed(ids, 0, window_of(length, exponent)) if x[1] - x[0] >= length]
    while todo:
        a, b = todo.pop()
        if all_words is None:
            all_words = ids.tolist()
        mid = (a + b) // 2
        for s, e, p in crossing(all_words[a:mid], all_words[mid:b], length, exponent):
            s, e = s + a, e + a
            # What goes on beyond this stretch is met whole in a wider one.
            if (s == a and s > 0 and all_words[s - 1] == all_words[s - 1 + p]) or (e == b and e < len(all_words) and all_words[e] == all_words[e - p]):
                continue
            if p < found.get((s, e), p + 1):
                found[s, e] = p
        todo += [(x, y) for x, y in ((a, mid), (mid, b)) if y - x >= length]
    return sorted((s, e - s, p) for (s, e), p in found.items())


def collapsed(words: list[str], runs: list[Run]) -> str:
    """The words without those that a run holds after its first period."""
    if not runs:
        return " ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for s, n, p in runs:
        edge[s + p] += 1
        edge[s + n] -= 1
    return " ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def mark_runs(df: DataFrame, text: str = "text", length: int = LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """`df` without its text, with n_words, runs and collapsed, the text's words without repeats, joined by a space."""
    if exponent < 3:
        raise ValueError("runs have at least three periods")

    def make():
        def run(texts: list) -> dict[str, list]:
            out: dict[str, list] = {"n_words": [], "runs": [], "collapsed": []}
            for body in texts:
                words = _WORDS.findall(body or "")
                runs = runs_of(words, length, exponent)
                out["n_words"].append(len(words))
                out["runs"].append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                out["collapsed"].append(collapsed(words, runs))
            return out

        return run

    return added(df, named(text), make, ADDED, drop=(text,))


def best_run(runs: Column) -> Column:
    """Of a text's runs the one with the greatest length / period, then the least start, then the least period; null if none."""
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    return F.reduce(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)), lambda best, r: F.when(more(r, best), r).otherwise(best))


def run_list(runs: Column) -> Column:
    """`start,length,period` and a line feed for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
