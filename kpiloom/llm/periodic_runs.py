"""Periodic stretches of words, found through Lyndon roots.

Method (Baier grouping). The first phase of Baier's suffix sorter groups the suffixes of a text
by their longest Lyndon prefix, handling groups from the highest to the lowest: a suffix whose
nearest unhandled neighbour on the left is ``j`` lengthens the prefix of ``j``. Lengths of the
groups' prefixes are the Lyndon array, with no suffix array built. The phase runs twice, for an
order of the words and for its reverse. By the runs theorem each run holds a Lyndon root that is
the longest one at its start under one of the two orders. So every (start, Lyndon length) is
extended to both sides by longest common extensions (hashes, binary search); extents that hold
the root twice are the runs. Their words are compared afterwards, so hash collisions change
nothing.

Words that cannot stand in a run are cut out before. A run of at least ``m`` and two periods
repeats, one period further, a window of (m + 1) div 2 words around each of its words. Stretches
not covered by windows that occur twice in them hold no run, whatever the text.

The work is a map over texts: no shuffle, time linear in the words.

Results of odd rows: NULL, empty and blank texts have no word and no run, and collapse to the
empty text. Repeated rows get the same result each; rows without id are treated like others. A
word that holds odd bytes is a word. Texts have any length. Ties: runs are listed by start, then
period. Extra columns pass through; one called like a result column gives way to it. An empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import prefix_sums, range_hashes, set_aside, utf8, window_hashes, without

RESULT = "starts array<bigint>, lengths array<bigint>, periods array<bigint>, n_words bigint, collapsed string"


@dataclass(frozen=True)
class Settings:
    """``min_words``: shortest stretch that counts as a run (and at least two periods)."""

    min_words: int = 12


def lyndon_lengths(text: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place; ``text`` holds the ranks 0..k-1."""
    n, letters = len(text), max(text, default=-1) + 1
    group_of = list(text)
    members: list[list[int]] = [[] for _ in range(letters)]
    for i, letter in enumerate(text):
        members[letter].append(i)
    length = [1] * letters
    below = list(range(-1, letters - 1))
    above = list(range(1, letters + 1))  # the last one points at no group
    left = list(range(-1, n - 1))
    handled = bytearray(n + 1)  # handled[-1], left of the first word, stays 0
    out = [0] * n

    group = letters - 1
    while group >= 0:
        here = [i for i in members[group] if group_of[i] == group]
        members[group] = []
        size = length[group]
        for i in here:
            handled[i] = 1
            out[i] = size
        reached: dict[int, int] = {}
        for i in here:
            j = left[i]
            while handled[j]:
                j = left[j]
            step = i
            while left[step] != j:  # shorten the way for those that follow
                left[step], step = j, left[step]
            if j >= 0:
                reached[j] = reached.get(j, 0) + 1
        if reached:
            moved: dict[tuple[int, int], list[int]] = {}
            for j, copies in reached.items():
                moved.setdefault((copies, group_of[j]), []).append(j)
            # More copies of the same prefix rank higher, so they are put in place first.
            for copies, old in sorted(moved, reverse=True):
                new = len(length)
                length.append(length[old] + copies * size)
                members.append(moved[copies, old])
                for j in members[new]:
                    group_of[j] = new
                higher = above[old]
                below.append(old)
                above.append(higher)
                above[old] = new
                below[higher] = new
        group = below[group]
    return out


def _extents(words: np.ndarray, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the widest stretch with this period around [at, at + period)."""
    n, sums = len(words), prefix_sums(words)

    def longest(most: np.ndarray, forward: bool) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            a, p, k = at[open_], period[open_], (low[open_] + high[open_] + 1) // 2
            b, e = (a, a + k) if forward else (a - k, a)
            same = range_hashes(sums, b, e) == range_hashes(sums, b + p, e + p)
            low[open_] = np.where(same, k, low[open_])
            high[open_] = np.where(same, high[open_], k - 1)

    return at - longest(at.copy(), False), at + period + longest(n - at - period, True)


def _exact_extent(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """As ``_extents`` for one place, by comparing every word; for texts that defeat the hash."""
    breaks = np.flatnonzero(words[:-period] != words[period:])
    k = int(np.searchsorted(breaks, at))
    return int(breaks[k - 1]) + 1 if k else 0, int(breaks[k]) + period if k < len(breaks) else len(words)


def _runs_of_stretch(words: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run of a stretch of word ids."""
    _, ranks = np.unique(words, return_inverse=True)
    n = len(words)
    up = np.array(lyndon_lengths(ranks.tolist()), dtype=np.int64)
    down = np.array(lyndon_lengths((ranks.max() - ranks).tolist()), dtype=np.int64)
    pairs = np.unique(np.concatenate([np.arange(n) * (n + 1) + up, np.arange(n) * (n + 1) + down]))
    at, period = pairs // (n + 1), pairs % (n + 1)
    # A root that neither neighbour continues is no run.
    padded = np.concatenate([[-1], words, [-2]])
    useful = (padded[at + 1] == padded[np.minimum(at + period, n) + 1]) | (padded[at] == padded[at + period])
    at, period = at[useful], period[useful]
    start, end = _extents(words, at, period)

    def counts(s, e, p):
        return (e - s >= 2 * p) & (e - s >= min_words)

    found: dict[tuple[int, int, int], list[int]] = {}
    for k in np.flatnonzero(counts(start, end, period)).tolist():
        found.setdefault((int(start[k]), int(end[k]), int(period[k])), []).append(int(at[k]))
    runs = set()
    for (s, e, p), places in found.items():
        if np.array_equal(words[s : e - p], words[s + p : e]):
            runs.add((s, e, p))
            continue
        for place in places:
            s, e = _exact_extent(words, place, p)
            if counts(s, e, p):
                runs.add((s, e, p))
    return sorted(runs)


def _stretches(words: np.ndarray, min_words: int, passes: int = 3) -> Iterator[tuple[int, int]]:
    """Stretches that may hold a run: every word lies in a window that occurs twice in its stretch."""
    window = (min_words + 1) // 2
    todo = [(0, len(words), passes)]
    while todo:
        first, last, left = todo.pop()
        if last - first < max(min_words, 2):
            continue
        if not left:
            yield first, last
            continue
        codes = window_hashes(words[first:last].astype(np.uint64), window)
        ordered = np.sort(codes)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            continue
        starts = np.flatnonzero(np.isin(codes, twice))
        edge = np.zeros(last - first + 1, dtype=np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + window, -1)
        covered = np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]])
        turns = np.flatnonzero(covered[1:] != covered[:-1])
        whole = len(turns) == 2 and turns[1] - turns[0] == last - first
        todo += [(first + int(a), first + int(b), 0 if whole else left - 1) for a, b in turns.reshape(-1, 2)]


def runs_of_words(words: list, min_words: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    if len(words) < max(min_words, 2):
        return []
    # The id of a word is the place where it occurs first.
    ids = np.fromiter(map({}.setdefault, words, count()), dtype=np.int64, count=len(words))
    found = [
        (first + s, e - s, p)
        for first, last in _stretches(ids, min_words)
        for s, e, p in _runs_of_stretch(ids[first:last], min_words)
    ]
    return sorted(found, key=lambda run: (run[0], run[2]))


def without_repeats(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def _searcher(settings: Settings):
    @F.pandas_udf(RESULT)
    def search(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = utf8(text).split()  # splits at space and \x09-\x0D
            runs = runs_of_words(words, settings.min_words)
            starts, lengths, periods = (list(column) for column in zip(*runs)) if runs else ([], [], [])
            collapsed = b" ".join(without_repeats(words, runs)).decode("utf-8", "surrogatepass")
            rows.append((starts, lengths, periods, len(words), collapsed))
        return pd.DataFrame(rows, columns=["starts", "lengths", "periods", "n_words", "collapsed"])

    return search


def find(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """Add ``n_words``, ``runs`` (structs of start, length, period) and ``collapsed`` (the kept words)."""
    own = without(docs, "n_words", "runs", "collapsed")
    aside = set_aside(own, text)
    found = aside.withColumn("_found", _searcher(settings)(F.col(f"`{text}`")))
    zipped = F.arrays_zip("_found.starts", "_found.lengths", "_found.periods")
    runs = F.transform(zipped, lambda r: F.struct(
        r["starts"].alias("start"), r["lengths"].alias("length"), r["periods"].alias("period")))
    return found.select(
        *aside.columns, F.col("_found.n_words").alias("n_words"), runs.alias("runs"), F.col("_found.collapsed").alias("collapsed"),
    ).toDF(*own.columns, "n_words", "runs", "collapsed")


def greatest(runs: Column) -> Column:
    """The longest run; ties go to the smallest start, then period. NULL without a run."""
    best = F.array_min(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("rest"), r["start"].alias("start"), r["period"].alias("period"))))
    return F.when(best.isNotNull(), F.struct(
        best["start"].alias("start"), (-best["rest"]).alias("length"), best["period"].alias("period")))
