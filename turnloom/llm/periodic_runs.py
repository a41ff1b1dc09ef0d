"""Periodic stretches of words, found by catching squares online.

Words are appended block by block to `RunCatcher`. Every completed block of 2^k words, at a
multiple of 2^k, is a catcher for periods from 2^k up to 2^(k+1) - 1 (blocks of the smallest
size also for all shorter periods): it catches where its words come again at such a distance.
Of the suffixes, the catcher of a level that a new word can meet is the block before, so one
comparison of window names per word and level finds all catches. A catch at distance q is
extended word by word to the left; to the right, every appended word advances the comparison
until two words differ. A stretch of n words that equal those q later holds the squares of
half-length q that start there once n >= q, and all of them merge into one run of n + q words.

A run of at least three periods holds a whole aligned block of its level in its first two
periods, so none is missed. Multiples of the period of a known stretch are skipped inside it,
so a text of one repeated word costs as little as any other.

Window names are 64-bit mixes made by doubling; every catch is confirmed on the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, crc32_of, pieces, text_or_empty

MIN_WORDS = 24
MIN_PERIODS = 3
APPEND_WORDS = 1 << 14
BATCH_BYTES = 4 << 20

# The smallest block: a run of MIN_WORDS or more words with a period below it holds one whole.
FIRST_LEVEL = 3
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    name = left * _LEFT + right * _RIGHT
    return name ^ (name >> np.uint64(29))


def _equal_ahead(words: np.ndarray, begin: int, period: int) -> int:
    """First position from `begin` whose word differs from the one `period` later, or the last comparable."""
    end, step = len(words) - period, 64
    while begin < end:
        stop = min(end, begin + step)
        differs = words[begin:stop] != words[begin + period : stop + period]
        first = int(differs.argmax())
        if differs[first]:
            return begin + first
        begin, step = stop, step * 2
    return max(begin, end)


def _equal_back(words: np.ndarray, begin: int, period: int) -> int:
    """Smallest position down from `begin` from which all words equal those `period` later."""
    step = 64
    while begin > 0:
        stop = max(0, begin - step)
        differs = words[stop:begin] != words[stop + period : begin + period]
        if differs.any():
            return begin - int(differs[::-1].argmax())
        begin, step = stop, step * 2
    return begin


class RunCatcher:
    """Runs of the words appended so far; words are whole numbers.

    `runs` holds (start, length, period) of the runs that have ended; `finish` ends the rest.
    """

    def __init__(self, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> None:
        if min_words < MIN_WORDS or min_periods < MIN_PERIODS:
            raise ValueError(f"runs need at least {MIN_WORDS} words and {MIN_PERIODS} periods")
        self.min_words, self.min_periods = min_words, min_periods
        self.runs: list[tuple[int, int, int]] = []
        self._words = np.empty(0, np.int64)
        self._names: list[np.ndarray] = [np.empty(0, np.uint64)]  # by level; a name where its window is whole
        self._new_from = self._ended = 0
        self._growing: dict[int, tuple[int, int]] = {}  # period: [start, end) of equal words up to the text's end

    def append(self, words: np.ndarray) -> None:
        self._words = np.concatenate([self._words, words]) if len(self._words) else words
        n, self._new_from = len(self._words), len(self._words) - len(words)
        self._ended = len(self.runs)
        for period, (start, end) in list(self._growing.items()):
            self._settle(period, start, _equal_ahead(self._words, end, period))
        level = 0
        while (MIN_PERIODS << level) <= n or level <= FIRST_LEVEL <= n.bit_length() - 1:
            seen = len(self._names[level]) if level < len(self._names) else 0
            self._advance(level)
            if level >= FIRST_LEVEL:
                self._catch(level, seen)
            level += 1

    def finish(self) -> list[tuple[int, int, int]]:
        """All runs by start, then period."""
        for period, (start, end) in self._growing.items():
            self._report(period, start, end)
        self._growing = {}
        return sorted(self.runs, key=lambda run: (run[0], run[2]))

    def _advance(self, level: int) -> None:
        """Names of the windows of 2^level words that the text now holds whole."""
        if level == len(self._names):
            self._names.append(np.empty(0, np.uint64))
        old = self._names[level]
        if level == 0:
            new = self._words[len(old) :].astype(np.uint64) * _LEFT
        else:
            below, half = self._names[level - 1], 1 << (level - 1)
            new = _mixed(below[len(old) : len(below) - half], below[len(old) + half :])
        self._names[level] = np.concatenate([old, new]) if len(old) else new

    def _catch(self, level: int, seen: int) -> None:
        names, size = self._names[level], 1 << level
        if level == FIRST_LEVEL:
            for period in range(1, size):
                first = max(0, -(-(seen - period) // size)) * size
                block = np.arange(first, len(names) - period, size)
                block = block[names[block] == names[block + period]]
                self._extend(block, block + period, size)
        place = np.arange(max(seen, size), len(names))
        block = ((place >> level) - 1) << level
        met = names[place] == names[block]
        if met.any():
            self._extend(block[met], place[met], size)

    def _extend(self, block: np.ndarray, place: np.ndarray, size: int) -> None:
        """Follow catches of one level, without those inside known stretches of their period or a part of it."""
        if not len(block):
            return
        new = np.ones(len(place), bool)
        # A stretch that holds a catch of this append reaches into its words.
        known = [(s, s + n, q) for s, n, q in self._recent() if q < 2 * size]
        known += [(s, e + q, q) for q, (s, e) in self._growing.items() if q < 2 * size]
        for start, end, period in known:
            lo, hi = np.searchsorted(place, start), np.searchsorted(place, end - size, "right")
            new[lo:hi] &= (block[lo:hi] < start) | ((place[lo:hi] - block[lo:hi]) % period != 0)
        block, period = block[new], (place - block)[new]
        order = np.argsort(period, kind="stable")
        known_to, last = -1, 0
        for at, q in zip(block[order].tolist(), period[order].tolist()):
            if q == last and at < known_to:
                continue
            known_to, last = _equal_ahead(self._words, at, q), q
            if known_to - at >= size:
                self._settle(q, _equal_back(self._words, at, q), known_to)

    def _recent(self) -> list[tuple[int, int, int]]:
        """The runs that reach into the words of this append; `runs` is by the append that ended them."""
        return [run for run in self.runs[self._ended :] if run[0] + run[1] > self._new_from]

    def _settle(self, period: int, start: int, end: int) -> None:
        if end + period == len(self._words):
            self._growing[period] = (start, end)
        else:
            self._growing.pop(period, None)
            self._report(period, start, end)

    def _report(self, period: int, start: int, end: int) -> None:
        length = end - start + period
        if length >= max(self.min_words, self.min_periods * period):
            self.runs.append((start, length, period))


def runs_of(words: np.ndarray, append: int = APPEND_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of whole numbers, by start, then period."""
    if len(words) < MIN_WORDS:
        return []
    catcher = RunCatcher()
    for begin in range(0, len(words), append):
        catcher.append(words[begin : begin + append])
    return catcher.finish()


def repeated(words: list, seed: int, one_in: int = 10) -> list:
    """The words, where one seed in `one_in` repeats a stretch from some word on to the end."""
    n, g = len(words), seed // one_in
    if seed % one_in or not n:
        return words
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    unit = words[at : at + period]
    return words[:at] + (unit * -(-(n - at) // period))[: n - at]


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Positions outside all runs or among the first period of each run that contains them."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.flatnonzero(np.cumsum(change[:n]) == 0)


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period; of ties the first, then the shortest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_repeats: bool = False
) -> DataFrame:
    """One row per input row: id, runs (start, length, period by start, then period), strongest, collapsed.

    A run is a stretch of at least 24 words and three of its smallest periods that no neighbour
    extends; `strongest` is the one of greatest length / period (of ties the first, then the one
    of the shortest period; NULL without runs). `collapsed` holds the words that no run repeats, joined by one space. NULL and
    empty texts have no words. `with_repeats` first repeats a stretch of one text in ten, by the
    crc32 of its id (a NULL id counts as the empty text), so that runs of any size occur.
    Narrow: one text at a time, whatever its length; repeated rows are independent rows.
    """
    source = docs.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    run_type = "struct<start:bigint,length:bigint,period:bigint>"
    made = (F.lit(None).cast(t).alias(c) for c, t in (("runs", f"array<{run_type}>"), ("strongest", run_type), ("collapsed", "string")))
    schema = source.select("id", *made).schema

    def one(doc_id: object, text: str) -> tuple[list, str]:
        words = text.encode("utf-8").split()
        if with_repeats:
            words = repeated(words, crc32_of(doc_id))
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        runs = runs_of(ids)
        if runs:
            words = [words[i] for i in kept_words(len(words), runs)]
        return runs, b" ".join(words).decode("utf-8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("start", "length", "period")
        item = pa.struct([(name, pa.int64()) for name in names])
        for batch in batches:
            for part in pieces(batch, "text", BATCH_BYTES):
                ids, texts = part.column("id"), part.column("text")
                found = [one(ids[i].as_py(), texts[i].as_py()) for i in range(part.num_rows)]
                runs = [[dict(zip(names, r)) for r in f[0]] for f in found]
                best = [dict(zip(names, b)) if (b := strongest(f[0])) else None for f in found]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(runs, pa.list_(item)), pa.array(best, item), pa.array([f[1] for f in found], pa.string())],
                    names=["id", "runs", "strongest", "collapsed"],
                )

    return source.mapInArrow(run, schema)
