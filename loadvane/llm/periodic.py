"""Periodic runs of words, found on a harmonic grid by longest common extensions.

A run of period p and length L is a stretch in which words p apart are identical; positions i
with word[i] = word[i + p] then fill a region of L - p places. With L at least ``LEAST`` and
``TIMES`` periods that region holds max(LEAST - p, (TIMES - 1) p) places, so a grid of half that
step has a point in its first half. All points of the grids of all periods, n log n of them,
are probed at a few places; those that hold are extended to the left and right, and extensions
that are long enough are runs. The smallest period of a stretch is the least one found for it.

Extensions are answered from a difference cover: only the suffixes that start at positions of a
perfect difference set modulo ``MODULUS`` are sorted, by prefix doubling in steps of that many
words. Two positions are compared word by word for the few places until both are sampled, from
there on the minimum of the neighbours' common prefixes between their ranks, out of a sparse
table, is the rest. Only texts with a probe that holds get such an index; another over the
reversed words serves the extensions to the left.

Texts are handled in one Arrow pass without a shuffle; steps hold about ``_BYTES`` of text, and
the texts of a step lie one after another with a word of its own between any two.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadvane.llm.hashing import in_steps
from loadvane.session import ship_package

#: Least words of a run, and least periods.
LEAST, TIMES = 24, 3
# A perfect difference set, every remainder but 0 is one difference of two members.
MODULUS = 31
COVER = np.array([1, 5, 11, 24, 25, 27])
#: Bytes of text of one step, and grid points and extensions handled at once.
_BYTES, _POINTS, _PAIRS = 1_500_000, 250_000, 100_000


def _meeting() -> np.ndarray:
    """For two remainders the least distance after which both stand on the cover."""
    member = np.zeros(MODULUS, bool)
    member[COVER] = True
    out = np.full((MODULUS, MODULUS), -1, np.int64)
    rest = np.arange(MODULUS)
    for step in range(MODULUS - 1, -1, -1):
        both = member[(rest + step) % MODULUS]
        out[both[:, None] & both[None, :]] = step
    return out


_MEET = _meeting()
_PLACE = np.full(MODULUS, -1, np.int64)
_PLACE[COVER] = np.arange(len(COVER))


class Extensions:
    """Common prefixes of suffixes of ``words``, in which a negative number occurs once at most."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        # an end mark that occurs nowhere else stops every comparison
        self.words = np.r_[words, np.full(1, words.min(initial=0) - 1), np.zeros(2 * MODULUS, words.dtype)]
        blocks = self.n // MODULUS + 1
        self.at = (np.arange(blocks)[:, None] * MODULUS + COVER).ravel()
        self.at = self.at[self.at <= self.n]
        self._sort()

    def _sort(self) -> None:
        """Names of the sampled blocks of MODULUS, 2 MODULUS, 4 MODULUS, ... words, then ranks."""
        low = int(self.words.min())
        size = int(self.words.max()) - low + 1
        several = max(1, int(62 / max(1, size.bit_length())))  # words that one key holds
        names = np.zeros(len(self.at), np.int64)
        for begin in range(0, MODULUS, several):
            key = np.zeros(len(self.at), np.int64)
            for step in range(begin, min(begin + several, MODULUS)):
                key = key * size + (self.words[self.at + step] - low)
            key = np.unique(key, return_inverse=True)[1]
            names = np.unique(names * (len(key) + 1) + key, return_inverse=True)[1]
        self.levels, width = [names], MODULUS
        while len(names) and names.max() + 1 < len(names):
            later = self.at + width
            after = np.where(later <= self.n, names[np.minimum(self._index(later), len(names) - 1)] + 1, 0)
            names = np.unique(names * (len(names) + 2) + after, return_inverse=True)[1]
            self.levels.append(names)
            width *= 2
        self.rank = names
        order = np.empty(len(names), np.int64)
        order[names] = np.arange(len(names))
        self.table = [self._neighbours(self.at[order[:-1]], self.at[order[1:]])]
        span = 1
        while 2 * span <= len(self.table[0]):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-span], last[span:]))
            span *= 2

    @staticmethod
    def _index(at: np.ndarray) -> np.ndarray:
        """Number of a sampled position."""
        return at // MODULUS * len(COVER) + _PLACE[at % MODULUS]

    def _neighbours(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Common prefixes of sampled suffixes, from the longest blocks down to words."""
        done = np.zeros(len(left), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            here, there = left + done, right + done
            on = np.flatnonzero((here <= self.n) & (there <= self.n))
            names = self.levels[level]
            same = on[names[self._index(here[on])] == names[self._index(there[on])]]
            done[same] += MODULUS << level
        return done + self._plain(left + done, right + done, np.full(len(left), MODULUS))

    def _plain(self, left: np.ndarray, right: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common words from two positions on, compared one by one up to ``most`` of them."""
        out = np.zeros(len(left), np.int64)
        on = np.flatnonzero(most > 0)
        while len(on):
            on = on[self.words[left[on] + out[on]] == self.words[right[on] + out[on]]]
            out[on] += 1
            on = on[out[on] < most[on]]
        return out

    def common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at pairs of different positions."""
        steps = _MEET[left % MODULUS, right % MODULUS]
        out = self._plain(left, right, steps)
        on = np.flatnonzero(out == steps)
        ranks = self.rank[self._index(left[on] + steps[on])], self.rank[self._index(right[on] + steps[on])]
        low, high = np.minimum(*ranks), np.maximum(*ranks)
        level = np.frexp((high - low).astype(float))[1] - 1
        for k in np.unique(level).tolist():
            part = level == k
            row = self.table[k]
            out[on[part]] += np.minimum(row[low[part]], row[high[part] - (1 << k)])
        return out


def _grid(begin: np.ndarray, size: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, position and period of the grid points of texts, a bounded number at once."""
    longest = int(size.max(initial=0))
    period = np.arange(1, longest // times + 1)
    step = np.maximum(1, _region(period, least, times) // 2)
    held = _held(period, least, times)
    of_text = np.where(size >= least, size // times, 0)
    text = np.repeat(np.arange(len(size)), of_text)
    which = np.arange(len(text)) - np.repeat(np.cumsum(of_text) - of_text, of_text)
    points = np.maximum(0, (size[text] - period[which] - held[which]) // step[which] + 1)
    upto = np.cumsum(points)
    first = 0
    while first < len(points):
        base = upto[first] - points[first]
        last = max(first + 1, int(np.searchsorted(upto, base + _POINTS, "right")))
        part = slice(first, last)
        number = np.arange(int(upto[last - 1] - base)) - np.repeat(upto[part] - points[part] - base, points[part])
        line = np.repeat(np.arange(first, last), points[part])
        yield text[line], begin[text[line]] + number * step[which[line]], period[which[line]]
        first = last


def _region(period: np.ndarray, least: int, times: int) -> np.ndarray:
    """Places of a run at which the word one period on is the same, at least."""
    return np.maximum(least - period, (times - 1) * period)


def _held(period: np.ndarray, least: int, times: int) -> np.ndarray:
    """Places from the first grid point in that region on that must hold, at least."""
    region = _region(period, least, times)
    return region - np.maximum(1, region // 2) + 1


def _lined(words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words with a mark of its own before every text and at the end, and where texts begin."""
    begin = np.cumsum(size + 1) - size
    out = np.empty(len(words) + len(size) + 1, np.int64)
    marks = np.r_[begin - 1, len(out) - 1]
    inside = np.ones(len(out), bool)
    inside[marks] = False
    out[marks] = -1 - np.arange(len(marks))
    out[inside] = words
    return out, begin


def _probed(lined: np.ndarray, begin: np.ndarray, size: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Text, position and period of the grid points at which a few places hold."""
    for text, at, period in _grid(begin, size, least, times):
        on = np.flatnonzero(lined[at] == lined[at + period])
        on = on[lined[at[on] + 1] == lined[at[on] + period[on] + 1]]
        last = at[on] + _held(period[on], least, times) - 1
        on = on[lined[last] == lined[last + period[on]]]
        yield text[on], at[on], period[on]


def find_runs(words: np.ndarray, size: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (text, start, length, period) of all runs of texts, by text, start and period.

    ``words`` holds the numbers, 0 or more, of the words of all texts one after another, ``size``
    how many each has. A stretch counts once, with its smallest period.
    """
    some = np.zeros(len(size), bool)
    for text, _, _ in _probed(*_lined(words, size), size, least, times):
        some[text] = True
    names = np.flatnonzero(some)
    if not len(names):
        return np.zeros((0, 4), np.int64)
    # only the texts with a probe that holds are indexed
    words, size = words[np.repeat(some, size)], size[names]
    lined, begin = _lined(words, size)
    ahead, back = Extensions(lined), Extensions(lined[::-1])
    runs = np.zeros((0, 4), np.int64)
    for points in _probed(lined, begin, size, least, times):
        for first in range(0, len(points[0]), _PAIRS):
            text, at, period = (x[first : first + _PAIRS] for x in points)
            right = ahead.common(at, at + period)
            on = np.flatnonzero(right >= _held(period, least, times))
            text, at, period, right = text[on], at[on], period[on], right[on]
            left = back.common(len(lined) - at, len(lined) - at - period)
            on = np.flatnonzero(left + right >= _region(period, least, times))
            found = np.stack([text, at - left - begin[text], left + right + period, period], axis=1)[on]
            runs = np.unique(np.concatenate([runs, found]), axis=0)
            # of the periods of one stretch the least
            first_of = np.ones(len(runs), bool)
            first_of[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)
            runs = runs[first_of]
    runs[:, 0] = names[runs[:, 0]]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _outside_repeats(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words no run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 1] + runs[:, 3], 1)
    np.add.at(edge, runs[:, 1] + runs[:, 2], -1)
    return np.cumsum(edge[:-1]) == 0


def repeated_tail(seed: int, n: int) -> np.ndarray | None:
    """Which word stands at each place when a seeded end of n words repeats its beginning."""
    if not n:
        return None
    begin = seed % n
    period = 1 + (n - begin) // (3 + seed % 8)
    place = np.arange(n)
    place[begin:] = begin + (place[begin:] - begin) % period
    return place


def runs(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: Column | None = None,
    rearrange: Callable[[int, int], np.ndarray | None] = repeated_tail,
) -> DataFrame:
    """Per row its id, ``n_words``, ``runs`` (array of start, length, period) and ``collapsed``.

    Words stand between white space of ASCII; runs are ordered by start and period; collapsed
    are the words that no run holds after its first period, joined by one space. ``seed`` may
    name a number per row: where it is not null, ``rearrange(seed, n)`` tells which word stands
    at each of the n places first. Null and empty texts have no words, no runs and an empty
    collapsed text. Every row gives one row, equal ids stay apart, other columns play no part.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_steps(whole, "size", _BYTES):
                yield _found(batch, rearrange)

    source = df.select(
        F.col(id_col).alias("id"),
        F.encode(text_col, "UTF-8").alias("raw"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("size"),
        (F.lit(None) if seed is None else seed).cast("long").alias("seed"),
    )
    kind = df.schema[id_col].dataType.simpleString()
    shape = "array<struct<start:long,length:long,period:long>>"
    found = source.mapInArrow(run, f"id {kind}, n_words long, runs {shape}, collapsed string")
    return found.withColumnRenamed("id", id_col)


def _found(batch: pa.RecordBatch, rearrange: Callable[[int, int], np.ndarray | None]) -> pa.RecordBatch:
    texts: list[list[bytes]] = []
    for raw, seed in zip(batch.column("raw").to_pylist(), batch.column("seed").to_pylist()):
        words = (raw or b"").split()
        order = None if seed is None else rearrange(seed, len(words))
        texts.append(words if order is None else [words[i] for i in order.tolist()])
    numbers: dict[bytes, int] = {}
    flat = np.array([numbers.setdefault(w, len(numbers)) for words in texts for w in words], np.int64)
    size = np.array([len(words) for words in texts], np.int64)
    rows = find_runs(flat, size)
    upto = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    for text in np.unique(rows[:, 0]).tolist():
        words = texts[text]
        keep = _outside_repeats(len(words), rows[upto[text] : upto[text + 1]])
        texts[text] = [words[i] for i in np.flatnonzero(keep).tolist()]
    fields = [pa.array(rows[:, k]) for k in (1, 2, 3)]
    listed = pa.ListArray.from_arrays(
        pa.array(upto.astype(np.int32)), pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
    )
    collapsed = pa.array([b" ".join(words) for words in texts], pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [batch.column("id"), pa.array(size), listed, collapsed], names=["id", "n_words", "runs", "collapsed"]
    )
