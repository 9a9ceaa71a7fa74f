"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

The kernel counts the common subsequences of LENGTH characters of two strings, each weighed by
DECAY to the power of the places it spans, so that gaps and inserted characters lower a match
instead of losing it. A sentence's value at a landmark is the best of its words (with runs of
spaced single letters as one word), over the landmark's kernel with itself. Landmarks are the
strings, with marks of a word's begin and end, whose presence best tells labelled documents
apart; the Nyström map of the landmarks' kernel matrix (cubed, as the values are) turns a sentence's values into features of a linear machine with squared hinge
loss. As labels are per document, a toxic one is represented by its most suspicious sentences,
chosen anew between rounds of training. A document's score is the logistic of its highest
sentence margin.

Training takes a bounded sample of labelled rows to the driver; scoring runs over all texts.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadvane.llm.common import resident
from loadvane.session import ship_package

LENGTH, DECAY = 3, 0.8
#: Characters of a word the kernel sees at once; longer ones are read in overlapping windows.
WIDTH = 24
#: Labelled documents of each kind learned from, the bytes of text of one, and landmarks, at most.
TOXIC, CLEAN, TRAIN_BYTES, LANDMARKS = 3_000, 4_000, 20_000, 64
#: Lengths of strings tried as landmarks, and the least number of toxic documents that hold one.
GRAMS, SEEN = range(4, 9), 3
#: Least difference of a landmark's frequencies in standard deviations, and least log odds.
WORTH, ODDS = 6.0, 1.8
#: Share of a landmark's neighbouring characters that a word must hold to be compared with it.
SHARED = 0.6
#: A word whose values all stay below is taken for nothing.
FAINT = 0.1
ROUNDS, RIDGE = 3, 1e-4
REMEMBERED, STEP_CHARS = 600_000, 1_000_000


#: Marks of a word's begin and end, so that a landmark can ask for either.
BEGIN, END = "\x02", "\x03"


def kernel(words: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Kernel value of each word with the mark beside it: code points, padded with 0 and -1."""
    n, m = words.shape[1], marks.shape[1]
    same = (words[:, :, None] == marks[:, None, :]).transpose(1, 2, 0).astype(np.float32) * np.float32(DECAY**2)
    # before[i][j]: weighed common subsequences, of the length so far, in words[:i] and marks[:j]
    before = np.ones((n + 1, m + 1, len(words)), np.float32)
    for _ in range(1, LENGTH):
        after = np.zeros_like(before)
        for i in range(n):
            line = np.zeros(len(words), np.float32)
            for j in range(m):
                line = np.float32(DECAY) * line + same[i, j] * before[i, j]
                after[i + 1, j + 1] = np.float32(DECAY) * after[i, j + 1] + line
        before = after
    return (same * before[:n, :m]).sum(axis=(0, 1))


def coded(words: list[str], pad: int) -> np.ndarray:
    width = max(map(len, words))
    out = np.full((len(words), width), pad, np.int32)
    sizes = np.array([len(w) for w in words])
    out[np.arange(width) < sizes[:, None]] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.int32)
    return out


def bare(chunk: str) -> str:
    """A chunk without the signs around it."""
    first, last = 0, len(chunk)
    while first < last and not chunk[first].isalnum():
        first += 1
    while last > first and not chunk[last - 1].isalnum():
        last -= 1
    return chunk[first:last]


def windows(word: str) -> list[str]:
    if len(word) <= WIDTH:
        return [word]
    return [word[at : at + WIDTH] for at in range(0, len(word) - WIDTH // 2, WIDTH // 2)]


class _Numbered(dict):
    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.fresh.append(chunk)
        return number


class Words:
    """Landmark values of chunks, remembered. Cold chunks share the row of zeros."""

    def __init__(self, landmarks: list[str]):
        self.marks = coded(landmarks, -1)
        self.own = kernel(coded(landmarks, 0), self.marks)
        # neighbouring characters of the landmarks, by a hash of 16 bits
        sides = [self._hash(self.marks[:, :-1], self.marks[:, 1:]), self.marks[:, 1:] >= 0]
        codes = np.unique(sides[0][sides[1]])
        self.place = np.full(1 << 16, len(codes), np.int32)
        self.place[codes] = np.arange(len(codes))
        self.asked = np.zeros((len(codes) + 1, len(landmarks)), np.float32)
        for mark in range(len(landmarks)):
            self.asked[self.place[sides[0][mark][sides[1][mark]]], mark] = 1
        self.asked[-1] = 0
        self.least = SHARED * self.asked.sum(axis=0) - 1e-6
        self.forget()

    @staticmethod
    def _hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return (first.astype(np.int64) * 40_503 + second.astype(np.int64) * 9_973) & 0xFFFF

    def forget(self) -> None:
        self.numbers = _Numbered()
        self.ends = np.zeros(0, bool)
        self.single = np.zeros(0, bool)
        self.hot = np.zeros(0, np.int32)
        self.values = np.zeros((1, len(self.marks)), np.float32)

    def measure(self, words: list[str]) -> np.ndarray:
        """Values of words, each over the landmark's kernel with itself, cubed.

        Only landmarks are tried of which SHARED of the neighbouring characters stand in the
        word in that order, next to each other or with one character between.
        """
        out = np.zeros((len(words), len(self.marks)), np.float32)
        classes: dict[int, list[tuple[int, str]]] = defaultdict(list)
        for at, word in enumerate(words):
            for part in windows(BEGIN + word + END):
                if len(part) > LENGTH:
                    classes[(len(part) + 3) // 4].append((at, part))
        for parts in classes.values():
            for start in range(0, len(parts), 4_000):
                some = parts[start : start + 4_000]
                codes = coded([p for _, p in some], 0)
                seen = np.zeros((len(some), len(self.asked)), np.float32)
                row = np.arange(len(some))[:, None]
                for apart in (1, 2):
                    seen[row, self.place[self._hash(codes[:, :-apart], codes[:, apart:])]] = 1
                which, mark = np.nonzero(seen @ self.asked >= self.least)
                for begin in range(0, len(which), 4_000):
                    w, k = which[begin : begin + 4_000], mark[begin : begin + 4_000]
                    found = np.minimum(kernel(codes[w], self.marks[k]) / self.own[k], 1) ** 3
                    np.maximum.at(out, (np.array([at for at, _ in some])[w], k), found)
        return out

    def learn(self) -> None:
        fresh, self.numbers.fresh = self.numbers.fresh, []
        stripped = [bare(c) for c in fresh]
        kinds = list(dict.fromkeys(stripped))
        values = self.measure(kinds)
        warm = np.flatnonzero(values.max(axis=1, initial=0) >= FAINT)
        rows = np.zeros(len(kinds), np.int32)
        rows[warm] = np.arange(len(self.values), len(self.values) + len(warm))
        self.values = np.concatenate([self.values, values[warm]])
        at = dict(zip(kinds, rows.tolist()))
        self.hot = np.r_[self.hot, np.array([at[s] for s in stripped], np.int32)]
        self.ends = np.r_[self.ends, np.array([c[-1] in ".!?\n" and len(s) != 1 for c, s in zip(fresh, stripped)], bool)]
        self.single = np.r_[self.single, np.array([len(s) == 1 for s in stripped], bool)]

    def sentences(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Values of the sentences that hold a warm word, and the text of each."""
        if len(self.numbers) > REMEMBERED:
            self.forget()
        lookup = self.numbers.__getitem__
        chunks = [text.lower().replace("\n", " \n ").split(" ") for text in texts]
        chunks = [[c for c in line if c] for line in chunks]
        numbers = np.array([n for line in chunks for n in map(lookup, line)], np.int64)
        if self.numbers.fresh:
            self.learn()
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in chunks])
        ends = self.ends[numbers]
        # a sentence ends behind its last chunk and with its text
        sentence = np.cumsum(np.r_[False, ends[:-1]]) + owner if len(numbers) else np.zeros(0, np.int64)
        rows = self.hot[numbers]
        extra = self._spelled(numbers, owner, sentence, chunks)
        at = np.flatnonzero(rows)
        values = np.concatenate([self.values[rows[at]], *[v[None] for _, _, v in extra]])
        texts_of = np.r_[owner[at], np.array([o for o, _, _ in extra], np.int64)]
        of = np.r_[sentence[at], np.array([s for _, s, _ in extra], np.int64)]
        if not len(of):
            return np.zeros((0, len(self.marks)), np.float32), np.zeros(0, np.int64)
        order = np.argsort(of, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(of[order]) > 0])
        return np.maximum.reduceat(values[order], first, axis=0), texts_of[order][first]

    def _spelled(self, numbers, owner, sentence, chunks) -> list[tuple[int, int, np.ndarray]]:
        """Runs of at least four single letters in one text as words of their own."""
        single = self.single[numbers]
        if not single.any():
            return []
        cut = np.r_[True, (np.diff(single.astype(np.int8)) != 0) | (np.diff(owner) != 0)]
        begin = np.flatnonzero(cut)
        stop = np.r_[begin[1:], len(single)]
        runs = [(b, e) for b, e in zip(begin, stop) if single[b] and e - b >= 4]
        if not runs:
            return []
        flat = [c for line in chunks for c in line]
        values = self.measure(["".join(map(bare, flat[b:e])) for b, e in runs])
        return [(int(owner[b]), int(sentence[b]), v) for (b, _), v in zip(runs, values) if v.max() >= FAINT]


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, words: Words, texts: list[str]) -> np.ndarray:
        """The highest sentence margin of each text; one without a warm word has the bias."""
        values, of = words.sentences(texts)
        out = np.full(len(texts), self.bias)
        np.maximum.at(out, of, values @ self.weights + self.bias)
        return out

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


def _where(texts: list[str], rows: list[int]) -> dict[str, int]:
    """For each word the texts that hold it, as the bits of a number."""
    words: dict[str, int] = defaultdict(int)
    for bit, at in enumerate(rows):
        for word in {bare(chunk) for chunk in texts[at].lower().split()}:
            words[word] |= 1 << bit
    return words


def _grams(word: str, n: int) -> set[str]:
    marked = BEGIN + word + END
    return {marked[start : start + n] for start in range(len(marked) - n + 1)}


def _frequent_grams(words: dict[str, int], n: int, least: int) -> dict[str, int]:
    """The strings of n characters that at least ``least`` texts hold, with the texts as bits.

    A table of counts by hash, of fixed size, first rules out nearly all of the rare ones.
    """
    mask = (1 << 22) - 1
    most = array("I", bytes(4 * (mask + 1)))
    for word, where in words.items():
        seen = where.bit_count()
        for gram in _grams(word, n):
            most[hash(gram) & mask] += seen
    held: dict[str, int] = defaultdict(int)
    for word, where in words.items():
        for gram in _grams(word, n):
            if most[hash(gram) & mask] >= least:
                held[gram] |= where
    return {g: d for g, d in held.items() if d.bit_count() >= least}


def _deviation(seen: int, n_toxic: int, n_clean: int) -> float:
    """Of the difference of two shares, if ``seen`` texts of both kinds hold the string."""
    return float(np.sqrt((seen + 1) / (n_toxic + n_clean) * (1 / n_toxic + 1 / n_clean)))


def choose_landmarks(texts: list[str], toxic: np.ndarray) -> dict[str, float]:
    """Strings inside words that many toxic and hardly any clean texts hold.

    Taken in the order of how much they tell apart; one that occurs where a chosen one does is
    left out. The order of ties is that of the strings. The value is the logarithm of how many
    times likelier the string is in a toxic text.
    """
    n_toxic, n_clean = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    # fewer toxic texts than this do not reach WORTH even without a clean one
    least = next((k for k in range(SEEN, n_toxic) if k / n_toxic >= WORTH * _deviation(k, n_toxic, n_clean)), n_toxic)
    in_toxic, in_clean = _where(texts, np.flatnonzero(toxic).tolist()), _where(texts, np.flatnonzero(~toxic).tolist())
    telling: list[tuple[float, str, int, float]] = []
    for n in GRAMS:
        held = _frequent_grams(in_toxic, n, least)
        clean: dict[str, int] = defaultdict(int)
        for word, where in in_clean.items():
            for gram in _grams(word, n):
                if gram in held:
                    clean[gram] |= where
        for gram, where in held.items():
            seen, other = where.bit_count(), clean[gram].bit_count() if gram in clean else 0
            worth = (seen / n_toxic - other / n_clean) / _deviation(seen + other, n_toxic, n_clean)
            odds = float(np.log((seen + 0.5) / n_toxic) - np.log((other + 0.5) / n_clean))
            if worth >= WORTH and odds > ODDS:
                telling.append((worth, gram, where, odds))
    chosen: dict[str, float] = {}
    taken: list[int] = []
    for _, gram, where, odds in sorted(telling, key=lambda t: (-t[0], -len(t[1]), t[1])):
        if len(chosen) == LANDMARKS:
            break
        if all((where & other).bit_count() < 0.8 * where.bit_count() for other in taken):
            chosen[gram] = odds
            taken.append(where)
    # a word that begins like a toxic one may be harmless if it ends there
    ended = [g + END for g in chosen if g[0] == BEGIN and g[-1] != END]
    return chosen | {g: 0.0 for g in ended if g not in chosen}


def squared_hinge(features: np.ndarray, sign: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights and bias (last) of a linear machine, by Newton steps."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), RIDGE * weight.sum())
    ridge[-1] = 1e-9
    for _ in range(30):
        inside = sign * (x @ w) < 1
        some = x[inside] * weight[inside, None]
        new = np.linalg.solve(some.T @ x[inside] + np.diag(ridge), some.T @ sign[inside])
        if np.abs(new - w).max() < 1e-8:
            return new
        w = new
    return w


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """Without texts of both kinds, or without a landmark, every text gets the share of toxic ones."""
    told = choose_landmarks(texts, toxic) if toxic.any() and not toxic.all() else {}
    landmarks = list(told)
    share = (toxic.sum() + 0.5) / (len(toxic) + 1)
    if not landmarks:
        return Model(["\0" * LENGTH], np.zeros(1), 0.0, 0.0, float(np.log(share / (1 - share))))
    words = Words(landmarks)
    count = len(landmarks)
    left, right = np.repeat(np.arange(count), count), np.tile(np.arange(count), count)
    root = np.sqrt(words.own)
    gram = (kernel(coded(landmarks, 0)[left], words.marks[right]).reshape(count, count) / root[:, None] / root) ** 3
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    values = np.maximum(values, 1e-3)
    nystrom = (vectors / np.sqrt(values)) @ vectors.T
    parts, owners = [], []
    for start in range(0, len(texts), 200):
        found, of = words.sentences(texts[start : start + 200])
        parts.append(found)
        owners.append(of + start)
    found, of = np.concatenate(parts), np.concatenate(owners)
    features = found @ nystrom
    bad = toxic[of]
    suspicion = (found * np.array(list(told.values()))).max(axis=1)
    quiet = np.zeros((1, features.shape[1]))
    n_quiet = int((~toxic).sum())
    for _ in range(ROUNDS):
        most = np.full(len(texts), -np.inf)
        np.maximum.at(most, of, suspicion)
        # witnesses: what is suspicious at least half as much as the text's worst sentence
        used = np.flatnonzero(~bad | (suspicion >= np.minimum(most[of], np.maximum(most[of] / 2, 1e-3))))
        x = np.concatenate([features[used], quiet])
        sign = np.r_[np.where(bad[used], 1.0, -1.0), -1.0]
        solved = squared_hinge(x, sign, np.r_[np.ones(len(used)), max(1, n_quiet)])
        suspicion = features @ solved[:-1]
    model = Model(landmarks, nystrom @ solved[:-1], float(solved[-1]), 1.0, 0.0)
    margin = np.full(len(texts), model.bias)
    np.maximum.at(margin, of, found @ model.weights + model.bias)
    model.slope, model.offset = _logistic(margin, toxic)
    return model


def _logistic(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    x = np.column_stack([margin, np.ones(len(margin))])
    # targets drawn in, as in Platt's method, keep separable data finite
    up, down = toxic.sum(), (~toxic).sum()
    goal = np.where(toxic, (up + 1) / (up + 2), 1 / (down + 2))
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - goal) + 1e-6 * w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0)), float(w[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from at most TOXIC and CLEAN labelled rows (id, toxic 0/1) in the order of a hash.

    Rows without a label or an id are not learned from, nor are texts above TRAIN_BYTES. Of an
    id with several labels the toxic one counts, of one with several texts the smallest. Only
    the sampled ids, a bounded table, are broadcast.
    """
    known = (
        labels.where(F.col("id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("id")
        .agg((F.max("toxic") == 1).alias("toxic"))
    )
    taken = [
        known.where(F.col("toxic") == kind).orderBy(F.xxhash64("id"), "id").limit(most) for kind, most in ((True, TOXIC), (False, CLEAN))
    ]
    rows = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .where(F.octet_length("text") <= TRAIN_BYTES)
        .join(F.broadcast(taken[0].unionByName(taken[1])), "id")
        # one row per id, however often it is repeated
        .groupBy("id", "toxic")
        .agg(F.min("text").alias("text"))
        .toPandas()
        .sort_values(["id", "text"])
    )
    return fit(rows["text"].tolist(), rows["toxic"].to_numpy(bool))


def score(df: DataFrame, model: Model, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and the score (0 to 1) of every row's whole text; null is empty."""
    ship_package(df.sparkSession)
    names = list(keep)
    source = df.select(*[c.alias(n) for n, c in keep.items()], F.coalesce(F.col(text_col), F.lit("")).alias("scored text"))
    fields = [f for f in source.schema.fields if f.name in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = resident(("toxicity", *model.landmarks), lambda: Words(model.landmarks))
        for batch in batches:
            texts = batch.column("scored text").to_pylist()
            margins, start = [np.zeros(0)], 0
            while start < len(texts):
                stop, held = start, 0
                while stop < len(texts) and (stop == start or held + len(texts[stop]) <= STEP_CHARS):
                    held += len(texts[stop])
                    stop += 1
                margins.append(model.margins(words, texts[start:stop]))
                start = stop
            values = pa.array(model.scores(np.concatenate(margins)), pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], values], names=[*names, "score"])

    return source.mapInArrow(run, T.StructType([*fields, T.StructField("score", T.DoubleType())]))
