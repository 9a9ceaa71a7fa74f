"""Byte-level BPE with the ranks of a vocabulary file: encoding and decoding of whole texts.

Within a task, the pieces of a batch that are not yet known are put into numpy matrices of
token ids, one per length class and padded on the right. Each round every row merges its
leftmost pair of minimum rank; pairs are looked up in an open-addressing hash table; the row
then closes its gap, and rows without a mergeable pair leave the matrix. Pieces longer than
``WIDE`` bytes are rows of their own, where one round merges all occurrences of the minimum as
long as this gives the same result as one at a time.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loadvane.llm.common import resident
from loadvane.session import ship_package

WIDE = 64
#: Bytes of text that one step holds as pieces, and pieces that a worker remembers.
STEP, REMEMBERED = 500_000, 250_000
NONE = np.int32(2**31 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Numbered(dict):
    """Numbers pieces as they are first asked for; ``fresh`` has those without ids so far."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.fresh.append(piece)
        return number


def _spread(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions begin, begin + 1, ... of every run."""
    ends = np.cumsum(counts)
    return np.repeat(begins - ends + counts, counts) + np.arange(int(ends[-1]) if len(ends) else 0)


class Vocabulary:
    """Ranks of a file with one base64 token and its rank per line."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            fields = (line.split() for line in lines)
            self.ranks = {base64.b64decode(f[0]): int(f[1]) for f in fields if f}
        self.pattern = regex.compile(pattern)
        top = max(self.ranks.values()) + 1
        self.lengths = np.full(top, -1, np.int64)
        for token, rank in self.ranks.items():
            self.lengths[rank] = len(token)
        self.starts = np.zeros(top, np.int64)
        tokens = sorted(self.ranks, key=self.ranks.get)
        placed = np.array([self.ranks[t] for t in tokens])
        self.starts[placed] = np.cumsum(self.lengths[placed]) - self.lengths[placed]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self._index_pairs()
        self._forget()

    def _index_pairs(self) -> None:
        ranks = self.ranks
        pairs = [
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        keys = np.array([p[0] for p in pairs] or [0], np.uint64)[: len(pairs)]
        values = np.array([p[1] for p in pairs], np.int32)
        self.bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 4))))
        self.slot_key = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.slot_rank = np.full(1 << self.bits, NONE)
        at = (keys * _MIX) >> np.uint64(64 - self.bits)
        waiting = np.arange(len(keys))
        while len(waiting):
            # of several keys at one free slot the first is placed, the others go one further
            where = at[waiting]
            free = self.slot_key[where] == np.uint64(2**64 - 1)
            _, first = np.unique(np.where(free, where, np.uint64(2**63)), return_index=True)
            placed = first[free[first]]
            self.slot_key[where[placed]] = keys[waiting[placed]]
            self.slot_rank[where[placed]] = values[waiting[placed]]
            waiting = np.delete(waiting, placed)
            at[waiting] = (at[waiting] + np.uint64(1)) & np.uint64((1 << self.bits) - 1)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, NONE where there is none or an id is -1."""
        out = np.full(left.shape, NONE)
        real = (left >= 0) & (right >= 0)
        keys = left[real].astype(np.uint64) << np.uint64(32) | right[real].astype(np.uint64)
        found = np.full(len(keys), NONE)
        at = (keys * _MIX) >> np.uint64(64 - self.bits)
        waiting = np.arange(len(keys))
        while len(waiting):
            slots = self.slot_key[at]
            hit = slots == keys[waiting]
            found[waiting[hit]] = self.slot_rank[at[hit]]
            on = ~hit & (slots != np.uint64(2**64 - 1))
            waiting = waiting[on]
            at = (at[on] + np.uint64(1)) & np.uint64((1 << self.bits) - 1)
        out[real] = found
        return out

    def _merge_rows(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of one length class one after another, and how many each piece has."""
        sizes = np.array([len(p) for p in pieces])
        width = int(sizes.max())
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < sizes[:, None]] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        result = np.full((len(pieces), width), -1, np.int32)
        rows = np.arange(len(pieces))
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        while ids.shape[1] > 1:
            best = ranks.argmin(axis=1)
            low = ranks[np.arange(len(rows)), best]
            on = low != NONE
            if not on.all():
                done = ~on
                result[rows[done], : ids.shape[1]] = ids[done]
                rows, ids, ranks, best, low = rows[on], ids[on], ranks[on], best[on], low[on]
            if not len(rows):
                break
            each = np.arange(len(rows))
            ids[each, best] = low
            # close the gap behind the merged pair; the width shrinks by one each round
            gap = np.arange(ids.shape[1] - 1)[None, :] > best[:, None]
            ids = np.where(gap, ids[:, 1:], ids[:, :-1])
            if ids.shape[1] == 1:
                break
            ranks = np.where(gap[:, :-1], ranks[:, 1:], ranks[:, :-1])
            here, before = each[best < ranks.shape[1]], each[best > 0]
            row, col = np.concatenate([here, before]), np.concatenate([best[here], best[before] - 1])
            ranks[row, col] = self.pair_ranks(ids[row, col], ids[row, col + 1])
        if len(rows):
            result[rows, : ids.shape[1]] = ids
        real = result >= 0
        return result[real], real.sum(axis=1)

    def _merge_long(self, piece: bytes) -> np.ndarray:
        ids = self.single[np.frombuffer(piece, np.uint8)]
        ranks = self.pair_ranks(ids[:-1], ids[1:])
        while len(ids) > 1 and (low := ranks.min()) != NONE:
            at = np.flatnonzero(ranks == low)
            # of overlapping pairs the first, third, ... of each run
            run = np.cumsum(np.r_[True, np.diff(at) > 1])
            first = np.searchsorted(run, run)
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            # all at once only if no pair that arises on the way ranks as low
            left = np.where(at > 0, ids[at - 1], -1)
            left[1:] = np.where(at[1:] == at[:-1] + 2, low, left[1:])
            right = np.where(at + 2 < len(ids), ids[np.minimum(at + 2, len(ids) - 1)], -1)
            merged = np.full(len(at), low, np.int32)
            if len(at) > 1 and min(self.pair_ranks(left, merged).min(), self.pair_ranks(merged, right).min()) <= low:
                at = at[:1]
            ids = ids.copy()
            ids[at] = low
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids = ids[keep]
            fresh = np.zeros(len(keep), bool)
            fresh[at] = True
            fresh = np.flatnonzero(fresh[keep])
            ranks = ranks[keep[1:]] if len(ids) > 1 else ranks[:0]
            if len(ids) > 1:
                redo = np.unique(np.concatenate([fresh, fresh - 1]))
                redo = redo[(redo >= 0) & (redo < len(ids) - 1)]
                ranks[redo] = self.pair_ranks(ids[redo], ids[redo + 1])
        return ids

    def learn(self, pieces: list[str]) -> None:
        """Append the ids of new pieces to the store, in the order of ``pieces``."""
        raw = [piece.encode() for piece in pieces]
        whole = np.array([self.ranks.get(r, -1) for r in raw], np.int32)
        counts = np.ones(len(raw), np.int64)
        classes: dict[int, list[int]] = {}
        for at in np.flatnonzero(whole < 0).tolist():
            size = len(raw[at])
            classes.setdefault((size + 3) // 4 if size <= WIDE else -1, []).append(at)
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.flatnonzero(whole >= 0), whole[whole >= 0])]
        for kind, members in classes.items():
            for start in range(0, len(members), 8_000 if kind > 0 else 1):
                part = np.array(members[start : start + (8_000 if kind > 0 else 1)])
                if kind > 0:
                    ids, counts[part] = self._merge_rows([raw[at] for at in part])
                else:
                    ids = self._merge_long(raw[part[0]])
                    counts[part] = len(ids)
                found.append((part, ids))
        begins = np.cumsum(counts) - counts
        fresh = np.empty(int(counts.sum()), np.int32)
        for part, ids in found:
            fresh[_spread(begins[part], counts[part])] = ids
        base = self.size
        self._reserve(base + len(fresh), len(self.known))
        self.flat[base : base + len(fresh)] = fresh
        first = len(self.known) - len(pieces)
        self.begin[first : first + len(pieces)] = base + begins
        self.count[first : first + len(pieces)] = counts
        self.size = base + len(fresh)

    def _reserve(self, ids: int, pieces: int) -> None:
        if ids > len(self.flat):
            self.flat = np.resize(self.flat, 2 * ids)
        if pieces > len(self.begin):
            self.begin, self.count = np.resize(self.begin, 2 * pieces), np.resize(self.count, 2 * pieces)

    def _forget(self) -> None:
        self.known = _Numbered()
        self.size = 0
        self.flat, self.begin, self.count = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and where each text ends."""
        parts: list[np.ndarray] = []
        ends: list[np.ndarray] = []
        total, start = 0, 0
        while start < len(texts):
            stop, held = start, 0
            while stop < len(texts) and (stop == start or held + len(texts[stop]) <= STEP):
                held += len(texts[stop])
                stop += 1
            if len(self.known) > REMEMBERED:
                self._forget()
            lookup = self.known.__getitem__
            numbers = [list(map(lookup, self.pattern.findall(text))) for text in texts[start:stop]]
            if self.known.fresh:
                self.learn(self.known.fresh)
                self.known.fresh = []
            used = np.fromiter(chain.from_iterable(numbers), np.int64)
            counts = self.count[used]
            parts.append(self.flat[_spread(self.begin[used], counts)])
            pieces = np.cumsum([0, *map(len, numbers)])
            upto = np.r_[0, np.cumsum(counts)]
            ends.append(total + upto[pieces[1:]])
            total += int(upto[-1])
            start = stop
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate(parts), np.concatenate(ends)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids one after another, and where each id's bytes end."""
        sizes = self.lengths[ids]
        if len(ids) and (ids.min() < 0 or sizes.min() < 0):
            raise ValueError("an id is not in the vocabulary")
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        out = np.empty(total, np.uint8)
        for start in range(0, len(ids), 1_000_000):  # the index array is eight times the bytes
            stop = min(len(ids), start + 1_000_000)
            base = int(ends[start] - sizes[start])
            begin = ends[start:stop] - sizes[start:stop]
            source = np.repeat(self.starts[ids[start:stop]] - begin, sizes[start:stop])
            top = int(ends[stop - 1])
            out[base:top] = self.bytes[source + np.arange(base, top)]
        return out, ends


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """The vocabulary of a path, read once per worker."""
    return resident(("bpe", path, pattern), lambda: Vocabulary(path, pattern))


def _steps(batch: pa.RecordBatch, text_col: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of about STEP bytes of text, or single rows, with their texts; null is empty."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(sizes):
        held = int(upto[start] - sizes[start])
        stop = max(start + 1, int(np.searchsorted(upto, held + STEP, "right")))
        part = batch.slice(start, stop - start)
        yield part, [text or "" for text in part.column(text_col).to_pylist()]
        start = stop


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids, pa.int32()))


def _with_columns(batch: pa.RecordBatch, keep: list[str], values: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *values.values()], names=[*keep, *values])


def encode(
    df: DataFrame, path: str, pattern: str, text_col: str = "text", into: str = "ids", keep: list[str] | None = None
) -> DataFrame:
    """The ``keep`` columns (default: all but the text) and the ids of each text.

    A null text is an empty one; an empty text has no ids. Every row gives one row. A kept
    column named like ``into`` is replaced.
    """
    ship_package(df.sparkSession)
    keep = [c for c in (keep if keep is not None else df.columns) if c not in (text_col, into)]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(into, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in batches:
            for part, texts in _steps(batch, text_col):
                yield _with_columns(part, keep, {into: _lists(*vocab.encode(texts))})

    return df.select(*keep, text_col).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns and the bytes that the ids stand for; null ids give no bytes."""
    ship_package(df.sparkSession)
    keep = [c for c in df.columns if c != into]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(into, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for whole in batches:
            for start in range(0, max(1, whole.num_rows), 500):
                batch = whole.slice(start, 500)
                lists = batch.column(ids_col).fill_null([])
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                sizes = np.asarray(lists.value_lengths())
                raw, ends = vocab.decode(ids)
                marks = np.r_[0, ends][np.r_[0, np.cumsum(sizes)]]
                values = pa.BinaryArray.from_buffers(
                    pa.binary(), batch.num_rows, [None, pa.py_buffer(marks.astype(np.int32)), pa.py_buffer(raw)]
                )
                yield _with_columns(batch, keep, {into: values})

    return df.mapInArrow(run, schema)


def digest(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False
) -> DataFrame:
    """Per document the number of ids, digests of the ids and of the bytes they decode to.

    Texts are encoded, decoded again and digested in one pass, so a task has one worker with one
    vocabulary. ``keep_ids`` adds the ids themselves. A null text is an empty one; every row
    gives one row.
    """
    ship_package(df.sparkSession)
    sums = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    schema = T.StructType([df.schema[id_col], *(T.StructField(c, kind) for c, kind in sums.items())])
    if keep_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in batches:
            for part, texts in _steps(batch, text_col):
                ids, ends = vocab.encode(texts)
                raw, byte_ends = vocab.decode(ids)
                raw, upto = memoryview(raw), np.r_[0, byte_ends]
                of_ids, of_bytes, begin = [], [], 0
                for end in ends.tolist():
                    of_ids.append(sha256(b" ".join(map(b"%d".__mod__, ids[begin:end].tolist()))).hexdigest())
                    of_bytes.append(sha256(raw[upto[begin] : upto[end]]).hexdigest())
                    begin = end
                values = {
                    "n_tokens": pa.array(np.diff(ends, prepend=0), pa.int64()),
                    "ids_sha256": pa.array(of_ids, pa.string()),
                    "decoded_sha256": pa.array(of_bytes, pa.string()),
                }
                if keep_ids:
                    values["ids"] = _lists(ids, ends)
                yield _with_columns(part, [id_col], values)

    return df.select(id_col, text_col).mapInArrow(run, schema)
