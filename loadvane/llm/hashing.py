"""Hashes of words and of runs of words, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x100000001B3)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def in_steps(batch: pa.RecordBatch, size_column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose sizes together stay within ``most``, or single rows."""
    sizes = batch.column(size_column).to_pylist()
    start = 0
    while start < len(sizes):
        stop, held = start, 0
        while stop < len(sizes) and (stop == start or held + sizes[stop] <= most):
            held += sizes[stop]
            stop += 1
        yield batch.slice(start, stop - start)
        start = stop


def mixed(values: np.ndarray) -> np.ndarray:
    """Values spread over all 64 bits."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def word_hashes(texts: list[bytes], kind: np.ndarray, change: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts one after another, and how many each text has.

    ``kind`` tells for each byte value whether it belongs to a word (0 never does); ``change``
    maps byte values first. Words are hashed in rounds over their length, the longest first; a
    round takes the next byte of all words that have one.
    """
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # a zero byte stands before each text and at the end, so that no word crosses
    raw = np.frombuffer(b"\0" + b"\0".join(texts) + b"\0", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    raw = raw if change is None else change[raw]
    edge = np.diff(kind[raw].view(np.int8))
    begin, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    order = np.argsort(begin - end, kind="stable")
    start, length = begin[order], (end - begin)[order]
    value = np.zeros(len(begin), np.uint64)
    at, live = 0, len(begin)
    while live:
        if live < 32:  # few very long words are left
            for word in range(live):
                value[word] = _long_hash(value[word], raw[start[word] + at : start[word] + length[word]])
            break
        value[:live] = (value[:live] + raw[start[:live] + at].astype(np.uint64) + np.uint64(1)) * _BASE
        at += 1
        live = int(np.searchsorted(-length, -at, side="left"))
    hashed = np.empty(len(begin), np.uint64)
    hashed[order] = mixed(value)
    return hashed, np.bincount(np.searchsorted(ends, begin, side="left"), minlength=len(texts))[: len(texts)]


def _long_hash(value: np.uint64, rest: np.ndarray) -> np.uint64:
    base, out = int(_BASE), int(value)
    for byte in rest.tolist():
        out = (out + byte + 1) * base & 0xFFFFFFFFFFFFFFFF
    return np.uint64(out)


def shingle_sets(texts: list[bytes], kind: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of ``width`` words of each text.

    A text of fewer words has one run of all its words; one without words has none.
    """
    words, counts = word_hashes(texts, kind)
    runs = np.zeros(len(words), np.uint64)
    for step in range(width):
        # beyond a text's last full run the values are not read
        runs = runs * _BASE + np.r_[words[step:], np.zeros(min(step, len(words)), np.uint64)]
    runs = mixed(runs)
    out, start = [], 0
    for count in counts.tolist():
        if 0 < count < width:
            short = np.uint64(count)
            for word in words[start : start + count]:
                short = np.uint64((int(short) * int(_BASE) + int(word)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mixed(np.array([short], np.uint64)))
        else:
            out.append(np.unique(runs[start : start + max(0, count - width + 1)]))
        start += count
    return out
