"""Alignment of two tokenizers over the same bytes, and how often their ids stand together.

Offsets at which tokens of both end cut a text into groups. A byte range of a text becomes a
fragment of three parts: the tokens up to its first common end (open prefix), the groups up to
its last one (closed, kept as text and as counted links), the tokens after it (open suffix).
Two fragments of neighbouring ranges compose by closing one group from the left one's suffix and
the right one's prefix. That is associative, with the fragment without tokens as identity, so
the fragments of a long text are made in different tasks and composed in a tree of groupings;
a text of one range is a tree of one leaf.

A range takes the tokens that end in it. To know them it is encoded from the last safe cut before
it to the first one after it; a safe cut is a space between two other characters that are no
white space, over which neither tokenizer joins anything (``Tokenizers`` verifies that for its
files). A border within a longer stretch without a safe cut is dropped, so the work stays linear.

Counts over the corpus are joined back without a row per text and id pair: texts are packed into
blocks of bounded size, each with a list of its distinct id pairs, and texts refer to places in
it. Only the lists go through the count and the join; then each block meets its texts again.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadvane.llm.common import octets, resident, store
from loadvane.session import ship_package

#: Bytes of a range of a long text, fragments composed at once, bytes encoded in one step and
#: bytes of text of one block.
RANGE, FAN, STEP, BLOCK = 32_768, 8, 500_000, 4_000_000

_NO_IDS, _NO_ENDS = np.zeros(0, np.int64), np.zeros(0, np.int64)


@dataclass(frozen=True)
class Files:
    """A byte-level BPE file (A), the pattern that splits its texts, and a sentencepiece model (B)."""

    a: str
    b: str
    pattern: str


class Tokenizers:
    """Two tokenizers of one space and a text, and the bytes of their ids.

    A's merges are ranked by the ids they make and its split is the pattern of the rank files, so
    the rank library encodes its texts, several times faster than the file's own; texts with
    endless pieces, on which that one takes quadratic time, go to the file's own. B adds the
    space itself. What is relied on is verified when the files are read.
    """

    ENDLESS = re.compile(r"\S{1000}|\s{1000}")

    def __init__(self, files: Files):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(files.a, encoding="utf-8") as source:
            model = json.load(source)
        vocab = model["model"]["vocab"]
        special = {token["content"] for token in model["added_tokens"]}
        to_byte = _byte_letters()
        raw = {i: bytes(to_byte[c] for c in token) for token, i in vocab.items() if token not in special}
        made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["model"]["merges"]]
        order = [vocab[m] for m in made]
        if order != sorted(order) or model["normalizer"]:
            raise ValueError("the merges of this file are not ranked by the ids they make")
        self.own = Tokenizer.from_file(files.a)
        self.own.encode_special_tokens = True
        ranks = {token: i for i, token in raw.items()}
        self.ranked = tiktoken.Encoding("a", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        self.model = sentencepiece.SentencePieceProcessor(model_file=files.b)
        pieces = self.model.id_to_piece(list(range(self.model.get_piece_size())))
        if any("▁" in piece.lstrip("▁") for piece in pieces):
            raise ValueError("a piece of this model goes on after a space, so spaces are no safe cuts")
        self.a = Tokens([raw.get(i, b"") for i in range(max(vocab.values()) + 1)])
        self.b = Tokens(
            [
                bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
                for i, piece in enumerate(pieces)
            ]
        )
        # an id within its side of a group, and as the last one of it
        self.split = 2 * len(self.a.sizes)
        self.forms = [f"{i}{sign}" for i in range(len(self.a.sizes)) for sign in ",|"]
        self.forms += [f"{i}{sign}" for i in range(len(self.b.sizes)) for sign in ",;"]

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        if self.ENDLESS.search(text):
            a = self.own.encode(" " + text, add_special_tokens=False).ids
        else:
            a = self.ranked.encode_ordinary(" " + text)
        return np.array(a, np.int64), np.array(self.model.encode(text), np.int64)


class Tokens:
    """The bytes that the ids of a vocabulary stand for."""

    def __init__(self, raw: list[bytes]):
        self.sizes = np.array([len(r) for r in raw], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids one after another."""
        sizes = self.sizes[ids]
        begin = np.cumsum(sizes) - sizes
        return self.raw[np.repeat(self.starts[ids] - begin, sizes) + np.arange(int(sizes.sum()))]


def _byte_letters() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def tokenizers(files: Files) -> Tokenizers:
    """The tokenizers of a pair of files, read once per worker."""
    return resident(("alignment", files), lambda: Tokenizers(files))


@dataclass
class Side:
    """Tokens of one tokenizer: ids and the offsets at which they end."""

    ids: np.ndarray
    ends: np.ndarray

    def part(self, low: int | None, high: int | None) -> Side:
        """The tokens that end beyond ``low`` and up to ``high``."""
        first = 0 if low is None else int(np.searchsorted(self.ends, low, "right"))
        last = len(self.ids) if high is None else int(np.searchsorted(self.ends, high, "right"))
        return Side(self.ids[first:last], self.ends[first:last])

    def __add__(self, other: Side) -> Side:
        return Side(np.r_[self.ids, other.ids], np.r_[self.ends, other.ends])


NOTHING = Side(np.zeros(0, np.int64), np.zeros(0, np.int64))


def merged_ends(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """All offsets at which tokens end, and those at which tokens of both do."""
    ends = np.concatenate([a.ends, b.ends])
    ends.sort(kind="stable")
    again = ends[1:] == ends[:-1]
    return ends[np.r_[True, ~again]] if len(ends) else ends, ends[1:][again]


def links_at(ends: np.ndarray, a: Side, b: Side) -> np.ndarray:
    """The linked ids, as b and a in one number, that cover the bytes before each end.

    Both sides end together; from one end to the next the same two tokens cover all bytes, so
    the ends stand for the pairs of tokens that overlap.
    """
    return b.ids[np.searchsorted(b.ends, ends)] << 32 | a.ids[np.searchsorted(a.ends, ends)]


def written(a: Side, b: Side, common: np.ndarray, known: Tokenizers) -> list[str]:
    """The ids in the order in which groups are written, each with the sign that follows it."""
    group_a, group_b = np.searchsorted(common, a.ends), np.searchsorted(common, b.ends)
    every = np.arange(len(common))
    place_a = np.arange(len(a.ids)) + np.searchsorted(group_b, every)[group_a]
    place_b = np.arange(len(b.ids)) + np.searchsorted(group_a, every, "right")[group_b]
    codes = np.empty(len(a.ids) + len(b.ids), np.int64)
    codes[place_a] = 2 * a.ids + (a.ends == common[group_a])
    codes[place_b] = known.split + 2 * b.ids + (b.ends == common[group_b])
    return list(map(known.forms.__getitem__, codes.tolist()))


def counted(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs."""
    if times is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times, first) if len(first) else times


@dataclass
class Fragment:
    """What a byte range says about the groups of its text.

    Without a common end all tokens are in ``head`` and ``closed`` is false. ``spoiled`` tells
    that the tokens do not spell the bytes, which spoils the whole text.
    """

    head: tuple[Side, Side] = (NOTHING, NOTHING)
    tail: tuple[Side, Side] = (NOTHING, NOTHING)
    closed: bool = False
    spoiled: bool = False
    text: str = ""
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    keys: np.ndarray = field(default_factory=lambda: NOTHING.ids)
    times: np.ndarray = field(default_factory=lambda: NOTHING.ids)

    @classmethod
    def of(cls, a: Side, b: Side, known: Tokenizers, spoiled: bool = False) -> Fragment:
        ends, common = merged_ends(a, b)
        sizes = {"n_a": len(a.ids), "n_b": len(b.ids), "spoiled": spoiled}
        if not len(common):
            return cls(head=(a, b), **sizes)
        first, last = int(common[0]), int(common[-1])
        inner_a, inner_b = a.part(first, last), b.part(first, last)
        inner = ends[(ends > first) & (ends <= last)]
        keys, times = counted(links_at(inner, inner_a, inner_b))
        return cls(
            head=(a.part(None, first), b.part(None, first)),
            tail=(a.part(last, None), b.part(last, None)),
            closed=True,
            text="".join(written(inner_a, inner_b, common[1:], known)),
            n_groups=len(common) - 1,
            n_links=len(inner),
            keys=keys,
            times=times,
            **sizes,
        )

    def then(self, other: Fragment, known: Tokenizers) -> Fragment:
        """The fragment of this range and the next one together."""
        middle = tuple(x + y for x, y in zip(self.tail if self.closed else self.head, other.head))
        sums = {
            "n_a": self.n_a + other.n_a,
            "n_b": self.n_b + other.n_b,
            "spoiled": self.spoiled or other.spoiled,
        }
        if not other.closed:
            kept = {"head": self.head, "tail": middle} if self.closed else {"head": middle}
            return Fragment(**(vars(self) | kept | sums))
        if not self.closed:
            return Fragment(**(vars(other) | {"head": middle} | sums))
        text, ends = _group(*middle, known)
        keys, times = counted(
            np.concatenate([self.keys, links_at(ends, *middle), other.keys]),
            np.concatenate([self.times, np.ones(len(ends), np.int64), other.times]),
        )
        return Fragment(
            head=self.head,
            tail=other.tail,
            closed=True,
            text=self.text + text + other.text,
            n_groups=self.n_groups + 1 + other.n_groups,
            n_links=self.n_links + len(ends) + other.n_links,
            keys=keys,
            times=times,
            **sums,
        )

    def whole(self, known: Tokenizers) -> Fragment:
        """The fragment of a whole text, whose head is its first group; spoiled ones have nothing."""
        if self.spoiled or not self.closed:
            return Fragment(spoiled=True)
        return Fragment(closed=True).then(self, known)


def _group(a: Side, b: Side, known: Tokenizers) -> tuple[str, np.ndarray]:
    """One group as text and the ends in it."""
    ends, common = merged_ends(a, b)
    return "".join(written(a, b, common, known)), ends


# The fields of a fragment as columns.
_SIDES = [f"{part}_{side}_{what}" for part in ("head", "tail") for side in "ab" for what in ("ids", "ends")]
_SUMS = ["n_a", "n_b", "n_groups", "n_links"]
_FRAGMENT = (
    "closed boolean, spoiled boolean, text string, "
    + ", ".join(f"{c} long" for c in _SUMS)
    + ", keys array<long>, times array<long>, "
    + ", ".join(f"{c} array<long>" for c in _SIDES)
)


def _to_row(f: Fragment) -> dict:
    arrays = [x for part in (f.head, f.tail) for side in part for x in (side.ids, side.ends)]
    plain = {c: getattr(f, c) for c in ("closed", "spoiled", "text", *_SUMS, "keys", "times")}
    return plain | dict(zip(_SIDES, arrays))


def _from_row(row: dict) -> Fragment:
    head_a, head_b, tail_a, tail_b = (
        Side(*(np.asarray(row[c], np.int64) for c in _SIDES[i : i + 2])) for i in range(0, 8, 2)
    )
    arrays = {c: np.asarray(row[c], np.int64) for c in ("keys", "times")}
    plain = {c: row[c] for c in ("closed", "spoiled", "text", *_SUMS)}
    return Fragment(head=(head_a, head_b), tail=(tail_a, tail_b), **plain, **arrays)


def ranges(raw: bytes, length: int) -> list[tuple[int, int, int, int]]:
    """Byte ranges (low, high] of a text and from where to where each is encoded.

    ``raw`` begins with a space. Borders lie ``length`` apart, except where the next safe cut on
    either side is farther away than that.
    """
    spaces = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)

    def cut(near: np.ndarray, edge: int, border: int) -> int | None:
        for at in near.tolist():
            if abs(at - border) > length:
                return None
            if _safe(raw, at):
                return at
        return edge if abs(edge - border) <= length else None

    borders = [(0, 0, 0)]
    for border in range(length, len(raw), length):
        middle = int(np.searchsorted(spaces, border))
        after = cut(spaces[middle : middle + length + 1], len(raw), border)
        before = cut(spaces[max(0, middle - length) : middle][::-1], 0, border)
        if after is not None and before is not None:
            borders.append((border, before, after))
    borders.append((len(raw), len(raw), len(raw)))
    return [(low, high, begin, end) for (low, begin, _), (high, _, end) in zip(borders, borders[1:])]


def _safe(raw: bytes, at: int) -> bool:
    """Whether the space at a place stands between two characters that are no white space."""
    before = raw[max(0, at - 4) : at].decode("utf-8", "ignore")[-1:]
    after = raw[at + 1 : at + 5].decode("utf-8", "ignore")[:1]
    return bool(before and after) and not before.isspace() and not after.isspace()


def _encoded(raw: bytes, begin: int, known: Tokenizers) -> tuple[Side, Side, bool]:
    """Tokens of bytes that begin with a space at offset ``begin``, and whether they spell them."""
    a, b = known.ids(raw[1:].decode())
    sides = [Side(ids, begin + np.cumsum(of.sizes[ids])) for ids, of in ((a, known.a), (b, known.b))]
    good = all(of.spell(ids).tobytes() == raw for ids, of in ((a, known.a), (b, known.b)))
    return sides[0], sides[1], good


class Packer:
    """Rows of texts, and per block of them a row that lists its distinct links."""

    def __init__(self, id_type: pa.DataType, keep_groups: bool):
        self.schema = pa.schema(
            [
                ("block", pa.string()),
                ("id", id_type),
                *((c, pa.int64()) for c in _SUMS),
                ("groups", pa.string()),
                ("groups_sha256", pa.string()),
                ("places", pa.binary()),
                ("times", pa.binary()),
                ("keys", pa.list_(pa.int64())),
                ("totals", pa.list_(pa.int64())),
            ]
        )
        self.keep_groups = keep_groups
        self._begin()

    def _begin(self) -> None:
        self.rows: list[tuple] = []
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: object, sums: Sequence[int], text: str, keys: np.ndarray, times: np.ndarray, size: int) -> None:
        self.rows.append((doc_id, *sums, text if self.keep_groups else None, _digest(text)))
        self.keys.append(keys)
        self.times.append(times)
        self.held += size

    def block(self) -> pa.RecordBatch:
        """The rows of the texts added so far and their block's own row."""
        name = uuid.uuid4().hex
        keys, totals = counted(np.concatenate(self.keys), np.concatenate(self.times))
        out = []
        for row, own, times in zip(self.rows, self.keys, self.times):
            steps = np.diff(np.searchsorted(keys, own), prepend=0)
            out.append((name, *row, _packed(steps), _packed(times), None, None))
        if len(keys):
            out.append((name, *[None] * (len(self.rows[0]) + 2), keys, totals))
        self._begin()
        columns = [pa.array(c, f.type) for c, f in zip(zip(*out), self.schema)]
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def _packed(values: np.ndarray) -> bytes:
    """Numbers, 0 or more, in the fewest bytes that hold the largest; the first byte tells how many."""
    top = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _add_texts(packer: Packer, ids: list, texts: list[str | None], known: Tokenizers) -> None:
    """Align short texts as one row of tokens, in which each text ends with a common end."""
    parts, stops, base = [], [], 0
    for text in texts:
        if text:
            raw = b" " + text.encode()
            a, b, good = _encoded(raw, base, known)
            if good:
                parts.append((a, b))
                base += len(raw)
        stops.append(base)
    if parts:
        a = Side(np.concatenate([p[0].ids for p in parts]), np.concatenate([p[0].ends for p in parts]))
        b = Side(np.concatenate([p[1].ids for p in parts]), np.concatenate([p[1].ends for p in parts]))
    else:
        a = b = NOTHING
    ends, common = merged_ends(a, b)
    links = links_at(ends, a, b)
    forms = written(a, b, common, known)
    # where each text's tokens, groups and links end
    upto = [np.searchsorted(x, np.array(stops, np.int64), "right").tolist() for x in (a.ends, b.ends, common, ends)]
    before = (0, 0, 0, 0)
    for doc_id, text, *now in zip(ids, texts, *upto):
        sums = [x - y for x, y in zip(now, before)]
        keys, times = counted(links[before[3] : now[3]])
        groups = "".join(forms[before[0] + before[1] : now[0] + now[1]])[:-1]
        packer.add(doc_id, sums, groups, keys, times, len(text or ""))
        before = now


def align(
    df: DataFrame,
    files: Files,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_groups: bool = False,
    length: int = RANGE,
) -> DataFrame:
    """Per row its id, counts of the alignment and how common its links are.

    ``n_a``, ``n_b``, ``n_groups`` and ``n_links`` count tokens, groups and overlapping pairs of
    tokens; ``n_best`` the links whose id pair is, over all rows, the most frequent one (ties
    too) of its B id, ``count_sum`` adds up the links' frequencies. ``groups`` (if kept) is
    written `a1,a2|b1;a3|b2,b3`, ``groups_sha256`` its digest. Null and empty texts, and those
    that the tokens of either side do not spell, have no tokens: zeros and empty strings. Every
    row gives one row and counts as often as it is there; other columns play no part.
    Texts from ``length`` bytes on are aligned in ranges of that many.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    packed = (
        f"block string, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, "
        "groups_sha256 string, places binary, times binary, keys array<long>, totals array<long>"
    )

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, packer = tokenizers(files), None
        for batch in batches:
            packer = packer or Packer(batch.schema.field("id").type, keep_groups)
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column("id"), batch.column("text")):
                ids.append(doc_id.as_py())
                texts.append(text.as_py())
                held += len(texts[-1] or "")
                if held >= STEP:
                    _add_texts(packer, ids, texts, known)
                    ids, texts, held = [], [], 0
                    if packer.held >= BLOCK:
                        yield packer.block()
            if ids:
                _add_texts(packer, ids, texts, known)
        if packer and packer.rows:
            yield packer.block()

    is_long = octets(F.col("text")) >= length
    both = rows.where(~is_long).mapInArrow(short, packed).unionByName(
        _long_texts(rows.where(is_long), files, kind, packed, keep_groups, length)
    )
    stored = store(both, "aligned")
    blocks = stored.where("keys is not null").select("block", F.posexplode(F.arrays_zip("keys", "totals")).alias("at", "x"))
    blocks = blocks.select("block", "at", F.col("x.keys").alias("key"), F.col("x.totals").alias("total"))
    counts = blocks.groupBy("key").agg(F.sum("total").alias("count"))
    # per B id there are at most as many pairs as A has ids
    most = F.max("count").over(Window.partitionBy(F.shiftright("key", 32)))
    counts = counts.select("key", "count", (F.col("count") == most).alias("best"))
    listed = blocks.join(counts, "key").select(F.col("block").alias("of_block"), "at", "count", "best")
    texts = stored.where("keys is null").drop("keys", "totals")

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("at").to_numpy())
        count = right.column("count").to_numpy()[order]
        best = right.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        sums = []
        for places, times in zip(left.column("places"), left.column("times")):
            at, n = np.cumsum(_unpacked(places.as_py())), _unpacked(times.as_py())
            sums.append((int(n @ best[at]), int(n @ count[at])))
        n_best, count_sum = zip(*sums) if sums else ((), ())
        return (
            left.drop_columns(["block", "places", "times"])
            .append_column("n_best", pa.array(n_best, pa.int64()))
            .append_column("count_sum", pa.array(count_sum, pa.int64()))
        )

    result = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, n_best long, count_sum long"
    out = texts.groupBy("block").cogroup(listed.groupBy("of_block")).applyInArrow(add_up, result)
    groups = [F.col("groups")] if keep_groups else []
    return out.select(F.col("id").alias(id_col), *_SUMS, "n_best", "count_sum", *groups, "groups_sha256")


def _long_texts(rows: DataFrame, files: Files, kind: str, packed: str, keep_groups: bool, length: int) -> DataFrame:
    """Packed rows of texts whose ranges are encoded in tasks of their own and composed in a tree."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(c) for c in ("row", "id", "text"))):
                raw = b" " + text.as_py().encode()
                found = ranges(raw, length)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array([row.as_py()] * len(found), pa.int64()),
                        "id": pa.array([doc_id.as_py()] * len(found), batch.schema.field("id").type),
                        "part": pa.array(range(len(found)), pa.int64()),
                        "low": pa.array([r[0] for r in found], pa.int64()),
                        "high": pa.array([r[1] for r in found], pa.int64()),
                        "begin": pa.array([r[2] for r in found], pa.int64()),
                        "raw": pa.array([raw[r[2] : r[3]] for r in found], pa.binary()),
                    }
                )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizers(files)
        for batch in batches:
            for at, (low, high, begin, raw) in enumerate(zip(*(batch.column(c) for c in ("low", "high", "begin", "raw")))):
                a, b, good = _encoded(raw.as_py(), begin.as_py(), known)
                inside = (x.part(low.as_py() or None, high.as_py()) for x in (a, b))
                fragment = Fragment.of(*inside, known, spoiled=not good)
                yield _fragment_row(batch.slice(at, 1), 0, fragment)

    def compose(group: pa.Table) -> pa.Table:
        known = tokenizers(files)
        group = group.sort_by("part")
        parts = (_from_row(row) for row in group.drop_columns(["row", "id", "part"]).to_pylist())
        whole = reduce(lambda x, y: x.then(y, known), parts)
        return pa.Table.from_batches([_fragment_row(group.slice(0, 1), FAN, whole)])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, packer = tokenizers(files), None
        for batch in batches:
            packer = packer or Packer(batch.schema.field("id").type, keep_groups)
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                f = _from_row(row).whole(known)
                packer.add(row["id"], [getattr(f, c) for c in _SUMS], f.text[:-1], f.keys, f.times, f.n_a + f.n_b)
                if packer.held >= BLOCK // 2:
                    yield packer.block()
        if packer and packer.rows:
            yield packer.block()

    name = f"row long, id {kind}, part long"
    # stored, so that the numbers given to rows stay what they are
    pieces = store(
        rows.select(F.monotonically_increasing_id().alias("row"), "id", "text").mapInArrow(
            split, f"{name}, low long, high long, begin long, raw binary"
        ),
        "ranges",
    )
    parts = (pieces.agg(F.max("part")).first()[0] or 0) + 1
    found = pieces.repartition("row", "part").mapInArrow(encode, f"{name}, {_FRAGMENT}")
    while parts > 1:
        near = F.floor(F.col("part") / FAN)
        found = found.groupBy("row", near.alias("near")).applyInArrow(compose, f"{name}, {_FRAGMENT}")
        parts = -(-parts // FAN)
    return found.mapInArrow(finish, packed)


def _fragment_row(keys: pa.RecordBatch | pa.Table, fan: int, fragment: Fragment) -> pa.RecordBatch:
    """A fragment under the row, id and number that the first of its parts gives it."""
    row = {c: pa.array(keys.column(c).to_pylist(), keys.schema.field(c).type) for c in ("row", "id", "part")}
    if fan:
        row["part"] = pa.array([keys.column("part")[0].as_py() // fan], pa.int64())
    kinds = {"closed": pa.bool_(), "spoiled": pa.bool_(), "text": pa.string()} | dict.fromkeys(_SUMS, pa.int64())
    values = {c: pa.array([v], kinds.get(c, pa.list_(pa.int64()))) for c, v in _to_row(fragment).items()}
    return pa.RecordBatch.from_pydict(row | values)
