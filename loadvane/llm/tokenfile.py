"""Token ids in binary files of independent zstandard frames.

A file is a row of frames followed by a table and a trailer:

    frame*    zstandard frame of the ids of some documents, little-endian unsigned 32-bit
    table     zstandard frame of 40-byte rows for the frames, then 24-byte rows for documents
    trailer   table bytes u64, frames u64, documents u64, crc32 of the table u32, b"LVTF"

A frame row holds offset, stored bytes, ids, first document (u64 each), crc32 of the ids'
bytes (u32) and a zero. A document row holds id (i64), whether it is null (u64) and ids (u64).
Documents stand in ascending id order, null first, equal ids by a hash of their text; file
number k + 1 continues where file k ends. A reader fetches the trailer, the table and only the
frames that hold the documents asked for, and checks each frame it opens.

Files go to the shared folder under a name of their own for each attempt of a task; a stored
list of the files of the attempts that Spark accepted makes them the result.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadvane.llm.common import qualified, resident, shared_uri
from loadvane.llm.hashing import in_steps
from loadvane.session import fresh_dir, ship_package

MAGIC = b"LVTF"
FRAME = np.dtype([("offset", "<u8"), ("stored", "<u8"), ("ids", "<u8"), ("first", "<u8"), ("crc", "<u4"), ("pad", "<u4")])
DOCUMENT = np.dtype([("id", "<i8"), ("null", "<u8"), ("ids", "<u8")])
TRAILER = struct.Struct("<QQQI4s")
#: Bytes of ids a frame holds at least, unless it is the last.
FRAME_BYTES = 1 << 18
#: Text pieces a worker remembers, bytes of text encoded in one step, new pieces encoded together.
REMEMBERED, STEP, TOGETHER = 400_000, 4_000_000, 4_096


class Encoder:
    """A tokenizer file with a memory of the pieces between blanks.

    Blanks are characters that the tokenizer drops, so that no token crosses them: a text's ids
    are those of its pieces one after another. This tokenizer lowers the case and cuts between
    letters and signs, so ASCII letters are lowered and Latin ones parted from a comma or full
    stop behind them first, which leaves fewer different pieces. Of a word of Latin letters its
    normaliser and splitter make one piece, so that goes to the library's model at once, spelled
    in the characters by which the tokenizer writes bytes.
    """

    LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
    BEFORE_SIGN = "([a-zÀ-ÖØ-öø-ÿ])([,.])"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        splitter = self.tokenizer.pre_tokenizer
        letters = filter(self.LETTERS.fullmatch, map(chr, range(256)))
        self.spelling = {ord(c): splitter.pre_tokenize_str(c)[0][0] for c in letters if c == c.lower()}
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, fresh: list[str]) -> None:
        tokenize, spelling = self.tokenizer.model.tokenize, self.spelling
        plain = list(filter(self.LETTERS.fullmatch, fresh))
        other = [p for p in fresh if not self.LETTERS.fullmatch(p)]
        # pure ASCII is spelled as it is
        lists = [[t.id for t in tokenize(w if w.isascii() else w.lower().translate(spelling))] for w in plain]
        for first in range(0, len(other), TOGETHER):
            some = other[first : first + TOGETHER]
            lists += [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        self.numbers.update(zip(chain(plain, other), range(len(self.numbers), len(self.numbers) + len(fresh))))
        self.begin = np.r_[self.begin, len(self.flat) + np.cumsum(count) - count]
        self.count = np.r_[self.count, count]
        self.flat = np.r_[self.flat, np.fromiter(chain.from_iterable(lists), np.uint32)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another and how many each text has.

        Texts are split and their pieces numbered by Arrow; only different pieces are looked up.
        """
        if len(self.numbers) > REMEMBERED:
            self._forget()
        spaced = pc.replace_substring_regex(texts.cast(pa.large_string()), "[\n\t\r]", " ")
        # ascii_lower garbles slices of an array; what the replacement returns is none
        parted = pc.replace_substring_regex(pc.ascii_lower(spaced), self.BEFORE_SIGN, r"\1 \2")
        lists = pc.split_pattern(parted, " ")
        coded = lists.flatten().dictionary_encode()
        pieces, numbers = coded.dictionary.to_pylist(), self.numbers
        # two blanks in a row have an empty piece between them, which has no ids
        fresh = [p for p in pieces if p not in numbers]
        if fresh:
            self._learn(fresh)
        known = np.fromiter(map(numbers.__getitem__, pieces), np.int64, len(pieces))
        used = known[coded.indices.to_numpy()]
        counts = self.count[used]
        upto = np.r_[0, np.cumsum(counts)]
        where = np.repeat(self.begin[used] - upto[:-1], counts)
        where += np.arange(len(where))
        offsets = lists.offsets.to_numpy()
        return self.flat[where], np.diff(upto[offsets - offsets[0]])


class FileWriter:
    def __init__(self, out):
        self.out, self.packer = out, zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple] = []
        self.documents: list[np.ndarray] = []
        self.waiting: list[bytes] = []
        self.held = self.offset = self.first = self.count = self.ids = 0

    def add(self, doc_ids: np.ndarray, null: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Documents in order, ids of all of them one after another."""
        rows = np.zeros(len(doc_ids), DOCUMENT)
        rows["id"], rows["null"], rows["ids"] = doc_ids, null, counts
        self.documents.append(rows)
        raw, begin = ids.astype("<u4").tobytes(), 0
        for size in (counts * 4).tolist():
            self.waiting.append(raw[begin : begin + size])
            begin += size
            self.held += size
            self.count += 1
            if self.held >= FRAME_BYTES:
                self._flush()
        self.ids += int(counts.sum())

    def _flush(self) -> None:
        raw = b"".join(self.waiting)
        stored = self.packer.compress(raw)
        self.out.write(stored)
        self.frames.append((self.offset, len(stored), len(raw) // 4, self.first, zlib.crc32(raw), 0))
        self.offset += len(stored)
        self.first, self.waiting, self.held = self.count, [], 0

    def close(self) -> None:
        if self.count > self.first:
            self._flush()
        documents = np.concatenate(self.documents) if self.documents else np.zeros(0, DOCUMENT)
        table = self.packer.compress(np.array(self.frames, FRAME).tobytes() + documents.tobytes())
        self.out.write(table)
        self.out.write(TRAILER.pack(len(table), len(self.frames), len(documents), zlib.crc32(table), MAGIC))


def read_table(source) -> tuple[np.ndarray, np.ndarray]:
    """The frame and document rows of a file open for random access."""
    size = source.size()
    if size < TRAILER.size:
        raise ValueError("not a token file: too short")
    length, frames, documents, crc, magic = TRAILER.unpack(source.read_at(TRAILER.size, size - TRAILER.size))
    if magic != MAGIC:
        raise ValueError("not a token file")
    stored = source.read_at(length, size - TRAILER.size - length)
    if zlib.crc32(stored) != crc:
        raise ValueError("the table of a token file is damaged")
    raw = zstandard.ZstdDecompressor().decompress(stored, max_output_size=frames * FRAME.itemsize + documents * DOCUMENT.itemsize)
    cut = frames * FRAME.itemsize
    return np.frombuffer(raw[:cut], FRAME), np.frombuffer(raw[cut:], DOCUMENT)


def read_frame(source, frame: np.void) -> bytes:
    stored = source.read_at(int(frame["stored"]), int(frame["offset"]))
    raw = zstandard.ZstdDecompressor().decompress(stored, max_output_size=int(frame["ids"]) * 4)
    if zlib.crc32(raw) != frame["crc"]:
        raise ValueError("a frame of a token file is damaged")
    return raw


@dataclass
class TokenFiles:
    """A folder of token files and the stored list of them: file, documents, ids, part."""

    folder: str
    listed: str

    def files(self, spark: SparkSession) -> DataFrame:
        """One row per file with the number of ids in the files before it."""
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        return (
            spark.read.schema("file string, part int, documents long, ids long")
            .parquet(self.listed)
            .withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long"))
        )


def write_tokens(
    docs: DataFrame, path: str, end_id: int, parts: int, id_col: str = "doc_id", text_col: str = "text"
) -> TokenFiles:
    """Encode every text, append ``end_id``, and write token files in ascending id order.

    A null text is an empty one and has the end id alone. Equal ids are kept, in the order of a
    hash of their text. An empty table gives no files. Only the id and the text are read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder, listed = qualified(spark, fresh_dir(spark, "token-files")), fresh_dir(spark, "token-list")
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .withColumns({"tie": F.xxhash64("text"), "size": F.octet_length("text").cast("long")})
        .repartitionByRange(parts, F.col("id").asc_nulls_first(), "tie")
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        part = TaskContext.get().partitionId()
        name = f"tokens-{part:06d}-{uuid.uuid4().hex}.lvtf"
        system, where = shared_uri(f"{folder}/{name}")
        writer = out = None
        for whole in batches:
            for batch in in_steps(whole, "size", STEP):
                if writer is None:
                    system.create_dir(os.path.dirname(where), recursive=True)
                    out = system.open_output_stream(where)
                    writer = FileWriter(out)
                ids, counts = encoder.encode(batch.column("text"))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)
                doc = batch.column("id")
                writer.add(doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False), counts + 1, ids)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"file": [name], "part": pa.array([part], pa.int32()), "documents": [writer.count], "ids": [writer.ids]}
            )

    ordered.mapInArrow(run, "file string, part int, documents long, ids long").write.parquet(listed)
    return TokenFiles(folder, listed)


def _encoder(path: str) -> Encoder:
    return resident(("tokens", path), lambda: Encoder(path))


def read_tokens(spark: SparkSession, files: TokenFiles, only: list[int] | None = None) -> DataFrame:
    """doc_id, start, and ids (little-endian u32 bytes) of all documents, or of those in ``only``.

    ``start`` is the number of ids of all documents before. With ``only``, frames without such
    a document are not opened.
    """
    ship_package(spark)
    folder = files.folder
    wanted = None if only is None else np.array(sorted(set(only)), np.int64)
    listed = files.files(spark).select("file", "start")
    listed = listed.repartition(max(spark.sparkContext.defaultParallelism, 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, begin in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                system, where = shared_uri(f"{folder}/{name}")
                with system.open_input_file(where) as source:
                    frames, documents = read_table(source)
                    starts = begin + np.cumsum(documents["ids"]).astype(np.int64) - documents["ids"].astype(np.int64)
                    last = np.r_[frames["first"][1:], len(documents)]
                    for frame, stop in zip(frames, last):
                        span = slice(int(frame["first"]), int(stop))
                        part = documents[span]
                        chosen = np.ones(len(part), bool)
                        if wanted is not None:
                            chosen = np.isin(part["id"], wanted) & (part["null"] == 0)
                        if not chosen.any():
                            continue
                        raw = read_frame(source, frame)
                        ends = np.cumsum(part["ids"]).astype(np.int64) * 4
                        cuts = np.r_[0, ends]
                        which = np.flatnonzero(chosen)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(part["id"][which], mask=part["null"][which] > 0),
                                pa.array(starts[span][which]),
                                pa.array([raw[cuts[i] : cuts[i + 1]] for i in which.tolist()], pa.binary()),
                            ],
                            names=["doc_id", "start", "ids"],
                        )

    return listed.mapInArrow(run, "doc_id long, start long, ids binary")
