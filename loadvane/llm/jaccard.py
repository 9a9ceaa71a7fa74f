"""Set-similarity join of texts by the chosen-path method.

A text is the set of its runs of WORDS words, of which a sketch keeps the SKETCH smallest
hashes. A set chooses its tokens whose hash lies below a bound inversely proportional to its
size, the same hash for all sets, so that two sets of Jaccard similarity THRESHOLD or more are
expected to choose RUNS tokens in common, one for each repetition of the method: the loss is at
most exp(-RUNS), which the target recall fixes. Sets that chose a token are a bucket. Small
buckets are compared pair by pair. Large ones are split by further tokens, chosen by a hash of
the path so far, unless their sets are alike throughout; what is still large at the end is
compared block by block. Buckets of the same sets, as a line that many texts share makes them,
are one at every level, so a bucket that does not shrink does not multiply either.

Equal texts are one set. Candidates are pruned by size and by sketch, with bounds six standard
deviations off, and then verified on the full sets, which are built again from the texts that
need it. Blocks hand on a count of links and a representative per set, not the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadvane.llm.common import free_name, store
from loadvane.llm.hashing import in_steps, mixed, shingle_sets
from loadvane.session import ship_package

WORDS, THRESHOLD = 5, 0.8
#: Target recall of one level, hashes of a sketch, and those that prune pairs.
RECALL, SKETCH, HEAD = 0.999995, 128, 32
#: Largest bucket compared pair by pair, levels of splitting, expected common tokens of a split,
#: and how many buckets of the same sets count at most for that number.
SMALL, LEVELS, SPLIT, TRIES = 32, 4, 3.0, 4
#: Mean overlap of the first ALIKE_HEAD hashes from which a bucket is not split any further, and
#: signed sums that estimate it, one for each bit of a token's hash.
ALIKE, ALIKE_HEAD, SIGNS = 0.5, 16, 64
BLOCK, BYTES = 1_000, 2_000_000

_KIND = np.ones(256, bool)
_KIND[[0, 0x20, *range(0x09, 0x0E)]] = False


def _sets(df: DataFrame, keep: list[str], most: int | None) -> DataFrame:
    """keep, n and the hashes of each text: the ``most`` smallest upper halves, or all."""
    ship_package(df.sparkSession)
    kind = T.ArrayType(T.IntegerType(), False) if most else T.BinaryType()
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("n", T.IntegerType()), T.StructField("hashes", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_steps(whole, "size", BYTES):
                sets = shingle_sets([x or b"" for x in batch.column("raw").to_pylist()], _KIND, WORDS)
                if most:
                    heads = [(s[:most] >> np.uint64(32)).astype(np.uint32).view(np.int32) for s in sets]
                    offsets = np.cumsum([0, *map(len, heads)]).astype(np.int32)
                    hashes = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(heads)))
                else:
                    hashes = pa.array([s.tobytes() for s in sets], pa.binary())
                n = pa.array([len(s) for s in sets], pa.int32())
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], n, hashes], names=[*keep, "n", "hashes"])

    source = df.select(
        *keep,
        F.encode("text", "UTF-8").alias("raw"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"),
    )
    return source.mapInArrow(run, schema)


def _fraction(hash_bits: Column) -> Column:
    """A 32-bit hash as a number from 0 to 1."""
    return F.pmod(hash_bits.cast("long"), F.lit(1 << 32)) / F.lit(float(1 << 32))


def _bucketed(rows: DataFrame) -> DataFrame:
    """Rows of buckets with at least two sets, with the bucket's size, each of the buckets once.

    Buckets of the same sets are one; ``tries`` is their number. Two sums of 32 bits of the keys'
    hashes tell which are the same.
    """
    bits = F.xxhash64("key")
    sums = [F.sum(half.bitwiseAND(0xFFFFFFFF)).alias(name) for half, name in ((bits, "low"), (F.shiftright(bits, 32), "high"))]
    sizes = rows.groupBy("path").agg(F.count("*").alias("held"), *sums).where(F.col("held") > 1)
    once = sizes.groupBy("held", "low", "high").agg(F.min("path").alias("path"), F.count("*").alias("tries"))
    return rows.join(once.select("path", "held", "tries"), "path")


def _small_pairs(rows: DataFrame) -> DataFrame:
    """Pairs a < b of small buckets that may be similar, each once."""
    member = F.struct("key", "n", "head")
    lists = rows.groupBy("path").agg(F.array_sort(F.collect_list(member)).alias("members"))
    a, b = F.col("a"), F.col("b")
    common = F.size(F.array_intersect(a["head"], b["head"]))
    whole = F.greatest(a["n"], b["n"]) <= HEAD
    # of HEAD hashes at least 0.8 are common in the mean; a third is six deviations below
    enough = F.when(whole, common >= F.ceil(THRESHOLD / (1 + THRESHOLD) * (a["n"] + b["n"]) - 1e-9)).otherwise(
        (F.least(a["n"], b["n"]) < HEAD) | (common >= HEAD // 3)
    )
    return (
        lists.select(F.posexplode("members").alias("at", "a"), "members")
        .select("a", F.explode(F.expr("slice(members, at + 2, size(members))")).alias("b"))
        .where(F.least(a["n"], b["n"]) >= F.lit(THRESHOLD) * F.greatest(a["n"], b["n"]))
        .where(enough)
        .select(a["key"].alias("a"), b["key"].alias("b"))
        .distinct()
    )


def _signed(rows: DataFrame) -> DataFrame:
    """path, held, number of tokens and SIGNS signed sums of them, of the sets' first hashes.

    Each token counts +1 or -1 in each of the sums, by the bits of its hash, which differ from
    bucket to bucket. A batch gives one row for each of its buckets.
    """
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, held, heads = batch.column("path").to_numpy(), batch.column("held").to_numpy(), batch.column("head")
            sizes = pc.list_value_length(heads).to_numpy()
            if not len(path):
                continue
            order = np.argsort(np.repeat(path, sizes), kind="stable")
            paths, first, of_row = np.unique(path, return_index=True, return_inverse=True)
            tokens = heads.flatten().to_numpy().view(np.uint32)[order].astype(np.uint64)
            count = np.bincount(of_row, sizes).astype(np.int64)
            bits = mixed(tokens + np.repeat(mixed(paths.view(np.uint64)), count))
            bits = np.unpackbits(bits.view(np.uint8)).reshape(-1, SIGNS)
            # sets have a word run at least, so no bucket is without tokens
            ones = np.add.reduceat(bits, np.cumsum(count) - count, axis=0, dtype=np.int64)
            sums = pa.FixedSizeListArray.from_arrays(pa.array((2 * ones - count[:, None]).ravel()), SIGNS)
            columns = [pa.array(paths), pa.array(held[first]), pa.array(count), sums.cast(pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "held", "tokens", "sums"])

    return rows.select("path", "held", F.slice("head", 1, ALIKE_HEAD).alias("head")).mapInArrow(
        run, "path long, held long, tokens long, sums array<long>"
    )


def _alike(rows: DataFrame) -> DataFrame:
    """Paths of buckets whose sets are alike throughout, by the first hashes of their sketches.

    The mean square of signed sums of tokens estimates the sum of the squared counts of the
    different tokens, within 18 % by standard deviation, and no row per token is needed. Which
    way a bucket goes decides how its pairs are compared, not whether.
    """
    sums = [F.sum(F.col("sums")[i]).cast("double").alias(f"sum{i}") for i in range(SIGNS)]
    squares = sum((F.col(f"sum{i}") * F.col(f"sum{i}") for i in range(SIGNS)), F.lit(0.0)) / SIGNS
    return (
        _signed(rows)
        .groupBy("path", "held")
        .agg(F.sum("tokens").alias("tokens"), *sums)
        .where((squares - F.col("tokens")) / F.col("tokens") >= F.lit(ALIKE) * (F.col("held") - 1))
        .select("path")
    )


def _links(sets: list[np.ndarray], at: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which of the sets ``at`` and ``other`` are similar, as a matrix."""
    both = np.unique(np.concatenate([at, other]))
    tokens, inverse = np.unique(np.concatenate([sets[i] for i in both]), return_inverse=True)
    owner = np.repeat(np.arange(len(both)), [len(sets[i]) for i in both])
    frequent = np.bincount(inverse, minlength=len(tokens)) > 1
    column = np.cumsum(frequent) - 1
    on = frequent[inverse]
    owner, column = owner[on], column[inverse[on]]
    left, right = np.searchsorted(both, at), np.searchsorted(both, other)
    common = np.zeros((len(at), len(other)), np.float32)
    for start in range(0, int(frequent.sum()), 4_096):
        inside = (column >= start) & (column < start + 4_096)
        part = np.zeros((len(both), min(4_096, int(frequent.sum()) - start)), np.float32)
        part[owner[inside], column[inside] - start] = 1
        common += part[left] @ part[right].T
    sizes = np.array([len(sets[i]) for i in both], np.float64)
    union = sizes[left][:, None] + sizes[right] - common
    return common >= THRESHOLD * union - 1e-9


def _block(frame: pd.DataFrame) -> pd.DataFrame:
    """Links within a pair of blocks of a bucket.

    A pair that shares several such buckets is counted in the first of them.
    """
    path, first, second = frame[["path", "first", "second"]].iloc[0]
    sets = [np.frombuffer(x, np.uint64) for x in frame["hashes"]]
    block = frame["block"].to_numpy()
    at, other = np.flatnonzero(block == first), np.flatnonzero(block == second)
    if not len(at) or not len(other):
        return pd.DataFrame({"key": [], "root": [], "links": []}).astype({"links": "int64"})
    linked = _links(sets, at, other)
    if first == second:
        np.fill_diagonal(linked, False)
    earlier = sorted({p for paths in frame["paths"] for p in paths if p < path})
    seen = np.zeros((len(frame), max(1, len(earlier))), np.float32)
    place = {p: k for k, p in enumerate(earlier)}
    for row, paths in enumerate(frame["paths"]):
        for p in paths:
            if p in place:
                seen[row, place[p]] = 1
    counted = linked & (seen[at] @ seen[other].T == 0)
    links = np.zeros(len(frame), np.int64)
    links[at] += counted.sum(axis=1)
    if first != second:
        links[other] += counted.sum(axis=0)
    # the smallest row that each is linked with over any number of steps
    root = np.arange(len(frame))
    while True:
        low = np.where(linked, root[other][None, :], len(frame)).min(axis=1)
        new = root.copy()
        new[at] = np.minimum(new[at], low)
        new[other] = np.minimum(new[other], np.where(linked, new[at][:, None], len(frame)).min(axis=0))
        new = new[new]
        if (new == root).all():
            break
        root = new
    on = (links > 0) | (root != np.arange(len(frame)))
    keys = frame["key"].to_numpy(object)
    return pd.DataFrame({"key": keys[on], "root": keys[root[on]], "links": links[on]})


def _verified(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                on.append(common >= THRESHOLD * (len(x) + len(y) - common) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(on, pa.bool_()))

    left = full.select(F.col("key").alias("a"), F.col("hashes").alias("set_a"))
    right = full.select(F.col("key").alias("b"), F.col("hashes").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """key and label, the smallest key that it is connected with, for all keys of the edges.

    Labels are lowered along edges and then to the label's own label until nothing changes; each
    round is stored.
    """
    both = store(edges.union(edges.select("b", "a")).distinct(), "near-edges")
    labels = store(both.groupBy(F.col("a").alias("key")).agg(F.least(F.col("key"), F.min("b")).alias("label")), "near-labels")
    while True:
        lowered = (
            both.join(labels, both["b"] == labels["key"])
            .groupBy("a")
            .agg(F.min("label").alias("low"))
            .join(labels, F.col("a") == labels["key"])
            .select("key", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        )
        up = labels.select(F.col("key").alias("label"), F.col("label").alias("above"))
        new = store(lowered.join(up, "label").select("key", "old", F.least("label", "above").alias("label")), "near-labels")
        if new.where(F.col("label") != F.col("old")).isEmpty():
            return new.select("key", "label")
        labels = new.select("key", "label")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, key (of the text), class_id and n_links of every row.

    Texts are linked if their sets of word runs have a Jaccard similarity of THRESHOLD or more;
    n_links counts the different texts that a row's text is linked with. Equal texts and linked
    ones, over any number of steps, are a class, named by its smallest id. Null texts and those
    without words are linked with nothing and stand alone, whatever they equal. Rows without an
    id count as copies like others; a class of such rows has a null name. An empty table gives
    no rows.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.unhex(F.md5(text_col)).alias("key"))
    rows = store(_sets(source, ["id", "key"], SKETCH), "near-sketches")
    with_words = rows.where(F.col("n") > 0)
    # one set per text: that of the row with the smallest id
    texts = with_words.groupBy("key").agg(F.min("id").alias("id"))
    first = texts.select(F.col("key").alias("k"), F.col("id").alias("i"))
    # the id as a second join key spreads the copies of a text over the partitions
    sets = store(
        with_words.join(first, (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("i")), "left_semi")
        .select("key", "id", "n", "hashes")
        .dropDuplicates(["key", "id"]),
        "near-sets",
    )
    runs = math.log(1 / (1 - RECALL))
    bound = F.lit(runs / THRESHOLD) / F.col("n")
    token = F.explode(F.filter("hashes", lambda h: _fraction(h) < bound)).alias("token")
    heads = sets.select("key", "n", F.slice("hashes", 1, HEAD).alias("head"))
    level = sets.select("key", token).select(F.xxhash64("token").alias("path"), "key")
    pairs, large = [], []
    for depth in range(LEVELS + 1):
        held = store(_bucketed(level).join(heads, "key"), "near-level")
        pairs.append(_small_pairs(held.where(F.col("held") <= SMALL)))
        wide = held.where(F.col("held") > SMALL)
        if depth == LEVELS:
            large.append(wide.select("path", "key"))
            break
        alike = store(_alike(wide), "near-alike")
        large.append(wide.join(alike, "path", "left_semi").select("path", "key"))
        rest = wide.join(alike, "path", "left_anti").select("path", "key", "tries")
        # one bucket is split for all of its sets, so as often as they would be
        tokens = F.lit(SPLIT / THRESHOLD) * F.least("tries", F.lit(TRIES))
        share = tokens / F.least(F.col("n"), F.lit(SKETCH))
        level = store(
            rest.join(sets.select("key", "n", "hashes"), "key")
            .withColumn("paths", F.transform("hashes", lambda token: F.xxhash64("path", token)))
            .withColumn("paths", F.filter("paths", lambda p: _fraction(F.xxhash64(p).bitwiseAND(0xFFFFFFFF)) < share))
            .select(F.explode("paths").alias("path"), "key"),
            "near-split",
        )
    big = large[0]
    for more in large[1:]:
        big = big.union(more)
    big = store(big, "near-large")
    shared = big.groupBy("key").agg(F.array_sort(F.collect_set("path")).alias("paths"))
    candidates = pairs[0]
    for more in pairs[1:]:
        candidates = candidates.union(more)
    # pairs of a large bucket are found there
    a, b = shared.select(F.col("key").alias("a"), F.col("paths").alias("of_a")), shared.select(F.col("key").alias("b"), F.col("paths").alias("of_b"))
    candidates = store(
        candidates.distinct()
        .join(a, "a", "left")
        .join(b, "b", "left")
        .where(~F.coalesce(F.arrays_overlap("of_a", "of_b"), F.lit(False)))
        .select("a", "b"),
        "near-candidates",
    )
    needed = candidates.select(F.col("a").alias("key")).union(candidates.select("b")).union(big.select("key")).distinct()
    wanted = sets.select("key", "id").join(needed, "key", "left_semi")
    again = source.join(wanted.select(F.col("key").alias("k"), F.col("id").alias("i")), (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("i")), "left_semi")
    full = store(_sets(again, ["key"], None).dropDuplicates(["key"]), "near-full")
    verified = store(_verified(candidates, full), "near-verified")
    counts = big.groupBy("path").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    cut = (
        big.join(counts, "path")
        .join(shared, "key")
        .join(full.select("key", "hashes"), "key")
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("block", "other"))
        .withColumn("second", F.greatest("block", "other"))
        .select("path", "first", "second", "block", "key", "paths", "hashes")
    )
    found = store(
        cut.groupBy("path", "first", "second").applyInPandas(_block, "key binary, root binary, links long"), "near-blocks"
    )
    edges = verified.union(found.where(F.col("key") != F.col("root")).select("root", "key"))
    links = (
        verified.select(F.col("a").alias("key"), F.lit(1).cast("long").alias("links"))
        .union(verified.select("b", F.lit(1).cast("long")))
        .union(found.select("key", "links"))
        .groupBy("key")
        .agg(F.sum("links").alias("links"))
    )
    labels = components(edges)
    named = sets.select("key", "id").join(labels, "key", "left").select("key", "id", F.coalesce("label", "key").alias("label"))
    classes = named.groupBy("label").agg(F.min("id").alias("class_id"))
    by_text = named.join(classes, "label").join(links, "key", "left").select("key", "class_id", F.coalesce("links", F.lit(0)).alias("n_links"))
    worded = with_words.select("id", "key").join(by_text, "key").select("id", "key", "class_id", "n_links")
    bare = rows.where(F.col("n") == 0).select("id", "key", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return worded.union(bare).withColumnRenamed("id", id_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the row with the smallest id.

    Rows that repeat both id and text are one row; rows without words all stay otherwise.
    """
    kept = docs.columns
    own, text_key = free_name(kept, "text_key"), F.unhex(F.md5(text_col))
    found = near_duplicates(docs.select(id_col, text_col), id_col, text_col)
    gone = (
        found.where(~F.col(id_col).eqNullSafe(F.col("class_id")))
        .select(F.col(id_col).alias("gone_id"), F.col("key").alias("gone_key"))
        .distinct()
    )
    rows = docs.withColumn(own, text_key)
    return (
        rows.join(gone, rows[id_col].eqNullSafe(gone["gone_id"]) & (rows[own] == gone["gone_key"]), "left_anti")
        .dropDuplicates([id_col, own])
        .select(*kept)
    )
