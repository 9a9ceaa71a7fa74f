"""Mixing sources to target weights, with a bound on how often a source is repeated.

Targets follow by capped water-filling: every source gets its weight's share of the total,
a source above ``max_epochs`` times its size stays at that bound, and what it leaves is shared
again by weight until no source is above. The fixed point is computed in closed form: with the
sources in order of bound / weight, the clamped ones are a prefix.

A source of target t and size s is taken floor(t / s) whole times. The rest is a fractional
repetition: documents follow in the order of a seeded hash of their id until the rest is used
up; then the documents (two at most) whose sizes come nearest to what is still missing are
added. The cut is found by running totals over hash prefixes, so that no task holds a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadvane.llm.common import PLAIN_WORD, free_name, store

#: Hex digits of the seeded hash that one refinement of the cut reads, and refinements.
DIGITS, LEVELS = 3, 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(PLAIN_WORD)).cast("long"), F.lit(0).cast("long"))


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...]) -> DataFrame:
    """Weights that repeat along the sources in code-point order, the null source last.

    One row per source is sorted in one task; a corpus has few sources.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(float(w)) for w in cycle])
    return sources.select("source", F.get(values, rank % len(cycle)).alias("weight"))


def water_fill(sizes: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Targets of (source, source_size, weight): ``share`` of all sizes, capped.

    A weight must be positive. If all caps together are below the total, every source is at
    its cap.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (
        sizes.withColumn("cap", cap)
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(after))
        .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("level", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"])
        .select(
            "source",
            "source_size",
            F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"),
        )
    )


def _prefix_cut(units: DataFrame, need: DataFrame) -> DataFrame:
    """Per source the hash below which units fit into ``need``, and what is then missing.

    units: source_key, mark, size; need: source_key, need. Refines a bin of hash prefixes level
    by level; the last bin holds about one unit in 16 ** (DIGITS * LEVELS).
    """
    state = need.select("source_key", "need", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("used"))
    rest = units
    for level in range(LEVELS + 1):
        last = level == LEVELS
        digits = F.col("mark") if last else F.substring("mark", 1, DIGITS * (level + 1))
        bins = (
            rest.join(state.select("source_key", "prefix"), "source_key")
            .where(F.col("mark").startswith(F.col("prefix")))
            .groupBy("source_key", digits.alias("bin"))
            .agg(F.sum("size").alias("size"))
        )
        running = F.sum("size").over(Window.partitionBy("source_key").orderBy("bin"))
        cut = (
            bins.join(state, "source_key")
            .withColumn("upto", F.col("used") + running)
            .groupBy("source_key", "need")
            .agg(
                F.min(F.when(F.col("upto") > F.col("need"), F.struct("bin", (F.col("upto") - F.col("size")).alias("used")))).alias("over"),
                F.max("upto").alias("all"),
            )
        )
        # a source without a bin beyond its need is used up: the mark after all hashes
        state = store(
            cut.select(
                "source_key",
                "need",
                F.coalesce(F.col("over.bin"), F.lit("~")).alias("prefix"),
                F.coalesce(F.col("over.used"), F.col("all")).alias("used"),
            ),
            "mix-cut",
        )
    return state


def _nearest(units: DataFrame, state: DataFrame) -> DataFrame:
    """Per source the unit left whose size comes nearest to what is missing, if it helps."""
    off = F.abs(F.col("size") - F.col("need") + F.col("used"))
    best = (
        units.join(state, "source_key")
        .where((F.col("mark") >= F.col("prefix")) & ~F.array_contains("added", F.col("mark")))
        .where((F.col("size") > 0) & (off < F.col("need") - F.col("used")))
        .groupBy("source_key")
        .agg(F.min(F.struct(off.alias("off"), "mark", "size")).alias("best"))
    )
    return store(
        state.join(best, "source_key", "left").select(
            "source_key",
            "need",
            "prefix",
            (F.col("used") + F.coalesce(F.col("best.size"), F.lit(0))).alias("used"),
            F.concat("added", F.when(F.col("best").isNotNull(), F.array("best.mark")).otherwise(F.array().cast("array<string>"))).alias("added"),
        ),
        "mix-fill",
    )


def mix(
    docs: DataFrame,
    weights: DataFrame,
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs`` with size, source_size, target and repeats, the times a row is taken.

    ``weights`` has source and weight. Null sources are one source; a null text has size 0. Rows
    with equal ids (null ids too) within a source are taken or left together. A source of size 0
    is not taken. An empty table gives no rows. Existing columns of the added names are replaced.
    """
    added = ["size", "source_size", "target", "repeats"]
    kept = [c for c in docs.columns if c.lower() not in added]
    key, mark, cut = (free_name([*docs.columns, *added], n) for n in ("source_key", "mark", "cut"))
    sized = docs.select(
        *kept,
        word_count(F.col(text_col)).alias("size"),
        # a null source is a key of its own: the prefix keeps it apart from any text
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias(key),
        F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias(mark),
    )
    units = store(
        sized.select(F.col(key).alias("source_key"), F.col(mark).alias("mark"), "size", F.col(source_col).alias("source"))
        .groupBy("source_key", "source", "mark")
        .agg(F.sum("size").alias("size")),
        "mix-units",
    )
    totals = units.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    keyed = weights.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source_key"), "weight"
    )
    targets = store(
        water_fill(
            totals.join(keyed, "source_key").select(F.col("source_key").alias("source"), "source_size", "weight"),
            share,
            max_epochs,
        ).select(
            F.col("source").alias("source_key"),
            "source_size",
            "target",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("whole"),
        ),
        "mix-targets",
    )
    need = targets.select("source_key", (F.col("target") - F.col("whole") * F.col("source_size")).alias("need"))
    state = _prefix_cut(units, need).withColumn("added", F.array().cast("array<string>"))
    for _ in range(2):
        state = _nearest(units, state)
    # one column beside those of the documents, whatever their names are
    plan = targets.join(state, "source_key", "left").select(
        F.col("source_key").alias(key), F.struct("source_size", "target", "whole", "prefix", "added").alias(cut)
    )
    plan_of = lambda name: F.col(f"{cut}.{name}")
    extra = (F.col(mark) < plan_of("prefix")) | F.array_contains(plan_of("added"), F.col(mark))
    return sized.join(plan, key).select(
        *kept,
        "size",
        plan_of("source_size").alias("source_size"),
        plan_of("target").alias("target"),
        (plan_of("whole") + F.when(extra, 1).otherwise(0)).cast("int").alias("repeats"),
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """One row for each time a document is taken, without the columns of the mix."""
    kept = [c for c in mixed.columns if c not in ("size", "source_size", "target", "repeats")]
    copy = free_name(kept, "copy")
    return (
        mixed.where(F.col("repeats") > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("repeats"))))
        .select(*kept)
    )
