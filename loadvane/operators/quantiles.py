"""Exact quantiles by group, safe for a group that holds most of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadvane.session import settle

ACCURACY = 10_000
#: Different values among which one task ranks, and bits of the digit by which more are cut down.
SLICE, DIGIT = 65_536, 16
# Bracket half-widths as shares of a group's ranks, tightest first; all far beyond the sketch's error.
SLACKS = (10 / ACCURACY, 100 / ACCURACY)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    extras: dict[str, Callable[[Column], Column]] | None = None,
    slice_size: int = SLICE,
) -> DataFrame:
    """One row per key: linearly interpolated quantiles, named by ``probabilities``.

    A sketch of bounded size first brackets every quantile to a sliver of its group's
    ranks, at least ten times the sketch's guaranteed error on each side; a group of a
    few hundred rows is its own bracket. The sketch is stored, one row per group, and while it
    is small enough to broadcast, no row is shuffled by its group. Rows below a bracket are only counted, before
    the shuffle; rows above are skipped; the sliver is grouped by value, stored, and where
    it has more than ``slice_size`` values cut down by radix selection before one task
    ranks it. The result does not depend on the sketch: a rank outside its bracket stops
    the job instead of answering wrongly.

    ``extras`` are further aggregates of the value, taken
    in the same pass as the sketch. Null values and null keys take no part.
    """
    keys, extras = list(keys), extras or {}
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).na.drop()
    # one constant key makes the ungrouped case the same plan
    group = keys or ["_everything"]
    if not keys:
        rows = rows.withColumn("_everything", F.lit(0))

    bounds = [
        bound
        for slack in SLACKS
        for p in probabilities.values()
        for bound in (max(p - slack, 0.0), min(p + slack, 1.0))
    ]
    sketch = rows.groupBy(*group).agg(
        F.count("_v").alias("_n"),
        F.percentile_approx("_v", bounds, ACCURACY).alias("_cuts"),
        *[aggregate(F.col("_v")).alias(name) for name, aggregate in extras.items()],
    )
    # stored, so that the join is planned with its real size: few groups go to where the rows are,
    # and no group's rows are sorted in one task
    sketch = settle(sketch, "quantile-sketch")

    def cut(at: int) -> Column:
        # the slack must span some ranks; in a group too small for that there is no bracket
        chosen = F.when(F.col("_n") * SLACKS[0] >= 2, F.get("_cuts", F.lit(at)))
        return chosen.when(F.col("_n") * SLACKS[1] >= 2, F.get("_cuts", F.lit(2 * len(probabilities) + at)))

    brackets = F.array(
        *[
            F.struct(F.lit(i).alias("which"), cut(2 * i).alias("low"), cut(2 * i + 1).alias("high"))
            for i in range(len(probabilities))
        ]
    )
    # the extras are constant per group and ride along
    carried = [F.max(name).alias(name) for name in extras]
    low, high, v = F.col("_q.low"), F.col("_q.high"), F.col("_v")
    counted = (
        rows.join(sketch.select(*group, "_n", *extras, brackets.alias("_brackets")), group)
        .select(*group, "_n", "_v", *extras, F.explode("_brackets").alias("_q"))
        .filter(high.isNull() | (v <= high))
        .groupBy(*group, F.col("_q.which").alias("_which"), F.when(low.isNull() | (v >= low), v).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"), F.max("_n").alias("_n"), *carried)
    )
    share = F.get(F.lit(list(map(float, probabilities.values()))), F.col("_which"))
    place = share * (F.col("_n") - 1)
    stored = settle(counted.withColumn("_place", place).drop("_n"), "quantile-slices")
    # the two neighbours of a place are looked for apart
    sides = F.array(F.floor("_place"), F.ceil("_place"))
    rows = stored.select(*group, "_which", "_v", "_c", F.posexplode(sides).alias("_side", "_rank"))
    found = _at_rank(narrow(rows, [*group, "_which", "_side"], slice_size), [*group, "_which", "_side"])
    below = F.max(F.when(F.col("_side") == 0, F.col("_v"))).alias("_below")
    above = F.max(F.when(F.col("_side") == 1, F.col("_v"))).alias("_above")
    neighbours = found.groupBy(*group, "_which").agg(below, above)
    # one place and the extras per slice
    about = stored.groupBy(*group, "_which").agg(F.max("_place").alias("_place"), *carried)
    below, above, place = F.col("_below"), F.col("_above"), F.col("_place")
    missed = F.raise_error(F.lit("quantile outside its bracket")).cast("double")
    answered = about.join(neighbours, [*group, "_which"], "left").withColumn(
        "_answer",
        F.when(below.isNull() | above.isNull(), missed)
        .when(below == above, below)  # also where both are infinite
        .otherwise(below + (above - below) * (place - F.floor(place))),
    )
    wide = answered.groupBy(*group).agg(
        *[F.max(F.when(F.col("_which") == i, F.col("_answer"))).alias(name) for i, name in enumerate(probabilities)],
        *carried,
    )
    return wide.select(*keys, *extras, *probabilities)


def ordered_bits(v: Column) -> Column:
    """A long that orders like the double: its bits, those of negative numbers turned over.

    Both zeros are one value, NaN is the largest; null, which stands for rows counted below,
    is the smallest.
    """
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), v + F.lit(0.0)).cast("long")
    turned = F.when(bits < 0, bits.bitwiseXOR(F.lit(2**63 - 1))).otherwise(bits)
    return F.coalesce(F.when(v.isNotNull(), turned), F.lit(-(2**63)))


def narrow(rows: DataFrame, keys: Sequence[str], slice_size: int = SLICE) -> DataFrame:
    """Radix selection: rows of each key cut down to at most ``slice_size`` around its rank.

    ``rows`` hold different values ``_v`` with their counts ``_c`` and the rank ``_rank`` that
    the key asks for, counted from 0 over repeated values. Per step the counts are summed by one
    more digit of the ordered bits; only the values with the digits of the asked one stay, and
    the rank counts from their first on. Every step is a partial aggregation and ranks at most
    2^16 digits of a key in one task; after four the value is known to the bit.
    """
    rows = rows.withColumn("_bits", ordered_bits(F.col("_v")))
    largest = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_values")).agg(F.max("_values")).first()[0] or 0
    shift = 64
    while largest > slice_size and shift:
        shift -= DIGIT
        digits = rows.withColumn("_digits", F.shiftright("_bits", shift))
        sums = digits.groupBy(*keys, "_rank", "_digits").agg(F.sum("_c").alias("_held"), F.count(F.lit(1)).alias("_values"))
        upto = F.sum("_held").over(Window.partitionBy(*keys).orderBy("_digits"))
        chosen = (
            sums.withColumn("_before", upto - F.col("_held"))
            .filter((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_held")))
            .select(*keys, "_digits", "_before", "_values")
        )
        chosen = settle(chosen, "radix-digits")
        kept = digits.join(chosen.drop("_values"), [*keys, "_digits"])
        rows = settle(kept.withColumn("_rank", F.col("_rank") - F.col("_before")).drop("_digits", "_before"), "radix-slices")
        largest = chosen.agg(F.max("_values")).first()[0] or 0
    return rows.drop("_bits")


def _at_rank(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The value at ``_rank`` of each key, out of a bounded number of values per key."""
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_v"))
    upto = F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.withColumn("_upto", upto)
        .filter((F.col("_upto") - F.col("_c") <= F.col("_rank")) & (F.col("_rank") < F.col("_upto")))
        .select(*keys, "_v")
    )
