"""Join shapes that hold when one key carries a large share of a side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of the right rows from which a key may be hot, and parts into which its rows are dealt.
SHARE, PARTS = 1 / 64, 32


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = SHARE) -> Column:
    """An array of keys, among them all that ``share`` of the rows have; at most 1 / share.

    It is a scalar subquery: one narrow aggregation of bounded size, part of the plan that
    uses it. Every key in it occurs in ``df``; rows with a null key are left out.
    """
    key = F.struct(*keys).alias("key")
    found = df.select(*keys).na.drop().select(key).freqItems(["key"], share)
    return found.select("key_freqItems").scalar()


def left_join_dealt(
    left: DataFrame, right: DataFrame, keys: Sequence[str], share: float = SHARE, parts: int = PARTS
) -> DataFrame:
    """Left outer join in one pass over ``left``, with the hot keys of ``right`` dealt out.

    A left outer join can split a hot key of its left side, which adaptive execution does,
    but not one of its right side. Here the right rows of a possibly hot key are tagged with
    one of ``parts`` numbers by a hash of the whole row, and each left row with that key
    stands once per number. Such a key occurs on the right, so a copy without a partner is
    only a copy and goes; all other left rows stand once and keep null columns without one.
    ``right`` is read twice, once of it only its keys. Null keys have no partner.
    """
    keys = list(keys)
    hot = hot_keys(right, keys, share)
    is_hot = F.coalesce(F.array_contains(hot, F.struct(*keys)), F.lit(False))
    # "|" is no part of the names of ours, so nothing of either side is hidden
    part, mark, matched = "part|", "hot|", "matched|"
    numbers = F.when(F.col(mark), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    copies = left.withColumn(mark, is_hot).withColumn(part, F.explode(numbers))
    number = F.pmod(F.xxhash64(*right.columns), F.lit(parts)).cast("int")
    dealt = right.withColumn(part, F.when(is_hot, number).otherwise(0)).withColumn(matched, F.lit(True))
    joined = copies.join(dealt, [*keys, part], "left")
    return joined.filter(~F.col(mark) | F.col(matched).isNotNull()).drop(part, mark, matched)
