"""URL filters: given host and path rules, and rules mined from labelled URLs by FP-growth.

A labelled URL is a transaction of its tokens (host labels, path segments, suffix) and its
label. FP-growth finds the token combinations that come with a label more often than its base
rate explains; how many URLs that takes is a count, not a share of the table. Tokens that occur
in the same labelled URLs are one item, as no combination tells them apart. A rule is indexed
under its rarest item, so a URL looks up its items and checks the few rules found there for the
rest of theirs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadvane.llm.common import ascii_lower, store

#: Standard deviations of the lower bound of a confidence; the least part of the way from the
#: label's base rate to 1 that this bound goes; and the bound that is enough at any base rate.
DEVIATIONS, GAIN, ENOUGH = 3.0, 0.2, 0.9
BLOCK, ALLOW = "label=block", "label=allow"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for null or without ``://``."""
    start = F.instr(url, "://")
    after = F.when(start > 0, F.substr(url, start + 3))
    host = F.coalesce(ascii_lower(F.regexp_substr(after, F.lit("^[^/?#]+"))), F.lit(""))
    path = F.coalesce(F.regexp_extract(after, r"^[^/?#]*(/[^?#]*)", 1), F.lit(""))
    return host, path


def given_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits as a struct of rule and verdict, else null.

    The rules are part of the expression; a list of many thousands belongs in a table.
    """
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    # the longest is tested last, so that it stands outermost
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        within = (host == rule.host) | host.endswith("." + rule.host)
        fits = within & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def tokens(host: Column, path: Column) -> Column:
    """Distinct tokens: the host's labels, the path's segments, and the last segment's suffix."""
    labels = F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("host="), x))
    parts = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), lambda x: F.concat(F.lit("path="), x))
    suffix = F.regexp_extract(path, r"\.([^./]+)$", 1)
    ends = F.when(suffix != "", F.array(F.concat(F.lit("suffix="), suffix))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(labels, parts, ends))


def least_bound(rate: float) -> float:
    """The lower bound of the confidence that a rule for a label of this base rate needs."""
    return min(rate + GAIN * (1 - rate), ENOUGH)


def least_count(rate: float) -> int:
    """URLs that a combination needs with the label, at least; so many without exception suffice."""
    bound = least_bound(rate)
    return math.ceil(DEVIATIONS**2 * bound / (1 - bound) - 1e-9)


def lower_bound(share: Column, n: Column) -> Column:
    """Wilson's lower bound of a share seen in n cases."""
    z = DEVIATIONS**2 / n
    return (share + z / 2 - F.sqrt(z * (share * (1 - share) + z / 4))) / (1 + z)


def mine(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rules (need, key, verdict, confidence, n, strength) and items (token, item).

    ``labelled`` has tokens and blocked. need holds the items of a combination, key the rarest
    of them, n its URLs, and strength how far the lower bound of its confidence goes from the
    base rate of the verdict to 1. Only items of a rule are returned. Without labelled rows there
    are no rules. The driver holds the items of ``least_count`` URLs, as FP-growth does.
    """
    baskets = store(labelled.select(F.monotonically_increasing_id().alias("row"), "tokens", "blocked"), "url-baskets")
    rows, blocked = baskets.agg(F.count("*"), F.count_if("blocked")).first()
    rates = {BLOCK: blocked / max(rows, 1), ALLOW: (rows - blocked) / max(rows, 1)}
    least = {label: least_count(rate) for label, rate in rates.items()}
    one = baskets.select("row", "blocked", F.explode("tokens").alias("token"))
    # a token's rows, by number and two hashes, are its item; the rarest item sorts first
    item = F.concat_ws("-", F.lpad(F.col("n").cast("string"), 19, "0"), F.hex("x"), F.hex("y"))
    items = store(
        one.groupBy("token")
        .agg(
            F.count("*").alias("n"),
            F.count_if("blocked").alias("blocked"),
            F.bit_xor(F.xxhash64("row")).alias("x"),
            F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y"),
        )
        # no combination has more URLs of a label than each of its tokens
        .where((F.col("blocked") >= least[BLOCK]) | (F.col("n") - F.col("blocked") >= least[ALLOW]))
        .select("token", item.alias("item")),
        "url-items",
    )
    label = F.when(F.col("blocked"), BLOCK).otherwise(ALLOW)
    held = store(
        one.join(items, "token").groupBy("row", "blocked").agg(F.collect_set("item").alias("items"))
        .select(F.array_append("items", label).alias("items")),
        "url-transactions",
    )
    total = held.count()
    support = min(1.0, (min(least.values()) - 0.5) / max(total, 1))
    confidence = min(map(least_bound, rates.values()))
    found = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(held).associationRules.where(
        F.col("consequent")[0].isin(BLOCK, ALLOW)
        & ~F.arrays_overlap("antecedent", F.array(F.lit(BLOCK), F.lit(ALLOW)))
    )

    def of_label(values: dict[str, float]) -> Column:
        return F.when(F.col("consequent")[0] == BLOCK, F.lit(values[BLOCK])).otherwise(F.lit(values[ALLOW]))

    rate, bound = of_label(rates), of_label({label: least_bound(r) for label, r in rates.items()})
    rules = store(
        found.withColumn("n", F.round(F.col("support") * total / F.col("confidence")))
        .withColumn("low", lower_bound(F.col("confidence"), F.col("n")))
        .where(F.col("low") >= bound - 1e-9)
        .select(
            F.array_sort("antecedent").alias("need"),
            F.array_min("antecedent").alias("key"),
            F.when(F.col("consequent")[0] == BLOCK, "block").otherwise("allow").alias("verdict"),
            "confidence",
            F.col("n").cast("long").alias("n"),
            ((F.col("low") - rate) / F.greatest(1 - rate, F.lit(1e-9))).alias("strength"),
        ),
        "url-rules",
    )
    return rules, items.join(rules.select(F.explode("need").alias("item")).distinct(), "item", "left_semi")


def judge(
    pages: DataFrame, labels: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """id, host, path, rule (null if none fits) and verdict of every page.

    ``labels`` has id and blocked. A page that no given rule fits gets the verdict of the
    strongest mined rule that it meets, block before allow at a tie, and is allowed if there is
    none. Every row gives one row; null and malformed URLs have no tokens and are
    allowed. Rows of one URL are judged once and alike.
    """
    host, path = split_url(F.col(url_col))
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    named = named.withColumn("given", given_rule(F.col("host"), F.col("path"), rules))
    known = named.join(labels.where(F.col("id").isNotNull()), "id").select(tokens(F.col("host"), F.col("path")).alias("tokens"), "blocked")
    mined, items = mine(known)
    open_urls = named.where(F.col("given").isNull()).select("host", "path").distinct()
    met = (
        open_urls.select("host", "path", F.explode(tokens(F.col("host"), F.col("path"))).alias("token"))
        .join(items, "token")
        .groupBy("host", "path")
        .agg(F.collect_set("item").alias("items"))
        .select("host", "path", "items", F.explode("items").alias("key"))
        .join(mined, "key")
        .where(F.size(F.array_except("need", "items")) == 0)
        .groupBy("host", "path")
        .agg(F.max(F.struct("strength", "verdict")).alias("best"))
    )
    judged = met.select("host", "path", F.col("best.verdict").alias("mined"))
    return named.join(judged, ["host", "path"], "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("given.rule").alias("rule"),
        F.coalesce("given.verdict", "mined", F.lit("allow")).alias("verdict"),
    )
