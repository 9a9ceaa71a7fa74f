"""Secret scans over the history of files, with a ledger of what has been scanned.

Every version of every path is addressed by the SHA-256 of its content, its blob. The ledger is
a Parquet folder with a row per scan of a blob: the rules by name and version, and the spans
they found. A scan looks up which pairs of blob and rule version the ledger lacks, reads one
copy of those blobs, runs only the missing rules and appends the outcome, found or not. The
findings are joined back from the blobs to all paths that hold them, so a copied, restored or
unchanged file costs its hash and nothing more, and a new rule version runs alone.

A ledger row is true by itself, so rows of a run that broke off may stay, and rows of two runs
for one blob merge. Copies of a blob are dropped where they are read, before the shuffle by
blob, so a content with a third of all rows meets in one task with one row per input task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadvane.llm.common import store
from loadvane.session import ship_package

LEDGER = "blob binary, rules array<string>, spans array<struct<rule:string,begin:long,end:long>>"


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if ``group`` has ``least`` characters.

    Matches are leftmost and do not overlap; too short ones are passed over as a whole. A change
    of the pattern needs another ``version``.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns every scan reports.
BASE = (
    Rule(
        "assign",
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)

# Published forms of keys and tokens.
FORMS = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,400}\.eyJ[A-Za-z0-9_-]{8,4000}\.[A-Za-z0-9_-]{16,}"),
    Rule("hosted_git", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("live_key", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s/:@]{1,64}:([^\s/:@]{4,64})@", group=1),
)


def _search(rule: Rule) -> re.Pattern[str]:
    """The rule's pattern; one class repeated is searched at its full least length at once."""
    repeated = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    if repeated and not rule.group and rule.least:
        # the first place with enough characters begins the run, as shorter runs do not count
        return re.compile(f"{repeated[1]}{{{rule.least},}}")
    return re.compile(rule.pattern)


def spans_of(text: str, rules: Sequence[Rule]) -> list[dict]:
    """Spans (code points, end exclusive) of the whole matches of the rules in a text."""
    return [
        {"rule": rule.name, "begin": found.start(), "end": found.end()}
        for rule in rules
        for found in _search(rule).finditer(text)
        if found.end(rule.group) - found.start(rule.group) >= rule.least
    ]


def blob_of(text: Column) -> Column:
    """The address of a content; a null text is the empty one."""
    return F.unhex(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """One row per blob with all rule versions that have run on it and their spans.

    A folder that does not exist yet is an empty ledger.
    """
    try:
        rows = spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], LEDGER)
    return rows.groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"),
        F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
    )


def record(versions: DataFrame, rules: Sequence[Rule], ledger: str, text_col: str = "text") -> None:
    """Scan what the ledger lacks of ``versions`` and append it.

    ``rules`` are told apart by kind and version; two rules of one name are an error.
    """
    names = [rule.name for rule in rules]
    if len(set(names)) < len(names):
        raise ValueError("two rules share kind and version")
    ship_package(versions.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_name = {rule.name: rule for rule in rules}
        schema = pa.schema(
            [
                ("blob", pa.binary()),
                ("rules", pa.list_(pa.string())),
                ("spans", pa.list_(pa.struct([("rule", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))),
            ]
        )
        for batch in batches:
            todo = batch.column("todo").to_pylist()
            # texts are taken one by one, so that a batch is not held twice
            found = [spans_of(text.as_py(), [by_name[n] for n in todo[i]]) for i, text in enumerate(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), batch.column("todo").cast(schema.field("rules").type), pa.array(found, schema.field("spans").type)],
                schema=schema,
            )

    text = F.coalesce(F.col(text_col), F.lit(""))
    contents = versions.select(blob_of(text).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    known = read_ledger(versions.sparkSession, ledger).select("blob", F.col("rules").alias("run"))
    missing = F.array_except(F.array(*map(F.lit, names)), F.coalesce("run", F.array().cast("array<string>")))
    unseen = contents.join(known, "blob", "left").select("blob", "text", missing.alias("todo")).where(F.size("todo") > 0)
    unseen.mapInArrow(run, LEDGER).write.mode("append").parquet(ledger)


def scan(
    versions: DataFrame,
    rules: Sequence[Rule],
    ledger: str,
    keep: Sequence[str],
    text_col: str = "text",
) -> DataFrame:
    """The ``keep`` columns of every version and ``findings`` of the given rules in its content.

    ``versions`` has a row per path and version of its history, of whatever columns; ``findings``
    is an array of kind, begin and end (code points, end exclusive) ordered by begin, then by the
    place of the kind among ``rules``, then end. Null and empty texts have no findings; every
    row gives one row, equal rows stay apart. What the ledger lacks is scanned and appended first.
    """
    record(versions, rules, ledger, text_col)
    place = {rule.name: at for at, rule in enumerate(rules)}
    number = F.coalesce(*(F.when(F.col("s.rule") == name, at) for name, at in place.items()))
    found = (
        spread(read_ledger(versions.sparkSession, ledger))
        .withColumn("place", number)
        .where("place is not null")
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list(F.struct("s.begin", "place", "s.end"))).alias("found"))
    )
    # stored, so that nothing stands between the shuffles and the join and it can split a hot blob
    listed = store(found, "findings")
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    # a stored list of the addresses: its join is small, and texts are not read for it
    paths = store(versions.select(*(F.col(c).alias(f"keep{i}") for i, c in enumerate(keep)), blob_of(F.col(text_col)).alias("blob")), "versions")
    findings = F.transform(
        F.coalesce("found", F.array().cast("array<struct<begin:long,place:int,end:long>>")),
        lambda x: F.struct(F.get(kinds, x["place"]).alias("kind"), x["begin"].alias("begin"), x["end"].alias("end")),
    )
    return paths.join(listed, "blob", "left").select(
        *(F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)), findings.alias("findings")
    )


def spread(ledger: DataFrame) -> DataFrame:
    """A row per span of a blob; blobs without spans have none."""
    return ledger.select("blob", F.explode("spans").alias("s"))


def joined(findings: Column) -> Column:
    """Findings as text: kind:begin:end, comma-joined."""
    parts = ("kind", "begin", "end")
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", *(x[p].cast("string") for p in parts))), ",")


def among(kinds: Sequence[str]) -> Column:
    """The findings of some kinds, in their order."""
    return F.filter("findings", lambda x: reduce(Column.__or__, (x["kind"] == kind for kind in kinds)))
