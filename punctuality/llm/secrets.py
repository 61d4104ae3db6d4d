"""Secret scans over an incremental ledger of blobs.

Every historical version of every path is content-addressed by the SHA-256 of its text. Only pairs
of a blob and a rule version that the ledger doesn't hold are scanned; findings are joined back to
all paths with that blob. Everything is DataFrame expressions: a match's place follows from the
lengths of what stands between the matches.

Cases: a null text is the empty blob. Rows without a path and repeated rows are versions like any
other. An empty table gives no rows. Ties of spans at one place go by the order of the rules. Only
the named columns are read. A blob without findings is in the ledger too, as it has been scanned.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int
    least: int


def any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(any_case, ("password", "passwd", "secret", "token")), any_case("api") + "_?" + any_case("key")])

# Fixed values of the contract. Runs of one class need no second look at their length: the longest
# run is the match, so the least length can stand in the pattern.
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)


def rule_version(rules: tuple[Rule, ...]) -> str:
    return f"{zlib.crc32(repr(rules).encode()):08x}"


def spans_of(text: Column, rule: Rule, place: int) -> Column:
    """Array of (start, place of the rule, kind, end) of a rule's matches; code points.

    A lambda evaluates what it refers to for each element, so the three searches are bound to a name
    first. Starts are running sums; as an array that grows is copied, they grow in blocks.
    """
    pattern = F.lit(rule.pattern)
    lengths = lambda xs: F.transform(xs, F.length)
    whole = lengths(F.regexp_extract_all(text, pattern, F.lit(0)))
    kept = F.array().cast("array<int>") if rule.group == 0 else lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group)))
    searched = F.struct(lengths(F.split(text, rule.pattern, -1)).alias("gap"), whole.alias("whole"), kept.alias("kept"))

    def span(at: Column, x: Column) -> Column:
        start = at + x["gap"]
        good = x["whole" if rule.group == 0 else "kept"] >= rule.least
        return F.struct(
            start.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"),
            (start + x["whole"]).alias("end"), good.alias("good"),
        )

    def in_block(sofar: Column, block: Column) -> Column:
        none = F.struct(sofar["at"].alias("at"), F.array().cast(_SPANS).alias("spans"))
        return F.aggregate(block, none, lambda a, x: F.struct(
            (a["at"] + x["gap"] + x["whole"]).alias("at"), F.concat(a["spans"], F.array(span(a["at"], x))).alias("spans")
        ))

    def add_block(sofar: Column, block: Column) -> Column:
        return bound(in_block(sofar, block), lambda made: F.struct(
            made["at"].alias("at"), F.concat(sofar["blocks"], F.array(made["spans"])).alias("blocks")
        ))

    def placed(found: Column) -> Column:
        steps = F.arrays_zip(found["gap"].alias("gap"), found["whole"].alias("whole"), found["kept"].alias("kept"))

        def in_blocks(xs: Column) -> Column:
            # The text ends with a gap, which no match follows.
            n = F.size(xs) - 1
            blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda i: F.slice(xs, i * BLOCK + 1, F.least(F.lit(BLOCK), n - i * BLOCK)))
            none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("blocks"))
            return F.flatten(F.aggregate(blocks, none, add_block)["blocks"])

        return bound(steps, in_blocks)

    found = F.filter(bound(searched, placed), lambda s: s["good"])
    # Most texts have no match, and then one search is all they need.
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(_SPANS))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, for which ``value`` is evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


BLOCK = 256  # matches whose spans are gathered in one array before it is copied
_SPANS = "array<struct<start:int,place:int,kind:string,end:int,good:boolean>>"


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def blobs(versions: DataFrame, text_col: str) -> DataFrame:
    """Each distinct text once, with its address. Copies meet before they are shuffled."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return versions.select(blob_of(F.col(text_col)).alias("blob"), text.alias("text")).groupBy("blob").agg(
        F.first("text").alias("text")
    )


def scan(blob_table: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows: the findings in blobs that this rule version has not seen."""
    version = rule_version(rules)
    if ledger is not None:
        seen = ledger.filter(F.col("rules") == version).select("blob")
        blob_table = blob_table.join(seen, "blob", "left_anti")
    text = F.col("text")
    found = blob_table.select(
        "blob", F.array_sort(F.concat(*[spans_of(text, r, i) for i, r in enumerate(rules)])).alias("spans")
    )
    joined = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
    )))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(r.kind) for r in rules]
    return found.select("blob", F.lit(version).alias("rules"), *counts, joined.alias("spans"))


def findings(
    versions: DataFrame, path_col: str, text_col: str,
    ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Every version of every path with its blob and that blob's findings.

    ``ledger`` holds what earlier runs of :func:`scan` gave; only other blobs are scanned now.
    """
    new = scan(blobs(versions, text_col), ledger, rules)
    return joined_back(versions, path_col, text_col, new if ledger is None else new.unionByName(
        ledger.filter(F.col("rules") == rule_version(rules))
    ), rules)


def joined_back(
    versions: DataFrame, path_col: str, text_col: str, known: DataFrame, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The findings of ``known`` blobs at every path that has them."""
    known = known.drop("rules")  # no filter on the spans: it would sink below them and search twice
    paths = versions.select(F.col(path_col).alias("path"), blob_of(F.col(text_col)).alias("blob"))
    counts = [F.coalesce(f"n_{r.kind}", F.lit(0).cast("bigint")).alias(f"n_{r.kind}") for r in rules]
    spans = F.coalesce("spans", F.lit(""))
    return paths.join(known, "blob", "left").select(
        "path", *counts, F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"),
        F.hex("blob").alias("blob"),
    )


def read_ledger(spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame | None:
    """What runs of this rule version have found below ``path``; none before the first."""
    try:
        return spark.read.parquet(f"{path}/{rule_version(rules)}").withColumn("rules", F.lit(rule_version(rules)))
    except AnalysisException as cause:
        if cause.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def findings_by_ledger(
    versions: DataFrame, path_col: str, text_col: str, ledger_path: str, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """:func:`findings` from the ledger below ``ledger_path``, after the blobs that it lacks were
    scanned and added. A run that breaks off adds nothing, and the next one scans the same blobs."""
    spark = versions.sparkSession
    new = scan(blobs(versions, text_col), read_ledger(spark, ledger_path, rules), rules)
    new.drop("rules").write.mode("append").parquet(f"{ledger_path}/{rule_version(rules)}")
    known = read_ledger(spark, ledger_path, rules).filter("spans <> ''")  # what holds nothing needs no join
    return joined_back(versions, path_col, text_col, known, rules)
