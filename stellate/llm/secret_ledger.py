"""Secret scans over an incremental blob ledger, with DataFrame operators only.

Every version of a file is named by the digest of its text (its blob).  The
ledger holds, per blob, the rules that it was scanned with (kind and rule
version) and the spans found.  A scan takes one row of each blob, leaves out
the pairs of blob and rule version that the ledger has, scans the rest,
appends them to the ledger, and joins the ledger's findings back to all paths
that hold the blob.  A changed rule gets a new version and is then the only
one that runs again.

Places come from two native functions of one pattern: ``split`` gives the
gaps between matches and ``regexp_extract_all`` the matches, so running sums
of their lengths are the places (in code points).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stellate.llm.common import join_grouped

#: the ledger's columns
SPANS = "array<struct<start: bigint, place: int, kind: string, rule: string, end: bigint>>"
LEDGER = f"blob string, rules array<string>, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose group ``group``
    has at least ``least`` characters; shorter ones are dropped after matching."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# fixed values: the kinds of secrets, in the order in which equal starts are listed
RULES = (
    Rule("assign", 1, r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; empty if none was written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def _search(rule: Rule) -> tuple[str, str]:
    """The pattern, and one that only texts with a kept match contain.

    A rule whose match is a plain run needs no look at short runs."""
    if rule.group == 0 and rule.pattern.endswith("]+"):
        body = rule.pattern[:-1]
        fixed = len(body[:body.rindex("[")])
        long = f"{body}{{{rule.least - fixed},}}"
        return long, long
    return rule.pattern, rule.pattern


def _matches(rule: Rule, place: int, text: Column, wanted: Column) -> Column:
    """Matches as structs (rule, nth, gap before, length, length of the group), empty unless wanted."""
    pattern, contains = _search(rule)
    p = F.lit(pattern)
    shape = "array<struct<place: int, kind: string, rule: string, least: int, gap: int, size: int, own: int>>"
    found = F.transform(
        F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, p, F.lit(0)).alias("hit"),
                     F.regexp_extract_all(text, p, F.lit(rule.group)).alias("own")),
        lambda x: F.struct(F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), F.lit(rule.key).alias("rule"),
                           F.lit(rule.least).alias("least"), F.char_length(x["gap"]).alias("gap"),
                           F.char_length(x["hit"]).alias("size"), F.char_length(x["own"]).alias("own")))
    # the last gap has no match after it
    return F.when(wanted & text.rlike(contains), found).otherwise(F.array()).cast(shape)


def _scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, spans`` of blobs with a finding.  blobs: ``blob, text, seen`` (keys of rules that are done)."""
    parts = [_matches(r, i, F.col("text"), ~F.array_contains("seen", r.key)) for i, r in enumerate(rules)]
    each = blobs.select("blob", F.posexplode(F.concat(*parts)).alias("nth", "m")).select("blob", "nth", "m.*")
    # gaps and matches of a rule follow each other; one exchange by blob serves the sums and the lists
    before = Window.partitionBy("blob", "place").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (each.filter(F.col("size").isNotNull()).repartition("blob").dropDuplicates(["blob", "nth"])
              .withColumn("end", F.sum((F.col("gap") + F.col("size")).cast("bigint")).over(before))
              .filter(F.col("own") >= F.col("least")))
    return placed.groupBy("blob").agg(F.array_sort(F.collect_list(
        F.struct((F.col("end") - F.col("size")).alias("start"), "place", "kind", "rule", "end"))).alias("spans"))


def scan_blobs(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, extra: tuple[str, ...] = ()) -> DataFrame:
    """Brings the ledger at ``ledger_path`` up to date with ``versions``
    (``path, text``) and returns ``path, blob, spans`` and the ``extra``
    columns for every path, spans sorted by start, then by the order of
    ``rules``."""
    spark = versions.sparkSession
    named = versions.select("path", F.coalesce("text", F.lit("")).alias("text"), *extra).withColumn(
        "blob", F.sha2(F.col("text").cast("binary"), 256))
    known = read_ledger(spark, ledger_path).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    keys = F.array(*[F.lit(r.key) for r in rules])
    # one path stands for each blob; only that row's text is moved
    unseen = (named.select("blob", "path").groupBy("blob").agg(F.min("path").alias("path"))
              .join(known, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
              .filter(F.size(F.array_except(keys, "seen")) > 0))
    texts = named.alias("t").join(unseen.alias("u"), F.expr("t.path <=> u.path AND t.blob = u.blob")).select(
        "t.blob", "t.text", "u.seen")
    found = _scan(texts, rules).dropDuplicates(["blob"])
    entry = unseen.select("blob", F.array_except(keys, "seen").alias("rules")).join(found, "blob", "left")
    (entry.select("blob", "rules", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))
     .write.mode("append").parquet(ledger_path))
    # the findings of the present rule versions, back to all paths
    current = (read_ledger(spark, ledger_path).filter(F.size("spans") > 0).groupBy("blob")
               .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("all"))
               .select("blob", F.filter("all", lambda s: F.array_contains(keys, s["rule"])).alias("found")))
    return (join_grouped(named.select("path", "blob", *extra), current, ["blob"], "left")
            .select("path", "blob", *extra, F.coalesce("found", F.array()).alias("spans")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, ledger_path: str, id_col: str = "doc_id", text_col: str = "text",
                 rules: tuple[Rule, ...] = RULES, key_col: str | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``n_<kind>`` of each rule,
    ``base_sha256`` and ``spans``, and ``key`` if there is a ``key_col``
    (returned as it is).

    Spans are ``kind:start:end`` in code points, end exclusive, by start and
    then by the order of the rules, comma-joined.  Null and empty texts have
    no span; equal texts are scanned once; repeated rows and null ids are
    returned as they are; an empty table gives no rows; other columns are
    ignored.
    """
    extra = ("key",) if key_col else ()
    versions = docs.select(F.col(id_col).cast("bigint").alias("path"), F.col(text_col).cast("string").alias("text"),
                           *([F.col(key_col).alias("key")] if key_col else []))
    scanned = scan_blobs(versions, ledger_path, rules, extra)

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return scanned.select(F.col("path").alias("doc_id"), *[number(r.kind) for r in rules],
                          F.sha2(listed(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
                          listed(F.col("spans")).alias("spans"), *extra)
