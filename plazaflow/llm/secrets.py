"""Secret scans over a ledger of blobs: a text is scanned once per rule version, wherever it appears.

Each historical version of a path is addressed by the SHA-256 of its content. The ledger
remembers which rule versions have seen a blob and what they found. A run scans one copy of
each blob for the rule versions that are new to it, appends to the ledger, and joins the
findings back to all paths. Only built-in functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from plazaflow.llm.common import scratch, written


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts when its group has at least `least` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules, in the order in which equal starts are listed. The lower
# bounds inside the second and third pattern find the same matches as the bound checked later,
# since a match takes a whole run of its characters.
BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
MORE = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE + MORE
LEDGER = "blob string, rule string, n long, spans array<struct<start:long,end:long>>"


def _pieces(text: str, rule: Rule) -> Column:
    """Lengths of what stands before each match, of the match, and of its group."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    return F.when(F.col(text).rlike(rule.pattern), F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
        F.transform(matches, F.length).alias("len"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("group")))


def scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of (blob, text, todo): one row for each blob and rule of its todo that matches."""
    parts = [
        F.when(F.array_contains("todo", r.key), F.struct(F.lit(r.key).alias("rule"), F.lit(r.least).alias("least"), _pieces("text", r).alias("pieces")))
        for r in rules
    ]
    found = blobs.select("blob", F.explode(F.array(*parts)).alias("f")).where("f.pieces is not null")
    cells = found.select("blob", "f.rule", "f.least", F.posexplode("f.pieces").alias("i", "p"))
    # the rows of a blob are together already; running sums give the offsets in one pass
    upto = Window.partitionBy("blob", "rule").orderBy("i")
    start = F.sum(F.col("p.gap").cast("long")).over(upto) + F.sum(F.coalesce("p.len", F.lit(0)).cast("long")).over(upto) - F.coalesce("p.len", F.lit(0))
    spans = cells.withColumn("start", start).where(F.col("p.len").isNotNull() & (F.col("p.group") >= F.col("least")))
    spans = spans.select("blob", "rule", F.struct("start", (F.col("start") + F.col("p.len")).alias("end")).alias("span"))
    return spans.groupBy("blob", "rule").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("span")).alias("spans"))


def read_ledger(spark: SparkSession, path: str, part: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(f"{path}/{part}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_history(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds blob and findings (array of rule, start, end) to each version; text is needed, other columns but text pass.

    The ledger folder holds `seen` (blob, rule) and `findings`; both are appended to, findings
    first, so a run that dies between is repeated and only ever repeats equal rows. A null text
    is an empty one. Rows may repeat; each gets the findings of its blob. Offsets are code points.
    """
    spark = versions.sparkSession
    keys = F.array(*[F.lit(r.key) for r in rules])
    text = F.coalesce("text", F.lit(""))
    columns = [F.col(f"`{c}`") for c in versions.columns if c != "text"]
    paths = written(versions.select(F.struct(*columns).alias("row"), F.sha2(text, 256).alias("blob")), "paths")
    seen = read_ledger(spark, ledger, "seen", "blob string, rules array<string>")
    seen = seen.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("had"))
    todo = paths.select("blob").distinct().join(seen, "blob", "left").withColumn(
        "todo", F.array_except(keys, F.coalesce("had", F.array().cast("array<string>")))).where("size(todo) > 0").select("blob", "todo")
    todo = written(todo, "unseen")
    contents = versions.select(F.sha2(text, 256).alias("blob"), text.alias("text"))
    unseen = contents.join(todo, "blob").groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))
    scan(unseen, rules).write.mode("append").parquet(f"{ledger}/findings")
    todo.select("blob", F.col("todo").alias("rules")).write.mode("append").parquet(f"{ledger}/seen")
    found = read_ledger(spark, ledger, "findings", LEDGER).where(F.col("rule").isin([r.key for r in rules]))
    found = found.dropDuplicates(["blob", "rule"]).groupBy("blob").agg(F.flatten(F.collect_list(
        F.transform("spans", lambda s: F.struct(F.col("rule").alias("rule"), s["start"].alias("start"), s["end"].alias("end"))))).alias("findings"))
    return paths.join(found, "blob", "left").select(
        "row", "blob", F.coalesce("findings", F.array().cast("array<struct<rule:string,start:bigint,end:bigint>>")).alias("findings"))


def listed(findings: str, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end by start, then by the order of the rules, joined by commas."""
    order = F.array(*[F.lit(r.key) for r in rules])
    own = F.filter(findings, lambda f: F.array_contains(order, f["rule"]))
    keyed = F.array_sort(F.transform(own, lambda f: F.struct(
        f["start"].alias("s"), F.array_position(order, f["rule"]).alias("o"), f["end"].alias("e"), f["rule"].alias("r"))))
    return F.array_join(F.transform(keyed, lambda k: F.concat_ws(
        ":", F.substring_index(k["r"], "@", 1), k["s"].cast("string"), k["e"].cast("string"))), ",")


def secret_digest(versions: DataFrame, ledger: str | None = None) -> DataFrame:
    """doc_id with its counts and spans by the base rules and by all rules."""
    scanned = scan_history(versions.select("doc_id", "text"), ledger or scratch(versions.sparkSession, "secret-ledger"))
    count = lambda r: F.size(F.filter("findings", lambda f: f["rule"] == r.key)).cast("long").alias(f"n_{r.kind}")
    return scanned.select(
        F.col("row.doc_id").alias("doc_id"), *[count(r) for r in BASE], F.sha2(listed("findings", BASE), 256).alias("base_sha256"),
        listed("findings", RULES).alias("spans"), "blob")
