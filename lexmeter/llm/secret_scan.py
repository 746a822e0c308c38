"""Secret scans with an incremental blob ledger.

Every version of a document is addressed by the SHA-256 of its text. The ledger lists
which rule, at which version of the rule, has seen which blob, and what it found there.
A scan takes each blob once, however many documents hold it, and only with rules the
ledger has not recorded for it; findings are then joined to all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmeter.sources.scratch import new_folder, written


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters; none without ``hint``."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    hint: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed values.
BASE = (
    Rule(
        "assign",
        1,
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=12,
    ),
    Rule("access", 1, r"(AKIA[A-Z0-9]+)", least=18, hint="AKIA"),
    Rule("hex", 1, r"([0-9a-f]{16,})"),
)
ADDED = (
    Rule("github", 1, r"(gh[pousr]_[A-Za-z0-9]{36,})", hint="gh"),
    Rule("pem", 1, r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)", hint="-----BEGIN "),
)
RULES = BASE + ADDED

_SCANS = "blob string, rule string"
_FINDINGS = 'blob string, rule string, kind string, `start` bigint, `end` bigint'


def address(text: Column) -> Column:
    """The content address of a text; NULL counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the ledger; an empty one is made where there is none."""
    columns = [column.strip().rsplit(" ", 1) for column in schema.split(",")]
    empty = spark.range(0).select(*(F.lit(None).cast(kind).alias(name.strip("`")) for name, kind in columns))
    empty.write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _pieces(text: str, rule: Rule) -> Column:
    """Number, length of the gap before, length and verdict of each match, from staged columns."""
    matches, gaps, values = f"_{rule.kind}", f"_{rule.kind}_gaps", f"_{rule.kind}_values"
    numbers = F.sequence(F.lit(0), F.size(matches) - 1)

    def piece(i: Column) -> Column:
        return F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.kind).alias("kind"),
            i.alias("number"),
            F.length(F.get(gaps, i)).alias("gap"),
            F.length(F.get(matches, i)).alias("size"),
            (F.length(F.get(values, i)) >= rule.least).alias("valid"),
        )

    none = F.array().cast(
        "array<struct<rule:string,kind:string,number:int,gap:int,size:int,valid:boolean>>"
    )
    return F.when(F.size(matches) > 0, F.transform(numbers, piece)).otherwise(none)


def _scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Blob, rules applied and pieces found, of blobs with ``text`` and the rules ``seen``."""
    none = F.array().cast("array<string>")
    todo = F.array_except(F.array(*(F.lit(rule.name) for rule in rules)), F.coalesce("seen", none))
    staged = blobs.withColumn("todo", todo).where(F.size("todo") > 0)
    found = {}
    for rule in rules:
        applies = F.array_contains("todo", rule.name) & F.contains("text", F.lit(rule.hint))
        matches = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
        found[f"_{rule.kind}"] = F.when(applies, matches).otherwise(none)
    staged = staged.withColumns(found)
    parts = {}
    for rule in rules:
        some = F.size(f"_{rule.kind}") > 0
        parts[f"_{rule.kind}_gaps"] = F.when(some, F.split("text", rule.pattern))
        values = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
        parts[f"_{rule.kind}_values"] = F.when(some, values)
    staged = staged.withColumns(parts)
    return staged.select("blob", "todo", F.concat(*(_pieces("text", r) for r in rules)).alias("pieces"))


def _placed(scanned: DataFrame) -> DataFrame:
    """Findings with their start and end; matches that failed count for the places of others."""
    pieces = scanned.select("blob", F.inline("pieces"))
    before = Window.partitionBy("blob", "rule").orderBy("number")
    end = F.sum(F.col("gap").cast("long") + F.col("size")).over(before)
    placed = pieces.withColumn("end", end).where("valid")
    return placed.select("blob", "rule", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def update_ledger(
    docs: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES
) -> int:
    """Scan what the ledger has not recorded; return the number of blobs scanned.

    Findings are written before the record that their blob was scanned, so a job that
    dies between the two scans the blob again and loses nothing.
    """
    spark = docs.sparkSession
    scans = _table(spark, f"{ledger}/scans", _SCANS)
    _table(spark, f"{ledger}/findings", _FINDINGS)
    seen = scans.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    versions = docs.select(address(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))
    scanned = _scan(blobs.join(seen, "blob", "left"), rules)
    scanned = written(scanned, f"{new_folder(spark)}/scanned")
    _placed(scanned).write.mode("append").parquet(f"{ledger}/findings")
    scanned.select("blob", F.explode("todo").alias("rule")).write.mode("append").parquet(f"{ledger}/scans")
    return scanned.count()


def findings(docs: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``secrets``, the ledger's findings by ``rules`` in each document, in order.

    Each has start and end in code points, and its kind; they go by start, then by the order
    of the rules. A column of the same name is replaced. Documents without any, also
    NULL and empty ones, have an empty list.
    """
    spark = docs.sparkSession
    found = spark.read.schema(_FINDINGS).parquet(f"{ledger}/findings")
    order = F.array_position(F.array(*(F.lit(rule.name) for rule in rules)), F.col("rule"))
    current = found.where(F.col("rule").isin([rule.name for rule in rules])).distinct()
    one = F.struct("start", order.alias("rank"), "kind", "end")
    by_blob = current.groupBy("blob").agg(F.array_sort(F.collect_list(one)).alias("_found"))
    # Written, so that both sides of the join come straight from a shuffle: adaptive execution
    # then splits the copies of a hot blob, which it does not beside an aggregate.
    by_blob = written(by_blob, f"{new_folder(spark)}/by_blob")
    kept = [c for c in docs.columns if c.lower() != "secrets"]
    held = docs.select(F.struct(*kept).alias("_row"), address(F.col(text)).alias("blob"))
    none = F.array().cast(by_blob.schema["_found"].dataType)
    return held.join(by_blob, "blob", "left").select(
        "_row.*", F.coalesce("_found", none).alias("secrets")
    )


def scan_secrets(
    docs: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Bring the ledger up to date with ``docs`` and return their ``findings``."""
    update_ledger(docs, ledger, text, rules)
    return findings(docs, ledger, text, rules)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ledger = f"{new_folder(spark)}/ledger"
    update_ledger(docs, ledger)
    found = findings(docs.select("doc_id", "text"), ledger).drop("text")
    kinds = [rule.kind for rule in BASE]

    def number(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *map(number, kinds),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("secrets")).alias("spans"),
    )


def _sql() -> str:
    """Places of all matches of a document are the running sums of gaps and matches."""
    parts = []
    for rank, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
  SELECT rid, {rank} AS rank, '{rule.kind}' AS kind, i,
    sum(length(gaps[i]) + length(matches[i])) OVER (PARTITION BY rid ORDER BY i) AS ends,
    length(matches[i]) AS size, length(vals[i]) >= {rule.least} AS valid
  FROM (SELECT *, unnest(generate_series(1, len(matches))) AS i FROM (
    SELECT rid, regexp_extract_all(t, '{pattern}') AS matches,
      regexp_extract_all(t, '{pattern}', {rule.group}) AS vals, string_split_regex(t, '{pattern}') AS gaps
    FROM d))""")
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    names = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)
    span = "kind || ':' || CAST(ends - size AS BIGINT) || ':' || CAST(ends AS BIGINT)"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce("text", '') AS t FROM documents
), pieces AS ({" UNION ALL ".join(parts)}
), found AS (
  SELECT rid, {counts},
    string_agg({span}, ',' ORDER BY ends - size, rank) FILTER (rank < {len(BASE)}) AS base,
    string_agg({span}, ',' ORDER BY ends - size, rank) AS spans
  FROM pieces WHERE valid GROUP BY rid
)
SELECT doc_id, {names}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found USING (rid)
"""


OP10_SQL = _sql()
