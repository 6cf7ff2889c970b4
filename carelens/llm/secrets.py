"""Operator 1, secret scans with an incremental blob ledger.

Every version of a text is addressed by the hash of its content. The ledger
holds which (content, rule, rule version) triples have been scanned and what was
found; a scan reads only triples it does not hold, once per content however many
paths carry it, and the findings are joined back to all paths. Only built-in
functions run.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelens.llm.common import scratch, text_of


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches, leftmost first and not overlapping, are findings
    if group ``group`` has at least ``least`` characters. Raise ``version`` with
    every change: the ledger then scans all content again for this rule."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


# fixed values: the base rules, in this order. The last two take whole runs, so that
# asking for the least length in the pattern finds the same ones.
BASE = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
)
#: Formats that are secrets wherever they stand.
MORE = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27),
    Rule("code_host", 1, r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
)
RULES = BASE + MORE


def blob_id(text: Column) -> Column:
    """The address of a content; null counts as the empty text."""
    return F.sha2(text_of(text).cast("binary"), 256)


def _hits(rule: Rule) -> Column:
    """Per match of the rule in ``text``: the length of the gap before it, its own
    length and that of its group, in code points; null without any match."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all("text", pattern, F.lit(0))
    group = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else whole
    gaps = F.split("text", rule.pattern, -1)  # one more than matches
    parts = F.arrays_zip(gaps.alias("gap"), whole.alias("hit"), group.alias("value"))
    lengths = F.transform(parts, lambda x: F.struct(
        F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), F.lit(rule.least).alias("least"),
        F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("size"), F.length(x["value"]).alias("value")))
    # the last gap has no match after it
    return F.when(F.array_contains("kinds", rule.kind) & F.col("text").rlike(rule.pattern),
                  F.slice(lengths, F.lit(1), F.size(lengths) - 1))


def find(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, kind, version, start, end) of every finding in (blob, text, kinds),
    where ``kinds`` names the rules to apply to this row; code points, the end
    exclusive. A match starts after all gaps and matches before it, a running
    sum within one blob and rule."""
    hits = F.flatten(F.filter(F.array(*[_hits(r) for r in rules]), lambda x: x.isNotNull()))
    rows = blobs.select("blob", F.posexplode(hits).alias("place", "hit")).select("blob", "place", "hit.*")
    before = W.partitionBy("blob", "kind").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    return rows.withColumn("end", end).where(F.col("value") >= F.col("least")).select(
        "blob", "kind", "version", (F.col("end") - F.col("size")).alias("start"), "end")


class BlobLedger:
    """What has been scanned, and found, in a folder that all machines share.

    A scan writes its findings before it marks their triples as scanned. One that
    is broken off in between is repeated by the next scan, and a finding that is
    then held twice is read once."""

    SCANNED = "blob string, kind string, version int"
    FOUND = "blob string, kind string, version int, start bigint, end bigint"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        # a ledger without any scan yet has no such folder; the empty table stands for it
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            columns = [c.strip().split(" ") for c in schema.split(",")]
            return self.spark.range(0).select(*[F.lit(None).cast(kind).alias(c) for c, kind in columns])

    def scanned(self) -> DataFrame:
        return self._read("scanned", self.SCANNED)

    def scan(self, versions: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
        """Scans the content of ``versions`` for the pairs of blob and rule version
        that the ledger lacks. The seen rules are one small array per blob; blobs
        with nothing to do leave before any text is shuffled or searched, and each
        content goes through the search once."""
        blobs = versions.select(blob_id(F.col(text)).alias("blob"), text_of(text).alias("text"))
        wanted = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules])
        seen = self.scanned().groupBy("blob").agg(
            F.collect_set(F.concat_ws(":", "kind", "version")).alias("seen"))
        missing = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        todo = (
            blobs.join(seen, "blob", "left").withColumn("missing", missing).where(F.size("missing") > 0)
            .select("blob", "text", F.transform("missing", lambda x: F.split_part(x, F.lit(":"), F.lit(1))).alias("kinds"))
            .dropDuplicates(["blob"])
        )
        batch = uuid.uuid4().hex
        find(todo, rules).write.parquet(f"{self.folder}/found/{batch}")
        versions_of = F.array(*[
            F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
        done = (
            versions.select(blob_id(F.col(text)).alias("blob")).distinct().join(seen, "blob", "left")
            .withColumn("missing", missing)
            .select("blob", "missing", F.explode(versions_of).alias("rule"))
            .where(F.array_contains("missing", F.concat_ws(":", "rule.kind", "rule.version")))
        )
        done.select("blob", "rule.kind", "rule.version").write.parquet(f"{self.folder}/scanned/{batch}")

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """The findings of these rule versions, each once."""
        current = F.concat_ws(":", "kind", "version").isin([f"{r.kind}:{r.version}" for r in rules])
        return self._read("found", self.FOUND).where(current).distinct()


def scan_paths(
    versions: DataFrame, ledger: BlobLedger, text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``row`` (the input row) of every version with ``spans``: all findings in its
    content, an array of (start, rank, kind, end) by start and then by rule order.

    Null and empty texts have none. Repeated rows each come back. The text itself
    is not shuffled here: rows are joined by blob address to one array per blob,
    and Spark splits the partition of an address that very many rows carry."""
    ledger.scan(versions, text, rules)
    rank = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind"))
    spans = F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("spans")
    found = ledger.findings(rules).groupBy("blob").agg(spans)
    carried = [c for c in versions.columns if c != text]
    paths = versions.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"),
                            blob_id(F.col(text)).alias("blob"))
    return paths.join(found, "blob", "left").select(
        "row", "blob", F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)).alias("spans"))


def secrets_digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base findings, the hash of their spans, and all
    spans as text."""
    ledger = BlobLedger(docs.sparkSession, scratch(docs.sparkSession, "ledger"))
    told = scan_paths(docs.select("doc_id", "text"), ledger)

    def line(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["rank"] <= len(BASE))
    return told.select(
        "row.doc_id", *[count(r.kind) for r in BASE],
        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def oracle() -> str:
    """The same for one scan of everything, in DuckDB's SQL."""

    def of_rule(rank: int, rule: Rule) -> str:
        pattern = rule.pattern.replace("'", "''")
        return f"""
  select rid, '{rule.kind}' as kind, {rank} as rank, hit, value,
    length(array_to_string(gaps[1:i], '')) + length(array_to_string(hits[1:i-1], '')) as start_at
  from (select *, hits[i] as hit, values_[i] as value from (select *, unnest(range(1, len(hits) + 1)) as i from (
    select rid, string_split_regex(t, '{pattern}') as gaps, regexp_extract_all(t, '{pattern}', 0) as hits,
      regexp_extract_all(t, '{pattern}', {rule.group}) as values_
    from d where regexp_matches(t, '{pattern}'))))
  where length(value) >= {rule.least}"""

    found = " union all ".join(of_rule(k + 1, r) for k, r in enumerate(RULES))
    counts = ", ".join(
        f"coalesce(count_if(kind = '{r.kind}'), 0)::bigint as n_{r.kind}" for r in BASE)
    zeros = ", ".join(f"coalesce(n_{r.kind}, 0)::bigint as n_{r.kind}" for r in BASE)
    return f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
f as ({found}),
g as (select rid, {counts},
  string_agg(kind || ':' || start_at || ':' || (start_at + length(hit)), ',' order by start_at, rank)
    filter (where rank <= {len(BASE)}) as base,
  string_agg(kind || ':' || start_at || ':' || (start_at + length(hit)), ',' order by start_at, rank) as spans
  from f group by rid)
select doc_id, {zeros}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join g using (rid)"""
