"""Secrets in texts, by an incremental ledger of contents.

Every version of every text is named by the SHA-256 of its content, its blob. The ledger is a table
of blobs, each with the versions of the rules it has been scanned with and the spans they found. A
scan looks only at pairs of blob and rule version that the ledger does not hold, once for all paths
and versions with that content, and appends what it finds; findings are then joined to all paths.
So a new version costs its own scan, a copy or a reverted file nothing, and a changed rule that rule
alone over each blob.

A ledger row tells all that one scan found in one blob. A scan that was cut off leaves whole rows or
none, and repeating it scans what is missing. Two scans of one pair give the same row twice, which
counts once.

Only column functions. A text crosses one exchange, by its blob, with copies combined before it; the
places of its matches follow from the lengths of the pieces between them, summed up by a window over
the text's own matches. With rows in the ledger, only texts of pending blobs enter that exchange,
and Spark broadcasts these blobs where they are few.

Defined results: a null text is an empty one, which has no spans. Repeated rows and rows without an id
are each reported. Places count code points, the end is exclusive. Matches of one rule never
overlap, matches of different rules may. An empty table gives no rows. Columns of ``versions``
named ``blob`` or ``spans`` are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.llm.tables import dealt, table
from hourtally.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    A match that is too short still takes its text: the search goes on behind it. A changed pattern
    needs a new ``version``.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(word: str) -> str:
    """Letters of A-Z in either case, and no other character that some engines fold to them."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))

BASE = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    # The last two have greedy runs, so asking for the length in the pattern finds the same.
    Rule("access", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}"),
)
# Forms of published token formats.
ADDED = (
    Rule("github", "gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("login_url", r"[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~%-]{1,64}:[A-Za-z0-9._~%!$&*+-]{1,128}@"),
)
RULES = BASE + ADDED


def blob(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def _matches(rule: Rule, number: int, missing: Column) -> Column:
    """The rule's matches in ``_text``, with the text before each: lengths, in order."""
    hits = F.regexp_extract_all("_text", F.lit(rule.pattern), F.lit(0))
    # One piece more than matches: what follows the last.
    gaps = F.split("_text", rule.pattern, -1)
    lengths = F.zip_with(
        F.transform(hits, lambda h: F.struct(
            F.length(h).alias("size"),
            (F.length(F.regexp_extract(h, rule.pattern, rule.group)) >= rule.least).alias("counts"),
        )),
        F.slice(F.transform(gaps, F.length), F.lit(1), F.size(hits)),
        lambda h, gap: F.struct(
            F.lit(number).alias("rule"), gap.alias("gap"), h["size"].alias("size"), h["counts"].alias("counts")
        ),
    )
    none = F.expr("array()").cast("array<struct<rule:int,gap:int,size:int,counts:boolean>>")
    asked = F.array_contains(missing, rule.id) & F.col("_text").rlike(rule.pattern)
    return F.when(asked, lengths).otherwise(none)


@dataclass(frozen=True)
class SecretLedger:
    """The ledger stored at ``path``, and the ``rules`` to look with; several may share a path."""

    path: str
    rules: Sequence[Rule] = RULES

    SCHEMA = "blob binary, rules array<string>, spans array<struct<rule:string,start:int,end:int>>"

    def rows(self, spark: SparkSession) -> DataFrame:
        """What has been scanned; nothing before the first scan."""
        try:
            return spark.read.schema(self.SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self.SCHEMA)

    def pending(self, versions: DataFrame, text: str = "text") -> DataFrame:
        """``blob, missing`` of the blobs of ``versions`` that some rule has not seen yet."""
        known = F.array(*(F.lit(r.id) for r in self.rules))
        seen = self.rows(versions.sparkSession).groupBy("blob").agg(
            F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen")
        )
        blobs = versions.select(blob(text).alias("blob")).distinct()
        missing = F.array_except(known, F.coalesce("seen", F.expr("array()").cast("array<string>")))
        pending = blobs.join(seen, "blob", "left").select("blob", missing.alias("missing"))
        return pending.where(F.size("missing") > 0)

    def scan(self, versions: DataFrame, text: str = "text") -> None:
        """Scan what is pending of ``versions`` and write it down."""
        spark = versions.sparkSession
        contents = versions.select(
            blob(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("_text")
        )
        if self.rows(spark).isEmpty():
            missing = F.array(*(F.lit(r.id) for r in self.rules))
            contents = contents.withColumn("missing", missing)
        else:
            contents = contents.join(dealt(self.pending(versions, text), "blob"), "blob")
        once = contents.groupBy("blob").agg(F.first("_text").alias("_text"), F.first("missing").alias("rules"))
        found = F.concat(*(_matches(r, i, F.col("rules")) for i, r in enumerate(self.rules)))
        # A blob without a match keeps one row, so that it is known to have none.
        each = once.select("blob", "rules", F.posexplode_outer(found).alias("at", "m")).select("blob", "rules", "at", "m.*")
        stop = F.expr("sum(gap + size) OVER (PARTITION BY blob, rule ORDER BY at)").cast("int")
        names = F.array(*(F.lit(r.id) for r in self.rules))
        spans = each.withColumn("end", stop).select(
            "blob",
            "rules",
            F.when(
                F.col("counts"),
                F.struct(names[F.col("rule")].alias("rule"), (F.col("end") - F.col("size")).alias("start"), "end"),
            ).alias("span"),
        )
        rows = spans.groupBy("blob").agg(F.first("rules").alias("rules"), F.collect_list("span").alias("spans"))
        rows.write.mode("append").parquet(self.path)

    def findings(self, versions: DataFrame, text: str = "text") -> DataFrame:
        """All rows of ``versions`` with their ``blob`` and ``spans``: structs ``start, kind, end``
        by start, then rule as listed, of this ledger's rules."""
        listed = F.array(*(F.lit(r.id) for r in self.rules))
        kinds = F.array(*(F.lit(r.kind) for r in self.rules))

        def placed(s: Column) -> Column:
            number = F.array_position(listed, s["rule"]).cast("int")
            return F.struct(s["start"].alias("start"), number.alias("number"), s["end"].alias("end"))

        rows = self.rows(versions.sparkSession).where(F.size("spans") > 0)
        spans = rows.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
        ordered = F.array_sort(F.filter(F.transform("spans", placed), lambda s: s["number"] > 0))
        named = F.transform(
            ordered,
            lambda s: F.struct(s["start"].alias("start"), kinds[s["number"] - 1].alias("kind"), s["end"].alias("end")),
        )
        found = spans.select("blob", named.alias("_spans"))
        kept = [c for c in versions.columns if c not in ("blob", "spans", text)]
        paths = versions.select(*kept, blob(text).alias("blob"))
        none = F.expr("array()").cast("array<struct<start:int,kind:string,end:int>>")
        return paths.join(dealt(found, "blob"), "blob", "left").select(
            *kept, "blob", F.coalesce("_spans", none).alias("spans")
        )


def span_list(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    texts = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.concat_ws(",", texts)


def op13_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ledger = SecretLedger(scratch_path(spark, "secret-ledger"))
    ledger.scan(docs)
    kinds = [r.kind for r in BASE]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = span_list(F.filter("spans", lambda s: s["kind"].isin(kinds)))
    return ledger.findings(docs).select(
        "doc_id",
        *(count(k) for k in kinds),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


def _sql_hits(rule: Rule, number: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
      SELECT rid, {number} AS number, '{rule.kind}' AS kind, unnest(regexp_extract_all(text, '{pattern}')) AS hit,
             unnest(string_split_regex(text, '{pattern}')[:-2]) AS gap,
             generate_subscripts(regexp_extract_all(text, '{pattern}'), 1) AS place,
             {rule.least} AS least, '{pattern}' AS pattern, {rule.group} AS part
      FROM texts WHERE regexp_matches(text, '{pattern}')"""


def _sql_value() -> str:
    # The number of a group must be a constant.
    cases = " ".join(f"""WHEN {i} THEN regexp_extract(hit, '{r.pattern.replace("'", "''")}', {r.group})"""
                     for i, r in enumerate(RULES))
    return f"CASE number {cases} END"


_BASE_KINDS = ", ".join(f"'{r.kind}'" for r in BASE)

OP13_SQL = f"""
  WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
  hits AS ({" UNION ALL ".join(_sql_hits(r, i) for i, r in enumerate(RULES))}),
  placed AS (
    SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY rid, number ORDER BY place) AS stop FROM hits),
  spans AS (
    SELECT rid, number, kind, stop - length(hit) AS start,
           kind || ':' || (stop - length(hit)) || ':' || stop AS span
    FROM placed WHERE length({_sql_value()}) >= least),
  found AS (
    SELECT rid, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
           string_agg(span, ',' ORDER BY start, number) FILTER (kind IN ({_BASE_KINDS})) AS base,
           string_agg(span, ',' ORDER BY start, number) AS spans
    FROM spans GROUP BY rid)
  SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
         sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
  FROM texts LEFT JOIN found USING (rid)"""
