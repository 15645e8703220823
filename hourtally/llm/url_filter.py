"""URL filters: allow and block rules on hosts and paths.

A rule is a host and a path, like ``example.net/en/``. It fits its host and all subdomains if the
path of the url starts with the rule's; the longest rule that fits wins.

Every url is expanded into expressions, a suffix of its host with a prefix of its path that ends in
``/``, and every rule has one such expression: its host with its path up to the last ``/``. They are
joined on the first ``PREFIX`` hex digits of the expressions' SHA-256, a number; only for the hits
the digest is made again, and in full it confirms them together with the rule's path. Only the label counts and
depths that rules have are expanded, so the rows made do not depend on how long urls are.

Urls with the same host and path are judged once, before anything is joined. Urls without a host are
in no join, and the verdict on a host and path that very many pages have goes back to them by a join
that Spark can cut.

Defined results: a null url and one without ``://`` have an empty host and path, no rule and the
verdict of no rule. Rules without a host, a path that begins with ``/`` or a verdict fit nothing, and
an empty rules table allows everything. Of equally long rules the one with the
longer host wins, of equal rules a block. Repeated rows, and rows without an id, are each returned.
Very long urls are whole texts as others. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.llm.tables import dealt, literal_rows, table

# The verdict where no rule fits.
NO_RULE = "allow"
PREFIX = 8

#: The rules of the registered query.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def _short(digest: Column) -> Column:
    """The first digits of a digest, as the number that they write."""
    return F.conv(F.substring(digest, 1, PREFIX), 16, 10).cast("bigint")


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def _depth(path: Column) -> Column:
    """How many ``/`` there are."""
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _folder(path: Column, depth: Column) -> Column:
    """The part of a path up to its ``depth``-th ``/``."""
    return F.concat(F.call_function("substring_index", path, F.lit("/"), depth), F.lit("/"))


def url_verdicts(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` for each row of ``pages(page_id, url)`` under
    ``rules(host, path, verdict)``."""
    pages = pages.select("page_id", "url").withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}
    )
    rules = rules.select(
        F.lower("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict"
    ).where("rule_host <> '' and rule_path like '/%' and verdict in ('allow', 'block')")
    depth = _depth(F.col("rule_path"))
    rules = rules.withColumns(
        {
            "labels": _labels(F.col("rule_host")),
            "depth": depth,
            "rule_digest": _digest(F.col("rule_host"), _folder(F.col("rule_path"), depth)),
        }
    ).withColumn("short", _short(F.col("rule_digest")))
    # A few pairs however many rules there are: label counts and depths.
    shapes = rules.select("labels", "depth").distinct().collect()
    if not shapes:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(NO_RULE)})
    shape = F.explode(
        F.array(*(F.struct(F.lit(s["labels"]).alias("labels"), F.lit(s["depth"]).alias("depth")) for s in shapes))
    )

    # One row for each host and path, however many pages have it.
    distinct = pages.where("host <> '' and path like '/%'").select("host", "path").distinct()
    suffix = F.call_function("substring_index", F.col("host"), F.lit("."), -F.col("shape.labels"))
    digest = _digest(suffix, _folder(F.col("path"), F.col("shape.depth")))
    expressions = (
        distinct.select("host", "path", shape.alias("shape"))
        .where(_labels(F.col("host")) >= F.col("shape.labels"))
        .where(_depth(F.col("path")) >= F.col("shape.depth"))
        .withColumn("short", _short(digest))
    )
    # Not written as an equation, of which Spark would make a second join key.
    confirmed = (digest >= F.col("rule_digest")) & (digest <= F.col("rule_digest"))
    hits = (
        expressions.join(rules, "short")
        .where(confirmed & F.startswith("path", "rule_path"))
        .withColumn("rule", F.concat("rule_host", "rule_path"))
    )
    rank = F.struct(
        F.length("rule").alias("size"), F.length("rule_host").alias("host_size"),
        (F.col("verdict") == "block").alias("blocks"), "rule", "verdict",
    )
    judged = hits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    hosted = F.col("host") != ""
    ruled = pages.where(hosted).join(dealt(judged, "host", "path"), ["host", "path"], "left")
    free = pages.where(~hosted).withColumn("best", F.lit(None).cast(judged.schema["best"].dataType))
    return ruled.unionByName(free).select(
        "page_id",
        "url",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(NO_RULE)).alias("verdict"),
    )


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = literal_rows(spark, ("host", "path", "verdict"), RULES)
    return url_verdicts(table(spark, folder, "pages"), rules).drop("url")


_SQL_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

OP3_SQL = f"""
  WITH rules(rule_host, rule_path, verdict) AS (VALUES {_SQL_RULES}),
  cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3)
                    ELSE '' END AS rest FROM pages),
  parts AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
  shapes AS (SELECT DISTINCT host, path FROM parts),
  best AS (
    SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(verdict, length(rule_host || rule_path)) AS verdict
    FROM shapes JOIN rules ON starts_with(path, rule_path)
      AND (host = rule_host OR ends_with(host, '.' || rule_host))
    GROUP BY host, path)
  SELECT page_id, host, path, rule, coalesce(verdict, '{NO_RULE}') AS verdict
  FROM parts LEFT JOIN best USING (host, path)"""
