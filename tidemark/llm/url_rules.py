"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression over host + path and the literal tokens that a
matching URL must hold whole. Each rule is filed under the one of its literals
that the fewest URLs hold; a URL's tokens fetch the rules filed under them, and
only those run their expressions. A rule without literals is fetched by every
URL. Listed host/path rules win by length; where none fits, the block patterns
decide, and a URL that nothing matches is allowed. SQL functions only.

Distinct host + path strings are judged once, so a hot URL costs one row; the
judgements are a written table, so the join back may split a hot key.

Defined results: a null URL, or one without ``://``, has empty host and path, no
rule and the verdict ``allow``; repeated rows are all judged; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN_GAP = "[^A-Za-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``name`` is set for listed host/path rules; patterns have none."""

    verdict: str
    pattern: str
    literals: tuple[str, ...]
    name: str | None = None


def host_path_rule(verdict: str, name: str) -> Rule:
    """``example.org/es/``: the host and its subdomains, paths that start so."""
    host, _, path = name.partition("/")
    whole = re.split(TOKEN_GAP, f"{host}/{path}")
    whole = whole[:-1]  # what ends the prefix may go on in the URL; after a slash it is empty
    return Rule(verdict, r"^(?:[^/]*\.)?" + re.escape(host.lower()) + "/" + re.escape(path), tuple(t for t in whole if t), name)


def word_pattern(words: tuple[str, ...]) -> list[Rule]:
    """Block patterns for a word that stands alone in host or path."""
    return [Rule("block", rf"(?:^|[./_-]){w}(?:$|[./_-])", (w,)) for w in words]


LISTED = [
    host_path_rule("allow", "org/"),
    host_path_rule("block", "example.org/es/"),
    host_path_rule("block", "example.org/en/1"),
    host_path_rule("allow", "com/fr/"),
    host_path_rule("block", "com/de/"),
]
#: The method's own patterns, for URLs that no listed rule fits.
PATTERNS = word_pattern(("adserver", "casino", "doubleclick", "login", "porn", "tracker", "xxx"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def judge(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """``urls`` (page_id, url) with host, path, rule, pattern and verdict."""
    spark = urls.sparkSession
    host, path = host_and_path(F.col("url"))
    rows = urls.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.select("page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    rows = rows.withColumn("key", F.concat("host", "path"))
    keys = rows.select("key").distinct()
    tokens = keys.select("key", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), F.split("key", TOKEN_GAP)))).alias("token"))

    schema = "id int, verdict string, pattern string, name string, literals array<string>"
    table = spark.createDataFrame([(i, r.verdict, r.pattern, r.name, list(r.literals) or [""]) for i, r in enumerate(rules)], schema)
    literals = table.select("id", F.explode("literals").alias("token"))
    held = tokens.join(literals.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = literals.join(held, "token", "left").groupBy("id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token"))["token"].alias("token"))
    index = materialize(rarest.join(table.drop("literals"), "id"), "url-rules")  # as many rows as rules

    matched = tokens.join(index, "token").where("key rlike pattern")
    longest = F.struct(F.col("name").isNotNull(), F.length("name"), -F.col("id"))  # listed first, then the longest, then the first given
    judged = matched.groupBy("key").agg(F.max_by(F.struct("name", "pattern", "verdict"), longest).alias("by"))
    verdicts = materialize(judged, "url-verdicts").hint("merge")  # they grow with the URLs: never broadcast
    out = rows.join(verdicts, "key", "left")
    listed = F.col("by.name").isNotNull()
    return out.select("page_id", "host", "path", F.col("by.name").alias("rule"), F.coalesce("by.verdict", F.lit("allow")).alias("verdict"), F.when(~listed, F.col("by.pattern")).alias("pattern"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), LISTED + PATTERNS)


OP7_SQL = r"""
WITH parts AS (
  SELECT page_id, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END, '') AS rest FROM pages
), hp AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), listed(rule, verdict, rhost, rpath) AS (VALUES
  ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'), ('example.org/en/1', 'block', 'example.org', '/en/1'),
  ('com/fr/', 'allow', 'com', '/fr/'), ('com/de/', 'block', 'com', '/de/')
), fits AS (
  SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM hp JOIN listed ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY ALL
), words(w) AS (VALUES ('adserver'), ('casino'), ('doubleclick'), ('login'), ('porn'), ('tracker'), ('xxx')
), patterns AS (
  SELECT page_id, host, path, min(w) AS w FROM hp JOIN words ON regexp_matches(host || path, '(?:^|[./_-])' || w || '(?:$|[./_-])') GROUP BY ALL
)
SELECT hp.page_id, hp.host, hp.path, f.rule, CASE WHEN f.rule IS NOT NULL THEN f.verdict WHEN p.w IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN f.rule IS NULL AND p.w IS NOT NULL THEN '(?:^|[./_-])' || p.w || '(?:$|[./_-])' END AS pattern
FROM hp LEFT JOIN (SELECT DISTINCT * FROM fits) f USING (page_id, host, path) LEFT JOIN (SELECT DISTINCT * FROM patterns) p USING (page_id, host, path)
"""
