"""URL rules by host-suffix and path-prefix expressions.

Every url is expanded into the expressions a rule could be written as: each
suffix of its host at a label boundary (with no more labels than any rule
has) with each prefix of its path (of a length some rule has). Expressions
meet the rules in an equi-join on a short hash prefix; a hit counts only if
the full SHA-256 digests agree. Of the rules that fit, the longest one
decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_HEX = 8  # first 4 bytes of the digest
BROADCAST_RULES = 200_000
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased;
    empty if the url is null or has no ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1),
                                  UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or end; empty as for the host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow",
          broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url).

    ``rules`` (host, path, verdict): a rule fits its host and all subdomains if
    the path starts with the rule's. The longest fitting rule (host and path
    together; then the longer host, then ``block`` before ``allow``) gives the
    verdict; without one it is ``default`` and ``rule`` is null. A null url,
    or one without ``://``, has empty host and path and fits no rule. Rows
    repeat as they come; empty tables of pages or rules are fine; other
    columns are not read.
    """
    rules = rules.where("host is not null and path is not null").select(
        F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"),
        F.col("verdict").alias("r_verdict"))
    # one rule for each expression: block wins over allow
    rules = rules.groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict")) \
        .withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path"))) \
        .withColumn("r_short", F.substring("r_digest", 1, PREFIX_HEX))
    shape = rules.agg(F.count("*").alias("n"), F.max(F.size(F.split("r_host", r"\."))).alias("labels"),
                      F.collect_set(F.length("r_path")).alias("lengths")).first()
    judged = pages.select("page_id", "url").withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).drop("url")
    if not shape["n"]:
        return judged.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    labels = F.split("host", r"\.")
    most = F.least(F.size(labels), F.lit(shape["labels"]))
    suffixes = F.transform(F.sequence(F.lit(1), most), lambda k: F.array_join(
        F.slice(labels, -k, k), "."))
    lengths = F.filter(F.array(*[F.lit(n) for n in sorted(shape["lengths"])]),
                       lambda n: n <= F.length("path"))
    prefixes = F.transform(lengths, lambda n: F.substring(F.col("path"), F.lit(1), n))
    # distinct (host, path) first: a common url is expanded once, and the row
    # number of a page is never needed to bring its verdict back
    places = judged.where("host <> ''").select("host", "path").distinct()
    expr = (places.withColumn("sfx", F.explode(suffixes))
            .withColumn("pfx", F.explode(prefixes))
            .withColumn("digest", _digest(F.col("sfx"), F.col("pfx")))
            .select("host", "path", "digest", F.substring("digest", 1, PREFIX_HEX).alias("short")))
    if shape["n"] <= broadcast_rules:
        hits = expr.join(F.broadcast(rules), F.col("short") == F.col("r_short"))
    else:  # a common suffix such as a top-level domain is spread over the salts
        spread = rules.withColumn("r_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = expr.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")) \
            .join(spread, (F.col("short") == F.col("r_short")) & (F.col("salt") == F.col("r_salt")))
    hits = hits.where("digest = r_digest")
    order = F.struct(F.length(F.concat("r_host", "r_path")), F.length("r_host"),
                     F.col("r_verdict"), F.concat("r_host", "r_path"))
    best = hits.groupBy(F.col("host").alias("b_host"), F.col("path").alias("b_path")) \
        .agg(F.max(order).alias("best"))
    return judged.join(best, (F.col("host") == F.col("b_host")) & (F.col("path") == F.col("b_path")),
                       "left").select(
        "page_id", "host", "path", F.col("best.col4").alias("rule"),
        F.coalesce("best.r_verdict", F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


ORACLE = r"""
WITH u AS (
  SELECT page_id, url,
    CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rh, rp, rv) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (
  SELECT page_id, host, path, rh || rp AS rule, rv,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
  FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT p.page_id, p.host, p.path, f.rule AS rule, coalesce(f.rv, 'allow') AS verdict
FROM p LEFT JOIN f ON f.page_id = p.page_id AND f.host = p.host AND f.path = p.path AND f.k = 1
"""
