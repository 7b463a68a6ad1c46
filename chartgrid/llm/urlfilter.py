"""URL filters: host-suffix and path-prefix expressions against hashed rules.

A URL is expanded into every ``host suffix + path prefix`` a rule could name;
the expressions are joined with the rules on a short digest prefix and the full
digests decide.  Everything is a Spark expression or an equi-join.

Defined cases: a null URL or one without ``://`` has an empty host and path and
fits no rule; a rule list without rows leaves every URL at ``default``; repeated
URLs are judged once and every row gets the verdict; a rule given twice with two
verdicts blocks.  Extra columns of ``pages`` pass through only if asked for.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

DIGEST_PREFIX = 8   # hex digits of the join key (32 bits)


def url_host(url: Column) -> Column:
    """Text between the first ``://`` and the next ``/ ? #``, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """Text from the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def _digest(expr: Column) -> Column:
    return F.sha2(expr.cast("binary"), 256)


def expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """All ``host suffix + path prefix`` strings whose label count and prefix
    length occur in some rule (others could not equal a rule)."""
    n_labels = F.size(F.split(host, r"\."))
    counts = F.array(*[F.lit(n) for n in labels])
    cuts = F.array(*[F.lit(n) for n in lengths])
    suffixes = F.transform(F.filter(counts, lambda n: n <= n_labels),
                           lambda n: F.array_join(F.slice(F.split(host, r"\."), -n, n), "."))
    prefixes = F.transform(F.filter(cuts, lambda n: n <= F.length(path)),
                           lambda n: F.substr(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (or null), verdict.

    ``rules`` has host, path, verdict ('allow' or 'block').  The longest rule
    that fits wins; between rules of one length the longer host, then 'block'.
    """
    rules = (rules.groupBy(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"))
             .agg(F.max("verdict").alias("r_verdict"))       # 'block' > 'allow'
             .withColumn("rule", F.concat("r_host", "r_path"))
             .withColumn("full", _digest(F.col("rule")))
             .withColumn("short", F.substring("full", 1, DIGEST_PREFIX)))
    # The distinct label counts and path lengths of rules: bounded by the longest URL.
    shape = rules.agg(F.collect_set(F.size(F.split("r_host", r"\."))).alias("labels"),
                      F.collect_set(F.length("r_path")).alias("lengths")).first()

    urls = pages.select(F.col(id_col).alias(id_col), url_host(F.col(url_col)).alias("host"),
                        url_path(F.col(url_col)).alias("path"))
    if not shape.labels:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    asked = (urls.select("host", "path").distinct()
             .withColumn("expr", F.explode(expressions(
                 F.col("host"), F.col("path"), sorted(shape.labels), sorted(shape.lengths))))
             .withColumn("u_full", _digest(F.col("expr")))
             .withColumn("short", F.substring("u_full", 1, DIGEST_PREFIX)))
    best = (asked.join(rules, "short").filter("u_full = full")
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("n"), F.length("r_host").alias("h"),
                                "r_verdict", "rule")).alias("best")))
    return (urls.join(best, ["host", "path"], "left")
            .select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.r_verdict", F.lit(default)).alias("verdict")))
