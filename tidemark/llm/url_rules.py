"""URL filter lists: host-suffix and path-prefix expressions joined on short digest prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: The contract's rules: (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: A rule list of at most so many rows is broadcast (about 200 bytes each); a longer one is joined by shuffle.
BROADCAST_RULES = 200_000


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; ASCII lower case; empty without ``://``."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", otherwise: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """Longest-rule verdict for each URL; ``rules`` are (host, path, verdict).

    Every URL becomes expressions host suffix + path prefix, a prefix for each distinct length of a rule's path
    that fits. Expressions meet the rules on four bytes of their SHA-256; the full digest confirms. Of the
    confirmed rules the longest wins, then the greatest in byte order, then the greater verdict. URLs that no
    rule fits get ``otherwise`` and a null rule. A host has as many suffixes as the deepest rule has labels, so long
    hosts and paths cost linear time. Null URLs or ones without ``://`` have an empty host and path.
    Rules with null fields are ignored. Repeated rows and ids are judged one by one. Other columns are ignored; an
    empty table gives an empty result, an empty rule list the fallback for all.
    """
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumn("row", F.monotonically_increasing_id())
    rules = rules.select(lower_ascii(F.col("host")).alias("rh"), F.col("path").alias("rp"), F.col("verdict").alias("rv")).dropna().distinct()
    rules = rules.withColumn("full", F.sha2(F.concat("rh", "rp").cast("binary"), 256)).withColumn("short", F.substring("full", 1, 8))
    small = rules.limit(broadcast_rules + 1).count() <= broadcast_rules
    lengths = sorted(r[0] for r in rules.select(F.length("rp")).distinct().toLocalIterator())
    # no rule's host has more labels, so no longer suffix of a URL's host can meet one
    deepest = rules.agg(F.max(F.size(F.split("rh", r"\.")))).first()[0] or 1
    pages = pages.select("row", "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.greatest(F.size(labels) - deepest + 1, F.lit(1)), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    prefixes = F.transform(fits, lambda n: F.substring(F.col("path"), F.lit(1), n))
    tried = pages.withColumn("e", F.explode_outer(F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))))
    tried = tried.withColumn("efull", F.sha2(F.col("e").cast("binary"), 256)).withColumn("eshort", F.substring("efull", 1, 8))
    best = F.struct(F.length(F.concat("rh", "rp")).alias("n"), F.concat("rh", "rp").alias("rule"), F.col("rv").alias("verdict"))
    if small:
        met = tried.join(F.broadcast(rules), F.col("eshort") == F.col("short"), "left")
    else:
        salt = F.pmod("row", F.lit(16)).cast("int")
        met = tried.withColumn("salt", salt).join(
            rules.withColumn("rsalt", F.explode(F.sequence(F.lit(0), F.lit(15)))), (F.col("eshort") == F.col("short")) & (F.col("salt") == F.col("rsalt")), "left"
        )
    won = met.groupBy("row", "page_id", "host", "path").agg(F.max(F.when(F.col("efull") == F.col("full"), best)).alias("m"))
    return won.select("page_id", "host", "path", F.col("m.rule").alias("rule"), F.coalesce("m.verdict", F.lit(otherwise)).alias("verdict"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


OP6_SQL = r"""
WITH r(rh, rp, rv) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (
  SELECT row_number() OVER () AS k, page_id,
    translate(CASE WHEN url LIKE '%://%' THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*') ELSE '' END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN url LIKE '%://%' THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), m AS (
  SELECT k, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS verdict
  FROM p JOIN r ON (host = rh OR host LIKE '%.' || rh) AND starts_with(path, rp) GROUP BY k
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m ON p.k = m.k
"""
