"""URL filter with a blocked Bloom filter in front of an exact join, DataFrame functions only.

Listed entries are canonical URLs: a host with all its subdomains, and a path prefix. A URL stands for
the entries that could list it: its host's endings with as many labels as a listed host has, joined with
its path's beginnings as long as a listed path. Each of these keys sets or tests a few bits of one block
of four words, chosen by its hash; only keys with all bits set go on to the exact join with the list,
which removes false positives. The longest listed entry decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: host/path, verdict. Fixed values.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: The filter has at most so many blocks of 256 bits, so that it may be broadcast whatever the list.
BLOCKS = 1 << 15
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _block(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BLOCKS))


def _masks(key: Column) -> list[Column]:
    """One bit in each of the block's four words, from a second hash."""
    second = F.xxhash64(F.lit("second"), key)
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(4)]


def bloom(listed: DataFrame) -> DataFrame:
    """Blocks with bits set: block, w0 to w3; at most ``BLOCKS`` rows."""
    masked = listed.select(_block(F.col("key")).alias("block"), *[m.alias(f"m{k}") for k, m in enumerate(_masks(F.col("key")))])
    return masked.groupBy("block").agg(*[F.bit_or(f"m{k}").alias(f"w{k}") for k in range(4)])


def rules(spark: SparkSession, entries=RULES) -> DataFrame:
    return spark.createDataFrame(list(entries), "key string, verdict string")


def _shapes(listed: DataFrame) -> tuple[list[int], list[int]]:
    """Label counts of listed hosts and lengths of listed paths: a few numbers each."""
    listed_host = F.substring_index("key", "/", 1)
    labels = F.length(listed_host) - F.length(F.replace(listed_host, F.lit("."), F.lit(""))) + 1
    found = listed.agg(F.collect_set(labels).alias("labels"), F.collect_set(F.length("key") - F.length(listed_host)).alias("paths")).first()
    return sorted(found["labels"]), sorted(found["paths"])


def judged(pages: DataFrame, listed: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict.

    A null url, or one without ``://``, has an empty host and path. Without a listed entry the rule is
    null and the verdict allow. Entries of equal length: the smaller one decides. Rows that share a
    page_id are judged one by one; each different URL is looked up once.
    """
    labels, paths = _shapes(listed)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    urls = rows.filter(F.col("url").isNotNull()).select("url").distinct().select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    dots = "length(host) - length(replace(host, '.', '')) + 1"
    wanted = f"""explode(flatten(transform(array({', '.join(map(str, labels)) or 'cast(null as int)'}), n ->
        transform(array({', '.join(map(str, paths)) or 'cast(null as int)'}), p ->
        if({dots} >= n and length(path) >= p, concat(substring_index(host, '.', -n), left(path, p)), null))))) as key"""
    keys = urls.selectExpr("url", wanted).filter("key is not null")
    key = F.col("key")
    keys = keys.select("url", "key", _block(key).alias("block"), *[m.alias(f"m{k}") for k, m in enumerate(_masks(key))])
    possible = keys.join(F.broadcast(bloom(listed)), "block")
    for k in range(4):
        possible = possible.filter(F.col(f"m{k}").bitwiseAND(F.col(f"w{k}")) == F.col(f"m{k}"))
    hits = possible.select("url", "key").join(listed.dropDuplicates(["key"]), "key")
    best = hits.groupBy("url").agg(F.min_by(F.struct(F.col("key").alias("rule"), "verdict"), F.struct(-F.length("key"), "key")).alias("best"))
    out = rows.join(best, "url", "left")
    verdict = F.coalesce("best.verdict", F.lit("allow"))
    return out.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.col("best.rule").alias("rule"), verdict.alias("verdict"))


URL_SQL = r"""
WITH parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages
), fits AS (
  SELECT *, (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') AS a,
    (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') AS b,
    (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') AS c,
    (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') AS d FROM parts
)
SELECT page_id, host, path, CASE WHEN b THEN 'example.net/en/' WHEN c THEN 'example.com/de/' WHEN d THEN 'org/fr/' WHEN a THEN 'net/' END AS rule,
  CASE WHEN b THEN 'allow' WHEN c THEN 'block' WHEN d THEN 'allow' WHEN a THEN 'block' ELSE 'allow' END AS verdict
FROM fits
"""
