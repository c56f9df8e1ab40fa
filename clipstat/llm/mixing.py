"""Mix sources to target weights with DataFrame functions only.

Words are summed per source; sources in code-point order get the weights in turn, and the targets stop
at a multiple of the source's own words, the excess being shared again by weight. With sources ordered
by their words per weight the stopped ones come first, so one running sum finds them all. A document is
then emitted ``floor(rate)`` times, and once more if a number hashed from its id and a seed falls below
the fraction of the rate.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.llm.common import WORD

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
#: A source's documents are spread over so many parts when they meet its rate.
SALTS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD + "+")), F.lit(0)).cast("bigint")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number from 0 up to 1 that depends on the id and the seed only (52 bits of an MD5)."""
    told = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(told, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, size)`` rows to one row per source: source, source_size, target, rate."""
    total = sizes.groupBy("source").agg(F.sum("size").cast("decimal(38,0)").alias("s"))
    common = math.lcm(*weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    ranked = total.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), turn))
    # One row per source from here on.
    by_room = Window.orderBy(F.col("s") * (F.lit(common) / F.col("w")).cast("int"), F.col("source").asc_nulls_last())
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    ranked = ranked.select(
        "source", "s", "w",
        (F.sum("s").over(everyone) - F.lit(most) * F.coalesce(F.sum("s").over(earlier), F.lit(0))).alias("words_left"),
        (F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(earlier), F.lit(0))).alias("weight_left"),
    )
    full = F.lit(most) * F.col("s") * F.col("weight_left") <= F.col("w") * F.col("words_left")
    ranked = ranked.withColumn("full", full)
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("s"))).over(everyone), F.lit(0))
    used = F.coalesce(F.sum(F.when(F.col("full"), F.col("w"))).over(everyone), F.lit(0))
    rest = (F.sum("s").over(everyone) - F.lit(most) * taken).cast("double")
    weight = (F.sum("w").over(everyone) - used).cast("double")
    target = F.when(F.col("full"), (F.lit(most) * F.col("s")).cast("double")).otherwise(F.col("w") * rest / weight)
    out = ranked.select("source", F.col("s").cast("bigint").alias("source_size"), target.alias("target"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return out.withColumn("rate", F.least(rate, F.lit(float(most))))


def mix(df: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``df`` with ``_mix``: a struct of size, source_size, target and copies.

    A null text has no words; null sources are one source, the last. A source without words has target
    and rate 0. Rows that share a doc_id draw the same number.
    """
    sized = df.withColumn("_size", word_count(F.col(text)))
    known = targets(sized.select(F.col(source).alias("source"), F.col("_size").alias("size")), weights, most)
    known = known.select(F.struct("*").alias("_k"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_part"))
    salted = sized.withColumn("_salt", F.pmod(F.xxhash64(doc_id), F.lit(SALTS)).cast("int"))
    met = salted.join(known, (F.col("_salt") == F.col("_part")) & salted[source].eqNullSafe(F.col("_k.source")))
    whole = F.floor("_k.rate")
    copies = whole + F.when(draw(F.col(doc_id), seed) < F.col("_k.rate") - whole, 1).otherwise(0)
    told = F.struct(F.col("_size").alias("size"), F.col("_k.source_size"), F.col("_k.target"), copies.cast("bigint").alias("copies"))
    return met.select(*df.columns, told.alias("_mix"))


def emitted(mixed: DataFrame) -> DataFrame:
    """Each row as often as its mix says."""
    columns = [c for c in mixed.columns if c != "_mix"]
    repeats = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_mix.copies")))
    return mixed.filter("_mix.copies > 0").select(*columns, repeats.alias("_copy")).drop("_copy")


MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents
), per_source AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS s,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS w FROM sized GROUP BY source
), room AS (
  SELECT *, sum(s) OVER () - 3 * coalesce(sum(s) OVER (ORDER BY s * (10 // w), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_left,
    sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY s * (10 // w), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_left FROM per_source
), stopped AS (SELECT *, 3 * s * weight_left <= w * words_left AS is_full FROM room
), told AS (
  SELECT source, s, CASE WHEN is_full THEN CAST(3 * s AS DOUBLE)
    ELSE w * CAST(sum(s) OVER () - 3 * coalesce(sum(CASE WHEN is_full THEN s END) OVER (), 0) AS DOUBLE)
      / CAST(sum(w) OVER () - coalesce(sum(CASE WHEN is_full THEN w END) OVER (), 0) AS DOUBLE) END AS target FROM stopped
), rated AS (
  SELECT *, CASE WHEN s > 0 THEN least(target / CAST(s AS DOUBLE), 3.0) ELSE 0.0 END AS rate FROM told
)
SELECT d.doc_id, d.size, CAST(r.s AS BIGINT) AS source_size, r.target,
  CAST(d.size * (floor(r.rate) + CASE WHEN CAST(CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE)
    / 4503599627370496.0 < r.rate - floor(r.rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source
"""
