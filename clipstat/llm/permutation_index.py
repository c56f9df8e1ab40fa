"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. Vectors are dealt to shards of bounded size; a
shard posts each of its vectors in the inverted files of its ``POSTS`` nearest pivots. A query reads the
files of its own nearest pivots, ranks what it finds by Spearman's footrule over its first ``PREFIX``
pivots (a pivot beyond a vector's prefix counts as last), and reranks the best ``SHARE`` of the shard by
the inner product. Queries come to the shards in blocks, so a task holds one shard and streams one block.

Equal vectors are one entry that carries its smallest ids, as many as a result can show.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.llm.common import hold
from clipstat.session import ship_package

#: Pivots, drawn by a hash of the vectors; they are all that the driver sees.
PIVOTS = 256
POSTS, PREFIX = 20, 128
#: Part of a shard that is reranked, and at least so many of its vectors.
SHARE, AT_LEAST = 0.25, 512
SHARD_ROWS, BLOCK_ROWS = 8192, 4096


def _usable(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Rows that take part, with vectors as doubles."""
    rows = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(fine)
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("v") == (usual["n"] if usual else 0)).distinct()


class Shard:
    """Permutations and inverted files of some vectors."""

    def __init__(self, ids: np.ndarray, firsts: np.ndarray, vectors: np.ndarray, pivots: np.ndarray) -> None:
        """``firsts`` are the smallest vec_ids of the vectors; ties in score go by them."""
        self.ids, self.firsts, self.vectors, self.pivots = ids, firsts, vectors, pivots
        self.prefix, self.posts = min(PREFIX, len(pivots)), min(POSTS, len(pivots))
        order = self.nearest(vectors)
        # Footrules stay below 2**15: at most PREFIX * PREFIX.
        place = np.full((len(ids), len(pivots)), self.prefix, np.int16)
        np.put_along_axis(place, order, np.broadcast_to(np.arange(self.prefix, dtype=np.int16), order.shape), 1)
        self.place = np.ascontiguousarray(place.T)
        posted = order[:, : self.posts].ravel()
        by_pivot = np.argsort(posted, kind="stable")
        self.entries = by_pivot // self.posts
        self.bounds = np.searchsorted(posted[by_pivot], np.arange(len(pivots) + 1))
        self.taken = min(len(ids), max(AT_LEAST, int(np.ceil(SHARE * len(ids)))))

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """Nearest pivots of each vector in order; ties to the pivot drawn first."""
        return np.argsort(-(vectors @ self.pivots.T), axis=1, kind="stable")[:, : self.prefix]

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = self.nearest(query[None])[0]
        found = np.zeros(len(self.ids), bool)
        for pivot in order[: self.posts]:
            found[self.entries[self.bounds[pivot] : self.bounds[pivot + 1]]] = True
        apart = self.place[order]
        apart -= np.arange(self.prefix, dtype=np.int16)[:, None]
        footrule = np.abs(apart, out=apart).sum(0, dtype=np.int16)
        rows = np.flatnonzero(found)
        if len(rows) < k:
            rows = np.arange(len(self.ids))
        if len(rows) > self.taken:
            rows = rows[np.argsort(footrule[rows], kind="stable")[: self.taken]]
        score = (self.vectors[rows] * query).sum(1)
        best = np.lexsort((self.ids[rows], self.firsts[rows], -score))[:k]
        return self.ids[rows[best]], score[best]


def _searching(pivots: np.ndarray, k: int):
    """Stream of rows sorted by shard, block and kind (vectors first, then queries) to scored pairs."""
    width = pivots.shape[1]

    def vectors(column: pa.Array) -> np.ndarray:
        return np.asarray(column.flatten(), np.float64).reshape(-1, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, shard = None, [], None
        for batch in batches:
            keys = np.stack([np.asarray(batch.column(c)) for c in ("shard", "block", "kind")], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                ids, firsts, values = np.asarray(part.column("node")), np.asarray(part.column("first")), vectors(part.column("v"))
                if tuple(keys[a, :2]) != at:
                    at, parts, shard = tuple(keys[a, :2]), [], None
                if keys[a, 2] == 0:
                    parts.append((ids, firsts, values))
                    continue
                if shard is None and parts:
                    shard = Shard(*(np.concatenate(column) for column in zip(*parts)), pivots)
                if shard is None:
                    continue
                found = [shard.search(q, k) for q in values]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids, [len(f[0]) for f in found])),
                        pa.array(np.concatenate([f[0] for f in found])),
                        pa.array(np.concatenate([f[1] for f in found])),
                    ],
                    ["query", "node", "score"],
                )

    return run


def neighbours(df: DataFrame, queries: Column | str, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest other rows of each row for which ``queries`` holds.

    ``queries`` is a condition on ``vec_id``. Rows with a null id take no part, nor do vectors that are
    null, empty, zero, hold a null or non-finite component, or are not as long as most. Equal rows count
    once. Ties go to the smaller vec_id, also where a
    shard cuts its list.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = hold(_usable(df, vec_id, embedding), "vectors")
    first = Window.partitionBy("v").orderBy("vec_id")
    shown = rows.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= k + 1)
    entries = shown.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = hold(entries.withColumn("node", F.monotonically_increasing_id()), "entries")
    pivots = np.array([r["v"] for r in entries.orderBy(F.xxhash64("v"), "v").limit(PIVOTS).select("v").collect()], np.float64)
    asked = hold(rows.filter(queries).join(entries.select("v", "node"), "v").select("vec_id", "node"), "asked")
    shards = max(1, -(-entries.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))

    first_id = F.col("ids")[0].alias("first")
    held = entries.select(
        "node", first_id, "v", F.pmod(F.hash("node"), F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("kind")
    )
    asking = entries.join(asked.select("node").distinct(), "node", "left_semi").select(
        "node", first_id, "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.pmod(F.hash("node"), F.lit(blocks)).alias("block"), F.lit(1).alias("kind")
    )
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(shards * blocks, 100_000))
    dealt_out = held.unionByName(asking).repartition(tasks, "shard", "block").sortWithinPartitions("shard", "block", "kind", "node")
    if not len(pivots):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    scored = dealt_out.mapInArrow(_searching(pivots, k + 1), "query bigint, node bigint, score double")
    told = scored.join(entries.select("node", "ids"), "node")
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    told = told.withColumn("_n", F.row_number().over(nearest)).filter(F.col("_n") <= k + 1)
    each = told.select("query", "score", F.explode("ids").alias("vec_id"))
    closest = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    each = each.withColumn("_n", F.row_number().over(closest)).filter(F.col("_n") <= k + 1).drop("_n")
    out = asked.select(F.col("vec_id").alias("query_id"), F.col("node").alias("query")).join(each, "query").filter("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
