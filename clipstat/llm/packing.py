"""Best-fit packing of documents into fixed sequences by matching large pieces.

Every document becomes token pieces of at most one sequence. How pieces share sequences depends on
their lengths only, so the plan is made from the counts per length, at most ``capacity`` numbers
whatever the data: pieces above a third of the capacity meet at most two in a sequence and are matched
greedily, largest first with the largest partner that fits; smaller ones go, longest first, into the
smallest gap that takes them. The plan is a list of runs (length, ranks, sequences, offset); each piece
finds its run by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstat.llm.common import arrow_map, hold, texts_of
from clipstat.llm.tokens import packed_ids
from clipstat.session import ship_package

CAPACITY = 1024
END_ID = 2
#: Ranks of one length are counted in so many parts; whole sequences, the most frequent length, in more.
SALTS, WHOLE_SALTS = 64, 4096

Run = tuple[int, int, int, int, int]


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and packed ids if wanted.

    The ids of the text and the end id; cut only above the capacity, then the first piece takes the
    remainder. A null or empty text is its end id alone.
    """
    ship_package(df.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else [])]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple] = []
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for doc, ids in zip(batch.column("doc_id").to_pylist(), packed_ids(texts, path)):
            ids += end
            n = len(ids) // 4
            cuts = [0, *range(n % capacity or capacity, n, capacity), n]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                part = ids[4 * a : 4 * b]
                rows.append((doc, k, a, b - a, zlib.crc32(part), part)[: len(names)])
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    return arrow_map(texts_of(df, doc_id, text), run, schema)


class _Plan:
    """Runs of pieces of one length over consecutive sequences."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.rank: dict[int, int] = defaultdict(int)
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.sequences = 0
        self.runs: list[Run] = []

    def put(self, length: int, count: int, first: int, offset: int) -> None:
        self.runs.append((length, self.rank[length], count, first, offset))
        self.rank[length] += count
        self.left[length] -= count

    def opened(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def pair(self, length: int, partner: int | None) -> None:
        """Open sequences for all large pieces of a length, or for as many as have the partner."""
        if partner is None:
            count = self.left[length]
        else:
            count = self.left[length] // 2 if partner == length else min(self.left[length], self.left[partner])
        first = self.opened(count)
        self.put(length, count, first, 0)
        used = length
        if partner is not None:
            self.put(partner, count, first, length)
            used += partner
        if used < self.capacity:
            self.gaps[self.capacity - used].append((first, count))

    def fit(self, length: int, gap: int) -> None:
        """One run of small pieces into sequences of a gap."""
        first, count = self.gaps[gap].pop()
        used = min(count, self.left[length])
        self.put(length, used, first, self.capacity - gap)
        if used < count:
            self.gaps[gap].append((first + used, count - used))
        if gap > length:
            self.gaps[gap - length].append((first, used))

    def fill(self, length: int) -> None:
        """Small pieces that no gap takes: new sequences of nothing else."""
        each = self.capacity // length
        full, rest = divmod(self.left[length], each)
        for size, count in ((each, full), (rest, 1)):
            if size and count:
                first = self.opened(count)
                for k in range(size):
                    self.put(length, count, first, k * length)
                if size * length < self.capacity:
                    self.gaps[self.capacity - size * length].append((first, count))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs ``(length, first rank, count, first sequence, offset)`` that place every piece."""
    made = _Plan(counts, capacity)
    large = sorted((n for n in made.left if 3 * n > capacity), reverse=True)
    for length in large:
        while made.left[length]:
            fits = (n for n in large if n <= length and n + length <= capacity and made.left[n] > (n == length))
            partner = next(fits, None)
            made.pair(length, partner)
    for length in sorted((n for n in made.left if 3 * n <= capacity), reverse=True):
        while made.left[length]:
            gap = min((g for g, open_ in made.gaps.items() if g >= length and open_), default=None)
            if gap is None:
                made.fill(length)
            else:
                made.fit(length, gap)
    return made.runs


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces that carry doc_id, piece, length and ids_crc32."""
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = np.array(sorted(plan(counts, capacity)) or np.zeros((0, 5)), np.int64)
    key = (runs[:, 0] << 44) + runs[:, 1]

    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.when(F.col("length") == capacity, WHOLE_SALTS).otherwise(SALTS)))
    # At most capacity * SALTS + WHOLE_SALTS rows.
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_row", F.row_number().over(order)).join(F.broadcast(base), ["length", "_salt"])
    ranked = ranked.select(*cut.columns, (F.col("_base") + F.col("_row") - 1).alias("_rank"))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("_rank"))
        at = np.searchsorted(key, (length << 44) + rank, "right") - 1
        found = runs[at]
        rest = [c for c in batch.schema.names if c != "_rank"]
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in rest] + [pa.array(found[:, 3] + rank - found[:, 1]), pa.array(found[:, 4])],
            [*rest, "sequence_id", "offset"],
        )

    schema = ", ".join(f"{n} {k}" for n, k in cut.dtypes) + ", sequence_id bigint, offset bigint"
    return arrow_map(ranked, place, schema)


def packed(df: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents to placed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    An empty table packs to none. Rows that share a doc_id are separate documents; equal rows are
    interchangeable.
    """
    return pack(hold(pieces(df, path, capacity, with_ids=with_ids, doc_id=doc_id, text=text), "pieces"), capacity)
