"""Helpers shared by the operators: held tables, word hashes, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstat.session import shared_folder

#: Words are runs of anything but these six bytes; ``bytes.split()`` cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"

_held: dict[str, str] = {}


def hold(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once to the shared folder and read it back.

    What the write shuffled is of no use after it, so Spark is asked to delete those files at its end.
    """
    spark, setting = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(setting, before)
    back = spark.read.schema(df.schema).parquet(path)
    back._held_at = path
    return back


def release(*tables: DataFrame) -> None:
    """Delete held tables that nothing will read again."""
    for df in tables:
        path = getattr(df, "_held_at", None)
        if path:
            spark = df.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def is_empty_table(df: DataFrame) -> bool:
    return not df.take(1)


def parts_for(spark: SparkSession, rows_per_part: int, rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_part))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names, so further columns can't clash."""
    return df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of an unsigned 64-bit array over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int = 0) -> np.ndarray:
    step = np.uint64(0x9E3779B97F4A7C15)
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt * 1_000_003)) * step)


class WordHashes(dict):
    """64-bit hashes of byte words, remembered up to a bound."""

    BOUND = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def byte_texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array per row."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


#: Rows of whole texts that a worker holds as Python objects at a time.
TEXT_ROWS = 1000


def short_batches(spark: SparkSession) -> None:
    """Texts are long: no more than ``TEXT_ROWS`` of them go to a worker in one Arrow batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXT_ROWS:
        spark.conf.set(name, str(TEXT_ROWS))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` with one call per ``TEXT_ROWS`` rows."""
    short_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXT_ROWS):
                yield fn(batch.slice(start, TEXT_ROWS))
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def null_safe(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)
