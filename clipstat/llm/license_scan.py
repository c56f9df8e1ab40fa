"""License texts in documents: MinHash bands over overlapping windows, then exact shingle containment.

Words are runs of ASCII letters, digits and bytes above 127, so comment marks and punctuation do not count; a
shingle is three words, or the whole text if it has fewer. A template of more than ``M / 2`` and at most ``M``
shingles (``M`` a power of two) is sought in windows of ``M`` shingles and one stride, a stride of ``M / 2``
apart, so windows follow the size of what they look for, every shingle of every document lies in a window, and
a stretch of ``M`` shingles lies whole in one.

A template and a window share a band when the least of their permuted shingles is the same one (bands of one
row: a short text in a longer window has a low similarity). Of the template's ``n`` shingles a document holds
the share ``c``; each of them is the least of the template and of a window around it with probability
``1 / (n + W - 1)`` at least, whatever else the document holds. So a band misses with
``1 - c n / (n + W - 1)`` at most, all ``BANDS`` with 7e-7 at most for ``c`` = 0.8, and fewer for whole copies.

A permuted shingle is a one-to-one image of the shingle, so a window of no template shingle shares no band, and
minima are taken only over texts that a bitmap of all template shingles does not rule out. Documents that share
a band are counted exactly: their shingles meet the template's in a join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstat.llm.common import WordHashes, arrow_map, byte_texts, hold, lists, mixed, seeds
from clipstat.llm.license_texts import TEMPLATES
from clipstat.session import ship_package

SHINGLE = 3
#: A document holds a template when 100 * common >= PERCENT * shingles of the template.
PERCENT = 80
BANDS = 64
#: Bits of the bitmap of template shingles, whatever the list; cells of a matrix of permuted shingles.
BITS, CELLS = 1 << 21, 1 << 20

_PERMUTED = seeds(BANDS, 11)
_PLACE = seeds(SHINGLE, 12) | np.uint64(1)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def shingles(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Hashes of all shingles of a whole text, in order; no word makes none."""
    words = hashes.of((text or b"").translate(_PLAIN).split())
    n = len(words)
    if n < SHINGLE:
        return mixed(np.array([(words * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)], np.uint64)) if n else words
    total = words[: n - SHINGLE + 1] * _PLACE[0]
    for j in range(1, SHINGLE):
        total = total + words[j : n - SHINGLE + 1 + j] * _PLACE[j]
    return mixed(total)


def size_class(n: int) -> int:
    """The least power of two that is not below ``n``."""
    return 1 << (n - 1).bit_length()


def miss_probability(n: int, share: float = PERCENT / 100) -> float:
    """Bound on the probability that no band meets a template of ``n`` shingles of which a text holds ``share``."""
    m = size_class(n)
    return (1 - share * n / (n + m + max(1, m // 2) - 1)) ** BANDS


def _keys(least: np.ndarray, band: np.ndarray, m: int) -> np.ndarray:
    return mixed(mixed(least ^ seeds(BANDS, 13)[band]) ^ np.uint64(m))


def template_keys(items: np.ndarray) -> np.ndarray:
    """A template's band keys, from its distinct shingles."""
    m = size_class(len(items))
    return _keys(mixed(items[None, :] ^ _PERMUTED[:, None]).min(1), np.arange(BANDS), m).view(np.int64)


def window_keys(items: np.ndarray, known: np.ndarray, m: int) -> np.ndarray:
    """Distinct band keys of a text's windows for class ``m`` whose least shingle is one of ``known``."""
    stride = max(1, m // 2)
    blocks = -(-len(items) // stride)
    across = min(blocks, (m + stride) // stride)
    out = []
    step = max(1, CELLS // len(items))
    for start in range(0, BANDS, step):
        permuted = _PERMUTED[start : start + step, None]
        values = np.full((len(permuted), blocks * stride), _LAST, np.uint64)
        values[:, : len(items)] = mixed(items[None, :] ^ permuted)
        least = values.reshape(len(permuted), blocks, stride).min(2)
        windows = least[:, : blocks - across + 1]
        for k in range(1, across):
            windows = np.minimum(windows, least[:, k : blocks - across + 1 + k])
        band, at = np.nonzero(np.isin(windows, mixed(known[None, :] ^ permuted).ravel()))
        out.append(_keys(windows[band, at], band + start, m))
    return np.unique(np.concatenate(out)).view(np.int64)


def template_sets(templates: DataFrame) -> DataFrame:
    """``(license, text)`` to license, n (distinct shingles), m (size class), items, keys; a text without words is none."""
    ship_package(templates.sparkSession)
    hashes = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [np.unique(shingles(t, hashes)) for t in byte_texts(batch.column("text"))]
        some = [k for k, s in enumerate(sets) if len(s)]
        sets = [sets[k] for k in some]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("license").take(pa.array(some, pa.int64())),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([size_class(len(s)) for s in sets], pa.int64()),
                lists([s.view(np.int64) for s in sets], pa.int64()),
                lists([template_keys(s) for s in sets], pa.int64()),
            ],
            ["license", "n", "m", "items", "keys"],
        )

    rows = templates.select(F.col("license").cast("string"), F.col("text").cast("string"))
    return arrow_map(rows, run, "license string, n bigint, m bigint, items array<bigint>, keys array<bigint>")


def _bitmap(sets: DataFrame) -> np.ndarray:
    """One bit per shingle hash of any template: at most ``BITS`` numbers, whatever the list."""
    bit = F.explode(F.transform("items", lambda x: x.bitwiseAND(F.lit(BITS - 1)).cast("int"))).alias("bit")
    marks = np.zeros(BITS, bool)
    marks[[r["bit"] for r in sets.select(bit).distinct().collect()]] = True
    return np.packbits(marks, bitorder="little")


def scanned(df: DataFrame, sets: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, keys (bands met by a window), items (shingles that may be of a template)."""
    ship_package(df.sparkSession)
    hashes = WordHashes()
    marks = _bitmap(sets)
    classes = sorted(r["m"] for r in sets.select("m").distinct().collect())
    none = np.zeros(0, np.int64)

    def one(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        items = shingles(text, hashes)
        bit = items & np.uint64(BITS - 1)
        known = np.unique(items[(marks[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1])
        if not len(known):
            return none, none
        keys = [window_keys(items, known, m) for m in classes]
        return np.concatenate(keys), known.view(np.int64)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [one(t) for t in byte_texts(batch.column("text"))]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), lists([k for k, _ in found], pa.int64()), lists([i for _, i in found], pa.int64())],
            ["doc_id", "keys", "items"],
        )

    return arrow_map(df, run, "doc_id bigint, keys array<bigint>, items array<bigint>")


def given_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "license string, text string")


def licenses(df: DataFrame, templates: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, licenses (array of license, n_shingles, common; by license).

    Rows with equal or null ids are judged each by its own text. Templates of one name are judged each; one of
    fewer than three words is found only where it is the whole text.
    """
    sets = hold(template_sets(templates).withColumn("template", F.monotonically_increasing_id()), "templates")
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = hold(scanned(docs, sets).withColumn("row", F.monotonically_increasing_id()), "scanned")
    some = rows.filter(F.size("keys") > 0)
    met = some.select("row", F.explode("keys").alias("key")).join(sets.select("template", F.explode("keys").alias("key")), "key")
    met = met.select("row", "template").distinct()
    shared = some.select("row", F.explode("items").alias("item")).join(sets.select("template", F.explode("items").alias("item")), "item")
    common = shared.groupBy("row", "template").agg(F.count("*").alias("common")).join(met, ["row", "template"])
    held = common.join(sets.select("template", "license", "n"), "template").filter(F.lit(100) * F.col("common") >= F.lit(PERCENT) * F.col("n"))
    named = F.sort_array(F.collect_list(F.struct("license", F.col("n").alias("n_shingles"), "common")))
    found = rows.select("row", "doc_id").join(held.groupBy("row").agg(named.alias("licenses")), "row", "left")
    empty = F.array().cast("array<struct<license:string,n_shingles:bigint,common:bigint>>")
    return found.select("doc_id", F.coalesce("licenses", empty).alias("licenses"))
