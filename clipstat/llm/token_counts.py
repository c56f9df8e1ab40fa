"""Token counts of whole texts; huge documents by overlapping chunks that are spliced.

A huge document is encoded in chunks that overlap, with the offsets of the tokens. Two neighbouring
chunks are spliced at a white-space character of their overlap: no token of this vocabulary holds white
space and no merge reaches over it, so both sides are then as in the whole text. Beyond that proof the
two encodings must agree on all tokens between the splice and the end of the overlap. Without such a
place the overlap is widened, at last to the whole rest before it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import short_batches
from clipstat.llm.tokens import tokenizer, word_counts
from clipstat.session import ship_package

#: Characters from which on a document counts as huge, of a chunk, and of an overlap at first.
HUGE, CHUNK, OVERLAP = 65_536, 32_768, 512

Tokens = list[tuple[int, int, int]]


def _encoded(text: str, start: int, end: int, path: str) -> Tokens:
    """Tokens of a chunk: id, start and end in the whole text."""
    found = tokenizer(path).encode(text[start:end], add_special_tokens=False)
    return [(i, a + start, b + start) for i, (a, b) in zip(found.ids, found.offsets)]


def _splice(text: str, left: Tokens, right: Tokens, start: int, end: int) -> int | None:
    """A place in the overlap from ``start`` to ``end`` where both encodings may be joined."""
    stop = next((p for p in range(end - 1, start, -1) if text[p].isspace()), None)
    if stop is None:
        return None
    for place in range(start + 1, stop):
        if not text[place].isspace():
            continue
        ours = [t for t in left if place <= t[1] < stop]
        theirs = [t for t in right if place <= t[1] < stop]
        whole = all(not a < place < b for side in (left, right) for _, a, b in side)
        if ours and ours == theirs and whole:
            return place
    return None


def spliced(text: str, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Tokens:
    """Tokens of a text as of one call on the whole, from overlapping chunks."""
    done: Tokens = []
    begin, end = 0, min(len(text), chunk)
    last = _encoded(text, begin, end, path)
    while end < len(text):
        further, wide = min(len(text), end + chunk), overlap
        while True:
            start = max(begin, end - wide)
            if start == begin:
                # Nothing in common short of the whole: encode on from where the last chunk began.
                last, end = _encoded(text, begin, further, path), further
                break
            following = _encoded(text, start, further, path)
            place = _splice(text, last, following, start, end)
            if place is not None:
                done += [t for t in last if t[2] <= place]
                last = [t for t in following if t[1] >= place]
                begin, end = place, further
                break
            wide *= 2
    return done + last


def n_tokens(text: Column, path: str) -> Column:
    """Tokens of each whole text; null counts as empty."""

    @F.arrow_udf("bigint")
    def counted(texts: pa.Array) -> pa.Array:
        values = [t or "" for t in texts.to_pylist()]
        huge = [k for k, t in enumerate(values) if len(t) > HUGE]
        plain = word_counts([t if len(t) <= HUGE else "" for t in values], path)
        for k in huge:
            plain[k] = len(spliced(values[k], path))
        return pa.array(plain, pa.int64())

    return counted(text)


def token_counts(df: DataFrame, path: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit. Null texts are empty: 0 bytes, 0 tokens."""
    ship_package(df.sparkSession)
    short_batches(df.sparkSession)
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), n_tokens(F.col("text"), path).alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
