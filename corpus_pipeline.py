"""A training corpus from raw documents: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clipstat.llm import stages
from clipstat.llm.common import hold, release, table

STAGES = [
    ("language ID", stages.language),
    ("near-duplicates", stages.near_duplicates),
    ("repeated passages", stages.repeated_passages),
    ("source mix", stages.source_mix),
    ("packing", stages.packed_sequences),
]

#: Trained models, sketches and token ids have no SQL form; the tests compare run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``: placed token pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, hold(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
