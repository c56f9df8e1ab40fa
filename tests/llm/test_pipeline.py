"""The pipeline's stages against plain Python, each on its own input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clipstat.llm.stages import COLUMNS
from tests.llm.conftest import SF
from tests.llm.plain import near_components, without_repeats
from tests.llm.test_tokens import check_packing


@pytest.fixture(scope="module")
def steps(spark, documents):
    out, docs = [documents.collect()], documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        rows = docs.collect()
        out.append(rows)
        docs = spark.createDataFrame(rows, docs.schema)
    return out


def test_columns(steps):
    assert all(tuple(rows[0].__fields__) == COLUMNS for rows in steps[1:-1])


def test_clean_documents_pass_language_id(steps):
    assert {r.doc_id for r in steps[1]} == {r.doc_id for r in steps[0] if any(c.isalpha() for c in r.text)}


def test_one_of_each_near_group_stays(steps):
    want = near_components({r.doc_id: r.text for r in steps[1]})
    assert sorted(r.doc_id for r in steps[2]) == sorted(d for d, (_, c) in want.items() if c == d)


def test_repeated_passages_go(steps):
    before = {r.doc_id: r.text for r in steps[2]}
    want = without_repeats(before)
    got = {r.doc_id: r for r in steps[3]}
    assert got.keys() == {d for d, (n, gone, _) in want.items() if gone < n or not gone}
    for d, r in got.items():
        assert r.text == (want[d][2].decode() if want[d][1] else before[d])
        assert not want[d][1] or r.n_chars == len(r.text)


def test_mix_repeats_whole_documents(steps):
    before = {r.doc_id: r for r in steps[3]}
    assert all(r == before[r.doc_id] for r in steps[4]) and max(Counter(r.doc_id for r in steps[4]).values()) <= 3


def test_every_emitted_document_is_packed(steps):
    copies = Counter(r.doc_id for r in steps[4])
    check_packing(steps[5], {r.doc_id: r.text for r in steps[4] if copies[r.doc_id] == 1}, 1024)
    assert Counter(r.doc_id for r in steps[5] if r.piece == 0) == copies


def test_run_is_its_stages(spark, steps):
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, steps[5]))


def test_odd_rows_and_none(spark, odd, none):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF).count() >= 0
        assert stage(spark, none, SF).count() == 0


def test_rows_that_share_an_id_or_have_none(spark, prose):
    from clipstat.llm import stages

    base, other = prose(120, 1), prose(120, 2)
    near = base.replace("kan", "kas", 1)
    rows = [(3, base), (5, near), (5, other), (None, base), (None, prose(90, 3)), (None, prose(90, 3)), (7, None), (8, ""), (3, base)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = sorted(((r.doc_id, r.text) for r in stages.near_duplicates(spark, docs, SF).collect()), key=repr)
    assert got == sorted([(3, base), (5, other), (None, prose(90, 3)), (7, None), (8, "")], key=repr)
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert stages.language(spark, unlabelled, SF).count() == 7
