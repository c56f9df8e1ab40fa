import pytest

from clipstat.llm import substring_dedup as S
from tests.llm.plain import without_repeats


def as_dict(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_text.encode()) for r in df.collect()}


def test_given_documents_equal_brute_force(documents, rows_of):
    assert as_dict(S.without_repeats(documents)) == without_repeats(rows_of)


@pytest.mark.parametrize("rows", [1, 5, 100_000])
def test_long_prefixes_and_single_nodes_give_the_same(documents, rows_of, monkeypatch, rows):
    monkeypatch.setattr(S, "GROUP_ROWS", rows)
    monkeypatch.setattr(S, "UNEVEN", 0)
    monkeypatch.setattr(S, "BUCKETS", 64)
    assert as_dict(S.without_repeats(documents)) == without_repeats(rows_of)


def test_odd_rows(odd, odd_rows):
    out = S.without_repeats(odd, carry=("lang", "key"))
    assert out.columns == ["doc_id", "lang", "key", "n_words", "n_removed", "kept_text"]
    want = without_repeats({r[0]: r[1] for r in odd_rows if r[0] is not None})
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        if r.doc_id is None:
            assert r.n_removed == 0 and r.n_words == 70
        else:
            assert (r.n_words, r.n_removed, r.kept_text.encode()) == want[r.doc_id]
    assert want[5][1] == 200 and want[12][1] >= 60 and want[14][1] == 0 and want[16][1] == 0


def test_rows_that_share_an_id_are_told_apart(spark, prose):
    rows = [(1, prose(60, 1)), (2, prose(10, 2)), (2, prose(60, 1)), (2, prose(30, 3) + " " + prose(60, 1)), (3, prose(60, 1)[:-3])]
    got = {(r.doc_id, r.n_words): r.n_removed for r in S.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1, 60] == 0 and got[2, 10] == 0 and got[2, 60] == 60 and got[2, 90] == 60


def test_untouched_texts_stay_as_they_are(spark, prose):
    rows = [(1, " two  spaces\n"), (2, prose(80, 4)), (3, "x  " + prose(80, 4))]
    got = {r.doc_id: r.kept_text for r in S.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), rejoin=False).collect()}
    assert got == {1: rows[0][1], 2: rows[1][1], 3: "x"}


def test_empty(none):
    assert S.without_repeats(none).count() == 0
