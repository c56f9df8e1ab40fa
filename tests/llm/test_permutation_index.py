import numpy as np

from clipstat.llm import permutation_index as P
from clipstat.llm import queries
from clipstat.llm.common import table
from tests.llm.conftest import SF

EVERY = "vec_id % 20 = 0"


def brute(rows, k=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        score = (x * x[i]).sum(1)
        order = [j for j in np.lexsort((ids, -score)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    want, got = brute(rows), {}
    for r in queries.op6_neighbours(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == want.keys()
    true = {(q, v): s for q, best in want.items() for v, s in best}
    hits = [(q, v) in true for q, found in got.items() for _, v, _ in found]
    assert np.mean(hits) >= 0.9
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(true[q, v] - s) < 1e-12 for _, v, s in found if (q, v) in true)


def test_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD_ROWS", 90)
    monkeypatch.setattr(P, "BLOCK_ROWS", 7)
    df = table(spark, SF, "embeddings")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    got = P.neighbours(df, EVERY).collect()
    true = {(q, v) for q, best in want.items() for v, _ in best}
    assert np.mean([(r.query_id, r.vec_id) in true for r in got]) >= 0.9 and len(got) == 20 * len(want)


def test_odd_rows_ties_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (7, [1.0, 0.0, 0.0]), (None, [1.0, 1.0])]
    rows += [(i, [2.0, 1.0]) for i in range(40, 100)] + [(8, [1.0, 0.5]), (8, [1.0, 0.5])]
    df = spark.createDataFrame([(*r, "n", 1) for r in rows], "vec_id bigint, embedding array<float>, node string, query int")
    got = {}
    for r in P.neighbours(df, EVERY).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: list(range(40, 60)), 40: list(range(41, 61)), 60: list(range(40, 60)), 80: list(range(40, 60))}


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 1.0]), (5, [1.0, 1.0])], "vec_id bigint, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in P.neighbours(df, EVERY).collect())
    assert got == [(0, 1, 5), (0, 2, 20), (20, 1, 5), (20, 2, 0)]
    assert P.neighbours(df.limit(0), EVERY).columns == ["query_id", "rank", "vec_id", "score"]
    assert P.neighbours(df.limit(0), EVERY).count() == 0
    assert P.neighbours(df.limit(1), EVERY).count() == 0


def test_ties_at_a_shards_cut_go_to_the_smaller_id(spark, monkeypatch):
    """Sixty different vectors with one score: the twenty smallest ids win, whatever shards they are in."""
    monkeypatch.setattr(P, "SHARD_ROWS", 25)
    rows = [(1000, [1.0, 0.0])] + [(i, [0.5, float(i) + 1]) for i in range(60, 0, -1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    found = P.neighbours(df, "vec_id = 1000").orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == list(range(1, 21)) and {r["score"] for r in found} == {0.5}
