import zlib

from clipstat.llm import language_id as L
from clipstat.llm import queries
from tests.llm.conftest import SF


def test_held_out_accuracy(spark, documents):
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    rows = queries.op1_language(spark, SF).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0}
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(odd, odd_rows, documents, none):
    network = L.learned(documents)
    out = L.identified(odd, network)
    assert out.columns == [*odd.columns, "_lang"]
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r._lang.lang_pred == "und") == (not letters) and (letters or r._lang.score == 0)
    assert L.identified(none, network).count() == 0
    untrained = L.learned(none)
    assert {r._lang.lang_pred for r in L.identified(odd, untrained).collect()} == {"und"}


def test_same_rows_give_the_same_network(documents):
    usable = documents.select("text", "lang")
    a, b = L.sample(usable), L.sample(usable.repartition(5, "text"))
    assert a == b and (L.train(a[:60], 1).dense == L.train(b[:60], 1).dense).all()


def test_a_filter_runs_the_network_once(documents):
    found = L.identified(documents.select("doc_id", "text"), L.learned(documents)).filter("_lang.lang_pred <> 'und' and _lang.score > 0.5")
    plan = found.select("doc_id", "_lang.lang_pred")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_every_language_is_sampled_unless_bounded(spark):
    rows = [(f"word{i} text {'abc' * (i % 5)}", f"l{i:03d}") for i in range(80)] + [("once more", "l007")]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert len({lang for _, lang in L.sample(df)}) == 80
    assert {lang for _, lang in L.sample(df, most_langs=1)} == {"l007"}
