import hashlib
import zlib

import pytest

from clipstat.llm import manifest as M
from tests.compare import differences, duck
from tests.llm.conftest import SF


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def coded(values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""

    def tree(nodes):
        all_levels = [nodes]
        while len(all_levels[-1]) > 1:
            last = all_levels[-1]
            all_levels.append([sha("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
        return all_levels

    def walk(all_levels, place, fold):
        proof = ""
        for level in all_levels[:-1]:
            run = level[place // 16 * 16 : place // 16 * 16 + 16]
            own = place % 16
            proof += "".join(run[:own] + run[own + 1 :])
            fold, place = sha("".join(run[:own] + [fold] + run[own + 1 :])), place // 16
        return proof, fold

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {s: sorted(((sha(coded(r)), r) for r in groups[s]), key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0])) for s in sources}
    trees = {s: tree([leaf for leaf, _ in ordered[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for place, (leaf, r) in enumerate(ordered[s]):
            changed = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                changed = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            proof, fold = walk(trees[s], place, sha(coded(changed)))
            more, fold = walk(top, k, fold)
            root = top[-1][0]
            out.append((r[0], leaf, trees[s][-1][0], root, sha(proof + more), fold, fold == root))
    return sorted(out, key=repr)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_given_documents_equal_sql(spark):
    from clipstat.llm.common import table

    assert differences(spark, duck(SF), SF, lambda s, d: M.manifest(table(s, d, "documents")), M.MANIFEST_SQL) == []


def test_odd_rows(odd, odd_rows):
    assert as_rows(M.manifest(odd)) == plain([(r[0], r[3], r[2], r[4], r[1]) for r in odd_rows])


@pytest.mark.parametrize("sizes", [[16], [1, 17, 16, 257] + [2] * 14])
def test_runs_of_every_length(spark, sizes):
    rows, n = [], 0
    for s, size in enumerate(sizes):
        for _ in range(size):
            rows.append((n * 7 % 1009, f"s{s}" if s else None, "EN", n, f"Text {n}"))
            n += 1
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert as_rows(M.manifest(df)) == plain(rows)


def test_a_level_is_a_native_plan(spark):
    plan = M.leaves(spark.createDataFrame([(1, "s", "l", 2, "t")], "doc_id bigint, source string, lang string, n_chars bigint, text string"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_empty(none):
    assert M.manifest(none).count() == 0
