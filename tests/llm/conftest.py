"""Small tables with the awkward rows every operator must take."""

import random

import pytest

from clipstat.llm.common import table

SF = "/root/testdata/sf0.001"
#: Extra columns that clash with names the operators use inside.
CLASHING = "node string, part string, key int, size int, sequence string, _size int, _salt int"


@pytest.fixture(scope="session")
def prose():
    rng = random.Random(5)
    words = [a + b for a in ("ka", "lo", "mi", "ru", "te") for b in ("n", "s", "rt", "ba", "é")]
    return lambda n, seed=0: " ".join(random.Random(seed * 7919 + n).choice(words) + ("." if rng.random() < 0 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows(prose):
    base = prose(200, 1)
    near = base.replace("kan", "kas", 1)
    passage = prose(60, 2)
    return [
        (1, None, "en", "s1", None), (2, "", None, None, 0), (3, " \t\n ", "en", "s1", 4), (4, base, "en", "s1", 1),
        (5, base, "en", "s2", 1), (6, base.upper().lower().replace(" ", "  "), "en", "s2", 1), (7, near, None, "s1", 1),
        (8, "one two three", "de", "s3", 13), (9, "One  two\tthree", "de", "s3", 14), (10, prose(20_000, 3), "de", None, 1),
        (11, prose(40, 4) + " " + passage + " " + prose(30, 5), "fr", "s3", 1), (12, prose(33, 6) + " " + passage, "fr", "s3", 1),
        (13, "12345 !!! ...", "en", "s1", 13), (8, "one two three", "de", "s3", 13), (None, prose(70, 7), "en", "s1", 1),
        (14, "kan " * 300, "en", "s1", 1), (15, "漢字 🙂 é\u0301 <|endoftext|>  x\xa0y", "fr", "s2", 1), (16, prose(70, 7), "en", "s1", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + CLASHING
    return spark.createDataFrame([r + ("n", "p", 1, 2, "q", 3, 4) for r in odd_rows], schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="session")
def rows_of(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
