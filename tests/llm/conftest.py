from __future__ import annotations

import random

import pytest

#: Columns whose names the operators use themselves.
EXTRA = "lang string, source string, n_chars long, key long, score double, node long, bucket int, place long, found string, n long"


@pytest.fixture(scope="session")
def docs_of(spark, tmp_path_factory):
    """docs_of([(doc_id, text) or (doc_id, text, lang, source)]): documents with extra columns, over several partitions."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))

    def make(rows, parts=3):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or ""), 7, 0.5, 1, 2, 3, "x", 4) for r in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, {EXTRA}").repartition(parts)

    return make


@pytest.fixture
def prose():
    """prose(seed, n): n random words of a small vocabulary."""
    words = "the of and river stone green quickly under mountain seven paper window light carry drawn ever night sound field glass".split()

    def make(seed, n, vocabulary=()):
        rng = random.Random(seed)
        return " ".join(rng.choice([*words, *vocabulary]) + (f"{rng.randrange(400)}" if rng.random() < 0.4 else "") for _ in range(n))

    return make


#: Texts that every operator must take.
ODD = [None, "", " \n\t ", "a", "Ünï çødé 漢字 \U0001f600 ok", "12 34 !!! 5", "x" * 5000, "word " * 20000, "a\x1cb\x85c\xa0d", "tab\tand\x0bfeed\x0cend\r\n"]
