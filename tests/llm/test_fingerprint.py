import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyad.llm import fingerprint as fp

from .conftest import ODD


def test_span_equality_and_common_extension_match_brute_force():
    rng = random.Random(2)
    for _ in range(40):
        a = "".join(rng.choice("ab漢") for _ in range(rng.randint(0, 60)))
        b = a[: rng.randint(0, 60)] + "".join(rng.choice("ab漢") for _ in range(20))
        p, q = fp.Prefix(a), fp.Prefix(b)
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        n = 0
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        assert fp.common_extension(p, i, q, j) == n
        length = rng.randint(0, min(len(a) - i, len(b) - j))
        assert (p.span(i, length) == q.span(j, length)) == (a[i : i + length] == b[j : j + length])


def test_fingerprint_keeps_the_smallest_distinct_hashes():
    for text in [*filter(None, ODD), "ab" * 500]:
        prefix = fp.Prefix(text)
        length = min(fp.SPAN, len(text))
        all_hashes = np.unique(fp._mixed(np.array([prefix.span(i, length) for i in range(len(text) - length + 1)][:3000], np.uint64)))
        if len(text) < 3000:
            assert (fp.fingerprint(text) == all_hashes[: fp.SIZE]).all()
        assert fp.likeness(fp.fingerprint(text), fp.fingerprint(text)) == 1.0
    assert fp.likeness(fp.fingerprint(""), fp.fingerprint("")) == 1.0
    assert fp.likeness(fp.fingerprint(""), fp.fingerprint("x")) == 0.0
    rng = random.Random(1)
    a = "".join(rng.choice("abcdefgh") for _ in range(4000))
    assert 0.7 < fp.likeness(fp.fingerprint(a), fp.fingerprint(a[:3700])) and fp.likeness(fp.fingerprint(a), fp.fingerprint(a[::-1])) < 0.1


@pytest.mark.parametrize("parts", [1, 4])
def test_neighbours_match_brute_force(docs_of, prose, parts):
    rows = [(3 * i, prose(i, 10 + i)) for i in range(60)] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(7, "twin"), (7, "twins"), (8, "same"), (8, "same"), (None, "no id"), (None, "no id 2")]
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    expected = sorted(
        ((d, len(t), hashlib.sha256(fp.edited(t, order[(k + 1) % len(order)][1]).encode()).hexdigest()) for k, (d, t) in enumerate(order)), key=str
    )
    found = fp.neighbours(docs_of(rows, parts)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=str) == expected
    by_text = {r.fingerprint for r in found if r.doc_id == 8}
    assert len(by_text) == 1 and all(0 <= x <= 1 for r in found for x in (r.near_edited, r.near_next))


def test_one_row_and_empty_tables(docs_of):
    (row,) = fp.neighbours(docs_of([(5, "abcdefghi")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefabc").hexdigest() and row.kept_chars == 6
    assert fp.neighbours(docs_of([]).limit(0)).count() == 0


def test_every_bucket_has_a_task_of_its_own(spark, docs_of, prose):
    docs = docs_of([(i, prose(i, 4)) for i in range(400)])
    dealt = fp.with_next(docs, 16).withColumn("task", F.spark_partition_id())
    found = dealt.groupBy("task").agg(F.count_distinct("bucket").alias("buckets"), F.count("*").alias("n")).collect()
    assert {r.buckets for r in found} == {1} and len(found) == 16
    assert max(r.n for r in found) <= 3 * min(r.n for r in found)
