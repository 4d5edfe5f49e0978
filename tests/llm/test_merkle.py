import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from polyad.llm import merkle

from .conftest import ODD


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def up(nodes, fanout):
    """All levels of a tree."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def path(levels, at, fanout):
    out = []
    for level in levels[:-1]:
        run = at // fanout * fanout
        out.append(("".join(level[run:at]), "".join(level[at + 1 : run + fanout])))
        at //= fanout
    return out


def by_hand(rows, fanout=3):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text)."""
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda row: sha("".join(map(field, row)))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = [sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources]
    levels = [up([leaf(r) for r in tree], fanout) for tree in trees]
    top = up([x[-1][0] for x in levels], fanout)
    out = []
    for s, tree in enumerate(trees):
        for i, row in enumerate(tree):
            proof = path(levels[s], i, fanout) + path(top, s, fanout)
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            h = leaf((*row[:4], text))
            for a, b in proof:
                h = sha(a + h + b)
            out.append((row[0], leaf(row), levels[s][-1][0], top[-1][0], sha("".join(a + b for a, b in proof)), h, h == top[-1][0]))
    return out


def table(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, block int, rank long, top string").repartition(parts)


def manifest(docs, **how):
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    changed = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return [tuple(r) for r in merkle.manifest(merkle.leaves(docs, changed={"text": changed}), **how).collect()]


def rows_of(sizes, prose):
    return [(100 * k + i * (7 if k % 2 else 1), source, None if i % 5 == 0 else "en", i if i % 3 else None, prose(i, 3) + "\n" * (i % 2)) for k, (source, n) in enumerate(sizes.items()) for i in range(n)]


@pytest.mark.parametrize(("fanout", "levels"), [(3, 1), (3, 2), (2, 1), (5, 1), (3, 7)])
def test_trees_of_all_sizes(spark, docs_of, prose, fanout, levels):
    docs_of([])  # a shared folder
    sizes = {None: 5, "": 1, "=": 2, "a": 3, "A": 4, "é": 9, "z": 10, "hot": 100, "漢": 28, "\U0001f600": 27}
    rows = rows_of(sizes, prose)
    assert sorted(map(str, manifest(table(spark, rows), fanout=fanout, levels=levels))) == sorted(map(str, by_hand(rows, fanout)))


def test_odd_rows(spark, docs_of):
    docs_of([])
    rows = [(i, "s", None, None, t) for i, t in enumerate(ODD)]
    rows += [(None, "s", "en", 1, "no\nnumber")] * 2 + [(None, None, None, None, None)] * 2 + [(4, "s", "a", 1, "one"), (4, "s", "a", 1, "two"), (4, "s", "a", 1, "two")]
    for levels in (1, 7):
        assert sorted(map(str, manifest(table(spark, rows), levels=levels))) == sorted(map(str, by_hand(rows)))


def test_partitions_do_not_matter(spark, docs_of, prose):
    docs_of([])
    rows = rows_of({"a": 40, "b": 7}, prose)
    assert sorted(manifest(table(spark, rows, 1), levels=1)) == sorted(manifest(table(spark, rows, 9), levels=1))


def test_proofs_fold_to_the_root_and_notice_changes(spark, docs_of, prose):
    docs_of([])
    found = merkle.proofs(merkle.leaves(table(spark, rows_of({"a": 30, "b": 1}, prose))), levels=1).collect()
    for r in found:
        proof = [tuple(x) for x in r.proof]
        assert merkle.fold(r.leaf, proof) == r.top
        assert not proof or merkle.fold(sha(r.leaf), proof) != r.top
    assert {len(r.proof) for r in found} == {4, 0}


def test_every_group_of_a_round_has_as_many_members(spark, docs_of, prose):
    docs_of([])
    n, fanout = 22, 3  # blocks of one tree: 27 with the empty ones
    state = spark.createDataFrame([("t", n, 27, b, sha(str(b)) if b < n else None, [] if b < n else None) for b in range(27)], "tree string, n long, power long, block long, top string, upper array<struct<before:string,after:string>>")
    for r in range(3):
        groups = state.groupBy(F.expr(f"block div {fanout ** (r + 1)}"), F.col("block") % fanout**r).count()
        assert {g["count"] for g in groups.collect()} == {fanout}
        state = merkle.swap(state, r, fanout)
    tops = {x.top for x in state.collect()}
    assert tops == {up([sha(str(b)) for b in range(n)], fanout)[-1][0]}  # every block hashed the root for itself


def test_empty_table(spark, docs_of):
    docs_of([])
    assert manifest(table(spark, [(1, "a", "b", 1, "c")]).limit(0)) == []
