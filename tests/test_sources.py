from __future__ import annotations

import math

import pandas as pd
import pytest
from conftest import values

from polyad import session
from polyad.operators import schema
from polyad.sources import tables


def test_missing_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,x,s\n1,NA,NA\n2,,\n3,nan,ok\n4,1.5,\"quoted, text\"\n")
    df = tables.read_delimited(spark, str(tmp_path / "a.csv"), "k int, x double, s string")
    assert values(df) == [(1, None, None), (2, None, None), (3, None, "ok"), (4, 1.5, "quoted, text")]


def test_tab_separated_dates_and_round_trip(spark, make, tmp_path):
    df = make("k int, s string", [(1, "a"), (2, None)])
    tables.write_delimited(df, str(tmp_path / "t"), sep="\t")
    assert values(tables.read_tab_separated(spark, str(tmp_path / "t"), "k int, s string")) == [(1, "a"), (2, None)]
    (tmp_path / "d.txt").write_text("id\tstartdate\n1\t2001-02-03\n")
    assert str(tables.read_tab_separated(spark, str(tmp_path / "d.txt"), "id int, startdate date").first().startdate) == "2001-02-03"


def test_find_in_tree(spark, tmp_path):
    deep = tmp_path / "x" / "y"
    deep.mkdir(parents=True)
    (deep / "wanted.csv").write_text("k\n1\n")
    (deep / "other.csv").write_text("k\n2\n")
    assert values(tables.read_from_tree(spark, str(tmp_path), "wanted.csv", "k int")) == [(1,)]


def test_ragged_batches(spark, tmp_path):
    (tmp_path / "one.csv").write_text("iso,year,gdp\nAA,2000,1.5\nBB,2000,NA\n")
    (tmp_path / "two.csv").write_text("year,iso\n2001,CC\n")
    (tmp_path / "three.csv").write_text("what,ever\n1,2\n")
    paths = {n: str(tmp_path / f"{n}.csv") for n in ("one", "two", "three", "four")}
    rows, status = tables.read_batches(spark, paths, {"iso": "string", "year": "int", "gdp": "double", "pop": "double"})
    assert values(rows, "batch", "iso", "year", "gdp", "pop") == [
        ("one", "AA", 2000, 1.5, None),
        ("one", "BB", 2000, None, None),
        ("two", "CC", 2001, None, None),
    ]
    assert values(status, "batch", "loaded") == [("four", False), ("one", True), ("three", False), ("two", True)]
    none, _ = tables.read_batches(spark, {"four": paths["four"]}, {"iso": "string"})
    assert (none.count(), none.columns) == (0, ["batch", "iso"])


def test_broken_parquet_batch(spark, make, tmp_path):
    make("iso string, gdp double", [("AA", 1.0)]).write.parquet(str(tmp_path / "good"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part.parquet").write_bytes(b"not parquet")
    paths = {n: str(tmp_path / n) for n in ("good", "bad")}
    rows, status = tables.read_batches(spark, paths, {"iso": "string", "gdp": "double"}, fmt="parquet")
    assert values(rows) == [("good", "AA", 1.0)]
    assert values(status, "batch", "loaded") == [("bad", False), ("good", True)]


def test_stata_files(spark, tmp_path):
    source = tmp_path / "dta"
    source.mkdir()
    for i in range(3):
        frame = pd.DataFrame({"code": [i, i + 10], "gdp": [1.5, math.nan], "label": ["leftist", ""]})
        frame.to_stata(source / f"f{i}.dta", write_index=False)
    target = str(tmp_path / "out")
    tables.stata_to_parquet(spark, str(source), target, "code int, gdp double, label string, absent double", rows_per_chunk=1)
    found = values(spark.read.parquet(target))
    assert found == sorted([(i, 1.5, "leftist", None) for i in range(3)] + [(i + 10, None, None, None) for i in range(3)])


def test_replace_reads_its_own_target(spark, make, tmp_path):
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        tables.replace_table(make("k int", [(1,), (2,), (3,)]), path, fmt)
        read = (lambda p=path: spark.read.parquet(p)) if fmt == "parquet" else (lambda p=path: tables.read_delimited(spark, p, "k int"))
        tables.replace_table(read().where("k > 1"), path, fmt)
        assert values(read()) == [(2,), (3,)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["csv", "parquet"]


def test_typed_snapshot(spark, make, tmp_path):
    path = str(tmp_path / "snap")
    df = make("flag int, x double", [(1, 0.5), (0, 1.5), (None, 2.5), (1, 3.5)])
    tables.save_typed(schema.as_category(df, ["flag"]), path)
    assert tables.load_typed(spark, path, ["flag"]).dtypes == [("flag", "string"), ("x", "double")]
    assert values(spark.read.parquet(f"{path}/levels")) == [("flag", None, 1), ("flag", "0", 1), ("flag", "1", 2)]
    with pytest.raises(ValueError, match="lost"):
        tables.load_typed(spark, path, ["x"])


def test_name_map(spark, make, tmp_path):
    tables.save_name_map(make("COWcode int, `a b` int", [(1, 2)]), str(tmp_path / "map"))
    assert values(spark.read.parquet(str(tmp_path / "map"))) == [("COWcode", "co_wcode"), ("a b", "a_b")]


def test_nan_columns(spark, make, tmp_path):
    make("x double, y double", [(math.nan, 1.0)]).write.parquet(str(tmp_path / "p"))
    assert values(tables.read_landed(spark, str(tmp_path / "p"))) == [(None, 1.0)]


def test_stage_keeps_rows_and_schema(spark, make):
    df = schema.as_category(make("k int, x double", [(1, 0.5), (None, 1.5)]), ["k"])
    staged = session.stage(df, "test")
    assert (values(staged), staged.schema, schema.category_columns(staged)) == (values(df), df.schema, ["k"])
    assert session.checkpoint_folder(spark) in staged.inputFiles()[0]


def test_stage_tables_go_at_the_end_of_their_block(spark):
    from polyad import session

    with session.stages(spark):
        path = session.scratch_path(spark, "kept")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def folders(spark):
    import os

    root = session.checkpoint_folder(spark).removeprefix("file:")
    return {name.rsplit("-", 1)[0] for name in os.listdir(root) if name.startswith("own_")}


def test_results_outlive_their_inputs(spark, make):
    before = folders(spark)
    with session.stages(spark) as outer:
        with session.stages(spark) as inner:
            parts = session.stage(make("k int", [(1,), (2,)]), "own_parts")
            assert folders(spark) - before == {"own_parts"}
            kept = inner.keep(parts.where("k > 1"), "own_kept")
            assert folders(spark) - before == {"own_parts", "own_kept"}
        assert folders(spark) - before == {"own_kept"}
        last = outer.keep(kept, "own_last")
    assert folders(spark) - before == {"own_last"}
    assert values(last) == [(2,)]
    session.release(last)
    assert folders(spark) == before


def test_last_use_releases_a_stage_table(spark, make):
    before = folders(spark)
    with session.stages(spark):
        first = session.stage(make("k int", [(1,), (2,), (3,)]), "own_first")
        second = session.stage(first.where("k > 1"), "own_second", last_use_of=[first])
        assert folders(spark) - before == {"own_second"}
        third = session.stage(second.where("k > 2"), "own_third", last_use_of=[first, second, make("k int", [])])
        assert folders(spark) - before == {"own_third"}
        assert values(third) == [(3,)]
    assert folders(spark) == before


def test_a_failed_block_leaves_nothing(spark, make):
    before = folders(spark)
    with pytest.raises(RuntimeError), session.stages(spark):
        session.stage(make("k int", [(1,)]), "own_lost")
        raise RuntimeError
    assert folders(spark) == before


def test_quarantine_names_every_problem(spark, tmp_path):
    from polyad.sources import checked

    (tmp_path / "a.csv").write_text("k,x.y,d\n1,2.5,2001-01-01\nzz,bad,2001-02-03\n3,NA,\n4,5\n5,1,2,3\n6,nan,never\n7, 8 ,2001-01-09\n")
    (tmp_path / "b.csv").write_text("k,x.y,d\n9,1e5,2001-01-01\n")
    read = lambda **how: checked.read_checked(spark, str(tmp_path), "k int, `x.y` double, d date", **how)
    found = read()
    assert [(r[0], r[1], str(r[2])) for r in values(found.rows)] == [(1, 2.5, "2001-01-01"), (3, None, "None"), (7, 8.0, "2001-01-09"), (9, 1e5, "2001-01-01")]
    bad = [(r.file.rsplit("/", 1)[1], r.line, r.problems) for r in found.quarantine.orderBy("row").collect()]
    assert bad == [("a.csv", "zz,bad,2001-02-03", ["k: zz", "x.y: bad"]), ("a.csv", "4,5", ["cells"]), ("a.csv", "5,1,2,3", ["cells"]), ("a.csv", "6,nan,never", ["d: never"])]
    assert [(r[0].rsplit("/", 1)[1], *r[1:]) for r in values(found.counts)] == [("a.csv", 7, 4, 5), ("b.csv", 1, 0, 0)]
    kept = read(keep=True)
    assert values(kept.rows, "k") == [(None,), (1,), (3,), (6,), (7,), (9,)]
    assert kept.quarantine.count() == 4


def test_quarantine_of_nothing(spark, tmp_path):
    from polyad.sources import checked

    (tmp_path / "a.csv").write_text("k,x\n")
    found = checked.read_checked(spark, str(tmp_path), "k int, x double")
    assert [t.count() for t in found] == [0, 0, 0]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_source_order_survives_shuffles(spark, tmp_path, fmt):
    from pyspark.sql import functions as F

    from polyad.operators import ranking
    from polyad.sources import ordered

    rows = spark.range(4000).select((F.col("id") % 100).alias("k"), F.col("id"), F.xxhash64("id").alias("mess"))
    for part in range(4):  # the file's order is that of no column
        chosen = rows.where(F.col("id") % 4 == part).repartition(1).sortWithinPartitions("mess")
        chosen.write.format(fmt).save(f"{tmp_path}/t/part={part}")
    read = spark.read.schema(rows.schema).option("maxPartitionBytes", 20_000).format(fmt).load(f"{tmp_path}/t")
    order = [(r.part, r.mess, r.id, r.k) for r in sorted(read.collect(), key=lambda r: (r.part, r.mess))]
    noted = ordered.with_source_order(read).repartition(7, "id")
    assert [r.id for r in noted.orderBy("source_order").collect()] == [r[2] for r in order]
    first = {}
    for *_, i, k in order:
        first.setdefault(k, i)
    assert {r.k: r.id for r in ranking.first_in_source(read, ["k"]).collect()} == first


def test_only_scans_have_a_source_order(spark, make):
    from polyad.sources import ordered

    with pytest.raises(ValueError, match="scanned"):
        ordered.with_source_order(make("k int", [(1,)]))
    assert ordered.source_place(make("k int", [(1,)])) is None


def test_the_pair_table_holds_only_what_it_reads(spark):
    import os

    from workload.queries import QUERIES

    root = session.checkpoint_folder(spark).removeprefix("file:")
    before = set(os.listdir(root))
    master = QUERIES["dyad_master"](spark, "/root/testdata/sf0.001")
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(root)) - before}
    assert "dyads" in left and not left & {"links", "profile", "pairs", "panel"}
    assert master.count() > 0
