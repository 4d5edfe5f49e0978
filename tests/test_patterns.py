from __future__ import annotations

import random

from conftest import values
from pyspark.sql import functions as F

from polyad.operators import crosswalk, patterns

TRICKY = [
    "(?i)korea",
    "(?i)NORTH.*korea",
    "^Peru$",
    "pe?ru",
    "per{2}u",
    "a+b",
    "ab|cd",
    "ab|",
    "(ab|cd)x",
    "((a)(b(c)))?z",
    "[a-c]d",
    "[^a]b",
    "[]a]b",
    "[a[bc]]d",
    r"a\.b",
    r"\Qa.b|c\E",
    r"\x61b",
    r"(?s)a.b",
    "(?x)a b",
    "(?:ab)?c",
    "(?i:AB)c",
    "(?!ab)cd",
    "(?<n>ab)c",
    ".*",
    "",
    "b??c",
    "b*+c",
    "a{0}b",
    r"\bab\b",
    r"\(ab\)",
    "É",
    "(?i)É",
    "(?iu)É",
    "𝒳+y",
    "İ",
]


def brute(names, table):
    met = names.select("name").where("name IS NOT NULL").distinct().crossJoin(table.dropna().distinct()).where(F.rlike("name", "pattern"))
    return values(met.groupBy("name").agg(F.count_distinct("unit").cast("int").alias("n")))


def test_any_pattern_as_tried_on_every_name(make):
    rng = random.Random(3)
    pieces = ["a", "b", "c", "d", "x", "z", ".", "|", "(ab)", "ab", "cd", "Peru", "peru", "North ", "Korea", "É", "é", "𝒳", "y", " ", "İ", "u", "]", "korea"]
    plain = "a ab abc aab bd ad ]b a.b aXb c cd abx z abcz (ab) Peru pru perru É é 𝒳𝒳y İ b a.b|c".split()
    names = ["", "north korea", "a b", *plain, *["".join(rng.choices(pieces, k=rng.randint(1, 6))) for _ in range(400)], None, None, "per" * 40 + "u"]
    frame = make("name string", [(n,) for n in names])
    table = make("pattern string, unit int", [(p, k) for k, p in enumerate(TRICKY)] + [("ab", 6), (None, 1), ("ab", None)])
    found = patterns.match_name_table(frame, "name", table)
    assert values(found.where("n_matches > 0"), "name", "n_matches") == brute(frame, table)
    assert found.count() == len({n for n in names if n is not None})


def test_required_texts(make):
    rows = make("p string", [("^New.*Guinea$",), ("(?i)ab|cD+e",), ("x(ab)?y",), ("[a-z]+",), (r"\Qab\E",)])
    found = {p: t for p, t in rows.select("p", patterns.required_texts(F.col("p"))).collect()}
    assert found == {"^New.*Guinea$": [["new", "guinea"]], "(?i)ab|cD+e": [["ab"], ["cd", "e"]], "x(ab)?y": [["x", "y"]], "[a-z]+": [[]], r"\Qab\E": [[]]}


def test_a_full_filter_and_a_single_counter_change_nothing(make, monkeypatch):
    monkeypatch.setattr(patterns, "FILTER_BITS", 64)
    monkeypatch.setattr(patterns, "COUNTERS", 1)
    frame = make("name string", [(a + b,) for a in ("ab", "Peru", "North Korea", "per" * 12) for b in ("", "d", "u", "korea")])
    table = make("pattern string, unit int", [(p, k) for k, p in enumerate([*TRICKY, "(per){3}" + "per" * 9])])
    found = patterns.match_name_table(frame, "name", table)
    assert values(found.where("n_matches > 0"), "name", "n_matches") == brute(frame, table)


def test_names_bring_only_what_patterns_want(spark):
    names = spark.range(3000).select(F.concat(F.lit("ord of Customer#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("name"))
    table = spark.range(1000, 2000).select(F.concat(F.lit("(?i)CUSTOMER#0*"), F.col("id").cast("string"), F.lit("$")).alias("pattern"), F.col("id").cast("int").alias("unit"))
    index = patterns._index(table, names)
    assert {(r.length, len(r.pattern)) for r in index.collect()} == {(4, 20)}  # the whole number, and no part of it
    held = patterns._held(names, index)
    wanted = held.join(index, "piece", "left_semi").count()
    assert 1000 <= wanted <= held.count() < 1.1 * wanted and wanted < 5000  # a name has about 100 pieces of up to 16 characters


def test_same_report_as_a_list_of_patterns(make):
    listed = [("(?i)korea", 732), ("(?i)north.*korea", 731), ("^Peru$", 135), ("(?i)^peru", 135)]
    names = make("name string, v int", [("South Korea", 1), ("North Korea", 2), ("Peru", 3), ("Guam", 4), ("Mars", 5), (None, 6)])
    table = make("pattern string, unit int", listed)
    overrides = {"Guam": None, "North Korea": 731}
    assert values(patterns.match_name_table(names, "name", table, overrides)) == values(crosswalk.match_names(names, "name", listed, overrides))
    assert values(patterns.map_name_table(names, "name", table, overrides), "v", "unit") == values(crosswalk.map_names(names, "name", listed, overrides), "v", "unit")


def test_empty_tables_and_dotted_names(make):
    names = make("`full.name` string", [("Peru",)])
    none = make("`re.gex` string, `u.nit` int", [])
    assert values(patterns.match_name_table(names, "full.name", none, pattern="re.gex", unit="u.nit")) == [("Peru", None, 0, "unmatched")]
    some = make("`re.gex` string, `u.nit` int", [("Peru", 1)])
    assert values(patterns.match_name_table(names.limit(0), "full.name", some, pattern="re.gex", unit="u.nit")) == []
    assert values(patterns.map_name_table(names, "full.name", some, pattern="re.gex", unit="u.nit")) == [("Peru", 1)]


def test_ten_thousand_patterns_without_a_nested_loop(spark, capsys):
    rows = spark.range(12_000)
    table = rows.where("id < 10000").select(F.concat(F.lit("(?i)STATE of .*-"), F.hex("id"), F.lit("$")).alias("pattern"), F.col("id").cast("int").alias("unit"))
    names = rows.select(F.concat(F.lit("State of Q-"), F.hex("id")).alias("name"))
    found = patterns.match_name_table(names, "name", table)
    found.explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert values(found.groupBy("status").count()) == [("matched", 10_000), ("unmatched", 2_000)]
