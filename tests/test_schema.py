from __future__ import annotations

import pytest
from conftest import values

from polyad.operators import schema as S


def test_selectors(make):
    df = make("mid_a int, MID_b int, x_sd int, year int", [(1, 2, 3, 4)])
    assert S.resolve(df, S.starts_with("mid_")) == ["mid_a", "MID_b"]
    assert S.resolve(df, S.ends_with("_sd"), S.contains("ea"), S.any_of("nope", "year")) == ["x_sd", "year"]
    assert S.drop(df, S.starts_with("mid_"), "absent").columns == ["x_sd", "year"]
    assert S.keep(df, "year", S.everything()).columns == ["year", "mid_a", "MID_b", "x_sd"]
    with pytest.raises(ValueError, match="nope"):
        S.keep(df, "nope")


def test_aliases(make):
    assert S.rename_aliases(make("statea int", [(1,)]), {"COWcode_a": ["statea", "ccode_a"]}).columns == ["COWcode_a"]
    assert S.rename_aliases(make("z int", [(1,)]), {"COWcode_a": ["statea"]}).columns == ["z"]
    for clash in ("statea int, ccode_a int", "statea int, COWcode_a int"):
        with pytest.raises(ValueError, match="claimed by several"):
            S.rename_aliases(make(clash, [(1, 2)]), {"COWcode_a": ["statea", "ccode_a"]})


@pytest.mark.parametrize(
    ("name", "clean"),
    [
        ("COWcode", "co_wcode"),
        ("v2x_libdem", "v2x_libdem"),
        ("Country Name", "country_name"),
        ("nCustomers", "n_customers"),
        ("growth %", "growth_percent"),
        ("2nd", "x2nd"),
        ("Größe", "groe"),
    ],
)
def test_clean_name(name, clean):
    assert S.clean_name(name) == clean


def test_clean_names_are_unique(make):
    df = make("`A b` int, `a_b` int", [(1, 2)])
    assert S.clean_names(df).columns == ["a_b", "a_b_2"]
    assert S.clean_name_map(["A b", "a_b"]) == [("A b", "a_b"), ("a_b", "a_b_2")]


def test_ensure_and_fallback(make):
    df = S.ensure_columns(make("a int", [(1,)]), {"a": "int", "b": "double"})
    assert df.dtypes == [("a", "int"), ("b", "double")]
    assert df.select(S.column_or(df, "nope").alias("x")).dtypes == [("x", "double")]


def test_categories(make):
    df = make("x double, s string, k int", [(1.9, "a", 1), (None, None, 2), (float("nan"), "b", 2)])
    typed = S.as_category(df, ["x", "s", "absent"], fill_missing="-1")
    assert S.category_columns(typed) == ["x", "s"]
    assert values(typed, "x", "s") == [("-1", "-1"), ("-1", "-1"), ("1", "-1")]  # untagged text is parsed as a number
    tagged = S.as_category(S.as_category(df, ["s"]), ["x", "s"], fill_missing="-1")
    assert values(tagged, "x", "s") == [("-1", "-1"), ("-1", "b"), ("1", "a")]
    assert values(S.level_report(tagged, ["x", "s", "absent"])) == [("absent", False, 0), ("s", True, 3), ("x", True, 2)]


def test_contract(make):
    df = make("statea int, year int", [(1, 2000), (None, 2001)])
    report = S.contract_report(df, {"core": ["COWcode_a", "year", "z"]}, {"COWcode_a": ["statea"]})
    assert values(report) == [
        ("core", "COWcode_a", False, True, 1),
        ("core", "year", True, True, 2),
        ("core", "z", False, False, 0),
    ]
    with pytest.raises(ValueError, match="z"):
        S.require_columns(df, ["year", "z"])
