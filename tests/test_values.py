from __future__ import annotations

import math

from conftest import values
from pyspark.sql import functions as F

from polyad.functions import values as V


def one(make, schema, row, expr):
    return make(schema, [row]).select(expr.alias("x")).first().x


def test_ifelse_keeps_unknown(make):
    df = make("a double", [(0.2,), (0.8,), (None,)])
    found = df.select("a", V.ifelse(F.col("a") < 0.5, "low", "high").alias("x"))
    assert values(found) == [(None, None), (0.2, "low"), (0.8, "high")]


def test_flags_differ_on_unknown(make):
    assert one(make, "a int", (None,), V.flag(F.col("a") > 1)) is None
    assert one(make, "a int", (None,), V.known_flag(F.col("a") > 1)) == 0


def test_three_valued_and(make):
    both = V.flag((F.col("a") > 1) & (F.col("b") > 1))
    assert one(make, "a int, b int", (0, None), both) == 0
    assert one(make, "a int, b int", (2, None), both) is None


def test_recode_default_covers_null(make):
    df = make("label string", [("left",), ("odd",), (None,)])
    assert values(df.select("label", V.recode("label", {"left": 1}, default=0).alias("x"))) == [
        (None, 0),
        ("left", 1),
        ("odd", 0),
    ]


def test_sum_of_nothing(make):
    df = make("x double", [(None,), (None,)])
    found = df.agg(V.sum_of("x").alias("zero"), V.sum_of("x", "null").alias("null"), F.avg("x"), F.max("x")).first()
    assert tuple(found) == (0.0, None, None, None)


def test_any_event(make):
    df = make("g int, x int", [(1, None), (2, 0), (2, 4), (3, 1)])
    assert values(df.groupBy("g").agg(V.any_event(F.col("x") >= 4).alias("e"))) == [(1, 0), (2, 1), (3, 0)]


def test_sentinels_nan_and_parsing(make):
    assert one(make, "a int", (-9,), V.sentinel_to_null("a", -9)) is None
    assert one(make, "a int", (3,), V.sentinel_to_null("a", -9, -8)) == 3
    assert one(make, "a double", (math.nan,), V.nan_to_null("a")) is None
    assert one(make, "a double", (math.inf,), V.finite_or_null("a")) is None
    for text, number in (("2", 2.0), ("abc", None), ("nan", None), (None, None), ("2.7", 2.7)):
        assert one(make, "a string", (text,), V.to_number("a")) == number


def test_logs_are_guarded(make):
    df = make("a double", [(0.0,), (-1.0,), (None,)])
    assert {r.x for r in df.select(V.safe_ln("a").alias("x")).collect()} == {None}
    assert values(df.select("a", V.safe_ln1p("a").alias("x"))) == [(None, None), (-1.0, None), (0.0, 0.0)]


def test_clip_keeps_null(make):
    df = make("a double", [(-1.0,), (0.0,), (None,), (2.0,)])
    assert values(df.select(V.clip_lower("a").alias("x"))) == [(None,), (0.0,), (0.0,), (2.0,)]


def test_ids(make):
    assert one(make, "a int, b int", (1, None), V.paste_id("a", "b")) is None
    assert one(make, "a int, b int", (1, None), V.paste_id("a", "b", missing="NA")) == "1_NA"
    assert one(make, "a int, b int", (1, 2), V.paste_id("a", "b", sep="-")) == "1-2"


def test_percent_text(make):
    for number, text in ((0.0, "0%"), (100.0, "100%"), (12.5, "12.5%"), (0.125, "0.12%"), (33.33333, "33.33%")):
        assert one(make, "a double", (number,), V.percent_text(F.col("a"))) == text


def test_concentration_and_partner_sums(make):
    df = make("u int, p int, s double", [(1, 2, 50.0), (1, 3, 30.0), (1, 4, 20.0), (2, 2, None)])
    found = df.groupBy("u").agg(
        F.round(V.concentration("s"), 6).alias("hhi"), V.partner_sum("s", "p", [2, 4]).alias("bloc")
    )
    assert values(found) == [(1, 0.38, 70.0), (2, 0.0, 0.0)]
