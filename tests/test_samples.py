from __future__ import annotations

import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from polyad.learn import samples, sequences


def brute(times, longest=25, shortest=11):
    """Longest samples from each time on and up to each time."""
    pairs = {(t, max(u for u in times if t <= u < t + longest)) for t in times}
    pairs |= {(min(u for u in times if t - longest < u <= t), t) for t in times}
    return sorted((a, b - a + 1) for a, b in pairs if b - a + 1 >= shortest)


@pytest.fixture(scope="module")
def panel():
    rng = random.Random(11)
    units = {k: sorted(rng.sample(range(-40, 200), rng.randint(1, 120))) for k in range(25)}
    units[100], units[101], units[102] = list(range(60)), list(range(11)), list(range(10))
    units[103] = [0, 10, 24, 25, 49, 500, 501, 524]
    return units


@pytest.fixture(scope="module")
def frame(make, panel):
    rows = [(u, t, float(t % 17) + u) for u, times in panel.items() for t in times]
    return make("u int, t int, v double", [*rows, (None, 3, 1.0), (7, None, 1.0)])


@pytest.mark.parametrize("step", [25, 40, 4096])
def test_every_sample(frame, panel, step):
    found = samples.sequence_index(frame, "u", "t", step=step)
    expected = sorted((u, a, n) for u, times in panel.items() for a, n in brute(times))
    assert values(found, "u", "start", "length") == expected
    assert found.where("encoder_length NOT BETWEEN 10 AND 20 OR decoder_length NOT BETWEEN 1 AND 5 OR cut <> start + encoder_length").count() == 0
    assert found.where("length <> encoder_length + decoder_length OR decoder_length <> least(5, length - 10)").count() == 0


def test_without_gaps_every_length_occurs(frame):
    found = values(samples.sequence_index(frame.where("u = 100"), "u", "t"), "start", "length")
    assert [n for a, n in found if a == 0] == list(range(11, 26))
    assert [n for a, n in found if a > 35] == list(range(24, 10, -1))


@pytest.mark.parametrize("block", [25, 37, 128])
def test_values_of_samples(frame, panel, block):
    index = samples.sequence_index(frame, "u", "t")
    store = samples.sequence_store(frame, "u", "t", ["v"], block=block, step=64)
    rows = samples.materialise(index, store, "u", "t", block).collect()
    assert len(rows) == index.count()
    for r in rows:
        start = r.cut - r.encoder_length
        assert [s.t for s in r.encoder + r.decoder] == list(range(start, r.cut + r.decoder_length))
        for s in r.encoder + r.decoder:
            seen = max(t for t in panel[r.u] if t <= s.t)
            assert s.v == float(seen % 17) + r.u


def test_samples_go_on_as_other_samples_do(frame):
    index = samples.sequence_index(frame.where("u = 101"), "u", "t")
    store = samples.sequence_store(frame, "u", "t", ["v"])
    rows = sequences.sequence_steps(samples.materialise(index, store, "u", "t"), "u", "t")
    assert values(rows, "cut", "t", "role") == [(10, t, "encoder" if t < 10 else "decoder") for t in range(11)]


def test_a_block_is_stored_once_but_for_its_edge(spark):
    long = spark.range(20_000).select(F.lit(1).alias("u"), F.col("id").cast("int").alias("t"), F.rand(1).alias("v"))
    store = samples.sequence_store(long, "u", "t", ["v"])
    held = store.agg(F.sum(F.size("steps")).alias("n"), F.max(F.size("steps")).alias("most")).first()
    assert held.most == samples.BLOCK + 24 and held.n < 20_000 * 1.2


def test_empty_and_bad_sizes(frame):
    assert samples.sequence_index(frame.limit(0), "u", "t").count() == 0
    assert samples.sequence_store(frame.limit(0), "u", "t", ["v"]).count() == 0
    with pytest.raises(ValueError, match="whole sample"):
        samples.sequence_index(frame, "u", "t", step=24)
    with pytest.raises(ValueError, match="whole sample"):
        samples.sequence_store(frame, "u", "t", ["v"], block=24)
