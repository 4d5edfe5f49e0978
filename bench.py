"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from polyad.session import local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "dispute_monadic",
    "bloc_membership",
    "order_membership",
    "trade_dependence",
    "alliance_weighted",
    "gdp_history",
    "resource_wealth",
    "indicator_panel",
    "monadic_master",
    "share_series_yearly",
    "dyad_spine",
    "monad_to_dyad",
    "all_pairs_dyads",
    "dyad_distance",
    "spell_tenure",
    "index_z",
    "dyad_master",
    "index_summary",
    "corr_matrix",
    "grouped_quantiles",
    "missing_profile",
    "keep_first",
    "sequence_window_steps",
    "normalize_groups",
    "impute_deterministic",
    "impute_sampled",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, memory=os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name}))


if __name__ == "__main__":
    main()
