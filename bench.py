"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and executes the full plan into Spark's ``noop``
sink (no collect to the driver). Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "hist_summary", "new_summary", "train_features", "test_features", "top5_ids_hist",
    "spearman_matrix", "lag_density", "target_summary", "split_stratified",
    "category_props_hist", "target_histogram",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE

    from cardgrain.plans.catalog import queries
    from cardgrain.session import build_session, checkpoint_dir

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    checkpoint_dir(spark)
    qs = queries()
    # Warm-up, not timed: every headline query once over the smallest tables,
    # so the timings below measure steady-state execution rather than JIT
    # compilation and class loading in a fresh JVM.
    from cardgrain.sources import fixtures as fx
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        fx.bundle(spark, warm_dir)
        for name in names:
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    # Load step: role views derived once and saved as a parquet bundle.
    t0 = time.perf_counter()
    fx.bundle(spark, sf_dir)
    times["bundle_load"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        df = qs[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf_text = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf: float | str = float(sf_text)
    except ValueError:
        sf = sf_text
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "warmup": os.path.basename(warm_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
