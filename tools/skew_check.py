"""Hot-card path at a meaningful size: one card gets a third of the
historical rows, is forced onto the hot path, and the summary is compared
with the all-window result (relative tolerance for floating sums).

Usage: python tools/skew_check.py [sf_dir] [hot_rows]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import functions as F

    from cardgrain.operators import summaries as summ
    from cardgrain.session import build_session, checkpoint_dir
    from cardgrain.sources import fixtures as fx

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    hot_rows = int(sys.argv[2]) if len(sys.argv) > 2 else 100_000
    spark = build_session("local[8]", shuffle_partitions=16)
    checkpoint_dir(spark)
    h = fx.stored(spark, sf_dir, "histdata").withColumn(
        "card_id", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("card_id")))
    print("hot card rows", h.filter("card_id = 1").count(), "of", h.count())
    t = time.perf_counter()
    hot = {r["card_id"]: r.asDict() for r in summ.hist_summary(h, hot_rows=hot_rows).collect()}
    t_hot = time.perf_counter() - t
    t = time.perf_counter()
    cold = {r["card_id"]: r.asDict() for r in summ.hist_summary(h, hot_rows=10**12).collect()}
    t_cold = time.perf_counter() - t
    bad = 0
    for k, a in cold.items():
        b = hot[k]
        for c, v in a.items():
            w = b[c]
            same = (v == w) or (v is not None and w is not None
                                and math.isclose(v, w, rel_tol=1e-12, abs_tol=1e-9))
            if not same:
                bad += 1
                print("differs", k, c, v, w)
    print(f"cards {len(cold)} / {len(hot)}, differing cells {bad}, "
          f"hot path {t_hot:.1f}s, window path {t_cold:.1f}s")


if __name__ == "__main__":
    main()
