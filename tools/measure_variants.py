"""

Usage: python tools/measure_variants.py [sf_dir]
"""

from __future__ import annotations

import json
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
    spark = build_session("local[8]", shuffle_partitions=16)
    checkpoint_dir(spark)
    h = fx.stored(spark, sf_dir, "histdata")
    hf = summ.with_dummy_flag(h)

    def best(build) -> float:
        ts = []
        for _ in range(3):
            t = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t)
        return round(min(ts), 3)

    def blocks():
        return (summ.stats6(hf, summ.HIST_STAT_COLUMNS)
                .join(summ.distinct_counts(h), "card_id", "left")
                .join(summ.term_features(h), "card_id", "left")
                .join(summ.order_distance(h), "card_id", "left")
                .join(summ.pivot_counts(h, "category_1"), "card_id", "left")
                .join(summ.pivot_counts(h, "category_2"), "card_id", "left")
                .join(summ.pivot_counts(h, "category_3"), "card_id", "left"))

    dcols = summ.distinct_columns(h) + summ.HIST_STAT_COLUMNS
    out = {
        "hist_summary_fused": best(lambda: summ.hist_summary(h)),
        "hist_summary_join_of_blocks": best(blocks),
        "distinct9_collect_set": best(lambda: hf.groupBy("card_id").agg(
            *[F.size(F.collect_set(c)).alias(c) for c in dcols])),
        "distinct9_count_distinct": best(lambda: hf.groupBy("card_id").agg(
            *[F.count_distinct(c).alias(c) for c in dcols])),
        "hist_summary_all_hot_path": best(lambda: summ.hist_summary(h, hot_rows=0)),
    }
    print(json.dumps({"sf_dir": sf_dir, "best_of_3_sec": out}))


if __name__ == "__main__":
    main()
