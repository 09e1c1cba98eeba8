"""Plan checks: filters reach the scan, no single-partition exchange or
window sneaks into the transaction-sized parts of a plan."""

import contextlib
import io

from cardgrain.operators import summaries as summ
from cardgrain.plans.catalog import queries

REGISTRY = queries()
from cardgrain.sources import fixtures as fx


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_period_filter_is_pushed_to_the_lineitem_scan(spark, sf_small):
    plan = _plan(fx.histdata(spark, sf_small))
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in plan


def test_column_pruning_on_term_query(spark, sf_small):
    plan = _plan(REGISTRY["term_hist"](spark, sf_small))
    scan = [ln for ln in plan.splitlines() if "lineitem.parquet" in ln or "ReadSchema" in ln]
    text = " ".join(scan)
    assert "l_comment" not in text and "l_quantity" not in text


def test_flagship_has_no_single_partition_step(spark, sf_small):
    plan = _plan(REGISTRY["train_features"](spark, sf_small))
    assert "SinglePartition" not in plan


def test_cold_summary_avoids_expand(spark, sf_small):
    plan = _plan(summ.hist_summary(fx.histdata(spark, sf_small)))
    assert "Expand" not in plan
    hot = _plan(summ.hist_summary(fx.histdata(spark, sf_small), hot_rows=25))
    assert "Expand" in hot


def test_top5_prunes_before_the_shuffle(spark, sf_small):
    plan = _plan(REGISTRY["top5_ids_hist"](spark, sf_small))
    assert "WindowGroupLimit" in plan
