"""Row positions, ranks and exact quantiles without a one-partition window.

``Window.orderBy(...)`` without ``partitionBy`` (or a window partitioned by a
key that holds a third of the rows) sends a whole group through one task.
The helpers here range-partition on ``(group, order)`` instead, so a hot
group is cut into many partitions, and stitch the pieces back together from
small per-segment counts:

1. ``repartitionByRange`` on the group and order columns, sorted within each
   partition; ``monotonically_increasing_id`` then gives every row its
   partition id and its offset inside the partition;
2. the result is checkpointed into the shared checkpoint folder, so both
   consumers below see the same partitioning even after an executor loss;
3. a group-by on ``(partition, group)`` gives one row per segment (at most
   groups + partitions rows); a running sum over the segments of a group
   (at most ``partitions`` rows per group) gives each segment's offset;
4. the segment offsets are joined back on ``(partition, group)``.

The order columns must form a total order within each group for the
positions to be repeatable (ties between identical rows are harmless).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardgrain.session import reliable_checkpoint

_LOW33 = (1 << 33) - 1
WANTED_ROWS = 100_000


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def partition_positions(df: DataFrame, order: Sequence[str | Column],
                        partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``order``; add ``_pid`` and ``_loc``."""
    order_cols = _as_cols(order)
    n = _partitions(df, partitions)
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    ranged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    ranged = ranged.withColumns({
        "_pid": F.shiftright(F.col("_mid"), 33),
        "_loc": F.col("_mid").bitwiseAND(F.lit(_LOW33)),
    }).drop("_mid")
    return reliable_checkpoint(ranged)


def group_positions(df: DataFrame, group: Sequence[str], order: Sequence[str | Column],
                    name: str = "pos", partitions: int | None = None) -> DataFrame:
    """1-based position of each row within its group in ``order`` order."""
    group = list(group)
    keyed = partition_positions(df, [*group, *order], partitions)
    seg = keyed.groupBy("_pid", *group).agg(
        F.min("_loc").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    seg = seg.select(F.col("_pid").alias("_s_pid"),
                     *[F.col(g).alias(f"_s_{g}") for g in group], "_first", "_off")
    if not group:
        # One segment per partition: the offsets table is bounded by the
        # partition count, so broadcasting it is safe at any data size.
        seg = F.broadcast(seg)
    cond = keyed["_pid"] == seg["_s_pid"]
    for g in group:
        cond = cond & keyed[g].eqNullSafe(seg[f"_s_{g}"])
    out = keyed.join(seg, cond, "inner")
    out = out.withColumn(name, F.col("_loc") - F.col("_first") + F.col("_off") + 1)
    return out.drop("_pid", "_loc", "_first", "_off", "_s_pid", *[f"_s_{g}" for g in group])


def global_positions(df: DataFrame, order: Sequence[str | Column], name: str = "pos",
                     partitions: int | None = None) -> DataFrame:
    """1-based global position of each row in ``order`` order."""
    return group_positions(df, [], order, name, partitions)


def dense_rank_codes(df: DataFrame, col: str, name: str | None = None,
                     partitions: int | None = None) -> DataFrame:
    """Factor code: position of each value among the sorted distinct values.

    Missing values keep a missing code (as R does for NA in a factor).
    """
    name = name or f"{col}_code"
    values = df.select(col).filter(F.col(col).isNotNull()).distinct()
    codes = global_positions(values, [col], "_code", partitions)
    codes = codes.select(F.col(col).alias("_v"), F.col("_code").cast("bigint").alias(name))
    out = df.join(codes, df[col] == codes["_v"], "left")
    return out.drop("_v")


def value_positions(df: DataFrame, group: Sequence[str], col: str,
                    partitions: int | None = None) -> DataFrame:
    """(*group, col, _before, _n): each distinct value with its rows and the rows
    of smaller values in its group. Rows are counted by value first (partial
    sums), so a value that most rows share is one row before any range cut."""
    group = list(group)
    return count_positions(df.filter(F.col(col).isNotNull()).groupBy(*group, col).agg(
        F.count(F.lit(1)).alias("_n")), group, col, partitions)


def count_positions(counts: DataFrame, group: Sequence[str], col: str,
                    partitions: int | None = None) -> DataFrame:
    """:func:`value_positions` from values that are counted (``_n``) already."""
    group = list(group)
    keyed = partition_positions(counts, [*group, col], partitions)
    inner = Window.partitionBy("_pid", *group).orderBy("_loc").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    seg = keyed.groupBy("_pid", *group).agg(F.sum("_n").alias("_all")).withColumn(
        "_off", F.coalesce(F.sum("_all").over(outer), F.lit(0)))
    seg = seg.select(F.col("_pid").alias("_s_pid"), "_off", *[F.col(g).alias(f"_s_{g}") for g in group])
    keyed = keyed.withColumn("_in", F.coalesce(F.sum("_n").over(inner), F.lit(0)))
    cond = F.col("_pid") == F.col("_s_pid")
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_s_{g}"))
    return keyed.join(seg, cond).select(*group, col, (F.col("_off") + F.col("_in")).alias("_before"), "_n")


def value_ranks(df: DataFrame, col: str, partitions: int | None = None) -> DataFrame:
    """(col, _rank): average rank of each distinct value."""
    return value_positions(df, [], col, partitions).select(
        col, (F.col("_before") + (F.col("_n") + 1) / 2.0).alias("_rank"))


def average_ranks(df: DataFrame, col: str, name: str | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Rank of each row's value with ties sharing their average rank.

    Rows with a missing value are dropped (rank correlation needs complete rows).
    """
    name = name or f"{col}_rank"
    base = df.filter(F.col(col).isNotNull())
    return base.join(value_ranks(base, col, partitions).withColumnRenamed("_rank", name), col, "left")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    group: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles (R type 7 / ``quantile_cont``), per group.

    Returns ``(*group, prob, value)``. Only the two values around each wanted
    position leave the counted values; the wanted-positions table has
    groups x probs x 2 rows. It is broadcast where that is known to be at most
    ``WANTED_ROWS`` (counted if there is a group), so that no group's values meet
    in one task; more groups than that are joined by a shuffle on the group.
    """
    group = list(group)
    base = df.select(*group, col).filter(F.col(col).isNotNull())
    pos = value_positions(base, group, col, partitions)
    n = base.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    n = n.withColumnRenamed("_n", "_rows")
    h = n.withColumn("prob", F.explode(F.array(*[F.lit(float(q)) for q in probs])))
    h = h.withColumn("_h", (F.col("_rows") - 1) * F.col("prob") + 1)
    h = h.withColumns({"_lo": F.floor("_h"), "_hi": F.ceil("_h")})
    renamed = [F.col(g).alias(f"_w_{g}") for g in group]
    want = h.select(*renamed, "prob", "_h", "_lo", F.col("_lo").alias("_at")).unionByName(
        h.select(*renamed, "prob", "_h", "_lo", F.col("_hi").alias("_at")))
    if not group or len(probs) * 2 * n.count() <= WANTED_ROWS:
        want = F.broadcast(want)
    cond = (F.col("_at") > F.col("_before")) & (F.col("_at") <= F.col("_before") + F.col("_n"))
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_w_{g}"))
    hit = pos.select(*group, "_before", "_n", F.col(col).alias("_v")).join(want, cond, "inner").select(
        *[F.col(f"_w_{g}").alias(g) for g in group], "prob", "_h", "_lo", "_at", "_v")
    agg = hit.groupBy(*group, "prob", "_h", "_lo").agg(
        F.min_by("_v", "_at").alias("_vlo"), F.max_by("_v", "_at").alias("_vhi"))
    value = F.col("_vlo") + (F.col("_h") - F.col("_lo")) * (F.col("_vhi") - F.col("_vlo"))
    return agg.select(*group, "prob", value.alias("value"))
