"""File sources and sinks: CSV with an explicit schema, first-n rows in
source order, and a named-table bundle written as parquet."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardgrain.session import checkpoint_dir

# Text spellings of non-finite numbers accepted in CSV input.
POS_INF = ("inf", "+inf", "infinity", "+infinity")
NEG_INF = ("-inf", "-infinity")
NAN = ("nan",)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/cardgrain-{name}-{uuid.uuid4().hex}"


def parse_double(c: str):
    """Text -> double, accepting every spelling of Inf/NaN; bad text -> null."""
    t = F.lower(F.trim(F.col(c)))
    return (F.when(t.isin(*POS_INF), F.lit(float("inf")))
            .when(t.isin(*NEG_INF), F.lit(float("-inf")))
            .when(t.isin(*NAN), F.lit(float("nan")))
            .otherwise(t.try_cast("double")))


def parse_whole(c: str, kind: str):
    """Text -> whole number; ``1.0`` counts as 1, a fraction or bad text -> null."""
    t = F.trim(F.col(c))
    wide = t.try_cast("double")
    whole = F.when(wide == F.floor(wide), wide.try_cast("bigint"))
    return F.coalesce(t.try_cast("bigint"), whole).try_cast(kind)


# Columns that tell a row's place in its source: order by them for "the order of the file".
SOURCE_ORDER = ["source_file", "source_block", "source_row"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType, ordinal: bool = False) -> DataFrame:
    """CSV with a header, ``NA`` or blank (quoted or not) -> missing, types from ``schema``.

    Columns are found by their name in the header, in any order; other columns
    of the file are left out, and a missing one is an error. Every column is
    read as text and parsed: ``Inf``, ``inf`` and ``Infinity`` are infinity,
    ``1.0`` is a whole number, text that does not parse is missing.

    With ``ordinal`` the columns ``SOURCE_ORDER`` give the row's place in the source:
    file, start of the split and a number that grows within it. Other runs may cut
    splits elsewhere and number differently; the order is the same.
    """
    raw = (spark.read.option("header", True).option("inferSchema", False)
           .option("nullValue", "NA").option("emptyValue", "").csv(path))
    absent = [f.name for f in schema.fields if f.name not in raw.columns]
    if absent:
        raise ValueError(f"no column {', '.join(absent)} in the header of {path}")
    place = []
    if ordinal:
        meta = raw.metadataColumn("_metadata")
        place = [meta["file_path"].alias("source_file"), meta["file_block_start"].alias("source_block"),
                 F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("source_row")]
    blank = raw.select(*place, *[F.when(F.trim(F.col(f.name)) != "", F.col(f.name)).alias(f.name)
                         for f in schema.fields])
    cols = [F.col(c) for c in SOURCE_ORDER] if ordinal else []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(parse_double(f.name).cast(kind).alias(f.name))
        elif isinstance(f.dataType, T.IntegralType):
            cols.append(parse_whole(f.name, kind).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(F.col(f.name))
        else:
            cols.append(F.trim(F.col(f.name)).try_cast(kind).alias(f.name))
    return blank.select(*cols)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("errorifexists").option("header", True).csv(path)
    return path


# Up to this many rows, "first n" is a plain sort-limit (each partition keeps
# its top n, one task merges them). Beyond it the rows are not sorted.
SMALL_LIMIT = 10_000


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in source order (given by the ``order`` columns, missing first).

    A bare ``limit`` over several files is not "first n". Rows are counted by
    the first order column; the running counts tell its value at which the n-th row
    lies. All rows before that value pass by a filter, which reaches the scan,
    and only those with that value are told apart by the next columns.
    """
    if n <= SMALL_LIMIT or not order:
        return df.orderBy(*order).limit(n) if order else df.limit(n)
    from cardgrain.operators.ranks import count_positions
    lead = order[0]
    blank = df.filter(F.col(lead).isNull()).count()
    if blank >= n:
        return first_n(df.filter(F.col(lead).isNull()), order[1:], n)
    counts = df.filter(F.col(lead).isNotNull()).groupBy(lead).agg(F.count(F.lit(1)).alias("_n"))
    last = count_positions(counts, [], lead).where(
        (F.col("_before") < n - blank) & (F.col("_before") + F.col("_n") >= n - blank)).first()
    if last is None:  # fewer rows than n
        return df
    before = F.col(lead) < F.lit(last[lead])
    if blank:
        before = before | F.col(lead).isNull()
    edge = df.filter(F.col(lead) == F.lit(last[lead]))
    rest = n - blank - last["_before"]
    return df.filter(before).unionByName(edge if rest == last["_n"] else first_n(edge, order[1:], rest))


def write_bundle(tables: Mapping[str, DataFrame], path: str) -> str:
    """Saves named tables under ``path`` as its next version, and returns ``path``.

    Every table goes into a folder of its own; the version is there once the
    last step has added its list of folders to ``manifests`` (one file, put in place by
    a rename). A write that ends before leaves the older version in use. Rows are
    written from the tasks that have them, without an exchange: scans and AQE
    size those by bytes.
    """
    spark = next(iter(tables.values())).sparkSession
    versions = _manifest(spark, path)
    version = (max(v for v, _, _ in versions) if versions else 0) + 1
    rows = []
    for name, df in tables.items():
        folder = f"{name}-{version:06d}-{uuid.uuid4().hex}"
        df.write.parquet(f"{path}/{folder}")
        rows.append((version, name, folder))
    (spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifests"))
    return path


_MANIFEST = "version long, name string, folder string"


def _manifest(spark: SparkSession, path: str) -> list:
    """(version, table, folder) of all versions: a row per table and save."""
    try:
        return [tuple(r) for r in spark.read.schema(_MANIFEST).parquet(f"{path}/manifests").collect()]
    except AnalysisException:
        return []


def read_bundle(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Tables of the last version that was saved whole."""
    rows = _manifest(spark, path)
    last = max((v for v, _, _ in rows), default=0)
    folders = {name: folder for v, name, folder in rows if v == last}
    absent = [n for n in names if n not in folders]
    if absent:
        raise ValueError(f"no table {', '.join(absent)} in the bundle {path}")
    return {n: spark.read.parquet(f"{path}/{folders[n]}") for n in names}
