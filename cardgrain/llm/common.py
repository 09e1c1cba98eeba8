"""Shared pieces of the text operators: sessions, shared tables, words, folds."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardgrain.session import checkpoint_dir

# Words are runs of anything but ASCII white space; bytes.split() cuts at
# exactly these six bytes, and bytes.lower() touches A-Z only.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings for whole texts in Arrow batches (few rows, and few bytes unless one text has more) and
    for joins: a side is broadcast by its measured size only if it is small even
    unpacked; larger sides are joined by shuffles that AQE splits where skewed."""
    for key in ("spark.sql.autoBroadcastJoinThreshold",
                "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "2m")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "32m")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/cardgrain-llm/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs a read, not a recomputation, and
    both readers of the table see the same rows.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`materialize` that nothing reads any more."""
    path = getattr(df, "_shared_path", None)
    if path:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def fold(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % m


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def arrow_map(df: DataFrame, fn: Callable[[Iterator[dict[str, list]]], Iterable[dict]],
              schema: str, plain: bool = True) -> DataFrame:
    """``mapInArrow`` on plain column lists: ``fn`` gets and yields dicts of columns
    (``plain`` false: gets the record batches as they are)."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for out in fn((b.to_pydict() for b in batches) if plain else batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


BROADCAST_IDS = 1_000_000  # 8 MB of ids; more go through a shuffle join


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in ``gone`` (_gone long); rows
    without a doc_id stay. The ids are broadcast only up to a checked number.
    """
    gone = materialize(gone, "gone")
    small = gone.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if small else gone,
                     F.col("doc_id") == F.col("_gone"), "left_anti")
