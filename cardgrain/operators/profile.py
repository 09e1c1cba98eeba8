"""Table profile: row count and, per column, missing count, min and max."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardgrain.sources.files import SOURCE_ORDER

_NUM = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
        T.DecimalType)


def head(df: DataFrame, n: int = 6) -> DataFrame:
    """The first ``n`` rows in source order (where a reader has made it, else as they come)."""
    order = [c for c in SOURCE_ORDER if c in df.columns]
    return (df.orderBy(*order) if order else df).limit(n)


def profile(df: DataFrame) -> DataFrame:
    """One aggregate pass; long result ``(column_name, position, n_rows, n_null,
    min_value, max_value, min_text, max_text)``: bounds as numbers for numeric
    columns, as text for all that can be ordered (numbers, text, dates, times)."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for f in df.schema.fields:
        c = F.col(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"{f.name}__null"))
        ordered = not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
        for fn in (F.min, F.max):
            text = fn(c).cast("string") if ordered else F.lit(None).cast("string")
            aggs.append(text.alias(f"{f.name}__{fn.__name__}_text"))
        if isinstance(f.dataType, _NUM):
            aggs += [F.min(c).cast("double").alias(f"{f.name}__min"),
                     F.max(c).cast("double").alias(f"{f.name}__max")]
        else:
            aggs += [F.lit(None).cast("double").alias(f"{f.name}__min"),
                     F.lit(None).cast("double").alias(f"{f.name}__max")]
    one = df.agg(*aggs)
    entries = [F.struct(F.lit(f.name).alias("column_name"), F.lit(i + 1).alias("position"),
                        F.col(f"{f.name}__null").alias("n_null"),
                        F.col(f"{f.name}__min").alias("min_value"),
                        F.col(f"{f.name}__max").alias("max_value"),
                        F.col(f"{f.name}__min_text").alias("min_text"),
                        F.col(f"{f.name}__max_text").alias("max_text"))
               for i, f in enumerate(df.schema.fields)]
    return one.select(F.col("_rows").alias("n_rows"), F.explode(F.array(*entries)).alias("e")) \
        .select("e.column_name", "e.position", "n_rows", "e.n_null", "e.min_value", "e.max_value",
                "e.min_text", "e.max_text")
