"""Name-level helpers: pattern selection, join suffixes, aggregate grids."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contains(df: DataFrame, text: str) -> list[str]:
    """Columns whose name contains ``text`` (case-insensitive)."""
    t = text.lower()
    return [c for c in df.columns if t in c.lower()]


def starts_with(df: DataFrame, prefix: str) -> list[str]:
    """Columns whose name starts with ``prefix`` (case-insensitive)."""
    p = prefix.lower()
    return [c for c in df.columns if c.lower().startswith(p)]


def select_pattern(df: DataFrame, *, contains_any: Sequence[str] = (),
                   starts_any: Sequence[str] = (), keep: Sequence[str] = ()) -> list[str]:
    """Union of selector matches in selector order, without repeats."""
    out: list[str] = []
    for k in keep:
        if k not in out:
            out.append(k)
    for t in contains_any:
        out += [c for c in contains(df, t) if c not in out]
    for p in starts_any:
        out += [c for c in starts_with(df, p) if c not in out]
    return out


def suffix_collisions(left: DataFrame, right: DataFrame, keys: Sequence[str],
                      suffix: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rename non-key columns present on both sides with the given suffixes."""
    common = [c for c in left.columns if c in set(right.columns) and c not in keys]
    ls, rs = suffix
    if ls:
        left = left.withColumnsRenamed({c: c + ls for c in common})
    if rs:
        right = right.withColumnsRenamed({c: c + rs for c in common})
    return left, right


# The six summary statistics and the name each one gets as a suffix. These
# are fixed values: they must equal the reference's names.
STATS6 = ("sum", "mean", "min", "max", "sd", "n_distinct")


# SQL aggregate for each statistic (nulls skipped by all of them).
_STAT_SQL = {"sum": "sum({})", "mean": "avg({})", "min": "min({})", "max": "max({})",
             "sd": "stddev_samp({})", "n_distinct": "count(DISTINCT {})"}


def quoted(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def stat_expr(fn: str, c: str, exact_distinct: bool = True, name: str | None = None) -> Column:
    """One statistic of column ``c`` as a single SQL expression (one call to
    the JVM per aggregate, which keeps wide plans quick to build)."""
    if fn not in _STAT_SQL:
        raise ValueError(fn)
    sql = _STAT_SQL[fn].format(quoted(c))
    if fn == "n_distinct" and not exact_distinct:
        sql = f"approx_count_distinct({quoted(c)})"
    return F.expr(f"{sql} AS {quoted(name)}" if name else sql)


def stat_grid(columns: Sequence[str], fns: Sequence[str] = STATS6,
              exact_distinct: bool = True,
              rename: Callable[[str], str] | None = None) -> list[Column]:
    """Cross product ``fns x columns`` named ``<column>_<fn>``; nulls skipped."""
    rename = rename or (lambda n: n)
    return [stat_expr(fn, c, exact_distinct, rename(f"{c}_{fn}"))
            for fn in fns for c in columns]
