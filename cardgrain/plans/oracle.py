"""DuckDB SQL for every query that has a SQL form (the correctness oracle).

Each statement starts with the role views it needs as ``WITH`` items and
then restates the query. Floating results are rounded to 4 places and
integer sums cast to BIGINT, exactly as the Spark report form does.
"""

from __future__ import annotations

# Role views over the driver's tables (same text as FIXTURES.md).
ROLE_SQL = {
    "tx": """
SELECT o.o_custkey AS card_id, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
 CASE WHEN l.l_suppkey % 25 = 7 THEN NULL ELSE l.l_suppkey END AS merchant_id,
 p.p_size AS merchant_category_id,
 CASE WHEN l.l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS authorized_flag,
 CASE WHEN l.l_quantity > 40 THEN 'Y' ELSE 'N' END AS category_1,
 CASE WHEN l.l_tax >= 0.075 THEN NULL ELSE CAST(substr(o.o_orderpriority,1,1) AS INT) END AS category_2,
 CASE WHEN l.l_returnflag = 'A' THEN 'A' WHEN l.l_returnflag = 'N' THEN 'B'
      WHEN l.l_discount >= 0.095 THEN NULL ELSE 'C' END AS category_3,
 CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_linenumber END AS installments,
 l.l_extendedprice AS purchase_amount, l.l_shipdate AS purchase_date,
 CAST((year(l.l_shipdate) - 2000) * 12 + month(l.l_shipdate) - 1 AS INTEGER) AS month_lag
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "histdata": "SELECT * FROM tx WHERE month_lag < 0",
    "newdata": "SELECT * FROM tx WHERE month_lag >= 0",
    "merchants": """
SELECT s_suppkey AS merchant_id, s_nationkey AS merchant_category_id,
 CASE WHEN s_nationkey % 2 = 0 THEN 'Y' ELSE 'N' END AS category_1,
 CAST(s_nationkey % 5 + 1 AS INTEGER) AS category_2,
 CASE WHEN s_suppkey % 20 = 3 THEN CAST('Infinity' AS DOUBLE) WHEN s_acctbal < 0 THEN NULL
      ELSE s_acctbal / 2000 END AS avg_purchases_lag3,
 s_acctbal / 3000 AS avg_purchases_lag6, s_acctbal / 4000 AS avg_purchases_lag12
FROM supplier WHERE s_suppkey % 10 <> 9""",
    "merchants_dup": "SELECT * FROM merchants UNION ALL SELECT * FROM merchants WHERE merchant_id = 1",
    "cards": """
SELECT f.first_active_month, c.c_custkey AS card_id, CAST(c.c_nationkey % 5 + 1 AS INTEGER) AS feature_1,
 CAST(c.c_nationkey % 3 + 1 AS INTEGER) AS feature_2, CAST(c.c_nationkey % 2 AS INTEGER) AS feature_3,
 CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE c.c_acctbal / 1000 END AS target
FROM customer c LEFT JOIN (SELECT o_custkey, substr(CAST(min(o_orderdate) AS VARCHAR), 1, 7) AS first_active_month
 FROM orders GROUP BY o_custkey) f ON c.c_custkey = f.o_custkey""",
    "train": "SELECT * FROM cards WHERE target IS NOT NULL",
    "test": "SELECT first_active_month, card_id, feature_1, feature_2, feature_3 FROM cards WHERE target IS NULL",
}

_DEPS = {
    "tx": [], "histdata": ["tx"], "newdata": ["tx"], "merchants": [],
    "merchants_dup": ["merchants"], "cards": [], "train": ["cards"], "test": ["cards"],
}


def with_roles(roles: list[str], body: str, extra: list[tuple[str, str]] = ()) -> str:
    """Prefix ``body`` with the role views it needs (dependencies first)."""
    order: list[str] = []

    def add(r):
        for d in _DEPS[r]:
            add(d)
        if r not in order:
            order.append(r)

    for r in roles:
        add(r)
    items = [f"{r} AS ({ROLE_SQL[r].strip()})" for r in order]
    items += [f"{n} AS ({q.strip()})" for n, q in extra]
    return "WITH " + ",\n".join(items) + "\n" + body.strip()


def r4(e: str) -> str:
    """Same arithmetic as the Spark report form (snap to 8 places, then 4)."""
    return f"(round(round({e}, 8) * 10000) / 10000)"


ORDINAL_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, purchase_amount"
FLAG_SQL = ("CASE WHEN authorized_flag = 'Y' THEN 1 WHEN authorized_flag IS NOT NULL "
            "THEN 0 END")

# Column kinds, to give each statistic the same type as in Spark.
INT_COLS = {"month_lag", "installments", "authorized_flag"}


def stat_sql(c: str, fn: str, src: str | None = None) -> str:
    src = src or c
    is_int = c in INT_COLS
    if fn == "sum":
        return f"CAST(sum({src}) AS BIGINT)" if is_int else r4(f"sum({src})")
    if fn == "mean":
        return r4(f"avg({src})")
    if fn in ("min", "max"):
        return f"{fn}({src})" if is_int else r4(f"{fn}({src})")
    if fn == "sd":
        return r4(f"stddev_samp({src})")
    if fn == "n_distinct":
        return f"count(DISTINCT {src})"
    raise ValueError(fn)


STATS6 = ("sum", "mean", "min", "max", "sd", "n_distinct")


def stats_block(cols: list[str], names=None) -> list[str]:
    names = names or (lambda n: n)
    return [f"{stat_sql(c, fn)} AS {names(f'{c}_{fn}')}" for fn in STATS6 for c in cols]


def order_distance_sql(src: str, name: str) -> str:
    return f"""
SELECT card_id, avg(abs(idx - pidx)) AS {name} FROM (
  SELECT card_id, idx, lag(idx) OVER (PARTITION BY card_id ORDER BY purchase_date ASC NULLS LAST, idx) AS pidx
  FROM (SELECT card_id, purchase_date,
        row_number() OVER (PARTITION BY card_id ORDER BY {ORDINAL_SQL}) AS idx FROM {src}) a) b
GROUP BY card_id"""


CAT_LEVELS = {"category_1": ["'N'", "'Y'"], "category_2": ["1", "2", "3", "4", "5"],
              "category_3": ["'A'", "'B'", "'C'"]}
HIST_PIVOT = {"category_1": ["hist_N", "hist_Y"],
              "category_2": ["hist_1", "hist_2", "hist_3", "hist_4", "hist_5"],
              "category_3": ["hist_A", "hist_B", "hist_C"]}
NEW_PIVOT = {"category_1": ["new_N", "new_Y"],
             "category_2": ["new1", "new2", "new3", "new4", "new5"],
             "category_3": ["new_A", "new_B", "new_C"]}


def pivot_sql(names: dict[str, list[str]]) -> list[str]:
    out = []
    for cat, levels in CAT_LEVELS.items():
        for v, n in zip(levels, names[cat]):
            out.append(f"NULLIF(count(*) FILTER (WHERE {cat} = {v}), 0) AS {n}")
    return out


HIST_STATS = ["purchase_amount", "month_lag", "installments", "authorized_flag"]
NEW_STATS = HIST_STATS + ["avg_purchases_lag3", "avg_purchases_lag6", "avg_purchases_lag12"]
HIST_DISTINCT = ["merchant_id", "merchant_category_id", "category_1", "category_2", "category_3"]
NEW_DISTINCT = ["merchant_id", "merchant_category_id_new", "merchant_category_id_m",
                "category_1_new", "category_2_new", "category_3", "category_1_m", "category_2_m"]
TERM_SQL = ("count(*) AS {p}no_trans, CAST(epoch(max(purchase_date)) - "
            "epoch(min(purchase_date)) AS BIGINT) AS {p}pur_term")

NEW_MERGE_SQL = """
SELECT n.card_id, n.l_orderkey, n.l_linenumber, n.l_partkey, n.l_suppkey, n.merchant_id,
 n.merchant_category_id AS merchant_category_id_new, n.authorized_flag,
 n.category_1 AS category_1_new, n.category_2 AS category_2_new, n.category_3,
 n.installments, n.purchase_amount, n.purchase_date, n.month_lag,
 m.merchant_category_id AS merchant_category_id_m, m.category_1 AS category_1_m,
 m.category_2 AS category_2_m, m.avg_purchases_lag3, m.avg_purchases_lag6, m.avg_purchases_lag12
FROM newdata n LEFT JOIN {m} m ON n.merchant_id = m.merchant_id"""


def hist_summary_items() -> list[tuple[str, str]]:
    fused = ", ".join(
        ["card_id"] + stats_block(HIST_STATS)
        + [f"count(DISTINCT {c}) AS {c}" for c in HIST_DISTINCT]
        + [TERM_SQL.format(p="")] + pivot_sql(HIST_PIVOT))
    return [
        ("hist_f", f"SELECT * REPLACE ({FLAG_SQL} AS authorized_flag) FROM histdata"),
        ("hist_fused", f"SELECT {fused} FROM hist_f GROUP BY card_id"),
        ("hist_od", order_distance_sql("histdata", "avg_term")),
        ("hist_summary", "SELECT f.*, o.avg_term FROM hist_fused f LEFT JOIN hist_od o USING (card_id)"),
    ]


def new_summary_items(merchants: str = "merchants") -> list[tuple[str, str]]:
    fused = ", ".join(
        ["card_id"] + stats_block(NEW_STATS)
        + [f"count(DISTINCT {c}) AS {c}" for c in NEW_DISTINCT]
        + [TERM_SQL.format(p="new_")])
    piv = ", ".join(["card_id"] + pivot_sql(NEW_PIVOT))
    return [
        ("new_merge", NEW_MERGE_SQL.format(m=merchants)),
        ("new_f", f"SELECT * REPLACE ({FLAG_SQL} AS authorized_flag) FROM new_merge"),
        ("new_fused", f"SELECT {fused} FROM new_f GROUP BY card_id"),
        ("new_piv", f"SELECT {piv} FROM newdata GROUP BY card_id"),
        ("new_od", order_distance_sql("new_merge", "new_avg_term")),
        ("new_summary", "SELECT f.*, o.new_avg_term, p.* EXCLUDE (card_id) FROM new_fused f "
                        "LEFT JOIN new_od o USING (card_id) LEFT JOIN new_piv p USING (card_id)"),
    ]


def hist_summary_sql() -> str:
    return with_roles(["histdata"], "SELECT * FROM hist_summary", hist_summary_items())


def new_summary_sql(merchants: str = "merchants") -> str:
    return with_roles(["newdata", merchants], "SELECT * FROM new_summary",
                      new_summary_items(merchants))


def _feature_columns() -> list[tuple[str, str]]:
    """(output name, SQL type kind) of the joined feature table after the key."""
    cols: list[tuple[str, str]] = []

    def stat_kind(c, fn):
        if fn == "n_distinct":
            return "bigint"
        if c in INT_COLS:
            return "bigint" if fn == "sum" else ("double" if fn in ("mean", "sd") else "int")
        return "double"

    for fn in STATS6:
        for c in HIST_STATS:
            cols.append((f"{c}_{fn}", stat_kind(c, fn)))
    cols += [(c, "bigint") for c in HIST_DISTINCT]
    cols += [("no_trans", "bigint"), ("pur_term", "bigint"), ("avg_term", "double")]
    cols += [(n, "bigint") for cat in HIST_PIVOT for n in HIST_PIVOT[cat]]
    left_names = {c for c, _ in cols} | {"year", "month", "howlong", "feature_1", "feature_2",
                                           "feature_3", "target", "card_id", "first_active_month"}
    for fn in STATS6:
        for c in NEW_STATS:
            n = f"{c}_{fn}"
            cols.append((n + "_new" if n in left_names else n, stat_kind(c, fn)))
    cols += [(c + "_new" if c in left_names else c, "bigint") for c in NEW_DISTINCT]
    cols += [("new_no_trans", "bigint"), ("new_pur_term", "bigint"), ("new_avg_term", "double")]
    cols += [(n, "bigint") for cat in NEW_PIVOT for n in NEW_PIVOT[cat]]
    return cols


def _new_select_list() -> str:
    """Rename colliding new-summary columns with the ``_new`` suffix."""
    left = {c for c, _ in _feature_columns()[:42]} | {
        "year", "month", "howlong", "feature_1", "feature_2", "feature_3", "target", "card_id"}
    out = []
    for fn in STATS6:
        for c in NEW_STATS:
            n = f"{c}_{fn}"
            out.append(f"n.{n} AS {n}_new" if n in left else f"n.{n}")
    for c in NEW_DISTINCT:
        out.append(f"n.{c} AS {c}_new" if c in left else f"n.{c}")
    out += ["n.new_no_trans", "n.new_pur_term", "n.new_avg_term"]
    out += [f"n.{x}" for cat in NEW_PIVOT for x in NEW_PIVOT[cat]]
    return ", ".join(out)


def _fill(name: str, kind: str) -> str:
    if kind == "double":
        return r4(f"CASE WHEN {name} IS NULL OR isnan({name}) THEN 0 ELSE {name} END") + f" AS {name}"
    return f"coalesce({name}, 0) AS {name}"


def card_features_sql(cards_role: str, ref_date: str, with_target: bool) -> str:
    cal = (f"SELECT * REPLACE (CAST(try_strptime(first_active_month, '%Y-%m') AS DATE) "
           f"AS first_active_month) FROM {cards_role}")
    cal2 = ("SELECT *, CAST(year(first_active_month) AS INTEGER) AS year, "
            "CAST(month(first_active_month) AS INTEGER) AS month, "
            f"CAST(date_diff('day', first_active_month, DATE '{ref_date}') AS INTEGER) AS howlong "
            "FROM cal1")
    joined = (f"SELECT c.*, h.* EXCLUDE (card_id), {_new_select_list()} FROM cal2 c "
              "LEFT JOIN hist_summary h USING (card_id) LEFT JOIN new_summary n USING (card_id)")
    head = [("card_id", "bigint"), ("feature_1", "int"), ("feature_2", "int"),
            ("feature_3", "int")]
    if with_target:
        head.append(("target", "double"))
    head += [("year", "int"), ("month", "int"), ("howlong", "int")]
    sel = ", ".join(_fill(n, k) for n, k in head + _feature_columns())
    items = hist_summary_items() + new_summary_items() + [
        ("cal1", cal), ("cal2", cal2), ("joined", joined)]
    return with_roles(["histdata", "newdata", "merchants", cards_role],
                      f"SELECT {sel} FROM joined", items)


# ---------------------------------------------------------------------------
# Statements per query key
# ---------------------------------------------------------------------------

SQL: dict[str, str] = {}


def _hist_summary_rounded() -> list[tuple[str, str]]:
    items = hist_summary_items()
    items[-1] = ("hist_summary", "SELECT f.*, " + r4("o.avg_term") + " AS avg_term FROM hist_fused f "
                                 "LEFT JOIN hist_od o USING (card_id)")
    return items


def _new_summary_rounded(merchants: str) -> list[tuple[str, str]]:
    items = new_summary_items(merchants)
    items[-1] = ("new_summary", "SELECT f.*, " + r4("o.new_avg_term") + " AS new_avg_term, "
                                "p.* EXCLUDE (card_id) FROM new_fused f LEFT JOIN new_od o "
                                "USING (card_id) LEFT JOIN new_piv p USING (card_id)")
    return items


def _merge_items(m: str = "merchants") -> list[tuple[str, str]]:
    return [("new_merge", NEW_MERGE_SQL.format(m=m))]


def _register_core() -> None:
    term = TERM_SQL.format(p="")
    SQL["term_hist"] = with_roles(["histdata"], f"SELECT card_id, {term} FROM histdata GROUP BY card_id")
    SQL["term_new"] = with_roles(
        ["newdata", "merchants"],
        f"SELECT card_id, {TERM_SQL.format(p='new_')} FROM new_merge GROUP BY card_id",
        _merge_items())
    SQL["term_order_hist"] = with_roles(
        ["histdata"], f"SELECT card_id, {r4('avg_term')} AS avg_term FROM od",
        [("od", order_distance_sql("histdata", "avg_term"))])
    SQL["term_order_new"] = with_roles(
        ["newdata", "merchants"], f"SELECT card_id, {r4('new_avg_term')} AS new_avg_term FROM od",
        _merge_items() + [("od", order_distance_sql("new_merge", "new_avg_term"))])
    gap = r4("CASE WHEN count(purchase_date) > 1 THEN (epoch(max(purchase_date)) - "
             "epoch(min(purchase_date))) / (count(purchase_date) - 1) END") + " AS {p}avg_gap"
    SQL["term_gap_hist"] = with_roles(
        ["histdata"], f"SELECT card_id, {gap.format(p='')} FROM histdata GROUP BY card_id")
    SQL["term_gap_new"] = with_roles(
        ["newdata", "merchants"],
        f"SELECT card_id, {gap.format(p='new_')} FROM new_merge GROUP BY card_id", _merge_items())
    for side in ("hist", "new"):
        src = f"{side}data"
        SQL[f"cat_counts_{side}"] = with_roles([src], f"""
SELECT card_id, feature, value, count(*) AS n FROM (
 SELECT card_id, 'category_1' AS feature, category_1 AS value FROM {src}
 UNION ALL SELECT card_id, 'category_2', CAST(category_2 AS VARCHAR) FROM {src}
 UNION ALL SELECT card_id, 'category_3', category_3 FROM {src}) u
GROUP BY card_id, feature, value""")
        names = HIST_PIVOT if side == "hist" else NEW_PIVOT
        for i, cat in enumerate(CAT_LEVELS, start=1):
            cols = ", ".join(f"NULLIF(count(*) FILTER (WHERE {cat} = {v}), 0) AS {n}"
                             for v, n in zip(CAT_LEVELS[cat], names[cat]))
            SQL[f"pivot_cat{i}_{side}"] = with_roles(
                [src], f"SELECT card_id, {cols} FROM {src} GROUP BY card_id")
    SQL["distinct_hist"] = with_roles(["histdata"], "SELECT card_id, " + ", ".join(
        f"count(DISTINCT {c}) AS {c}" for c in HIST_DISTINCT) + " FROM histdata GROUP BY card_id")
    SQL["distinct_new"] = with_roles(["newdata", "merchants"], "SELECT card_id, " + ", ".join(
        f"count(DISTINCT {c}) AS {c}" for c in NEW_DISTINCT) + " FROM new_merge GROUP BY card_id",
        _merge_items())
    SQL["stats6_hist"] = with_roles(
        ["histdata"], "SELECT card_id, " + ", ".join(stats_block(HIST_STATS))
        + " FROM hist_f GROUP BY card_id",
        [("hist_f", f"SELECT * REPLACE ({FLAG_SQL} AS authorized_flag) FROM histdata")])
    SQL["stats6_new"] = with_roles(
        ["newdata", "merchants"], "SELECT card_id, " + ", ".join(stats_block(NEW_STATS))
        + " FROM new_f GROUP BY card_id",
        _merge_items() + [("new_f", f"SELECT * REPLACE ({FLAG_SQL} AS authorized_flag) FROM new_merge")])
    rounded = ("SELECT * REPLACE (" + ", ".join(
        f"{r4(c)} AS {c}" for c in ("purchase_amount", "avg_purchases_lag3",
                                     "avg_purchases_lag6", "avg_purchases_lag12"))
        + ") FROM new_merge")
    SQL["merge_merchants"] = with_roles(["newdata", "merchants"], rounded, _merge_items())
    SQL["merge_merchants_dup"] = with_roles(["newdata", "merchants_dup"], rounded,
                                            _merge_items("merchants_dup"))
    SQL["hist_summary"] = with_roles(["histdata"], "SELECT * FROM hist_summary",
                                     _hist_summary_rounded())
    SQL["new_summary"] = with_roles(["newdata", "merchants"], "SELECT * FROM new_summary",
                                    _new_summary_rounded("merchants"))
    SQL["new_summary_dup"] = with_roles(["newdata", "merchants_dup"], "SELECT * FROM new_summary",
                                        _new_summary_rounded("merchants_dup"))
    SQL["train_features"] = card_features_sql("train", "2002-01-01", True)
    SQL["test_features"] = card_features_sql("test", "2002-01-01", False)


_register_core()


def oracle_sql() -> dict[str, str]:
    from cardgrain.plans import explore_oracle  # noqa: F401  (registers the rest)
    return dict(SQL)
