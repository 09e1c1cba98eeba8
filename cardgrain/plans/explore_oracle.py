"""Oracle SQL for exploration, scalar, reshape, source/sink and split queries
(registered into ``oracle.SQL`` on import)."""

from __future__ import annotations

from cardgrain.plans.oracle import SQL, ORDINAL_SQL, r4, with_roles

REF = "2002-01-01"
LAGS = ("avg_purchases_lag3", "avg_purchases_lag6", "avg_purchases_lag12")
TX_DOUBLES = ("purchase_amount",)

CARDS_LABELLED = ("SELECT *, CASE WHEN target IS NULL THEN 'Test' ELSE 'Train' END AS set "
                  "FROM (SELECT * FROM train UNION ALL BY NAME SELECT * FROM test) u")
MONTH_DATE = "CAST(try_strptime(first_active_month, '%Y-%m') AS DATE)"


def _round_cols(cols, src):
    return "SELECT * REPLACE (" + ", ".join(f"{r4(c)} AS {c}" for c in cols) + f") FROM {src}"


def _reg() -> None:
    # --- sources and sinks
    SQL["src_csv"] = with_roles(["merchants"], _round_cols(LAGS, "merchants"))
    SQL["src_first_n"] = with_roles(
        ["histdata"], _round_cols(TX_DOUBLES, f"(SELECT * FROM histdata ORDER BY {ORDINAL_SQL} "
                                              "LIMIT 200000) f"))
    SQL["src_first_n_cut"] = with_roles(
        ["histdata"], _round_cols(TX_DOUBLES, f"(SELECT * FROM histdata ORDER BY {ORDINAL_SQL} "
                                              "LIMIT 20000) f"))
    counts = []
    for name, ncol in (("train", 6), ("test", 5), ("histdata", 15), ("newdata", 15),
                       ("merchants", 7)):
        counts.append(f"SELECT '{name}' AS table_name, count(*) AS n_rows, {ncol} AS n_columns "
                      f"FROM {name}")
    SQL["sink_roundtrip"] = with_roles(["train", "test", "histdata", "newdata", "merchants"],
                                       " UNION ALL ".join(counts))
    cols = [("card_id", True), ("l_orderkey", True), ("l_linenumber", True), ("l_partkey", True),
            ("l_suppkey", True), ("merchant_id", True), ("merchant_category_id", True),
            ("authorized_flag", False), ("category_1", False), ("category_2", True),
            ("category_3", False), ("installments", True), ("purchase_amount", True),
            ("purchase_date", False), ("month_lag", True)]
    parts = []
    for i, (c, num) in enumerate(cols, start=1):
        mn = f"CAST(min({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"
        mx = f"CAST(max({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS column_name, {i} AS position, count(*) AS n_rows, "
                     f"count(*) FILTER (WHERE {c} IS NULL) AS n_null, {r4(mn)} AS min_value, "
                     f"{r4(mx)} AS max_value FROM histdata")
    SQL["profile_table"] = with_roles(["histdata"], " UNION ALL ".join(parts))

    SQL["profile_bounds"] = with_roles(["histdata"], " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, CAST(min({c}) AS VARCHAR) AS min_text, "
        f"CAST(max({c}) AS VARCHAR) AS max_text FROM histdata"
        for c in ("authorized_flag", "category_1", "category_3", "purchase_date")))
    # --- projection and scalars
    SQL["select_pattern"] = with_roles(
        ["histdata"], f"SELECT card_id, merchant_id, merchant_category_id, {r4('purchase_amount')} "
                      "AS purchase_amount FROM histdata")
    SQL["card_calendar"] = with_roles(["cards"], f"""
SELECT card_id, d AS first_active_month, CAST(year(d) AS INTEGER) AS year,
 CAST(month(d) AS INTEGER) AS month, CAST(date_diff('day', d, DATE '{REF}') AS INTEGER) AS howlong
FROM (SELECT card_id, {MONTH_DATE} AS d FROM cards) c""")
    SQL["set_label"] = with_roles(["train", "test"], _round_cols(("target",), f"({CARDS_LABELLED}) l"))
    SQL["flag_dummy"] = with_roles(["histdata"], """
SELECT card_id, l_orderkey, l_linenumber, l_partkey, l_suppkey,
 CASE WHEN authorized_flag = 'Y' THEN 1 WHEN authorized_flag IS NOT NULL THEN 0 END AS authorized_flag
FROM histdata""")
    inf_null = ", ".join(f"{r4(f'CASE WHEN abs({c}) = CAST(' + chr(39) + 'Infinity' + chr(39) + f' AS DOUBLE) THEN NULL ELSE {c} END')} AS {c}"
                         for c in LAGS)
    SQL["lag_clean"] = with_roles(["merchants"], f"SELECT * REPLACE ({inf_null}) FROM merchants")
    fill = ", ".join(f"{r4(f'CASE WHEN {c} IS NULL OR isnan({c}) THEN 0 ELSE {c} END')} AS {c}"
                     for c in LAGS)
    SQL["fill_zero"] = with_roles(["merchants"], f"SELECT * REPLACE ({fill}) FROM merchants")
    SQL["drop_missing"] = with_roles(
        ["histdata"], _round_cols(TX_DOUBLES, "(SELECT * FROM histdata WHERE " + " AND ".join(
            f"{c} IS NOT NULL" for c, _ in cols) + ") f"))
    SQL["factor_code"] = with_roles(["histdata"], """
SELECT card_id, count(*) AS no_trans, max(code) - min(code) AS pur_term
FROM (SELECT card_id, dense_rank() OVER (ORDER BY purchase_date) AS code FROM histdata) c
GROUP BY card_id""")

    # --- reshape
    feat_long = ("SELECT set, 'feature_1' AS feature, CAST(feature_1 AS VARCHAR) AS value FROM lab "
                 "UNION ALL SELECT set, 'feature_2', CAST(feature_2 AS VARCHAR) FROM lab "
                 "UNION ALL SELECT set, 'feature_3', CAST(feature_3 AS VARCHAR) FROM lab")
    SQL["unpivot_features"] = with_roles(["train", "test"], feat_long, [("lab", CARDS_LABELLED)])
    cat_long = ("SELECT 'authorized_flag' AS feature, authorized_flag AS value FROM {s} "
                "UNION ALL SELECT 'category_1', category_1 FROM {s} "
                "UNION ALL SELECT 'category_2', CAST(category_2 AS VARCHAR) FROM {s} "
                "UNION ALL SELECT 'category_3', category_3 FROM {s}")
    SQL["unpivot_categories"] = with_roles(["histdata"], cat_long.format(s="histdata"))
    lag_long = " UNION ALL ".join(
        f"SELECT merchant_id, '{c}' AS feature, CASE WHEN abs({c}) = CAST('Infinity' AS DOUBLE) "
        f"THEN NULL ELSE {c} END AS value FROM merchants" for c in LAGS)
    SQL["unpivot_lags"] = with_roles(["merchants"], _round_cols(("value",), f"({lag_long}) l"))
    one_hot = ("SELECT card_id, " + ", ".join(
        [f"CASE WHEN feature_1 = {v} THEN 1 ELSE 0 END AS feature_1{v}" for v in range(1, 6)]
        + [f"CASE WHEN feature_2 = {v} THEN 1 ELSE 0 END AS feature_2{v}" for v in (2, 3)])
        + ", feature_3, target FROM train")
    SQL["one_hot_cards"] = with_roles(["train"], _round_cols(("target",), f"({one_hot}) o"))

    # --- aggregates and windows
    SQL["cards_by_month_set"] = with_roles(
        ["train", "test"], f"SELECT {MONTH_DATE} AS first_active_month, set, count(*) AS n "
                           "FROM lab GROUP BY ALL", [("lab", CARDS_LABELLED)])
    prop = ("SELECT *, {r} AS prop FROM (SELECT {p}, value, count(*) AS n FROM ({src}) x "
            "GROUP BY {p}, value) c")
    SQL["feature_props"] = with_roles(
        ["train", "test"], prop.format(r=r4("n / sum(n) OVER (PARTITION BY set, feature)"),
                                       p="set, feature", src=feat_long), [("lab", CARDS_LABELLED)])
    for side in ("hist", "new"):
        SQL[f"category_props_{side}"] = with_roles(
            [f"{side}data"], prop.format(r=r4("n / sum(n) OVER (PARTITION BY feature)"),
                                         p="feature", src=cat_long.format(s=f"{side}data")))
        ids_long = " UNION ALL ".join(
            f"SELECT '{c}' AS id, CAST({c} AS VARCHAR) AS value, purchase_amount FROM {side}data"
            for c in ("card_id", "merchant_id", "merchant_category_id"))
        SQL[f"top5_ids_{side}"] = with_roles([f"{side}data"], f"""
SELECT id, value, {r4('purchase_amount')} AS purchase_amount, CAST(rank AS INTEGER) AS rank FROM (
 SELECT *, row_number() OVER (PARTITION BY id ORDER BY purchase_amount DESC NULLS LAST,
   value ASC NULLS LAST) AS rank
 FROM (SELECT id, value, CASE WHEN count(purchase_amount) = count(*) THEN avg(purchase_amount) END
       AS purchase_amount FROM ({ids_long}) l GROUP BY id, value) m) r
WHERE rank <= 5""")
    monthly = (f"SELECT {MONTH_DATE} AS first_active_month, "
               "CASE WHEN count(target) = count(*) THEN sum(target) END AS target_sum, "
               "CASE WHEN count(target) = count(*) THEN avg(target) END AS target_mean "
               "FROM train GROUP BY 1")
    SQL["target_by_month"] = with_roles(
        ["train"], _round_cols(("target_sum", "target_mean"), f"({monthly}) m"))
    SQL["target_trend"] = with_roles(["train"], f"""
SELECT first_active_month, feature, {r4('value')} AS value,
 {r4('avg(value) OVER (PARTITION BY feature ORDER BY first_active_month ASC NULLS LAST ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)')} AS trend
FROM (SELECT first_active_month, 'target_sum' AS feature, target_sum AS value FROM m
      UNION ALL SELECT first_active_month, 'target_mean', target_mean FROM m) l""",
        [("m", monthly)])
    w, square, line = "w * u", "(s0 * c0 - s1 * c1 + s2 * c2)", "(s0 * s2 - s1 * s1)"
    SQL["target_smooth"] = with_roles(["train"], f"""
SELECT feature, point, {r4('x_days')} AS x_days, {r4('fit')} AS fit,
 CAST(DATE '1970-01-01' + CAST(floor(x_days) AS INTEGER) AS DATE) AS first_active_month
FROM (SELECT feature, point, x_days,
       CASE WHEN n < 3 THEN mean
            WHEN {square} > 1e-9 * s0 * s2 * s4 THEN (t0 * c0 - t1 * c1 + t2 * c2) / {square}
            WHEN {line} > 1e-9 * s0 * s2 THEN (t0 * s2 - t1 * s1) / {line}
            WHEN s0 > 0 THEN t0 / s0 ELSE edge END AS fit
      FROM (SELECT *, s2 * s4 - s3 * s3 AS c0, s1 * s4 - s2 * s3 AS c1, s1 * s3 - s2 * s2 AS c2
            FROM (SELECT feature, point, x_days, n, avg(y) AS mean,
                   avg(CASE WHEN dist <= h THEN y END) AS edge, sum(w) AS s0, sum({w}) AS s1,
                   sum({w} * u) AS s2, sum({w} * u * u) AS s3, sum({w} * u * u * u) AS s4,
                   sum(w * y) AS t0, sum({w} * y) AS t1, sum({w} * u * y) AS t2
                  FROM (SELECT *, (d - x_days) / h AS u, pow(1 - pow(least(dist / h, 1.0), 3), 3) AS w
                        FROM (SELECT * REPLACE (CASE WHEN h > 0 THEN h ELSE 1.0 END AS h)
                              FROM (SELECT *, max(CASE WHEN i = least(n, greatest(3, floor(n * 0.75)))
                                                  THEN dist END) OVER (PARTITION BY feature, point) AS h
                                    FROM near) a) b) c
                  GROUP BY feature, point, x_days, n) s) k) f""",
        [("m", monthly), ("long", """
SELECT feature, CAST(first_active_month - DATE '1970-01-01' AS DOUBLE) AS d, value AS y
FROM (SELECT first_active_month, 'target_sum' AS feature, target_sum AS value FROM m
      UNION ALL SELECT first_active_month, 'target_mean', target_mean FROM m) l
WHERE first_active_month IS NOT NULL AND value IS NOT NULL"""),
         ("near", """
SELECT *, row_number() OVER (PARTITION BY feature, point ORDER BY dist) AS i
FROM (SELECT *, abs(d - x_days) AS dist
      FROM (SELECT long.*, n, CAST(p.range AS INTEGER) AS point,
                   lo + (hi - lo) * p.range / 79.0 AS x_days
            FROM long JOIN (SELECT feature, min(d) AS lo, max(d) AS hi, count(*) AS n
                            FROM long GROUP BY feature) r USING (feature),
                 range(0, 80) p) g) e""")])
    SQL["target_summary"] = with_roles(["train"], f"""
SELECT {r4('min(target)')} AS min, {r4('quantile_cont(target, 0.25)')} AS q1,
 {r4('quantile_cont(target, 0.5)')} AS median, {r4('avg(target)')} AS mean,
 {r4('quantile_cont(target, 0.75)')} AS q3, {r4('max(target)')} AS max FROM train""")
    binned = """
SELECT b.bin, {xmin} AS xmin, {xmax} AS xmax, {xmid} AS x, coalesce(c.cnt, 0) AS count,
 {dens} AS density
FROM p, (SELECT CAST(range AS INTEGER) AS bin FROM p, range(1, p.nbins + 1)) b
LEFT JOIN (SELECT LEAST(GREATEST(1, CAST(ceil((target - p.fz - p.origin) / p.w) AS BIGINT)),
                        p.nbins) AS bin, count(*) AS cnt
           FROM train, p WHERE target IS NOT NULL GROUP BY 1) c ON b.bin = c.bin"""
    fmt = dict(xmin=r4("p.origin + (b.bin - 1) * p.w"), xmax=r4("p.origin + b.bin * p.w"),
               xmid=r4("((p.origin + (b.bin - 1) * p.w) + (p.origin + b.bin * p.w)) / 2"),
               dens=r4("coalesce(c.cnt, 0) / (CAST(p.n AS DOUBLE) * p.w)"))
    ggbins = """
SELECT w, origin, n, fz, GREATEST(1, CAST(floor((hi + (1 - 1e-08) * w - origin) / w + 1e-10) AS INTEGER)) AS nbins
FROM (SELECT w, n, hi, w / 2 + floor((lo - w / 2) / w) * w AS origin, 1e-08 * w AS fz
      FROM (SELECT min(target) AS lo, max(target) AS hi, count(target) AS n,
                   (max(target) - min(target)) / 99 AS w FROM train) r) s"""
    SQL["target_histogram"] = with_roles(["train"], binned.format(**fmt), [("p", ggbins)])
    pretty = """
SELECT unit AS w, ns * unit AS origin, n, 1e-7 * unit AS fz,
       GREATEST(1, CAST(round((nu - ns)) AS INTEGER)) AS nbins
FROM (SELECT unit, n,
        floor(lo / unit + 1e-10) - CASE WHEN floor(lo / unit + 1e-10) * unit > lo + 1e-10 * unit THEN 1 ELSE 0 END AS ns,
        ceil(hi / unit - 1e-10) + CASE WHEN ceil(hi / unit - 1e-10) * unit < hi - 1e-10 * unit THEN 1 ELSE 0 END AS nu
      FROM (SELECT lo, hi, n, CASE WHEN 2 * base - cell < 1.5 * (cell - base) THEN
               CASE WHEN 5 * base - cell < 2.75 * (cell - 2 * base) THEN
                 CASE WHEN 10 * base - cell < 1.5 * (cell - 5 * base) THEN 10 * base ELSE 5 * base END
               ELSE 2 * base END ELSE base END AS unit
            FROM (SELECT lo, hi, n, cell, pow(10.0, floor(log10(cell))) AS base
                  FROM (SELECT min(target) AS lo, max(target) AS hi, count(target) AS n,
                               (max(target) - min(target)) / 100 AS cell FROM train) r) b) u) v"""
    SQL["target_histogram_density"] = with_roles(["train"], binned.format(**fmt), [("p", pretty)])
    SQL["lag_density"] = with_roles(["merchants"], f"""
SELECT d.feature, g.point, {r4('g.x')} AS x,
 {r4('sum(c.cnt * exp(-0.5 * ((g.x - c.mid) / d.bw) * ((g.x - c.mid) / d.bw))) / (d.n * d.bw * sqrt(2 * pi()))')} AS density,
 {r4('d.bw')} AS bw, d.n
FROM bwt d JOIN cells c ON c.feature = d.feature,
     (SELECT CAST(range AS INTEGER) AS point, 5.0 * range / 511 AS x FROM range(512)) g
GROUP BY d.feature, g.point, g.x, d.bw, d.n""", [
        ("lagl", f"SELECT * FROM ({lag_long}) l WHERE value IS NOT NULL AND value >= 0 AND value <= 5"),
        ("cells", "SELECT feature, 0 + (LEAST(floor(value / (5.0 / 2048)), 2047) + 0.5) * (5.0 / 2048) AS mid, "
                  "count(*) AS cnt FROM lagl GROUP BY feature, LEAST(floor(value / (5.0 / 2048)), 2047)"),
        ("mom", "SELECT feature, count(*) AS n, stddev_samp(value) AS sd, min(value) AS first, "
                "quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM lagl GROUP BY feature"),
        ("bwt", "SELECT feature, n, 0.9 * CASE WHEN least(coalesce(sd, 0), iqr / 1.34) > 0 "
                "THEN least(coalesce(sd, 0), iqr / 1.34) WHEN coalesce(sd, 0) > 0 THEN sd "
                "WHEN abs(first) > 0 THEN abs(first) ELSE 1 END * pow(n, -0.2) AS bw FROM mom"),
    ])
    oh_cols = [f"feature_1{v}" for v in range(1, 6)] + ["feature_22", "feature_23", "feature_3", "target"]
    ranks_long = " UNION ALL ".join(
        f"SELECT card_id, '{c}' AS col, rank() OVER (ORDER BY {c}) + "
        f"(count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r FROM oh" for c in oh_cols)
    full = ("SELECT * FROM train WHERE feature_1 IS NOT NULL AND feature_2 IS NOT NULL "
            "AND feature_3 IS NOT NULL AND target IS NOT NULL")
    SQL["one_hot_cells"] = with_roles(["train"], f"""
SELECT card_id, CAST(c AS BIGINT) AS "column", {r4('v')} AS value FROM (
  SELECT card_id, dense_rank() OVER (ORDER BY feature_1) - 1 AS c, CAST(1 AS DOUBLE) AS v FROM full_rows
  UNION ALL
  SELECT card_id, n1 + r - 2, CAST(1 AS DOUBLE) FROM (
    SELECT card_id, dense_rank() OVER (ORDER BY feature_2) AS r FROM full_rows),
    (SELECT count(DISTINCT feature_1) AS n1 FROM full_rows) WHERE r > 1
  UNION ALL
  SELECT card_id, n - 1, CAST(feature_3 AS DOUBLE) FROM full_rows,
    (SELECT count(DISTINCT feature_1) + count(DISTINCT feature_2) AS n FROM full_rows) WHERE feature_3 <> 0
  UNION ALL
  SELECT card_id, n, target FROM full_rows,
    (SELECT count(DISTINCT feature_1) + count(DISTINCT feature_2) AS n FROM full_rows) WHERE target <> 0) x""",
        [("full_rows", full)])
    SQL["spearman_matrix"] = with_roles(["train"], f"""
SELECT a.col AS col_a, b.col AS col_b,
 {r4('CASE WHEN stddev_pop(a.r) = 0 OR stddev_pop(b.r) = 0 THEN NULL ELSE corr(a.r, b.r) END')} AS rho
FROM rl a JOIN rl b ON a.card_id = b.card_id GROUP BY a.col, b.col""",
        [("oh", one_hot), ("rl", ranks_long)])

    # --- split
    groups = """
SELECT t.card_id, t.target,
 CASE WHEN t.target <= q.c1 THEN 1 WHEN t.target <= q.c2 THEN 2 WHEN t.target <= q.c3 THEN 3 ELSE 4 END AS grp
FROM train t, (SELECT quantile_cont(target, 0.25) AS c1, quantile_cont(target, 0.5) AS c2,
                      quantile_cont(target, 0.75) AS c3 FROM train) q"""
    split = """
SELECT card_id, target, grp,
 CASE WHEN row_number() OVER (PARTITION BY grp ORDER BY md5('1:2:' || CAST(card_id AS VARCHAR)), card_id)
      <= ceil(count(*) OVER (PARTITION BY grp) * 0.8) THEN 'train' ELSE 'holdout' END AS part
FROM g"""
    SQL["split_stratified"] = with_roles(["train"], _round_cols(("target",), "s"),
                                         [("g", groups), ("s", split)])
    folds = """
SELECT card_id, target, grp,
 CAST((row_number() OVER (PARTITION BY grp ORDER BY md5('1:0:' || CAST(card_id AS VARCHAR)), card_id) - 1) % 5 AS INTEGER) AS fold
FROM g"""
    SQL["cv_folds"] = with_roles(["train"], _round_cols(("target",), "f"),
                                 [("g", groups), ("f", folds)])
    SQL["rmse_baseline"] = with_roles(["train"], f"""
SELECT m.n_train, {r4('m.mean_train')} AS mean_train, count(*) AS n_holdout,
 {r4('sqrt(avg(pow(s.target - m.mean_train, 2)))')} AS rmse
FROM s, (SELECT count(*) AS n_train, avg(target) AS mean_train FROM s WHERE part = 'train') m
WHERE s.part = 'holdout' GROUP BY m.n_train, m.mean_train""", [("g", groups), ("s", split)])


_reg()


def _reg_stream() -> None:
    amount = ", ".join([
        f"{r4('sum(purchase_amount)')} AS purchase_amount_sum",
        f"{r4('avg(purchase_amount)')} AS purchase_amount_mean",
        f"{r4('min(purchase_amount)')} AS purchase_amount_min",
        f"{r4('max(purchase_amount)')} AS purchase_amount_max",
        f"{r4('stddev_samp(purchase_amount)')} AS purchase_amount_sd"])
    SQL["stream_term_hist"] = with_roles(["histdata"], f"""
SELECT card_id, count(*) AS no_trans,
 CAST(epoch(max(purchase_date)) - epoch(min(purchase_date)) AS BIGINT) AS pur_term, {amount}
FROM histdata GROUP BY card_id""")


_reg_stream()


def _reg_sink() -> None:
    from cardgrain.plans.oracle import card_features_sql
    SQL["sink_features_csv"] = card_features_sql("train", REF, True)


_reg_sink()
