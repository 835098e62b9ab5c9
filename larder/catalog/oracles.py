"""The SQL equivalent of each query that has one."""

from __future__ import annotations

from larder.catalog.queries import (
    FIXED_BASE, FIXED_LINE, LATEST_ROWS, MAINGROUP, PROVINCE, ROLLOUT_DAYS, SAMPLE_ROWS, SERIES_LEVEL, TREND_END,
    TREND_START,
)
from larder.schemas import CODED_IDS, FEATURES, KEY_COLUMNS, LAGS, LEVELS, MEASURES, MODEL_PREFERENCE

STAR = """
sales AS (
  SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INT) AS date_key,
         l_partkey AS product_key, l_suppkey AS store_key,
         CAST(CAST(l_quantity AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS sales_qty,
         CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS sales_revenue,
         CAST(round(CAST(l_quantity AS DECIMAL(12,2)) * (1 + CAST(l_tax AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS import_qty,
         CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.001 AS DECIMAL(4,3)) - 5, 2) AS DECIMAL(18,2)) AS opening_inventory,
         CAST(l_shipdate AS DATE) AS full_date
  FROM lineitem),
products AS (
  SELECT p_partkey AS product_key, p_type AS maingroup_id, p_type AS maingroup_name,
         CAST(regexp_replace(p_brand, '[^0-9]', '', 'g') AS INT) AS subgroup_id,
         CASE WHEN CAST(regexp_replace(p_brand, '[^0-9]', '', 'g') AS INT) < 20
              THEN translate(p_brand, '#0123456789', ' abcdefghij') ELSE p_brand END AS subgroup_name
  FROM part),
stores AS (
  SELECT s_suppkey AS store_key, CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name,
         n_nationkey AS province_id, n_name AS province_name
  FROM supplier JOIN nation ON n_nationkey = s_nationkey),
star AS (
  SELECT *, CAST(isodow(full_date) - 1 AS INT) AS day_of_week, isodow(full_date) >= 6 AS is_weekend,
         CAST((day(full_date) - 1) // 7 + 1 AS INT) AS week_of_month
  FROM sales JOIN products USING (product_key) JOIN stores USING (store_key))"""

CALENDAR = "day_of_week, is_weekend, week_of_month"
SUMS = ", ".join(f"CAST(sum({m}) AS DOUBLE) AS {m}" for m in MEASURES)
DOUBLES = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in MEASURES)


def _r(expression: str, name: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) AS {name}"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([STAR.strip(), *ctes])


def _daily(level: str) -> str:
    """The roll-up of a level."""
    keys = ", ".join(LEVELS[level])
    return f"SELECT full_date, {CALENDAR}, {keys}, {SUMS} FROM star GROUP BY full_date, {CALENDAR}, {keys}"


def _windowed(source: str, keys) -> str:
    """Unrounded features of the daily rows of a source."""
    part = ", ".join(keys)
    lags = ", ".join(f"lag(sales_qty, {i}) OVER w AS {n}" for i, n in enumerate(LAGS, 1))
    return (
        f"SELECT *, rolling_std_7 / (rolling_mean_7 + 1e-6) AS cv_7, ln(1 + sales_qty) AS log_sales_qty FROM ("
        f"SELECT *, {lags}, avg(sales_qty) OVER b AS rolling_mean_7, "
        f"coalesce(stddev_samp(sales_qty) OVER b, 0) AS rolling_std_7 FROM {source} "
        f"WINDOW w AS (PARTITION BY {part} ORDER BY full_date), "
        f"b AS (PARTITION BY {part} ORDER BY full_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) "
        f"WHERE lag_7 IS NOT NULL"
    )


def _rounded_features(keys) -> str:
    derived = ("rolling_mean_7", "rolling_std_7", "cv_7", "log_sales_qty")
    return ", ".join(
        ["full_date", CALENDAR, *keys, *MEASURES, *LAGS] + [_r(c, c) for c in derived]
    )


def _level_features(level: str) -> list[str]:
    """CTEs that end in `feat`, the unrounded features of a level."""
    return [f"daily AS ({_daily(level)})", f"feat AS ({_windowed('daily', LEVELS[level])})"]


TYPES = {"subgroup_id": "INT", "province_id": "INT"}


def _long(level: str, source: str) -> str:
    """Rows of a level with all key columns."""
    keys = ", ".join(
        k if k in LEVELS[level] else f"CAST(NULL AS {TYPES.get(k, 'VARCHAR')}) AS {k}"
        for k in KEY_COLUMNS
    )
    measures = ", ".join(MEASURES)
    return f"SELECT '{level}' AS level, full_date, {CALENDAR}, {keys}, {measures} FROM ({source})"


ALL_DAILY = " UNION ALL ".join(_long(level, _daily(level)) for level in LEVELS)
ALL_FEATURES = [
    f"daily AS ({ALL_DAILY})",
    f"feat AS ({_windowed('daily', ('level', *KEY_COLUMNS))})",
]
SPLIT = ("CASE WHEN day(full_date) <= 21 THEN 'train' "
         "WHEN day(full_date) <= 26 THEN 'val' ELSE 'test' END")


def _codes_sql(columns_of, order_of) -> str:
    ctes, selects = [], []
    for i, (level, keys) in enumerate(LEVELS.items()):
        ctes += [
            f"daily{i} AS ({_daily(level)})",
            f"series{i} AS (SELECT DISTINCT {', '.join(keys)} FROM ({_windowed(f'daily{i}', keys)}))",
            f"ranked{i} AS (SELECT *, row_number() OVER (ORDER BY {', '.join(keys)}) AS pos FROM series{i})",
        ]
        for column in columns_of(keys):
            selects.append(
                f"SELECT '{level}' AS level, '{column}' AS key_column, CAST({column} AS VARCHAR) AS value, "
                f"CAST(row_number() OVER (ORDER BY {order_of(column)}) - 1 AS INT) AS code "
                f"FROM ranked{i} GROUP BY {column}"
            )
    return _with(*ctes) + "\n" + " UNION ALL ".join(selects)


TEXT_KEYS = ("maingroup_id", "maingroup_name", "subgroup_name", "province_name", "store_id")


def _feature_vector_sql() -> str:
    level = "2_category_province"
    keys = LEVELS[level]
    # maingroup_id is text in the test tables, so its label code replaces the first-seen one.
    ids = [c for c in CODED_IDS if c in keys]
    codes = ids + [k for k in keys if k in TEXT_KEYS and k not in ids]
    inner = []
    for c in codes:
        if c in TEXT_KEYS:
            inner.append(f"dense_rank() OVER (ORDER BY {c}) - 1 AS {c}_enc")
        else:
            inner.append(f"dense_rank() OVER (ORDER BY first_{c}) - 1 AS {c}_enc")
    firsts = ", ".join(f"min(pos) OVER (PARTITION BY {c}) AS first_{c}" for c in ids)
    names = [f"CAST({'CAST(is_weekend AS INT)' if c == 'is_weekend' else c} AS DOUBLE)" for c in FEATURES]
    columns = [_r(e, c) for e, c in zip(names, FEATURES)]
    columns += [f"CAST({c}_enc AS DOUBLE) AS {c}_enc" for c in codes]
    using = ", ".join(keys)
    return _with(
        *_level_features(level),
        f"ranked AS (SELECT *, row_number() OVER (ORDER BY {using}) AS pos FROM (SELECT DISTINCT {using} FROM feat))",
        f"firsts AS (SELECT *, {firsts} FROM ranked)",
        f"coded AS (SELECT *, {', '.join(inner)} FROM firsts)",
    ) + f"\nSELECT {using}, full_date, {_r('log_sales_qty', 'log_sales_qty')}, {', '.join(columns)} FROM feat JOIN coded USING ({using})"


QTY = [
    "vals AS (SELECT 'raw' AS scale, CAST(sales_qty AS DOUBLE) AS x FROM sales WHERE sales_qty > 0 AND sales_qty < 1000 "
    "UNION ALL SELECT 'log1p', ln(1 + CAST(sales_qty AS DOUBLE)) FROM sales WHERE sales_qty > 0 AND sales_qty < 1000)",
    "stats AS (SELECT scale, count(*) AS n_rows, avg(x) AS mean, median(x) AS median, "
    "stddev_samp(x) AS std, min(x) AS low, max(x) AS high FROM vals GROUP BY scale)",
    "freq AS (SELECT scale, x, count(*) AS n FROM vals GROUP BY scale, x)",
]

TREND = (
    "trend AS (SELECT full_date, is_weekend, maingroup_name, CAST(sum(sales_qty) AS DOUBLE) AS sales_qty FROM star "
    f"WHERE full_date BETWEEN DATE '{TREND_START}' AND DATE '{TREND_END}' GROUP BY full_date, is_weekend, maingroup_name)"
)
TOP3 = (
    "top3 AS (SELECT maingroup_name, sum(sales_qty) AS total_qty, "
    "row_number() OVER (ORDER BY sum(sales_qty) DESC, maingroup_name) AS pos FROM trend GROUP BY maingroup_name "
    "QUALIFY pos <= 3)"
)
DATES = (
    "dates AS (SELECT full_date, CAST(isodow(full_date) - 1 AS INT) AS day_of_week, "
    "isodow(full_date) >= 6 AS is_weekend, CAST((day(full_date) - 1) // 7 + 1 AS INT) AS week_of_month "
    "FROM (SELECT CAST(unnest(generate_series(min(full_date), max(full_date), INTERVAL 1 DAY)) AS DATE) AS full_date FROM sales))"
)


def _correlation_sql() -> str:
    names = [*LAGS, "rolling_mean_7", "rolling_std_7", "cv_7", "day_of_week", "is_weekend"]
    label = {"rolling_mean_7": "roll_mean7", "rolling_std_7": "roll_std7", "day_of_week": "day_of_wk"}
    cell = "SELECT '{}' AS feature, '{}' AS other, round(corr(CAST({} AS DOUBLE), CAST({} AS DOUBLE)), 6) AS corr FROM flat"
    cells = [
        cell.format(label.get(a, a), label.get(b, b), a, b)
        for i, a in enumerate(names) for b in names[: i + 1]
    ]
    return _with(
        *_level_features("1_category_national"),
        "flat AS (SELECT * REPLACE (CAST(is_weekend AS INT) AS is_weekend) FROM feat)",
    ) + "\n" + " UNION ALL ".join(cells)


def _moments_sql() -> str:
    """Correlations of the model inputs and the target by level and split."""
    names = [*FEATURES, "log_sales_qty"]
    values = ", ".join(f"coalesce(CAST({n} AS DOUBLE), 0) AS {n}" for n in names)
    cell = (
        "SELECT level, split, '{0}' AS feature, '{1}' AS other, count(*) AS n, CASE WHEN min({0}) < max({0}) "
        "AND min({1}) < max({1}) THEN round(corr({0}, {1}), 6) END AS corr FROM flat GROUP BY level, split"
    )
    cells = [cell.format(a, b) for i, a in enumerate(names) for b in names[:i]]
    return _with(
        *ALL_FEATURES,
        f"flat AS MATERIALIZED (SELECT level, {SPLIT} AS split, {values} "
        f"FROM (SELECT * REPLACE (CAST(is_weekend AS INT) AS is_weekend) FROM feat) "
        f"WHERE sales_qty > -1 OR {SPLIT} = 'test')",
    ) + "\n" + " UNION ALL ".join(cells)


def _naive_ctes(keys) -> list[str]:
    part = ", ".join(keys)
    return [
        f"parted AS (SELECT *, {SPLIT} AS split FROM feat)",
        f"counted AS (SELECT *, count(*) FILTER (split = 'train') OVER s AS n_train, "
        f"count(*) FILTER (split = 'test') OVER s AS n_test, "
        f"arg_max(sales_qty, CASE WHEN split <> 'test' THEN full_date END) OVER s AS last_qty "
        f"FROM parted WINDOW s AS (PARTITION BY {part}))",
        "naive AS (SELECT * FROM counted WHERE n_train >= 7 AND n_test > 0 AND split = 'test')",
    ]


def _autoregression_ctes(keys: str) -> list[str]:
    """Moments of a series and its two lags; a variance that is none but rounding is NULL."""
    return [
        f"parted AS (SELECT *, {SPLIT} AS split FROM feat)",
        f"fitting AS (SELECT * FROM parted QUALIFY count(*) FILTER (split = 'train') OVER (PARTITION BY {keys}) >= 7 "
        f"AND count(*) FILTER (split = 'test') OVER (PARTITION BY {keys}) > 0)",
        f"lagged AS (SELECT {keys}, log_sales_qty AS y, lag(log_sales_qty, 1) OVER s AS l1, lag(log_sales_qty, 2) OVER s AS l2, "
        f"count(*) OVER (PARTITION BY {keys}) AS held FROM fitting WHERE split <> 'test' AND log_sales_qty IS NOT NULL "
        f"WINDOW s AS (PARTITION BY {keys} ORDER BY full_date))",
        f"raw AS (SELECT {keys}, CAST(count(*) AS INT) AS n, avg(y) AS y, avg(l1) AS l1, avg(l2) AS l2, var_pop(y) AS vy, "
        f"CASE WHEN count(*) * var_pop(l1) > 1e-10 * sum(l1 * l1) THEN var_pop(l1) END AS v1, var_pop(l2) AS v2, "
        f"sum(l2 * l2) AS s2, covar_pop(l1, y) AS c1y, covar_pop(l2, y) AS c2y, covar_pop(l1, l2) AS c12 "
        f"FROM lagged WHERE held > 5 AND l2 IS NOT NULL GROUP BY {keys})",
        "moments AS (SELECT *, CASE WHEN n * (v1 * v2 - c12 * c12) / v1 > 1e-10 * s2 THEN v1 * v2 - c12 * c12 END AS det FROM raw)",
    ]


METRICS = [
    *ALL_FEATURES,
    *_naive_ctes(("level", *KEY_COLUMNS)),
    "forecasts AS (SELECT level, 'naive' AS model, sales_qty AS a, last_qty AS p FROM naive "
    "UNION ALL SELECT level, 'uplift', sales_qty, lag_1 * (1 + 0.05::DOUBLE) FROM parted WHERE split = 'test')",
    """scored AS (SELECT level, model,
      round(sqrt(avg((a - p) * (a - p))), 4) AS "RMSE",
      round(avg(abs(a - p) / a) FILTER (a > 1e-6) * 100, 2) AS "MAPE",
      round(avg(abs(a - p)), 4) AS "MAE",
      round(avg(CASE WHEN abs(a - p) / a < 0.25 THEN 1.0::DOUBLE ELSE 0 END) FILTER (a > 1e-6) * 100, 2) AS "PRED25",
      round(avg(abs(p - a) / greatest(least(a, p), 1e-6)) FILTER (a > 1e-6) * 100, 2) AS "MBRE",
      round(avg(abs(p - a) / greatest(a, p, 1e-6)) FILTER (a > 1e-6) * 100, 2) AS "MIBRE",
      round(avg((p - a) / a) FILTER (a > 1e-6) * 100, 2) AS mean_bias_pct,
      round(avg(2 * abs(p - a) / (a + p)) FILTER (a > 1e-6) * 100, 2) AS smape_pct,
      count(*) AS "N" FROM forecasts GROUP BY level, model)""",
]

CUTOFF = "(SELECT max(full_date) FROM sales)"
SERVED_COLUMNS = f"full_date, {CALENDAR}, subgroup_id, subgroup_name, maingroup_id, maingroup_name"
SERVED_SUMS = ", ".join(
    f"CAST(sum({m}) AS DOUBLE) AS {m}" for m in ("sales_qty", "opening_inventory", "import_qty")
)
SERVED_ALL = f"SELECT {SERVED_COLUMNS}, {SERVED_SUMS} FROM star WHERE full_date < {CUTOFF} GROUP BY {SERVED_COLUMNS}"
SERVED = f"served AS ({SERVED_ALL})"
LATEST = f"ORDER BY full_date DESC, maingroup_id, subgroup_id, maingroup_name, subgroup_name LIMIT {LATEST_ROWS}"

SERIES_KEYS = ", ".join(LEVELS[SERIES_LEVEL])
RECENT = [
    f"daily AS ({_daily(SERIES_LEVEL)})",
    f"recent AS (SELECT *, row_number() OVER (PARTITION BY {SERIES_KEYS} ORDER BY full_date DESC) AS back FROM daily QUALIFY back <= 7)",
]
POINT = [
    *RECENT,
    f"agg AS (SELECT {SERIES_KEYS}, max(full_date) AS last_date, CAST(max(full_date) + 1 AS DATE) AS target, count(*) AS size, "
    + ", ".join(f"coalesce(max(sales_qty) FILTER (back = {i}), 0) AS {n}" for i, n in enumerate(LAGS, 1))
    + ", avg(sales_qty) AS rolling_mean_7, CASE WHEN count(*) >= 7 THEN stddev_pop(sales_qty) ELSE 0 END AS rolling_std_7, "
    f"max(opening_inventory) FILTER (back = 1) AS stock FROM recent GROUP BY {SERIES_KEYS})",
    "point AS (SELECT *, rolling_std_7 / (rolling_mean_7 + 1e-6) AS cv_7, CAST(isodow(target) - 1 AS INT) AS day_of_week, "
    "CAST(isodow(target) >= 6 AS INT) AS is_weekend, CAST((day(target) - 1) // 7 + 1 AS INT) AS week_of_month FROM agg)",
]


def _ordered(source: str, keys: str) -> str:
    """Order lines from qty, cv and stock of a source."""
    return (
        f"SELECT {keys}, round(qty, 2) AS predicted_qty, round(stock, 2) AS opening_inventory, "
        f"round(least(0.40::DOUBLE, 0.15::DOUBLE + cv * 0.25::DOUBLE) * 100, 1) AS safety_factor_pct, "
        f"round(CASE WHEN stock > qty * 3 THEN 0::DOUBLE ELSE greatest(0::DOUBLE, qty * (1 + least(0.40::DOUBLE, 0.15::DOUBLE + cv * 0.25::DOUBLE)) - stock) END, 2) "
        f"AS import_suggestion FROM {source}"
    )


ORDERS = [
    *POINT,
    f"plan AS ({_ordered('(SELECT *, lag_1 * (1 + 0.05::DOUBLE) AS qty, cv_7 AS cv FROM point)', SERIES_KEYS)})",
]


def _rolled(source: str, keys: str, before: str, days: int) -> list[str]:
    """CTEs that end in `rolled`: the fixed line from the last seven days, one row a step.

    Without days it is the one day at the cutoff.
    """
    lag = {f"lag_{i}": f"CASE WHEN len(h) >= {i} THEN h[len(h) - {i - 1}] ELSE 0 END" for i in range(1, 8)}
    terms = " + ".join(f"{w}::DOUBLE * ({lag.get(name, name)})" for name, w in FIXED_LINE.items())
    return [
        f"recent AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY full_date DESC) AS back FROM {source} "
        f"WHERE full_date {before} {CUTOFF} QUALIFY back <= 7)",
        f"state AS (SELECT {keys}, list(sales_qty ORDER BY full_date) AS h, max(full_date) AS last_date, "
        f"arg_max(opening_inventory, full_date) AS stock FROM recent GROUP BY {keys})",
        f"rolled AS (SELECT {keys}, h, last_date, stock, 0 AS step, NULL::DOUBLE AS cv, NULL::DOUBLE AS qty FROM state UNION ALL "
        f"SELECT {keys}, list_append(h, exp(line) - 1)[-7:], last_date, stock, step + 1, cv_7, exp(line) - 1 FROM ("
        f"SELECT *, {FIXED_BASE}::DOUBLE + {terms} AS line FROM ("
        "SELECT *, rolling_std_7 / (rolling_mean_7 + 1e-6) AS cv_7, isodow(target) - 1 AS day_of_week, "
        "CAST(isodow(target) >= 6 AS INT) AS is_weekend, (day(target) - 1) // 7 + 1 AS week_of_month FROM ("
        "SELECT *, list_avg(h) AS rolling_mean_7, CASE WHEN len(h) >= 7 THEN list_stddev_pop(h) ELSE 0 END AS rolling_std_7, "
        f"CAST({CUTOFF} + step{' + 1' if days else ''} AS DATE) AS target FROM rolled WHERE step < {max(days, 1)}))))",
    ]


def _rolled_sql(days: int) -> str:
    plan = _ordered(f"(SELECT * FROM rolled WHERE step = {max(days, 1)})", f"{SERIES_KEYS}, last_date, {_r('cv', 'cv_7')}, {_r('qty', 'forecast')}")
    ctes = _with(f"daily AS ({_daily(SERIES_LEVEL)})", *_rolled("daily", SERIES_KEYS, "<=" if days else "<", days))
    return f"WITH RECURSIVE {ctes.removeprefix('WITH ')}\n{plan}"


DETAILS = [
    "days AS (SELECT subgroup_id, full_date, sum(sales_qty) AS sales_qty, sum(opening_inventory) AS stock, "
    "arg_min({'s': subgroup_name, 'm': maingroup_name}, maingroup_id) AS names FROM served GROUP BY subgroup_id, full_date)",
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY subgroup_id ORDER BY full_date DESC) AS back FROM days)",
    "lines AS (SELECT subgroup_id, arg_max(names, full_date) AS names, arg_max(sales_qty, full_date) * (1 + 0.05::DOUBLE) AS qty, "
    "sum(stock) / count(*) AS stock, CASE WHEN count(*) >= 3 THEN stddev_pop(sales_qty) FILTER (back <= 7) / "
    "(avg(sales_qty) FILTER (back <= 7) + 1e-6) ELSE 0.15 END AS cv FROM ranked GROUP BY subgroup_id)",
]
STATUS = (
    "CASE WHEN import_suggestion > predicted_qty * 0.5 THEN 'alert' WHEN import_suggestion > 0 THEN 'warn' ELSE 'ok' END AS status, "
    "CASE WHEN opening_inventory > 0 AND predicted_qty > 0 THEN CAST(round(opening_inventory / predicted_qty) AS BIGINT) END AS days_of_cover, "
    "NOT (opening_inventory > 0 AND predicted_qty > 0) AS is_short"
)


def _record_sql() -> str:
    ctes = _with(
        f"served AS ({SERVED_ALL})",
        "daily AS (SELECT 1 AS one, full_date, sum(sales_qty) AS sales_qty, sum(opening_inventory) AS opening_inventory FROM served GROUP BY full_date)",
        *_rolled("daily", "one", "<", 0), *DETAILS,
        f"total AS ({_ordered('(SELECT * FROM rolled WHERE step = 1)', 'one')})",
    )
    return f"WITH RECURSIVE {ctes.removeprefix('WITH ')}" + (
        f"\nSELECT * EXCLUDE (one), {STATUS}, {CUTOFF} AS forecast_date, 'fixed' AS model_used, false AS is_rolling, "
        "0 AS rollout_days, 0 AS error_growth_pct, (SELECT CAST(count(*) AS INT) FROM recent) AS n_history, "
        f"(SELECT CAST(count(*) AS INT) FROM lines) AS n_details, {_r('(SELECT sum(sales_qty) FROM recent)', 'history_qty')}, "
        f"{_r('(SELECT sum(round(qty, 2)) FROM lines)', 'details_qty')} FROM total"
    )


def _oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    o["star_scan"] = _with() + f"\nSELECT date_key, product_key, store_key, {DOUBLES}, opening_inventory < 0 AS is_negative_inventory FROM sales"
    o["star_join"] = _with() + (
        f"\nSELECT date_key, product_key, store_key, {DOUBLES}, opening_inventory < 0 AS is_negative_inventory, "
        f"maingroup_id, maingroup_name, subgroup_id, subgroup_name, store_id, store_name, province_id, province_name, "
        f"full_date, {CALENDAR} FROM star"
    )
    o["rollup_all_levels"] = _with() + f"\n{ALL_DAILY}"
    o["features_all_levels"] = _with(*ALL_FEATURES) + (
        f"\nSELECT level, {_rounded_features(KEY_COLUMNS)} FROM feat"
    )
    for i, level in enumerate(LEVELS, start=1):
        o[f"rollup_level{i}"] = _with() + f"\n{_daily(level)}"
        o[f"features_level{i}"] = _with(*_level_features(level)) + (
            f"\nSELECT {_rounded_features(LEVELS[level])} FROM feat"
        )
    o["factorize_codes"] = _codes_sql(
        lambda keys: [k for k in keys if k.endswith("_id")], lambda column: "min(pos)"
    )
    o["label_codes"] = _codes_sql(
        lambda keys: [k for k in keys if k in TEXT_KEYS], lambda column: column
    )
    o["feature_vector"] = _feature_vector_sql()

    o["dim_lists"] = _with() + "\nSELECT DISTINCT province_id, province_name FROM stores WHERE province_name IS NOT NULL"
    o["store_list"] = _with() + "\nSELECT coalesce(store_id, '') AS store_id, coalesce(store_name, '') AS store_name FROM stores"
    o["store_list_of_province"] = o["store_list"] + f" WHERE province_id = {PROVINCE}"
    sold = "SELECT {0} FROM products WHERE product_key IN (SELECT product_key FROM sales)"
    named = "{0} IS NOT NULL AND NOT regexp_matches({0}, '[0-9]')"
    o["maingroup_list"] = _with() + (
        f"\nSELECT DISTINCT maingroup_id, maingroup_name FROM products WHERE maingroup_id IN ({sold.format('maingroup_id')}) "
        f"AND {named.format('maingroup_name')}"
    )
    o["subgroup_list"] = _with() + (
        f"\nSELECT DISTINCT subgroup_id, subgroup_name FROM products WHERE subgroup_id IN ({sold.format('subgroup_id')}) "
        f"AND {named.format('subgroup_name')}"
    )
    o["subgroup_list_of_maingroup"] = o["subgroup_list"] + f" AND maingroup_id = '{MAINGROUP}'"

    in_range = "sales_qty > 0 AND sales_qty < 1000"
    o["qty_range"] = _with() + f"\nSELECT date_key, product_key, store_key, CAST(sales_qty AS DOUBLE) AS sales_qty FROM sales WHERE {in_range}"
    o["qty_sample"] = _with() + (
        f"\nSELECT CAST(sales_qty AS DOUBLE) AS sales_qty FROM sales WHERE {in_range} "
        f"ORDER BY md5(concat_ws('|', '1', date_key, product_key, store_key, sales_qty, sales_revenue)) LIMIT {SAMPLE_ROWS}"
    )
    o["qty_summary"] = _with(*QTY) + (
        "\nSELECT scale, n_rows, " + ", ".join(_r(c, c) for c in ("mean", "median", "std", "low", "high")) + " FROM stats"
    )
    o["qty_histogram"] = _with(
        *QTY,
        "placed AS (SELECT scale, least(CAST(floor(60 * (x - low) / (high - low)) AS BIGINT) + 1, 60) AS bin, count(*) AS n "
        "FROM vals JOIN stats USING (scale) GROUP BY ALL)",
        "edges AS (SELECT *, unnest(generate_series(1, 60)) AS bin FROM stats)",
    ) + (
        f"\nSELECT scale, bin, {_r('low + (bin - 1) * ((high - low) / 60)', 'bin_low')}, coalesce(n, 0) AS n, "
        f"{_r('coalesce(n, 0) / (n_rows * ((high - low) / 60))', 'density')} FROM edges LEFT JOIN placed USING (scale, bin)"
    )
    o["qty_kde"] = _with(
        *QTY,
        "grid AS (SELECT scale, CAST(point AS INT) AS point, low + (high - low) * point / 399 AS g, n_rows, std * pow(n_rows, -0.2::DOUBLE) AS h "
        "FROM (SELECT *, unnest(generate_series(0, 399)) AS point FROM stats))",
    ) + (
        f"\nSELECT scale, point, {_r('max(g)', 'x')}, "
        f"{_r('sum(n * exp(-((g - x) / h) * ((g - x) / h) / 2)) / max(n_rows * h * sqrt(2 * pi()))', 'density')} "
        "FROM grid JOIN freq USING (scale) GROUP BY scale, point"
    )
    o["negative_inventory"] = _with() + (
        "\nSELECT maingroup_name, count(*) FILTER (opening_inventory < 0) AS neg_count, count(*) AS total_count, "
        "round(count(*) FILTER (opening_inventory < 0) / count(*) * 100, 6) AS pct_neg "
        "FROM sales JOIN products USING (product_key) GROUP BY maingroup_name"
    )
    o["daily_trend"] = _with(TREND) + "\nSELECT * FROM trend"
    o["top3_groups"] = _with(TREND, TOP3) + "\nSELECT maingroup_name, total_qty FROM top3"
    o["daily_trend_top3"] = _with(TREND, TOP3) + "\nSELECT * FROM trend WHERE maingroup_name IN (SELECT maingroup_name FROM top3)"
    o["daily_pivot"] = _with(TREND, TOP3) + (
        "\nSELECT full_date, " + ", ".join(f"sum(sales_qty) FILTER (pos = {i}) AS top{i}" for i in (1, 2, 3))
        + " FROM trend JOIN top3 USING (maingroup_name) GROUP BY full_date"
    )
    o["correlation_long"] = _correlation_sql()
    o["calendar"] = _with(DATES) + "\nSELECT * FROM dates"
    o["weekend_dates"] = _with(DATES) + "\nSELECT full_date, strftime(full_date, '%d/%m') AS label FROM dates WHERE is_weekend"

    long_keys = ", ".join(("level", *KEY_COLUMNS))
    o["temporal_split"] = _with(*ALL_FEATURES) + (
        f"\nSELECT {long_keys}, full_date, {SPLIT} AS split, day(full_date) <= 26 AS is_fit FROM feat")
    counts = ", ".join(f"count(*) FILTER ({SPLIT} = '{s}') AS n_{s}" for s in ("train", "val", "test"))
    o["split_counts"] = _with(*ALL_FEATURES) + f"\nSELECT level, {counts} FROM feat GROUP BY level"
    o["naive_forecast"] = _with(*ALL_FEATURES, *_naive_ctes(("level", *KEY_COLUMNS))) + (
        f"\nSELECT {long_keys}, full_date, sales_qty AS actual, last_qty AS predicted FROM naive"
    )
    o["ar_coefficients"] = _with(*ALL_FEATURES, *_autoregression_ctes(long_keys)) + (
        f"\nSELECT {long_keys}, 1 AS p, n, {_r('y - c1y / v1 * l1', 'constant')}, {_r('c1y / v1', 'ar1')}, NULL::DOUBLE AS ar2, "
        f"{_r('n * (vy - c1y * c1y / v1)', 'squares_left')} FROM moments UNION ALL "
        f"SELECT {long_keys}, 2, n, {_r('y - a1 * l1 - a2 * l2', 'constant')}, {_r('a1', 'ar1')}, {_r('a2', 'ar2')}, "
        f"{_r('n * (vy - a1 * c1y - a2 * c2y)', 'squares_left')} FROM "
        "(SELECT *, (c1y * v2 - c2y * c12) / det AS a1, (c2y * v1 - c1y * c12) / det AS a2 FROM moments)")
    o["metrics"] = _with(*METRICS) + "\nSELECT * FROM scored"
    o["best_model"] = _with(*METRICS) + (
        '\nSELECT model, round(avg("MAPE"), 6) AS mean_mape FROM scored GROUP BY model ORDER BY mean_mape NULLS LAST, model LIMIT 1'
    )

    o["serving_filter"] = _with() + (
        f"\nSELECT date_key, product_key, store_id, province_id, subgroup_id, maingroup_id, {DOUBLES} "
        f"FROM star WHERE province_id = {PROVINCE} AND full_date < {CUTOFF}"
    )
    o["serving_rollup"] = _with(SERVED) + "\nSELECT * FROM served"
    o["serving_latest"] = _with(SERVED) + f"\nSELECT * FROM served {LATEST}"
    o["serving_daily"] = _with(SERVED) + (
        "\nSELECT full_date, " + ", ".join(f"round(sum({m}), 6) AS {m}" for m in ("sales_qty", "opening_inventory", "import_qty"))
        + f", {CALENDAR} FROM served GROUP BY full_date, {CALENDAR}"
    )
    peak = f"greatest(max(greatest(sales_qty, coalesce(import_qty, 0))) OVER (PARTITION BY {SERIES_KEYS}), 1)"
    o["recent_history"] = _with(*RECENT) + (
        f"\nSELECT {SERIES_KEYS}, full_date, strftime(full_date, '%d/%m') AS label, strftime(full_date, '%m-%d') AS short_label, "
        f"sales_qty, import_qty, {_r(f'sales_qty / {peak}', 'sales_ratio')}, {_r(f'coalesce(import_qty, 0) / {peak}', 'import_ratio')} FROM recent"
    )
    derived = ", ".join([*LAGS, *(_r(c, c) for c in ("rolling_mean_7", "rolling_std_7", "cv_7"))])
    o["point_features"] = _with(*POINT) + f"\nSELECT {SERIES_KEYS}, {derived}, {CALENDAR} FROM point"
    o["order_plan"] = _with(*ORDERS) + "\nSELECT * FROM plan"
    o["stock_status"] = _with(*ORDERS) + (
        f"\nSELECT *, {STATUS} FROM plan"
    )
    o["subgroup_details"] = _with(
        f"served AS ({SERVED_ALL})", *DETAILS,
        f"plan AS ({_ordered('lines', 'nullif(subgroup_id, 0) AS subgroup_id, names')})",
    ) + "\nSELECT * EXCLUDE (names), names.s AS subgroup_name, names.m AS maingroup_name FROM plan"
    o["one_day_forecast_fixed"] = _rolled_sql(0)
    o["recursive_forecast_fixed"] = _rolled_sql(ROLLOUT_DAYS)
    o["forecast_record_fixed"] = _record_sql()
    cell = ", ".join(["full_date", CALENDAR, *KEY_COLUMNS])
    o["daily_cells"] = _with() + (
        f"\nSELECT date_key, {cell}, {SUMS}, CAST(date_key // 100 AS INT) AS month FROM star GROUP BY date_key, {cell}")
    o["serving_province_stored"] = o["serving_rollup"].replace("FROM star WHERE", f"FROM star WHERE province_id = {PROVINCE} AND")
    for name in ("rollup_all_levels", "serving_rollup", "serving_daily", "subgroup_details"):
        o[f"{name}_stored"] = o[name]
    o["forecast_record_stored"] = o["forecast_record_fixed"]
    o["features_refreshed"] = o["features_all_levels"]
    o["training_moments"] = _moments_sql()
    o["model_registry"] = _with(*ALL_FEATURES) + (
        "\nSELECT level, 'linear' AS family, "
        + ", ".join(f"count(*) FILTER ({SPLIT} = '{s}' AND sales_qty > -1) AS n_{s}" for s in ("train", "val"))
        + f", count(*) FILTER ({SPLIT} = 'test') AS n_test FROM feat GROUP BY level HAVING n_train >= 10 AND n_test > 0"
    )
    rank = " ".join(f"WHEN '{level}' THEN {i}" for i, level in enumerate(MODEL_PREFERENCE))
    o["model_preference"] = _with(*ALL_FEATURES) + (
        f"\nSELECT level FROM (SELECT level, {counts} FROM feat GROUP BY level) WHERE n_train > 0 AND n_test > 0 "
        f"ORDER BY CASE level {rank} ELSE {len(MODEL_PREFERENCE)} END, level LIMIT 1"
    )
    return o


def oracle_sql() -> dict[str, str]:
    return _oracles()
