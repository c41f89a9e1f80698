"""Demand forecast on the daily sales."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.catalog.reference_sql import rnd, with_layers
from shopgrain.catalog.registry import query
from shopgrain.functions import rounded
from shopgrain.functions.calendar import HOLIDAYS
from shopgrain.operators import forecast
from shopgrain.plans import gold
from shopgrain.session import materialize, scratch_path
from shopgrain.sources.conform import Retail


def total_series(t: Retail) -> DataFrame:
    """One series over all sales, gaps filled; small and read several times, so written once."""
    series = forecast.daily_series(gold.daily_revenue(t.order_lines), [])
    return forecast.fill_days(materialize(series, "series"))


@query(
    "forecast_daily_series",
    with_layers(
        """SELECT concat_ws('|', region, channel) AS series, order_date AS ds,
          CAST(SUM(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE) AS y
        FROM gold_daily_sales WHERE order_date IS NOT NULL GROUP BY 1, 2""",
        "gold_daily_sales",
    ),
)
def forecast_daily_series(t: Retail):
    return forecast.daily_series(gold.daily_revenue(t.order_lines), ["region", "channel"])


@query("forecast_train_test_split", with_layers("SELECT * FROM daily_split", "daily_split"))
def forecast_train_test_split(t: Retail):
    return forecast.with_split(total_series(t))


def _waves_sql(prefix: str, period: float, order: int) -> list[str]:
    columns = []
    for n in range(1, order + 1):
        angle = f"(CAST(n AS DOUBLE) * (CAST(2.0 AS DOUBLE) * pi() * {n} / CAST({period} AS DOUBLE)))"
        columns += [
            f"{rnd(f'sin{angle}', 6)} AS {prefix}_sin_{n}",
            f"{rnd(f'cos{angle}', 6)} AS {prefix}_cos_{n}",
        ]
    return columns


HOLIDAY_SQL = """CASE
  WHEN mo = 1 AND da = 1 THEN 'New Year''s Day'
  WHEN mo = 1 AND wd = 1 AND da BETWEEN 15 AND 21 THEN 'Martin Luther King Jr. Day'
  WHEN mo = 2 AND wd = 1 AND da BETWEEN 15 AND 21 THEN 'Washington''s Birthday'
  WHEN mo = 5 AND wd = 1 AND da >= 25 THEN 'Memorial Day'
  WHEN mo = 6 AND da = 19 AND year(ds) >= 2021 THEN 'Juneteenth'
  WHEN mo = 7 AND da = 4 THEN 'Independence Day'
  WHEN mo = 9 AND wd = 1 AND da <= 7 THEN 'Labor Day'
  WHEN mo = 10 AND wd = 1 AND da BETWEEN 8 AND 14 THEN 'Columbus Day'
  WHEN mo = 11 AND da = 11 THEN 'Veterans Day'
  WHEN mo = 11 AND wd = 4 AND da BETWEEN 22 AND 28 THEN 'Thanksgiving'
  WHEN mo = 12 AND da = 25 THEN 'Christmas Day' END"""


@query(
    "forecast_features",
    with_layers(
        f"""SELECT ds, CAST(n AS INTEGER) AS trend, {HOLIDAY_SQL} AS holiday,
          {", ".join(_waves_sql("yearly", 365.25, 10) + _waves_sql("weekly", 7.0, 3))}
        FROM (SELECT ds, date_diff('day', DATE '1970-01-01', ds) AS n, month(ds) AS mo, day(ds) AS da,
                     dayofweek(ds) AS wd FROM daily_filled)""",
        "daily_filled",
    ),
)
def forecast_features(t: Retail):
    rows = forecast.features(total_series(t)).drop("series", "y")
    waves = [c for c in rows.columns if c.startswith(("yearly_", "weekly_"))]
    return rows.withColumns({c: rounded(F.col(c), 6) for c in waves})


TREND_SQL = """SELECT 'all' AS series, MIN(ds) AS first_day, COUNT(y) AS n,
    CAST(SUM(x) AS DOUBLE) AS sx, CAST(SUM(v) AS DOUBLE) AS sy, CAST(SUM(x * x) AS DOUBLE) AS sxx,
    CAST(SUM(x * v) AS DOUBLE) AS sxy
  FROM (SELECT ds, y, CAST(y AS DECIMAL(18,2)) AS v, CAST(date_diff('day',
          (SELECT MIN(ds) FROM daily_split), ds) AS DECIMAL(10,0)) AS x
        FROM daily_split WHERE is_train)"""
SLOPE_SQL = "((n * sxy - sx * sy) / NULLIF(n * sxx - sx * sx, 0))"


@query(
    "forecast_trend_baseline",
    with_layers(
        f"""SELECT series, first_day, n, {rnd(SLOPE_SQL, 4)} AS slope,
          {rnd(f"(sy - {SLOPE_SQL} * sx) / n", 2)} AS intercept FROM ({TREND_SQL})""",
        "daily_split",
    ),
)
def forecast_trend_baseline(t: Retail):
    train, _ = forecast.split(total_series(t))
    return forecast.linear_trend(train).withColumns(
        {"slope": rounded(F.col("slope"), 4), "intercept": rounded(F.col("intercept"), 2)}
    )


@query(
    "forecast_evaluate",
    with_layers(
        f"""SELECT 'all' AS series, COUNT(*) AS n_days, {rnd("AVG(abs(y - yhat))", 2)} AS mae,
          {rnd("sqrt(AVG((y - yhat) * (y - yhat)))", 2)} AS rmse,
          {rnd("AVG(abs((y - yhat) / NULLIF(y, 0))) * 100", 4)} AS mape
        FROM (SELECT y, (sy - {SLOPE_SQL} * sx) / n + {SLOPE_SQL} * date_diff('day', first_day, ds)
                AS yhat FROM daily_split, ({TREND_SQL}) WHERE NOT is_train)""",
        "daily_split",
    ),
)
def forecast_evaluate(t: Retail):
    train, test = forecast.split(total_series(t))
    predicted = forecast.predict_trend(forecast.linear_trend(train), test.select("series", "ds"))
    return forecast.evaluate(predicted, test)


HOLIDAY_NAMES = [h.replace("'", "''") for h in HOLIDAYS]
KNOTS = [forecast.CHANGEPOINT_RANGE * k / forecast.CHANGEPOINTS for k in range(1, forecast.CHANGEPOINTS + 1)]
N_WAVES = 2 * (forecast.YEARLY_ORDER + forecast.WEEKLY_ORDER)
#: One by the square of each prior, in the order of the features; the constant has none.
WEIGHTS = [0.0, 0.04, *[100.0] * len(KNOTS), *[0.01] * (N_WAVES + len(HOLIDAYS))]


def _angles(period: float, order: int) -> list[str]:
    waves = [f"day_no * 2e0 * pi() * {n} / {period}e0" for n in range(1, order + 1)]
    return [f"{f}({a})" for a in waves for f in ("sin", "cos")]


def fit_sql(train: str, *layers: str) -> str:
    """The fit told as linear algebra: normal equations as lists of lists, reduced row by row, twice.

    ``train`` selects series, ds and y, over 33 days a series. Results in whole currency units.
    """
    size = len(WEIGHTS)
    inputs = ["1e0", "t", *[f"greatest(0e0, t - {k!r})" for k in KNOTS]]
    inputs += _angles(365.25, 10) + _angles(7.0, 3)
    inputs += [f"(CASE WHEN holiday = '{h}' THEN 1e0 ELSE 0e0 END)" for h in HOLIDAY_NAMES]
    reduced = f"""SELECT series, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k
        THEN list_transform(r, lambda v: v / r[k])
        ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END)"""
    solve = "".join(
        f"""system{n} AS (SELECT series, list(list_transform(r, lambda v, j:
            v + CASE WHEN j = i THEN noise * weights[i] ELSE 0e0 END) ORDER BY i) AS m
          FROM gram JOIN noise{n} USING (series), (SELECT {WEIGHTS}::DOUBLE[] AS weights) GROUP BY series),
        step{n}(series, k, m) AS (SELECT series, 1, m FROM system{n} UNION ALL {reduced}
          FROM step{n} WHERE k <= {size}),
        beta{n} AS (SELECT series, list_transform(m, lambda r: r[{size + 1}]) AS beta FROM step{n}
          WHERE k = {size + 1}),
        noise{n + 1} AS (SELECT series, greatest(avg((v - list_dot_product(x, beta)) ** 2), 1e-9) AS noise
          FROM feat JOIN beta{n} USING (series) WHERE v IS NOT NULL GROUP BY series),
        """
        for n in (1, 2)
    )
    z = repr(NormalDist().inv_cdf((1 + forecast.INTERVAL) / 2))
    body = f"""SELECT * FROM (WITH RECURSIVE train AS ({train}),
        span AS (SELECT series, MIN(ds) AS d0, MAX(ds) AS d1, MAX(abs(y)) AS size FROM train GROUP BY 1),
        days AS (SELECT series, ds, y FROM train UNION ALL
          SELECT series, CAST(d1 + CAST(i AS INTEGER) AS DATE), NULL FROM span, range(1, 91) AS a(i)),
        told AS (SELECT series, ds, y / size AS v, date_diff('day', DATE '1970-01-01', ds) AS day_no,
          CAST(date_diff('day', d0, ds) AS DOUBLE) / date_diff('day', d0, d1) AS t, month(ds) AS mo,
          day(ds) AS da, dayofweek(ds) AS wd FROM days JOIN span USING (series)),
        feat AS (SELECT series, ds, v, [{", ".join(inputs)}] AS x FROM (SELECT *, {HOLIDAY_SQL} AS holiday FROM told)),
        gram AS (SELECT series, i, list(s ORDER BY j) AS r FROM (
            SELECT series, i, j, SUM(a[i] * a[j]) AS s
            FROM (SELECT series, list_append(x, v) AS a FROM feat WHERE v IS NOT NULL),
              range(1, {size + 1}) AS p(i), range(1, {size + 2}) AS q(j) GROUP BY ALL) GROUP BY series, i),
        noise1 AS (SELECT series, greatest(var_pop(v), 1e-9) AS noise FROM feat WHERE v IS NOT NULL GROUP BY series),
        {solve}
        ahead AS (SELECT series, ds, list_dot_product(x, beta) * size AS yhat, {z} * sqrt(noise) * size AS margin
          FROM feat JOIN beta2 USING (series) JOIN noise3 USING (series) JOIN span USING (series) WHERE v IS NULL)
        SELECT series, ds, round(yhat) AS yhat, round(yhat - margin) AS yhat_lower,
          round(yhat + margin) AS yhat_upper FROM ahead)"""
    return with_layers(body, *layers)


def whole(predicted: DataFrame) -> DataFrame:
    """Forecasts in whole currency units, as reported."""
    return predicted.withColumns({c: F.round(c) for c in ("yhat", "yhat_lower", "yhat_upper")})


REPORT = "SELECT ds AS forecast_date, yhat AS predicted_revenue, yhat_lower AS lower_bound, yhat_upper AS upper_bound"
ONE_FIT = fit_sql("SELECT series, ds, y FROM daily_split WHERE is_train", "daily_split")
BY_SERIES = """WITH s AS (SELECT concat_ws('|', region, channel) AS series, order_date AS ds,
      CAST(SUM(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE) AS y
    FROM gold_daily_sales WHERE order_date IS NOT NULL GROUP BY 1, 2),
  e AS (SELECT series, MAX(ds) AS last, unnest(generate_series(MIN(ds), MAX(ds), INTERVAL 1 DAY)) AS d
    FROM s GROUP BY series)
  SELECT e.series, CAST(d AS DATE) AS ds, COALESCE(y, 0.0) AS y
  FROM e LEFT JOIN s ON e.series = s.series AND CAST(d AS DATE) = s.ds WHERE CAST(d AS DATE) <= last - 30"""


@query("forecast_fit_predict", fit_sql(BY_SERIES, "gold_daily_sales"))
def forecast_fit_predict(t: Retail):
    """90 days ahead for every (region, channel) series."""
    series = forecast.daily_series(gold.daily_revenue(t.order_lines), ["region", "channel"])
    train, _ = forecast.split(forecast.fill_days(materialize(series, "series")))
    return whole(forecast.fit_predict(train))


@query(
    "forecast_evaluate_fit",
    f"""SELECT 'all' AS series, COUNT(*) AS n_days, {rnd("AVG(abs(y - yhat))", 2)} AS mae,
          {rnd("sqrt(AVG((y - yhat) * (y - yhat)))", 2)} AS rmse,
          {rnd("AVG(abs((y - yhat) / NULLIF(y, 0))) * 100", 4)} AS mape
        FROM ({ONE_FIT}) JOIN ({with_layers("SELECT ds, y FROM daily_split WHERE NOT is_train", "daily_split")})
          USING (ds)""",
)
def forecast_evaluate_fit(t: Retail):
    train, test = forecast.split(total_series(t))
    return forecast.evaluate(whole(forecast.fit_predict_one(train)), test)


@query("forecast_write", f"SELECT series, {REPORT.removeprefix('SELECT ')} FROM ({ONE_FIT})")
def forecast_write(t: Retail):
    train, _ = forecast.split(total_series(t))
    path = scratch_path(t.spark, "gold_forecast")
    forecast.as_report(whole(forecast.fit_predict_one(train))).write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


@query("gold_forecast_90day", f"{REPORT} FROM ({ONE_FIT})")
def gold_forecast_90day(t: Retail):
    train, _ = forecast.split(total_series(t))
    return forecast.as_report(whole(forecast.fit_predict_one(train))).drop("series")
