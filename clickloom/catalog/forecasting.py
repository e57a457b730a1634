"""Daily series and Fourier forecasts of ad revenue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clickloom.catalog.registry import query, with_
from clickloom.catalog.tables import AD_DAYS, ad_days, table
from clickloom.operators import forecast
from clickloom.operators.ranking import keep_first

START, END = dt.date(1998, 1, 1), dt.date(1998, 6, 29)  # 180 days
N = 180
KEYS = ["title"]


def revenue(spark, sf):
    return ad_days(spark, sf).select("web_id", "title", "product_id", "date", F.floor(F.col("cents") / 100).alias("revenue"))


DAILY = """daily AS (SELECT title, date, sum(cents // 100) AS v FROM ad_days
  WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-06-29' GROUP BY 1, 2),
titles AS (SELECT DISTINCT title FROM daily),
padded AS (SELECT t.title, c.t, CAST(COALESCE(d.v, 0) AS DOUBLE) AS v FROM titles t
  CROSS JOIN (SELECT CAST(unnest(range(1, 181)) AS INTEGER) AS t) c
  LEFT JOIN daily d ON d.title = t.title AND d.date = DATE '1998-01-01' + (c.t - 1))"""


@query(
    "W13_pad_days",
    with_(
        AD_DAYS, DAILY,
        select="SELECT title, strftime(DATE '1998-01-01' + (t - 1), '%Y-%m-%d') AS date, CAST(v AS BIGINT) AS revenue FROM padded",
    ),
)
def pad_days(spark, sf):
    rows = forecast.pad_days(revenue(spark, sf), KEYS, "revenue", START, END)
    return rows.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def _dft(n, padded="padded", trend=True):
    """Detrended half spectrum of every series, by the definition of the transform."""
    slope = "regr_slope(v, t)" if trend else "0.0"
    return f"""fit AS (SELECT title, {slope} AS slope FROM {padded} GROUP BY 1),
flat AS (SELECT p.title, t, v - slope * t AS v FROM {padded} p JOIN fit USING (title)),
spec AS (SELECT title, k, sum(v * cos(2 * pi() * k * (t - 1) / {n}.0)) AS re, -sum(v * sin(2 * pi() * k * (t - 1) / {n}.0)) AS im
  FROM flat, (SELECT unnest(range({n // 2})) AS k) GROUP BY 1, 2)"""


def _restored(n, first, last):
    return f"""restored AS (SELECT s.title, d, greatest(0, sum(sqrt(re * re + im * im) / {n}.0 *
    cos(2 * pi() * k / {n - 1}.0 * d + atan2(im, re))) + any_value(slope) * d) AS y
  FROM spec s JOIN fit USING (title), (SELECT unnest(range({first}, {last + 1})) AS d) GROUP BY s.title, d)"""


@query(
    "X14_forecast",
    with_(
        AD_DAYS, DAILY, _dft(N), _restored(N, N - 6, N + 7),
        """sides AS (SELECT title, avg(CASE WHEN d <= 180 THEN y END) AS l7, avg(CASE WHEN d > 180 THEN y END) AS f7 FROM restored GROUP BY 1)""",
        select="""SELECT title, round(l7, 3) AS revenue_l7, round(f7, 3) AS revenue_f7,
  round(CASE WHEN l7 = 0 THEN 0.0 ELSE (f7 - l7) / l7 * 100 END, 3) AS grow_rate FROM sides""",
    ),
)
def revenue_growth(spark, sf):
    rows = forecast.forecast(revenue(spark, sf), KEYS, "revenue", START, END)
    return rows.withColumns({c: F.round(c, 3) for c in ("revenue_l7", "revenue_f7", "grow_rate")})


@query(
    "X14_forecast_days",
    with_(
        AD_DAYS, DAILY, _dft(N), _restored(N, N + 1, N + 7),
        select="SELECT title, strftime(DATE '1998-06-29' + CAST(d - 180 AS INTEGER), '%Y-%m-%d') AS date, round(y, 3) AS predicted FROM restored",
    ),
)
def forecast_days(spark, sf):
    rows = forecast.forecast_days(revenue(spark, sf), KEYS, "revenue", START, END)
    return rows.select("title", F.date_format("date", "yyyy-MM-dd").alias("date"), F.round("predicted", 3).alias("predicted"))


@query(
    "X15_backtest",
    with_(
        AD_DAYS, DAILY, "known AS (SELECT * FROM padded WHERE t <= 150)", _dft(150, "known"), _restored(150, 151, 180),
        select="""SELECT r.title, round(avg(abs(y - v)), 3) AS mae FROM restored r JOIN padded p ON p.title = r.title AND p.t = r.d
  WHERE r.title IN (SELECT title FROM daily WHERE date <= DATE '1998-05-30') GROUP BY 1""",
    ),
)
def backtest(spark, sf):
    return forecast.backtest(revenue(spark, sf), KEYS, "revenue", START, END, 30).withColumn("mae", F.round("mae", 3))


@query(
    "X16_power_spectrum",
    with_(
        AD_DAYS, DAILY, _dft(N, trend=False),
        select="SELECT title, CAST(k AS INTEGER) AS k, round(k / 179.0, 6) AS freq, round(sqrt((re * re + im * im) / 180.0), 2) AS root_psd FROM spec",
    ),
)
def power_spectrum(spark, sf):
    rows = forecast.power_spectrum(revenue(spark, sf), KEYS, "revenue", START, END)
    return rows.select("title", "k", F.round("freq", 6).alias("freq"), F.round(F.sqrt("psd"), 2).alias("root_psd"))


def outlook_sql(rows, items):
    """Sixty-day forecast per tenant and title from the ``rows`` of the ads, with the ids of ``items``."""
    return with_(
        AD_DAYS,
        f"""daily AS (SELECT web_id || '|' || title AS title, date, sum(cents // 100) AS v FROM ad_days
  WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-03-01' AND {rows} GROUP BY 1, 2),
padded AS (SELECT t.title, c.t, CAST(COALESCE(d.v, 0) AS DOUBLE) AS v FROM (SELECT DISTINCT title FROM daily) t
  CROSS JOIN (SELECT CAST(unnest(range(1, 61)) AS INTEGER) AS t) c
  LEFT JOIN daily d ON d.title = t.title AND d.date = DATE '1998-01-01' + (c.t - 1))""",
        _dft(60), _restored(60, 54, 67),
        "sides AS (SELECT title, avg(CASE WHEN d <= 60 THEN y END) AS l7, avg(CASE WHEN d > 60 THEN y END) AS f7 FROM restored GROUP BY 1)",
        f"items AS (SELECT p_name AS title, min(CAST(p_partkey AS VARCHAR)) AS product_id FROM part WHERE {items} GROUP BY 1)",
        select="""SELECT split_part(s.title, '|', 1) AS web_id, split_part(s.title, '|', 2) AS title, product_id, round(l7, 3) AS revenue_l7,
  round(f7, 3) AS revenue_f7, '1998-03-01' AS date FROM sides s JOIN items i ON i.title = split_part(s.title, '|', 2)""",
    )


@query("X14_revenue_forecast", outlook_sql("TRUE", "p_size > 45"))
def revenue_forecast(spark, sf):
    items = table(spark, sf, "part").where(F.col("p_size") > 45)
    items = items.select(F.col("p_name").alias("title"), F.col("p_partkey").cast("string").alias("product_id"))
    return outlook_columns(forecast.revenue_forecast(revenue(spark, sf).drop("product_id"), items, START, dt.date(1998, 3, 1)))


def outlook_columns(rows):
    return rows.select(
        "web_id", "title", "product_id", F.round("revenue_l7", 3).alias("revenue_l7"), F.round("revenue_f7", 3).alias("revenue_f7"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
    )


@query(
    "W14_best_day",
    with_(
        AD_DAYS,
        "daily AS (SELECT title, date, sum(cents // 100) AS v FROM ad_days GROUP BY 1, 2)",
        select="""SELECT title, strftime(date, '%Y-%m-%d') AS date, CAST(v AS BIGINT) AS revenue FROM (SELECT *, row_number() OVER
  (PARTITION BY title ORDER BY v DESC, date) AS rk FROM daily) WHERE rk = 1""",
    ),
)
def best_day(spark, sf):
    daily = revenue(spark, sf).groupBy("title", "date").agg(F.sum("revenue").alias("revenue"))
    best = keep_first(daily, ["title"], [F.desc("revenue"), F.asc("date")])
    return best.select("title", F.date_format("date", "yyyy-MM-dd").alias("date"), "revenue")
