"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = "") -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the body below the common table expressions."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = f"WITH RECURSIVE {COMMON}{ctes}\n{sql.strip()}"
        return fn

    return add


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def r(expr: str, digits: int, name: str | None = None) -> str:
    """Rounded SQL expression without a negative zero."""
    return f"round({expr}, {digits}) + 0.0" + (f" AS {name}" if name else "")


COMMON = """
oc AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_orderdate, o.o_totalprice,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS price,
         CAST(year(o.o_orderdate) AS INTEGER) AS yr, CAST(month(o.o_orderdate) AS INTEGER) AS mon,
         c.c_nationkey, lpad(CAST(c.c_nationkey + 1 AS VARCHAR), 2, '0') AS st,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN '001' WHEN 'BUILDING' THEN '002' WHEN 'FURNITURE' THEN '003'
                             WHEN 'HOUSEHOLD' THEN '004' WHEN 'MACHINERY' THEN '005' END AS seg
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
),
ln AS (
  SELECT l_orderkey, sum(CAST(l_discount AS DECIMAL(18,2))) AS disc,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS ext, count(*) AS cnt
  FROM lineitem GROUP BY 1
),
ol AS (SELECT * FROM oc JOIN ln ON ln.l_orderkey = oc.o_orderkey),
fx_pop AS (
  SELECT geo_code, yr AS year, CAST(floor(sum(price)) AS BIGINT) AS population
  FROM (SELECT unnest(['US', st, st || seg]) AS geo_code, yr, price FROM oc) GROUP BY 1, 2
),
ltot AS (
  SELECT geo_code, yr AS year, sum(disc) AS disc, sum(ext) AS ext, sum(cnt) AS cnt
  FROM (SELECT unnest(['US', st, st || seg]) AS geo_code, yr, disc, ext, cnt FROM ol) GROUP BY 1, 2
),
fx_rate AS (
  SELECT geo_code, year, 'BLS_UNRATE' AS indicator_code, round(CAST(disc AS DOUBLE) / cnt * 100.0, 4) AS value FROM ltot
),
fx_cpi AS (
  SELECT geo_code, yr AS year, 'CPI_SHELTER' AS indicator_code,
         round(CAST(sum(price) AS DOUBLE) / count(*) / 1000.0, 4) AS value
  FROM (SELECT unnest(['US', CASE WHEN n_regionkey < 4 THEN 'R' || CAST(n_regionkey + 1 AS VARCHAR) END]) AS geo_code,
               yr, price
        FROM oc JOIN nation ON n_nationkey = c_nationkey)
  WHERE geo_code IS NOT NULL GROUP BY 1, 2
),
fx_region AS (
  SELECT lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') AS prefix,
         CASE WHEN n_regionkey < 4 THEN 'R' || CAST(n_regionkey + 1 AS VARCHAR) END AS region
  FROM nation
),
fx_survey AS (
  SELECT geo_code, 'Area ' || geo_code AS geo_name,
         CASE WHEN geo_code = 'US' THEN 'nation' WHEN length(geo_code) = 2 THEN 'state' ELSE 'county' END AS geo_type,
         year, source, population
  FROM (
    SELECT geo_code, year, population, 'ACS1' AS source FROM fx_pop
    WHERE length(geo_code) = 2 OR (CAST(substr(geo_code, 1, 2) AS INTEGER) - 1) % 2 = 0
    UNION ALL
    SELECT geo_code, year, CAST(floor(ext) AS BIGINT), 'ACS5' FROM ltot
  )
),
fx_ind AS (
  SELECT geo_code, year, source || '_TOTAL_POP' AS indicator_code, CAST(population AS DOUBLE) AS value,
         source, 'count' AS unit, 'batch_1' AS etl_batch_id FROM fx_survey
  UNION ALL SELECT *, 'BLS', 'percent', 'batch_1' FROM fx_rate
  UNION ALL SELECT *, 'FRED', 'index', 'batch_1' FROM fx_cpi
),
fx_geo AS (
  SELECT 'US' AS geo_code, 'United States' AS geo_name, 'nation' AS geo_type
  UNION ALL SELECT 'R' || CAST(r_regionkey + 1 AS VARCHAR), r_name, 'region' FROM region
  UNION ALL SELECT lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0'), n_name, 'state' FROM nation
  UNION ALL SELECT lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') || code, n_name || ' ' || name, 'county'
  FROM nation, (VALUES ('AUTOMOBILE', '001'), ('BUILDING', '002'), ('FURNITURE', '003'),
                       ('HOUSEHOLD', '004'), ('MACHINERY', '005')) AS s(name, code)
),
walk AS (
  SELECT geo_code, unnest(years) AS year, generate_subscripts(years, 1) AS i, levels
  FROM (SELECT geo_code, list(year ORDER BY year) AS years, list(CAST(population AS DOUBLE) ORDER BY year) AS levels FROM fx_pop GROUP BY 1)
),
level AS (
  SELECT geo_code, year, levels[i] AS population, CASE WHEN i > 1 THEN levels[i - 1] END AS pop_lag1,
         CASE WHEN i > 5 THEN levels[i - 5] END AS pop_lag5, list_avg(levels[greatest(1, i - 2):i]) AS pop_ma3
  FROM walk
),
offered AS (
  SELECT p.geo_code, p.year, r.region, c.geo_code AS place, c.value,
         list_position([p.geo_code, r.region, 'US'], c.geo_code) AS choice
  FROM fx_pop p LEFT JOIN fx_region r ON starts_with(p.geo_code, r.prefix)
  JOIN fx_cpi c ON c.year = p.year AND list_contains([p.geo_code, r.region, 'US'], c.geo_code)
),
price AS (
  SELECT geo_code, year, max(value) FILTER (WHERE place = geo_code) AS own_index, max(value) FILTER (WHERE place = region) AS region_index,
         max(value) FILTER (WHERE place = 'US') AS nation_index, min_by(value, choice) AS rent_cpi_index
  FROM offered GROUP BY 1, 2
),
joined AS (
  SELECT level.*, (population - pop_lag1) * 100.0 / nullif(pop_lag1, 0) AS pop_yoy_growth_pct,
         (pow(population / nullif(pop_lag5, 0), 0.2) - 1.0) * 100.0 AS pop_cagr_5yr_pct,
         fx_rate.value AS unemployment_rate, own_index, region_index, nation_index, rent_cpi_index
  FROM level LEFT JOIN fx_rate USING (geo_code, year) LEFT JOIN price USING (geo_code, year)
),
flagged AS (
  SELECT *, (population + pop_lag1 + pop_lag5 + pop_ma3 + pop_yoy_growth_pct + pop_cagr_5yr_pct + unemployment_rate + rent_cpi_index)
            IS NOT NULL AS has_full_features
  FROM joined
),
cutins AS (SELECT geo_code, min(CASE WHEN has_full_features THEN year END) AS first_full_year FROM flagged GROUP BY 1),
matrix AS (
  SELECT geo_code, year, population, pop_lag1, pop_lag5, pop_ma3, pop_yoy_growth_pct, pop_cagr_5yr_pct,
         unemployment_rate, rent_cpi_index, has_full_features
  FROM flagged WHERE has_full_features AND year >= 1996
),
mpanel AS (
  SELECT c_nationkey AS entity, CAST(yr * 12 + mon AS INTEGER) AS period, CAST(sum(price) AS DOUBLE) AS value
  FROM oc GROUP BY 1, 2
),
mhist AS (
  SELECT c_nationkey AS entity, CAST(yr * 12 + mon AS INTEGER) AS period, CAST(sum(price) AS DOUBLE) AS population,
         CAST(sum(disc) AS DOUBLE) / sum(cnt) * 100.0 AS unemployment_rate,
         CAST(sum(price) AS DOUBLE) / count(*) / 1000.0 AS rent_cpi_index
  FROM ol GROUP BY 1, 2
),
mfeat AS (
  SELECT * FROM (
    SELECT *, lag(population, 1) OVER w AS pop_lag1, lag(population, 5) OVER w AS pop_lag5
    FROM mhist WINDOW w AS (PARTITION BY entity ORDER BY period))
  WHERE pop_lag1 IS NOT NULL AND pop_lag5 IS NOT NULL
),
mnum AS (
  SELECT c_nationkey, yr AS year, mon AS month, CAST(floor(sum(price) / 1000) AS BIGINT) % 90
         + CASE WHEN c_nationkey % 6 = 0 AND yr % 3 = 0 THEN 60 ELSE 0 END AS number
  FROM oc GROUP BY 1, 2, 3
),
mpoints AS (
  SELECT CASE WHEN c_nationkey % 12 = 11 THEN 'XXXXX' ELSE 'LASST' END
           || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') || '0000000000003' AS series_id, year, period, value
  FROM (
    SELECT c_nationkey, year, 'M' || lpad(CAST(month AS VARCHAR), 2, '0') AS period,
           CASE WHEN month = 2 AND c_nationkey % 5 = 0 THEN '.' ELSE CAST(number AS VARCHAR) END AS value
    FROM mnum
    UNION ALL
    SELECT c_nationkey, year, 'M13', CAST(CAST(sum(number) AS BIGINT) // count(*) AS VARCHAR)
    FROM mnum WHERE c_nationkey % 2 = 0 GROUP BY 1, 2
  )
),
yearly AS (
  SELECT series_id, year, max(period = 'M13') AS published,
         max(TRY_CAST(nullif(value, '.') AS DOUBLE)) FILTER (WHERE period = 'M13') AS annual_value,
         avg(TRY_CAST(nullif(value, '.') AS DOUBLE)) AS mean_value,
         max(max(period = 'M13')) OVER (PARTITION BY series_id) AS has_annual
  FROM mpoints GROUP BY 1, 2
),
annual AS (
  SELECT series_id, year, CASE WHEN has_annual THEN annual_value ELSE mean_value END AS value
  FROM yearly WHERE NOT has_annual OR published
),
obs AS (
  SELECT series_id, make_date(year, month, 1) AS obs_date,
         CASE WHEN month = 4 THEN '.' ELSE CAST(total // 100 AS VARCHAR) END AS raw_value
  FROM (
    SELECT series_id, yr AS year, mon AS month, sum(CAST(price * 100 AS BIGINT)) // count(*) AS total
    FROM (SELECT unnest(['CUUR0000SAH1', CASE WHEN n_regionkey < 4 THEN 'CUUR0' || CAST(n_regionkey + 1 AS VARCHAR) || '00SAH1'
                                              ELSE 'OTHER' END]) AS series_id, yr, mon, price
          FROM oc JOIN nation ON n_nationkey = c_nationkey)
    GROUP BY 1, 2, 3)
),
fx_runs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, st AS geo_code, o_orderpriority AS model,
         md5(CAST(o_orderkey AS VARCHAR)) AS data_hash, o_orderdate AS trained_at, o_custkey AS rows,
         yr - 5 AS year_min, yr AS year_max, 'models/' || CAST(o_orderkey AS VARCHAR) AS artifact_path
  FROM oc
),
fx_metrics AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, 'rmse' AS metric, 'test' AS scope, -1 AS fold,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS value FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'mae', 'test', -1, o_totalprice / 2 FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'r2', 'test', -1, o_custkey / 1e6 FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'rmse', 'train', -1, o_totalprice / 4 FROM orders
),
headline AS (
  SELECT run_id, max(value) FILTER (WHERE metric = 'r2' AND scope = 'test') AS r2_test,
         min(value) FILTER (WHERE metric = 'rmse' AND scope = 'test') AS rmse_test,
         min(value) FILTER (WHERE metric = 'mae' AND scope = 'test') AS mae_test
  FROM fx_metrics GROUP BY 1
),
scored AS (
  SELECT r.geo_code, r.model, r.run_id, r.trained_at, h.rmse_test, h.mae_test, h.r2_test
  FROM fx_runs r LEFT JOIN headline h USING (run_id)
),
card AS (
  SELECT *, row_number() OVER (PARTITION BY geo_code ORDER BY rmse_test ASC NULLS LAST, trained_at DESC, run_id)
              AS rank_within_geo_code
  FROM (SELECT *, row_number() OVER (PARTITION BY geo_code, model ORDER BY trained_at DESC, run_id DESC) AS rn FROM scored)
  WHERE rn = 1
),
fx_rows AS (
  SELECT o_orderkey AS key, o_custkey AS cust, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS value,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, o_orderpriority AS source
  FROM orders
)"""
