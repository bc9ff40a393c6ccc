"""SQL for small linear systems and for the period-by-period forecast.

Only the oracle side uses this: normal equations are solved by elimination,
the forecast by a recursive query.
"""

from __future__ import annotations


def moments_sql(features: list[str], target: str, over: str = "", alpha: float = 0.0) -> str:
    """Select list: means and centred sums of features and target."""
    n = f"count(*){over}"
    cols = [f"{n} AS n", f"avg({target}){over} AS my"]
    for i, f in enumerate(features, 1):
        cols.append(f"avg({f}){over} AS m_{i}")
        cols.append(f"covar_pop({f}, {target}){over} * {n} AS b_{i}")
        for j in range(i, len(features) + 1):
            extra = f" + {alpha}" if i == j and alpha else ""
            cols.append(f"covar_pop({f}, {features[j - 1]}){over} * {n}{extra} AS a_{i}_{j}")
    return ", ".join(cols)


def solve_sql(name: str, source: str, size: int) -> str:
    """CTEs that end in ``name``: all columns of ``source`` plus x_1..x_n."""
    ctes, prev = [], source
    for k in range(1, size):
        changed = []
        for i in range(k + 1, size + 1):
            factor = f"a_{k}_{i} / a_{k}_{k}"
            changed.append(f"b_{i} - b_{k} * {factor} AS b_{i}")
            changed += [f"a_{i}_{j} - a_{k}_{j} * {factor} AS a_{i}_{j}" for j in range(i, size + 1)]
        step = f"{name}_e{k}"
        ctes.append(f"{step} AS (SELECT * REPLACE ({', '.join(changed)}) FROM {prev})")
        prev = step
    for i in range(size, 0, -1):
        known = "".join(f" - a_{i}_{j} * x_{j}" for j in range(i + 1, size + 1))
        step = name if i == 1 else f"{name}_x{i}"
        ctes.append(f"{step} AS (SELECT *, (b_{i}{known}) / a_{i}_{i} AS x_{i} FROM {prev})")
        prev = step
    return ",\n".join(ctes)


def fit_sql(name: str, source: str, key: str, features: list[str], target: str = "population", alpha: float = 0.0) -> str:
    """CTEs that end in ``name``(key, x_1.., x0): slopes and intercept per key."""
    size = len(features)
    intercept = "my" + "".join(f" - x_{i} * m_{i}" for i in range(1, size + 1))
    return (
        f"{name}_m AS (SELECT {key}, {moments_sql(features, target, alpha=alpha)} FROM {source} GROUP BY 1),\n"
        + solve_sql(f"{name}_s", f"{name}_m", size)
        + f",\n{name} AS (SELECT *, {intercept} AS x0 FROM {name}_s)"
    )


def score_sql(features: list[str], prefix: str = "") -> str:
    return f"{prefix}x0" + "".join(f" + {prefix}x_{i} * {f}" for i, f in enumerate(features, 1))


LINEAR = ["x0", "x_1", "x_2", "x_3", "x_4"]
LINEAR_LEVEL = "x0 + x_1 * coalesce(l1, 0.0) + x_2 * coalesce(l5, 0.0) + x_3 * u2 + x_4 * c2"


def stump_sql(name: str, source: str, key: str, features: list[str], rounds: int, rate: float, target: str = "population") -> str:
    """CTEs that end in ``name``(key, x0, f_1, t_1, a_1, b_1, f_2, ..): boosted trees of one split.

    Tree k gives a_k where feature number f_k is below t_k, else b_k; f_k is NULL if nothing splits.
    """
    ctes = [f"{name}_r0 AS (SELECT *, avg({target}) OVER (PARTITION BY {key}) AS x0, {target} - avg({target}) OVER (PARTITION BY {key}) AS r FROM {source})"]
    values = f"[{', '.join(features)}]"
    for k in range(1, rounds + 1):
        ctes += [
            f"""{name}_v{k} AS (
  SELECT {key}, f, v, sum(r) AS s, count(*) AS n
  FROM (SELECT {key}, unnest(range(1, {len(features) + 1})) AS f, unnest({values}) AS v, r FROM {name}_r{k - 1}) GROUP BY ALL)""",
            f"""{name}_c{k} AS (
  SELECT *, sl * sl / (nl + 1) + (st - sl) * (st - sl) / (nt - nl + 1) - st * st / (nt + 1) AS gain
  FROM (SELECT {key}, f, v, sum(s) OVER w AS sl, sum(n) OVER w AS nl, sum(s) OVER p AS st, sum(n) OVER p AS nt, lead(v) OVER w AS nv
        FROM {name}_v{k} WINDOW w AS (PARTITION BY {key}, f ORDER BY v), p AS (PARTITION BY {key}, f)))""",
            f"""{name}_b{k} AS (
  SELECT {key}, CASE WHEN cut THEN f END AS f_{k}, CASE WHEN cut THEN v + (nv - v) / 2 END AS t_{k},
         {rate} * CASE WHEN cut THEN sl / (nl + 1) ELSE st / (nt + 1) END AS a_{k},
         {rate} * CASE WHEN cut THEN (st - sl) / (nt - nl + 1) ELSE st / (nt + 1) END AS b_{k}
  FROM (SELECT *, nv IS NOT NULL AND gain > 1e-6 AS cut, max(gain) FILTER (WHERE nv IS NOT NULL) OVER (PARTITION BY {key}) AS most FROM {name}_c{k})
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY nv IS NULL, round(gain / most, 9) DESC, f, v) = 1)""",
            f"""{name}_r{k} AS (
  SELECT q.* REPLACE (r - CASE WHEN {values}[f_{k}] < t_{k} THEN a_{k} ELSE b_{k} END AS r), f_{k}, t_{k}, a_{k}, b_{k}
  FROM {name}_r{k - 1} q JOIN {name}_b{k} USING ({key}))""",
        ]
    columns = ", ".join(["x0", *stump_columns(rounds)])
    return ",\n".join(ctes) + f",\n{name} AS (SELECT DISTINCT {key}, {columns} FROM {name}_r{rounds})"


def stump_columns(rounds: int) -> list[str]:
    return [f"{c}_{k}" for k in range(1, rounds + 1) for c in "ftab"]


def stump_score(values: str, rounds: int) -> str:
    """Prediction from a list of feature values and the columns of :func:`stump_sql`."""
    return "x0" + "".join(f" + CASE WHEN {values}[f_{k}] < t_{k} THEN a_{k} ELSE b_{k} END" for k in range(1, rounds + 1))


def roll_sql(
    name: str, history: str, coefs: str, key: str, period: str, until: str, columns: list[str] = LINEAR, score: str = LINEAR_LEVEL
) -> str:
    """Recursive CTE ``name`` with one row per key and future period.

    ``coefs`` has the given columns, of which ``score`` makes the model's level from lag1,
    lag5, rate and index (l1, l5, u2, c2); ``until`` is the last period, in terms of the
    start row's columns.
    """
    model = ", ".join(columns)
    return f"""{name}_h AS (
  SELECT {key}, CAST(max({period}) AS INTEGER) AS t0, list_slice(list(population ORDER BY {period}), -6, -1) AS lv,
         list_slice(list(CAST({period} AS INTEGER) ORDER BY {period}), -6, -1) AS pv,
         list_slice(list(rent_cpi_index ORDER BY {period}), -6, -1) AS ix, max_by(unemployment_rate, {period}) AS u
  FROM {history} GROUP BY 1
),
{name}_r AS (
  SELECT {key}, t0, t0 AS t, CAST({until} AS INTEGER) AS stop, {model}, lv, pv, ix, u,
         CAST(NULL AS DOUBLE) AS yhat, CAST(NULL AS DOUBLE) AS lag1, CAST(NULL AS DOUBLE) AS lag5
  FROM {name}_h JOIN {coefs} USING ({key})
  UNION ALL
  SELECT {key}, t0, CAST(t + 1 AS INTEGER), stop, {model}, list_slice(list_append(lv, yh), -6, -1),
         list_slice(list_append(pv, CAST(t + 1 AS INTEGER)), -6, -1), list_slice(list_append(ix, c2), -6, -1), u2, yh, l1, l5
  FROM (
    SELECT *, CASE WHEN l1 > 0 AND sd > 0 THEN l1 + least(dm + 2.0 * sd, greatest(dm - 2.0 * sd, blend - l1))
                   WHEN l1 > 0 THEN greatest(l1 * 0.95, least(l1 * 1.05, blend)) ELSE level END AS yh
    FROM (
      SELECT *, 0.7 * level + 0.3 * l1 * (1.0 + g) AS blend
      FROM (
        SELECT *, {score} AS level
        FROM (
          SELECT *, greatest(2.0, least(15.0, 4.5 + (u - 4.5) * 0.5)) AS u2, ix[-1] * (1.0 + 0.6 * ig + 0.4 * 0.025) AS c2,
                 coalesce(list_avg(ds), 0.0) AS dm, coalesce(list_stddev_pop(ds), 0.0) AS sd
          FROM (
            SELECT *, lv[list_position(pv, t)] AS l1, lv[list_position(pv, CAST(t - 4 AS INTEGER))] AS l5,
                   CASE WHEN len(lv) > 1 THEN pow(lv[-1] / lv[1], 1.0 / (len(lv) - 1)) - 1.0 ELSE 0.0 END AS g,
                   CASE WHEN len(ix) > 1 THEN pow(ix[-1] / ix[1], 1.0 / (len(ix) - 1)) - 1.0 ELSE 0.025 END AS ig,
                   list_transform(range(1, len(lv)), lambda i: lv[i + 1] - lv[i]) AS ds
            FROM {name}_r WHERE t < stop)))))
),
{name} AS (
  SELECT {key}, t AS {period}, yhat, u AS unemployment_rate, ix[-1] AS rent_cpi_index,
         coalesce(lag1, 0.0) AS pop_lag1, coalesce(lag5, 0.0) AS pop_lag5
  FROM {name}_r WHERE t > t0
)"""


def _unit_sql(kind: int, draws: int, events: int) -> str:
    """(draw, event, u): the fixed numbers of one kind, by whole-number arithmetic."""
    turned = f"SELECT d, i, (d * 1000003 + i * 7919 + {kind} * 104729 + 1) % 2147483647 AS x FROM range({draws}) a(d), range({events}) b(i)"
    for _ in range(3):
        turned = f"SELECT d, i, (x * x + 48271 * x + 11) % 2147483647 AS x FROM ({turned})"
    return f"(SELECT d, i, (x + 0.5) / 2147483647 AS u FROM ({turned}))"


def one_bend_sql(name: str, rows: str, first: int, last: int, draws: int = 1000, events: int = 256) -> str:
    """Trend of population with one changepoint, its most probable slope and bend, and simulated intervals.

    With a single bend the fit has a closed form for a given noise level; a recursion
    alternates the two until they agree.
    """
    return f"""{name}_s AS (
  SELECT entity, period, CAST(population AS DOUBLE) AS v, row_number() OVER (PARTITION BY entity ORDER BY period) - 1 AS rk,
         count(*) OVER e * 4 // 5 AS early, min(period) OVER e AS t0, greatest(max(period) OVER e - min(period) OVER e, 1) AS span,
         max(abs(population)) OVER e AS top
  FROM {rows} WHERE population IS NOT NULL WINDOW e AS (PARTITION BY entity)
),
{name}_t AS (
  SELECT *, (period - t0) / CAST(span AS DOUBLE) AS t, v / top AS y,
         min(CASE WHEN early >= 2 AND rk = early - 1 THEN (period - t0) / CAST(span AS DOUBLE) END) OVER (PARTITION BY entity) AS knot
  FROM {name}_s
),
{name}_h AS (SELECT *, CASE WHEN t > knot THEN t - knot ELSE 0.0 END AS h FROM {name}_t),
{name}_m AS (
  SELECT entity, count(*) AS n, any_value(t0) AS t0, any_value(span) AS span, any_value(top) AS top, any_value(knot) AS knot,
         avg(t) AS mt, avg(h) AS mh, avg(y) AS my, covar_pop(t, t) * count(*) AS tt, covar_pop(t, h) * count(*) AS th,
         covar_pop(h, h) * count(*) AS hh, covar_pop(t, y) * count(*) AS ty, covar_pop(h, y) * count(*) AS hy,
         covar_pop(y, y) * count(*) AS yy
  FROM {name}_h GROUP BY 1
),
{name}_r AS (
  SELECT entity, 0 AS step, CAST(1.0 AS DOUBLE) AS v, CAST(0.0 AS DOUBLE) AS d, CAST(0.0 AS DOUBLE) AS k FROM {name}_m
  UNION ALL
  SELECT entity, step + 1, greatest(1e-8, 2 * sse / (n + sqrt(n * n + 16 * sse))), d, k
  FROM (
    SELECT *, greatest(0.0, yy - 2 * (k * ty + d * hy) + k * k * tt + 2 * k * d * th + d * d * hh) AS sse
    FROM (
      SELECT *, (ty - th * d) / (tt + v / 25) AS k
      FROM (
        SELECT entity, step, v, n, tt, th, hh, ty, hy, yy,
               CASE WHEN step > 0 AND hh - th * th / (tt + v / 25) > 1e-12 * n
                    THEN sign(hy - th * ty / (tt + v / 25)) * greatest(0.0, abs(hy - th * ty / (tt + v / 25)) - v / 0.05)
                         / (hh - th * th / (tt + v / 25)) ELSE 0.0 END AS d
        FROM {name}_r JOIN {name}_m USING (entity) WHERE step < 150
      )
    )
  )
),
{name}_f AS (
  SELECT entity, t0, span, top, knot, k, d, my - k * mt - d * mh AS level, sqrt(v) * top AS noise
  FROM {name}_r JOIN {name}_m USING (entity) WHERE step = 150
),
{name}_e AS (
  SELECT g.d AS draw, sum(-ln(g.u)) OVER (PARTITION BY g.d ORDER BY g.i) AS w,
         -ln(s.u) * CASE WHEN o.u < 0.5 THEN -1 ELSE 1 END AS size
  FROM {_unit_sql(3, draws, events)} g JOIN {_unit_sql(4, draws, events)} s USING (d, i) JOIN {_unit_sql(5, draws, events)} o USING (d, i)
),
{name}_z AS (
  SELECT p.d AS draw, sqrt(-2 * ln(p.u)) * cos(2 * pi() * q.u) AS z
  FROM {_unit_sql(1, draws, 1)} p JOIN {_unit_sql(2, draws, 1)} q USING (d, i)
),
{name}_p AS (
  SELECT *, top * (level + k * t + d * CASE WHEN t > knot THEN t - knot ELSE 0.0 END) AS yhat, t > 1 AND d <> 0 AS ahead
  FROM (SELECT *, (period - t0) / CAST(span AS DOUBLE) AS t
        FROM {name}_f, (SELECT CAST(unnest(range({first}, {last + 1})) AS INTEGER) AS period) s)
),
{name}_c AS (
  SELECT entity, period, draw, sum(size * (t - 1 - w)) AS bent
  FROM {name}_p JOIN {name}_e ON w < t - 1 WHERE ahead GROUP BY 1, 2, 3
),
{name}_q AS (
  SELECT entity, period, quantile_cont(abs(d) * top * coalesce(bent, 0) + noise * z, [0.1, 0.9]) AS q
  FROM {name}_p CROSS JOIN {name}_z LEFT JOIN {name}_c USING (entity, period, draw) WHERE ahead GROUP BY 1, 2
),
{name} AS (
  SELECT entity, period, yhat, yhat + coalesce(q[1], -1.2816 * noise) AS yhat_lo, yhat + coalesce(q[2], 1.2816 * noise) AS yhat_hi
  FROM {name}_p LEFT JOIN {name}_q USING (entity, period)
)"""
