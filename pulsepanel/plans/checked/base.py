"""Registration of queries and the SQL building blocks of their checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Checked:
    build: Build
    sql: str | None


REGISTRY: dict[str, Checked] = {}


# Decimal places compared: results of iterated solves agree to fewer.
PLACES = {"f": 6, "r": 4}


def _columns(spec: str) -> list[tuple[str, str]]:
    """'region date new_tests:f n:i' -> [(name, kind)]; f and r are rounded, i is a bigint."""
    out = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        out.append((name, kind))
    return out


def _spark_output(df: DataFrame, spec: str) -> DataFrame:
    picked = []
    for name, kind in _columns(spec):
        c = F.col(f"`{name}`")
        if kind in ("f", "r"):
            c = F.round(c.cast("double"), PLACES[kind]) + F.lit(0.0)
        elif kind == "i":
            c = c.cast("bigint")
        picked.append(c.alias(name))
    return df.select(picked)


def _sql_output(body: str, spec: str) -> str:
    picked = []
    for name, kind in _columns(spec):
        c = f'"{name}"'
        if kind in ("f", "r"):
            c = f"round(CAST({c} AS DOUBLE), {PLACES[kind]}) + 0.0"
        elif kind == "i":
            c = f"CAST({c} AS BIGINT)"
        picked.append(f'{c} AS "{name}"')
    return f"SELECT {', '.join(picked)} FROM ({body}) AS result"


def query(name: str, spec: str, sql: str | None = None):
    """Register a query; both sides end in the same columns, floats rounded to six places."""

    def register(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"Query {name} is registered twice.")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _spark_output(build(spark, sf_dir), spec)

        REGISTRY[name] = Checked(run, None if sql is None else _sql_output(sql, spec))
        return build

    return register


# --- SQL building blocks -----------------------------------------------------------------

PE = """pe AS (
  SELECT 'R' || CAST(user_id % 5 AS VARCHAR) AS region, CAST(ts AS DATE) AS date,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) AS new_cases,
         CAST(count(*) AS DOUBLE) AS new_tests,
         CAST(count(*) FILTER (WHERE event_type = 'signup') AS DOUBLE) AS new_deaths
  FROM events GROUP BY 1, 2)"""

PU = """pu AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS region, CAST(ts AS DATE) AS date,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) AS new_cases,
         CAST(count(*) AS DOUBLE) AS new_tests,
         CAST(count(*) FILTER (WHERE event_type = 'signup') AS DOUBLE) AS new_deaths
  FROM events GROUP BY 1, 2)"""

PO = """po AS (
  SELECT r_name AS region, CAST(o_orderdate AS DATE) AS date,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS new_cases,
         CAST(count(*) AS DOUBLE) AS new_tests
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2)"""

PN = """pn AS (
  SELECT c_nationkey AS nationkey, CAST(o_orderdate AS DATE) AS date,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS new_cases,
         CAST(count(*) AS DOUBLE) AS new_tests
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""

# test counts missing on every fifth day of the month
MASKED = """masked AS (
  SELECT region, date, new_cases,
         CASE WHEN day(date) % 5 = 0 THEN NULL ELSE new_tests END AS new_tests FROM pe)"""

MASKED_USERS = """masked AS (
  SELECT region, date, new_cases,
         CASE WHEN day(date) % 5 = 0 THEN NULL ELSE new_tests END AS new_tests FROM pu)"""


def with_sql(*parts: str) -> str:
    """CTEs and a final SELECT."""
    *ctes, body = parts
    recursive = any("UNION ALL" in c and "RECURSIVE" in c for c in ctes)
    ctes = [c.replace("/*RECURSIVE*/", "") for c in ctes]
    head = "WITH RECURSIVE" if recursive else "WITH"
    return f"{head} {', '.join(ctes)} {body}"


def sql_all(src: str, out: str, columns: str = "new_cases new_tests") -> str:
    """Panel plus national rows."""
    cols = columns.split()
    sums = ", ".join(f"sum({c}) AS {c}" for c in cols)
    return (
        f"{out} AS (SELECT region, date, {', '.join(cols)} FROM {src} UNION ALL "
        f"SELECT 'all', date, {sums} FROM {src} GROUP BY date)"
    )


def sql_dense(src: str, out: str, columns: str, trail: int = 0, lead: int = 0) -> str:
    """Gap-free calendar per region by joining generated days."""
    cols = ", ".join(f"p.{c}" for c in columns.split())
    return (
        f"{out} AS (SELECT g.region, g.date, {cols} FROM (SELECT region, CAST(unnest(generate_series("
        f"min(date) - INTERVAL {lead} DAY, max(date) + INTERVAL {trail} DAY, INTERVAL 1 DAY)) AS DATE) AS date "
        f"FROM {src} GROUP BY region) AS g LEFT JOIN {src} AS p ON p.region = g.region AND p.date = g.date)"
    )


def sql_interpolate(src: str, out: str, c: str) -> str:
    up = "OVER (PARTITION BY region ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    down = "OVER (PARTITION BY region ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"""{out} AS (
  SELECT * EXCLUDE (_p, _lv, _lp, _rv, _rp) REPLACE (
    CASE WHEN {c} IS NOT NULL THEN {c} WHEN _rv IS NULL THEN _lv
         WHEN _lv IS NOT NULL THEN _lv + (_rv - _lv) * (_p - _lp) / (_rp - _lp) END AS {c})
  FROM (SELECT *,
      last_value({c} IGNORE NULLS) {up} AS _lv,
      last_value(CASE WHEN {c} IS NOT NULL THEN _p END IGNORE NULLS) {up} AS _lp,
      first_value({c} IGNORE NULLS) {down} AS _rv,
      first_value(CASE WHEN {c} IS NOT NULL THEN _p END IGNORE NULLS) {down} AS _rp
    FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY date) AS _p FROM {src}) AS a) AS b)"""


def sql_fit(
    src: str,
    out: str,
    *,
    ignore_before: str | None = "2020-03-15",
    more_than: int = 10,
    segment_days: int | None = None,
    holiday: bool = False,
    column: str = "new_tests",
) -> str:
    """Trend x weekday x holiday fit by grouped aggregates joined back to the days."""
    start = f"greatest(DATE '{ignore_before}', _first)" if ignore_before else "_first"
    parts = [
        f"{out}_n AS (SELECT region, min(date) FILTER (WHERE {column} IS NOT NULL) AS _first, "
        f"count({column}) AS n_train FROM {src} GROUP BY region)",
        f"{out}_x AS (SELECT s.*, {start} AS fit_from, n_train, date_diff('day', {start}, s.date) AS _x, "
        f"CASE WHEN s.date >= {start} AND n_train > {more_than} THEN {column} END AS _y "
        f"FROM {src} AS s JOIN {out}_n AS n ON s.region = n.region)",
        f"{out}_r AS (SELECT region, regr_slope(_y, _x) AS sl, regr_intercept(_y, _x) AS ic "
        f"FROM {out}_x WHERE _y IS NOT NULL GROUP BY region)",
    ]
    if segment_days:
        parts += [
            f"{out}_m AS (SELECT region, max(CAST(floor(_x / {segment_days}.0) AS BIGINT)) AS _last FROM {out}_x WHERE _y IS NOT NULL GROUP BY region)",
            f"{out}_s AS (SELECT x.*, least(greatest(CAST(floor(_x / {segment_days}.0) AS BIGINT), 0), _last) AS _seg FROM {out}_x AS x LEFT JOIN {out}_m AS m ON x.region = m.region)",
            f"{out}_g AS (SELECT region, _seg, CASE WHEN count(*) > 1 THEN regr_slope(_y, _x) END AS sl2, CASE WHEN count(*) > 1 THEN regr_intercept(_y, _x) END AS ic2 FROM {out}_s WHERE _y IS NOT NULL GROUP BY 1, 2)",
            f"{out}_t AS (SELECT s.*, coalesce(ic2 + sl2 * _x, ic + sl * _x) AS trend FROM {out}_s AS s LEFT JOIN {out}_r AS r ON s.region = r.region LEFT JOIN {out}_g AS g ON g.region = s.region AND g._seg = s._seg)",
        ]
    else:
        parts.append(
            f"{out}_t AS (SELECT x.*, ic + sl * _x AS trend FROM {out}_x AS x LEFT JOIN {out}_r AS r ON x.region = r.region)"
        )
    parts += [
        f"{out}_w AS (SELECT region, dayofweek(date) AS _d, avg(_y / trend) AS _w FROM {out}_t WHERE _y IS NOT NULL AND trend > 1e-9 GROUP BY 1, 2)",
        f"{out}_wm AS (SELECT region, avg(_w) AS _m FROM {out}_w GROUP BY region)",
        f"{out}_k AS (SELECT t.*, coalesce(_w / nullif(_m, 0), 1.0) AS weekly FROM {out}_t AS t "
        f"LEFT JOIN {out}_w AS w ON w.region = t.region AND w._d = dayofweek(t.date) "
        f"LEFT JOIN {out}_wm AS wm ON wm.region = t.region)",
    ]
    if holiday:
        parts += [
            f"{out}_h AS (SELECT region, holiday AS _h, avg(_y / (trend * weekly)) AS _e FROM {out}_k WHERE _y IS NOT NULL AND trend * weekly > 1e-9 AND holiday IS NOT NULL GROUP BY 1, 2)",
            f"{out}_e AS (SELECT k.*, coalesce(_e, 1.0) AS holiday_effect FROM {out}_k AS k LEFT JOIN {out}_h AS h ON h.region = k.region AND h._h = k.holiday)",
        ]
    else:
        parts.append(f"{out}_e AS (SELECT *, 1.0 AS holiday_effect FROM {out}_k)")
    parts.append(
        f"{out} AS (SELECT *, CASE WHEN trend IS NOT NULL THEN greatest(trend * weekly * holiday_effect, 0.0) END AS yhat FROM {out}_e)"
    )
    return ", ".join(parts)


def sql_predict(src: str, out: str, *, keep_data: bool = True, more_than: int = 10,
                target: str = "predicted_new_tests", column: str = "new_tests") -> str:
    """Prediction column on top of ``sql_fit``."""
    asked = f"date >= fit_from AND {column} IS NULL" if keep_data else "date >= fit_from"
    return (
        f"{out} AS (SELECT *, CASE WHEN n_train > {more_than} THEN "
        f"CASE WHEN {asked} THEN yhat ELSE {column} END END AS {target} FROM {src})"
    )


def sql_reconcile(src: str, out: str, predicted: str, reported: str) -> str:
    """Scaling factors per day: reports paired with their predecessor, days joined to intervals."""
    return f"""{out}_r AS (
  SELECT region, date AS d1, lag(date) OVER w AS d0,
         {reported} - lag({reported}) OVER w AS diff_reported
  FROM {src} WHERE {reported} IS NOT NULL WINDOW w AS (PARTITION BY region ORDER BY date)),
{out}_i AS (
  SELECT r.region, r.d0, r.d1, r.diff_reported, sum(s.{predicted}) AS sum_predicted
  FROM {out}_r AS r JOIN {src} AS s ON s.region = r.region AND s.date > r.d0 AND s.date <= r.d1
  GROUP BY 1, 2, 3, 4),
{out}_f AS (
  SELECT s.region, s.date, i.sum_predicted, i.diff_reported,
         i.diff_reported / nullif(i.sum_predicted, 0) AS f
  FROM {src} AS s LEFT JOIN {out}_i AS i ON s.region = i.region AND s.date > i.d0 AND s.date <= i.d1),
{out} AS (
  SELECT region, date, sum_predicted, diff_reported,
    coalesce(
      last_value(f IGNORE NULLS) OVER (PARTITION BY region ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(f IGNORE NULLS) OVER (PARTITION BY region ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    ) AS scaling_factor FROM {out}_f)"""


def sql_kernel(name: str, kernel: list[float]) -> str:
    rows = ", ".join(f"({lag}, CAST({p!r} AS DOUBLE))" for lag, p in enumerate(kernel))
    return f"{name} AS (SELECT * FROM (VALUES {rows}) AS k(lag, p))"


def sql_convolve(src: str, out: str, kernel: str, c: str, target: str, keys: str = "region") -> str:
    """Convolution as a join of every day with the days up to the kernel length before it."""
    on = " AND ".join(f"b.{k} = a.{k}" for k in keys.split())
    group = ", ".join(f"a.{k}" for k in keys.split())
    return f"""{out}_c AS (
  SELECT {group}, a.date, sum(b.{c} * k.p) AS {target}
  FROM {src} AS a JOIN {src} AS b ON {on} AND b.date <= a.date
  JOIN {kernel} AS k ON k.lag = date_diff('day', b.date, a.date)
  GROUP BY {group}, a.date),
{out} AS (SELECT s.*, coalesce(c.{target}, 0.0) AS {target} FROM {src} AS s
  LEFT JOIN {out}_c AS c ON {' AND '.join(f'c.{k} = s.{k}' for k in keys.split())} AND c.date = s.date)"""


def sql_hdi(src: str, value: str, keys: str, p: float, out: str) -> str:
    """Narrowest interval over floor(p * n) ranks by ranking the samples of every group."""
    k = ", ".join(keys.split())
    ak = ", ".join("a." + c for c in keys.split())
    on = " AND ".join(f"a.{c} = b.{c}" for c in keys.split())
    return f"""{out}_r AS (
  SELECT {k}, {value} AS v, row_number() OVER (PARTITION BY {k} ORDER BY {value}) AS i,
         count(*) OVER (PARTITION BY {k}) AS n FROM {src} WHERE {value} IS NOT NULL),
{out} AS (
  SELECT {k}, lo AS lower, hi AS upper FROM (
    SELECT {ak}, a.v AS lo, b.v AS hi,
           row_number() OVER (PARTITION BY {ak} ORDER BY b.v - a.v, a.v) AS rn
    FROM {out}_r AS a JOIN {out}_r AS b
      ON {on} AND b.i = a.i + CAST(floor({p!r}::DOUBLE * a.n) AS BIGINT)) AS pairs WHERE rn = 1)"""


def sql_solve(augmented: str, size: str) -> str:
    """Gauss-Jordan elimination of a list of rows [A | B], A positive definite: the rows [1 | X]."""
    return f"""list_reduce(
      list_concat([{augmented}], list_transform(range(1, {size} + 1), lambda k: [[CAST(k AS DOUBLE)]])),
      lambda m, e: list_transform(m, lambda row, i:
        CASE WHEN i = CAST(e[1][1] AS BIGINT)
          THEN list_transform(row, lambda v: v / row[CAST(e[1][1] AS BIGINT)])
          ELSE list_transform(row, lambda v, j: v - row[CAST(e[1][1] AS BIGINT)]
            / m[CAST(e[1][1] AS BIGINT)][CAST(e[1][1] AS BIGINT)] * m[CAST(e[1][1] AS BIGINT)][j]) END))"""


def sql_growth(
    src: str,
    out: str,
    options,
    *,
    iterations: int,
    ignore_before: str | None = "2020-03-15",
    more_than: int = 10,
    holiday: bool = False,
    column: str = "new_tests",
) -> str:
    """Joint fit by Gauss-Newton steps on lists, one row per region: a recursion over the steps."""
    from pulsepanel.operators import growth as model

    start = f"greatest(DATE '{ignore_before}', _first)" if ignore_before else "_first"
    classes = model.HOLIDAY_CLASSES if options.effects else ()
    days = model.WEEKDAYS - 1 if options.effects else 0
    variance = options.noise**2
    squares = [variance / model.TREND_SCALE**2] * 2
    change, effect = variance / options.change_scale**2, variance / model.EFFECT_SCALE**2
    held = "holiday" if holiday else "NULL"
    n_knots = f"CAST(ceil(_span / {options.knot_days}.0) AS BIGINT)" if options.knot_days else "0"
    contrasts = ", ".join(f"CAST(_dow = {d} AS INTEGER) - CAST(_dow = {days} AS INTEGER)" for d in range(days))
    named = ", ".join(f"CAST(coalesce(_h = '{c}', FALSE) AS INTEGER)" for c in classes)
    effects = ", ".join(x for x in (contrasts, named) if x)
    zs = f"CAST([{effects}] AS DOUBLE[])"
    hs = (
        "list_concat([1.0, _t], list_transform(range(1, _k + 1), lambda j: "
        f"greatest(_t - {options.knot_range!r} * j / _k, 0.0)))"
    )
    dot = "list_inner_product"
    if options.kind == "linear":
        trend, slope = (lambda e: e), (lambda g: "1.0")
    else:
        trend = lambda e: f"({options.cap_factor!r} / (1 + exp(-({e}))))"
        slope = lambda g: f"({g} * (1 - {g} / {options.cap_factor!r}))"
    factor = (lambda i, th: f"(1 + {dot}(zs[{i}], {th}[q + 1:]))") if effects else (lambda i, th: "1.0")

    def objective(th: str) -> str:
        g = trend(f"{dot}(hs[i], ({th})[:q])")
        fit = f"list_sum(list_transform(range(1, len(ys) + 1), lambda i: pow(ys[i] - {g} * {factor('i', '(' + th + ')')}, 2)))"
        return f"({fit} + list_sum(list_transform({th}, lambda v, a: weights[a] * v * v)))"

    tried = ", ".join(
        objective(f"list_transform(th, lambda v, a: v + {s!r} * move[a])") for s in model.STEPS
    )
    steps = ", ".join(map(repr, model.STEPS))
    zcols = f"list_transform(range(1, len(th) - q + 1), lambda a: list_transform(zs, lambda z, i: z[a] * gs[i]))"
    columns = "list_transform(range(1, q + 1), lambda a: list_transform(hs, lambda h, i: h[a] * slopes[i] * factors[i]))"
    if effects:
        columns = f"list_concat({columns}, {zcols})"
    return f"""/*RECURSIVE*/{out}_n AS (
  SELECT region, min(date) FILTER (WHERE {column} IS NOT NULL) AS _first, count({column}) AS n_train FROM {src} GROUP BY region),
{out}_x AS (
  SELECT s.*, {start} AS fit_from, n_train, CASE WHEN s.date >= {start} AND n_train > {more_than} THEN {column} END AS _y,
         isodow(s.date) - 1 AS _dow, {held} AS _h
  FROM {src} AS s JOIN {out}_n AS n ON s.region = n.region),
{out}_b AS (
  SELECT region, min(date) AS _f0, date_diff('day', min(date), max(date)) AS _span,
         CASE WHEN max(abs(_y)) > 0 THEN max(abs(_y)) ELSE 1.0 END AS _scale
  FROM {out}_x WHERE _y IS NOT NULL GROUP BY region),
{out}_t AS (
  SELECT x.*, _scale, date_diff('day', _f0, x.date) / greatest(_span, 1) AS _t, {n_knots} AS _k
  FROM {out}_x AS x JOIN {out}_b AS b ON b.region = x.region),
{out}_l AS (SELECT *, {hs} AS _hs, {zs} AS _zs FROM {out}_t),
{out}_d AS (
  SELECT region, any_value(_k) + 2 AS q, list(_y / _scale ORDER BY date) AS ys, list(_hs ORDER BY date) AS hs, list(_zs ORDER BY date) AS zs,
         list_concat([{squares[0]!r}, {squares[1]!r}], list_transform(range(any_value(_k)), lambda j: {change!r}),
           list_transform(range({days + len(classes)}), lambda j: {effect!r})) AS weights
  FROM {out}_l WHERE _y IS NOT NULL GROUP BY region),
{out}_s AS (
  SELECT region, 0 AS it, list_transform(weights, lambda w: 0.0::DOUBLE) AS th FROM {out}_d
  UNION ALL
  SELECT region, it + 1, list_transform(th, lambda v, a: v + step * move[a]) FROM (
    SELECT *, ([{steps}])[list_position(list_transform(objectives, lambda o: o <= list_min(objectives) * (1 + {model.FLAT!r})), TRUE)] AS step FROM (
      SELECT *, [{tried}] AS objectives FROM (
        SELECT *, list_transform({sql_solve('m', 'len(th)')}, lambda row: row[len(row)]) AS move FROM (
          SELECT *, list_transform(js, lambda a, i: list_append(
              list_transform(js, lambda b, j: {dot}(a, b) + CASE WHEN i = j THEN weights[i] ELSE 0.0 END),
              {dot}(a, rs) - weights[i] * th[i])) AS m FROM (
            SELECT *, {columns} AS js, list_transform(ys, lambda y, i: y - gs[i] * factors[i]) AS rs FROM (
              SELECT *, list_transform(gs, lambda g: CAST({slope('g')} AS DOUBLE)) AS slopes FROM (
                SELECT s.region, it, th, q, ys, hs, zs, weights,
                       list_transform(hs, lambda h: {trend(f'{dot}(h, th[:q])')}) AS gs,
                       list_transform(range(1, len(ys) + 1), lambda i: CAST({factor('i', 'th')} AS DOUBLE)) AS factors
                FROM {out}_s AS s JOIN {out}_d AS d ON d.region = s.region WHERE it < {iterations})))))))),
{out}_c AS (
  SELECT l.*, {trend(f"{dot}(_hs, th[:_k + 2])")} * _scale AS trend,
         {f"1 + {dot}(_zs[:{days}], th[_k + 3:_k + {2 + days}])" if effects else "1.0"} AS weekly,
         {f"1 + {dot}(_zs, th[_k + 3:])" if effects else "1.0"} AS _both
  FROM {out}_l AS l JOIN {out}_s AS s ON s.region = l.region AND it = {iterations}),
{out} AS (
  SELECT x.*, c.trend, c.weekly, CASE WHEN c.trend IS NOT NULL THEN CASE WHEN c._h IS NULL OR c.weekly = 0 THEN 1.0 ELSE _both / c.weekly END END AS holiday_effect,
         greatest(c.trend * CASE WHEN c._h IS NULL OR c.weekly = 0 THEN c.weekly ELSE _both END, 0.0 * c.trend) AS yhat
  FROM {out}_x AS x LEFT JOIN {out}_c AS c ON c.region = x.region AND c.date = x.date)"""
