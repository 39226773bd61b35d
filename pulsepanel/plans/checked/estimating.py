"""Renewal model (M*) and summaries of draws (A10 to A16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsepanel.operators import renewal, smoother
from pulsepanel.operators.calendar import model_axis
from pulsepanel.operators.kernels import generation_time, still_active
from pulsepanel.operators.summary import (
    quantile_bands,
    summarize_infections,
    summarize_median_and_hdi,
    summarize_r_t,
    summary_lists,
    threshold_probability,
)
from pulsepanel.plans.checked import derived as d
from pulsepanel.plans.checked.base import (
    MASKED,
    MASKED_USERS,
    PE,
    PU,
    query,
    sql_convolve,
    sql_dense,
    sql_hdi,
    sql_interpolate,
    sql_kernel,
    sql_solve,
    with_sql,
)
from pulsepanel.session import shared_table_path
from pulsepanel.sources import files

G = generation_time(20)
P_DELAY = [0.0, 0.05, 0.2, 0.3, 0.2, 0.15, 0.1]
PATH = "region chain draw"
SEED = 0.02

R_T = """rt AS (
  SELECT region, chain, draw, date, exp(sum(step) OVER (PARTITION BY region, chain, draw ORDER BY date)) AS r_t FROM steps)"""

_G_LIST = "[" + ", ".join(repr(g) for g in G) + "]"


def sql_renewal(src: str, out: str) -> str:
    """Recurrence over a growing list of infections per path."""
    return f"""/*RECURSIVE*/{out}_p AS (
  SELECT region, chain, draw, list(date ORDER BY date) AS dates, list(r_t ORDER BY date) AS r
  FROM {src} GROUP BY 1, 2, 3),
{out}_y AS (
  SELECT region, chain, draw, dates, r, [CAST({SEED} AS DOUBLE)] AS y FROM {out}_p
  UNION ALL
  SELECT region, chain, draw, dates, r, list_append(y, list_sum(list_transform(
    range(1, least(len(y), {len(G) - 1}) + 1),
    lambda s: ({_G_LIST})[s + 1] * r[len(y) + 1 - s] * y[len(y) + 1 - s])))
  FROM {out}_y WHERE len(y) < len(r)),
{out} AS (
  SELECT region, chain, draw, unnest(dates) AS date, unnest(r) AS r_t, unnest(y) AS infections
  FROM {out}_y WHERE len(y) = len(r))"""


OBSERVED = """ob AS (
  SELECT region, date, new_cases, new_tests AS daily_tests,
         CASE WHEN new_tests IS NOT NULL THEN greatest(new_tests, 0.1 * max(new_tests) OVER (PARTITION BY region)) END AS exposure
  FROM masked)"""

RENEWED = (d.STEPS, R_T, sql_renewal("rt", "inf"))
DELAYED = (
    *RENEWED,
    sql_kernel("pd", P_DELAY),
    sql_convolve("inf", "tap", "pd", "infections", "test_adjusted_positive", PATH),
)
EXPECTED = (
    *DELAYED,
    "pos AS (SELECT t.*, exposure, exposure * test_adjusted_positive AS positive FROM tap AS t "
    "JOIN ob ON ob.region = t.region AND ob.date = t.date WHERE exposure IS NOT NULL)",
)
FACTORS = (
    *EXPECTED,
    f"sf AS (SELECT t.region, chain, draw, sum(new_cases) / sum(test_adjusted_positive * ob.exposure / mx) / {sum(P_DELAY)!r} AS scale_factor "
    "FROM tap AS t JOIN ob ON ob.region = t.region AND ob.date = t.date "
    "JOIN (SELECT region, max(exposure) AS mx FROM ob GROUP BY region) AS m ON m.region = t.region "
    "WHERE new_cases IS NOT NULL AND ob.exposure IS NOT NULL GROUP BY 1, 2, 3)",
)
CURVES = (
    *FACTORS,
    "nc AS (SELECT i.region, i.chain, i.draw, i.date, infections * scale_factor AS new_cases FROM inf AS i JOIN sf USING (region, chain, draw))",
    "tc AS (SELECT *, sum(new_cases) OVER (PARTITION BY region, chain, draw ORDER BY date) AS total_cases FROM nc)",
    sql_kernel("act", still_active(G)),
    sql_convolve("tc", "curves", "act", "new_cases", "active_cases", PATH),
)


def draws(spark, sf):
    return renewal.r_t_path(d.log_steps(spark, sf))


def infections(spark, sf):
    return renewal.renewal_infections(draws(spark, sf), G, seed=SEED)


def delayed(spark, sf):
    return renewal.delayed_positives(infections(spark, sf), P_DELAY)


def observed(spark, sf):
    panel = d.masked_events(spark, sf).withColumnRenamed("new_tests", "daily_tests")
    return renewal.with_exposure(panel)


@query("m01_r_t_path", "region chain draw date r_t:f", with_sql(PE, d.STEPS, R_T, "SELECT * FROM rt"))
def m01(spark, sf):
    return draws(spark, sf)


@query(
    "m02_renewal_infections",
    "region chain draw date infections:f",
    with_sql(PE, *RENEWED, "SELECT * FROM inf"),
)
def m02(spark, sf):
    return infections(spark, sf)


@query(
    "m03_delayed_positives",
    "region chain draw date test_adjusted_positive:f",
    with_sql(PE, *DELAYED, "SELECT * FROM tap"),
)
def m03(spark, sf):
    return delayed(spark, sf)


@query("m04_exposure", "region date exposure:f", with_sql(PE, MASKED, OBSERVED, "SELECT * FROM ob"))
def m04(spark, sf):
    return observed(spark, sf)


@query(
    "m05_expected_positives",
    "region chain draw date positive:f",
    with_sql(PE, MASKED, OBSERVED, *EXPECTED, "SELECT * FROM pos"),
)
def m05(spark, sf):
    return renewal.expected_positives(delayed(spark, sf), observed(spark, sf))


@query(
    "m06_log_likelihood",
    "region chain draw log_likelihood:f n_days:i",
    with_sql(
        PE, MASKED, OBSERVED, *EXPECTED,
        "SELECT p.region, chain, draw, count(*) AS n_days, sum(lgamma(y + 6) - lgamma(6) - lgamma(y + 1) "
        "+ 6 * ln(6 / (6 + positive)) + y * ln(positive / (6 + positive))) AS log_likelihood FROM pos AS p "
        "JOIN (SELECT region, date, new_cases AS y FROM ob WHERE new_cases IS NOT NULL) AS o "
        "ON o.region = p.region AND o.date = p.date WHERE positive > 0 GROUP BY 1, 2, 3",
    ),
)
def m06(spark, sf):
    ob = observed(spark, sf)
    return renewal.log_likelihood(renewal.expected_positives(delayed(spark, sf), ob), ob)


def sql_uniform(text: str, begin: int) -> str:
    return f"(CAST('0x' || substr(md5({text}), {begin}, 13) AS BIGINT) + 0.5) / {float(1 << 52)!r}"


def sql_normal(text: str) -> str:
    return f"sqrt(-2 * ln({sql_uniform(text, 1)})) * cos(2 * pi() * {sql_uniform(text, 14)})"


# Wilson and Hilferty's quantile of the gamma with shape 36 and rate 6
ALPHAS = (
    "az AS (SELECT DISTINCT region, chain, draw, "
    + sql_normal("'0|alpha|' || region || '|' || chain || '|' || draw")
    + " AS z FROM pos)",
    "al AS (SELECT region, chain, draw, greatest(36 * pow(1 - 1 / (9.0 * 36) + z / (3 * 6), 3) / 6, 0.0) AS alpha FROM az)",
    "ll AS (SELECT p.region, p.chain, p.draw, alpha, count(*) AS n_days, sum(lgamma(y + alpha) - lgamma(alpha) - lgamma(y + 1) "
    "+ alpha * ln(alpha / (alpha + positive)) + y * ln(positive / (alpha + positive))) AS log_likelihood "
    "FROM pos AS p JOIN al ON al.region = p.region AND al.chain = p.chain AND al.draw = p.draw "
    "JOIN (SELECT region, date, new_cases AS y FROM ob WHERE new_cases IS NOT NULL) AS o ON o.region = p.region AND o.date = p.date "
    "WHERE positive > 0 GROUP BY 1, 2, 3, 4)",
    "wt AS (SELECT *, exp(log_likelihood - max(log_likelihood) OVER r) / sum(exp(log_likelihood - top)) OVER r AS weight "
    "FROM (SELECT *, max(log_likelihood) OVER (PARTITION BY region) AS top FROM ll) WINDOW r AS (PARTITION BY region))",
)


def weights(spark, sf):
    """Paths weighted by the likelihood of the observed cases, alpha drawn from its prior."""
    ob = observed(spark, sf)
    predicted = renewal.with_drawn_alpha(renewal.expected_positives(delayed(spark, sf), ob))
    likelihood = renewal.log_likelihood(predicted, ob, alpha="alpha", keys=[*renewal.PATH, "alpha"])
    return renewal.importance_weights(likelihood)


@query(
    "m06_drawn_alpha_weights",
    "region chain draw alpha:f log_likelihood:f n_days:i weight:f",
    with_sql(PE, MASKED, OBSERVED, *EXPECTED, *ALPHAS, "SELECT * FROM wt"),
)
def m06_weights(spark, sf):
    return weights(spark, sf)


@query(
    "m06_effective_paths",
    "region n_paths:i effective_paths:f",
    with_sql(
        PE, MASKED, OBSERVED, *EXPECTED, *ALPHAS,
        "SELECT region, count(*) AS n_paths, pow(sum(weight), 2) / sum(weight * weight) AS effective_paths FROM wt GROUP BY region",
    ),
)
def m06_effective(spark, sf):
    return renewal.effective_sample_size(weights(spark, sf))


def sql_estimate(src: str, out: str, lead: int = 10) -> str:
    """Window estimate on the model axis of ``src`` (region, date, new_cases, new_tests)."""
    full = "OVER (PARTITION BY region ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    return ", ".join(
        [
            f"{out}_f AS (SELECT region, coalesce(min(date) FILTER (WHERE new_cases > 0), min(date)) AS f FROM {src} GROUP BY region)",
            f"{out}_k AS (SELECT s.region, s.date, s.new_cases, s.new_tests FROM {src} AS s JOIN {out}_f AS f ON f.region = s.region WHERE s.date >= f)",
            sql_dense(f"{out}_k", f"{out}_d", "new_cases new_tests", lead=lead),
            f"{out}_e AS (SELECT *, CASE WHEN new_tests IS NOT NULL THEN greatest(new_tests, 0.1 * max(new_tests) OVER (PARTITION BY region)) END AS exposure FROM {out}_d)",
            f"{out}_a AS (SELECT region, date, new_cases, exposure, new_cases / (exposure / max(exposure) OVER (PARTITION BY region)) AS adj FROM {out}_e)",
            f"{out}_h AS (SELECT *, adj AS hist FROM {out}_a)",
            sql_interpolate(f"{out}_h", f"{out}_i", "hist"),
            sql_kernel(f"{out}_g", G),
            sql_convolve(f"{out}_i", f"{out}_l", f"{out}_g", "hist", "force"),
            f"{out}_w AS (SELECT region, date, count(*) {full} AS nrows, sum(CASE WHEN adj IS NOT NULL AND force > 0 THEN adj END) {full} AS sc, "
            f"sum(CASE WHEN adj IS NOT NULL AND force > 0 THEN force END) {full} AS sl FROM {out}_l)",
            f"{out} AS (SELECT region, date, 1 + sc AS shape, 0.2 + sl AS rate, (1 + sc) / (0.2 + sl) AS r_t_mean, sqrt(1 + sc) / (0.2 + sl) AS r_t_sd "
            f"FROM {out}_w WHERE nrows = 7 AND sc >= 1 AND sl > 0)",
        ]
    )


@query(
    "m07_r_t_estimate",
    "region date shape:f rate:f r_t_mean:f r_t_sd:f",
    with_sql(PE, MASKED, sql_estimate("masked", "est"), "SELECT * FROM est"),
)
def m07(spark, sf):
    axis = model_axis(d.masked_events(spark, sf).withColumnRenamed("new_tests", "daily_tests"))
    return renewal.estimate_r_t(axis, G)


@query(
    "m07_r_t_estimate_users",
    "region date r_t_mean:f r_t_sd:f",
    with_sql(PU, MASKED_USERS, sql_estimate("masked", "est"), "SELECT * FROM est"),
)
def m07_users(spark, sf):
    axis = model_axis(d.masked_users(spark, sf).withColumnRenamed("new_tests", "daily_tests"))
    return renewal.estimate_r_t(axis, G)


def sql_smoother(src: str, out: str, lead: int = 10) -> str:
    """Mode and covariance of log R by dense solves on the model axis of ``src``: a recursion over scoring steps."""
    step, first, a = 1 / renewal.STEP_SCALE**2, 1 / smoother.FIRST_SCALE**2, renewal.ALPHA
    prior = (
        f"CASE WHEN i = j THEN CASE WHEN i = 1 THEN {first!r} ELSE {step!r} END + CASE WHEN i < len(ys) THEN {step!r} ELSE 0.0 END "
        f"WHEN abs(i - j) = 1 THEN {-step!r} ELSE 0.0 END"
    )
    matrix = (
        f"list_transform(range(1, len(ys) + 1), lambda i: list_transform(range(1, len(ys) + 1), lambda j: "
        f"{prior} + CASE WHEN i = j AND ys[i] IS NOT NULL THEN {a} * mus[i] / (mus[i] + {a}) ELSE 0.0 END))"
    )
    identity = "list_transform(range(1, len(ys) + 1), lambda j: CASE WHEN i = j THEN 1.0 ELSE 0.0 END)"
    slope = (
        f"CASE WHEN ys[i] IS NOT NULL THEN {a} * (ys[i] - mus[i]) / (mus[i] + {a}) ELSE 0.0 END "
        f"- list_inner_product(list_transform(range(1, len(ys) + 1), lambda j: {prior}), x)"
    )
    steps = 40
    return f"""/*RECURSIVE*/{out}_f AS (SELECT region, coalesce(min(date) FILTER (WHERE new_cases > 0), min(date)) AS f FROM {src} GROUP BY region),
{out}_k AS (SELECT s.region, s.date, s.new_cases, s.new_tests FROM {src} AS s JOIN {out}_f AS f ON f.region = s.region WHERE s.date >= f),
{sql_dense(f"{out}_k", f"{out}_d", "new_cases new_tests", lead=lead)},
{out}_e AS (SELECT *, CASE WHEN new_tests IS NOT NULL THEN greatest(new_tests, 0.1 * max(new_tests) OVER (PARTITION BY region)) END AS exposure FROM {out}_d),
{out}_a AS (SELECT region, date, new_cases, exposure / max(exposure) OVER (PARTITION BY region) AS profile FROM {out}_e),
{out}_h AS (SELECT *, new_cases / profile AS hist FROM {out}_a),
{sql_interpolate(f"{out}_h", f"{out}_i", "hist")},
{sql_kernel(f"{out}_g", G)},
{sql_convolve(f"{out}_i", f"{out}_l", f"{out}_g", "hist", "force")},
{out}_o AS (
  SELECT region, list(date ORDER BY date) AS dates,
         list(CASE WHEN profile * force > 0 THEN new_cases END ORDER BY date) AS ys, list(coalesce(profile * force, 1.0) ORDER BY date) AS levels
  FROM {out}_l GROUP BY region),
{out}_x AS (
  SELECT region, 0 AS it, list_transform(ys, lambda y: 0.0::DOUBLE) AS x FROM {out}_o
  UNION ALL
  SELECT region, it + 1, list_transform(x, lambda v, i: v + greatest(-{smoother.LONGEST_MOVE}, least({smoother.LONGEST_MOVE}, move[i]))) FROM (
    SELECT region, it, x, list_transform({sql_solve('m', 'len(x)')}, lambda row: row[len(row)]) AS move FROM (
      SELECT region, it, x, list_transform({matrix}, lambda row, i: list_append(row, {slope})) AS m FROM (
        SELECT s.region, it, x, ys, list_transform(x, lambda v, i: levels[i] * exp(v)) AS mus
        FROM {out}_x AS s JOIN {out}_o AS o ON o.region = s.region WHERE it < {steps})))),
{out}_v AS (
  SELECT region, dates, x, list_transform({sql_solve('m', 'len(x)')}, lambda row: row[len(x) + 1:]) AS cov FROM (
    SELECT region, dates, x, list_transform({matrix}, lambda row, i: list_concat(row, {identity})) AS m FROM (
      SELECT s.region, dates, x, ys, list_transform(x, lambda v, i: levels[i] * exp(v)) AS mus
      FROM {out}_x AS s JOIN {out}_o AS o ON o.region = s.region WHERE it = {steps}))),
{out} AS (
  SELECT region, i, dates[i] AS date, x[i] AS log_r, sqrt(cov[i][i]) AS log_r_sd,
         CASE WHEN i < len(x) THEN cov[i][i + 1] / cov[i + 1][i + 1] ELSE 0.0 END AS gain,
         sqrt(cov[i][i] - CASE WHEN i < len(x) THEN cov[i][i + 1] * cov[i][i + 1] / cov[i + 1][i + 1] ELSE 0.0 END) AS draw_sd,
         exp(x[i]) AS r_t_median, exp(x[i] - 1.6448536269514722 * sqrt(cov[i][i])) AS r_t_lower,
         exp(x[i] + 1.6448536269514722 * sqrt(cov[i][i])) AS r_t_upper
  FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM {out}_v))"""


SMOOTHED = "region date log_r:f log_r_sd:f gain:f draw_sd:f r_t_median:f r_t_lower:f r_t_upper:f"


def smoothed(spark, sf):
    axis = model_axis(d.masked_events(spark, sf).withColumnRenamed("new_tests", "daily_tests"))
    return smoother.smoothed_r_t(axis, G)


@query(
    "m07_smoothed_r_t",
    SMOOTHED,
    with_sql(PE, MASKED, sql_smoother("masked", "sm"), "SELECT * FROM sm"),
)
def m07_smoothed(spark, sf):
    """R(t) under the random walk, from the first day of the axis on."""
    return smoothed(spark, sf)


def sql_joint_draws(src: str, out: str, chains: int, draws: int) -> str:
    """Paths from the last day back, with noise from MD5."""
    key = "'0|' || region || '|' || chain || '|' || draw || '|' || CAST(date AS VARCHAR)"
    return f"""/*RECURSIVE*/{out}_k AS (SELECT CAST(k // {draws} AS INTEGER) AS chain, CAST(k % {draws} AS INTEGER) AS draw FROM range({chains * draws}) AS t(k)),
{out}_e AS (
  SELECT region, chain, draw, i, date, log_r, gain, draw_sd * {sql_normal(key)} AS e FROM {src}, {out}_k),
{out}_p AS (
  SELECT region, chain, draw, i, e AS dev FROM {out}_e AS e WHERE i = (SELECT max(i) FROM {src} AS s WHERE s.region = e.region)
  UNION ALL
  SELECT p.region, p.chain, p.draw, e.i, e.gain * dev + e.e FROM {out}_p AS p
  JOIN {out}_e AS e ON e.region = p.region AND e.chain = p.chain AND e.draw = p.draw AND e.i = p.i - 1),
{out} AS (
  SELECT e.region, e.chain, e.draw, e.date, exp(log_r + dev) AS r_t FROM {out}_p AS p
  JOIN {out}_e AS e ON e.region = p.region AND e.chain = p.chain AND e.draw = p.draw AND e.i = p.i)"""


JOINT = (MASKED, sql_smoother("masked", "sm"), sql_joint_draws("sm", "jd", 2, 10))


def joint(spark, sf):
    return smoother.joint_draws(smoothed(spark, sf), chains=2, draws=10)


@query("m08_joint_draws", "region chain draw date r_t:f", with_sql(PE, *JOINT, "SELECT * FROM jd"))
def m08_joint(spark, sf):
    return joint(spark, sf)


def sql_draws(src: str, out: str, chains: int, draws: int) -> str:
    scores = ", ".join(f"({k}, {z!r})" for k, z in enumerate(renewal.normal_scores(chains * draws)))
    return (
        f"{out} AS (SELECT region, CAST(k // {draws} AS INTEGER) AS chain, CAST(k % {draws} AS INTEGER) AS draw, date, "
        f"greatest(shape * pow(1 - 1 / (9 * shape) + z / (3 * sqrt(shape)), 3) / rate, 0.0) AS r_t "
        f"FROM {src}, (VALUES {scores}) AS s(k, z))"
    )


POSTERIOR = (MASKED, sql_estimate("masked", "est"), sql_draws("est", "post", 4, 25))


def posterior(spark, sf):
    return renewal.posterior_draws(m07(spark, sf), chains=4, draws=25)


@query("m08_posterior_draws", "region chain draw date r_t:f", with_sql(PE, *POSTERIOR, "SELECT * FROM post"))
def m08(spark, sf):
    return posterior(spark, sf)


@query(
    "m09_scale_factor",
    "region chain draw scale_factor:f",
    with_sql(PE, MASKED, OBSERVED, *FACTORS, "SELECT * FROM sf"),
)
def m09(spark, sf):
    return renewal.scale_factor(delayed(spark, sf), observed(spark, sf), P_DELAY)


@query(
    "m10_case_curves",
    "region chain draw date new_cases:f total_cases:f active_cases:f",
    with_sql(PE, MASKED, OBSERVED, *CURVES, "SELECT * FROM curves"),
)
def m10(spark, sf):
    paths = delayed(spark, sf)
    factors = renewal.scale_factor(paths, observed(spark, sf), P_DELAY)
    return renewal.case_curves(paths, factors, G)


@query(
    "m11_display_curves",
    "region chain draw date label value:f",
    with_sql(
        PE, MASKED,
        OBSERVED.replace("FROM masked)", "FROM (SELECT * REPLACE (CASE WHEN day(date) <= 26 THEN new_cases END AS new_cases) FROM masked) AS q)"),
        *FACTORS,
        "b AS (SELECT region, min(date) + 3 AS lo, max(date) FILTER (WHERE new_cases IS NOT NULL) AS hi FROM ob GROUP BY region)",
        "SELECT p.region, p.chain, p.draw, p.date, 'infections' AS label, infections * scale_factor AS value FROM pos AS p JOIN sf USING (region, chain, draw) "
        "JOIN b ON b.region = p.region WHERE p.date BETWEEN lo AND hi UNION ALL "
        "SELECT p.region, p.chain, p.draw, p.date, 'test_adjusted_positive', test_adjusted_positive * scale_factor FROM pos AS p JOIN sf USING (region, chain, draw) "
        "JOIN b ON b.region = p.region WHERE p.date >= lo UNION ALL "
        "SELECT p.region, p.chain, p.draw, p.date, 'positive', positive FROM pos AS p JOIN b ON b.region = p.region WHERE p.date >= hi",
    ),
)
def m11(spark, sf):
    ob = observed(spark, sf).withColumn("new_cases", F.when(F.dayofmonth("date") <= 26, F.col("new_cases")))
    paths = delayed(spark, sf)
    factors = renewal.scale_factor(paths, ob, P_DELAY)
    return renewal.display_curves(
        renewal.expected_positives(paths, ob), factors, ob, positive="unobserved"
    )


# --- summaries -------------------------------------------------------------------------------


@query(
    "a10_threshold_probability",
    "region date r_t_threshold_probability:f",
    with_sql(PE, *POSTERIOR, "SELECT region, date, avg(CASE WHEN r_t > 1 THEN 1.0 ELSE 0.0 END) AS r_t_threshold_probability FROM post GROUP BY 1, 2"),
)
def a10(spark, sf):
    return threshold_probability(posterior(spark, sf))


@query(
    "a10_pooled_threshold_probability",
    "region r_t_threshold_probability:f",
    with_sql(PE, *POSTERIOR, "SELECT region, avg(CASE WHEN r_t > 1 THEN 1.0 ELSE 0.0 END) AS r_t_threshold_probability FROM post GROUP BY 1"),
)
def a10_pooled(spark, sf):
    return threshold_probability(posterior(spark, sf), keys=["region"])


@query(
    "a11_posterior_median",
    "region date r_t:f",
    with_sql(PE, *POSTERIOR, "SELECT region, date, median(r_t) AS r_t FROM post GROUP BY 1, 2"),
)
def a11(spark, sf):
    return summarize_median_and_hdi(posterior(spark, sf), "r_t", "r_t", 0.9, per_group=100)


@query(
    "a12_density_intervals",
    "region date r_t:f lower_50:f upper_50:f lower_90:f upper_90:f",
    with_sql(
        PE, *POSTERIOR, sql_hdi("post", "r_t", "region date", 0.5, "h5"), sql_hdi("post", "r_t", "region date", 0.9, "h9"),
        'SELECT region, date, r_t, h5.lower AS lower_50, h5.upper AS upper_50, h9.lower AS lower_90, h9.upper AS upper_90 '
        "FROM (SELECT region, date, median(r_t) AS r_t FROM post GROUP BY 1, 2) AS m JOIN h5 USING (region, date) JOIN h9 USING (region, date)",
    ),
)
def a12(spark, sf):
    summary = summarize_median_and_hdi(posterior(spark, sf), "r_t", "r_t", [0.5, 0.9], per_group=100)
    return summary.toDF("region", "date", "r_t", "lower_50", "upper_50", "lower_90", "upper_90")


@query(
    "a12_density_interval_any_group_size",
    "l_returnflag price:f price_lower:f price_upper:f",
    with_sql(
        sql_hdi("lineitem", "l_extendedprice", "l_returnflag", 0.9, "h"),
        "SELECT l_returnflag, price, h.lower AS price_lower, h.upper AS price_upper FROM "
        "(SELECT l_returnflag, median(l_extendedprice) AS price FROM lineitem GROUP BY 1) AS m JOIN h USING (l_returnflag)",
    ),
)
def a12_any(spark, sf):
    samples = d.table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    return summarize_median_and_hdi(samples, "l_extendedprice", "price", 0.9, keys=["l_returnflag"])


@query(
    "a12_density_interval_many_ties",
    "l_linestatus quantity:f quantity_lower:f quantity_upper:f",
    with_sql(
        sql_hdi("lineitem", "l_quantity", "l_linestatus", 0.5, "h"),
        "SELECT l_linestatus, quantity, h.lower AS quantity_lower, h.upper AS quantity_upper FROM "
        "(SELECT l_linestatus, median(l_quantity) AS quantity FROM lineitem GROUP BY 1) AS m JOIN h USING (l_linestatus)",
    ),
)
def a12_ties(spark, sf):
    samples = d.table(spark, sf, "lineitem").select("l_linestatus", "l_quantity")
    return summarize_median_and_hdi(samples, "l_quantity", "quantity", 0.5, keys=["l_linestatus"])


def sql_weighted_hdi(src: str, value: str, weight: str, keys: str, p: float, out: str) -> str:
    """Least width over all pairs of values that hold a share of the weight."""
    k = ", ".join(keys.split())
    on = " AND ".join(f"a.{c} = b.{c}" for c in keys.split())
    ak = ", ".join("a." + c for c in keys.split())
    return f"""{out}_c AS (
  SELECT {k}, v, w, sum(w) OVER (PARTITION BY {k} ORDER BY v) AS upto, sum(w) OVER (PARTITION BY {k}) AS n
  FROM (SELECT {k}, {value} AS v, sum({weight}) AS w FROM {src} WHERE {value} IS NOT NULL GROUP BY {k}, v)),
{out}_q AS (SELECT {k}, min(v) FILTER (WHERE upto > n * (0.5 - 1e-9)) AS mid FROM {out}_c GROUP BY {k}),
{out} AS (
  SELECT {k}, lo AS lower, hi AS upper FROM (
    SELECT {ak}, a.v AS lo, b.v AS hi, row_number() OVER (PARTITION BY {ak} ORDER BY b.v - a.v, a.v) AS rn
    FROM {out}_c AS a JOIN {out}_c AS b ON {on} AND b.v >= a.v AND b.upto - a.upto + a.w > a.n * ({p!r} - 1e-9)) AS pairs WHERE rn = 1)"""


@query(
    "a10_weighted_r_t_summary",
    "region date r_t_threshold_probability:f r_t:f r_t_lower:f r_t_upper:f",
    with_sql(
        PE, MASKED, OBSERVED, *EXPECTED, *ALPHAS,
        "smp AS (SELECT rt.*, weight FROM rt JOIN wt ON wt.region = rt.region AND wt.chain = rt.chain AND wt.draw = rt.draw)",
        sql_weighted_hdi("smp", "r_t", "weight", "region date", 0.6, "h"),
        "SELECT p.region, p.date, p AS r_t_threshold_probability, mid AS r_t, h.lower AS r_t_lower, h.upper AS r_t_upper FROM "
        "(SELECT region, date, sum(CASE WHEN r_t > 1 THEN weight ELSE 0.0 END) / sum(weight) AS p FROM smp GROUP BY 1, 2) AS p "
        "JOIN h ON h.region = p.region AND h.date = p.date JOIN h_q AS q ON q.region = p.region AND q.date = p.date",
    ),
)
def a10_weighted(spark, sf):
    """Probability, median and interval of R(t) from weighted paths, stored once and summarised from there."""
    path = shared_table_path(spark, "weighted_draws")
    samples = draws(spark, sf).join(weights(spark, sf).select(*renewal.PATH, "weight"), list(renewal.PATH))
    files.write_draws(samples.select(*renewal.PATH, "date", "r_t", "weight"), path)
    return summarize_r_t(files.read_draws(spark, path), 0.6, weight="weight")


@query(
    "a14_weighted_bands",
    "l_returnflag q:f value:f",
    with_sql(
        "c AS (SELECT l_returnflag, l_extendedprice AS v, sum(sum(l_quantity)) OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS upto, "
        "sum(sum(l_quantity)) OVER (PARTITION BY l_returnflag) AS n FROM lineitem GROUP BY 1, 2)",
        "SELECT l_returnflag, q, min(v) FILTER (WHERE upto > n * (q - 1e-9)) AS value "
        "FROM c, (VALUES (0.05::DOUBLE), (0.5), (0.95)) AS t(q) GROUP BY 1, 2",
    ),
)
def a14_weighted(spark, sf):
    """Prices of the 5, 50 and 95 % of all pieces sold: groups of any size, weighted."""
    samples = d.table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice", "l_quantity")
    return quantile_bands(
        samples, "l_extendedprice", [0.05, 0.5, 0.95], keys=["l_returnflag"], weight="l_quantity"
    )


@query(
    "a13_infections_per_100k",
    "region date infections_by_100k:f infections_by_100k_lower:f infections_by_100k_upper:f "
    "infections_absolute:f infections_absolute_lower:f infections_absolute_upper:f",
    with_sql(
        PE, MASKED, OBSERVED, *CURVES, sql_hdi("nc", "new_cases", "region date", 0.75, "h"),
        "pop AS (SELECT 'R' || CAST(user_id % 5 AS VARCHAR) AS region, count(DISTINCT user_id) * 1000 AS population FROM events GROUP BY 1)",
        "SELECT m.region, m.date, med / population * 100000 AS infections_by_100k, h.lower / population * 100000 AS infections_by_100k_lower, "
        "h.upper / population * 100000 AS infections_by_100k_upper, med AS infections_absolute, h.lower AS infections_absolute_lower, "
        "h.upper AS infections_absolute_upper FROM (SELECT region, date, median(new_cases) AS med FROM nc GROUP BY 1, 2) AS m "
        "JOIN h USING (region, date) JOIN pop USING (region)",
    ),
)
def a13(spark, sf):
    curves = m10(spark, sf).withColumnRenamed("new_cases", "infections")
    users = d.table(spark, sf, "events").select("user_id").distinct()
    population = users.groupBy(
        F.concat(F.lit("R"), (F.col("user_id") % 5).cast("string")).alias("region")
    ).agg((F.count("*") * 1000).alias("population"))
    return summarize_infections(curves, population, 0.75, per_group=8)


@query(
    "a14_quantile_bands",
    "region date q:f value:f",
    with_sql(
        PE, *POSTERIOR,
        " UNION ALL ".join(
            f"SELECT region, date, {q} AS q, quantile_cont(r_t, {q}) AS value FROM post GROUP BY region, date"
            for q in (0.05, 0.25, 0.75, 0.95)
        ),
    ),
)
def a14(spark, sf):
    return quantile_bands(posterior(spark, sf), "r_t", [0.05, 0.25, 0.75, 0.95], per_group=100)


@query(
    "a14_quantile_bands_any_group_size",
    "l_returnflag q:f value:f",
    " UNION ALL ".join(
        f"SELECT l_returnflag, {q} AS q, quantile_cont(l_extendedprice, {q}) AS value FROM lineitem GROUP BY 1"
        for q in (0.05, 0.25, 0.75, 0.95)
    ),
)
def a14_any(spark, sf):
    samples = d.table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    return quantile_bands(samples, "l_extendedprice", [0.05, 0.25, 0.75, 0.95], keys=["l_returnflag"])


@query(
    "a16_scale_factor_parts",
    "region n_paths:i mean_factor:f",
    with_sql(
        PE, MASKED, OBSERVED, *FACTORS,
        "SELECT region, count(*) AS n_paths, avg(scale_factor) AS mean_factor FROM sf GROUP BY region",
    ),
)
def a16(spark, sf):
    return m09(spark, sf).groupBy("region").agg(
        F.count("*").alias("n_paths"), F.avg("scale_factor").alias("mean_factor")
    )


@query(
    "q_rt_summary",
    "region date r_t_threshold_probability:f r_t:f r_t_lower:f r_t_upper:f",
    with_sql(
        PE, *POSTERIOR, sql_hdi("post", "r_t", "region date", 0.9, "h"),
        "SELECT m.region, m.date, p AS r_t_threshold_probability, r_t, h.lower AS r_t_lower, h.upper AS r_t_upper FROM "
        "(SELECT region, date, median(r_t) AS r_t, avg(CASE WHEN r_t > 1 THEN 1.0 ELSE 0.0 END) AS p FROM post GROUP BY 1, 2) AS m "
        "JOIN h USING (region, date)",
    ),
)
def q_rt(spark, sf):
    return summarize_r_t(posterior(spark, sf), 0.9, per_group=100)


@query(
    "q_rt_summary_lists",
    "region dates percents",
    with_sql(
        PE, *POSTERIOR,
        "SELECT region, string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) AS dates, "
        "string_agg(CAST(CAST(round(p * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY date) AS percents FROM "
        "(SELECT region, date, avg(CASE WHEN r_t > 1 THEN 1.0 ELSE 0.0 END) AS p FROM post GROUP BY 1, 2) AS m GROUP BY region",
    ),
)
def q_rt_lists(spark, sf):
    lists = summary_lists(threshold_probability(posterior(spark, sf)))
    percent = F.transform("r_t_threshold_probability", lambda p: F.round(p * 100).cast("bigint").cast("string"))
    days = F.transform("date", lambda x: F.date_format(x, "yyyy-MM-dd"))
    return lists.select(
        "region", F.array_join(days, ",").alias("dates"), F.array_join(percent, ",").alias("percents")
    )
