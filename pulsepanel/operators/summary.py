"""Summaries of posterior draws: median, density intervals, quantile bands, probabilities.

Two exact ways compute order statistics:

* ``per_group`` given: the caller states how many samples a group has at most (chains x draws
  of a sampler). The samples of a group are sorted as one array; one shuffle.
* otherwise groups may have any size, also a third of the table. Samples are counted per value;
  the values of a large group are cut into cells of about the same number of values, at edges from
  a mergeable quantile sketch, and ranks come from cell offsets, so no task ever holds a group.

Samples may carry weights (see ``renewal.importance_weights``); ranks are then sums of weights.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_ARRAY_GROUP = 100_000
#: Distinct values up to which a group is one cell, and cells of a larger group.
CELL_VALUES, CELLS = 65_536, 256
BLOCK_ROWS = 4096
MAX_BLOCKS = 65536
#: Share of a group's weight that counts as none, as sums of weights are not exact.
NO_WEIGHT = 1e-9

REGION_DATE = ("region", "date")


def _with_cells(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct values with their cell: 0 in small groups, else the number of sketched edges below.

    The sketches of all tasks are merged per group; only large groups send their edges back.
    """
    shares = [i / CELLS for i in range(1, CELLS)]
    edges = (
        counts.groupBy(*keys)
        .agg(F.count("*").alias("_values"), F.percentile_approx("value", shares, 16 * CELLS).alias("_edges"))
        .where(F.col("_values") > CELL_VALUES)
        .select(*keys, F.sort_array(F.array_distinct("_edges")).alias("_edges"))
    )
    # a row of some 2 KB for each large group
    found = counts.join(F.broadcast(edges), list(keys), "left").withColumn("_cell", F.lit(0))
    # the number of edges below the value, by halving steps: past the end, and without edges, ``get`` is null
    for step in (1 << i for i in reversed(range(CELLS.bit_length()))):
        lower = F.get("_edges", F.col("_cell") + (step - 1)) < F.col("value")
        found = found.withColumn("_cell", F.col("_cell") + F.when(lower, step).otherwise(0))
    return found.drop("_edges")


def value_ranks(
    samples: DataFrame,
    value: str,
    keys: Sequence[str] = REGION_DATE,
    weight: str | None = None,
    quantiles: Sequence[float] | None = None,
) -> DataFrame:
    """Every distinct value of a group with its 0-based rank range [start, end), group size n and number of values.

    With ``weight`` they are sums of weights. Equal values are merged before the shuffle. Ranks inside a
    cell come from a window over (keys, cell); the offset of a cell comes from the sizes of the cells below it.
    With ``quantiles`` samples are counted per cell, and only the values of cells that hold one of them are merged
    and ranked; other cells are left out.
    """
    rows = samples.where(F.col(value).isNotNull()).select(
        *keys,
        F.col(value).cast("double").alias("value"),
        (F.lit(1) if weight is None else F.col(weight).cast("double")).alias("_n"),
    )
    if quantiles is None:
        rows = rows.groupBy(*keys, "value").agg(F.sum("_n").alias("_n"))
    celled = _with_cells(rows, keys)
    sizes = celled.groupBy(*keys, "_cell").agg(F.sum("_n").alias("_cell_n"), F.count("*").alias("_values"))
    cells = Window.partitionBy(*keys).orderBy("_cell")
    below = F.coalesce(F.sum("_cell_n").over(cells.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = Window.partitionBy(*keys)
    offsets = sizes.select(
        *keys, "_cell", "_cell_n", below.alias("_below"),
        F.sum("_cell_n").over(whole).alias("n"), F.sum("_values").over(whole).alias("n_values"),
        F.max("_cell").over(whole).alias("_last_cell"),
    )
    if quantiles is not None:
        offsets = _cells_of(offsets, quantiles, keys, weight is not None)
        wanted = offsets.where("_last_cell > 0").groupBy(*keys).agg(F.collect_set("_cell").alias("_cells"))
        # only groups of several cells have a row here; those of one are kept whole
        celled = (
            celled.join(F.broadcast(wanted), list(keys), "left")
            .where(F.coalesce(F.array_contains("_cells", F.col("_cell")), F.lit(True)))
            .groupBy(*keys, "_cell", "value")
            .agg(F.sum("_n").alias("_n"))
        )
    inside = Window.partitionBy(*keys, "_cell").orderBy("value")
    # not the running sum less the own weight: a small start would drown in a large weight
    earlier = F.coalesce(F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = celled.withColumn("_earlier", earlier).join(offsets, [*keys, "_cell"])
    start = F.col("_below") + F.col("_earlier")
    return ranked.select(
        *keys, "value", start.alias("start"), (start + F.col("_n")).alias("end"), "n", "n_values"
    )


def _cells_of(offsets: DataFrame, quantiles: Sequence[float], keys: Sequence[str], weighted: bool) -> DataFrame:
    """The cells that hold a quantile; of weighted ones also those that end or start there but for rounding."""
    upto = F.col("_below") + F.col("_cell_n")
    if weighted:
        slack = F.col("n") * (NO_WEIGHT / 1000)
        whole = Window.partitionBy(*keys)
        wanted, firsts = [], {}
        for i, q in enumerate(quantiles):
            bound = F.col("n") * (q - NO_WEIGHT)
            firsts[f"_first{i}"] = F.min(F.when(upto > bound + slack, F.col("_cell"))).over(whole)
            wanted.append((upto >= bound - slack) & (F.col("_cell") <= F.col(f"_first{i}")))
        offsets = offsets.withColumns(firsts)
    else:
        positions = [(F.col("n") - 1) * F.lit(float(q)) for q in quantiles]
        ranks = [rank for p in positions for rank in (F.floor(p), F.ceil(p))]
        wanted = [(F.col("_below") <= rank) & (rank < upto) for rank in ranks]
    # a group without a weight keeps its cells, as its quantiles are null
    any_of = reduce(lambda a, b: a | b, wanted, F.lit(False))
    return offsets.where(F.coalesce(any_of, F.lit(True)))


def _at_rank(rank: Column) -> Column:
    """Aggregate: the value whose rank range contains ``rank``."""
    inside = (F.col("start") <= rank) & (rank < F.col("end"))
    return F.max(F.when(inside, F.col("value")))


def ranked_quantiles(
    ranks: DataFrame, quantiles: Sequence[float], keys: Sequence[str] = REGION_DATE
) -> DataFrame:
    """Linearly interpolated quantiles as array column ``quantiles``."""
    parts = []
    for i, q in enumerate(quantiles):
        position = (F.col("n") - 1) * F.lit(float(q))
        low = F.floor(position)
        parts += [
            _at_rank(low).alias(f"_lo{i}"),
            _at_rank(F.ceil(position)).alias(f"_hi{i}"),
            F.max(position - low).alias(f"_w{i}"),
        ]
    found = ranks.groupBy(*keys).agg(*parts)
    values = [
        F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_w{i}")
        for i in range(len(quantiles))
    ]
    return found.select(*keys, F.array(*values).alias("quantiles"))


def ranked_hdi(ranks: DataFrame, prob: float, keys: Sequence[str] = REGION_DATE) -> DataFrame:
    """Narrowest interval spanning floor(prob * n) ranks: (keys, lower, upper).

    Each value looks up the value floor(prob * n) ranks above. Ranks are cut into blocks and the
    lookup is a running "last value seen" inside a block, so its work is linear.
    """
    reach = F.floor(F.col("n") * F.lit(float(prob)))
    block_rows = F.greatest(F.lit(BLOCK_ROWS), F.ceil(F.col("n") / MAX_BLOCKS)).cast("bigint")
    sized = ranks.withColumns({"_rows": block_rows, "_target": F.col("start") + reach, "_last": F.col("end") - 1})
    return _narrowest(sized, keys)


def _narrowest(sized: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The narrowest (value, value at ``_target``): (keys, lower, upper), from values that hold [start, _last].

    A value stands in each block of ``_rows`` that it reaches into, a lookup in the block of its target.
    """
    block = F.sequence(*[F.floor(F.col(c) / F.col("_rows")).cast("bigint") for c in ("start", "_last")])
    none = F.lit(None).cast("double")
    spans = F.transform(
        block,
        lambda b: F.struct(
            b.alias("_block"),
            F.greatest(F.col("start").cast("double"), (b * F.col("_rows")).cast("double")).alias("_rank"),
            F.lit(0).alias("_kind"),
            F.col("value").alias("_seen"),
            none.alias("lower"),
        ),
    )
    probe = F.struct(
        F.floor(F.col("_target") / F.col("_rows")).cast("bigint").alias("_block"),
        F.col("_target").cast("double").alias("_rank"),
        F.lit(1).alias("_kind"),
        none.alias("_seen"),
        F.col("value").alias("lower"),
    )
    events = F.when(F.col("_target") < F.col("n"), F.concat(spans, F.array(probe))).otherwise(spans)
    each = sized.select(*keys, F.explode(events).alias("_e")).select(*keys, "_e.*")
    w = Window.partitionBy(*keys, "_block").orderBy("_rank", "_kind", "_seen")
    upper = F.last("_seen", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    pairs = each.withColumn("upper", upper).where("_kind = 1")
    best = F.min(F.struct((F.col("upper") - F.col("lower")).alias("width"), "lower", "upper"))
    return pairs.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.lower", "_b.upper")


def weighted_quantiles(
    ranks: DataFrame, quantiles: Sequence[float], keys: Sequence[str] = REGION_DATE
) -> DataFrame:
    """The least value up to which there is so much of the weight, for each quantile, as ``quantiles``."""
    found = [F.min(F.when(F.col("end") > F.col("n") * (q - NO_WEIGHT), F.col("value"))) for q in quantiles]
    return ranks.groupBy(*keys).agg(F.array(*found).alias("quantiles"))


def weighted_hdi(ranks: DataFrame, prob: float, keys: Sequence[str] = REGION_DATE) -> DataFrame:
    """Narrowest interval that holds a share ``prob`` of the weight, both ends included: (keys, lower, upper).

    The same lookup as in ``ranked_hdi``, in blocks of equal weight.
    """
    share = F.col("n") * (prob - NO_WEIGHT)
    blocks = F.least(F.ceil(F.col("n_values") / BLOCK_ROWS), F.lit(MAX_BLOCKS))
    sized = ranks.where("end > start").withColumns(
        {"_rows": F.col("n") / blocks, "_target": F.col("start") + share, "_last": F.col("end")}
    )
    return _narrowest(sized, keys)


def _sorted_groups(samples: DataFrame, value: str, keys: Sequence[str], per_group: int) -> DataFrame:
    if per_group > MAX_ARRAY_GROUP:
        raise ValueError(f"per_group may be at most {MAX_ARRAY_GROUP}; leave it out beyond that.")
    return (
        samples.where(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.col(value).cast("double"))).alias("_v"))
    )


def _array_quantile(q: float) -> Column:
    position = (F.size("_v") - 1) * F.lit(float(q))
    low = F.floor(position).cast("int")
    lo = F.get("_v", low)
    hi = F.get("_v", F.ceil(position).cast("int"))
    return lo + (hi - lo) * (position - low)


def _array_hdi(prob: float) -> Column:
    reach = F.floor(F.size("_v") * F.lit(float(prob))).cast("int")
    starts = F.slice("_v", F.lit(1), F.size("_v") - reach)
    ends = F.slice("_v", reach + 1, F.size("_v") - reach)
    pairs = F.zip_with(
        starts,
        ends,
        lambda lo, hi: F.struct((hi - lo).alias("width"), lo.alias("lower"), hi.alias("upper")),
    )
    return F.array_min(pairs)


def _interval_names(prefix: str, hdi_prob: float | Iterable[float]) -> list[tuple[float, str, str]]:
    if isinstance(hdi_prob, (int, float)):
        return [(float(hdi_prob), f"{prefix}_lower", f"{prefix}_upper")]
    return [(float(p), f"{prefix}_lower_{p}", f"{prefix}_upper_{p}") for p in hdi_prob]


def summarize_median_and_hdi(
    samples: DataFrame,
    value: str,
    prefix: str,
    hdi_prob: float | Iterable[float] = 0.9,
    *,
    keys: Sequence[str] = REGION_DATE,
    per_group: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Median and highest-density interval(s) per group.

    Columns ``prefix``, ``prefix_lower``, ``prefix_upper``; with several probabilities one
    ``prefix_lower_<p>``/``prefix_upper_<p>`` pair each. With ``weight`` both are of the weighted samples.
    """
    intervals = _interval_names(prefix, hdi_prob)
    if per_group is not None and weight is None:
        grouped = _sorted_groups(samples, value, keys, per_group).withColumns(
            {f"_h{i}": _array_hdi(p) for i, (p, _, _) in enumerate(intervals)}
        )
        bounds = []
        for i, (_, lower, upper) in enumerate(intervals):
            bounds += [F.col(f"_h{i}.lower").alias(lower), F.col(f"_h{i}.upper").alias(upper)]
        return grouped.select(*keys, _array_quantile(0.5).alias(prefix), *bounds)
    ranks = value_ranks(samples, value, keys, weight)
    quantiles, interval = (ranked_quantiles, ranked_hdi) if weight is None else (weighted_quantiles, weighted_hdi)
    result = quantiles(ranks, [0.5], keys).select(*keys, F.col("quantiles")[0].alias(prefix))
    for p, lower, upper in intervals:
        hdi = interval(ranks, p, keys).select(
            *keys, F.col("lower").alias(lower), F.col("upper").alias(upper)
        )
        result = result.join(hdi, list(keys))
    return result


def threshold_probability(
    samples: DataFrame,
    value: str = "r_t",
    threshold: float = 1.0,
    keys: Sequence[str] = REGION_DATE,
    weight: str | None = None,
) -> DataFrame:
    """Share of samples (or of their weight) above the threshold per group; pass fewer keys to pool more."""
    above = (F.col(value) > threshold).cast("double")
    share = F.avg(above)
    if weight is not None:
        share = F.try_divide(F.sum(above * F.col(weight)), F.sum(F.when(above.isNotNull(), F.col(weight))))
    return samples.groupBy(*keys).agg(share.alias(f"{value}_threshold_probability"))


def summarize_r_t(
    samples: DataFrame,
    hdi_prob: float | Iterable[float] = 0.9,
    *,
    keys: Sequence[str] = REGION_DATE,
    per_group: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Probability of R > 1, median and interval(s) of R(t) per region and date."""
    probability = threshold_probability(samples, "r_t", 1.0, keys, weight)
    summary = summarize_median_and_hdi(
        samples, "r_t", "r_t", hdi_prob, keys=keys, per_group=per_group, weight=weight
    )
    return probability.join(summary, list(keys))


def summarize_infections(
    samples: DataFrame,
    region_dim: DataFrame,
    hdi_prob: float | Iterable[float] = 0.9,
    *,
    value: str = "infections",
    keys: Sequence[str] = REGION_DATE,
    per_group: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Median and interval(s) of infections, absolute and per 100,000 inhabitants.

    Scaling keeps the order of the samples, so the absolute summary is divided afterwards.
    """
    absolute = summarize_median_and_hdi(
        samples, value, "infections_absolute", hdi_prob, keys=keys, per_group=per_group, weight=weight
    )
    names = [c for c in absolute.columns if c not in keys]
    per_100k = {
        c.replace("infections_absolute", "infections_by_100k"):
        F.try_divide(F.col(f"`{c}`"), F.col("population")) * 100_000
        for c in names
    }
    joined = absolute.join(region_dim.select("region", "population"), "region", "left")
    return joined.select(
        *keys, *[e.alias(n) for n, e in per_100k.items()], *[F.col(f"`{c}`") for c in names]
    )


def quantile_bands(
    samples: DataFrame,
    value: str,
    quantiles: Sequence[float],
    *,
    keys: Sequence[str] = REGION_DATE,
    per_group: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Quantiles of every group in long form: (keys, q, value)."""
    if weight is not None:
        grouped = weighted_quantiles(value_ranks(samples, value, keys, weight, quantiles), quantiles, keys)
    elif per_group is not None:
        grouped = _sorted_groups(samples, value, keys, per_group).select(
            *keys, F.array(*[_array_quantile(q) for q in quantiles]).alias("quantiles")
        )
    else:
        grouped = ranked_quantiles(value_ranks(samples, value, keys, quantiles=quantiles), quantiles, keys)
    levels = F.array(*[F.lit(float(q)) for q in quantiles])
    return grouped.select(
        *keys, F.explode(F.arrays_zip(levels.alias("q"), F.col("quantiles").alias("value"))).alias("z")
    ).select(*keys, "z.*")


def summary_lists(summary: DataFrame, keys: Sequence[str] = ("region",)) -> DataFrame:
    """Summary rows of a series as date-ordered lists, one row per series, for export.

    A list is as long as the calendar.
    """
    names = [c for c in summary.columns if c not in keys]
    entry = F.struct("date", *[F.col(f"`{c}`") for c in names if c != "date"])
    packed = summary.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    return packed.select(*keys, *[F.col(f"_e.`{c}`").alias(c) for c in names])


def countries_by_zone(countries: DataFrame, zones: DataFrame) -> DataFrame:
    """Countries of every zone as a sorted list; zones without a country have an empty one."""
    return (
        zones.join(countries, "zone", "left")
        .groupBy("zone")
        .agg(F.sort_array(F.collect_set("alpha2")).alias("countries"))
    )
