"""Exact linear-interpolation quantiles, per group or over everything, at any group size.

Which way is taken follows from the measured sizes. Values of small groups travel packed, one array per
group, feature and map task, all groupings in one shuffle. Where a group is larger, its values are sorted
by the shuffle and the wanted ranks kept, and a table of bounded size takes Spark's `percentile`. Either
would put a hot group in one task, so hot groups are narrowed instead.
Each pass keeps, per group and feature, exact counts around the current bracket and a sketch of a
bounded random sample of the values strictly inside it; the next bracket is read off the sketch.
Runs of equal values end up on a bracket edge, where they are counted and not collected. When few
values remain inside, they are sorted and the wanted order statistics are taken. The sample only
proposes brackets: every value is counted in every pass, the counts prove that the bracket holds the
wanted ranks (a bracket that misses is widened), so the answer is exact and no task ever holds a
group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.expressions import col, finite
from plumbline.operators.groups import (
    GROUP_CELLS, GroupSizes, all_present, attach_small, by_grouping, fits_broadcast, groupings_sizes, SPREAD,
)
from plumbline.session import materialize

# Groups of at most so many cells are packed; Spark holds up to 128 of them side by side in a task.
PACKED_CELLS = 50_000
GRID_STEPS = 1000
SKETCH_ACCURACY = 10_000
# Values per group, feature and pass that go into a sketch.
SKETCH_VALUES = 1_000_000
# A pass keeps about a hundredth of a bracket; so many mean a fault, not more data.
MAX_PASSES = 60
# Values one bracket may hold when it is finally sorted.
FINAL_VALUES = 200_000
_INF = float("inf")


def q_col(feature: str) -> str:
    return f"__q__{feature}"


def n_col(feature: str) -> str:
    return f"__n__{feature}"


@dataclass(frozen=True)
class GroupStats:
    """Per-group counts (`n_col`) and quantile arrays (`q_col`), hot groups kept apart."""

    sizes: GroupSizes
    cold: DataFrame
    hot: DataFrame | None
    row_bytes: int

    @property
    def table(self) -> DataFrame:
        return self.cold if self.hot is None else self.cold.unionByName(self.hot)


def group_quantiles(
    df: DataFrame, by: Sequence[str], features: Sequence[str], probs: Sequence[float],
    cells: int = GROUP_CELLS, final_values: int = FINAL_VALUES,
) -> GroupStats:
    """Count and quantiles of every feature within every group of ``by``; missing values ignored."""
    return groupings_quantiles(df, [by], features, probs, cells, final_values)[0]


def groupings_quantiles(
    df: DataFrame, groupings: Sequence[Sequence[str]], features: Sequence[str], probs: Sequence[float],
    cells: int = GROUP_CELLS, final_values: int = FINAL_VALUES,
) -> list[GroupStats]:
    """``group_quantiles`` of several groupings, which share the pass over the rows and the shuffle."""
    groupings, features = [list(by) for by in groupings], list(features)
    sizes = groupings_sizes(df, groupings, len(features), cells)
    keys = dict.fromkeys(c for by in groupings for c in by)
    rows = df.select(*[col(c) for c in keys], *[finite(col(f)).alias(f) for f in features])
    for i, (by, size) in enumerate(zip(groupings, sizes)):
        if size.n_hot:
            rows = attach_small(rows, size.hot.withColumn(f"__hot{i}", F.lit(True)), by, size.n_hot, 64)
    is_hot = [F.col(f"__hot{i}").isNotNull() if s.n_hot else F.lit(False) for i, s in enumerate(sizes)]
    packed = [i for i, s in enumerate(sizes) if s.largest * len(features) <= PACKED_CELLS]
    row_bytes = 64 + len(features) * (40 + 8 * len(probs))
    cold: dict[int, DataFrame] = {}
    if packed:
        found, names = _by_packing(
            rows, [groupings[i] for i in packed], features, probs, [~is_hot[i] for i in packed])
        for place, i in enumerate(packed):
            cold[i] = found.where(F.col("__grouping") == place).drop(
                "__grouping", *[c for c in names if c not in groupings[i]])
    out = []
    for i, (by, size) in enumerate(zip(groupings, sizes)):
        own = rows.where(all_present(by)).select(*[col(c) for c in by], *[col(f) for f in features],
                                                 is_hot[i].alias("__is_hot"))
        if i not in cold:
            cold[i] = _by_sorting(own.where(~F.col("__is_hot")).drop("__is_hot"), by, features, probs)
        hot = _by_narrowing(own.where(F.col("__is_hot")).drop("__is_hot"), by, features, probs, size.n_hot,
                            size.n_hot_rows, final_values) if size.n_hot else None
        out.append(GroupStats(size, cold[i], hot, row_bytes))
    return out


def _by_packing(rows, groupings, features, probs, taken) -> tuple[DataFrame, list[str]]:
    """Each group's values of a feature in one sorted array; one shuffle for all groupings.

    With several groupings the result is written, so that taking one of them does not repeat the rest.
    """
    expanded, keys = by_grouping(rows, groupings, features, taken)
    packed = expanded.groupBy("__grouping", *[col(c) for c in keys]).agg(
        *[F.sort_array(F.collect_list(col(f))).alias(f) for f in features])

    def at(feature, prob):
        values = col(feature)
        exact = F.lit(float(prob)) * (F.size(values) - 1).cast("double")
        low, high = (F.get(values, rank(exact).cast("int")) for rank in (F.floor, F.ceil))
        return F.when(low == high, low).otherwise(
            (F.ceil(exact) - exact) * low + (exact - F.floor(exact)) * high)

    found = packed.select("__grouping", *[col(c) for c in keys], *[c for f in features for c in (
        F.size(col(f)).cast("bigint").alias(n_col(f)),
        F.when(F.size(col(f)) > 0, F.array(*[at(f, p) for p in probs])).alias(q_col(f)))])
    return (materialize(found, "group-stats") if len(groupings) > 1 else found), keys


def column_quantiles(
    df: DataFrame, features: Sequence[str], probs: Sequence[float],
    cells: int = GROUP_CELLS, final_values: int = FINAL_VALUES, n_rows: int | None = None,
) -> dict[str, tuple[int, list[float] | None]]:
    """Count and quantiles of each column over all rows, as plain numbers (one row per feature).

    Pass ``n_rows`` when the row count is known already; it only chooses between the two methods.
    """
    features = list(features)
    rows = df.select(*[finite(col(f)).alias(f) for f in features])
    n_rows = rows.count() if n_rows is None else n_rows
    if n_rows * len(features) <= cells:
        found = rows.agg(*_aggregates(features, probs)).first()
    else:
        everything = rows.select(F.lit(0).alias("__all"), "*")
        found = _by_narrowing(
            everything, ["__all"], features, probs, 1, n_rows, final_values).first()
    return {f: (found[n_col(f)], found[q_col(f)]) for f in features}


def _aggregates(features: Sequence[str], probs: Sequence[float]) -> list[Column]:
    return [
        agg for f in features for agg in (
            F.count(col(f)).alias(n_col(f)), F.percentile(col(f), list(probs)).alias(q_col(f)))
    ]


def _by_sorting(rows, by, features, probs) -> DataFrame:
    """Sort each group's values of a feature in the shuffle and keep the wanted ranks.

    The sort and the count over a group spill to disk, so no group has to fit in memory.
    """
    cells = rows.unpivot([col(c) for c in by], [col(f) for f in features], "__feature", "__v")
    # A group whose values are all missing still has its row of counts.
    group = Window.partitionBy(*[col(c) for c in by], "__feature")
    placed = cells.withColumn("__n", F.count("__v").over(group)).withColumn(
        "__at", F.row_number().over(group.orderBy(F.col("__v").asc_nulls_last())) - 1)
    last = (F.col("__n") - 1).cast("double")
    position = [F.lit(float(p)) * last for p in probs]

    def at(rank):
        return F.max(F.when((F.col("__at") == rank) & (F.col("__at") < F.col("__n")), F.col("__v")))

    wanted = F.lit(False)
    for p in position:
        wanted = wanted | (F.col("__at") == F.floor(p)) | (F.col("__at") == F.ceil(p))
    found = placed.where(wanted | (F.col("__at") == 0)).groupBy(*[col(c) for c in by], "__feature").agg(
        F.first("__n").alias("n"),
        *[c for i, p in enumerate(position) for c in (
            at(F.floor(p)).alias(f"low{i}"), at(F.ceil(p)).alias(f"high{i}"))])

    def between(i, prob):
        exact = F.lit(float(prob)) * (F.col("n") - 1).cast("double")
        low, high = F.col(f"low{i}"), F.col(f"high{i}")
        return F.when(low == high, low).otherwise(
            (F.ceil(exact) - exact) * low + (exact - F.floor(exact)) * high)

    values = F.when(F.col("n") > 0, F.array(*[between(i, p) for i, p in enumerate(probs)]))
    return _wide(found.select(
        *[col(c) for c in by], "__feature", F.struct("n", values.alias("q")).alias("found")), by, features)


def _wide(found: DataFrame, by, features) -> DataFrame:
    """One row per group from one row per group and feature."""
    wide = found.groupBy(*[col(c) for c in by]).agg(
        F.map_from_entries(F.collect_list(F.struct("__feature", "found"))).alias("by_feature"))

    def of(feature):
        return F.try_element_at("by_feature", F.lit(feature))

    return wide.select(
        *[col(c) for c in by],
        *[c for f in features for c in (
            F.coalesce(of(f).getField("n"), F.lit(0)).cast("bigint").alias(n_col(f)),
            of(f).getField("q").alias(q_col(f)))])


def _by_narrowing(rows, by, features, probs, n_groups, n_rows, final_values) -> DataFrame:
    """Bracket every (group, feature, quantile) and narrow until few values are left inside."""
    values = (
        rows.unpivot([col(c) for c in by], [col(f) for f in features], "__feature", "__v")
        .where(F.col("__v").isNotNull())
    )
    key = [*by, "__feature"]
    which = range(len(probs))
    state_rows, state_bytes = n_groups * len(features), 96 + 48 * len(probs)

    def narrowed(counted, bracket_of):
        return materialize(counted.select(
            *[col(c) for c in key], "n",
            *[c for i in which for c in _next_bracket(i, probs[i], bracket_of(i))]), "brackets")

    # Before any bracket exists, sample every group at the rate that suits the average one.
    share = min(1.0, SKETCH_VALUES * n_groups / max(1, n_rows))
    first = values.withColumn("__u", F.rand(_SEED)).groupBy(*[col(c) for c in key]).agg(
        F.count(F.lit(1)).alias("n"),
        _sketch(F.when(F.col("__u") < share, F.col("__v"))).alias("grid"))
    whole = {"lo": F.lit(-_INF), "hi": F.lit(_INF), "base": F.lit(0), "inside": F.col("n"),
             "grid": F.col("grid"), "share": F.lit(share), "slack": F.lit(1.0), "held": F.lit(True)}
    state, passes = narrowed(first, lambda i: whole), 0
    while state.agg(F.max(F.greatest(F.lit(0), *[F.col(f"left{i}") for i in which]))).first()[0] \
            > final_values:
        passes += 1
        if passes > MAX_PASSES:
            raise RuntimeError(f"quantile brackets are not narrow after {MAX_PASSES} passes")
        counted = _count_in_brackets(
            values.withColumn("__u", F.rand(_SEED + passes)), state, key, which, state_rows,
            state_bytes, sketch=True)
        state = narrowed(counted, lambda i: _seen(i, probs[i]))

    last = _count_in_brackets(values, state, key, which, state_rows, state_bytes, sketch=False)
    found = last.select(
        *[col(c) for c in by], "__feature",
        F.struct(F.col("n"), F.array(*[_pick(i, probs[i]) for i in which]).alias("q")).alias("found"),
    )
    return materialize(_wide(found, by, features), "quantiles")


_SEED = 20


def _sketch(value: Column) -> Column:
    steps = [i / GRID_STEPS for i in range(GRID_STEPS + 1)]
    return F.percentile_approx(value, steps, SKETCH_ACCURACY)


def _ranks(prob: float) -> tuple[Column, Column, Column]:
    position = F.lit(float(prob)) * (F.col("n") - F.lit(1)).cast("double")
    return position, F.floor(position), F.ceil(position)


def _next_bracket(i: int, prob: float, seen: dict[str, Column]) -> list[Column]:
    """Edges around the wanted ranks, read off the sketch, and how many values may lie between.

    The margin covers the grid step, the sketch error and four standard errors of the sample. A
    bracket whose counts do not hold the wanted ranks, or whose sample came out empty, starts over
    with twice the margin.
    """
    _, low_rank, high_rank = _ranks(prob)
    held = seen["held"] & (seen["grid"].isNotNull() | (seen["inside"] == 0))
    inside = F.greatest(seen["inside"], F.lit(1)).cast("double")
    steps = F.lit(float(GRID_STEPS))
    sampled = F.greatest(inside * seen["share"], F.lit(1.0))
    error = F.when(seen["share"] < 1.0, F.lit(2.0) / F.sqrt(sampled)).otherwise(F.lit(0.0))
    margin = seen["slack"] * (error + F.lit(1.0 / GRID_STEPS + 4.0 / SKETCH_ACCURACY))
    from_step = F.floor(((low_rank - seen["base"]) / inside - margin) * steps)
    to_step = F.ceil(((high_rank - seen["base"]) / inside + margin) * steps)
    lo = F.when(from_step < 0, seen["lo"]).otherwise(
        F.get(seen["grid"], F.least(from_step, F.lit(GRID_STEPS)).cast("int")))
    hi = F.when(to_step > GRID_STEPS, seen["hi"]).otherwise(
        F.get(seen["grid"], F.greatest(to_step, F.lit(0)).cast("int")))
    width = (F.least(to_step, F.lit(GRID_STEPS)) - F.greatest(from_step, F.lit(0))).cast("double")
    left = F.when(~held, F.col("n").cast("double")).when(seen["inside"] == 0, F.lit(0.0)).otherwise(
        F.greatest((width / steps + margin) * inside, F.lit(0.0)))
    return [
        F.when(~held, F.lit(-_INF)).when(seen["inside"] == 0, seen["lo"]).otherwise(lo).alias(f"lo{i}"),
        F.when(~held, F.lit(_INF)).when(seen["inside"] == 0, seen["hi"]).otherwise(hi).alias(f"hi{i}"),
        left.alias(f"left{i}"),
        F.when(held, F.lit(1.0)).otherwise(F.least(seen["slack"] * 2, F.lit(64.0))).alias(f"slack{i}"),
        F.least(F.lit(1.0), F.lit(float(SKETCH_VALUES)) / F.greatest(left, F.lit(1.0)))
        .alias(f"share{i}"),
    ]


def _count_in_brackets(values, state, key, which, state_rows, state_bytes, sketch) -> DataFrame:
    joined = attach_small(values, state, key, state_rows, state_bytes, "inner")
    v = F.col("__v")
    aggregates = [F.first("n").alias("n")]
    for i in which:
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        strictly = F.when((v > lo) & (v < hi), v)
        aggregates += [F.first(f"{c}{i}").alias(f"{c}{i}") for c in ("lo", "hi", "slack", "share")]
        aggregates += [
            F.count_if(v < lo).alias(f"below{i}"),
            F.count_if(v == lo).alias(f"at_lo{i}"),
            F.count_if((v == hi) & (hi > lo)).alias(f"at_hi{i}"),
            F.count(strictly).alias(f"inside{i}"),
            _sketch(F.when(F.col("__u") < F.col(f"share{i}"), strictly)).alias(f"grid{i}")
            if sketch
            else F.sort_array(F.collect_list(strictly)).alias(f"values{i}"),
        ]
    return joined.groupBy(*[col(c) for c in key]).agg(*aggregates)


def _held(i: int, prob: float) -> Column:
    _, low_rank, high_rank = _ranks(prob)
    through = F.col(f"below{i}") + F.col(f"at_lo{i}") + F.col(f"inside{i}") + F.col(f"at_hi{i}")
    return (F.col(f"below{i}") <= low_rank) & (high_rank < through)


def _seen(i: int, prob: float) -> dict[str, Column]:
    return {
        "lo": F.col(f"lo{i}"), "hi": F.col(f"hi{i}"), "slack": F.col(f"slack{i}"),
        "share": F.col(f"share{i}"),
        "base": F.col(f"below{i}") + F.col(f"at_lo{i}"), "inside": F.col(f"inside{i}"),
        "grid": F.col(f"grid{i}"), "held": _held(i, prob),
    }


def _pick(i: int, prob: float) -> Column:
    position, low_rank, high_rank = _ranks(prob)
    base = F.col(f"below{i}") + F.col(f"at_lo{i}")

    def at(rank):
        return (
            F.when(rank < base, F.col(f"lo{i}"))
            .when(rank < base + F.col(f"inside{i}"),
                  F.get(F.col(f"values{i}"), (rank - base).cast("int")))
            .otherwise(F.col(f"hi{i}")))

    low, high = at(low_rank), at(high_rank)
    between = (high_rank - position) * low + (position - low_rank) * high
    return F.when(~_held(i, prob), F.raise_error(F.lit("quantile bracket lost its rank"))) \
        .when(low == high, low).otherwise(between)


def attach_group_stats(df: DataFrame, stats: GroupStats) -> DataFrame:
    """Left-join group statistics to the rows of ``df``, adding the `n_col` and `q_col` columns.

    Few groups: broadcast, no shuffle. Many groups: one shuffle on the key. Rows of hot groups take
    their statistics from a broadcast of the hot table and carry a salt that matches nothing in the
    shuffle join, which spreads them evenly over its tasks.
    """
    sizes, by = stats.sizes, list(stats.sizes.by)
    if fits_broadcast(sizes.n_groups, stats.row_bytes):
        return df.join(F.broadcast(stats.table), by, "left")
    if stats.hot is not None and not fits_broadcast(sizes.n_hot, stats.row_bytes):
        return attach_small(df, stats.table, by, sizes.n_groups, stats.row_bytes)
    payload = [c for c in stats.cold.columns if c not in by]
    spread = F.lit(1) + F.pmod(F.xxhash64(*[
        col(f.name) for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")
    ]), F.lit(SPREAD)).cast("int")
    # Rows without a key match nothing either, so they are spread as well.
    marked = df.withColumn("__salt", F.when(all_present(by), F.lit(0)).otherwise(spread))
    if stats.hot is not None:
        hot = stats.hot.select(
            *[col(c) for c in by], F.struct(*[col(c) for c in payload]).alias("__hot"))
        marked = marked.join(F.broadcast(hot), by, "left").withColumn(
            "__salt", F.when(F.col("__hot").isNull(), F.col("__salt")).otherwise(spread))
    # Always 0, but no constant: that would be taken out of the join's keys, and the salt would not spread.
    zero = F.pmod(F.hash(*[col(c) for c in by]), F.lit(1))
    joined = marked.join(stats.cold.withColumn("__salt", zero).hint("merge"), [*by, "__salt"], "left")
    if stats.hot is None:
        return joined.drop("__salt")
    return joined.select(
        *[col(c) for c in df.columns],
        *[F.coalesce(F.col("__hot").getField(c), col(c)).alias(c) for c in payload])
