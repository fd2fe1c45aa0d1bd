"""Slices: each group's rows, in an order, cut into stretches of bounded size.

A window over a whole pair is one task's work, however long the pair. Windows here run over
(keys, ``_slice``) instead. Slices are cut at the group's own quantiles, level by level: a slice
that is still too large gets cut points of its own, first by the first order column, then
(where a slice holds one value of it) by the next one. So bursts, ties and pairs of any
length are parted, and ordinary groups are one slice, at the cost of one counting aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleframe.session import checked_broadcast, checkpointed

#: Rows that one slice holds, about; at most twice as many.
SLICE_ROWS = 1_000_000
#: Quantiles that a level takes of a slice. Each can cut before and after its value.
FAN = 64
WIDTH = 2 * FAN
#: Levels whose slice numbers fit a long; each divides a slice of several values by FAN / 2 or more.
MOST_LEVELS = 9
#: Cut slices up to which their cut points, about 3 kB each, are broadcast.
MOST_CUT = 5_000

CONTENT = "_content"


def micros(c: str) -> Column:
    """Microseconds of a zone-less time from its own fields, whatever the session's time zone."""
    seconds = F.unix_date(F.to_date(c)) * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60
    return seconds.cast("bigint") * 1_000_000 + (F.extract(F.lit("SECOND"), F.col(c)) * 1_000_000).cast("bigint")


def _numbers(df: DataFrame, c: str) -> list[Column]:
    """Numbers that order like column ``c`` with NULLs first; none if there are no such numbers."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.TimestampNTZType):
        value = micros(c)
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(c)
    elif isinstance(kind, T.DateType):
        value = F.unix_date(c)
    elif isinstance(kind, T.NumericType):
        value = F.col(c)
    else:
        return []
    known = F.col(c).isNotNull()
    # A NULL is never parted from values by the second number, but always by the first.
    return [known.cast("int"), F.when(known, value)] if df.schema[c].nullable and not isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)) else [
        F.coalesce(value, F.lit(-(2**62)))]


def renamed_keys(keys: Sequence[str]) -> list[Column]:
    """The key columns of a small derived table under names of their own: it is joined to its origin."""
    return [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """The keys of ``left`` equal the renamed ones of ``right``; NULL equals NULL."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_k{i}"]) for i, k in enumerate(keys)])


@dataclass
class Slices:
    """How a frame's groups are cut: the cut points of each level, and the columns that order the rows."""

    keys: list[str]
    order: list[str]
    levels: list[tuple[Column, DataFrame]] = field(default_factory=list)
    by_content: bool = False

    def ordered(self, df: DataFrame) -> DataFrame:
        """``df`` with the column that decides between rows equal in ``order``, if slices were cut by it."""
        return df.withColumn(CONTENT, F.xxhash64(*[c for c in df.columns if not c.startswith("_")])) if self.by_content else df

    @property
    def order_by(self) -> list[str]:
        return [*self.order, *([CONTENT] if self.by_content else [])]

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_slice``; along a group's order, slice numbers rise."""
        out = df.withColumn("_slice", F.lit(0).cast("bigint"))
        for number, cuts in self.levels:
            same = same_keys(out, cuts, self.keys) & (out["_slice"] == cuts["_of"])
            past = _count_past(F.struct(number, F.lit(0)))
            out = out.join(cuts, same, "left").select(
                *[out[c] for c in df.columns], (out["_slice"] * WIDTH + F.coalesce(past, F.lit(0))).alias("_slice"))
        return out


def _count_past(at: Column) -> Column:
    """How many of the sorted ``_cuts`` lie at or before ``at``: a binary search."""
    steps = [WIDTH >> (i + 1) for i in range(WIDTH.bit_length() - 1)]
    return F.when(F.col("_cuts").isNotNull(), F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda found, step: found + F.when(F.coalesce(F.get("_cuts", found + step - 1) <= at, F.lit(False)), step).otherwise(0)))


def _cut_points(slice_rows: int) -> Column:
    """Of a slice's grid of quantiles, about one every ``slice_rows`` rows, as (value, 0 before it or 1 after it).

    A value that several quantiles hit is cut on both sides. There is at least one cut that
    parts the smallest value from the largest.
    """
    wanted = F.least(F.lit(FAN), F.ceil(F.col("_n") / F.lit(slice_rows))).cast("int")
    picked = F.transform(F.sequence(F.lit(1), wanted - 1), lambda i: F.element_at("_grid", F.greatest(F.lit(1), F.floor(i * FAN / wanted).cast("int"))))
    before = F.transform(F.filter(picked, lambda q: q > F.col("_low")), lambda q: F.struct(q.alias("value"), F.lit(0).alias("after")))
    repeated = F.filter(picked, lambda q, i: (q < F.col("_high")) & ((q == F.col("_low")) | (F.coalesce(F.get(picked, i + 1) == q, F.lit(False)))))
    after = F.transform(repeated, lambda q: F.struct(q.alias("value"), F.lit(1).alias("after")))
    return F.array_sort(F.array_distinct(F.concat(before, after)))


def cut_slices(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int = SLICE_ROWS, *, part_ties: bool = True
) -> Slices:
    """Cut the groups of ``df`` (by ``keys``) that hold more than ``2 * slice_rows`` rows, along ``order``.

    Each round is one aggregate over the rows of the slices still too large, merged
    map-side, with one small checkpointed row a slice. Rows equal in all of ``order`` are cut by
    a hash of their columns, which then decides their order too; rows equal in every
    column stay together, and so do ties of the rest of an ``order`` from a column on that is
    no number, date or time. ``part_ties=False`` never parts rows equal in all of ``order``.
    """
    out = Slices(list(keys), list(order))
    numbers: list[Column] = []
    for c in order:
        found = _numbers(df, c)
        numbers += found
        if not found:
            break
    part_ties = part_ties and bool(found)
    if part_ties:
        numbers.append(F.col(CONTENT))
    too_large, cut = None, False  # slices of the last round, and whether it cut them
    for i, number in enumerate(numbers):
        out.by_content = part_ties and i == len(numbers) - 1
        while True:
            rows = out.assign(out.ordered(df))
            if too_large is not None:
                at = F.floor(rows["_slice"] / WIDTH) if cut else rows["_slice"]
                rows = rows.join(checked_broadcast(too_large, 100_000), same_keys(rows, too_large, out.keys) & (at == too_large["_of"]), "left_semi")
            # Without bounds there is nothing to compare with: all groups, one narrow pass.
            stats = checkpointed(
                rows.select(*out.keys, "_slice", number.alias("_v")).groupBy(*out.keys, F.col("_slice").alias("_of")).agg(
                    F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"),
                    F.percentile_approx("_v", [q / FAN for q in range(1, FAN)]).alias("_grid"))
                .where(F.col("_n") > 2 * slice_rows))
            spread = F.col("_low") < F.col("_high")
            left, parted = stats.agg(F.count(F.lit(1)), F.count_if(spread)).first()
            if not left:
                return out
            cut = parted > 0
            too_large = stats.select(*renamed_keys(out.keys), "_of")
            if not cut:
                break
            if len(out.levels) == MOST_LEVELS:
                raise ArithmeticError(f"slices deeper than {MOST_LEVELS} levels: increase slice_rows")
            cuts = stats.where(spread).select(*renamed_keys(out.keys), "_of", _cut_points(slice_rows).alias("_cuts"))
            out.levels.append((number, checked_broadcast(cuts, MOST_CUT)))
    return out


def with_halo(rows: DataFrame, slices: Slices, before: int) -> DataFrame:
    """Rows of every slice (``_slice``) plus, marked ``_halo``, the last ``before`` rows that precede it in its group.

    A row of a slice's end goes to each later slice within reach, also past slices shorter
    than ``before``: at most ``before`` of them. ``rows`` carries ``_slice`` and the order.
    """
    if not before:
        return rows.withColumn("_halo", F.lit(0))
    keys = slices.keys
    in_group = Window.partitionBy(*keys).orderBy("_slice")
    sizes = rows.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    # Each slice with the next ones in reach: the rows between must leave room for one more.
    ahead = F.collect_list(F.struct(F.col("_slice").alias("to"), F.col("_through").alias("through"), F.col("_n").alias("n"))).over(
        in_group.rowsBetween(1, before))
    reach = checkpointed(
        sizes.withColumn("_through", F.sum("_n").over(in_group.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_ahead", ahead)
        .select(*renamed_keys(keys), F.col("_slice").alias("_from"), F.filter(F.transform(
            "_ahead", lambda a: F.struct(a["to"].alias("to"), (a["through"] - a["n"] - F.col("_through")).alias("between"))),
            lambda a: a["between"] < before).alias("_ahead"))
        .where(F.size("_ahead") > 0))
    from_end = Window.partitionBy(*keys, "_slice").orderBy(*[F.col(c).desc() for c in slices.order_by])
    ends = rows.withColumn("_end", F.row_number().over(from_end)).where(F.col("_end") <= before)
    halo = ends.join(checked_broadcast(reach), same_keys(ends, reach, keys) & (ends["_slice"] == reach["_from"])).select(
        *[ends[c] for c in rows.columns], "_end", F.explode("_ahead").alias("_a")).where(F.col("_a.between") + F.col("_end") <= before)
    halo = halo.select(*[F.col("_a.to").alias(c) if c == "_slice" else F.col(c) for c in rows.columns], F.lit(1).alias("_halo"))
    return rows.withColumn("_halo", F.lit(0)).unionByName(halo)
