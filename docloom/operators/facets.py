"""Facet counts and the filters that go with them.

Every facet is a table ``(facet, count)``. The rows counted are those for which ``hit``
holds; values that only occur elsewhere have a count of 0.
"""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Callable
from datetime import datetime
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.text import each

# Options of ``other`` and of ``include``.
OTHERS = ["before", "after", "between"]
INCLUDES = ["lower", "upper", "edge", "outer"]

# Seconds in the units of a date gap. Months and years go by the calendar.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
UNIT_MONTHS = {"month": 1, "year": 12}


def filter_query(df: DataFrame, field: str, *values: object, exclude: bool = False) -> DataFrame:
    """Rows whose ``field`` equals every one of ``values``; with ``exclude``, none of them.

    An array field equals a value when it contains it.
    """
    many = df.schema[field].dataType.typeName() == "array"
    for value in values:
        same = F.array_contains(F.col(field), value) if many else F.col(field) == value
        df = df.filter(~F.coalesce(same, F.lit(False)) if exclude else same)
    return df


def in_range(value: Column, low=None, high=None, include_low: bool = True, include_high: bool = True) -> Column:
    """Within two bounds, each with or without its end; ``None`` leaves a side open."""
    condition = value.isNotNull()
    if low is not None:
        condition = condition & (value >= low if include_low else value > low)
    if high is not None:
        condition = condition & (value <= high if include_high else value < high)
    return condition


def _counted(hit: Column | None) -> Column:
    return F.count(F.lit(1)) if hit is None else F.count_if(hit)


def facet_field(
    df: DataFrame,
    field: str,
    hit: Column | None = None,
    prefix: str = "",
    sort: str = "count",
    limit: int | None = None,
    offset: int = 0,
    mincount: int = 0,
    missing: bool = False,
) -> DataFrame:
    """Rows per value, by falling count or, with ``sort="index"``, by value.

    A row with an array counts once for each different value in it. ``missing`` adds the rows
    without a value, as facet null, last and whatever the other options.
    """
    many = df.schema[field].dataType.typeName() == "array"
    if many:
        valued = F.size(F.filter(F.col(field), lambda v: v.isNotNull())) > 0
        rows = each(df, F.array_distinct(field), *([] if hit is None else [hit.alias("_hit")]), name="_value")
        key, flag = F.col("_value").cast("string"), None if hit is None else F.col("_hit")
    else:
        valued = F.col(field).isNotNull()
        rows, key, flag = df.filter(valued), F.col(field).cast("string"), hit
    counts = rows.groupBy(key.alias("facet")).agg(_counted(flag).alias("count"))
    if prefix:
        counts = counts.filter(F.startswith(F.col("facet"), F.lit(prefix)))
    if mincount > 0:
        counts = counts.filter(F.col("count") >= mincount)
    order = [F.desc("count"), F.col("facet")] if sort == "count" else [F.col("facet")]
    counts = counts.orderBy(*order)
    if offset:
        counts = counts.offset(offset)
    if limit is not None:
        counts = counts.limit(limit)
    if missing:
        absent = df.filter(~F.coalesce(valued, F.lit(False))).agg(_counted(hit).alias("count"))
        absent = absent.select(F.lit(None).cast("string").alias("facet"), "count", F.lit(1).alias("_last"))
        both = counts.withColumn("_last", F.lit(0)).unionByName(absent)
        counts = both.orderBy("_last", *order).drop("_last")
    return counts


def facet_fields(df: DataFrame, fields: list[str], hit: Column | None = None, mincount: int = 0) -> DataFrame:
    """``(field, facet, count)`` of several fields in one pass over the rows; null values are left out."""
    pairs = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("facet")) for f in fields]
    flag = [] if hit is None else [hit.alias("_hit")]
    rows = df.select(F.inline(F.array(*pairs)), *flag).filter(F.col("facet").isNotNull())
    counts = rows.groupBy("field", "facet").agg(_counted(None if hit is None else F.col("_hit")).alias("count"))
    return counts.filter(F.col("count") >= mincount) if mincount > 0 else counts


# The edge of a range by its number: edge(0) is the start of the first, edge(size) the end of the last.
Edge = Callable[[Column], Column]


def _range_counts(
    df: DataFrame, value: Column, guess: Column, edge_of: Edge, size: int, name: Edge, include: set[str], other: set[str], hit: Column | None
) -> DataFrame:
    """Rows per range ``edge(b) .. edge(b + 1)`` and per wanted outer range, zeros included.

    ``guess`` is the number of the range a value is in, give or take one. The rows are only
    counted by range and by whether they lie exactly on its lower edge: at most two groups
    per range, so the shuffle is tiny. Which ranges an edge belongs to is settled on those
    counts afterwards. Edges are computed row by row, so any number of ranges will do.
    """
    lower, upper, edge, outer = (bool({option, "all"} & include) for option in INCLUDES)
    number = lambda n: F.lit(n).cast("long")
    near = F.greatest(number(0), F.least(number(size - 1), guess))
    step = F.when(value < edge_of(near), number(-1)).when(value >= edge_of(near + 1), number(1)).otherwise(number(0))
    place = (
        F.when(value < edge_of(number(0)), number(-1)).when(value >= edge_of(number(size)), number(size)).otherwise(near + step)
    )
    flag = F.lit(True) if hit is None else F.coalesce(hit, F.lit(False))
    placed = df.filter(value.isNotNull()).select(place.alias("b"), value.alias("v"), flag.alias("hit"))
    on_lower = F.col("v") == edge_of(F.greatest(number(0), F.col("b")))
    groups = placed.groupBy("b", on_lower.alias("on_edge")).agg(F.count_if("hit").alias("n"))

    b, on_edge = F.col("b"), F.col("on_edge")
    start, end = (b == 0) & on_edge, (b == size) & on_edge
    in_start, in_end = lower or edge, upper or edge
    member = [
        F.when((b >= 0) & (b < size) & (~on_edge | F.lit(lower) | (start & F.lit(edge))), b),
        F.when((b >= 1) & on_edge & (F.lit(upper) | (end & F.lit(edge))), b - 1),
    ]
    outside = {
        "before": (-1, (b == -1) | (start & F.lit(outer or not in_start))),
        "after": (-2, (b == size) & (~on_edge | F.lit(outer or not in_end))),
        "between": (-3, ((b >= 0) & (b < size) & (~start | F.lit(in_start))) | (end & F.lit(in_end))),
    }
    wanted = [name for name in OTHERS if {name, "all"} & other]
    member += [F.when(outside[name][1], number(outside[name][0])) for name in wanted]
    counts = each(groups, F.array(*member), "n", name="range").groupBy("range").agg(F.sum("n").alias("count"))

    ranges = df.sparkSession.range(size).select(F.col("id").alias("range"), name(F.col("id")).alias("facet"))
    if wanted:
        more = [(outside[name][0], name) for name in wanted]
        ranges = ranges.union(df.sparkSession.createDataFrame(more, "range long, facet string"))
    return ranges.join(counts, "range", "left").select("facet", F.coalesce("count", F.lit(0)).alias("count"))


def _options(include: str | list[str], other: str | list[str]) -> tuple[set[str], set[str]]:
    return tuple({o} if isinstance(o, str) else set(o) for o in (include, other))


def _checked(size: int) -> int:
    if size <= 0:
        raise ValueError("a range facet needs a start before its end and a gap above 0")
    return size


def _cut(edge_of: Edge, size: int, end: Column) -> Edge:
    """The same edges, but for the last one."""
    return lambda b: F.when(b == size, end).otherwise(edge_of(b))


def facet_range(
    df: DataFrame,
    field: str,
    start: float,
    end: float,
    gap: float,
    hardend: bool = False,
    other: str | list[str] = "none",
    include: str | list[str] = "lower",
    hit: Column | None = None,
) -> DataFrame:
    """Rows per range of width ``gap``, named by its start.

    The last range reaches beyond ``end`` if the gap does not divide the span, unless
    ``hardend`` cuts it there. ``other`` may ask for ``before``, ``after``, ``between``,
    ``all``; ``include`` says which ends belong to a range: ``lower``, ``upper``, ``edge``,
    ``outer``, ``all``.
    """
    start, end, gap = float(start), float(end), float(gap)
    size = _checked(ceil((end - start) / gap) if gap > 0 else 0)

    def edge_of(b: Column) -> Column:
        return F.lit(start) + b.cast("double") * F.lit(gap)

    value = F.col(field).cast("double")
    share = F.floor((value - F.lit(start)) / F.lit(gap)).cast("double")
    guess = F.greatest(F.lit(0.0), F.least(F.lit(float(size - 1)), share)).cast("long")
    edges = _cut(edge_of, size, F.lit(end)) if hardend else edge_of
    return _range_counts(df, value, guess, edges, size, lambda b: edge_of(b).cast("string"), *_options(include, other), hit)


def facet_date(
    df: DataFrame,
    field: str,
    start: datetime,
    end: datetime,
    gap: int,
    unit: str = "day",
    hardend: bool = False,
    other: str | list[str] = "none",
    include: str | list[str] = "lower",
    hit: Column | None = None,
) -> DataFrame:
    """As ``facet_range`` over a date field; ``unit`` runs from ``second`` to ``year``."""
    value = F.col(field).cast("timestamp_ntz")
    if unit in UNIT_MONTHS:
        step, scale = gap * UNIT_MONTHS[unit], "MONTH"
        span = (end.year - start.year) * 12 + end.month - start.month
        size = _checked(0 if gap <= 0 or end <= start else max(1, span // step))
        while _months_later(start, step * size) < end:
            size += 1
        guess = F.floor((F.year(value) * 12 + F.month(value) - (start.year * 12 + start.month)) / step)
    else:
        step, scale = gap * UNIT_SECONDS[unit], "SECOND"
        size = _checked(ceil((end - start).total_seconds() / step) if gap > 0 else 0)
        seconds = F.unix_seconds(value.cast("timestamp")) - F.unix_seconds(_ntz(start).cast("timestamp"))
        guess = F.floor(seconds / step)

    def edge_of(b: Column) -> Column:
        return F.timestamp_add(scale, b * step, _ntz(start))

    edges = _cut(edge_of, size, _ntz(end)) if hardend else edge_of
    named = lambda b: F.date_format(edge_of(b), "yyyy-MM-dd'T'HH:mm:ss")
    return _range_counts(df, value, guess.cast("long"), edges, size, named, *_options(include, other), hit)


def _months_later(start: datetime, months: int) -> datetime:
    year, month = divmod(start.year * 12 + start.month - 1 + months, 12)
    return start.replace(year=year, month=month + 1, day=min(start.day, monthrange(year, month + 1)[1]))


def _ntz(moment: datetime) -> Column:
    return F.to_timestamp_ntz(F.lit(moment.isoformat(sep=" ")))


def facet_query(df: DataFrame, conditions: dict[str, Column], hit: Column | None = None) -> DataFrame:
    """Rows for which each named condition holds. All are counted in one pass."""
    both = {name: c if hit is None else c & hit for name, c in conditions.items()}
    wide = df.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(both.values())])
    pairs = [F.struct(F.lit(name).alias("facet"), F.col(f"c{i}").alias("count")) for i, name in enumerate(both)]
    return wide.select(F.inline(F.array(*pairs)))


def facet_pivot(df: DataFrame, *fields: str, totals: bool = False) -> DataFrame:
    """Rows per combination of values. ``totals`` adds the sums over the later fields."""
    grouped = df.rollup(*fields) if totals else df.groupBy(*fields)
    return grouped.agg(F.count(F.lit(1)).alias("count"))


def as_map(facets: DataFrame) -> DataFrame:
    """Facet rows as one map: an answer format, for facets that were given a limit."""
    entries = F.array_sort(F.collect_list(F.struct("facet", "count")))
    return facets.agg(F.map_from_entries(entries).alias("counts"))


def from_map(counts: DataFrame, column: str = "counts") -> DataFrame:
    return counts.select(F.explode(column).alias("facet", "count"))


def from_pairs(counts: DataFrame, column: str = "counts") -> DataFrame:
    """Facet rows from an array of ``(facet, count)`` pairs."""
    return counts.select(F.explode(column).alias("_pair")).select(
        F.col("_pair")[0].alias("facet"), F.col("_pair")[1].cast("long").alias("count")
    )


def from_flat(counts: DataFrame, column: str = "counts") -> DataFrame:
    """Facet rows from an array in which values and counts take turns."""
    values = F.col(column)
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(values), F.lit(2)),
        lambda i: F.struct(F.get(values, i - 1).alias("facet"), F.get(values, i).cast("long").alias("count")),
    )
    return counts.filter(F.size(values) > 1).select(F.inline(pairs))


def group_top(df: DataFrame, group: str | Column, order: list[Column], rows: int = 1) -> DataFrame:
    """The first ``rows`` of every group. Each task cuts its groups before the shuffle."""
    key = F.col(group) if isinstance(group, str) else group
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= rows)
