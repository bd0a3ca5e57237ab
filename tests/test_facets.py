from __future__ import annotations

import itertools
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docloom.functions import geo
from docloom.operators import facets as A


def counts(df):
    rows = df.collect()
    assert len({r["facet"] for r in rows}) == len(rows)
    return {r["facet"]: r["count"] for r in rows}


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(-2, 14)]), rng.choice("abc"), rng.random() < 0.5) for _ in range(400)]
    return rows, spark.createDataFrame([(float(v) if v is not None else None, g, h) for v, g, h in rows], "v double, g string, hit boolean").cache()


def by_hand(values, start, end, gap, hardend, include, other):
    """The rules for every range and value, one by one."""
    include = {"lower", "upper", "edge", "outer"} if "all" in include else include
    edges = [start]
    while edges[-1] < end:
        edges.append(edges[-1] + gap)
    if hardend:
        edges[-1] = end
    last = len(edges) - 2
    found = {}
    for b, (low, high) in enumerate(zip(edges, edges[1:])):
        in_low = "lower" in include or ("edge" in include and b == 0)
        in_high = "upper" in include or ("edge" in include and b == last)
        found[str(float(start + b * gap))] = sum(
            (low < v < high) or (v == low and in_low) or (v == high and in_high) for v in values
        )
    in_start, in_end = bool({"lower", "edge"} & include), bool({"upper", "edge"} & include)
    first, final = edges[0], edges[-1]
    extra = {
        "before": sum(v < first or (v == first and ("outer" in include or not in_start)) for v in values),
        "after": sum(v > final or (v == final and ("outer" in include or not in_end)) for v in values),
        "between": sum(first < v < final or (v == first and in_start) or (v == final and in_end) for v in values),
    }
    return found | {k: n for k, n in extra.items() if {k, "all"} & other}


INCLUDES = [set(c) for n in range(5) for c in itertools.combinations(A.INCLUDES, n)] + [{"all"}]


@pytest.mark.parametrize("hardend", [False, True])
@pytest.mark.parametrize("include", INCLUDES, ids=lambda i: "+".join(sorted(i)) or "none")
def test_ranges_by_hand(values, include, hardend):
    rows, df = values
    wanted = by_hand([v for v, _, h in rows if v is not None and h], 1, 11, 4, hardend, include, {"all"})
    got = A.facet_range(df, "v", 1, 11, 4, hardend, "all", list(include), F.col("hit"))
    assert counts(got) == wanted


def test_ranges_with_a_fractional_gap(spark):
    # The edges are sums of floats, so a value such as 0.3 may lie just below its edge.
    df = spark.range(1001).select((F.col("id") / 1000).alias("v"))
    values = [i / 1000 for i in range(1001)]
    assert counts(A.facet_range(df, "v", 0, 1, 0.1)) == {
        str(0.1 * b): sum(0.1 * b <= v < 0.1 * (b + 1) for v in values) for b in range(10)
    }
    for start, end, gap in ((0, 1, 0), (0, 1, -1), (1, 1, 0.1), (2, 1, 0.1)):
        with pytest.raises(ValueError):
            A.facet_range(df, "v", start, end, gap)


def test_months_and_days(spark):
    start = datetime(2024, 1, 31)
    rows = [(start + timedelta(hours=7 * i),) for i in range(300)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = counts(A.facet_date(df, "t", datetime(2024, 1, 31), datetime(2024, 4, 30), 1, "month", other="all"))
    edges = [datetime(2024, 1, 31), datetime(2024, 2, 29), datetime(2024, 3, 31), datetime(2024, 4, 30)]
    for low, high in zip(edges, edges[1:]):
        assert got[low.isoformat()] == sum(low <= t < high for (t,) in rows)
    assert got["after"] == sum(t >= edges[-1] for (t,) in rows) and got["before"] == 0
    days = counts(A.facet_date(df, "t", datetime(2024, 2, 1), datetime(2024, 2, 8), 3, "day", hardend=True))
    assert list(days) and days["2024-02-07T00:00:00"] == sum(datetime(2024, 2, 7) <= t < datetime(2024, 2, 8) for (t,) in rows)


def test_dates_of_timestamps_with_a_zone(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:30:00' AS t UNION ALL SELECT TIMESTAMP '2024-01-01 01:00:00'")
    got = counts(A.facet_date(df, "t", datetime(2024, 1, 1), datetime(2024, 1, 1, 2), 1, "hour"))
    assert got == {"2024-01-01T00:00:00": 1, "2024-01-01T01:00:00": 1}


def test_field_facets(values):
    rows, df = values
    by_group = Counter(g for _, g, _ in rows)
    assert counts(A.facet_field(df, "g")) == by_group
    hits = Counter(g for _, g, h in rows if h and g == "a")
    only_a = counts(A.facet_field(df, "g", hit=F.col("hit") & (F.col("g") == "a")))
    assert only_a == {"a": hits["a"], "b": 0, "c": 0}
    assert set(counts(A.facet_field(df, "g", hit=F.col("g") == "a", mincount=1))) == {"a"}
    ranked = [g for g, _ in sorted(by_group.items(), key=lambda e: (-e[1], e[0]))]
    assert [r["facet"] for r in A.facet_field(df, "g", limit=2, offset=1).collect()] == ranked[1:3]
    assert [r["facet"] for r in A.facet_field(df, "g", sort="index", limit=2).collect()] == ["a", "b"]
    assert counts(A.facet_field(df, "g", prefix="b")) == {"b": by_group["b"]}
    missing = counts(A.facet_field(df, "v", missing=True, mincount=10_000))
    assert missing == {None: sum(v is None for v, _, _ in rows)}


def test_facet_forms(spark, values):
    facet = A.facet_field(values[1], "g")
    expected = counts(facet)
    assert counts(A.from_map(A.as_map(facet))) == expected
    pairs = facet.agg(F.collect_list(F.array("facet", F.col("count").cast("string"))).alias("counts"))
    assert counts(A.from_pairs(pairs)) == expected
    flat = pairs.select(F.flatten("counts").alias("counts"))
    assert counts(A.from_flat(flat)) == expected
    assert A.from_flat(spark.createDataFrame([([],)], "counts array<string>")).count() == 0


def test_sort_holds_with_and_without_a_limit(spark):
    df = spark.createDataFrame([(f"v{i % 40}",) for i in range(997) if i % 40 % 7 != i % 3] + [(None,)], "f string")
    got = [(r["facet"], r["count"]) for r in A.facet_field(df, "f", missing=True).collect()]
    assert got == sorted(got[:-1], key=lambda e: (-e[1], e[0])) + [(None, 1)]
    assert [r["facet"] for r in A.facet_field(df, "f", sort="index").collect()] == sorted(f for f, _ in got[:-1])


def test_a_row_counts_for_each_value_of_its_array(spark):
    rows = [(["a", "b", "a"], True), (["b", None], False), ([], True), (None, True), ([None], False)]
    df = spark.createDataFrame(rows, "tags array<string>, hit boolean")
    assert counts(A.facet_field(df, "tags", missing=True)) == {"a": 1, "b": 2, None: 3}
    assert counts(A.facet_field(df, "tags", hit=F.col("hit"))) == {"a": 1, "b": 1}


def test_several_fields_in_one_pass(values, plan):
    rows, df = values
    got = {(r["field"], r["facet"]): r["count"] for r in A.facet_fields(df, ["g", "hit"]).collect()}
    expected = Counter(("g", g) for _, g, _ in rows) + Counter(("hit", str(h).lower()) for _, _, h in rows)
    assert got == expected
    assert plan(A.facet_fields(df, ["g", "hit"])).count("+- Exchange") == 1


def test_any_number_of_ranges(spark):
    df = spark.range(20_000).select((F.col("id") + 0.5).alias("v"))
    got = A.facet_range(df, "v", 0, 20_000, 1, other="all")
    assert got.agg(F.sum("count"), F.min("count"), F.count("*")).first()[:] == (40_000, 0, 20_003)


def test_query_and_pivot_facets(values):
    rows, df = values
    got = counts(A.facet_query(df, {"low": F.col("v") < 3, "none": F.col("v") > 99}, hit=F.col("hit")))
    assert got == {"low": sum(h and v is not None and v < 3 for v, _, h in rows), "none": 0}
    pivot = {(r["g"], r["hit"]): r["count"] for r in A.facet_pivot(df, "g", "hit").collect()}
    assert pivot == Counter((g, h) for _, g, h in rows)
    totals = {(r["g"], r["hit"]): r["count"] for r in A.facet_pivot(df, "g", "hit", totals=True).collect()}
    assert totals[None, None] == len(rows) and totals["a", None] == sum(g == "a" for _, g, _ in rows)


def test_filter_queries(spark):
    df = spark.createDataFrame([("a", ["x"]), ("b", ["x", "y"]), (None, None)], "f string, tags array<string>")
    assert [r["f"] for r in A.filter_query(df, "f", "a").collect()] == ["a"]
    assert {r["f"] for r in A.filter_query(df, "f", "a", exclude=True).collect()} == {"b", None}
    assert {r["f"] for r in A.filter_query(df, "tags", "x", "y").collect()} == {"b"}
    assert {r["f"] for r in A.filter_query(df, "tags", "y", exclude=True).collect()} == {"a", None}


def test_groups(values, plan):
    rows, df = values
    top = A.group_top(df.filter("v IS NOT NULL"), "g", [F.desc("v"), F.col("hit")], rows=2)
    assert Counter(r["g"] for r in top.collect()) == {"a": 2, "b": 2, "c": 2}
    assert "WindowGroupLimit" in plan(top)
    halves = A.group_top(df.filter("v IS NOT NULL"), F.col("v") > 5, [F.col("v")], rows=1)
    assert sorted(r["v"] for r in halves.collect()) == [-2.0, 6.0]


def test_distances(spark):
    places = {"london": (51.5074, -0.1278), "fiji": (-17.7134, 178.065), "samoa": (-13.759, -172.1046)}
    df = spark.createDataFrame([(n, *p) for n, p in places.items()], "n string, lat double, lng double")
    lat, lng = F.col("lat"), F.col("lng")
    km = {r["n"]: r["d"] for r in df.select("n", geo.distance(lat, lng, 48.8566, 2.3522).alias("d")).collect()}
    assert km["london"] == pytest.approx(343.6, abs=1)
    over = {r["n"]: r["d"] for r in df.select("n", geo.distance(lat, lng, *places["fiji"], calc="plane").alias("d")).collect()}
    assert over["samoa"] == pytest.approx(1143, abs=15)
    near = df.filter(geo.within(lat, lng, *places["fiji"], radius=750, unit="miles"))
    assert {r["n"] for r in near.collect()} == {"fiji", "samoa"}
    with pytest.raises(ValueError):
        geo.distance(lat, lng, 0, 0, calc="other")
