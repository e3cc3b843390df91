"""Building blocks against brute force, with hot and NULL keys."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import rows
from stocktake.operators import dedup, joins, rates
from stocktake.operators.sequence import global_sequence


@pytest.fixture(scope="module")
def skewed(spark):
    """3 000 rows: a third under one key, a sixth under no key, ties in the order column."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 6 == 1, None).otherwise(n % 400 + 100)
    df = spark.range(3000).select(
        key.cast("int").alias("k"),
        F.when(n % 11 == 0, None).otherwise((n * 37) % 50).cast("int").alias("o"),
        n.cast("string").alias("id"),
        (n % 13).cast("int").alias("v"),
    )
    return df.repartition(6, "id").cache()


def grouped(df):
    groups = defaultdict(list)
    for r in df.collect():
        groups[r["k"]].append(r)
    return groups


def test_keep_latest_matches_brute_force(skewed):
    expected = []
    for k, group in grouped(skewed).items():
        best = max(group, key=lambda r: (r["o"] is not None, r["o"] or 0, [-ord(c) for c in r["id"].ljust(8, " ")]))
        expected.append((k, best["o"], best["id"], best["v"]))
    got = dedup.keep_latest(skewed, ["k"], "o", ties=["id"])
    assert {tuple(r) for r in got.collect()} == set(expected)
    assert got.filter("k is null").count() == 1


def test_keep_first_matches_brute_force(skewed):
    expected = set()
    for k, group in grouped(skewed).items():
        best = min(group, key=lambda r: (r["o"] is None, r["o"] or 0, r["id"]))
        expected.add((k, best["o"], best["id"], best["v"]))
    assert {tuple(r) for r in dedup.keep_first(skewed, ["k"], "o", ties=["id"]).collect()} == expected


def test_last_with_count_matches_brute_force(skewed):
    expected = set()
    for k, group in grouped(skewed).items():
        best = max(group, key=lambda r: (r["o"] is not None, r["o"] or 0, r["id"]))
        expected.add((k, best["v"], best["o"], len(group)))
    got = dedup.last_with_count(skewed, ["k"], ["o", "id"], ["v", "o"], "n")
    assert {tuple(r) for r in got.collect()} == expected


def test_hot_keys_are_reduced_before_the_shuffle(skewed, plan):
    picked = plan(dedup.keep_first(skewed, ["k"], "o", ties=["id"]))
    assert "Partial" in picked and "WindowGroupLimit" in picked
    assert "partial_max" in plan(dedup.last_with_count(skewed, ["k"], ["o"], ["v"], "n"))
    assert plan(dedup.distinct_rows(skewed)).count("HashAggregate") == 2


def test_hot_key_shuffles_one_row_per_task(spark, skewed):
    """What leaves the map side for the hot key is bounded by the number of tasks."""
    ranked = dedup.keep_first(skewed, ["k"], "o", ties=["id"])
    ranked.collect()
    limits = _metrics(ranked, "WindowGroupLimit")
    partial = max(limits)  # the map side keeps the most rows
    keys = skewed.select("k").distinct().count()
    assert partial <= keys * 6
    assert partial < skewed.count()


def _metrics(df, name):
    """Output rows of the executed operators of that name."""
    found = []

    def visit(node):
        if node.nodeName() == name and node.metrics().contains("numOutputRows"):
            found.append(node.metrics().apply("numOutputRows").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            visit(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            visit(node.plan())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(df._jdf.queryExecution().executedPlan())
    return found


@pytest.fixture(scope="module")
def partner(spark):
    return spark.createDataFrame([(7, "a"), (101, "b"), (103, "c"), (None, "d"), (9999, "e")], "k int, w string")


def test_left_lookup_keeps_all_rows(skewed, partner):
    named = {k: w for k, w in partner.collect() if k is not None}
    expected = Counter((r["k"], r["id"], named.get(r["k"])) for r in skewed.collect())
    assert Counter(map(tuple, joins.left_lookup(skewed, partner, ["k"]).select("k", "id", "w").collect())) == expected


def test_unmatched_and_matched_split_the_rows(skewed, partner):
    keys = {k for k, _ in partner.collect() if k is not None}
    everything = {r["id"]: r["k"] for r in skewed.collect()}
    out = {r["id"] for r in joins.unmatched(skewed, partner, ["k"], scatter_by=["id"]).collect()}
    inside = [r["id"] for r in joins.matched(skewed, partner.unionByName(partner), ["k"]).collect()]
    assert out == {i for i, k in everything.items() if k not in keys}
    assert sorted(inside) == sorted(i for i, k in everything.items() if k in keys)


def test_null_keys_spread_over_tasks(spark, skewed, partner):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = joins.left_lookup(skewed, partner, ["k"], scatter_by=["id"])
        tasks = joined.filter("k is null").select(F.spark_partition_id()).distinct().count()
        assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_adaptive_execution_splits_a_hot_key(spark):
    """The fact's join shape: a hot key on the left, an aggregate on the right."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = F.col("id")
        left = spark.range(0, 60000, 1, 6).select(
            F.when(n % 3 == 0, 7).otherwise(n).alias("k"), F.sha2(n.cast("string"), 256).alias("x")
        )
        right = spark.range(0, 5000, 1, 6).select((n % 1000).alias("k"), n.alias("o"))
        last = dedup.last_with_count(right, ["k"], ["o"], ["o"], "n")
        joined = joins.left_lookup(left, last, ["k"], scatter_by=["x"])
        assert joined.count() == 60000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.filter("k = 7 and n = 5").count() == left.filter("k = 7").count()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_known_or_default(spark):
    df = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, area int")
    dim = spark.createDataFrame([(10,), (10,), (20,)], "area_id int")
    assert rows(joins.known_or_default(df, "area", dim, "area_id", -1)) == [(1, 10), (2, -1), (3, -1)]
    assert rows(joins.known_or_default(df, "area", dim, "area_id", -1, keep_null=True)) == [(1, 10), (2, -1), (3, None)]


def test_unread_key_costs_no_join(spark, plan):
    df = spark.createDataFrame([(1, 10)], "id int, area int")
    dim = spark.createDataFrame([(10,)], "area_id int")
    assert "Join" not in plan(joins.known_or_default(df, "area", dim, "area_id", -1, scatter_by=["id"]).select("id"))


def test_unknown_member_and_roles(spark):
    dim = spark.createDataFrame([(1, "a")], "area_id int, nome string")
    wide = joins.with_unknown_member(dim, area_id=-1, nome="?")
    assert rows(wide) == [(-1, "?"), (1, "a")]
    assert joins.role(dim, "carga").columns == ["carga_area_id", "carga_nome"]


def test_global_sequence_numbers_everything(spark, skewed):
    numbered = global_sequence(skewed.select("id"), ["id"], "pos", start=5)
    got = [r["id"] for r in sorted(numbered.collect(), key=lambda r: r["pos"])]
    assert got == sorted(r["id"] for r in skewed.collect())
    assert sorted(r["pos"] for r in numbered.collect()) == list(range(5, 3005))


def test_global_sequence_of_nothing(spark):
    assert global_sequence(spark.createDataFrame([], "id string"), ["id"], "pos").count() == 0


def test_percent_is_a_ratio_of_sums(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 0, 1), ("a", 0, 1), ("b", 0, 0)], "k string, x int, y int")
    summed = rates.totals(df, ["k"], {"x": "x", "y": "y"}, count_as="n")
    rated = summed.select("k", "n", rates.percent(F.col("x"), F.col("y")).alias("p"))
    assert rows(rated) == [("a", 3, 33.3), ("b", 1, None)]


def test_totals_of_totals_and_decimal_type(spark):
    df = spark.createDataFrame([("a", 1, "1.10"), ("a", 2, "2.20"), ("b", 3, "3.30")], "k string, n int, v string")
    df = df.withColumn("v", F.col("v").cast("decimal(14,2)"))
    once = rates.totals(df, ["k"], {"v": "v"}, count_as="rows")
    twice = rates.totals(once, [], {"v": "v"}, count_as="rows", counted="rows")
    assert dict(twice.dtypes) == {"rows": "bigint", "v": "decimal(38,2)"}
    assert [str(x) for x in twice.first()] == ["3", "6.60"]


def test_earliest_keeps_ties_and_cuts_before_the_shuffle(skewed, plan):
    found = dedup.earliest(skewed, ["k"], "o")
    expected = []
    for group in grouped(skewed).values():
        least = min((r["o"] for r in group if r["o"] is not None), default=None)
        expected += [r for r in group if r["o"] == least]
    assert sorted(repr(tuple(r)) for r in expected) == sorted(repr(tuple(r)) for r in found.collect())
    assert "rank(o" in plan(found) and ", 1, Partial" in plan(found)


def test_members_are_fetched_only_behind_a_count(spark, plan):
    df = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, area int")
    dim = spark.createDataFrame([(10,), (10,), (11,)], "area_id int")
    for rows, fetched in ((2, True), (1, False)):
        known, small = joins.distinct_members(dim, "area_id", rows)
        assert small is fetched
        led = joins.known_or_default(df, "area", known, "area_id", -1, fetched=small)
        assert sorted(tuple(r) for r in led.collect()) == [(1, 10), (2, -1), (3, -1)]
        assert ("Exchange hashpartitioning" in plan(led)) is not fetched
    empty, small = joins.distinct_members(dim.limit(0), "area_id")
    assert small and {r["area"] for r in joins.known_or_default(df, "area", empty, "area_id", -1, fetched=True).collect()} == {-1}
