import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.operators import aggregates, dedup, filters


def test_latest_per_key_settles_ties(spark, rows):
    df = spark.createDataFrame(
        [("a", 2, "y"), ("a", 2, "x"), ("a", 1, "z"), ("b", None, "n"), (None, 1, "k")],
        "k string, at int, v string",
    )
    for n in (1, 4):
        got = dedup.latest_per_key(df.repartition(n), ["k"], "at", ["v"])
        assert rows(got) == [(None, 1, "k"), ("a", 2, "x"), ("b", None, "n")]


def test_top_n_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    got = dedup.top_n_per_group(df, ["k"], [F.desc("id")], 2, rank="place")
    assert sorted(map(tuple, got.collect())) == [
        (0, 96, 2), (0, 99, 1), (1, 94, 2), (1, 97, 1), (2, 95, 2), (2, 98, 1),
    ]
    plan = dedup.top_n_per_group(df, ["k"], [F.desc("id")], 2)._jdf.queryExecution()
    above, below = plan.executedPlan().toString().split("Exchange hashpartitioning", 1)
    assert "2, Final" in above and "2, Partial" in below


def test_first_label_puts_null_first(spark, rows):
    df = spark.createDataFrame(
        [("z1", "b"), ("z1", "a"), ("z1", "a"), ("z2", None), ("z2", "a")], "zip string, city string"
    )
    assert rows(dedup.first_label(df, "zip", "city")) == [
        ("z1", "a", "a"), ("z1", "b", "a"), ("z2", None, None), ("z2", "a", None),
    ]


def test_first_per_key(spark, rows):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, n int")
    assert rows(dedup.first_per_key(df, ["k"], ["n"])) == [("a", 1), ("b", 5)]


def test_distinct_volume_if(spark, rows):
    df = spark.createDataFrame(
        [("g", 1, True), ("g", 1, False), ("g", 2, None), ("g", None, True), ("h", 1, False)],
        "g string, v int, flag boolean",
    )
    assert rows(aggregates.distinct_volume_if(df, ["g"], "v", "flag")) == [("g", 2, 1), ("h", 1, 0)]


def test_pivot_sum_keeps_other_categories_in_the_total(spark, rows):
    df = spark.createDataFrame(
        [("o", "card", 5), ("o", "cash", 7), ("o", None, 1), ("p", "other", 2)],
        "k string, kind string, v long",
    )
    got = aggregates.pivot_sum(df, ["k"], "kind", F.col("v"), ["card", "cash"])
    assert got.columns == ["k", "total", "total_card", "total_cash"]
    assert rows(got) == [("o", 13, 5, 7), ("p", 2, 0, 0)]


def test_centroid_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(
        [("z", 0.1 * i, -0.1 * i) for i in range(200)], "zip string, lat double, lng double"
    )
    got = {
        tuple(aggregates.centroid(df.repartition(n, "lat"), ["zip"], "lat", "lng").first())
        for n in (1, 3, 7)
    }
    assert got == {("z", 9.95, -9.95)}


def test_shares(spark, rows):
    df = spark.createDataFrame([("y1", 1, 1), ("y1", 2, 2), ("y2", 1, 4)], "y string, s int, n long")
    assert rows(aggregates.share_of_pane(df, ["y"], "n")) == [
        ("y1", 1, 1, 1 / 3), ("y1", 2, 2, 2 / 3), ("y2", 1, 4, 1.0),
    ]
    assert [r.share for r in aggregates.share_of_pane(df, [], "n").orderBy("n").collect()] == [
        1 / 7, 2 / 7, 4 / 7,
    ]


def test_small_aggregates(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, n int")
    assert rows(aggregates.row_volume(df, ["k"])) == [(None, 1), ("a", 2)]
    assert rows(aggregates.distinct_volume(df, ["k"], "n")) == [(None, 1), ("a", 1)]
    assert aggregates.max_and_count(df, "n").first() == (2, 3)
    assert aggregates.distinct_keys(df, ["k"]).first() == (2,)
    assert aggregates.count_report({"x": df, "y": df.limit(0)}).collect() == [("x", 3), ("y", 0)]
    assert aggregates.newest(df, "n", 1, ["k"]).collect() == [(None, 2)]
    assert aggregates.any_row(df, F.col("n") == 2).first() == (True,)
    assert aggregates.any_row(df, F.col("n") == 9).first() == (False,)


def test_filters(spark):
    df = spark.createDataFrame(
        [(datetime.datetime(2024, 1, d, 12),) for d in (1, 2, 3)], "at timestamp"
    )
    assert filters.between_days(df, "at", "2024-01-02", "2024-01-03").count() == 2
    assert filters.since(df, "at", datetime.date(2024, 1, 3)).count() == 1
    assert filters.null_rows(df, "at").count() == 0
    empty = filters.empty_like(spark, "a int, b string")
    assert (empty.count(), empty.columns) == (0, ["a", "b"])


def test_date_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT timestamp'2024-01-05 10:00:00' AS at, 1 AS v").write.parquet(path)
    plan = (
        filters.between_days(spark.read.parquet(path), "at", "2024-01-01", "2024-01-31")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "GreaterThanOrEqual(at" in plan and "LessThan(at" in plan


@pytest.mark.parametrize("column, expected", [("k", 3)])
def test_approximate_distinct(spark, column, expected):
    df = spark.createDataFrame([(0, i % 3) for i in range(50)], "g int, k int")
    got = aggregates.distinct_volume(df, ["g"], column, approximate=True).first()
    assert got.distinct_volume == expected


def test_positions_over_many_ranges(spark):
    from stratalake.operators.aggregates import with_positions

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 50 END AS v").repartition(9)
        got = with_positions(df, [F.col("v").desc_nulls_last(), "id"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(range(5000), key=lambda k: (-(7 if k % 3 == 0 else k % 50), k))
    assert [r.id for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(1, 5001))
    assert with_positions(df.limit(0), ["id"]).count() == 0
    assert "SinglePartition" not in with_positions(df, ["id"]).select("id")._jdf.queryExecution().optimizedPlan().toString()
