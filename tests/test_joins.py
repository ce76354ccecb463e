import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratalake.operators import joins


@pytest.fixture(scope="module")
def skewed(spark):
    """6,000 facts: a third on key 1 and all alike, a tenth without key, the rest spread.

    The shuffle is wide enough for a third of the rows to be far more than one partition.
    """
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    rng = random.Random(7)
    data = [(1, "copy")] * 2000 + [(None, f"n{i}") for i in range(600)]
    data += [(rng.randrange(2, 900), f"v{i}") for i in range(3400)]
    facts = spark.createDataFrame(data, "k long, v string").repartition(6)
    lookup = spark.createDataFrame(
        [(k, f"name{k}") for k in [*range(0, 700), None]], "k long, name string"
    )
    yield data, facts, lookup
    spark.conf.set("spark.sql.shuffle.partitions", width)


def is_salted(df):
    return "_salts" in df._jdf.queryExecution().analyzed().toString()


def brute(data, how):
    known = set(range(0, 700))
    out = Counter()
    for k, v in data:
        hit = k in known
        if how in ("inner", "left") and hit:
            out[(k, v, f"name{k}")] += 1
        elif how == "left":
            out[(k, v, None)] += 1
        elif (how == "left_semi" and hit) or (how == "left_anti" and not hit):
            out[(k, v)] += 1
    return out


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("salt", [True, False])
def test_lookup_join_equals_brute_force(skewed, how, salt):
    data, facts, lookup = skewed
    got = joins.lookup_join(facts, lookup, "k", how, salt=salt)
    assert is_salted(got) == salt
    names = ["k", "v", "name"] if how in ("inner", "left") else ["k", "v"]
    assert got.columns == names
    assert Counter(tuple(r) for r in got.collect()) == brute(data, how)


def test_hot_keys_finds_the_heavy_keys_only(spark, skewed):
    _, facts, _ = skewed
    hot = {r["_h"]: r["_salts"] for r in joins.hot_keys(facts, ["k"], ["bigint"]).collect()}
    one, null = (
        spark.range(1).select(F.xxhash64(F.lit(v).cast("long"))).first()[0] for v in (1, None)
    )
    # A third of the rows fills eight of 24 partitions, a tenth 2.4; twice as many salts.
    assert hot == {one: 16, null: 5}


def test_even_keys_take_the_plain_join(spark):
    facts = spark.range(1000).select((F.col("id") % 100).alias("k"), "id")
    assert joins.hot_keys(facts, ["k"], ["bigint"]) is None


def test_salts_spread_identical_copies(spark, skewed):
    _, facts, _ = skewed
    hot = spark.createDataFrame(
        [spark.range(1).select(F.xxhash64(F.lit(1).cast("long")), F.lit(16)).first()],
        "_h long, _salts int",
    )
    salted = joins._salt(facts, joins._key_hash(["k"], ["bigint"]), hot).filter("k = 1 AND v = 'copy'")
    assert salted.select("_salt").distinct().count() > 1


@pytest.mark.parametrize("fact_type, lookup_type", [("int", "bigint"), ("bigint", "smallint")])
def test_whole_numbers_of_other_widths_still_meet(skewed, fact_type, lookup_type):
    data, facts, lookup = skewed
    facts = facts.withColumn("k", F.col("k").cast(fact_type))
    lookup = lookup.withColumn("k", F.col("k").cast(lookup_type))
    got = joins.lookup_join(facts, lookup, "k", "inner", salt=True)
    assert is_salted(got)
    assert Counter(tuple(r) for r in got.collect()) == brute(data, "inner")


def test_keys_that_may_hash_apart_are_refused(skewed):
    _, facts, lookup = skewed
    with pytest.raises(ValueError, match="cannot be salted"):
        joins.lookup_join(facts.withColumn("k", F.col("k").cast("double")), lookup, "k", salt=True)


def test_every_hot_key_is_split(spark):
    """Far more than a few hundred hot keys: as many as arithmetic allows."""
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "700")
    try:
        facts = spark.range(350 * 30).select((F.col("id") % 350).alias("k"), "id")
        hot = joins.hot_keys(facts, ["k"], ["bigint"])
        assert hot.count() == 350
        plan = hot._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
        lookup = spark.range(350).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        got = joins.lookup_join(facts, lookup, "k", "inner", salt=True)
        assert got.count() == got.filter("v = 2 * k").count() == 350 * 30
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def test_keys_can_be_counted_on_another_table(spark, skewed, monkeypatch):
    _, facts, lookup = skewed
    counted = []
    monkeypatch.setattr(joins, "hot_keys", lambda df, *_: counted.append(df))
    joins.lookup_join(facts.filter("k > 5"), lookup, "k", salt=True, count_on=facts)
    joins.lookup_join(facts, lookup, "k")
    assert counted == [facts]


def test_text_keys_are_salted(skewed):
    data, facts, lookup = skewed
    facts = facts.withColumn("k", F.col("k").cast("string"))
    lookup = lookup.withColumn("k", F.col("k").cast("string"))
    got = joins.lookup_join(facts, lookup, "k", "left", salt=True)
    assert is_salted(got)
    want = Counter({(None if k is None else str(k), v, n): c
                    for (k, v, n), c in brute(data, "left").items()})
    assert Counter(tuple(r) for r in got.collect()) == want


def test_salted_rows_spread_over_partitions(spark, skewed):
    _, facts, lookup = skewed
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = {}
        for salt in (True, False):
            got = joins.lookup_join(facts, lookup, "k", "left", salt=salt)
            per_part = got.groupBy(F.spark_partition_id().alias("p")).count()
            sizes[salt] = per_part.agg(F.max("count")).first()[0]
        assert sizes[False] >= 2000 and sizes[True] < 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_within_adds_a_condition(spark, skewed):
    facts = spark.createDataFrame([(1, 5), (1, 50)], "k long, at int")
    spans = spark.createDataFrame([(1, 0, 10, "a"), (1, 10, 20, "b")], "k long, lo int, hi int, n string")
    inside = (F.col("at") >= F.col("lo")) & (F.col("at") < F.col("hi"))
    for salt in (True, False):
        got = joins.lookup_join(facts, spans, "k", "left", within=inside, salt=salt)
        assert sorted(map(tuple, got.select("at", "n").collect())) == [(5, "a"), (50, None)]


def test_category_is_not_multiplied_by_duplicate_translations(spark, rows):
    products = spark.createDataFrame(
        [(1, "moveis"), (2, None), (3, "rara"), (4, "moveis")],
        "product_id int, product_category_name string",
    )
    translation = spark.createDataFrame(
        [("moveis", "furniture"), ("moveis", "furniture"), (None, "nothing")],
        "product_category_name string, product_category_name_english string",
    )
    got = joins.with_category(products, translation).select(
        "product_id", "product_category_name_english"
    )
    assert rows(got) == [(1, "furniture"), (2, "unknown"), (3, "unknown"), (4, "furniture")]


def test_orphans_count_rows_and_pass_null(spark, rows):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (3,)], "fk long")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "pk long")
    assert rows(joins.orphan_keys(child, parent, "fk", "pk")) == [(2, 2), (3, 1)]
    assert rows(joins.orphans(child, parent, "fk", "pk")) == [(2,), (2,), (3,)]


def test_disappeared_treats_null_as_a_key(spark, rows):
    current = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    source = spark.createDataFrame([(2, "x"), (None, "y")], "k long, v string")
    assert rows(joins.disappeared(current, source, ["k"])) == [(1, "a")]


def test_reconcile_shows_grains_of_one_side(spark, rows):
    a = spark.createDataFrame([("d1", 1.0), ("d2", 2.0), ("d4", None)], "d string, m double")
    b = spark.createDataFrame([("d1", 1.4), ("d3", 3.0), ("d4", None)], "d string, m double")
    got = joins.reconcile(a, b, ["d"], ["m"], tolerance=0.5).select("d", "m_left", "m_right", "matches")
    assert rows(got) == [
        ("d1", 1.0, 1.4, True),
        ("d2", 2.0, None, False),
        ("d3", None, 3.0, False),
        ("d4", None, None, True),
    ]
    strict = joins.reconcile(a, b, ["d"], ["m"])
    assert strict.filter("matches").select("d").collect() == [("d4",)]
