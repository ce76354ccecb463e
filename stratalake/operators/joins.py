"""Joins of a large table with a lookup, safe when one key holds a large share of the rows.

``lookup_join`` is the one many-to-one join of the library. It is an ordinary join: its strategy is
left to Catalyst, and a skewed partition is split by adaptive execution when the join runs, also
where the next step could have used its partitioning (``SESSION_SETTINGS`` asks for that). A caller
that must not rely on adaptive execution asks for salts: then the rows of each key are counted, and
those that would overfill a shuffle partition are spread over as many salts as their share calls
for, with only their lookup rows repeated. Every row takes part in exactly one key/salt
combination, so the result does not depend on which keys were found.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.config import scratch_dir
from stratalake.functions import spread_hash
from stratalake.sizing import shuffle_width

def _key_types(fact: DataFrame, lookup: DataFrame, keys: list[str]) -> list[str] | None:
    """Types in which equal keys of both sides hash alike; None if there is no such type.

    An int and a long join as equal but do not hash alike, so whole numbers are hashed as longs.
    """
    types = []
    for k in keys:
        a, b = fact.schema[k].dataType, lookup.schema[k].dataType
        if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
            types.append("bigint")
        elif a == b and not isinstance(a, T.FractionalType):
            types.append(a.simpleString())
        else:
            return None
    return types


def _key_hash(keys: list[str], types: list[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast(t) for k, t in zip(keys, types)])


def hot_keys(df: DataFrame, keys: list[str], types: list[str]) -> DataFrame | None:
    """Hashes of the keys that fill two shuffle partitions or more, with their salt count.

    Rows are counted per key, exactly, with one row per key and map task in the shuffle. As a hot
    key has at least two partitions' worth of rows, there are at most half as many hot keys as
    partitions, which bounds the list that is broadcast. The list is written once, as both sides
    of the join must salt by the same one. None if no key is hot.
    """
    spark = df.sparkSession
    width = shuffle_width(spark)
    hashes = df.select(_key_hash(keys, types).alias("_h"))
    share = F.col("n") / hashes.agg(F.count(F.lit(1))).scalar()
    found = (
        hashes.groupBy("_h")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(share * width >= 2)
        .select("_h", F.ceil(share * width * 2).cast("int").alias("_salts"))
    )
    path = f"{scratch_dir(spark)}/hot-keys-{uuid.uuid4().hex}"
    found.write.parquet(path)
    stored = spark.read.schema(found.schema).parquet(path)
    return None if stored.isEmpty() else stored


def _salt(df: DataFrame, key_hash: Column, hot: DataFrame) -> DataFrame:
    """Give each row of a hot key one of its salts.

    The salt hashes the row and its partition number: it is the same when a lost task is run
    again, and identical copies of a row in different partitions still spread.
    """
    spread = F.pmod(spread_hash(df), F.col("_salts"))
    return (
        df.withColumn("_h", key_hash)
        .join(F.broadcast(hot), "_h", "left")
        .withColumn("_salt", F.coalesce(spread, F.lit(0)).cast("int"))
        .drop("_h", "_salts")
    )


def _repeat(lookup: DataFrame, key_hash: Column, hot: DataFrame) -> DataFrame:
    """Repeat the lookup rows of a hot key once per salt."""
    last = F.coalesce(F.col("_salts"), F.lit(1)) - 1
    return (
        lookup.withColumn("_h", key_hash)
        .join(F.broadcast(hot), "_h", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
        .drop("_h", "_salts")
    )


def _join(fact, lookup, keys, how, within):
    renamed = lookup.withColumnsRenamed({k: f"_lookup_{k}" for k in keys})
    condition = None
    for k in keys:
        match = F.col(k) == F.col(f"_lookup_{k}")
        condition = match if condition is None else condition & match
    if within is not None:
        condition = condition & within
    return fact.join(renamed, condition, how).drop(*[f"_lookup_{k}" for k in keys])


def spread_hot_keys(
    fact: DataFrame, lookup: DataFrame, keys: list[str], count_on: DataFrame | None = None
) -> tuple[DataFrame, DataFrame] | None:
    """Both sides with a column ``_salt``, by which rows of a hot key may be told apart; None if no
    key is hot. The keys of ``count_on`` are counted, by default the fact's."""
    types = _key_types(fact, lookup, keys)
    if types is None:
        raise ValueError(f"keys {keys} have types that cannot be salted; cast both sides alike")
    hot = hot_keys(fact if count_on is None else count_on, keys, types)
    if hot is None:
        return None
    key_hash = _key_hash(keys, types)
    return _salt(fact, key_hash, hot), _repeat(lookup, key_hash, hot)


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: str | list[str],
    how: str = "left",
    *,
    within: Column | None = None,
    salt: bool = False,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Join ``fact`` to a lookup on equal keys; ``how`` is inner, left, left_semi or left_anti.

    ``within`` is an extra condition over both sides (their other column names must differ).
    ``salt`` spreads hot keys, which are looked for by a job that runs when this function is
    called. It counts the keys of ``count_on``, by default the fact: give the table the keys come
    from if the fact is the result of other joins. Key types that do not hash alike are an error.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not salt:
        return _join(fact, lookup, keys, how, within)
    sides = spread_hot_keys(fact, lookup, keys, count_on)
    if sides is None:
        return _join(fact, lookup, keys, how, within)
    salted = _join(*sides, keys + ["_salt"], how, within)
    return salted.drop("_salt")


def with_category(
    products: DataFrame, translation: DataFrame, salt: bool = False
) -> DataFrame:
    """Products with their English category; ``unknown`` when there is no translation.

    The translation is reduced to one row per category first, so duplicates in it cannot
    multiply products. Many products may share one category (or none), hence ``lookup_join``.
    """
    english = translation.groupBy("product_category_name").agg(
        F.min("product_category_name_english").alias("product_category_name_english")
    )
    joined = lookup_join(products, english, "product_category_name", salt=salt)
    return joined.withColumn(
        "product_category_name_english",
        F.coalesce("product_category_name_english", F.lit("unknown")),
    )


def items_with_orders(items: DataFrame, orders: DataFrame, **opts) -> DataFrame:
    return lookup_join(items, orders, "order_id", "inner", **opts)


def items_with_products(items: DataFrame, products: DataFrame, **opts) -> DataFrame:
    return lookup_join(items, products, "product_id", "left", **opts)


def person_orders(orders: DataFrame, customers: DataFrame, **opts) -> DataFrame:
    """Orders with the person behind the order-level customer key."""
    people = customers.select("customer_id", "customer_unique_id")
    return lookup_join(orders, people, "customer_id", "inner", **opts)


def orphan_keys(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign keys without a parent and how many rows carry them; NULL keys pass.

    Children are counted per key before the join, so a hot key crosses the shuffle as one row
    per map task.
    """
    used = child.filter(F.isnotnull(fk)).groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(pk).alias("_pk")).filter(F.isnotnull("_pk")).distinct()
    return used.join(known, used[fk] == known["_pk"], "left_anti")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str, **opts) -> DataFrame:
    """The child rows whose foreign key has no parent."""
    keys = orphan_keys(child, parent, fk, pk).select(fk)
    return lookup_join(child, keys, fk, "left_semi", **opts)


def disappeared(current: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``current`` whose key is no longer in ``source`` (both unique per key)."""
    seen = source.select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
    match = [current[k].eqNullSafe(seen[f"_seen_{k}"]) for k in keys]
    return current.join(seen, match, "left_anti")


def reconcile(
    left: DataFrame, right: DataFrame, keys: list[str], measures: list[str], tolerance: float = 0.0
) -> DataFrame:
    """Compare the same measures of two tables on a shared grain.

    A full outer join, so a grain that only one side has is shown. Per measure ``m`` the result
    has ``m_left``, ``m_right``, ``m_diff``; ``matches`` is true when every difference is within
    the tolerance and both sides agree on NULLs.
    """
    a = left.select(*keys, *[F.col(m).alias(f"{m}_left") for m in measures])
    b = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[F.col(m).alias(f"{m}_right") for m in measures],
    )
    joined = a.withColumn("_in_left", F.lit(True)).join(
        b.withColumn("_in_right", F.lit(True)),
        [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys],
        "full_outer",
    )
    matches = F.isnotnull("_in_left") & F.isnotnull("_in_right")
    out = [F.coalesce(k, f"_r_{k}").alias(k) for k in keys]
    for m in measures:
        x, y = F.col(f"{m}_left"), F.col(f"{m}_right")
        out += [x, y, (x - y).alias(f"{m}_diff")]
        close = F.coalesce(F.abs(x - y) <= F.lit(tolerance), F.lit(False))
        matches = matches & (close | (x.isNull() & y.isNull()))
    return joined.select(*out, matches.alias("matches"))
