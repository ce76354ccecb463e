"""Version history, upserts and schema alignment."""

from pyspark.sql import DataFrame, Window, functions as F

from stratalake.operators import merge, scd2
from workbench.bindings import FIRST_RUN, SECOND_RUN, Roles, with_roles
from workbench.operator_queries import _CUSTOMER_STATES_SQL
from workbench.registry import query

CUSTOMER_KEYS, CUSTOMER_TRACKED = ["c_custkey"], ["c_mktsegment", "c_nationkey"]
PART_KEYS, PART_TRACKED = ["p_partkey"], ["p_type", "p_size"]

PART_STATES_SQL = {
    "h_before": "SELECT p_partkey, p_name, p_type, p_size FROM part",
    "h_after": """SELECT p_partkey, p_name,
        CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS p_type,
        CASE WHEN p_partkey % 11 = 0 THEN p_size + 1 ELSE p_size END AS p_size FROM part""",
}


def two_runs(before: DataFrame, after: DataFrame, keys, tracked, **opts) -> DataFrame:
    """All versions after loading ``before`` at the first run and ``after`` at the second."""
    first = scd2.scd2_apply(
        scd2.empty_history(before), before, keys, tracked, FIRST_RUN, **opts
    )
    return scd2.scd2_apply(first.filter("is_current"), after, keys, tracked, SECOND_RUN, **opts)


def customers_history(t: Roles, deletes: str = "ignore") -> DataFrame:
    return two_runs(
        t.customers_before, t.customers_after, CUSTOMER_KEYS, CUSTOMER_TRACKED, deletes=deletes
    )


def parts_history(t: Roles, **opts) -> DataFrame:
    return two_runs(t.parts_before, t.parts_after, PART_KEYS, PART_TRACKED, **opts)


def history_sql(key: str, columns: str, differs: str, deletes: str) -> dict[str, str]:
    """Versions over the states h_before (b) and h_after (a) of one dimension."""
    gone = "a.{0} IS NULL OR ".format(key) if deletes == "close" else ""
    here = "" if deletes == "close" else "a.{0} IS NOT NULL AND ".format(key)
    closes = f"({gone}({here}coalesce({differs}, false)))"

    def scd(run):
        return f"sha256(CAST({key} AS VARCHAR) || '||{run}')"

    def qualified(alias):
        return ", ".join(f"{alias}.{c}" for c in columns.split(", "))

    return {
        "h_versions": f"""
        SELECT {columns}, TIMESTAMP '{FIRST_RUN}' AS valid_from,
          CASE WHEN closes THEN TIMESTAMP '{SECOND_RUN}' END AS valid_to,
          NOT closes AS is_current, {scd(FIRST_RUN)} AS scd_id
        FROM (SELECT {qualified("b")}, {closes} AS closes
          FROM h_before b LEFT JOIN h_after a ON a.{key} = b.{key})
        UNION ALL
        SELECT {columns}, TIMESTAMP '{SECOND_RUN}', CAST(NULL AS TIMESTAMP), true,
          {scd(SECOND_RUN)}
        FROM (SELECT {qualified("a")} FROM h_after a LEFT JOIN h_before b ON a.{key} = b.{key}
          WHERE b.{key} IS NULL OR coalesce({differs}, false))"""
    }


_CUSTOMER_COLUMNS = "c_custkey, c_name, c_mktsegment, c_nationkey"
_PART_COLUMNS = "p_partkey, p_name, p_type, p_size"
_PART_DIFFERS = "(a.p_type IS DISTINCT FROM b.p_type OR a.p_size IS DISTINCT FROM b.p_size)"


def customers_sql(body: str, deletes: str = "ignore") -> str:
    versions = history_sql(
        "c_custkey", _CUSTOMER_COLUMNS, "a.c_mktsegment <> b.c_mktsegment", deletes
    )
    return with_roles(body, {**_CUSTOMER_STATES_SQL, **versions})


def parts_sql(body: str, differs: str = _PART_DIFFERS, deletes: str = "close") -> str:
    versions = history_sql("p_partkey", _PART_COLUMNS, differs, deletes)
    return with_roles(body, {**PART_STATES_SQL, **versions})


_UPSERT_SQL = """SELECT * FROM h_after UNION ALL
    SELECT * FROM h_before WHERE c_custkey NOT IN (SELECT c_custkey FROM h_after)"""

query("t01_insert_changed", customers_sql("FROM h_versions WHERE is_current AND valid_from > "
      f"TIMESTAMP '{FIRST_RUN}'"))(
    lambda t: customers_history(t).filter(
        F.col("is_current") & (F.col("valid_from") > F.lit(FIRST_RUN).cast("timestamp"))
    )
)

query("t02_upsert", with_roles(_UPSERT_SQL, _CUSTOMER_STATES_SQL))(
    lambda t: merge.upsert(t.customers_before, t.customers_after, ["c_custkey"])
)

# The merge route: keys that disappear stay open.
query("t03_v12_customers_merge", customers_sql("FROM h_versions"))(customers_history)

query(
    "t03_v13_parts_merge_sentinel",
    parts_sql(
        "FROM h_versions",
        "(coalesce(a.p_type, '') <> coalesce(b.p_type, '') OR a.p_size <> b.p_size)",
        "ignore",
    ),
)(lambda t: parts_history(t, null_equals_sentinel=True))

# The snapshot route: keys that disappear are closed.
query("t04_customers_snapshot", customers_sql("FROM h_versions", "close"))(
    lambda t: customers_history(t, "close")
)

query(
    "t05_v10_customers_view",
    customers_sql("SELECT * EXCLUDE (scd_id) FROM h_versions", "close"),
)(lambda t: scd2.scd2_view(customers_history(t, "close")))

query("t05_v11_parts_view", parts_sql("SELECT * EXCLUDE (scd_id) FROM h_versions"))(
    lambda t: scd2.scd2_view(parts_history(t, deletes="close"))
)

query("t06_current", customers_sql("FROM h_versions WHERE is_current", "close"))(
    lambda t: scd2.scd2_current(customers_history(t, "close"))
)

_AS_OF_SQL = customers_sql(
    """SELECT o_orderkey, o_custkey AS c_custkey, CAST(o_orderdate AS TIMESTAMP) AS at,
    h.c_mktsegment, h.c_nationkey FROM orders LEFT JOIN h_versions h
      ON o_custkey = h.c_custkey AND o_orderdate >= h.valid_from
      AND (h.valid_to IS NULL OR o_orderdate < h.valid_to)""",
    "close",
)


def _as_of(t: Roles, **opts) -> DataFrame:
    facts = t.table("orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderdate").cast("timestamp").alias("at"),
    )
    return scd2.scd2_as_of(
        facts,
        customers_history(t, "close"),
        "c_custkey",
        "at",
        ["c_mktsegment", "c_nationkey"],
        **opts,
    )


query("t07_j16_as_of", _AS_OF_SQL)(_as_of)
query("t07_j16_as_of_key_search", _AS_OF_SQL)(lambda t: _as_of(t, salt=True))

query("t07_j16_as_of_by_time", _AS_OF_SQL)(
    lambda t: scd2.scd2_as_of_by_time(
        t.table("orders").select(
            "o_orderkey",
            F.col("o_custkey").alias("c_custkey"),
            F.col("o_orderdate").cast("timestamp").alias("at"),
        ),
        customers_history(t, "close"),
        "c_custkey",
        "at",
        ["c_mktsegment", "c_nationkey"],
    )
)


# A version of each priority for each day with an order of it: five keys, thousands of versions
# each. Every seventh version ends a day early, so that some facts fall between versions.
@query(
    "t07_j16_as_of_long_history",
    """WITH days AS (SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS day,
        max(o_totalprice) AS top_price FROM orders GROUP BY 1, 2),
      versions AS (SELECT *, row_number() OVER w AS n, lead(day) OVER w AS following FROM days
        WINDOW w AS (PARTITION BY k ORDER BY day)),
      facts AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS day,
        ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][least(l_partkey % 9 + 1, 5)] AS k
        FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(f.day AS TIMESTAMP) AS at, f.k AS k,
      CASE WHEN v.following IS NULL OR f.day < v.following - CAST(v.n % 7 = 0 AS INTEGER)
        THEN v.top_price END AS top_price
    FROM facts f ASOF LEFT JOIN versions v ON f.k = v.k AND f.day >= v.day""",
)
def as_of_long_history(t: Roles) -> DataFrame:
    days = t.table("orders").groupBy(
        F.col("o_orderpriority").alias("k"), F.col("o_orderdate").cast("date").alias("day")
    ).agg(F.max("o_totalprice").alias("top_price"))
    of_key = Window.partitionBy("k").orderBy("day")
    early = (F.row_number().over(of_key) % 7 == 0).cast("int")
    versions = days.select(
        "k",
        "top_price",
        F.col("day").cast("timestamp").alias("valid_from"),
        F.date_sub(F.lead("day").over(of_key), early).cast("timestamp").alias("valid_to"),
    )
    names = F.array(*map(F.lit, ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]))
    facts = t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_shipdate").cast("date").cast("timestamp").alias("at"),
        F.element_at(names, F.least(F.col("l_partkey") % 9 + 1, F.lit(5)).cast("int")).alias("k"),
    )
    return scd2.scd2_as_of_by_time(facts, versions, "k", "at", ["top_price"])


query(
    "t08_check_finds_breaches",
    """SELECT c_custkey, CAST(2 AS BIGINT) AS n_current, CAST(0 AS BIGINT) AS n_empty,
    CAST(1 AS BIGINT) AS n_overlaps, CAST(0 AS BIGINT) AS n_flag_wrong FROM customer""",
)(
    # A history that was loaded twice without closing: two open versions of every customer.
    lambda t: scd2.scd2_check(
        scd2.scd2_apply(
            scd2.empty_history(t.customers_before),
            t.customers_before,
            CUSTOMER_KEYS,
            CUSTOMER_TRACKED,
            FIRST_RUN,
        ).unionByName(
            scd2.scd2_apply(
                scd2.empty_history(t.customers_before),
                t.customers_before,
                CUSTOMER_KEYS,
                CUSTOMER_TRACKED,
                SECOND_RUN,
            )
        ),
        CUSTOMER_KEYS,
    )
)

query("t08_check_clean_history", "SELECT CAST(0 AS BIGINT) AS keys_with_breaches")(
    lambda t: scd2.scd2_check(customers_history(t, "close"), CUSTOMER_KEYS).agg(
        F.count(F.lit(1)).alias("keys_with_breaches")
    )
)

query(
    "p13_scd2_history_of_key",
    customers_sql("FROM h_versions WHERE c_custkey = 10 ORDER BY valid_from", "close"),
)(lambda t: scd2.scd2_history(customers_history(t, "close"), "c_custkey", 10))

query(
    "s21_align_schema",
    """SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderpriority, o_totalprice,
    o_orderkey + 1 AS added FROM orders""",
)(
    lambda t: merge.align_schema(
        t.table("orders").select(
            "o_orderkey",
            "o_custkey",
            F.col("o_totalprice").cast("string").alias("o_totalprice"),
            (F.col("o_orderkey") + 1).alias("added"),
        ),
        t.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"),
    )
)
