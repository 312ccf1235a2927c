"""Wide tables from joins along the model."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestframe import (
    Condition,
    fetch,
    flatten,
    flatten_aligned,
    flatten_branches,
    join_renamed,
    matching_keys,
)
from nestframe.plans import DocumentTables, table_layout
from nestframe.queries.registry import query
from nestframe.queries.samples import amount_tables, customer_tables, load, order_tables


@query("""
    SELECT o_orderkey AS orderkey, o_orderstatus AS status, l_linestatus AS status_lines,
           l_linenumber AS linenumber, l_quantity AS quantity
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
""", name="join_renamed")
def join_with_renamed_columns(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status")
    )
    lines = load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linestatus").alias("status"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_quantity").alias("quantity"),
    )
    return join_renamed(orders, lines, "orderkey", "{name}_lines")


@query("""
    SELECT c_custkey AS "Customer_id", c_name AS name, c_acctbal AS amount,
           o_orderstatus AS status, o_totalprice AS "Customer_orders_amount",
           o_orderkey AS "Customer_orders_id"
    FROM customer JOIN orders ON o_custkey = c_custkey
""")
def flatten_related(spark: SparkSession, folder: str) -> DataFrame:
    tables = amount_tables(spark, folder)
    two_levels = tables.layout.only(["name", "amount", "orders.status", "orders.amount"])
    return flatten(DocumentTables(two_levels, tables.frames))


@query("""
    SELECT c_custkey AS "Customer_id", c_name AS name, c_acctbal AS amount,
           o_orderstatus AS status, o_totalprice AS "Customer_orders_amount",
           o_orderkey AS "Customer_orders_id", l_linestatus AS "Customer_orders_lines_status",
           l_extendedprice AS "Customer_orders_lines_amount"
    FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
""")
def flatten_three_levels(spark: SparkSession, folder: str) -> DataFrame:
    return flatten(amount_tables(spark, folder))


@query("""
    SELECT o_orderkey, o_orderstatus, o_orderkey AS "Order_id" FROM orders
""")
def flatten_skip_empty(spark: SparkSession, folder: str) -> DataFrame:
    """No line has a negative quantity, so the orders come alone."""
    tables = order_tables(spark, folder)
    none = tables["Order_lines"].where(F.col("l_quantity") < 0)
    return flatten(tables.with_frames({"Order_lines": none}), skip_empty=True)


def nation_tables(spark: SparkSession, folder: str) -> DocumentTables:
    """Nations with two lists side by side, customers with their orders and suppliers."""
    layout = table_layout(
        "n_name string, customers array<struct<c_custkey: bigint, orders: array<struct<o_orderkey: bigint, o_totalprice: double>>>>,"
        " suppliers array<struct<s_suppkey: bigint, s_acctbal: double>>",
        "Nation",
    )
    nations, customers, orders, suppliers = (load(spark, folder, n) for n in ("nation", "customer", "orders", "supplier"))
    frames = {
        "Nation": nations.select("n_name", F.col("n_nationkey").alias("Nation_id")),
        "Nation_customers": customers.select(
            "c_custkey", F.col("c_custkey").alias("Nation_customers_id"), F.col("c_nationkey").alias("Nation_id")
        ),
        "Nation_customers_orders": orders.select(
            "o_orderkey", "o_totalprice", F.col("o_custkey").alias("Nation_customers_id")
        ),
        "Nation_suppliers": suppliers.select("s_suppkey", "s_acctbal", F.col("s_nationkey").alias("Nation_id")),
    }
    order = {"Nation_customers": ["c_custkey"], "Nation_customers_orders": ["o_orderkey"], "Nation_suppliers": ["s_suppkey"]}
    return DocumentTables(layout, frames, order=order)


@query("""
    WITH a AS (
        SELECT c_nationkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey, o_orderkey) - 1 AS i,
               c_custkey, o_orderkey, o_totalprice
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey),
    b AS (
        SELECT s_nationkey AS k, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS i,
               s_suppkey, s_acctbal
        FROM supplier)
    SELECT n_name, coalesce(i, 0) AS _row, c_custkey, o_orderkey, o_totalprice, s_suppkey, s_acctbal
    FROM nation LEFT JOIN (a FULL JOIN b USING (k, i)) ON k = n_nationkey
""", name="flatten_aligned")
def flatten_side_by_side(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their orders beside suppliers, a row for each place in the longer list."""
    wide = flatten_aligned(nation_tables(spark, folder))
    return wide.drop("Nation_id", "Nation_customers_id")


@query("""
    SELECT 'Nation_customers_orders' AS branch, n_name, count(*) AS n_rows, CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS cents
    FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY n_name
    UNION ALL
    SELECT 'Nation_suppliers', n_name, count(*), CAST(sum(round(s_acctbal * 100)) AS BIGINT)
    FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name
""", name="flatten_branches")
def flatten_each_branch(spark: SparkSession, folder: str) -> DataFrame:
    """One wide table for each list that ends a branch."""
    branches = flatten_branches(nation_tables(spark, folder))
    amounts = {"Nation_customers_orders": "o_totalprice", "Nation_suppliers": "s_acctbal"}
    found = [
        branches[name].groupBy("n_name").agg(
            F.count("*").alias("n_rows"), F.sum(F.round(F.col(amount) * 100).cast("long")).alias("cents")
        ).select(F.lit(name).alias("branch"), "n_name", "n_rows", "cents")
        for name, amount in amounts.items()
    ]
    return found[0].unionByName(found[1])


@query("""
    SELECT o_orderkey, count(l_orderkey) AS n_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_orderkey ORDER BY o_orderkey LIMIT 25
""")
def fetch_from_a_list(spark: SparkSession, folder: str) -> DataFrame:
    """The orders of customers as documents of their own."""
    orders = fetch(customer_tables(spark, folder), name="Customer_orders", max_rows=25)
    return orders.select("o_orderkey", F.size("lines").cast("long").alias("n_lines"))


@query("""
    SELECT n_name, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n_customers,
           (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS n_suppliers
    FROM nation
    WHERE (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_custkey % 10 = 0) >= 2
      AND (SELECT count(*) FROM customer JOIN orders ON o_custkey = c_custkey
           WHERE c_nationkey = n_nationkey AND o_totalprice > 300000) >= 3
      AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND NOT coalesce(s_acctbal > -900, FALSE))
""")
def fetch_by_branches(spark: SparkSession, folder: str) -> DataFrame:
    """Nations chosen by conditions on both of their lists and on a list inside one, then rebuilt."""
    tables = nation_tables(spark, folder)
    chosen = matching_keys(
        tables,
        [
            Condition("Nation_customers", F.col("c_custkey") % 10 == 0, at_least=2),
            Condition("Nation_customers_orders", F.col("o_totalprice") > 300000, at_least=3),
            Condition("Nation_suppliers", F.col("s_acctbal") > -900, every=True),
        ],
    )
    nations = fetch(tables, matching=chosen, max_rows=None)
    sizes = [F.size(name).cast("long").alias(f"n_{name}") for name in ("customers", "suppliers")]
    return nations.select("n_name", *sizes)
