"""Selected documents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestframe import any_item_equals, assemble, equals, fetch, fetch_by_id, having, owner_keys
from nestframe.queries.rebuilding import cents, customer_rows, customer_sums, total
from nestframe.queries.registry import query
from nestframe.queries.samples import conversation_tables, customer_tables, load, order_tables


def order_sums(orders: DataFrame) -> DataFrame:
    """The documents as they are fetched, a row each."""
    return orders.select(
        "o_orderkey",
        F.size("lines").cast("long").alias("n_lines"),
        total(F.col("lines"), cents).alias("cents"),
    )


ORDER_SUMS = """
    SELECT o_orderkey, count(l_orderkey) AS n_lines,
           coalesce(CAST(sum(round(l_extendedprice * 100)) AS BIGINT), 0) AS cents
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_orderkey
"""


@query(f"SELECT * FROM ({ORDER_SUMS}) ORDER BY o_orderkey LIMIT 10")
def fetch_top_n(spark: SparkSession, folder: str) -> DataFrame:
    return order_sums(fetch(order_tables(spark, folder), max_rows=10))


@query(f"SELECT * FROM ({ORDER_SUMS}) WHERE o_orderkey = 42", name="fetch_by_id")
def fetch_one_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return order_sums(fetch_by_id(order_tables(spark, folder), 42))


@query("""
    SELECT conv_id, turn, role, text FROM conversations
    WHERE conv_id IN (SELECT conv_id FROM conversations WHERE role = 'system')
""")
def fetch_by_child_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Whole conversations that have a system turn."""
    tables = conversation_tables(spark, folder)
    keys = owner_keys(tables, "Conversation_turns", F.col("role") == "system")
    conversations = fetch(tables, matching=keys, max_rows=None)
    return conversations.select("conv_id", F.inline("turns")).select(
        "conv_id", "turn", "role", "text"
    )


@query(f"""
    SELECT * FROM ({ORDER_SUMS}) WHERE o_orderkey IN (
        SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50) ORDER BY o_orderkey LIMIT 100
""")
def fetch_top_n_by_joined_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The first orders with a large line, found on a join in which orders repeat."""
    tables = order_tables(spark, folder)
    joined = tables["Order"].join(tables["Order_lines"], "Order_id")
    matching = joined.where(F.col("l_quantity") >= 50)
    return order_sums(fetch(tables, matching=matching, max_rows=100))


@query("""
    WITH hit AS (
        SELECT DISTINCT o_custkey AS k FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        WHERE l_quantity >= 50)
    SELECT c_custkey, count(DISTINCT o_orderkey) AS n_orders, count(l_orderkey) AS n_lines,
           coalesce(CAST(sum(round(l_extendedprice * 100)) AS BIGINT), 0) AS cents
    FROM customer JOIN hit ON k = c_custkey LEFT JOIN orders ON o_custkey = c_custkey
         LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY c_custkey
""")
def fetch_by_grandchild_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Whole customers with a large line in any order."""
    tables = customer_tables(spark, folder)
    keys = owner_keys(tables, "Customer_orders_lines", F.col("l_quantity") >= 50)
    return customer_rows(fetch(tables, matching=keys, max_rows=None))


@query("""
    SELECT o_orderkey, count(l_orderkey) AS n_lines,
           coalesce(CAST(sum(l_quantity) AS BIGINT), 0) AS quantity
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_orderkey
""")
def fetch_selected_fields(spark: SparkSession, folder: str) -> DataFrame:
    fields = ["o_orderkey", "lines.l_quantity"]
    orders = fetch(order_tables(spark, folder), max_rows=None, fields=fields)
    quantity = total(F.col("lines"), lambda line: line["l_quantity"].cast("long"))
    n_lines = F.size("lines").cast("long").alias("n_lines")
    return orders.select("o_orderkey", n_lines, quantity.alias("quantity"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_equal(spark: SparkSession, folder: str) -> DataFrame:
    customers = load(spark, folder, "customer")
    chosen = customers.where(equals(customers, "c_mktsegment", "BUILDING"))
    return chosen.select("c_custkey", "c_name", "c_acctbal")


@query("""
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def filter_nested_path(spark: SparkSession, folder: str) -> DataFrame:
    """The hit is looked for in the table of lines; orders are chosen by its keys."""
    tables = order_tables(spark, folder)
    returned = owner_keys(tables, "Order_lines", F.col("l_returnflag") == "R")
    whole = fetch(tables, matching=returned, max_rows=None, fields=["o_orderkey", "o_orderstatus"])
    return whole.select("o_orderkey", "o_orderstatus")


@query("""
    SELECT conv_id FROM conversations WHERE role = 'system' GROUP BY conv_id
""")
def filter_nested_value(spark: SparkSession, folder: str) -> DataFrame:
    """The same on nested documents, by a condition on the items of their list."""
    talks = assemble(conversation_tables(spark, folder), ["conv_id", "turns.role"])
    return talks.where(any_item_equals("turns.role", "system")).select("conv_id")


LARGE_LINES = """
    FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
"""


@query(f"""
    SELECT c_custkey, count(DISTINCT o_orderkey) AS n_orders, count(l_orderkey) AS n_lines,
           CAST(sum(round(l_extendedprice * 100)) AS BIGINT) AS cents
    FROM customer JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey
    WHERE c_custkey IN (SELECT c_custkey {LARGE_LINES} WHERE l_quantity >= 45
                        GROUP BY c_custkey HAVING count(*) >= 3)
    GROUP BY c_custkey
""")
def filter_pieces_at_least(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with at least three large lines, which may be in different pieces of a customer."""
    customers = assemble(customer_tables(spark, folder), list_size=3)
    chosen = having(customers, "orders.lines.l_quantity", lambda q: q >= 45, at_least=3)
    return customer_sums(chosen)


@query("""
    SELECT o_orderkey, count(l_orderkey) AS n_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_orderkey HAVING coalesce(bool_and(l_returnflag <> 'R'), TRUE)
""")
def filter_pieces_every(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of which no line was returned, in pieces of two lines."""
    fields = ["o_orderkey", "lines.l_returnflag"]
    orders = fetch(order_tables(spark, folder), max_rows=None, fields=fields, list_size=2)
    chosen = having(orders, "lines.l_returnflag", lambda flag: flag != "R", every=True)
    return chosen.groupBy("o_orderkey").agg(F.sum(F.size("lines")).alias("n_lines"))
