"""The sample tables as nested documents, and as the flat tables of nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestframe import DocumentTables, model_schema, table_layout


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def split_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their text as a list of paragraphs, each with its list of words."""
    paragraphs = F.transform(
        F.split("text", "\n"), lambda p: F.struct(p.alias("text"), F.split(p, " ").alias("words"))
    )
    return load(spark, folder, "documents").select(
        "doc_id", "lang", "source", "n_chars", paragraphs.alias("paragraphs")
    )


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a label object, which is NULL for those without a label."""
    labels = load(spark, folder, "labels").select(
        "doc_id", F.struct("quality", "toxic").alias("label")
    )
    documents = load(spark, folder, "documents").select("doc_id", "lang")
    return documents.join(labels, "doc_id", "left")


def conversation_tables(spark: SparkSession, folder: str) -> DocumentTables:
    layout = table_layout(
        "conv_id bigint, turns array<struct<turn: bigint, role: string, text: string>>",
        "Conversation",
    )
    turns = load(spark, folder, "conversations")
    key = F.col("conv_id").alias("Conversation_id")
    return DocumentTables(
        layout,
        {
            "Conversation": turns.select("conv_id").distinct().select("conv_id", key),
            "Conversation_turns": turns.select("turn", "role", "text", key),
        },
        order={"Conversation_turns": ["turn"]},
    )


LINE = "l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string"


def _line_columns() -> list[str]:
    return model_schema(LINE).names


def order_tables(spark: SparkSession, folder: str) -> DocumentTables:
    """Orders with their lines. The stored lines have no position; they go by line number."""
    layout = table_layout(
        f"o_orderkey bigint, o_orderstatus string, lines array<struct<{LINE}>>", "Order"
    )
    return DocumentTables(
        layout,
        {
            "Order": load(spark, folder, "orders").select(
                "o_orderkey", "o_orderstatus", F.col("o_orderkey").alias("Order_id")
            ),
            "Order_lines": load(spark, folder, "lineitem").select(
                *_line_columns(), F.col("l_orderkey").alias("Order_id")
            ),
        },
        order={"Order_lines": ["l_linenumber"]},
    )


def customer_tables(spark: SparkSession, folder: str) -> DocumentTables:
    """Customers with their orders, and those with their lines."""
    layout = table_layout(
        "c_custkey bigint, c_name string, orders array<struct<"
        f"o_orderkey: bigint, o_orderstatus: string, lines: array<struct<{LINE}>>>>",
        "Customer",
    )
    return DocumentTables(
        layout,
        {
            "Customer": load(spark, folder, "customer").select(
                "c_custkey", "c_name", F.col("c_custkey").alias("Customer_id")
            ),
            "Customer_orders": load(spark, folder, "orders").select(
                "o_orderkey",
                "o_orderstatus",
                F.col("o_orderkey").alias("Customer_orders_id"),
                F.col("o_custkey").alias("Customer_id"),
            ),
            "Customer_orders_lines": load(spark, folder, "lineitem").select(
                *_line_columns(), F.col("l_orderkey").alias("Customer_orders_id")
            ),
        },
        order={"Customer_orders_lines": ["l_linenumber"]},
    )


def amount_tables(spark: SparkSession, folder: str) -> DocumentTables:
    """Customers, orders and lines with the same column names on every level."""
    layout = table_layout(
        "name string, amount double, orders array<struct<status: string, amount: double,"
        " lines: array<struct<status: string, amount: double>>>>",
        "Customer",
    )
    return DocumentTables(
        layout,
        {
            "Customer": load(spark, folder, "customer").select(
                F.col("c_name").alias("name"),
                F.col("c_acctbal").alias("amount"),
                F.col("c_custkey").alias("Customer_id"),
            ),
            "Customer_orders": load(spark, folder, "orders").select(
                F.col("o_orderstatus").alias("status"),
                F.col("o_totalprice").alias("amount"),
                F.col("o_orderkey").alias("Customer_orders_id"),
                F.col("o_custkey").alias("Customer_id"),
            ),
            "Customer_orders_lines": load(spark, folder, "lineitem").select(
                F.col("l_linestatus").alias("status"),
                F.col("l_extendedprice").alias("amount"),
                F.col("l_orderkey").alias("Customer_orders_id"),
            ),
        },
    )
