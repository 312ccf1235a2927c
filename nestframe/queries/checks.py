"""Types, constraints, counts and insertion."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe import (
    DocumentTables,
    absent_rows,
    audit_foreign_key,
    audit_model,
    audit_not_null,
    audit_primary_key,
    conform,
    field,
    parse_documents,
    table_counts,
    table_layout,
    text_output,
)
from nestframe.queries.registry import query
from nestframe.queries.samples import customer_tables, labelled_documents, load


@query("""
    SELECT 'Customer' AS table_name, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'Customer_orders', count(*) FROM orders
    UNION ALL SELECT 'Customer_orders_lines', count(*) FROM lineitem
""", name="table_counts")
def count_tables(spark: SparkSession, folder: str) -> DataFrame:
    return table_counts(customer_tables(spark, folder))


@query("""
    SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey NOT IN (
        SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
""")
def append_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer is offered twice, and those of two segments are stored already."""
    customers = load(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    stored = customers.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return absent_rows(customers.union(customers), stored, "c_custkey")


@query("""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           CASE WHEN event_type = 'error' THEN 'value: no double: n/a' ELSE '' END AS faults
    FROM events
""")
def conform_types(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers given as text, with the value of error events not a number."""
    value = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    texts = load(spark, folder, "events").select(
        "event_id", value.alias("value"), F.get_json_object("props", "$.k").alias("k")
    )
    checked = conform(texts, [field("value", "float"), field("k", "integer")])
    return checked.select("event_id", "value", "k", F.array_join("_reject", "; ").alias("faults"))


@query("""
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate FROM orders
""")
def conform_dates_as_text(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    checked = conform(orders, [field("o_orderdate", "date")], temporal="string")
    return checked.drop("_reject")


@query("""
    SELECT o_orderkey, o_orderpriority,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN ''
                ELSE 'o_orderpriority: not allowed: ' || o_orderpriority END AS faults
    FROM orders
""")
def conform_enum(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    priority = field("o_orderpriority", "string", allowed=["1-URGENT", "2-HIGH"])
    return conform(orders, [priority]).select(
        "o_orderkey", "o_orderpriority", F.array_join("_reject", "; ").alias("faults")
    )


@query("SELECT c_custkey, c_acctbal, c_acctbal > 0 AS accepted FROM customer")
def conform_positive(spark: SparkSession, folder: str) -> DataFrame:
    customers = load(spark, folder, "customer").select("c_custkey", "c_acctbal")
    checked = conform(customers, [field("c_acctbal", "PositiveFloat")])
    return checked.select(
        "c_custkey", "c_acctbal", (F.size("_reject") == 0).alias("accepted")
    )


@query("""
    SELECT doc_id, base64(encode(text)) AS body, CAST(quality AS VARCHAR) AS quality
    FROM documents LEFT JOIN labels USING (doc_id)
""", name="text_output")
def bytes_and_enums_as_text(spark: SparkSession, folder: str) -> DataFrame:
    documents = load(spark, folder, "documents").select(
        "doc_id", F.encode("text", "UTF-8").alias("body")
    )
    labels = load(spark, folder, "labels").select("doc_id", "quality")
    model = T.StructType([field("quality", T.IntegerType(), allowed=[0, 1])])
    return text_output(documents.join(labels, "doc_id", "left"), model)


@query("""
    SELECT 'doc_id' AS "column", count(*) FILTER (doc_id IS NULL) AS n_null
    FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL
    SELECT 'quality', count(*) FILTER (quality IS NULL)
    FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL
    SELECT 'toxic', count(*) FILTER (toxic IS NULL)
    FROM documents LEFT JOIN labels USING (doc_id)
""", name="audit_not_null")
def find_missing_values(spark: SparkSession, folder: str) -> DataFrame:
    documents = labelled_documents(spark, folder).select("doc_id", "label.*")
    return audit_not_null(documents, ["doc_id", "quality", "toxic"])


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""", name="audit_primary_key")
def find_repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return audit_primary_key(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT l_orderkey, count(*) AS n_rows FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    GROUP BY l_orderkey
""", name="audit_foreign_key")
def find_missing_parents(spark: SparkSession, folder: str) -> DataFrame:
    finished = load(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    return audit_foreign_key(load(spark, folder, "lineitem"), "l_orderkey", finished, "o_orderkey")


@query("""
    SELECT 'Order_lines' AS table_name, 'Order_id' AS "column", 'no parent' AS fault, count(*) AS n_rows
    FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    UNION ALL
    SELECT 'Order', 'o_orderpriority', 'missing', count(*) FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    UNION ALL
    SELECT 'Order_lines', 'Order_lines_id', 'repeated', sum(n - 1)::BIGINT
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
""", name="audit_model")
def audit_whole_model(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without those not finished, some without their priority, and lines with repeated keys."""
    line = T.StructType([T.StructField("l_quantity", T.DoubleType())])
    model = T.StructType([field("o_orderpriority", "string", required=True), T.StructField("lines", T.ArrayType(line))])
    key = F.concat_ws("/", "l_orderkey", "l_linenumber").alias("Order_lines_id")
    orders = load(spark, folder, "orders").where("o_orderstatus = 'F'")
    priority = F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("o_orderpriority")
    frames = {
        "Order": orders.select(priority, F.col("o_orderkey").alias("Order_id")),
        "Order_lines": load(spark, folder, "lineitem").select("l_quantity", F.col("l_orderkey").alias("Order_id"), key),
    }
    return audit_model(DocumentTables(table_layout(model, "Order"), frames))


@query("""
    SELECT event_id, event_type,
           CASE WHEN event_type <> 'error'
                THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
           CASE WHEN event_type = 'error' THEN left(props, length(props) - 1) END AS _reject
    FROM events
""")
def json_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Properties as JSON text, with that of error events cut off before its last character."""
    cut = F.expr("left(props, length(props) - 1)")
    props = F.when(F.col("event_type") == "error", cut).otherwise(F.col("props"))
    events = load(spark, folder, "events").select("event_id", "event_type", props.alias("props"))
    return parse_documents(events, "props", "k bigint")


@query("""
    SELECT doc_id, text, CAST(list_sort([lang, 'text']) AS VARCHAR[])[1] AS first_tag,
           source AS repo, CAST(NULL AS VARCHAR) AS _reject
    FROM documents
""")
def document_provenance(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as JSON text, with lists and where they are from, read by their model."""
    source = F.struct(F.col("source").alias("repo")).alias("__source__")
    tags = F.sort_array(F.array("lang", F.lit("text"))).alias("tags")
    texts = load(spark, folder, "documents").select(
        F.to_json(F.struct("doc_id", "text", tags, source)).alias("json")
    )
    model = "doc_id bigint, text string, tags array<string>, __source__ struct<repo: string>"
    return parse_documents(texts, "json", model).select(
        "doc_id", "text", F.col("tags")[0].alias("first_tag"), "__source__.repo", "_reject"
    )
