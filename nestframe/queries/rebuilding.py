"""Putting documents together again."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe import assemble, canonical, difference, durable, locate_differences, nan_as_null, shred
from nestframe.plans import DocumentTables, table_layout
from nestframe.queries.registry import query
from nestframe.queries.samples import (
    conversation_tables,
    customer_tables,
    load,
    order_tables,
    split_documents,
)
from nestframe.queries.shredding import PARAGRAPHS


def count_if_first(column: str):
    """Items of a list counted over the pieces of a document, each once; see ``assemble``."""
    return F.sum(F.when(~F.contains("_part", F.lit(".")), F.size(column)).otherwise(0))


def cents(item):
    return F.round(item["l_extendedprice"] * 100).cast("long")


def total(items, measure):
    return F.aggregate(items, F.lit(0).cast("long"), lambda sum_, item: sum_ + measure(item))


@query("""
    SELECT vec_id, label, CAST(len(embedding) AS BIGINT) AS n_values, embedding[1] AS first_value,
           embedding[len(embedding)] AS last_value
    FROM embeddings
""")
def assemble_primitive_list(spark: SparkSession, folder: str) -> DataFrame:
    vectors = assemble(shred(load(spark, folder, "embeddings"), "Vector", key="vec_id"))
    return vectors.select(
        "vec_id",
        "label",
        F.size("embedding").cast("long").alias("n_values"),
        F.element_at("embedding", 1).alias("first_value"),
        F.element_at("embedding", -1).alias("last_value"),
    )


@query("""
    SELECT conv_id, count(*) AS n_turns, CAST(sum(length(text)) AS BIGINT) AS n_chars,
           TRUE AS in_order
    FROM conversations GROUP BY conv_id
""")
def assemble_object_list(spark: SparkSession, folder: str) -> DataFrame:
    conversations = assemble(conversation_tables(spark, folder))
    turns = F.col("turns.turn")
    return conversations.groupBy("conv_id").agg(
        F.sum(F.size("turns")).alias("n_turns"),
        F.sum(total(F.col("turns"), lambda t: F.length(t["text"]))).alias("n_chars"),
        F.every(turns == F.sort_array(turns)).alias("in_order"),
    )


@query("""
    SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
""")
def assemble_single_object(spark: SparkSession, folder: str) -> DataFrame:
    layout = table_layout(
        "doc_id bigint, lang string, label struct<quality: int, toxic: int>", "Document"
    )
    key = F.col("doc_id").alias("Document_id")
    tables = DocumentTables(
        layout,
        {
            "Document": load(spark, folder, "documents").select("doc_id", "lang", key),
            "Document_label": load(spark, folder, "labels").select("quality", "toxic", key),
        },
    )
    return assemble(tables).select("doc_id", "lang", "label.quality", "label.toxic")


CUSTOMER_SUMS = """
    SELECT c_custkey, count(DISTINCT o_orderkey) AS n_orders, count(l_orderkey) AS n_lines,
           coalesce(CAST(sum(round(l_extendedprice * 100)) AS BIGINT), 0) AS cents
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
         LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY c_custkey
"""


def customer_rows(customers: DataFrame) -> DataFrame:
    """The same of customers in one row each."""
    lines = F.flatten("orders.lines")
    return customers.select(
        "c_custkey",
        F.size("orders").cast("long").alias("n_orders"),
        F.size(lines).cast("long").alias("n_lines"),
        total(lines, cents).alias("cents"),
    )


def customer_sums(customers: DataFrame, *more: Column) -> DataFrame:
    lines = F.flatten("orders.lines")
    return customers.groupBy("c_custkey").agg(
        count_if_first("orders").alias("n_orders"),
        F.sum(F.size(lines)).alias("n_lines"),
        F.sum(total(lines, cents)).alias("cents"),
        *more,
    )


@query(CUSTOMER_SUMS)
def assemble_three_levels(spark: SparkSession, folder: str) -> DataFrame:
    return customer_rows(assemble(customer_tables(spark, folder)))


@query(f"SELECT *, TRUE AS lists_fit FROM ({CUSTOMER_SUMS})")
def assemble_in_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The same with lists of at most three items, so that most customers come in pieces."""
    customers = assemble(customer_tables(spark, folder), list_size=3)
    orders = F.size("orders") <= 3
    lines = F.forall("orders", lambda order: F.size(order["lines"]) <= 3)
    return customer_sums(customers, F.every(orders & lines).alias("lists_fit"))


@query("""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
           CASE WHEN event_type <> 'error' THEN value END AS nested_value
    FROM events
""", name="nan_as_null")
def replace_nan(spark: SparkSession, folder: str) -> DataFrame:
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    events = load(spark, folder, "events").select(
        "event_id", value.alias("value"), F.array(F.struct(value.alias("value"))).alias("readings")
    )
    cleaned = nan_as_null(events)
    return cleaned.select(
        "event_id", "value", F.col("readings")[0]["value"].alias("nested_value")
    )


@query(f"""
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY text) - 1 AS INTEGER) AS pos,
           text, array_to_string(list_sort(string_split(text, ' ')), ' ') AS words
    FROM ({PARAGRAPHS})
""")
def canonical_nested(spark: SparkSession, folder: str) -> DataFrame:
    documents = split_documents(spark, folder).select(
        "doc_id", F.reverse("paragraphs").alias("paragraphs")
    )
    paragraphs = canonical(documents, by="text").select(
        "doc_id", F.posexplode_outer("paragraphs").alias("pos", "p")
    )
    return paragraphs.select(
        "doc_id", "pos", "p.text", F.array_join("p.words", " ").alias("words")
    )


@query("SELECT CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_extra")
def round_trip_diff(spark: SparkSession, folder: str) -> DataFrame:
    documents = split_documents(spark, folder)
    fields = [*documents.columns[:-1], "paragraphs.text", "paragraphs.words"]
    rebuilt = assemble(shred(documents, "Document", key="doc_id"), fields)
    return difference(documents, rebuilt.drop("id", "_part"))


@query("""
    SELECT vec_id, CAST(p - 1 AS INTEGER) AS pos, embedding[p] AS value
    FROM embeddings, LATERAL unnest(range(1, len(embedding) + 1)) AS r(p)
""")
def assemble_list_values(spark: SparkSession, folder: str) -> DataFrame:
    """Each value of a rebuilt list at its place."""
    vectors = assemble(shred(load(spark, folder, "embeddings"), "Vector", key="vec_id"))
    return vectors.select("vec_id", F.posexplode("embedding").alias("pos", "value"))


@query("""
    SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos,
           turn, role, text
    FROM conversations
""")
def assemble_list_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Each object of a rebuilt list at its place."""
    talks = assemble(conversation_tables(spark, folder))
    items = talks.select("conv_id", F.posexplode("turns").alias("pos", "item"))
    return items.select("conv_id", "pos", "item.turn", "item.role", "item.text")


@query("""
    SELECT orders.*, lineitem.* EXCLUDE (l_orderkey)
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
""")
def assemble_full_width(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and lines with all their columns, rebuilt and taken apart line by line."""
    orders, lines = load(spark, folder, "orders"), load(spark, folder, "lineitem")
    line = T.StructType([f for f in lines.schema if f.name != "l_orderkey"])
    model = T.StructType([*orders.schema, T.StructField("lines", T.ArrayType(line))])
    frames = {
        "Order": orders.select("*", F.col("o_orderkey").alias("Order_id")),
        "Order_lines": lines.withColumnRenamed("l_orderkey", "Order_id"),
    }
    order = {"Order_lines": ["l_linenumber"]}
    whole = assemble(DocumentTables(table_layout(model, "Order"), frames, order=order))
    return whole.select(*orders.columns, F.inline("lines")).drop("id")


@query("""
    SELECT CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_extra, count(*) AS n_documents FROM documents
""")
def difference_of_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in pieces of seven paragraphs and words against the same in a row each."""
    documents = split_documents(spark, folder)
    tables = shred(documents, "Document", key="doc_id")
    fields = [*documents.columns[:-1], "paragraphs.text", "paragraphs.words"]
    rebuilt = assemble(tables, fields, list_size=7)
    whole = rebuilt.where("_part = '0'").agg(F.count("*").alias("n_documents"))
    return difference(documents, rebuilt).join(F.broadcast(whole))


@query("""
    SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY role, turn, text) - 1 AS INTEGER) AS pos,
           turn, role, text
    FROM conversations
""")
def canonical_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Turns sorted by role over all pieces of a conversation, in pieces of two again."""
    talks = assemble(conversation_tables(spark, folder), list_size=2)
    ordered = canonical(talks, by="role", list_size=2)
    place = (F.col("_part").cast("int") + F.col("i")).alias("pos")
    items = ordered.select("conv_id", "_part", F.posexplode("turns").alias("i", "item"))
    return items.select("conv_id", place, "item.turn", "item.role", "item.text")


@query("""
    SELECT o_orderkey, CAST(count(l_orderkey) AS BIGINT) AS n_lines, coalesce(min(l_linenumber), 0) AS first_line
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def shred_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in pieces of two lines taken apart again: each order once, its lines numbered throughout."""
    orders = assemble(order_tables(spark, folder), list_size=2)
    tables = shred(orders, "Order", key="o_orderkey")
    counts = tables["Order_lines"].groupBy("Order_id").agg(
        F.count("*").alias("n"), (F.max("_pos") + 1).alias("span"), F.min("l_linenumber").alias("first_line")
    )
    found = tables["Order"].join(counts, "Order_id", "left").where("n IS NULL OR n = span")
    zero = F.lit(0)
    return found.select("o_orderkey", F.coalesce("n", zero).cast("long").alias("n_lines"), F.coalesce("first_line", zero).alias("first_line"))


@query("""
    WITH sides AS (SELECT *, doc_id % 49 <> 0 AS expected, doc_id % 50 <> 0 AS actual FROM documents),
    shared AS (SELECT * FROM sides WHERE expected AND actual)
    SELECT CAST(doc_id AS VARCHAR) AS document, '' AS path, CAST(NULL AS BIGINT) AS pos, 'missing' AS kind
    FROM sides WHERE expected AND NOT actual
    UNION ALL SELECT CAST(doc_id AS VARCHAR), '', NULL, 'extra' FROM sides WHERE actual AND NOT expected
    UNION ALL SELECT CAST(doc_id AS VARCHAR), '', NULL, 'changed' FROM shared WHERE doc_id % 11 = 1
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 'paragraphs.words', 0, 'changed' FROM shared WHERE doc_id % 13 = 2
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 'paragraphs', len(string_split(text, chr(10))), 'extra' FROM shared WHERE doc_id % 17 = 3
""")
def difference_located(spark: SparkSession, folder: str) -> DataFrame:
    """Documents left out, added, of another length, with another first word, with a paragraph more: each is told where."""
    documents = split_documents(spark, folder)
    marked = lambda words: F.transform(words, lambda w, i: F.when(i == 0, F.concat(w, F.lit("!"))).otherwise(w))
    reworded = F.transform(
        "paragraphs",
        lambda p, i: F.when((F.col("doc_id") % 13 == 2) & (i == 0), p.withField("words", marked(p["words"]))).otherwise(p),
    )
    more = F.array(F.struct(F.lit("more").alias("text"), F.array(F.lit("more")).alias("words")))
    changed = documents.withColumns(
        {
            "n_chars": F.when(F.col("doc_id") % 11 == 1, F.col("n_chars") + 1).otherwise(F.col("n_chars")),
            "paragraphs": F.when(F.col("doc_id") % 17 == 3, F.concat(reworded, more)).otherwise(reworded),
        }
    )
    sides = [
        shred(durable(rows, compression="zstd"), "Document", key="doc_id")
        for rows in (documents.where("doc_id % 49 <> 0"), changed.where("doc_id % 50 <> 0"))
    ]
    return locate_differences(*sides).select("document", "path", "pos", "kind")
