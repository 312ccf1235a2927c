"""Storing documents in Spark's table catalog and reading them again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe import (
    assemble,
    audit_foreign_key,
    conform,
    create_store,
    difference,
    durable,
    field,
    insert,
    load_tables,
    open_store,
    save_tables,
    shred,
    store_stream,
    text_output,
)
from nestframe.operators.durable import shared_path
from nestframe.plans import table_layout
from nestframe.queries.registry import query
from nestframe.queries.samples import load, split_documents
from nestframe.queries.shredding import PARAGRAPHS
from nestframe.sources import Store


def new_database(spark: SparkSession) -> str:
    name = f"nestframe_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def conversations(spark: SparkSession, folder: str, text: F.Column) -> DataFrame:
    turn = F.struct("turn", "role", text.alias("text"))
    turns = F.array_sort(F.collect_list(turn)).alias("turns")
    return load(spark, folder, "conversations").groupBy("conv_id").agg(turns)


def twice_stored(spark: SparkSession, folder: str, on_conflict: str) -> DataFrame:
    """All conversations, then all again, of which every third has other texts."""
    other = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("new "), "text")).otherwise(F.col("text"))
    database = new_database(spark)
    first = shred(conversations(spark, folder, F.col("text")), "Talk", key="conv_id", bad_keys="trust")
    second = shred(conversations(spark, folder, other), "Talk", key="conv_id", bad_keys="trust")
    insert(first, database)
    refused = insert(second, database, on_conflict).select("Talk_id", F.lit(True).alias("refused"))
    stored = assemble(load_tables(spark, first.layout, database)).select("conv_id", F.inline("turns"))
    stored = stored.join(refused, F.col("conv_id") == F.col("Talk_id"), "left")
    return stored.select("conv_id", "turn", "role", "text", F.coalesce("refused", F.lit(False)).alias("refused"))


@query("SELECT conv_id, turn, role, text, conv_id % 3 = 0 AS refused FROM conversations")
def insert_revised(spark: SparkSession, folder: str) -> DataFrame:
    """The stored version of a revised document stays, whole, and the other is reported."""
    return twice_stored(spark, folder, "keep")


@query("""
    SELECT conv_id, turn, role, CASE WHEN conv_id % 3 = 0 THEN 'new ' || text ELSE text END AS text,
           false AS refused
    FROM conversations
""")
def insert_replacing(spark: SparkSession, folder: str) -> DataFrame:
    """The new version of a revised document takes the place of the stored one, whole."""
    return twice_stored(spark, folder, "replace")


@query("""
    SELECT c_custkey, c_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment
    FROM customer
""")
def insert_new_attribute(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of one segment come without it, the others with it."""
    customers, database = load(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"), new_database(spark)
    building = F.col("c_mktsegment") == "BUILDING"
    insert(shred(customers.where(building).drop("c_mktsegment"), "Customer", key="c_custkey"), database)
    insert(shred(customers.where(~building), "Customer", key="c_custkey"), database)
    return spark.table(f"{database}.Customer").drop("Customer_id")


@query("""
    SELECT CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_extra, count(*) AS n_documents,
           CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_paragraphs
    FROM documents
""")
def stored_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of three levels, stored in buckets, loaded, rebuilt and compared."""
    documents, database = split_documents(spark, folder), new_database(spark)
    tables = shred(documents, "Document", key="doc_id")
    save_tables(tables, database, buckets=4)
    loaded = load_tables(spark, tables.layout, database)
    fields = [*documents.columns[:-1], "paragraphs.text", "paragraphs.words"]
    rebuilt = assemble(loaded, fields).drop("id", "_part")
    counts = rebuilt.agg(F.count("*").alias("n_documents"), F.sum(F.size("paragraphs")).alias("n_paragraphs"))
    compared = difference(documents, rebuilt)
    return compared.crossJoin(counts)


@query("""
    SELECT event_id,
           left(sha256(CAST(to_json({'user_id': user_id, 'ts': CAST(ts AS VARCHAR)}) AS VARCHAR)), 32) AS "Reading_id"
    FROM events
""")
def shred_by_time_key(spark: SparkSession, folder: str) -> DataFrame:
    """Times are part of keys to the microsecond and whatever the session's time zone."""
    return shred(load(spark, folder, "events"), "Reading", key=["user_id", "ts"])["Reading"].select("event_id", "Reading_id")


@query(f"""
    SELECT doc_id, CAST(pos AS INTEGER) AS _pos, CASE WHEN lang <> 'de' THEN text END AS text, 0 AS n_orphans
    FROM ({PARAGRAPHS}) JOIN (SELECT doc_id, lang FROM documents) USING (doc_id)
""")
def shred_with_required(spark: SparkSession, folder: str) -> DataFrame:
    """German paragraphs lack the one scalar that the model requires; they stay, as do their words."""
    documents = split_documents(spark, folder)
    missing = F.transform(
        "paragraphs", lambda p: F.when(F.col("lang") == "de", p.withField("text", F.lit(None).cast("string"))).otherwise(p)
    )
    paragraph = T.StructType([field("text", "string", required=True), T.StructField("words", T.ArrayType(T.StringType()))])
    model = T.StructType([documents.schema["doc_id"], T.StructField("paragraphs", T.ArrayType(paragraph))])
    tables = shred(documents.withColumn("paragraphs", missing), "Document", key="doc_id", model=model)
    paragraphs = tables["Document_paragraphs"]
    orphans = audit_foreign_key(
        tables["Document_paragraphs_words"], "Document_paragraphs_id", paragraphs, "Document_paragraphs_id"
    )
    n_orphans = orphans.agg(F.count("*").cast("int").alias("n_orphans"))
    return paragraphs.select(F.col("Document_id").alias("doc_id"), "_pos", "text").join(F.broadcast(n_orphans))


@query("""
    SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS c_acctbal,
           CASE WHEN c_acctbal <> trunc(c_acctbal) THEN 1 ELSE 0 END AS n_faults
    FROM customer
""")
def conform_lossy(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts taken for whole numbers: what the cast cuts off is reported."""
    checked = conform(load(spark, folder, "customer").select("c_custkey", "c_acctbal"), [field("c_acctbal", "integer")])
    return checked.select("c_custkey", "c_acctbal", F.size("_reject").alias("n_faults"))


@query("""
    SELECT conv_id, CAST(count(*) FILTER (role = 'system') + count(*) FILTER (text = '') AS INTEGER) AS n_faults
    FROM conversations GROUP BY conv_id
""")
def conform_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Roles other than two and texts that are missing, in the objects of a list."""
    talks = conversations(spark, folder, F.when(F.col("text") != "", F.col("text")))
    turn = T.StructType(
        [
            T.StructField("turn", T.LongType()),
            field("role", "string", allowed=["user", "assistant"]),
            field("text", "string", required=True),
        ]
    )
    checked = conform(talks, [T.StructField("turns", T.ArrayType(turn))])
    return checked.select("conv_id", F.size("_reject").alias("n_faults"))


@query("SELECT doc_id, CAST(quality AS VARCHAR) AS quality, CAST(toxic AS VARCHAR) AS toxic FROM labels")
def text_output_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Enumerations inside an object and inside the objects of a list become text."""
    labels = load(spark, folder, "labels").select(
        "doc_id", F.struct("quality").alias("one"), F.array(F.struct("toxic")).alias("many")
    )
    one = T.StructType([field("quality", "integer", allowed=[0, 1])])
    many = T.StructType([field("toxic", "integer", allowed=[0, 1])])
    model = T.StructType([T.StructField("one", one), T.StructField("many", T.ArrayType(many))])
    return text_output(labels, model).select("doc_id", "one.quality", F.col("many")[0]["toxic"].alias("toxic"))


def order_store(spark: SparkSession, folder: str) -> Store:
    """All orders with all columns of their lines, in slots by key."""
    lines = load(spark, folder, "lineitem")
    line = F.struct("l_linenumber", *(c for c in lines.columns if c not in ("l_orderkey", "l_linenumber")))
    listed = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    orders = load(spark, folder, "orders").join(listed, F.col("l_orderkey") == F.col("o_orderkey"), "left").drop("l_orderkey")
    tables = shred(durable(orders), "Order", key="o_orderkey", keys="path")
    return create_store(tables, new_database(spark), slots=16)


STORED_LINES = """
    SELECT o_orderkey, o_custkey, o_totalprice, count(l_orderkey) AS n_lines,
           coalesce(CAST(sum(round(l_extendedprice * 100)) AS BIGINT), 0) AS cents
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_orderkey, o_custkey, o_totalprice
"""


def stored_lines(orders: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    cents = F.aggregate("lines", zero, lambda sum_, line: sum_ + F.round(line["l_extendedprice"] * 100).cast("long"))
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", F.size("lines").cast("long").alias("n_lines"), cents.alias("cents"))


@query(f"SELECT * FROM ({STORED_LINES}) ORDER BY o_orderkey LIMIT 10")
def store_first(spark: SparkSession, folder: str) -> DataFrame:
    """The first documents of a store, from its first slot alone."""
    return stored_lines(order_store(spark, folder).first(10))


@query(f"SELECT * FROM ({STORED_LINES}) WHERE o_orderkey IN (7, 42, 999)")
def store_get(spark: SparkSession, folder: str) -> DataFrame:
    """Three documents of a store, from the ranges of their keys."""
    return stored_lines(order_store(spark, folder).get([7, 42, 999]))


@query(f"""
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 100 = 0 THEN -1.0 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderkey % 100 = 0 THEN least(n_lines, 1) ELSE n_lines END AS n_lines
    FROM ({STORED_LINES})
""")
def store_replace(spark: SparkSession, folder: str) -> DataFrame:
    """One order of a hundred replaced by one with another price and its first line only; the others offered again as they are."""
    store = order_store(spark, folder)
    every = assemble(store.tables())
    hundredth = F.col("o_orderkey") % 100 == 0
    revised = every.drop("id", "_part").withColumns(
        {
            "o_totalprice": F.when(hundredth, F.lit(-1.0)).otherwise(F.col("o_totalprice")),
            "lines": F.when(hundredth, F.slice("lines", 1, 1)).otherwise(F.col("lines")),
        }
    )
    store.put(shred(durable(revised), "Order", key="o_orderkey", model=revised.schema, keys="path"))
    return stored_lines(assemble(store.tables())).drop("cents")


@query("""
    SELECT c_custkey, CAST(round(c_acctbal, 2) AS DECIMAL(12,1)) AS rounded, CAST(CAST(c_custkey % 28 + 1 AS VARCHAR) AS INTEGER) AS day,
           CASE WHEN CAST(round(c_acctbal, 2) AS DECIMAL(12,2)) <> CAST(round(c_acctbal, 2) AS DECIMAL(12,1)) THEN 1 ELSE 0 END
           + CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END
           + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS n_faults
    FROM customer
""")
def conform_lossy_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text whose decimals are rounded and whose times are cut off, and text in an object and a list that is no number."""
    day = F.format_string("2020-01-%02d", F.col("c_custkey") % 28 + 1)
    timed = F.when(F.col("c_custkey") % 2 == 0, F.concat(day, F.lit(" 10:30:00"))).otherwise(day)
    number = F.when(F.col("c_mktsegment") == "BUILDING", "x").otherwise(F.lit("17"))
    second = F.when(F.col("c_custkey") % 3 == 0, "y").otherwise(F.lit("2"))
    texts = load(spark, folder, "customer").select(
        "c_custkey",
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("rounded"),
        timed.alias("day"),
        F.struct(number.alias("q")).alias("one"),
        F.array(F.lit("1"), second).alias("many"),
    )
    model = T.StructType.fromDDL("rounded decimal(12,1), day date, one struct<q: int>, many array<int>")
    checked = conform(texts, model)
    return checked.select("c_custkey", "rounded", F.dayofmonth("day").alias("day"), F.size("_reject").alias("n_faults"))


@query("""
    SELECT conv_id, turn, role, CASE WHEN conv_id % 5 = 0 THEN 'new ' || text ELSE text END AS text, n_rejects
    FROM conversations, (SELECT count(DISTINCT conv_id) FILTER (conv_id % 7 = 0) AS n_rejects FROM conversations)
""")
def stream_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as lines of JSON, some of them broken, taken in two batches; revised ones come later."""
    whole = F.to_json(F.struct("conv_id", "turns"))
    first = conversations(spark, folder, F.col("text")).select("conv_id", whole.alias("value"))
    broken = first.where("conv_id % 7 = 0").select(F.substring("value", 1, 20).alias("value"))
    second = conversations(spark, folder, F.concat(F.lit("new "), "text")).where("conv_id % 5 = 0").select(whole.alias("value"))
    files, database, checkpoint = shared_path(spark), new_database(spark), shared_path(spark)
    model = "conv_id bigint, turns array<struct<turn: bigint, role: string, text: string>>"
    for lines in (first.select("value").unionByName(broken), second):
        lines.write.mode("append").text(files)
        store_stream(spark, files, model, "Talk", "conv_id", database, checkpoint, one_per_file=False, slots=4).awaitTermination()
    store = open_store(spark, table_layout(model, "Talk"), database)
    rejects = spark.table(f"{database}.Talk_rejects").agg(F.count("*").alias("n_rejects"))
    talks = assemble(store.tables()).select("conv_id", F.inline("turns")).drop("id")
    return talks.join(F.broadcast(rejects))
