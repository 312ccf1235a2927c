"""What the plans read, shuffle and push down."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe import (
    DocumentTables,
    absent_rows,
    assemble,
    difference,
    fetch,
    field,
    load_tables,
    owner_keys,
    save_tables,
    shred,
)
from nestframe.operators.assemble import _any_list_over

MODEL = T.StructType(
    [
        field("name", "string", required=True),
        field("note", "string"),
        T.StructField(
            "parts",
            T.ArrayType(
                T.StructType(
                    [
                        field("label", "string", required=True),
                        field("weight", "float"),
                        T.StructField("marks", T.ArrayType(T.LongType())),
                        T.StructField("bolts", T.ArrayType(T.StructType([field("kind", "string")]))),
                    ]
                )
            ),
        ),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Documents in a file, and their tables in files."""
    folder = tmp_path_factory.mktemp("plans")
    rows = [
        (f"n{i}", "x", [("l", 1.0, [1, 2], [("m4",)]), ("r", 2.0, [], [])], ["t", "u"])
        for i in range(50)
    ]
    spark.createDataFrame(rows, MODEL).write.parquet(str(folder / "documents"))
    documents = spark.read.parquet(str(folder / "documents"))
    tables = shred(documents, "D", key="name", model=MODEL)
    frames = {}
    for name, frame in tables.frames.items():
        frame.write.parquet(str(folder / name))
        frames[name] = spark.read.parquet(str(folder / name))
    return tables, DocumentTables(tables.layout, frames)


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def explain(frame):
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return frame._jdf.queryExecution().explainString(mode.fromString("formatted"))


def read_schemas(frame):
    return set(re.findall(r"ReadSchema: struct<(.*)>", explain(frame)))


def shuffles(frame):
    return len(re.findall(r"\n\(\d+\) Exchange", explain(frame)))


def test_shredding_shuffles_nothing_and_reads_what_it_stores(stored):
    tables, _ = stored
    expected = {
        "D": "name:string,note:string",
        # that an item is NULL is seen on the whole item only
        "D_parts": "name:string,parts:array<struct<label:string,weight:double,"
        "marks:array<bigint>,bolts:array<struct<kind:string>>>>",
        "D_parts_marks": "name:string,parts:array<struct<marks:array<bigint>>>",
        "D_parts_bolts": "name:string,parts:array<struct<bolts:array<struct<kind:string>>>>",
        "D_tags": "name:string,tags:array<string>",
    }
    for name, schema in expected.items():
        assert read_schemas(tables[name]) == {schema}
        assert shuffles(tables[name]) == 0


def test_items_that_break_the_model_are_kept(spark):
    """A required value may be missing in the data; the audits report it, the row stays."""
    loose = "name string, parts array<struct<label: string, weight: double, marks array<bigint>>>"
    rows = [("a", [(None, 1.0, [1]), None, ("l", None, [2])])]
    element = T.StructType(MODEL["parts"].dataType.elementType.fields[:3])
    model = T.StructType([MODEL["name"], T.StructField("parts", T.ArrayType(element))])
    tables = shred(spark.createDataFrame(rows, loose), "D", key="name", model=model)
    parts = tables["D_parts"].orderBy("_pos").collect()
    assert [(r["label"], r["weight"], r["_pos"]) for r in parts] == [(None, 1.0, 0), ("l", None, 2)]
    assert tables["D_parts_marks"].count() == 2


def test_unrequested_columns_and_tables_are_not_read(stored):
    _, tables = stored
    schemas = read_schemas(assemble(tables, ["name", "parts.label"]))
    assert schemas == {
        "name:string,D_id:string",
        "label:string,D_parts_id:string,D_id:string,_pos:int",
    }


def test_each_table_moves_once_per_level(stored, no_broadcast):
    _, tables = stored
    assert shuffles(assemble(tables, ["name", "tags"])) == 2
    assert shuffles(assemble(tables, ["name", "parts.label"])) == 2
    # two lists below the parts, the parts to meet them, the parts to meet the root, the root
    assert shuffles(assemble(tables, ["parts.marks", "parts.bolts"])) == 5


def test_semi_join_and_collecting_share_a_shuffle(spark, stored, no_broadcast):
    _, tables = stored
    keys = owner_keys(tables, "D_parts", F.col("weight") > 1)
    frame = fetch(tables, matching=keys, max_rows=None, fields=["name", "tags"])
    # the keys, once for each table they select from, and these two tables
    assert shuffles(frame) == 4


def test_looking_for_long_lists_uses_statistics(stored):
    _, tables = stored
    over = tables["D_tags"].where(F.col("_pos") >= 1000)
    assert "GreaterThanOrEqual(_pos,1000)" in explain(over)
    assert not _any_list_over(tables, tables.layout, 2)
    assert _any_list_over(tables, tables.layout, 1)


def test_small_batch_does_not_shuffle_the_stored_rows(spark):
    stored = spark.range(50_000_000)
    plan = absent_rows(spark.range(3), stored, "id")._jdf.queryExecution().executedPlan().toString()
    semi = plan[plan.index("LeftSemi, BuildRight") :]
    assert "Range (0, 50000000" in semi.splitlines()[1]


def test_key_reads_one_bucket(spark, stored):
    tables, _ = stored
    spark.sql("CREATE DATABASE IF NOT EXISTS plans")
    save_tables(tables, "plans", buckets=8)
    loaded = load_tables(spark, tables.layout, "plans")
    text = explain(fetch(loaded, max_rows=1, fields=["name", "tags"]))
    assert "SelectedBucketsCount: 1 out of 8" in text


def test_gathered_lists_are_not_dealt_again_to_join_more_buckets(spark):
    """With more buckets than the session has partitions, lists go to as many as their owners are in."""
    spark.sql("CREATE DATABASE IF NOT EXISTS dealt_once")
    rows = [(i, [([f"w{j}" for j in range(i % 5)], f"t{i}")] * 3) for i in range(200)]
    tables = shred(spark.createDataFrame(rows, "k long, items array<struct<words: array<string>, t: string>>"), "Doc", key="k")
    save_tables(tables, "dealt_once", buckets=9)
    loaded = load_tables(spark, tables.layout, "dealt_once")
    assert loaded.buckets == {"Doc": 9, "Doc_items": 9}
    kept = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rebuilt = assemble(loaded)
        assert rebuilt._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert tuple(difference(assemble(tables), rebuilt).first()) == (0, 0)
