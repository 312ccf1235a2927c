"""Types, constraints and insertion of absent rows."""

import datetime
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestframe import (
    absent_rows,
    audit_foreign_key,
    audit_not_null,
    audit_primary_key,
    canonical,
    conform,
    difference,
    field,
    model_schema,
    nan_as_null,
    required_columns,
    shred,
    spark_type,
    table_counts,
    table_layout,
    text_output,
)


def test_type_names():
    assert spark_type("integer") == T.LongType()
    assert spark_type("float") == T.DoubleType()
    assert spark_type("string") == T.StringType()
    assert spark_type("boolean") == T.BooleanType()
    for unsupported in ("list", "Decimal", list):
        with pytest.raises(ValueError):
            spark_type(unsupported)


def test_required_and_optional_fields():
    foo, bar = field("foo", "string", required=True), field("bar", "integer")
    assert (foo.dataType, foo.nullable) == (T.StringType(), False)
    assert (bar.dataType, bar.nullable) == (T.LongType(), True)
    with pytest.raises(ValueError):
        field("mixed", "string", allowed=["a", 1])


def test_model_forms(spark):
    struct = T.StructType([field("foo", "string", required=True), field("n", "PositiveInt")])
    assert model_schema(struct) == struct
    read = model_schema(struct.json())
    assert read == struct and read["n"].metadata == {"positive": True}
    assert model_schema("foo string not null, n bigint")["foo"].nullable is False


def test_conform(spark):
    model = [
        field("n", "PositiveInt", required=True),
        field("kind", "string", allowed=["a", "b"]),
        field("day", "date"),
        field("flag", "boolean"),
    ]
    rows = spark.createDataFrame(
        [
            ("1", "a", "2024-02-29", "true", "good"),
            ("-1", "c", "2023-02-29", "maybe", "bad"),
            (None, None, None, None, "none"),
            ("x", "b", "2024-01-01", "false", "text"),
        ],
        "n string, kind string, day string, flag string, other string",
    )
    result = {r["other"]: r for r in conform(rows, model).collect()}
    good = result["good"]
    assert (good["n"], good["day"], good["flag"]) == (1, datetime.date(2024, 2, 29), True)
    assert good["_reject"] == []
    assert result["bad"]["_reject"] == [
        "n: not positive: -1",
        "kind: not allowed: c",
        "day: no date: 2023-02-29",
        "flag: no boolean: maybe",
    ]
    assert result["bad"]["n"] == -1 and result["bad"]["day"] is None
    assert result["none"]["_reject"] == ["n: missing"]
    assert result["text"]["_reject"] == ["n: no bigint: x"]
    assert conform(rows, model, temporal="string").schema["day"].dataType == T.StringType()
    with pytest.raises(ValueError):
        conform(rows, [field("absent", "string")])
    assert conform(rows, []).schema["_reject"].dataType == T.ArrayType(T.StringType())


def test_constraints_travel_to_the_tables(spark):
    model = T.StructType(
        [
            field("name", "string", required=True),
            T.StructField("items", T.ArrayType(T.StructType([field("n", "PositiveInt", True)]))),
        ]
    )
    layout = table_layout(model, "D")
    assert required_columns(layout) == ["name", "D_id"]
    items = layout.find("D_items")
    assert required_columns(items) == ["n", "D_items_id"]
    documents = spark.createDataFrame([("a", [(1,), (-2,)])], "name string, items array<struct<n: bigint>>")
    tables = shred(documents, "D", key="name", model=model)
    checked = conform(tables["D_items"], items.scalars)
    assert sorted(len(r["_reject"]) for r in checked.collect()) == [0, 1]


def test_text_output(spark):
    rows = spark.createDataFrame(
        [(1, bytearray(b"x" * 100), [bytearray(b"y")])], "e int, b binary, l array<binary>"
    )
    row = text_output(rows, T.StructType([field("e", T.IntegerType(), allowed=[1])])).first()
    assert row["e"] == "1" and row["l"] == ["eQ=="] and "\n" not in row["b"]


def test_audits(spark):
    rows = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, None), (None, "z"), (9, "a"), (9, "a")], "k int, v string"
    )
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    assert {tuple(r) for r in audit_not_null(rows, ["k", "v"]).collect()} == {("k", 1), ("v", 1)}
    assert {tuple(r) for r in audit_primary_key(rows, "k").collect()} == {(1, 2), (9, 2)}
    assert [tuple(r) for r in audit_primary_key(rows, ["k", "v"]).collect()] == [(9, "a", 2)]
    assert [tuple(r) for r in audit_foreign_key(rows, "k", parents, "id").collect()] == [(9, 2)]


def test_difference_counts_copies(spark):
    left = spark.createDataFrame([(1, ["a"]), (1, ["a"]), (2, None)], "k int, v array<string>")
    right = spark.createDataFrame([(["a"], 1), (["b"], 2)], "v array<string>, k int")
    assert tuple(difference(left, right).first()) == (2, 1)
    assert tuple(difference(left, left).first()) == (0, 0)
    assert tuple(difference(left.limit(0), right.limit(0)).first()) == (0, 0)


def test_table_counts(spark):
    documents = spark.createDataFrame([("a", [1, 2, 3])], "name string, marks array<int>")
    counts = table_counts(shred(documents, "D", key="name"))
    assert {tuple(r) for r in counts.collect()} == {("D", 1), ("D_marks", 3)}


def test_absent_rows(spark):
    stored = spark.createDataFrame([(1, "old"), (None, "old")], "k int, v string")
    new = spark.createDataFrame(
        [(1, "new"), (2, "b"), (2, "a"), (None, "new"), (3, None)], "k int, v string"
    )
    assert sorted(map(tuple, absent_rows(new, stored, "k").collect())) == [(2, "a"), (3, None)]
    assert absent_rows(new, stored.limit(0), "k").count() == 4
    only_keys = absent_rows(new.select("k"), stored, "k")
    assert sorted(r["k"] for r in only_keys.collect()) == [2, 3]
    pairs = absent_rows(new, stored, ["k", "v"])
    assert pairs.count() == 5


def test_canonical_and_nan(spark):
    rows = spark.createDataFrame(
        [([{"name": "b", "m": [3.0, 1.0]}, {"name": "a", "m": None}], float("nan"), [2, 1])],
        "items array<struct<name: string, m: array<double>>>, x double, l array<int>",
    )
    row = canonical(rows, by="name").first()
    assert [i["name"] for i in row["items"]] == ["a", "b"]
    assert row["items"][1]["m"] == [1.0, 3.0] and row["l"] == [1, 2]
    assert canonical(rows).schema == rows.schema
    assert math.isnan(row["x"])
    holes = rows.withColumn("items", F.transform("items", lambda i: i.withField("m", F.array(F.lit(float("nan"))))))
    cleaned = nan_as_null(holes).first()
    assert cleaned["x"] is None and cleaned["items"][0]["m"] == [None]


LOSSES = [
    ("'1.239'", "string", "decimal(5,2)", ["v: loses: 1.239"]),
    ("'1.230'", "string", "decimal(5,2)", []),
    ("'2020-01-01 10:00:00'", "string", "date", ["v: loses: 2020-01-01 10:00:00"]),
    ("'2020-01-01'", "string", "date", []),
    ("'2020-01-01 00:00:00.1234567'", "string", "timestamp", ["v: loses: 2020-01-01 00:00:00.1234567"]),
    ("'2020-01-01 00:00:00.123456'", "string", "timestamp", []),
    ("'0.1'", "string", "double", []),
    ("'1.2345678901234567'", "string", "float", ["v: loses: 1.2345678901234567"]),
    ("'1e400'", "string", "double", ["v: loses: 1e400"]),
    ("'x'", "string", "boolean", ["v: no boolean: x"]),
    ("5", "int", "boolean", ["v: loses: 5"]),
    ("300", "int", "tinyint", ["v: no tinyint: 300"]),
    ("struct('x' AS q, '1' AS r)", "", "struct<q: int, r: int>", ["v.q: no int: x"]),
    ("array('1', 'y', NULL)", "", "array<int>", ["v: no int: y"]),
    ("array(struct(array('1.5', 'z') AS a))", "", "array<struct<a: array<int>>>", ["v.a: no int: 1.5", "v.a: no int: z"]),
    ("array(struct(TIMESTAMP'2020-01-01 10:00:00' AS t))", "", "array<struct<t: date>>", ["v.t: loses: 2020-01-01 10:00:00"]),
    ("CAST(NULL AS struct<q: string>)", "", "struct<q: int>", []),
]


def test_every_loss_is_listed(spark):
    """Losses of text and of other types, on every level."""
    for value, _, dtype, wanted in LOSSES:
        rows = spark.sql(f"SELECT {value} AS v")
        model = T.StructType([T.StructField("v", T.StructType.fromDDL(f"v {dtype}")["v"].dataType)])
        assert conform(rows, model).first()["_reject"] == wanted, (value, dtype)
