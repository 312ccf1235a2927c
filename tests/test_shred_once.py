"""Taking documents apart in one pass gives the tables of one pass per table."""

import pytest
from pyspark.sql import functions as F

from nestframe import assemble, difference, save_tables, shred, shred_once
from nestframe.operators.shred_once import tagged_rows
from nestframe.plans import table_layout
from tests.test_shred_assemble import DOCUMENTS, MODEL


@pytest.fixture(scope="module")
def documents(spark):
    more = [
        {"name": "d", "size": 4, "tags": None, "owner": {"id": "o", "name": None}, "parts": None},
        {"name": "e/%", "size": 5, "tags": [None], "owner": None,
         "parts": [None, {"id": None, "label": "l", "weight": 0.0, "marks": None, "bolts": [None, {"kind": None}]}]},
    ]
    return spark.createDataFrame(DOCUMENTS + more, MODEL)


def same(one, other):
    assert [t.name for t in one.layout.walk()] == [t.name for t in other.layout.walk()]
    for table in one.layout.walk():
        expected, found = other[table.name], one[table.name]
        assert found.columns == expected.columns
        assert [f.dataType for f in found.schema] == [f.dataType for f in expected.schema]
        assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect())), table.name


@pytest.mark.parametrize("keys", ["digest", "path"])
@pytest.mark.parametrize("key", ["name", ["name", "size"], "size_at"])
def test_same_tables(documents, key, keys):
    if key == "size_at":  # a key of which the text is not all there is to it
        documents = documents.withColumn("size_at", F.timestamp_micros(F.coalesce("size", F.lit(0)) + F.lit(1)))
    same(shred_once(documents, "Thing", key=key, keys=keys), shred(documents, "Thing", key=key, keys=keys))


def test_same_tables_without_a_key_of_copies_and_with_other_options(documents):
    same(shred_once(documents.union(documents), "Thing"), shred(documents, "Thing"))
    options = {"key": "name", "drop_all_null": True, "keep_id": True, "names": {"parts.bolts": "Bolt"}}
    same(shred_once(documents, "Thing", **options), shred(documents, "Thing", **options))


def test_no_documents(documents):
    tables = shred_once(documents.limit(0), "Thing", key="name")
    assert [tables[t.name].count() for t in tables.layout.walk()] == [0] * 6


def test_documents_without_lists(spark):
    flat = spark.createDataFrame([(1, "x")], "k int, v string")
    same(shred_once(flat, "Flat", key="k"), shred(flat, "Flat", key="k"))


def test_bad_keys_are_refused_or_left_out(spark):
    model = "k int, v array<int>, o struct<w: array<int>>"
    rows = [(1, [1], ([7],)), (2, [2], ([8],)), (2, [3], ([9],)), (None, [4], ([10],))]
    documents = spark.createDataFrame(rows, model)
    with pytest.raises(ValueError, match="told apart"):
        shred_once(documents, "D", key="k")
    tables = shred_once(documents, "D", key="k", bad_keys="reject")
    other = shred(documents, "D", key="k", bad_keys="reject")
    same(tables, other)
    assert sorted(map(repr, tables.rejected.collect())) == sorted(map(repr, other.rejected.collect()))
    with pytest.raises(ValueError, match="pieces"):
        shred_once(documents.withColumn("_part", F.lit("0")), "D", key="k")


def test_source_is_read_once_and_not_again(spark, documents, tmp_path, capsys):
    documents.write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    tagged_rows(source, table_layout(MODEL, "Thing"), "name").explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan
    tables = shred_once(source, "Thing", key="name", path=str(tmp_path / "tables"))
    for table in tables.layout.walk():
        assert all("/tables/" in name for name in tables[table.name].inputFiles())
    tables["Thing_parts_bolts"].select("kind").explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(_table" in plan
    assert "ReadSchema: struct<Thing_parts_bolts:struct<kind:string>>" in plan


def test_stored_tables_are_rebuilt_as_documents(spark, documents, tmp_path):
    tables = shred_once(documents, "Once", key="name", path=str(tmp_path / "tables"))
    spark.sql("CREATE DATABASE IF NOT EXISTS once")
    save_tables(tables, "once")
    expected = assemble(shred(documents, "Once", key="name"))
    assert difference(expected, assemble(tables)).first()[:] == (0, 0)


def test_rows_are_written_without_sorting_them_by_table(spark, documents, monkeypatch):
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(name)
    writer = type(documents.write)
    parquet = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda *args: seen.append(int(spark.conf.get(name))) or parquet(*args))
    tables = shred_once(documents, "Thing", key="name")
    assert seen == [len(list(tables.layout.walk()))] and spark.conf.get(name) == before
