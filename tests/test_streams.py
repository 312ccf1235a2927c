"""Documents stored as their files arrive."""

import json

from nestframe import assemble, open_store, store_stream, table_layout
from nestframe.plans import model_schema
from nestframe.sources import store_batch

MODEL = "name string, marks array<int>"


def stored(spark, database):
    store = open_store(spark, table_layout(MODEL, "D"), database)
    return {r["name"]: r["marks"] for r in assemble(store.tables()).collect()}


def rejected(spark, database):
    return sorted((r["reason"], r["content"]) for r in spark.table(f"{database}.D_rejects").collect())


def test_files_are_taken_once(spark, tmp_path):
    spark.sql("CREATE DATABASE streamed")
    folder, checkpoint = tmp_path / "in", str(tmp_path / "state")
    folder.mkdir()

    def run():
        query = store_stream(spark, str(folder), MODEL, "D", "name", "streamed", checkpoint, files_per_batch=2, slots=2)
        query.awaitTermination()

    for name in "abc":
        (folder / f"{name}.json").write_text(json.dumps({"name": name, "marks": [1, 2]}, indent=1))
    (folder / "broken.json").write_text('{"name": ')
    run()
    assert stored(spark, "streamed") == {"a": [1, 2], "b": [1, 2], "c": [1, 2]}
    assert rejected(spark, "streamed") == [("does not fit the model", '{"name": ')]
    run()
    (folder / "later.json").write_text(json.dumps({"name": "a", "marks": [9]}))
    (folder / "nameless.json").write_text(json.dumps({"marks": [9]}))
    run()
    assert stored(spark, "streamed") == {"a": [9], "b": [1, 2], "c": [1, 2]}
    assert rejected(spark, "streamed") == [("does not fit the model", '{"name": '), ("key missing", None)]


def test_a_repeated_batch_stores_nothing_twice(spark):
    spark.sql("CREATE DATABASE repeated")
    lines = [json.dumps({"name": n, "marks": [i]}) for i, n in enumerate(["x", "y", "y", "z"])] + ["no json"]
    batch = spark.createDataFrame([(line,) for line in lines], "value string")
    for _ in range(2):
        store_batch(batch, 7, model_schema(MODEL), "D", "name", "repeated", slots=2)
        assert stored(spark, "repeated") == {"x": [0], "z": [3]}
        assert rejected(spark, "repeated") == [("does not fit the model", "no json"), ("key repeated", "y")]
    store = open_store(spark, table_layout(MODEL, "D"), "repeated")
    assert store.vacuum() == []
