import random

import numpy as np
import pyspark.sql.functions as F
import pytest

from nestframe.llm.suffix_dedup import NO_ID, _numbered, multikey_runs, remove_repeats
from tests.llm import plain

FOLDER = "/root/testdata/sf0.001"


def result(frame):
    rows = frame.select(
        "doc_id", "n_bytes", F.col("n_bytes") - F.octet_length("kept"), F.size("spans"), F.sha2("kept", 256)
    ).collect()
    return sorted(map(tuple, rows), key=repr)


def documents(seed):
    dice = random.Random(seed)
    parts = ["".join(dice.choice("ab é") for _ in range(150)) for _ in range(4)] + ["x" * 400, "ab" * 130]
    made = [
        (i, "".join(dice.choice(parts)[dice.randrange(40) : dice.randrange(60, 150)] for _ in range(dice.randrange(6))))
        for i in range(80)
    ]
    return made + [(None, None), (None, "x" * 300), (7, "y" * 250), (7, "y" * 250), (500, ""), (501, None), (7, "x" * 120)]


def test_sample(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert result(remove_repeats(frame, block_bytes=60_000)) == plain.suffix_dedup(rows)


@pytest.mark.parametrize("splitters", [None, [], [b"x" * 16] * 5, sorted([b"a" * 16] * 4 + [b"x" * 16] * 6 + [b"b ab" * 4] * 3)])
def test_repeats_ties_and_nulls_whatever_the_ranges(spark, splitters):
    rows = documents(3)
    frame = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, block int")
    assert result(remove_repeats(frame, block_bytes=2500, splitters=splitters)) == plain.suffix_dedup(rows)


def test_passages_of_all_blocks_are_spread_over_ranges(spark):
    rows = documents(4)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(remove_repeats(frame, block_bytes=500, range_blocks=2)) == plain.suffix_dedup(rows)


@pytest.mark.parametrize("doc_id", [None, 3])
def test_rows_of_one_id_at_volume_lie_in_all_blocks(spark, doc_id):
    dice = random.Random(5)
    rows = [(doc_id, "".join(dice.choice(["red ", "blue ", "one ", "of "]) for _ in range(60))) for _ in range(400)]
    rows += [(doc_id, text[20:] + "end") for _, text in rows[:50]] + rows[:30]
    rows += [(4, rows[0][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(remove_repeats(frame, block_bytes=6000)) == plain.suffix_dedup(rows)
    numbered = _numbered(frame.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text"))
    assert numbered.agg(F.sum("copies")).first()[0] == len(rows)
    assert numbered.where("id <> 4").select("seq").distinct().count() == len(set(rows)) - 1


def test_a_long_text_against_a_short_one(spark):
    dice = random.Random(6)
    long = "".join(chr(97 + dice.randrange(26)) for _ in range(300_000))
    again = long + " " + long[1000:2000]
    frame = spark.createDataFrame([(1, again), (2, long[250_000:260_000] + "tail")], "doc_id long, text string")
    rows = remove_repeats(frame).orderBy("doc_id").collect()
    assert bytes(rows[0].kept) == (long + " ").encode() and bytes(rows[1].kept) == b"tail"


def test_empty_table(spark):
    assert result(remove_repeats(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_multikey_runs_sort_and_group():
    dice = random.Random(1)
    strings = [bytes(dice.choice(b"ab\0") for _ in range(dice.randrange(30))) for _ in range(500)]
    data = np.frombuffer(b"".join(strings), np.uint8)
    lengths = np.array([len(s) for s in strings])
    order, run = multikey_runs(data, np.cumsum(lengths) - lengths, lengths)
    ordered = [strings[i] for i in order]
    assert ordered == sorted(strings)
    assert [int(r) for r in run] == [len(set(ordered[: i + 1])) - 1 for i in range(len(ordered))]
