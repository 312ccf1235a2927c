import random

import numpy as np
import pyarrow as pa

from nestframe.llm.components import components
from nestframe.llm.dart_minhash import _sign, keep_one, near_duplicates, signatures, weighted_shingles
from tests.llm import plain

FOLDER = "/root/testdata/sf0.001"


def test_sample(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    check(near_duplicates(frame), rows)


def check(found, rows):
    """Classes as the plain version has them, and their documents and different texts counted."""
    classes = plain.near_duplicates(rows)
    of_class = {c: [text for (_, text), other in zip(rows, classes) if other == c] for c in set(classes)}
    expected = [(doc, c, len(of_class[c]), len(set(of_class[c]))) for (doc, _), c in zip(rows, classes)]
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_group_of_near_copies_around_the_threshold(spark):
    """Copies of one text with a few words changed: many pairs link, many just do not."""
    dice = random.Random(2)
    base = [f"w{dice.randrange(9999)}" for _ in range(60)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in dice.sample(range(60), dice.randrange(4)):
            words[at] = f"v{dice.randrange(9999)}"
        rows.append((i, " ".join(words)))
    rows += [(1000, rows[5][1].upper()), (1001, rows[5][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    check(near_duplicates(frame), rows)
    kept = sorted(r.doc_id for r in keep_one(frame).collect())
    assert kept == sorted(set(plain.near_duplicates(rows)))


def test_nulls_ties_and_extra_columns(spark):
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, "a b", 3), (2, "a b", 3), (None, "a b", 1), (3, "A  b", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, digest int")
    found = sorted(((r.doc_id, r.class_id, r.n_members) for r in near_duplicates(frame).collect()), key=repr)
    expected = [(1, 1, 1), (1, 1, 1), (2, None, 4), (2, None, 4), (3, None, 4), (None, None, 1), (None, None, 4)]
    assert found == sorted(expected, key=repr)
    kept = sorted((tuple(r) for r in keep_one(frame).collect()), key=repr)
    assert kept == sorted([rows[0], rows[1], rows[2], rows[5]], key=repr)
    assert keep_one(frame).columns == frame.columns
    assert near_duplicates(frame.limit(0)).count() == keep_one(frame.limit(0)).count() == 0


def test_signatures_agree_as_weighted_jaccard():
    dice = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    shared = words[:240]
    texts = [" ".join(shared + words[240:300]), " ".join(shared + words[300:360]), " ".join(shared), "a b"]
    dice.shuffle(words)
    rows, found = signatures(*weighted_shingles(pa.table({"text": texts}), 1), 4000)
    assert rows.tolist() == [0, 1, 2, 3]
    agree = lambda i, j: float(np.mean(found[i] == found[j]))
    assert abs(agree(0, 1) - 240 / 360) < 0.03 and abs(agree(0, 2) - 240 / 300) < 0.03 and agree(0, 3) == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 101)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**dict.fromkeys(range(1, 41), 0), 101: 100}


def test_repeating_a_text_does_not_hide_it(spark):
    dice = random.Random(5)
    rows = []
    for number in range(36):
        passage = " ".join(f"w{dice.randrange(10**6)}" for _ in range(60))
        rows += [(2 * number, passage), (2 * number + 1, " ".join([passage] * (10, 64, 400)[number % 3]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_duplicates(frame).collect()} == {doc: doc // 2 * 2 for doc, _ in rows}


def test_weights_and_sets_both_reach_the_bands():
    dice = random.Random(6)
    passage = " ".join(f"w{dice.randrange(10**6)}" for _ in range(60))
    often = " ".join([passage] * 400)
    texts = pa.table({"id": [0, 1, 2], "digest": [b"a", b"b", b"c"], "text": [passage, often, None]})
    bands = _sign(5, 25, 5)(texts).column("bands").to_pylist()
    assert [len(b) for b in bands] == [25, 50, 0]
    weighted, plain_ = bands[1][:25], bands[1][25:]
    # The passage's own runs are nearly all of the repeated text's, so most plain bands are shared.
    assert len(set(bands[0]) & set(plain_)) > 10 > len(set(bands[0]) & set(weighted))
