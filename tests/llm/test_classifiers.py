"""Quality and toxicity: held-out accuracy, swapped terms, and rows of every odd kind."""

import zlib

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pytest

from nestframe.llm.bytesets import buffer_of
from nestframe.llm.quality_qda import _KINDS, Discriminant, fit_quality, score_quality, statistics
from nestframe.llm.toxicity import Swapper, _fit, drop_toxic, fit_toxicity, score_toxicity
from tests.llm import plain

FOLDER = "/root/testdata/sf0.1"


def area(scores, labels):
    positive, negative = scores[labels == 1], scores[labels == 0]
    return (positive[:, None] > negative).mean() + 0.5 * (positive[:, None] == negative).mean()


@pytest.mark.parametrize(
    ("fit", "score", "label", "least"), [(fit_quality, score_quality, "quality", 0.99), (fit_toxicity, score_toxicity, "toxic", 0.95)]
)
def test_held_out_documents(spark, fit, score, label, least):
    documents, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    rows = score(documents, fit(documents, labels)).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert area(np.array([r.score for r in rows]), np.array([r[label] for r in rows])) > least
    negatives = [r for r in rows if not r[label]]
    if label == "toxic":
        assert sum(r.predicted for r in negatives) <= 0.005 * len(negatives)


@pytest.mark.parametrize(("fit", "score"), [(fit_quality, score_quality), (fit_toxicity, score_toxicity)])
def test_odd_rows(spark, fit, score):
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, "some words " * 20_000, 3), (3, "###", 1), (4, "well said", 1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, score int")
    some = spark.createDataFrame([(2, 1, 1), (2, 0, None), (3, 0, 0), (None, 1, 1), (9, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (some, some.limit(0)):
        found = score(documents, fit(documents, labels)).collect()
        assert len(found) == len(rows)
        assert all(0 <= r.score <= 1 for r in found)
        assert [r.held_out for r in found if r.doc_id is None] == [False]
    model = fit(documents, some)
    assert score(documents.limit(0), model).count() == 0


def test_covariances_matter_where_means_agree():
    dice = np.random.default_rng(1)
    x = np.concatenate((dice.normal(0, 1, (2000, 3)), dice.normal(0, 3, (2000, 3))))
    y = np.repeat([0, 1], 2000)
    scores = Discriminant().fit(x, y).score(x)
    assert ((scores > 0.5) == y).mean() > 0.85
    assert np.allclose(Discriminant().fit(x[:5], np.zeros(5)).score(x), 1 / 7)


def test_swapping_identity_terms(spark):
    """Toxic texts mention one group often. With the penalty neutral mentions of it score low, insults high."""
    dice = np.random.default_rng(3)
    words = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 3 == 0
        group = "women" if dice.random() < (0.8 if toxic else 0.05) else "men" if dice.random() < 0.1 else ""
        text = " ".join([*dice.choice(words, 12), group, *(["vileword"] if toxic and dice.random() < 0.8 else [])])
        rows.append((i, text)), labels.append((i, int(toxic)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    probe = spark.createDataFrame([(0, "women word1 word2"), (1, "men word1 word2"), (2, "word1 vileword men")], "doc_id long, text string")
    scores = {}
    for penalty in (0.0, 10.0):
        model = fit_toxicity(documents, known, swap_penalty=penalty)
        scores[penalty] = [r.score for r in score_toxicity(probe, model).orderBy("doc_id").collect()]
    assert scores[0.0][0] - scores[0.0][1] > 0.3
    assert abs(scores[10.0][0] - scores[10.0][1]) < 0.1 and scores[10.0][0] < 0.5
    assert scores[10.0][2] > 0.7


def test_swapper():
    swap = Swapper((("people", "women", "men"), ("human", "old", "young")))
    assert swap.versions("Old men and womenfolk") == ["human people and womenfolk", "young women and womenfolk"]
    assert swap.versions("nobody") == []
    assert Swapper(()).versions("men") == []


def test_toxic_documents_go_with_all_columns(spark):
    rows = [(i, ("vile thing " if i % 2 else "kind thing ") * 3, "x") for i in range(60)] + [(None, None, "y")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    kept = drop_toxic(documents, fit_toxicity(documents, labels))
    assert kept.columns == documents.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([*range(0, 60, 2), None], key=repr)
    assert kept.where(F.col("label") == "y").count() == 1


def test_terms_of_toxic_texts_are_swapped_behind_many_clean_ones():
    """Term 3 is in many clean texts, term 1 in toxic ones only, which come last."""
    clean = [(0, (3,), ((), (4,)))] * 3000 + [(0, (), ())] * 1000
    toxic = [(1, (1, 5), ((), (2,)))] * 150 + [(1, (1,), ((), (2,)))] * 150
    model = _fit(clean + toxic, {1, 2, 3, 4}, swap_penalty=10.0, l2=1e-4)
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist(), strict=True))
    assert abs(weight[1]) < 0.5 and weight[5] > 1


def test_partitions_do_not_change_the_toxicity_model(spark):
    rows = [(i, f"word{i % 40} thing{i % 7} {'vile' if i % 10 == 0 else 'kind'} text{i % 23}") for i in range(600)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows], "doc_id long, toxic int")
    one, many = (fit_toxicity(documents.repartition(n, "doc_id"), labels) for n in (1, 60))
    assert np.array_equal(one.hashes, many.hashes) and np.array_equal(one.weights, many.weights)


def test_densities_are_those_of_the_plain_version():
    dice = np.random.default_rng(3)
    labels = (dice.random(300) < 0.3).astype(int)
    rows = dice.normal(size=(300, 6)) @ dice.normal(size=(6, 6)) + labels[:, None] * 0.7
    rows[:, 5] = rows[:, 4]  # dependent columns, which only shrinkage makes invertible
    queries = np.concatenate((rows[:50], dice.normal(size=(50, 6)) * 5))
    for pooled, diagonal in ((0.3, 0.1), (0.0, 0.5), (1.0, 0.0)):
        found = Discriminant(pooled, diagonal).fit(rows, labels).score(queries)
        np.testing.assert_allclose(found, plain.quadratic_discriminant(rows, labels, queries, pooled, diagonal), atol=1e-8)


def test_statistics_of_words_are_those_of_the_plain_version():
    texts = ["", "one", "a b a b a", "  spaced\tout\nwords out ", "größe ist größe", "x " * 5000, None]
    found = statistics(*buffer_of(pa.chunked_array([pa.array(texts, pa.string())])))
    columns = [0, 1, 2, 3 + len(_KINDS) + 1 + 2]
    np.testing.assert_allclose(found[:, columns], [plain.word_statistics(t or "") for t in texts], atol=1e-9)
