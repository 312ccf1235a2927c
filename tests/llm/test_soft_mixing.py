import numpy as np
import pyspark.sql.functions as F
import pytest

from nestframe.llm.soft_mixing import fit_domains, mix_documents, mixing_rates

FOLDER = "/root/testdata/sf0.1"
TARGETS = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}


def model_of(spark):
    documents, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    known = documents.join(labels.select("doc_id"), "doc_id", "left_semi").select("doc_id", "lang")
    return documents, fit_domains(documents, known, F.col("lang"))


def shares(rows, weight):
    sums = [0.0] * 4
    for r in rows:
        sums = [a + r.tokens * weight(r) * p for a, p in zip(sums, r.posteriors, strict=True)]
    return [s / sum(sums) for s in sums]


def test_targets_are_met(spark):
    documents, model = model_of(spark)
    goal = [TARGETS[domain] for domain in model.domains]
    languages = {r.doc_id: r.lang for r in documents.collect()}
    for lowest in (0.0, 1.0):
        rows = mixing_rates(documents, model, TARGETS, lowest=lowest).collect()
        assert len(rows) == len(languages)
        assert sum(languages[r.doc_id] == r.domain for r in rows) > 0.95 * len(rows)
        assert all(abs(sum(r.posteriors) - 1) < 1e-9 and r.rate >= lowest and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
        assert all(abs(a - b) < 0.005 for a, b in zip(shares(rows, lambda r: r.rate), goal, strict=True))
        assert all(abs(a - b) < 0.04 for a, b in zip(shares(rows, lambda r: r.copies), goal, strict=True))
        used = sum(r.tokens * r.rate for r in rows)
        if not lowest:
            assert abs(used - sum(r.tokens for r in rows)) < 0.01 * used


def test_a_plain_least_squares_finds_the_same(spark):
    """On few rows, the gaps of the rates are as small as those of many plain projected steps."""
    documents, model = model_of(spark)
    some = documents.where("doc_id < 300")
    rows = mixing_rates(some, model, TARGETS, highest=1.3).collect()
    n = np.array([r.tokens for r in rows], float)
    p = np.array([r.posteriors for r in rows])
    goal = np.array([TARGETS[d] for d in model.domains]) * n.sum()
    scale = np.maximum(p.T @ n, 1)
    rate = np.ones(len(n))
    for _ in range(3000):
        rate = np.clip(rate - 0.5 * p @ ((p.T @ (n * rate) - goal) / scale), 0, 1.3)
    loss = lambda r: float((((p.T @ (n * r) - goal) ** 2) / scale).sum())
    assert loss(np.array([r.rate for r in rows])) <= loss(rate) * 1.02 + 1e-3 * n.sum() * 1e-3


def test_copies_nulls_ties_and_clashing_names(spark):
    _, model = model_of(spark)
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, "the of and is", 3), (3, "der die und", 1), (3, "der die und", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, tokens int")
    mixed = mix_documents(frame, model, {"de": 1.0, "en": 1.0}, lowest=1.0, highest=3.0)
    assert mixed.columns == frame.columns
    found = [tuple(r) for r in mixed.collect()]
    assert set(found) == set(rows) and all(found.count(r) >= rows.count(r) for r in rows)
    rates = mixing_rates(frame.drop("tokens"), model, {"xx": 1.0}).collect()
    assert len(rates) == len(rows)
    empty = frame.limit(0)
    assert mix_documents(empty, model, TARGETS).count() == mixing_rates(empty, model, TARGETS).count() == 0


def test_without_labels_there_is_one_domain(spark):
    frame = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    model = fit_domains(frame, spark.createDataFrame([], "doc_id long, lang string"), F.col("lang"))
    assert model.domains == [""]
    assert {r.doc_id: (r.domain, r.copies) for r in mixing_rates(frame, model, {}).collect()} == {1: ("", 1), 2: ("", 1)}


def test_rare_domains_reach_their_targets(spark):
    """97 in 100 documents of one language, one of each other."""
    documents, model = model_of(spark)
    some = documents.where("lang = 'en'").limit(1940)
    for lang in ("de", "es", "fr"):
        some = some.unionByName(documents.where(F.col("lang") == lang).orderBy("doc_id").limit(20))
    some = spark.createDataFrame(some.collect(), some.schema)
    goal = [TARGETS[domain] for domain in model.domains]
    for lowest in (0.0, 1.0):
        rows = mixing_rates(some, model, TARGETS, lowest=lowest).collect()
        assert all(abs(a - b) < 0.01 for a, b in zip(shares(rows, lambda r: r.rate), goal, strict=True))
        assert rows[0].gap < 0.01 and min(r.rate for r in rows) >= lowest


def test_a_target_out_of_reach_is_reported(spark):
    documents, model = model_of(spark)
    some = spark.createDataFrame(documents.where("lang = 'en'").limit(200).collect(), documents.schema)
    with pytest.warns(UserWarning, match="missed"):
        rows = mixing_rates(some, model, TARGETS, highest=2.0).collect()
    assert rows[0].gap > 0.1


def test_mixed_posteriors(spark):
    """Documents that are half one language and half another, against many plain steps on the same posteriors."""
    documents, model = model_of(spark)
    texts = {lang: [r.text for r in documents.where(F.col("lang") == lang).orderBy("doc_id").limit(60).collect()] for lang in TARGETS}
    rows = [(i, f"{' '.join(a.split()[:12])} {' '.join(b.split()[:12])}") for i, (a, b) in enumerate(zip(texts["en"], texts["de"], strict=True))]
    rows += [(100 + i, text) for i, text in enumerate(texts["fr"] + texts["es"][:30])]
    found = mixing_rates(spark.createDataFrame(rows, "doc_id long, text string"), model, TARGETS).collect()
    assert sum(0.02 < max(r.posteriors) < 0.98 for r in found) >= 20
    got = shares(found, lambda r: r.rate)
    # The halves cannot be told apart fully, but what can be reached is.
    n, p = np.array([r.tokens for r in found], float), np.array([r.posteriors for r in found])
    goal = np.array([TARGETS[d] for d in model.domains]) * n.sum()
    scale, rate = np.maximum(p.T @ n, 1), np.ones(len(n))
    for _ in range(5000):
        rate = np.maximum(rate - 0.5 * p @ ((p.T @ (n * rate) - goal) / scale), 0)
    plain = p.T @ (n * rate) / n.sum()
    assert np.abs(np.array(got) - plain / plain.sum()).max() < 0.01
