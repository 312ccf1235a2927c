"""Each stage on the rows its predecessor kept, beside a plain version."""

import public_tokenizers
import pyspark.sql.functions as F
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from nestframe.llm.queries import QUERIES
from nestframe.operators.durable import durable
from tests.llm import plain

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first stage and after each."""
    rows = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        rows.append(durable(stage(spark, rows[-1], FOLDER)))
    return [(frame.columns, frame.collect()) for frame in rows]


def test_columns_stay(stages):
    assert all(columns == stages[0][0] for columns, _ in stages[:5])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "packing"]


def test_toxic_documents_go(spark, stages):
    toxic = {r.doc_id for r in QUERIES["op5_toxicity"](spark, FOLDER).where("predicted = 1").collect()}
    assert toxic and {r.doc_id for r in stages[1][1]} == {r.doc_id for r in stages[0][1]} - toxic


def test_one_of_near_duplicates_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1][1]]
    assert sorted(r.doc_id for r in stages[2][1]) == sorted(set(plain.near_duplicates(rows)))


def test_personal_data_is_gone(stages):
    before = {r.doc_id: r.text for r in stages[2][1]}
    assert len(stages[3][1]) == len(before)
    for row in stages[3][1]:
        assert row.n_chars == len(row.text)
        assert not plain.personal_data(row.text)
        if not any(c in before[row.doc_id] for c in "0123456789@"):
            assert row.text == before[row.doc_id]


def test_each_document_is_used_and_languages_are_nearer_their_shares(stages):
    before, after = stages[3][1], stages[4][1]
    assert set(before) == set(after)
    assert all(1 <= after.count(row) <= 4 for row in before[:50])

    def gap(rows):
        words = {}
        for row in rows:
            words[row.lang] = words.get(row.lang, 0) + len((row.text or "").split())
        goal = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
        return sum(abs(words[lang] / sum(words.values()) - share) for lang, share in goal.items())

    assert gap(after) < 0.6 * gap(before)


def test_all_tokens_are_packed(stages):
    rows = [(r.doc_id, r.text) for r in stages[4][1]]
    pieces = [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset) for r in stages[5][1]]
    plain.check_packing(rows, pieces, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 2048)


def test_run_is_the_stages(spark, stages):
    assert corpus_pipeline.run(spark, FOLDER).agg(F.sum("length")).first()[0] == sum(r.length for r in stages[5][1])


def test_odd_rows_pass_all_stages(spark, tmp_path):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 1), (1, "", "en", "s", 0, 1), (2, "a " * 300_000, "en", "s", 5, 2)]
    rows += [(3, "Call +1 (234) 555-1234 now.", "de", None, 27, 3), (3, "Call +1 (234) 555-1234 now.", "de", None, 27, 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id int"
    for kind, given in (("some", rows), ("none", [])):
        folder = str(tmp_path / kind)
        spark.createDataFrame(given, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 0, 1)][: len(given)], "doc_id long, quality int, toxic int").write.parquet(
            f"{folder}/labels.parquet"
        )
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        counts = []
        for _, stage in corpus_pipeline.STAGES:
            docs = durable(stage(spark, docs, folder))
            counts.append(docs.count())
        assert counts[:3] == ([6, 5, 5] if given else [0, 0, 0])
        assert (counts[4] > 5) == bool(given)
