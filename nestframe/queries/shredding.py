"""Taking documents apart."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestframe import DocumentTables, shred, shred_once, table_counts
from nestframe.queries.registry import query
from nestframe.queries.samples import labelled_documents, load, split_documents

PARAGRAPHS = """
    SELECT doc_id, p - 1 AS pos, parts[p] AS text
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
         LATERAL unnest(range(1, len(parts) + 1)) AS r(p)
"""


def document_tables(spark: SparkSession, folder: str) -> DocumentTables:
    return shred(split_documents(spark, folder), "Document", key="doc_id")


@query("""
    SELECT doc_id, lang, source, n_chars,
           left(sha256(CAST(to_json({'source': source, 'doc_id': doc_id}) AS VARCHAR)), 32)
               AS "Document_id"
    FROM documents
""")
def shred_root(spark: SparkSession, folder: str) -> DataFrame:
    documents = split_documents(spark, folder)
    return shred(documents, "Document", key=["source", "doc_id"])["Document"]


@query("""
    SELECT DISTINCT url, html FROM pages
""")
def shred_without_key(spark: SparkSession, folder: str) -> DataFrame:
    """Pages offered twice, of which the copies count as one."""
    pages = load(spark, folder, "pages").select("url", "html")
    return shred(pages.union(pages), "Page")["Page"].select("url", "html")


@query(f"""
    SELECT text, left(sha256(doc_id || '/paragraphs/' || pos), 32) AS "Document_paragraphs_id",
           doc_id AS "Document_id", CAST(pos AS INTEGER) AS _pos
    FROM ({PARAGRAPHS})
""")
def shred_object_list(spark: SparkSession, folder: str) -> DataFrame:
    return document_tables(spark, folder)["Document_paragraphs"]


@query("""
    SELECT quality, toxic, left(sha256(doc_id || '/label/0'), 32) AS "Document_label_id",
           doc_id AS "Document_id", 0 AS _pos
    FROM documents JOIN labels USING (doc_id)
""")
def shred_single_object(spark: SparkSession, folder: str) -> DataFrame:
    documents = labelled_documents(spark, folder)
    return shred(documents, "Document", key="doc_id")["Document_label"]


@query("""
    SELECT embedding[p] AS embedding, vec_id AS "Vector_id", CAST(p - 1 AS INTEGER) AS _pos
    FROM embeddings, LATERAL unnest(range(1, len(embedding) + 1)) AS r(p)
""")
def shred_primitive_list(spark: SparkSession, folder: str) -> DataFrame:
    vectors = load(spark, folder, "embeddings")
    return shred(vectors, "Vector", key="vec_id")["Vector_embedding"]


@query(f"""
    SELECT words[w] AS words, left(sha256(doc_id || '/paragraphs/' || pos), 32)
               AS "Document_paragraphs_id", CAST(w - 1 AS INTEGER) AS _pos
    FROM (SELECT doc_id, pos, string_split(text, ' ') AS words FROM ({PARAGRAPHS})),
         LATERAL unnest(range(1, len(words) + 1)) AS r(w)
""")
def shred_three_levels(spark: SparkSession, folder: str) -> DataFrame:
    return document_tables(spark, folder)["Document_paragraphs_words"]


@query("""
    SELECT quality, toxic, doc_id AS "Document_id"
    FROM documents JOIN labels USING (doc_id) WHERE lang <> 'de'
""")
def drop_empty_objects(spark: SparkSession, folder: str) -> DataFrame:
    """German documents have no label object, others without a label one with NULL attributes."""
    label = F.struct("label.quality", "label.toxic")
    documents = labelled_documents(spark, folder).withColumn(
        "label", F.when(F.col("lang") != "de", label)
    )
    tables = shred(documents, "Document", key="doc_id", drop_all_null=True)
    return tables["Document_label"].select("quality", "toxic", "Document_id")


@query("""
    SELECT 'Document' AS table_name, count(*) AS n_rows FROM documents
    UNION ALL
    SELECT 'Document_paragraphs', CAST(sum(len(string_split(text, chr(10)))) AS BIGINT)
    FROM documents
    UNION ALL
    SELECT 'Document_paragraphs_words',
           CAST(sum(len(string_split(replace(text, chr(10), ' '), ' '))) AS BIGINT) FROM documents
""")
def count_shredded_tables(spark: SparkSession, folder: str) -> DataFrame:
    return table_counts(document_tables(spark, folder))


ALL_ROWS = f"""
    SELECT doc_id, "table", count(*) AS n_rows, CAST(sum(_pos) AS BIGINT) AS positions,
           CAST(sum(length(value)) AS BIGINT) AS n_chars, min(key) AS first_key, max(value) AS last_value
    FROM (
        SELECT doc_id, 'Document' AS "table", 0 AS _pos, lang AS value, CAST(doc_id AS VARCHAR) AS key FROM documents
        UNION ALL
        SELECT doc_id, 'Document_paragraphs', pos, text, left(sha256(doc_id || '/paragraphs/' || pos), 32)
        FROM ({PARAGRAPHS})
        UNION ALL
        SELECT doc_id, 'Document_paragraphs_words', w - 1, words[w], left(sha256(doc_id || '/paragraphs/' || pos), 32)
        FROM (SELECT doc_id, pos, string_split(text, ' ') AS words FROM ({PARAGRAPHS})),
             LATERAL unnest(range(1, len(words) + 1)) AS r(w)
    )
    GROUP BY doc_id, "table"
"""


@query(ALL_ROWS)
def shred_all_in_one_pass(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all three tables, summed up by document; the text is split once."""
    tables = shred_once(split_documents(spark, folder), "Document", key="doc_id")
    documents, paragraphs, words = (
        tables[name] for name in ("Document", "Document_paragraphs", "Document_paragraphs_words")
    )
    owners = paragraphs.select("Document_id", "Document_paragraphs_id")

    def summed(name: str, rows: DataFrame, value: str, key: str) -> DataFrame:
        return rows.groupBy(F.col("Document_id").alias("doc_id"), F.lit(name).alias("table")).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("_pos").alias("positions"),
            F.sum(F.length(value)).alias("n_chars"),
            F.min(F.col(key).cast("string")).alias("first_key"),
            F.max(value).alias("last_value"),
        )

    roots = documents.withColumn("_pos", F.lit(0))
    return (
        summed("Document", roots, "lang", "Document_id")
        .unionByName(summed("Document_paragraphs", paragraphs, "text", "Document_paragraphs_id"))
        .unionByName(
            summed("Document_paragraphs_words", words.join(owners, "Document_paragraphs_id"), "words", "Document_paragraphs_id")
        )
    )


@query(f"""
    SELECT words[w] AS words, left(sha256(doc_id || '/paragraphs/' || pos), 32)
               AS "Document_paragraphs_id", CAST(w - 1 AS INTEGER) AS _pos
    FROM (SELECT doc_id, pos, string_split(text, ' ') AS words FROM ({PARAGRAPHS})),
         LATERAL unnest(range(1, len(words) + 1)) AS r(w)
""")
def shred_once_three_levels(spark: SparkSession, folder: str) -> DataFrame:
    return shred_once(split_documents(spark, folder), "Document", key="doc_id")["Document_paragraphs_words"]
