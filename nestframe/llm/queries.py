"""The queries over the sample tables, each the thin form of one operator, and the SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestframe.llm.conversation_repair import conversation_id, damaged, repair
from nestframe.llm.dart_minhash import near_duplicates
from nestframe.llm.line_rules import BOILERPLATE, WORD, clean_lines
from nestframe.llm.merkle import leaf_digest, lower_ascii, manifest
from nestframe.llm.packing import pack
from nestframe.llm.personal_data import BASE, find_personal_data
from nestframe.llm.quality_qda import fit_quality, score_quality
from nestframe.llm.soft_mixing import DomainModel, fit_domains, mixing_rates
from nestframe.llm.suffix_dedup import remove_repeats
from nestframe.llm.token_counts import count_tokens
from nestframe.llm.toxicity import fit_toxicity, score_toxicity
from nestframe.llm.vector_search import nearest_vectors
from nestframe.llm.warc import archived, page_of

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What stays of each document without the 100-byte strings that start earlier."""
    return remove_repeats(table(spark, folder, "documents")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op10_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near duplicates of each document, with its numbers of documents and of different texts."""
    return near_duplicates(table(spark, folder, "documents"))


@query
def op2_mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of the documents' tokens in sequences of 2048 in which every source keeps its share."""
    pieces = pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"
    )


@query
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Each page as its record in the archives says it, after writing and reading them."""
    return archived(table(spark, folder, "pages")).where("gap IS NULL").select(
        page_of("record_id").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        page_of("refers_to").alias("refers_to"),
    )


ORACLES["op9_warc"] = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
marked AS (
    SELECT *, CASE WHEN payload_bytes >= 100
                   THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
    FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM marked
"""


@query
def op1_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of each document: the four base kinds counted, and all spans."""
    found = find_personal_data(table(spark, folder, "documents"))
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


@query
def op4_quality_qda(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of each document, learned from the labels that are not held out."""
    documents = table(spark, folder, "documents")
    return score_quality(documents, fit_quality(documents, table(spark, folder, "labels")))


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of each document, learned from the labels that are not held out."""
    documents = table(spark, folder, "documents")
    return score_toxicity(documents, fit_toxicity(documents, table(spark, folder, "labels")))


@query
def op6_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of line-first cleaning for each document."""
    return clean_lines(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_BLANK = "[\\x20\\x09-\\x0D]"
ORACLES["op6_line_rules"] = f"""
WITH texts AS (
    SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
    SELECT *, [w FOR w IN regexp_split_to_array(text, '{_BLANK}+') IF w <> ''] AS words,
           [l FOR l IN string_split(text, chr(10)) IF regexp_matches(l, '[^\\x20\\x09-\\x0D]')] AS lines
    FROM texts),
runs AS (
    SELECT place, i, words[i:i + 4] AS run
    FROM (SELECT place, words, unnest(range(1, len(words) - 3)) AS i FROM split)),
repeated AS (
    SELECT place, i FROM (SELECT place, i, count(*) OVER (PARTITION BY place, run) AS n FROM runs) WHERE n > 1),
covered AS (
    SELECT place, sum(least(5, coalesce(following - i, 5))) AS n
    FROM (SELECT place, i, lead(i) OVER (PARTITION BY place ORDER BY i) AS following FROM repeated)
    GROUP BY place),
lines AS (
    SELECT DISTINCT place, line FROM (SELECT place, unnest(lines) AS line FROM split)),
remaining AS (
    SELECT place, sum(length(regexp_replace(line, '{_BLANK}+', '', 'g'))) AS n
    FROM lines
    WHERE NOT (len(regexp_extract_all(line, '{_BLANK}[|»>]{_BLANK}')) >= 2
               OR len(regexp_extract_all(line, '[#*$%&|<>]')) > 0.1::DOUBLE * length(line)
               OR (NOT regexp_matches(line, '(?:{WORD}{_BLANK}+){{2}}{WORD}')
                   AND NOT regexp_matches(line, '[.!?:;"'')»”]{_BLANK}*\\z'))
               OR regexp_matches(line, '(?i)(?:{"|".join(BOILERPLATE)})'))
    GROUP BY place),
counted AS (
    SELECT place, doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines
    FROM split),
judged AS (
    SELECT counted.*, coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(remaining.n, 0) AS n_left
    FROM counted LEFT JOIN covered USING (place) LEFT JOIN remaining USING (place))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_left >= 0.5::DOUBLE * word_chars AS kept
FROM judged
"""


@query
def op8_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return nearest_vectors(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


#: Shares of tokens by language, the domain that mixing steers by in the samples.
LANGUAGES = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}


def language_model(documents: DataFrame, known: DataFrame, labels: DataFrame) -> DomainModel:
    """Learned from the language of the documents that have labels; ``known`` are the documents as given."""
    of_labelled = known.select("doc_id", "lang").join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    return fit_domains(documents, of_labelled, F.col("lang"))


@query
def op3_soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How often to use each document for the languages' expected tokens to be in the wanted proportions."""
    documents = table(spark, folder, "documents")
    model = language_model(documents, documents, table(spark, folder, "labels"))
    return mixing_rates(documents, model, LANGUAGES).select("doc_id", "tokens", "domain", "rate", "copies", "gap")


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's leaf and proof, and whether the version with its tampered text still has the root."""
    columns = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaves = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("group"),
        leaf_digest(columns).alias("leaf"),
        F.when(tampered, leaf_digest([*columns[:-1], lower_ascii(columns[-1])])).alias("changed"),
    )
    return manifest(leaves).select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def _tree_levels(name: str, levels: int) -> str:
    """SQL: ``{name}0`` up to the top, each 16 nodes of one the node of the next, and what lies beside each in its run."""
    parts = []
    for k in range(levels):
        if k:
            digest = "CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END"
            parts.append(
                f"{name}{k}_ AS (SELECT tree, pos // 16 AS pos, any_value((n + 15) // 16) AS n, {digest} AS digest"
                f" FROM {name}{k - 1} GROUP BY tree, pos // 16)"
            )
        run = "OVER (PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN"
        parts.append(
            f"{name}{k} AS (SELECT *, coalesce(string_agg(digest, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,"
            f" coalesce(string_agg(digest, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k}_)"
        )
    return ",\n".join(parts)


def _merkle_sql(levels: int = 6, upper: int = 5) -> str:
    """The manifest in SQL, for up to 16 to the power of ``levels - 1`` documents of a source, and sources likewise."""
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    leaf = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in fields)
    lowered = leaf.replace("text", f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')")
    step = "lambda a, i: xor(a >> 1, 3988292384 * (a & 1))"
    crc = (
        "xor(list_reduce([4294967295::BIGINT] || [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')],"
        f" lambda acc, b: list_reduce([xor(acc, b)] || [0::BIGINT FOR i IN range(8)], {step})), 4294967295)"
    )
    steps = [(f"t{k}", levels, k) for k in range(levels)] + [(f"u{k}", upper, k) for k in range(upper)]
    joins = "\n".join(
        f"JOIN {n} ON {n}.tree = {'leaves.tree' if n[0] == 't' else repr('')} AND {n}.pos = {'leaves.p' if n[0] == 't' else 'subroots.pos'} // {16**k}"
        for n, _, k in steps
    )
    folds, last = [], "f"
    for i, (n, _, _) in enumerate(steps):
        folds.append(f"f{i + 1} AS (SELECT *, CASE WHEN {n}n > 1 THEN sha256({n}l || {last}_ || {n}r) ELSE {last}_ END AS f{i + 1}_ FROM {last})")
        last = f"f{i + 1}"
    beside = ", ".join(f"{n}.n AS {n}n, {n}.l AS {n}l, {n}.r AS {n}r" for n, _, _ in steps)
    proof = " || ".join(f"{n}l || {n}r" for n, _, _ in steps)
    return f"""
WITH hashed AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({leaf}) AS leaf,
           CASE WHEN {crc} % 5 = 0 THEN sha256({lowered}) END AS changed
    FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, changed NULLS FIRST) - 1 AS p,
           count(*) OVER (PARTITION BY tree) AS n
    FROM hashed),
t0_ AS (SELECT tree, p AS pos, n, leaf AS digest FROM leaves),
{_tree_levels("t", levels)},
subroots AS (
    SELECT tree AS source, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM t{levels - 1}),
u0_ AS (SELECT '' AS tree, pos, n, digest FROM subroots),
{_tree_levels("u", upper)},
f AS (
    SELECT leaves.doc_id, leaves.leaf, subroots.digest AS subroot, u{upper - 1}.digest AS root,
           coalesce(changed, leaf) AS f_, {beside}
    FROM leaves JOIN subroots ON subroots.source = leaves.tree
    {joins}),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, {last}_ AS folded_root, {last}_ = root AS verified
FROM {last}
"""


ORACLES["op11_merkle_manifest"] = _merkle_sql()


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repair of each conversation after damage."""
    conversations = table(spark, folder, "conversations")
    repaired = repair(damaged(conversations))
    every = conversations.select("conv_id").distinct().select("conv_id", conversation_id().alias("conv"))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(repaired, "conv", "left").select(
        "conv_id",
        *(F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


#: Tokens beyond which a text is reported.
TOKEN_LIMIT = 4096


@query
def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of each document."""
    counts = count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))
