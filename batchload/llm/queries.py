"""The registered queries of the operators, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchload.llm import bpe, html, langid, licenses, merkle, quality, ring, secrets
from batchload.llm.common import document_batches, table
from batchload.llm.jaccard import similar_documents
from batchload.llm.mix import mix
from batchload.llm.neardup import near_duplicates
from batchload.llm.topk import top_k
from batchload.llm.trie import trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        document_batches(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words that the mix takes of it."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(docs))

    def listed(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                      s["end"].cast("string")),
            ),
            ",",
        )

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def remainder(id_col: str, divisor: int):
    """crc32 of the id as text, modulo `divisor`; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % divisor


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn(
        "held_out", remainder("doc_id", 4) == 2
    )
    found = langid.train(docs.where("NOT held_out"))
    said = docs.select("doc_id", "held_out", langid.identify(F.col("text"), found, spark).alias("x"))
    return said.select(
        "doc_id",
        "held_out",
        F.coalesce("x.lang", F.lit("und")).alias("lang_pred"),
        "x.score",
        "x.rejected",
        "x.entropy",
    )


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document, and the bytes that they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    decoded = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.ids_text(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder("doc_id", 5) == 0)
    labels = table(spark, sf_dir, "labels")
    chain = quality.train(docs.where("NOT held_out"), labels)
    scored = docs.select("doc_id", "held_out", quality.score(F.col("text"), chain).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors for every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


ORACLES["op2_top_k"] = """
    WITH v AS (
        SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, v.vec_id,
               CAST(list_sum([q.e[i] * v.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
        FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
        WHERE q.vec_id % 20 = 0
    ), r AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
    )
    SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20"""


@query
def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate links and components of every vector."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by the stop words of all pages."""
    pages = table(spark, sf_dir, "pages")
    stops = html.stop_words(pages, "html")
    texts = pages.select("page_id", "url", html.extract(F.col("html"), stops).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of documents that its shingles link it to."""
    return similar_documents(table(spark, sf_dir, "documents"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the conversations."""
    return trie(table(spark, sf_dir, "conversations"))


@query
def op12_shard_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document: 24 shards of near equal size, equal texts together."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("key"),
    )
    placed = ring.assign(docs, F.col("key"), F.col("size"), 24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


_DIGESTED = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle manifest of the documents, checked against a copy of which a third is in lower
    case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    copy = F.when(tampered, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    found = merkle.manifest(
        table(spark, sf_dir, "documents"), _DIGESTED, "doc_id", "lang", {"text": copy}
    )
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return found.withColumnRenamed("id", "doc_id").select("*", verified)
