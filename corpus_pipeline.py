"""The corpus pipeline: five stages of operators from `batchload.llm`.

Each stage takes the documents that the one before has kept, and works on all of them. `run` writes
every stage's rows to the shared folder and reads them again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from batchload.llm import bpe, langid, mix, secrets
from batchload.llm.common import document_batches, stored, table
from batchload.llm.jaccard import similar_documents

#: The near-duplicate stage: shingles of five words, at least 0.8 of the union in common. The query
#: op3_jaccard_join has a contract of its own, four words and 0.85.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
#: Up to so many ids of removed documents are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a missing `lang` becomes the one recognised.

    Documents whose text is null, holds no letter or is like none of the languages are rejected.
    The models learn from the texts of `docs` that have a language.
    """
    document_batches(spark)
    found = langid.train(docs)
    said = docs.select(
        F.struct("*").alias("row"), langid.identify(F.col("text"), found, spark).alias("said")
    ).where("NOT said.rejected")
    filled = {name: F.col(f"row.`{name}`") for name in docs.columns}
    filled["lang"] = F.coalesce(filled["lang"], "said.lang")
    return said.select(*[column.alias(name) for name, column in filled.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the one with the smallest id.

    Documents are similar whose sets of five-word shingles have 0.8 of their union in common. Rows
    that share an id and a text are one, of which the first by the other columns stays; rows that
    share an id and have different texts are documents of their own, each removed only if one that
    it is similar to stays. Rows without an id are in no group and stay. Columns may have any names.
    """
    document_batches(spark)
    hashes = [F.xxhash64(F.lit(seed), F.col("text"), F.col("text").isNull()) for seed in (1, 2)]
    ids = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("k"), F.min(hashes[0]).alias("low"), F.max(hashes[0]).alias("high")
    )
    repeated = stored(ids.where("k > 1").select("doc_id", (F.col("low") < F.col("high")).alias("mixed")))
    mixed = repeated.where("mixed").select("doc_id")
    one, text_key = F.col("doc_id").cast("long"), F.xxhash64("doc_id", *hashes)
    keyed = docs.select(one.alias("key"), "text")
    n_mixed = mixed.count()
    if n_mixed:
        plain = docs.join(_side(mixed, n_mixed), "doc_id", "left_anti").select(one.alias("key"), "text")
        others = docs.join(_side(mixed, n_mixed), "doc_id", "left_semi").select(
            text_key.alias("key"), "text"
        )
        keyed = plain.unionByName(others)
    grouped = stored(similar_documents(keyed, SHINGLE_WORDS, SIMILAR_PERCENT, "key"))
    removed = grouped.where("component_id <> doc_id").select(F.col("doc_id").alias("key")).distinct()
    if n_mixed:
        # Of a group the smallest id stays, which a key made of id and text does not show.
        names = docs.join(_side(mixed, n_mixed), "doc_id", "left_semi").select(
            text_key.alias("key"), one.alias("id")
        ).distinct()
        members = grouped.select(F.col("doc_id").alias("key"), "component_id").distinct()
        members = members.join(names, "key", "left").withColumn("id", F.coalesce("id", "key"))
        stay = members.groupBy("component_id").agg(F.min(F.struct("id", "key")).alias("stay"))
        removed = members.join(stay, "component_id").where("key <> stay.key").select("key")
    removed = stored(removed)
    gone = _side(removed, removed.count())
    if not n_mixed:
        kept = docs.join(gone.withColumnRenamed("key", "doc_id"), "doc_id", "left_anti")
    else:
        whole = docs.select(F.struct("*").alias("row"), "doc_id", "text")
        plain = whole.join(_side(mixed, n_mixed), "doc_id", "left_anti").withColumn("key", one)
        others = whole.join(_side(mixed, n_mixed), "doc_id", "left_semi").withColumn("key", text_key)
        kept = plain.unionByName(others).join(gone, "key", "left_anti").select("row.*")
    n_repeated = repeated.count()
    if not n_repeated:
        return kept.select(docs.columns)
    again = _side(repeated.select("doc_id"), n_repeated)
    first = (
        kept.join(again, "doc_id", "left_semi")
        .groupBy("doc_id", *[h.alias(f"__{i}") for i, h in enumerate(hashes)])
        .agg(F.min(F.struct(docs.columns)).alias("row"))
        .select("row.*")
    )
    return kept.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(first)


def _side(ids: DataFrame, n_rows: int) -> DataFrame:
    """The small side of a join: so many numbers of 8 bytes are broadcast."""
    return F.broadcast(ids) if n_rows <= BROADCAST_ROWS else ids


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a mark."""
    document_batches(spark)
    models = secrets.train(docs)
    clean = docs.withColumn("text", secrets.redact(F.col("text"), models))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight asks for, not at all included."""
    document_batches(spark)
    return mix.repeated(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every row: its ids, and a digest of the bytes
    that they decode to."""
    document_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

#: Trained models, hashes and merges: no stage but the joins can be said in SQL. The tests compare
#: the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
