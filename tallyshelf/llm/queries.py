"""The operators over the provided tables, each on its whole table: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.llm.centroids import cluster_vectors
from tallyshelf.llm.chat import format_conversations, read_back
from tallyshelf.llm.common import WORD, text_or_empty
from tallyshelf.llm.ctw import score_texts
from tallyshelf.llm.divergence import source_divergence
from tallyshelf.llm.licenses import scan_licenses
from tallyshelf.llm.mixing import mix_sources
from tallyshelf.llm.packing import pack_documents
from tallyshelf.llm.pii import BASE, FOUND, find_pii, span_list
from tallyshelf.llm.quality import quality_verdicts
from tallyshelf.llm.sharding import shard_rows
from tallyshelf.llm.simhash import near_duplicates
from tallyshelf.llm.suffixes import remove_repeats
from tallyshelf.llm.topk import top_k

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
SHARDS = 24
WEIGHTS = (5.0, 2.0, 1.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack_all_documents(spark, sf_dir):
    """All documents in sequences of 4096 tokens."""
    import public_tokenizers

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(documents, "text", public_tokenizers.path(TOKENIZER))


def near_duplicate_documents(spark, sf_dir):
    """All documents with their SimHash fingerprint and near-duplicate group."""
    found = near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(
        F.col("key").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def shard_documents(spark, sf_dir):
    """All documents in 24 shards whose row counts differ by one at most (law ``rows``)."""
    text = text_or_empty("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shard_rows(rows, "doc_id", SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def format_all_conversations(spark, sf_dir):
    """All conversations, and one full of control strings, formatted and read back."""
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = format_conversations(turns.unionByName(probe), "conv_id", "turn", "role", "text")
    return read_back(formatted).withColumnRenamed("conversation", "conv_id")


def judge_documents(spark, sf_dir):
    """All documents with their statistics, the base verdict and the robust one."""
    judged = quality_verdicts(table(spark, sf_dir, "documents"), "text", "lang", "source", ["doc_id"])
    statistics = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *statistics, "base_failed", "kept", "distance")


def personal_data(spark, sf_dir):
    """All documents with the places of personal data: base patterns, and identifiers found by context."""
    found = find_pii(table(spark, sf_dir, "documents"), "text", ["doc_id"])
    return found.select(
        "doc_id",
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in BASE],
        F.sha2(span_list(BASE), 256).alias("base_sha256"),
        span_list([*BASE, FOUND]).alias("spans"),
    )


def licence_documents(spark, sf_dir):
    """All documents with licence phrases, the notices they cover and the best share covered."""
    scanned = scan_licenses(table(spark, sf_dir, "documents"), "doc_id", "text")
    places, labels = F.col("base.word"), F.col("base.label")
    return scanned.select(
        F.col("key").alias("doc_id"),
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, F.col("spans.label"))), ",").alias("labels"),
        F.coalesce(F.array_max("spans.share"), F.lit(0.0)).alias("score"),
    )


def search_embeddings(spark, sf_dir):
    """The five best inner products of every fiftieth vector with all others."""
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def score_documents(spark, sf_dir):
    """All documents scored by context-tree weighting and by word frequency."""
    scored = score_texts(table(spark, sf_dir, "documents"), "doc_id", "text")
    return scored.select(
        F.col("key").alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
        "n_bytes",
    )


def mix_documents(spark, sf_dir):
    """All documents mixed by source, weights 5, 2, 1 in turn, at most three passes over a source.

    ``first_position`` is a document's place in the mix's order, -1 if the mix never reaches it.
    """
    words = F.regexp_count(text_or_empty("text"), F.lit(WORD)).cast("bigint")
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", words.alias("size"))
    mixed, _ = mix_sources(rows, "doc_id", "source", "size", WEIGHTS)
    return mixed.select(
        F.col("key").alias("doc_id"),
        "size",
        "source_size",
        "target",
        "taken",
        "source",
        F.coalesce(F.get("positions", F.lit(0)), F.lit(-1)).alias("first_position"),
        F.size("positions").alias("passes"),
    )


def audit_sources(spark, sf_dir):
    """All sources of a language against each other and against it, by the terms of all documents."""
    return source_divergence(table(spark, sf_dir, "documents"), "lang", "source", "text")


def cluster_embeddings(spark, sf_dir):
    """All embeddings in 40 clusters after five rounds, with their centroids' digests."""
    assigned, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    digits = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    known = centroids.select("cluster", "cluster_inertia", "inertia", F.sha2(digits, 256).alias("centroid_sha256"))
    # One row per centroid, 40 at most.
    return assigned.join(F.broadcast(known), "cluster").select(
        F.col("key").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def remove_repeated_strings(spark, sf_dir):
    """All documents without the bytes of strings of 200 bytes that occur elsewhere too."""
    cut = remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")
    return cut.select(
        F.col("key").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_shortest_pack_first": pack_all_documents,
    "op2_ring_shards": shard_documents,
    "op3_golay_simhash": near_duplicate_documents,
    "op4_template_chat": format_all_conversations,
    "op5_robust_quality": judge_documents,
    "op6_bootstrapped_pii": personal_data,
    "op7_suffix_licenses": licence_documents,
    "op8_nra_topk": search_embeddings,
    "op9_context_tree": score_documents,
    "op10_golden_mix": mix_documents,
    "op11_segment_divergence": audit_sources,
    "op12_pca_centroids": cluster_embeddings,
    "op13_prefix_doubling": remove_repeated_strings,
}
