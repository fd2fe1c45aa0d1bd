"""The registered queries of the operators: thin projections of their results."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleframe.llm.common import table
from candleframe.llm.jaccard_join import jaccard_components
from candleframe.llm.line_dedup import line_dedup
from candleframe.llm.merkle import fold, leaf_digest, merkle_manifest, proof_digest
from candleframe.llm.packing import best_fit_pack
from candleframe.llm.quality import quality_rules
from candleframe.llm.sentencepiece_codec import decode, encode
from candleframe.llm.sharding import shard_documents
from candleframe.llm.suffix_dedup import suffix_dedup
from candleframe.llm.token_files import read_token_files, write_token_files
from candleframe.llm.topk import top_k
from candleframe.llm.url_filter import url_filter
from candleframe.llm.warc import read_warc, write_warc
from candleframe.llm.whitening import fit_whitening, whiten
from candleframe.session import ensure_checkpoint_dir

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also of the spans: where the last one ends (``covered``, the text's length in bytes) and a crc32 of all."""
    encoded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECE_BPE)
    spans = [F.concat_ws(",", F.col(c).cast("array<string>")) for c in ("begins", "ends")]
    slim = encoded.select(
        "doc_id", "ids", F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("covered"),
        F.crc32(F.concat_ws(";", *spans)).alias("spans_crc32"))
    return decode(slim, PIECE_BPE).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "covered",
        "spans_crc32",
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "group_rows")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 20 == 0)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, table(spark, sf_dir, "labels")).select("page_id", "host", "path", "rule", "verdict")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_pack(table(spark, sf_dir, "documents").select("doc_id", "text"), WORD_BPE)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents").select("doc_id", "text"), path, WORD_BPE)
    return read_token_files(spark, path, with_ids=False)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars"]
    marked = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    leaves = table(spark, sf_dir, "documents").select(
        "doc_id", "source", leaf_digest(*fields, "text").alias("leaf"),
        F.when(marked, leaf_digest(*fields, F.replace("text", F.lit("\n")))).alias("tampered"))
    return (
        merkle_manifest(leaves)
        .withColumn("proof_sha256", proof_digest(F.col("proof")))
        .withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
        .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                (F.col("folded_root") == F.col("root")).alias("verified"))
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fit = fit_whitening(vectors)
    rows = whiten(vectors, fit).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = fit.explained.tolist() if fit else []
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fit.n if fit else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*map(F.lit, explained)).cast("array<double>"), "at").alias("explained"),
        F.lit(fit.identity_error if fit else 0.0).alias("identity_error"),
    )


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_sharding": op2_sharding,
    "op3_top_k": op3_top_k,
    "op4_quality_rules": op4_quality_rules,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_url_filter": op6_url_filter,
    "op7_line_dedup": op7_line_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_token_files": op10_token_files,
    "op11_warc": op11_warc,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_embedding_whitening": op13_embedding_whitening,
}
