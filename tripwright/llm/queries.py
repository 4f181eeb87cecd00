"""The registered queries of the training-data operators, and SQL where it can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.llm import (
    bpe,
    chat,
    decontamination,
    html_extract,
    line_dedup,
    pii,
    quality,
    sharding,
    simhash_dedup,
    token_files,
)
from tripwright.llm._common import read_table


def _tokenizer(name: str) -> str:
    """The path of a public tokenizer file, the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return bpe.token_digests(read_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id of every document."""
    found = simhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text without repeated lines, n_lines before, n_removed, of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")
    return line_dedup.dedup_lines(docs.withColumn("n_lines", n_lines))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from its token file."""
    docs = read_table(spark, sf_dir, "documents")
    return token_files.read_token_files(token_files.write_token_files(docs, _tokenizer("byte_bpe_50k.json")))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, slot, shard of every document."""
    return sharding.assign_shards(read_table(spark, sf_dir, "documents").select("doc_id"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted examples."""
    columns = ["conv_id", "turn", "role", "text"]
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = read_table(spark, sf_dir, "conversations").select(*columns).unionByName(extra)
    return chat.digests(chat.format_chat(turns))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of the personal data in every document."""
    return pii.find_pii(read_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base figures, the score and the verdict of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it holds a passage of."""
    return decontamination.overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline of corpus_pipeline.py over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_files": op2_token_files,
    "op3_sharding": op3_sharding,
    "op4_bpe": op4_bpe,
    "op5_html": op5_html,
    "op6_simhash": op6_simhash,
    "op7_chat": op7_chat,
    "op8_pii": op8_pii,
    "op9_quality": op9_quality,
    "op10_decontamination": op10_decontamination,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op3_sharding": sharding.oracle(),
}
