"""The registered queries of this package, beside their SQL counterparts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, chat, decontamination, html, jaccard, line_dedup, packing, prefix_trie, quality, sharding, token_output, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All exchanges of all conversations as tool calls and results."""
    messages = _table(spark, sf_dir, "conversations")
    return chat.link_tool_calls(chat.exchanged_calls(messages), chat.exchanged_results(messages), chat.TOOLS)


def op2_exact_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.packed_documents(_table(spark, sf_dir, "documents"), _vocabulary(), capacity=2048)


def op3_stratified_interleaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of equal row counts and one mixture of sources."""
    sharded = sharding.stratified_shards(_table(spark, sf_dir, "documents"), shards=8, seed=17)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the edits of its best passage."""
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality.quality_verdicts(_table(spark, sf_dir, "documents"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored segment of all documents in packed rows of 2048 ids."""
    return token_output.packed_segments(_table(spark, sf_dir, "documents"), _vocabulary(), capacity=2048)


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document under links of 0.9 between sets of three-word shingles."""
    return jaccard.similar_groups(_table(spark, sf_dir, "documents"), words=3, least=90).select("doc_id", "n_shingles", "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learned from labels that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.scored(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract_articles(_table(spark, sf_dir, "pages"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the three-line passages that occur earlier."""
    return line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents")).select("doc_id", "text", "lines_removed")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of a byte-level and a piece tokenizer in every document, and how common they are."""
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents")
    return alignment.aligned_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as it is read back from archives with an embedded dictionary."""
    return warc.archived_pages(_table(spark, sf_dir, "pages"), least=0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_tool_calls,
        op2_exact_complement_packing,
        op3_stratified_interleaving,
        op4_decontamination,
        op5_quality_cascade,
        op6_token_output,
        op7_ngram_jaccard,
        op8_toxicity,
        op9_html_extraction,
        op10_line_dedup,
        op11_token_alignment,
        op12_warc,
        op13_prefix_trie,
    )
}

ORACLE = {"op1_tool_calls": chat.ORACLE, "op10_line_dedup": line_dedup.ORACLE, "op13_prefix_trie": prefix_trie.ORACLE}
