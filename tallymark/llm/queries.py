"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymark.llm.common import table


def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymark.llm.tokens import token_counts

    return token_counts(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens", "terminated")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymark.llm.bpe import digests

    return digests(table(spark, sf_dir, "documents"))


def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymark.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_trigram_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymark.llm.secrets import report

    return report(table(spark, sf_dir, "documents"))


def op6_word_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymark.llm.langid import identify

    return identify(table(spark, sf_dir, "documents"))


def op2_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymark.llm.ego import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_template_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymark.llm.templates import alignments

    return alignments(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymark.llm.lmscore import cross_entropy_difference

    chosen = table(spark, sf_dir, "labels").where("quality = 1")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), chosen)


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymark.llm.pii import pseudonymise

    # Set a key of your own: whoever knows it can tell which entity a surrogate stands for.
    return pseudonymise(table(spark, sf_dir, "documents"), spark.conf.get("spark.tallymark.pii.key", "public-example-key"))


def op3_compression_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymark.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymark.llm.mixing import report

    return report(table(spark, sf_dir, "documents"))


def op12_anagram_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymark.llm.anagrams import counted_words, variants

    return variants(counted_words(table(spark, sf_dir, "documents")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallymark.llm.prefixes import report

    return report(table(spark, sf_dir, "conversations"))
