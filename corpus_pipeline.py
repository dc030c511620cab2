"""From raw documents to clean, tokenised training text, in five stages.

Each stage takes (spark, docs, sf_dir), with docs the stage before it as re-read from Parquet, and returns a DataFrame.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.bpe import digests
from tallymark.llm.common import Scratch, table
from tallymark.llm.langid import UNKNOWN, fit, held_out, predict
from tallymark.llm.minhash import labelled_copies
from tallymark.llm.secrets import RULES, blocks, bound, find_secrets, running
from tallymark.llm.templates import decontaminate

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str, least_share: float = 0.0) -> DataFrame:
    """Keep the documents that have a letter; lang becomes the language found in the text.

    The model learns from the rows outside the held-out fold, as op6 does. Null texts and texts without a letter go, and
    all do where no language was learned. ``least_share`` would also reject texts whose best language holds less of the
    evidence; it is off, as a short text in a learned language may hold little. Ties go to the first language by name.
    Rows without an id and repeated rows are judged by their texts; very long texts are read whole; further columns go.
    """
    model = fit(docs.where(~held_out(4, 2)))
    found = predict(docs, model, *COLUMNS).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_share))
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def single_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates.

    Rows without an id or without words stay, as do repeated rows of a document that stays. Rows of one id and unequal
    texts are judged by their texts. Very long texts are compared whole; further columns go.
    """
    gone = labelled_copies(docs).where("NOT kept").select(F.col("doc_id").alias("gone_id"), "body").distinct()
    mine = (docs["doc_id"].cast("long") == gone["gone_id"]) & (F.xxhash64(docs["text"].cast("string")) == gone["body"])
    return docs.join(gone, mine, "left_anti").select(*COLUMNS)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no benchmark passage, re-parameterised ones included.

    Null and empty texts hold none and stay, as do rows without an id. Repeated rows go or stay together; very long
    texts are searched whole; further columns go.
    """
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def secret_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by [SECRET]; no document goes. n_chars follows the text.

    A null text stays null. Each row is treated by itself, so null ids and repeated rows change nothing; very long texts
    are searched whole; further columns go.
    """
    return redacted(docs.select(*COLUMNS)).select(*COLUMNS)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of the secrets in text replaced; overlapping spans make one.

    A text is put together block by block of its spans, so the work grows with its length and not with its square.
    """
    spans = F.array_sort(F.concat(*[F.transform(F.col(f"spans_{r.kind}"), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))) for r in RULES]))
    found = find_secrets(docs, keep=tuple(docs.columns)).withColumn("spans", spans)
    zero, none = F.lit(0).cast("long"), F.array().cast("array<string>")
    parts = bound(F.col("spans"), lambda found: F.transform(blocks(found), lambda b: F.struct(b.alias("b"), F.aggregate(b, zero, lambda m, s: F.greatest(m, s["stop"])).alias("stop"))))
    # Where the text before each block ends, and with it the text that the block's spans cut up.
    ends = lambda p: running(F.transform(p, lambda q: q["stop"]), lambda a, n: F.greatest(a, n))
    placed = bound(parts, lambda p: bound(ends(p), lambda e: F.arrays_zip(p.alias("part"), F.slice(e, 1, F.size(p)).alias("at"), F.slice(e, 2, F.size(p)).alias("stop"))))
    cut = lambda z: F.substring(F.col("text"), (z["at"] + 1).cast("int"), (z["stop"] - z["at"]).cast("int"))
    placed = F.transform(placed, lambda z: F.struct(z["part"]["b"].alias("b"), z["at"].alias("at"), cut(z).alias("body")))

    def step(z):
        def one(acc, s):
            inside = s["start"] < acc["at"]
            gap = F.substring(z["body"], (acc["at"] - z["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
            return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], F.array(gap, F.lit("[SECRET]")))).alias("out"))

        return one

    pieces = F.flatten(F.transform(placed, lambda z: F.aggregate(z["b"], F.struct(z["at"].alias("at"), none.alias("out")), step(z), lambda acc: acc["out"])))
    last = F.array_max(F.transform("spans", lambda s: s["stop"]))
    text = F.when(F.size("spans") > 0, F.concat(F.array_join(pieces, ""), F.substring(F.col("text"), (last + 1).cast("int"), F.length("text")))).otherwise(F.col("text"))
    return found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes of each document that is left.

    A null text counts as empty. Rows without an id and repeated rows all come back; very long texts are encoded whole.
    """
    return digests(docs)


STAGES = [
    ("language_id", language),
    ("near_duplicates", single_copies),
    ("decontamination", uncontaminated),
    ("secrets", secret_free),
    ("tokens", tokenised),
]

#: Language models, signatures and merges are beyond SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again.

    A stage's intermediate tables and its input go as soon as its result is written.
    """
    scratch = Scratch(spark, "pipeline")
    begun, docs = len(Scratch.live), table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        following = scratch.save(stage(spark, docs, sf_dir))
        Scratch.release(begun)
        scratch.drop(docs)
        docs = following
    return docs
