"""From raw documents to packed training sequences.

Language identification drops what has no language, line deduplication cuts repeated lines, the n-gram join keeps
one document of each near-duplicate group, span deduplication cuts repeated passages, packing tokenizes the rest.
Every stage but the last returns the columns of documents, lang as predicted and n_chars as the text now is.
The first stage bounds the session's Arrow batches for all of them.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from courtside.llm.common import read_table, shared_folder, small_batches
from courtside.llm.language_id import fit, held_out, identify, rejected, usual_means
from courtside.llm.line_dedup import drop_repeated_lines
from courtside.llm.ngram_join import near_duplicates
from courtside.llm.packing import op6_packing
from courtside.llm.span_dedup import remove_repeats

#: No SQL: language scores, MinHash, the tokenizer and the linear program are beyond it.
ORACLE_SQL = None


def _aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns of these names renamed, and the names to give back."""
    back = {f"__{name}": name for name in names if name in docs.columns}
    return docs.withColumnsRenamed({name: kept for kept, name in back.items()}), back


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    size = F.length("text").cast("long")
    return docs.select(*(size.alias(c) if c == "n_chars" else F.col(c) for c in columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language that stands out, or unlike any text of it; lang becomes the predicted one."""
    small_batches(spark)
    labelled = docs.where(~held_out())
    model = fit(labelled)
    usual = usual_means(labelled, model)
    others, back = _aside(docs, "lang_pred", "score", "log_mean")
    named = identify(others, model, mean="log_mean").where(~rejected(usual, "log_mean")).withColumn("lang", F.col("lang_pred"))
    return named.drop("lang_pred", "score", "log_mean").withColumnsRenamed(back).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one line of each group of like lines; documents left without a line go."""
    return _measured(drop_repeated_lines(docs), docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group, once; rows with a null doc_id stay."""
    groups = near_duplicates(docs)
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    once = Window.partitionBy("doc_id").orderBy(*(F.col(c).desc() for c in docs.columns if c != "doc_id"))
    first = docs.join(kept, "doc_id", "left_semi").withColumn("__row", F.row_number().over(once)).where("__row = 1")
    return first.select(docs.columns).unionByName(docs.where("doc_id is null"))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut sentences that repeated spans cover; documents left without a sentence go."""
    others, back = _aside(docs, "n_sentences", "removed")
    cut = remove_repeats(others).where("size(removed) = 0 or size(removed) < n_sentences")
    return _measured(cut.drop("n_sentences", "removed").withColumnsRenamed(back), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenized documents and their places in sequences."""
    return op6_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("ngram_join", near_copies),
    ("span_dedup", passages),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each but the last returns is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
