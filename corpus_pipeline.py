"""From raw documents to token ids: five stages, each a table of its own.

Every stage is a function of the session, the documents that the stage before it kept, and the folder of the
input tables. Between stages the documents are written to the shared folder and read back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sportmart.llm import decontamination, language_id, line_dedup, sentencepiece_bpe, simhash
from sportmart.llm.common import BLANKS, documents, importable, staged

#: Below this share of the best language a text counts as none of them.
MIN_SCORE = 0.5
MODEL = "piece_bpe_32k.model"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts in one of the learned languages: their code is no longer a byte than that language's own texts allow,
    and no other language's is near. Texts that are null or without a letter go; without any labelled
    row there is nothing to tell languages by, and all others stay. A missing ``lang`` is filled in."""
    model = language_id.fit(docs, limited=True)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # Else the filter is pushed below the prediction, which then runs twice.
    predict = language_id.language_of(docs, model).asNondeterministic()
    told = docs.select(whole(docs), predict("text").alias("told"))
    sure = (F.col("told.lang") != language_id.UNKNOWN) & (F.col("told.score") >= MIN_SCORE)
    return told.where(sure).select(*columns(docs, lang=F.coalesce("row.lang", "told.lang")))


def whole(docs: DataFrame) -> Column:
    """A row as one column, so that no helper column can meet one of its own."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def columns(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` out of the whole row, some of them changed."""
    return [(changed[c] if c in changed else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated chunks of lines out. A text of which nothing is left stands whole in documents with smaller ids, and goes."""
    # The text is no part of the row that is carried along: it would be shuffled twice.
    done = line_dedup.dedup_lines(docs.select(whole(docs.drop("text")), "doc_id", "text"))
    emptied = (F.col("n_removed") > 0) & (F.btrim("text", F.lit(BLANKS)) == "")
    done = done.where(~F.coalesce(emptied, F.lit(False)))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return done.select(*columns(docs, **changed))


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near copies."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add token ids, their number and the text that they decode to."""
    importable(spark)
    coded = sentencepiece_bpe.round_trip(public_tokenizers.path(MODEL))
    rows = docs.select(whole(docs), coded("text").alias("coded"))
    own = docs.drop("ids", "n_tokens", "decoded")
    return rows.select(
        *columns(own), F.col("coded.ids").alias("ids"), F.size("coded.ids").cast("long").alias("n_tokens"),
        F.col("coded.text").alias("decoded"),
    )


STAGES = [
    ("language", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near_copies),
    ("decontamination", decontaminate),
    ("tokens", tokenize),
]

#: Merges, fingerprints and code lengths are not for SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
