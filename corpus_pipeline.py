"""Documents made ready for training, in five stages.

    quality -> line dedup -> near-duplicates -> secrets -> packing

`run` applies the stages to `documents`; each stage's rows are written to the shared folder and read
again by the next one. All but the last return the columns of `documents`, with `n_chars` as the
text has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fovea.llm import line_dedup, near_dup, packing, quality, secret_scan
from fovea.llm.common import materialize, table, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near-duplicates share 80 % or more of their five-word shingles.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
#: Repeated runs of lines with fewer words stay: headings, greetings and list items, which clean documents share.
RUN_WORDS = 10


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of `documents`; `n_chars` counts the text."""
    chars = F.length("text").cast("bigint").alias("n_chars")
    return rows.select(*[chars if name == "n_chars" else name for name in COLUMNS])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is at least 0.3; rejected ones go.

    The classifier learns from `labels` of documents that this stage gets.
    """
    rows = docs.select(*COLUMNS)
    model = quality.learn(rows, table(spark, sf_dir, "labels"))
    scored = quality.score(rows, model, keep=COLUMNS)
    return _documents(scored.where(F.col("score") >= quality.KEEP_FROM))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of ten words or more that occur earlier; one of which no line is left goes."""
    rows = line_dedup.dedup_lines(docs.select(*COLUMNS), RUN_WORDS)
    return _documents(rows.where((F.col("n_deleted") == 0) | F.col("text").rlike(r"\S")))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Rows that repeat an id have one fate; a document without an id stays.
    """
    rows = docs.select(*COLUMNS)
    found = near_dup.near_duplicates(rows, SHINGLE_WORDS, SIMILAR_PERCENT)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    return _documents(rows.join(gone, "doc_id", "left_anti"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by a mark."""
    return _documents(secret_scan.redact(docs.select(*COLUMNS)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens (see `packing.pack`)."""
    return packing.pack(docs.select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near-duplicates", near_stage),
    ("secret scan", secret_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the classifier, the learned automata and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
