"""The corpus pipeline: quality rules, line dedup, n-gram Jaccard join, secret scans, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of documents; each works on all that its predecessor
kept, and a stage's output depends on its input alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keysweep.llm import line_spread, ngram_join, packing, quality_rules, secret_scan
from keysweep.llm.common import staged
from keysweep.llm.queries import WORD_MODEL, documents, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy rejects go."""
    return quality_rules.keep_documents(docs, quality_rules.V2)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Furniture lines, spread over many sites, are cut from the texts; ``n_chars`` follows."""
    marks = line_spread.line_marks(line_spread.line_table(docs))
    return line_spread.remove_furniture(docs, marks, length_col="n_chars")


def ngram_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) one document stays."""
    return ngram_join.keep_first(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows."""
    return secret_scan.redact(docs, length_col="n_chars")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are tokenized and packed into windows; one row per piece."""
    return packing.pack_documents(docs, tokenizer_path(WORD_MODEL))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_spread", line_stage),
    ("ngram_join", ngram_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]

#: SQL can't tokenize; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's output but the last is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
