"""The registered queries of this subpackage and their SQL where SQL can say it.

Each reads its whole table. Tokenizer files are found by ``public_tokenizers``;
the operators take their path as a parameter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.llm import (
    decontaminate,
    fill_middle,
    license_scan,
    line_spread,
    ngram_join,
    packing,
    piece_coding,
    quality_model,
    quality_rules,
    secret_scan,
    sharding,
    spot_signatures,
    vector_codes,
)
from keysweep.llm.sql import CODES_SQL, LEAKS_SQL, LINES_SQL, MIDDLE_SQL, NGRAM_SQL, QUALITY_SQL, SECRETS_SQL

PIECE_MODEL = "piece_bpe_32k.model"
WORD_MODEL = "word_bpe_49k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_piece_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_coding.coding_report(documents(spark, sf_dir), tokenizer_path(PIECE_MODEL))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(documents(spark, sf_dir), size=4, percent=85)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.ledger(documents(spark, sf_dir))
    judged = quality_rules.apply_policy(entries, quality_rules.V2)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.rejected(quality_rules.BASE).alias("base_failed"), "kept", "fail_bits", "n_lines", "n_upper")


def op4_spot_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.edited_report(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path(WORD_MODEL))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files of a tree with files at every depth: source, language, and folders of 4,096 and of 64 ids.

    Of eight ids one lies right under its source, one under its language, two in the folder of 4,096, four in that of 64.
    """
    number, turn = F.col("doc_id"), F.pmod(F.col("doc_id"), F.lit(8))
    path = F.concat_ws(
        "/", F.lit(""), "source", F.when(turn >= 1, F.col("lang")), F.when(turn >= 2, F.floor(number / 4096).cast("string")),
        F.when(turn >= 4, F.pmod(F.floor(number / 64), F.lit(64)).cast("string")), number.cast("string"))
    return license_scan.licence_report(documents(spark, sf_dir).withColumn("path", path))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(documents(spark, sf_dir), limit=1 << 20)


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.quality_scores(documents(spark, sf_dir), labels)


def op10_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return line_spread.line_report(docs, line_spread.line_marks(line_spread.line_table(docs)))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination_report(documents(spark, sf_dir), benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_middle(documents(spark, sf_dir))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(vector_codes.fit_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_piece_coding, op2_ngram_join, op3_quality_rules, op4_spot_fingerprints, op5_packing,
                            op6_license_scan, op7_secret_scan, op8_sharding, op9_quality_model, op10_line_spread,
                            op11_decontamination, op12_fill_middle, op13_vector_codes)}

ORACLE_SQL: dict[str, str] = {
    "op2_ngram_join": NGRAM_SQL,
    "op3_quality_rules": QUALITY_SQL,
    "op7_secret_scan": SECRETS_SQL,
    "op10_line_spread": LINES_SQL,
    "op11_decontamination": LEAKS_SQL,
    "op12_fill_middle": MIDDLE_SQL,
    "op13_vector_codes": CODES_SQL,
}
