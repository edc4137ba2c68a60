"""Operator 9: a quality classifier over document statistics.

Random Fourier features approximate a Gaussian kernel over statistics of the
whole text; ridge regression on them is fitted from normal equations that each
partition sums up for itself (one matrix per partition, added in a tree of ``FAN_IN``
at a time), and isotonic regression turns its scores into probabilities.

Isotonic regression sees no score of a row that its own weights were fitted on:
labelled rows are dealt to ``FOLDS`` by their id, the sums are kept per fold,
and a fold's rows are scored by the weights of all sums but its own. The
weights of the final scores come from all sums.

Only what has a size fixed by parameters reaches the driver: the mean and
deviation of each statistic, ``FOLDS`` sums of ``(FEATURES + 1)^2`` numbers, and
counts per score bin. All labelled rows that aren't held out are used.

Defined results: a null or empty text has zero words and all statistics zero,
and is scored like any other; without usable labels, or with one class only,
every score is the share of label 1 (0.5 without any); rows with a null id
can't meet a label but are scored; repeated rows are scored each, and a
repeated labelled row counts each time; an empty table gives an empty table;
other columns aren't read, neither the language nor the source.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysweep.llm.common import staged

#: Random features, ridge penalty per labelled row, width of the kernel, score bins of the calibration.
FEATURES = 128
PENALTY = 1e-4
BINS = 2048
THRESHOLD = 0.7
#: Matrices that one task adds.
FAN_IN = 64
HELD_OUT_OF, HELD_OUT = 4, 2
#: Folds of the labelled rows, for the calibration.
FOLDS = 4

STATISTICS = ("log_words", "mean_word", "symbols", "bars", "shouts", "upper", "digits", "sentence_marks", "repeats",
              "distinct", "top_word", "lines", "repeated_lines", "short_words", "other_marks")

_SYMBOLS, _UPPER, _DIGITS = b"#*$%&<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_OTHER = b"()[]{}\"'/\\=_+-~^@`"


def _count(raw: bytes, these: bytes) -> int:
    return len(raw) - len(raw.translate(None, these))


def statistics(text: str) -> list[float]:
    """Shares and means over the whole text, in the order of ``STATISTICS``."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    chars = sum(map(len, words))
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [
        float(np.log1p(n)), chars / n, _count(raw, _SYMBOLS) / n, raw.count(b"|") / n, raw.count(b"!") / n,
        _count(raw, _UPPER) / chars, _count(raw, _DIGITS) / chars, _count(raw, b".,;:?") / n,
        sum(map(eq, words, words[1:])) / n, len(seen) / n ** 0.75, max(seen.values()) / n,
        len(lines) / n, 1 - len(set(lines)) / len(lines), sum(map((3).__ge__, map(len, words))) / n,
        _count(raw, _OTHER) / n]


def statistics_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, one double per statistic) for every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            made = np.array([statistics(t.as_py() or "") for t in batch.column(1)]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(made[:, k]) for k in range(len(STATISTICS))]], names=["doc_id", *STATISTICS])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} double" for c in STATISTICS)
    return rows.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """True for ids whose text has crc32 mod 4 equal to 2; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def fold(doc_id: Column) -> Column:
    """0 to ``FOLDS - 1``, by bits of the crc32 that :func:`held_out` doesn't use; rows of one id share a fold."""
    return (F.floor(F.crc32(doc_id.cast("string").cast("binary")) / HELD_OUT_OF) % FOLDS).cast("int")


class FourierMap:
    """Random Fourier features of standardised statistics, with a constant one."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, features: int = FEATURES, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean = mean
        self.scale = np.where(deviation > 1e-9, deviation, 1.0)
        d = len(mean)
        self.directions = rng.normal(0, 1 / np.sqrt(d), (d, features))
        self.phases = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        # Far outliers all look alike; bounded, they can't turn around a cosine.
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / self.directions.shape[1]) * np.cos(z @ self.directions + self.phases)
        return np.hstack([waves, np.ones((len(stats), 1))])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in STATISTICS])


def _partial_sums(mapping: FourierMap):
    def run(batches):
        size = mapping.directions.shape[1] + 1
        total = np.zeros((FOLDS, size, size + 1))
        for batch in batches:
            z = mapping(_matrix(batch))
            y, folds = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("label", "fold"))
            for k in range(FOLDS):
                own = z[folds == k]
                total[k, :, :size] += own.T @ own
                total[k, :, size] += own.T @ y[folds == k].astype(float)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])
    return run


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x) for x in pdf["sums"])
    return pd.DataFrame({"k": [pdf["k"].iloc[0]], "sums": [total.tobytes()]})


def _tree_sum(parts: DataFrame) -> np.ndarray:
    """The sum of the matrices of every partition, ``FAN_IN`` partitions to a task, level by level."""
    level = parts.select((F.spark_partition_id() / FAN_IN).cast("long").alias("k"), "sums")
    while True:
        level = staged(level.groupBy("k").applyInPandas(_added, "k long, sums binary"), "quality-sums")
        rows = level.limit(2).collect()
        if len(rows) == 1:
            return np.frombuffer(rows[0]["sums"])
        level = level.select((F.col("k") / FAN_IN).cast("long").alias("k"), "sums")


def ridge(sums: np.ndarray) -> np.ndarray:
    """Weights from normal equations (``Z'Z`` and ``Z'y`` side by side); the constant feature counts the rows."""
    size = len(sums)
    rows = max(1.0, sums[size - 1, size - 1])
    return np.linalg.solve(sums[:, :size] + PENALTY * rows * np.eye(size), sums[:, size])


def _fold_scores(mapping: FourierMap, weights: np.ndarray):
    """(label, raw): each row by the weights fitted without its fold (a row of ``weights`` each)."""
    def run(batches):
        for batch in batches:
            label, folds = (batch.column(batch.schema.get_field_index(c)) for c in ("label", "fold"))
            raw = (mapping(_matrix(batch)) * weights[folds.to_numpy(zero_copy_only=False)]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([label, pa.array(raw, pa.float64())], names=["label", "raw"])
    return run


def _scores(mapping: FourierMap, weights: np.ndarray, knots: tuple[np.ndarray, np.ndarray]):
    def run(batches):
        for batch in batches:
            score = np.interp(mapping(_matrix(batch)) @ weights, *knots)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(score, pa.float64())],
                                             names=["doc_id", "score"])
    return run


def isotonic_knots(position: np.ndarray, ones: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and values of the non-decreasing blocks fitted to shares of ones (pool adjacent violators)."""
    blocks: list[list[float]] = []   # weighted position, ones, count
    for p, k, n in zip(position, ones, count):
        blocks.append([p * n, k, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
                   text_col: str = "text", threshold: float = THRESHOLD, features: int = FEATURES) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; fitted on the labels of ids not held out."""
    stats = staged(statistics_table(docs, id_col, text_col), "quality-statistics")
    means = stats.agg(*[F.avg(c).alias(f"m_{c}") for c in STATISTICS],
                      *[F.stddev_pop(c).alias(f"s_{c}") for c in STATISTICS]).first()
    mapping = FourierMap(np.array([means[f"m_{c}"] or 0.0 for c in STATISTICS]),
                         np.array([means[f"s_{c}"] or 0.0 for c in STATISTICS]), features)
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    train = staged(stats.join(known, "doc_id").withColumn("fold", fold(F.col("doc_id"))), "quality-train")

    totals = train.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).first()
    n, ones = totals["n"], totals["ones"] or 0.0
    if n == 0 or ones in (0.0, float(n)):
        scored = stats.select("doc_id", F.lit(ones / n if n else 0.5).alias("score"))
    else:
        size = features + 1
        sums = _tree_sum(train.mapInArrow(_partial_sums(mapping), "sums binary")).reshape(FOLDS, size, size + 1)
        total = sums.sum(axis=0)
        without = np.array([ridge(total - own) for own in sums])
        low, high = -0.5, 1.5
        width = (high - low) / BINS
        binned = (train.mapInArrow(_fold_scores(mapping, without), "label double, raw double")
                  .withColumn("bin", F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("raw") - low) / width))))
                  .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).orderBy("bin").collect())
        knots = isotonic_knots(np.array([low + (r["bin"] + 0.5) * width for r in binned]),
                               np.array([r["ones"] for r in binned]), np.array([float(r["n"]) for r in binned]))
        id_type = stats.schema["doc_id"].dataType.simpleString()
        scored = stats.mapInArrow(_scores(mapping, ridge(total), knots), f"doc_id {id_type}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
