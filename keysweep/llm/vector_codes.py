"""Operator 13: codes for vectors from one codebook per part, with LAESA pivots.

Vectors are scaled to integers and cut into equal consecutive parts. The codebook of a
part starts with that part of the first vectors by id; each round assigns every part to
its nearest entry and moves each entry to the mean of its parts, rounded down. All sums
and distances are integers, so results don't depend on partitions or their order.

Nearest entries are found with pivots: a few entries of the first codebooks, far from
each other, stay fixed; the distances of every part to its pivots are computed once and
written with the parts. In a round the distances of pivots to entries give, as |d(part,
pivot) - d(pivot, entry)|, lower bounds of the distances to all entries. The entries with
the smallest bounds are evaluated first, in integers; others only where their bound
doesn't exceed the best so far. Bounds are floats, lowered by more than their rounding
error, so no nearest entry, and no tie, is lost. (How many evaluations are saved depends on the
vectors: the more independent their components, the fewer.)

Each round is one pass over the written parts, a sum per task and entry, and an
aggregation by (part, entry); only codebooks reach the driver, whose size is fixed by
parameters. Sums of errors by label: labels with 1 / ``HOT_SHARE`` of all rows or more
are at most ``HOT_SHARE`` and broadcast; rows of all others meet theirs in a plain join.

Defined results: rows whose vector is null, or holds a null or non-finite component,
are dropped; ids are ordered with nulls last, equal ids by their vector; repeated rows
count each; null labels are one label; with fewer vectors than entries, codebooks are
smaller; an empty table gives an empty table; other columns aren't read. Vectors of
different lengths, of a length that parts don't divide, or with a component beyond
``MAX_COMPONENT`` after scaling, raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysweep.llm.common import staged

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Pivots of each part, and entries evaluated at first.
PIVOTS = 8
HEAD = 16
#: Largest size of a scaled component: squared distances of a part of up to 128 components then fit 63 bits.
MAX_COMPONENT = 1 << 27
HOT_SHARE = 10_000
_CHUNK = 2048


def scaled_vectors(table: DataFrame, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """(vec_id, label, x): rows with a finite vector, its components times ``scale`` rounded down."""
    vector = F.col(vector_col)
    fine = vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return table.where(F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
        F.transform(vector, lambda v: F.floor(v.cast("double") * float(scale))).alias("x"))


@dataclass(frozen=True)
class Shape:
    dim: int
    parts: int

    @property
    def width(self) -> int:
        return self.dim // self.parts

    def matrix(self, column: pa.Array) -> np.ndarray:
        """(rows, parts, width) of a column of vectors, checked."""
        offsets = np.asarray(column.offsets)
        if len(column) and (np.diff(offsets) != self.dim).any():
            raise ValueError(f"vectors differ in length: {self.dim} components expected")
        x = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), self.parts, self.width)
        if x.size and np.abs(x).max() > MAX_COMPONENT:
            raise ValueError(f"a scaled component is larger than {MAX_COMPONENT}")
        return x


def choose_pivots(entries: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Entries far from each other: the first, then always the one farthest from those taken (ties: the first)."""
    taken = [0]
    near = ((entries - entries[0]) ** 2).sum(axis=1)
    while len(taken) < min(pivots, len(entries)):
        taken.append(int(near.argmax()))
        near = np.minimum(near, ((entries - entries[taken[-1]]) ** 2).sum(axis=1))
    return entries[taken]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, pivots) distances of parts to pivots, as 32-bit floats."""
    return np.sqrt(np.stack([((x - p) ** 2).sum(axis=1) for p in pivots], axis=1)).astype(np.float32)


class Assigner:
    """Nearest entries of one part position, for one state of its codebook."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray, head: int = HEAD):
        self.entries = entries
        self.to_entries = pivot_distances(entries, pivots)          # once a round
        self.longest = float(self.to_entries.max(initial=0))
        self.head = min(head, len(entries))
        self.evaluated = 0

    def _exact(self, x: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        diff = x[rows] - self.entries[at]
        self.evaluated += len(rows)
        return np.einsum("ij,ij->i", diff, diff)

    def _chunk(self, x: np.ndarray, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(x), len(self.entries)
        bound = np.zeros((n, k), np.float32)
        for p in range(distances.shape[1]):
            np.maximum(bound, np.abs(distances[:, p, None] - self.to_entries[None, :, p]), out=bound)
        # the float distances are off by at most a part in 2^23 each
        bound -= (np.float32(1e-6) * (distances.max(axis=1, initial=0) + np.float32(self.longest)))[:, None]
        rows = np.arange(n)
        if self.head < k:
            first = np.argpartition(bound, self.head - 1, axis=1)[:, :self.head]
        else:
            first = np.tile(np.arange(k), (n, 1))
        exact = self._exact(x, np.repeat(rows, self.head), first.ravel()).reshape(n, self.head)
        best = exact.min(axis=1)
        entry = np.where(exact == best[:, None], first, k).min(axis=1)   # ties: the lower index
        if self.head < k:
            limit = np.sqrt(best.astype(np.float64)) * (1 + 1e-6) + 1e-3
            open_ = bound <= limit[:, None].astype(np.float32)
            np.put_along_axis(open_, first, False, axis=1)
            r, e = np.nonzero(open_)                                      # by row, then by entry
            if len(r):
                d = self._exact(x, r, e)
                starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                owner = r[starts]
                least = np.minimum.reduceat(d, starts)
                lowest = np.minimum.reduceat(np.where(d == np.repeat(least, np.diff(np.r_[starts, len(r)])), e, k), starts)
                better = (least < best[owner]) | ((least == best[owner]) & (lowest < entry[owner]))
                best[owner[better]], entry[owner[better]] = least[better], lowest[better]
        return entry, best

    def __call__(self, x: np.ndarray, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part."""
        entry, best = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
        for at in range(0, len(x), _CHUNK):
            cut = slice(at, at + _CHUNK)
            entry[cut], best[cut] = self._chunk(x[cut], distances[cut])
        return entry, best


def _with_distances(shape: Shape, pivots: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = shape.matrix(batch.column(2))
            d = np.concatenate([pivot_distances(x[:, p], pivots[p]) for p in range(shape.parts)], axis=1)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * d.shape[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(d.ravel()))],
                                             names=["vec_id", "label", "x", "pivot_distances"])
    return run


def _assigned(shape: Shape, pivots: list[np.ndarray], codebooks: list[np.ndarray]):
    """For batches of the written parts: (x, entries, squared distances)."""
    assigners = [Assigner(c, p) for c, p in zip(codebooks, pivots)]

    def run(batch: pa.RecordBatch):
        x = shape.matrix(batch.column(batch.schema.get_field_index("x")))
        d = batch.column(batch.schema.get_field_index("pivot_distances")).flatten().to_numpy(zero_copy_only=False)
        d = d.reshape(len(x), shape.parts, -1)
        each = [a(x[:, p], d[:, p]) for p, a in enumerate(assigners)]
        return x, [e for e, _ in each], [b for _, b in each]
    return run


#: Rows after which a task hands out its sums, so that they stay within 63 bits.
_FLUSH_ROWS = 1 << 30


def _sums(shape: Shape, pivots: list[np.ndarray], codebooks: list[np.ndarray]):
    """(part, entry, n, s0, s1, ...): for each task the sums of the parts of each entry."""
    size = len(codebooks[0])
    names = ["part", "entry", "n", *[f"s{i}" for i in range(shape.width)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _assigned(shape, pivots, codebooks)
        n, s, seen = np.zeros((shape.parts, size), np.int64), np.zeros((shape.parts, size, shape.width), np.int64), 0

        def rows():
            part, entry = np.nonzero(n)
            return pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]),
                 *[pa.array(s[part, entry, i]) for i in range(shape.width)]], names=names)

        for batch in batches:
            x, entries, _ = assign(batch)
            for p, e in enumerate(entries):
                n[p] += np.bincount(e, minlength=size)
                np.add.at(s[p], e, x[:, p])
            seen += len(x)
            if seen >= _FLUSH_ROWS:
                yield rows()
                n[:], s[:], seen = 0, 0, 0
        yield rows()
    return run


def _codes(shape: Shape, pivots: list[np.ndarray], codebooks: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _assigned(shape, pivots, codebooks)
        for batch in batches:
            x, entries, errors = assign(batch)
            code = [bytes(row).hex() for row in np.stack(entries, axis=1).astype(np.uint8)] if len(x) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("vec_id")), batch.column(batch.schema.get_field_index("label")),
                 pa.array(code, pa.string()), pa.array(sum(errors) if len(x) else np.zeros(0, np.int64))],
                names=["vec_id", "label", "code", "error"])
    return run


@dataclass(frozen=True)
class VectorCodes:
    """What a fit gives: (vec_id, label, code, error) as a written table, and the final codebooks (part, entry, component)."""

    table: DataFrame
    codebooks: list[np.ndarray]

    def sha256(self) -> str:
        text = ",".join(str(v) for book in self.codebooks for entry in book.tolist() for v in entry)
        return hashlib.sha256(text.encode()).hexdigest()


def fit_codes(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS,
              scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> VectorCodes:
    """Codebooks of ``entries`` (256 at most) entries for each part, and the codes of all vectors."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    rows = scaled_vectors(table, scale, id_col, vector_col, label_col)
    types = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}"
    first = [r["x"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()]
    if not first:
        return VectorCodes(rows.sparkSession.createDataFrame([], f"{types}, code string, error long"), [])
    shape = Shape(len(first[0]), parts)
    if shape.dim % parts:
        raise ValueError(f"{shape.dim} components can't be cut into {parts} equal parts")
    start = shape.matrix(pa.array(first, pa.list_(pa.int64())))
    books = [start[:, p].copy() for p in range(parts)]
    fixed = [choose_pivots(b, pivots) for b in books]
    written = staged(rows.mapInArrow(_with_distances(shape, fixed), f"{types}, x array<bigint>, pivot_distances array<float>"),
                     "vector-parts")
    components = [f"s{i}" for i in range(shape.width)]
    schema = "part int, entry int, n bigint" + "".join(f", {c} bigint" for c in components)
    for _ in range(rounds):
        summed = written.mapInArrow(_sums(shape, fixed, books), schema).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in components])
        moved = [b.copy() for b in books]
        for r in summed.collect():   # parts x entries rows at most
            moved[r["part"]][r["entry"]] = [int(r[c]) // r["n"] for c in components]
        books = moved
    return VectorCodes(staged(written.mapInArrow(_codes(shape, fixed, books), f"{types}, code string, error long"), "vector-codes"), books)


def code_report(codes: VectorCodes) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): ``label_error`` sums the errors of equal labels, nulls together."""
    table = codes.table
    by_label = staged(table.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("error").alias("label_error")), "label-errors")
    total = by_label.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    hot = F.col("n") * HOT_SHARE >= total
    named = lambda df: df.select(F.col("label").alias("l"), "label_error")
    same = F.col("label").eqNullSafe(F.col("l"))
    met = table.join(F.broadcast(named(by_label.where(hot))), same, "left")
    rest = met.where(F.col("label_error").isNull()).drop("l", "label_error").join(named(by_label.where(~hot)), same)
    every = met.where(F.col("label_error").isNotNull()).unionByName(rest)
    return every.select("vec_id", "code", "error", "label_error", F.lit(codes.sha256()).alias("codebooks_sha256"))
