"""Operator 8: shards of bounded size by extendible hashing.

Each row has a 64-bit hash of its id. The directory starts at a depth of hash
bits; a bucket over the byte limit splits on its next bit, the others stay, so
a shard is a prefix of the hash with a depth of its own. The rows are summed
once by a long prefix (a partial aggregate; at most 2^``STEP`` sums); buckets
are split on those sums, and only buckets still too large at that length are
summed again, by ``STEP`` more bits.

The upper 40 bits come from the id alone, the lower 24 from the row's place in
the scan, so that an id which many rows repeat can still be split. Rows, with
their hash and size, are written to the checkpoint folder first: all later
reads see the same hash.

A row weighs what it stores: the bytes of every column and ``ROW_BYTES`` for
the row itself, so that also rows without a text fill a bucket, and what
:func:`write_shards` writes, all columns, is what was counted.

Sums and directory have one row per prefix that occurs and per shard: their
number follows the total size over the limit. A row looks up its prefix at each
depth in use; a directory of the global depth would have a row per prefix of
that length, 2^64 where one id had to be split to its last bit.

Defined results: a null weighs nothing beside its row, a null id is an id like
others; a row larger than the limit is a shard of its own, marked
``oversized``; ties can't occur, as only sums
decide; an empty table gives an empty directory and table; other columns pass
through :func:`write_shards`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.llm.common import staged

SHARD_BYTES = 64 << 20
#: Hash bits summed at a time.
STEP = 12
ID_BITS = 40
MAX_DEPTH = 64
#: Bytes that a row takes beside its values.
ROW_BYTES = 16


def prefix(hash64: Column, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit hash, as a number."""
    return F.shiftrightunsigned(hash64, 64 - depth) if depth else F.lit(0).cast("long")


def row_hash(id_column: Column, place: Column) -> Column:
    """Upper bits from the id, lower bits from the row's place."""
    low = (1 << (64 - ID_BITS)) - 1
    own = F.coalesce(F.xxhash64(id_column.cast("string")), F.lit(0))
    return own.bitwiseAND(F.lit(~low).cast("long")).bitwiseOR(F.xxhash64(place).bitwiseAND(F.lit(low).cast("long")))


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row's values, plain: strings and binaries by length, nested ones as JSON, others at 8."""
    def weight(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.VarcharType, T.CharType, T.BinaryType)):
            length = F.octet_length(column)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            length = F.octet_length(F.to_json(F.struct(column.alias("v"))))
        else:
            length = F.lit(8)
        return F.when(column.isNull(), 0).otherwise(length).cast("long")

    return sum((weight(f) for f in schema.fields), F.lit(ROW_BYTES).cast("long"))


def hashed_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, hash, n_bytes) of every row, written and read again."""
    rows = docs.select(F.col(id_col).alias("doc_id"), row_bytes(docs.schema).alias("n_bytes"),
                       F.monotonically_increasing_id().alias("place"))
    return staged(rows.select("doc_id", row_hash(F.col("doc_id"), F.col("place")).alias("hash"), "n_bytes"), "shard-rows")


def _split(sums: DataFrame, depth: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(final, open): buckets of sums by ``depth``-bit prefixes.

    The sums are added up along shorter and shorter prefixes; a bucket is final
    where it fits and the bucket one bit shorter doesn't. Buckets that don't
    fit at the full length stay open.
    """
    start = sums.agg(F.min("base")).first()[0]
    levels = F.explode(F.sequence(F.lit(start), F.lit(depth))).alias("depth")
    every = sums.select("prefix", "n_bytes", "n_rows", levels)
    totals = (every.select(F.expr(f"shiftrightunsigned(prefix, {depth} - depth)").alias("prefix"), "depth", "n_bytes", "n_rows")
              .groupBy("depth", "prefix").agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n_rows").alias("n_rows")))
    above = totals.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"), F.col("n_bytes").alias("up_bytes"))
    joined = totals.withColumn("up", F.shiftrightunsigned("prefix", 1)).join(above, ["depth", "up"], "left")
    fits = F.col("n_bytes") <= limit
    opened = F.col("up_bytes").isNull() | (F.col("up_bytes") > limit)
    final = joined.where(fits & opened).select("depth", "prefix", "n_bytes", "n_rows")
    return final, totals.where((F.col("depth") == depth) & ~fits).select("depth", "prefix", "n_bytes", "n_rows")


def directory(rows: DataFrame, limit: int = SHARD_BYTES, step: int = STEP) -> DataFrame:
    """(depth, prefix, n_bytes, n_rows, oversized): the shards of :func:`hashed_rows`.

    A bucket of one row can't be split, however large the row.
    """
    done, depth = None, 0
    todo = rows.select("hash", "n_bytes")
    while True:
        top = min(MAX_DEPTH, depth + step)
        sums = staged(todo.groupBy(prefix(F.col("hash"), top).alias("prefix"), F.lit(depth).alias("base"))
                      .agg(F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_rows")), "shard-sums")
        if sums.isEmpty():
            return done if done is not None else sums.select(
                F.lit(0).alias("depth"), "prefix", "n_bytes", "n_rows", F.lit(False).alias("oversized")).limit(0)
        final, still = _split(sums, top, limit)
        single = still.where((F.col("n_rows") == 1) | (F.col("depth") == MAX_DEPTH))
        shards = staged(final.withColumn("oversized", F.lit(False)).unionByName(
            single.withColumn("oversized", F.lit(True))), "shard-directory")
        done = shards if done is None else done.unionByName(shards)
        open_buckets = staged(still.where((F.col("n_rows") > 1) & (F.col("depth") < MAX_DEPTH)).select("prefix"), "shard-open")
        if top == MAX_DEPTH or open_buckets.isEmpty():
            return done
        todo = (todo.withColumn("prefix", prefix(F.col("hash"), top))
                .join(open_buckets, "prefix", "left_semi").drop("prefix"))
        depth = top


def shard_rows(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """(doc_id, hash, shard, depth, oversized, n_bytes): every row with its shard.

    Depths in use are few (a list bounded by 64 numbers); a row is looked up by
    its prefix at each, and exactly one is in the directory.
    """
    depths = sorted(r["depth"] for r in shards.select("depth").distinct().collect())
    keys = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), prefix(F.col("hash"), d).alias("prefix")) for d in depths])) \
        if depths else F.explode(F.array().cast("array<struct<depth:int,prefix:bigint>>"))
    placed = rows.select("*", keys.alias("k")).select("doc_id", "hash", "n_bytes", "k.depth", "k.prefix")
    names = shards.select("depth", "prefix", "oversized")
    return placed.join(names, ["depth", "prefix"]).select(
        "doc_id", "hash", shard_name(F.col("depth"), F.col("prefix")).alias("shard"), "depth", "oversized", "n_bytes")


def shard_name(depth: Column, number: Column) -> Column:
    """Depth and prefix bits, such as ``05-01101``."""
    bits = F.when(depth == 0, F.lit("")).otherwise(F.expr("right(lpad(bin(prefix), 64, '0'), depth)"))
    return F.concat(F.lpad(depth.cast("string"), 2, "0"), F.lit("-"), bits)


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, shard, depth, oversized, n_bytes) per row."""
    rows = hashed_rows(docs, id_col)
    return shard_rows(rows, directory(rows, limit)).drop("hash")


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, id_col: str = "doc_id") -> None:
    """``docs`` as Parquet folders ``shard=...`` under ``path``; all columns pass through.

    The rows are staged with their hash, so that every row goes where its size
    was counted; equal hashes always share a shard.
    """
    kept = staged(docs.withColumns({
        "__bytes": row_bytes(docs.schema),
        "__hash": row_hash(F.col(id_col), F.monotonically_increasing_id())}), "shard-documents")
    rows = kept.select(F.col(id_col).alias("doc_id"), F.col("__hash").alias("hash"), F.col("__bytes").alias("n_bytes"))
    names = shard_rows(rows, directory(rows, limit)).select(F.col("hash").alias("__hash"), "shard").distinct()
    (kept.join(names, "__hash").drop("__hash", "__bytes")
     .repartition("shard").write.partitionBy("shard").parquet(path))
