"""Operator 11: benchmark decontamination with a broadcast hash set of test n-grams.

Texts are lower-cased (A-Z only) and cut into words of digits, letters and
characters beyond ASCII. Every run of ``size`` consecutive words of a benchmark
item is a window; an item of fewer words, but not none, is one window. The
distinct windows, with their words and the items that hold them, are broadcast
under a 64-bit key; the documents' windows are keyed the same way, looked up,
and each hit is verified word by word, so a clash of keys changes nothing. A
document word inside any verified occurrence is hit.

Keys are built by doubling: the key of 2, 4, 8 words joins two keys of half the
length, and any other length joins powers of two, so a window costs a few hashes
of two longs whatever its length.

The windows to broadcast are measured first (``MAX_BROADCAST_BYTES``). A larger
benchmark is cut by key into as many parts as it takes, and the documents' words,
written once, are looked up in one part after the other: more scans, not more
memory. Only matched windows, and one narrow row for each document, are shuffled,
by the row's number or by the digest of a text; no key of those is hot.

Defined results: a null or empty text has no words; an item without words has no
windows; a null item id is read as the empty text; items that share an id are one
item; repeated rows and null document ids are documents like others; empty tables
give an empty table, or documents without hits; other columns aren't read, except
by the functions that remove, which pass them through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysweep.llm.common import staged, whole_text

#: Words in a window.
SIZE = 10
#: Largest table of windows that is broadcast at once.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OTHER_UPPER = r"[\p{Lu}\p{Lt}\p{IsUppercase}&&[^A-Z]]"
#: What separates words, in a text of any case: all of ASCII but digits and letters. Named one by one,
#: they become one table in Java, which is faster than ranges.
_SEPARATOR = "[" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Key of the row that stands for the document itself; its window has no words.
_SELF = 0
_ROW_BYTES = 160   # row header, pointers and lengths of a window in a hash relation


def plain_words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased, in order.

    ``lower`` is several times as fast as ``translate`` and does the same to a
    text without other capitals.
    """
    low = F.when(text.rlike(_OTHER_UPPER), F.translate(text, _UPPER, _UPPER.lower())).otherwise(F.lower(text))
    return F.array_remove(F.split(low, _SEPARATOR), "")


def _with_keys(rows: DataFrame, lengths: list[int], words: str = "words") -> DataFrame:
    """``rows`` with ``key<L>`` for each length: at each place the key of the L words from there on.

    Keys of windows that would run over the end are there too, and match no window.
    """
    keep = rows.columns
    powers = {1 << b for n in lengths for b in range(n.bit_length()) if n >> b & 1}
    out = rows.withColumn("__p1", F.transform(words, lambda w: F.xxhash64(w)))
    step = 1
    while step < max(powers, default=1):
        out = out.withColumn(f"__p{2 * step}", _paired(f"__p{step}", f"__p{step}", step))
        step *= 2
    for n in lengths:
        parts = [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]
        out = out.withColumn(f"__k{n}_0", F.col(f"__p{parts[0]}"))
        done = parts[0]
        for i, p in enumerate(parts[1:], 1):
            out = out.withColumn(f"__k{n}_{i}", _paired(f"__k{n}_{i - 1}", f"__p{p}", done))
            done += p
        out = out.withColumnRenamed(f"__k{n}_{len(parts) - 1}", f"key{n}")
    return out.select(*keep, *[f"key{n}" for n in lengths])


def _paired(left: str, right: str, shift: int) -> Column:
    """At each place the hash of ``left`` there and ``right`` ``shift`` places on."""
    moved = F.slice(right, shift + 1, F.greatest(F.size(right), F.lit(1)))
    return F.zip_with(left, moved, lambda a, b: F.xxhash64(a, b))


@dataclass(frozen=True)
class Windows:
    """The benchmark's distinct windows: (key, length, words, items), and how they are cut for broadcasting."""

    table: DataFrame
    lengths: tuple[int, ...]
    parts: int


def benchmark_windows(benchmark: DataFrame, size: int = SIZE, id_col: str = "item_id", text_col: str = "text",
                      max_bytes: int = MAX_BROADCAST_BYTES) -> Windows:
    """The distinct windows of a benchmark, written once and measured."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                             plain_words(whole_text(text_col)).alias("words"))
    items = items.withColumn("length", F.least(F.size("words"), F.lit(size))).where("length > 0")
    at = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1))
    cut = (items.select("item", "length", "words", at.alias("at"))
           .select("item", "length", F.slice("words", F.col("at"), F.col("length")).alias("words")))
    found = staged(cut.groupBy("length", "words").agg(F.array_sort(F.collect_set("item")).alias("items")), "test-windows")
    lengths = sorted(r["length"] for r in found.select("length").distinct().collect())   # at most ``size`` of them
    keyed = _with_keys(found, lengths)
    key = F.coalesce(*[F.when(F.col("length") == n, F.get(f"key{n}", F.lit(0))) for n in lengths]) if lengths else F.lit(0)
    texts = [F.aggregate(c, F.lit(0), lambda n, x: n + F.octet_length(x) + 24) for c in ("words", "items")]
    keyed = keyed.select(key.cast("long").alias("key"), "length", "words", "items",
                         (F.lit(_ROW_BYTES) + texts[0] + texts[1]).cast("long").alias("bytes"))
    table = staged(keyed, "test-windows-keyed")
    parts = 1
    while parts < 1 << 16:   # beyond that, one window alone is too large
        largest = (table.groupBy(F.pmod("key", F.lit(parts)).alias("part")).agg(F.sum("bytes").alias("n"))
                   .agg(F.max("n").alias("n")).first()["n"])
        if (largest or 0) <= max_bytes:
            break
        parts *= 2
    return Windows(table.drop("bytes"), tuple(lengths), parts)


def _lookup(keyed: DataFrame, windows: Windows, part: int, with_self: bool) -> DataFrame:
    """Verified occurrences in the windows of one part; with_self: and a row of length 0 for each document."""
    carried = [c for c in keyed.columns if not c.startswith("key")]
    mine = windows.table.where(F.pmod("key", F.lit(windows.parts)) == part) if windows.parts > 1 else windows.table
    mine = mine.select("key", "length", F.col("words").alias("window"), "items")
    if with_self:
        none = F.array().cast("array<string>")
        mine = mine.unionByName(keyed.sparkSession.range(1).select(
            F.lit(_SELF).cast("long").alias("key"), F.lit(0).alias("length"), none.alias("window"), none.alias("items")))
    # the arrays of keys end to end, behind the document's own: each is as long as the document
    every = F.concat(F.array(F.lit(_SELF).cast("long")), *[F.col(f"key{n}") for n in windows.lengths])
    rows = keyed.select(*carried, every.alias("keys"))
    each = rows.select(*carried, F.posexplode_outer("keys").alias("place", "key")).join(F.broadcast(mine), "key")
    at = F.pmod(F.col("place") - 1, F.greatest(F.size("words"), F.lit(1))) + 1
    same = F.slice("words", at, F.greatest("length", F.lit(1))) == F.col("window")
    own = (F.col("place") == 0) & (F.col("length") == 0)
    return (each.where(own | ((F.col("place") > 0) & (F.col("length") > 0) & same))
            .select(*[c for c in carried if c != "words"], F.when(F.col("length") > 0, at).alias("at"), "length", "items"))


def occurrences(docs: DataFrame, windows: Windows, text_col: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """(row, ..., n_words, at, length, items): each place where a window occurs, from 1 on, and a row of length 0 for each document.

    ``row`` numbers the documents; ``carry`` are further columns to take along.
    """
    words = docs.select(*[c.alias(n) for n, c in (carry or {}).items()], plain_words(whole_text(text_col)).alias("words"))
    words = words.select(F.monotonically_increasing_id().alias("row"), "*")
    if windows.parts > 1:
        words = staged(words, "words")   # several scans must see the same row numbers
    keyed = _with_keys(words.withColumn("n_words", F.size("words")), list(windows.lengths))
    out = _lookup(keyed, windows, 0, True)
    for part in range(1, windows.parts):
        out = out.unionByName(_lookup(keyed, windows, part, False))
    return out


def _covered(places: Column) -> Column:
    """Words covered by (at, length) places, sorted; one pass that keeps two numbers."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(places, start, lambda acc, x: F.struct(
        F.greatest(acc["end"], x["at"] + x["length"]).alias("end"),
        (acc["n"] + F.greatest(x["at"] + x["length"] - F.greatest(acc["end"], x["at"]), F.lit(0))).alias("n")),
        lambda acc: acc["n"])


def contamination_report(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text",
                         item_col: str = "item_id", item_text_col: str = "text",
                         max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """One row per document: words, hit words, and the items whose windows occur, as a sorted array."""
    windows = benchmark_windows(benchmark, size, item_col, item_text_col, max_bytes)
    found = occurrences(docs, windows, text_col, {"doc_id": F.col(id_col)})
    real = F.col("length") > 0
    grouped = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").cast("long").alias("n_words"),
        F.collect_list(F.when(real, F.struct("at", "length"))).alias("places"),
        F.collect_set(F.when(real, F.col("items"))).alias("sets"))
    return grouped.select("doc_id", "n_words", _covered(F.array_sort("places")).cast("long").alias("n_hit"),
                          F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items"))


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text",
                       max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(digest, spans): of each different text that holds a window, its hit words as runs ``[first, last]``, from 1 on.

    Keyed by the text's MD5, so that copies meet in one row and no row numbers have to be the same twice.
    """
    windows = benchmark_windows(benchmark, size, item_col, item_text_col, max_bytes)
    found = occurrences(docs, windows, text_col, {"digest": F.md5(whole_text(text_col))}).where("length > 0")
    words = (found.select("digest", F.explode(F.sequence("at", F.col("at") + F.col("length") - 1)).alias("word")).distinct())
    # a run of neighbours: word number minus rank stays the same; the window holds the words of one text
    ranked = words.selectExpr("digest", "word", "word - row_number() OVER (PARTITION BY digest ORDER BY word) AS run")
    runs = ranked.groupBy("digest", "run").agg(F.min("word").alias("first"), F.max("word").alias("last"))
    return runs.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))


def _without(text: Column, spans: Column) -> Column:
    """``text`` without its runs of hit words: from a run's first word to its last; what stands around stays."""
    gaps, words = F.col("__gaps"), F.col("__words")
    last = F.struct((F.size(words) + 1).alias("first"), F.size(words).alias("last"))
    every = F.concat(spans, F.array(last))
    pieces = F.transform(every, lambda s, i: F.concat(
        F.array_join(F.slice("__pairs", F.when(i == 0, 0).otherwise(F.get(every, i - 1)["last"]) + 1,
                             s["first"] - F.when(i == 0, 0).otherwise(F.get(every, i - 1)["last"]) - 1), ""),
        F.get(gaps, s["first"] - 1)))
    return F.array_join(pieces, "")


def remove_spans(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, text_col: str = "text",
                 length_col: str | None = None, max_bytes: int = MAX_BROADCAST_BYTES, **items: str) -> DataFrame:
    """``docs`` without the hit runs of words; every row and column stays, texts without hits as they are.

    ``length_col``, where given, is set to the new text's code points.
    """
    spans = contaminated_spans(docs, benchmark, size, text_col, max_bytes=max_bytes, **items)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                       F.md5(whole_text(text_col)).alias("digest"))
    joined = rows.join(spans, "digest", "left")
    text = F.when(F.col("spans").isNotNull(), F.col("__row")[text_col])
    cut = joined.select("__row", "spans", F.array_remove(F.split(text, _SEPARATOR), "").alias("__words"),
                        F.split(text, _WORD).alias("__gaps"))
    cut = cut.withColumn("__pairs", F.zip_with(F.slice("__gaps", 1, F.greatest(F.size("__words"), F.lit(1))), "__words",
                                               lambda g, w: F.concat(g, w)))
    new = cut.select("__row", F.col("spans").isNotNull().alias("__hit"),
                     F.when(F.col("spans").isNotNull(), _without(text, F.col("spans"))).otherwise(F.col("__row")[text_col]).alias("__text"))

    def column(name: str) -> Column:
        old = F.col("__row")[name]
        if name == text_col:
            return F.col("__text").alias(name)
        if name == length_col:
            return F.when(F.col("__hit"), F.length("__text")).otherwise(old).cast(docs.schema[name].dataType).alias(name)
        return old.alias(name)

    return new.select(*[column(c) for c in docs.columns])


def remove_documents(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, text_col: str = "text",
                     max_bytes: int = MAX_BROADCAST_BYTES, **items: str) -> DataFrame:
    """``docs`` without the rows whose text holds a window."""
    spans = contaminated_spans(docs, benchmark, size, text_col, max_bytes=max_bytes, **items).select("digest")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                       F.md5(whole_text(text_col)).alias("digest"))
    left = rows.join(spans, "digest", "left_anti")
    return left.select(*[F.col("__row")[c].alias(c) for c in docs.columns])
