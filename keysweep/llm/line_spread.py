"""Operator 10: line deduplication by distinct-site spread.

A line is widespread when it occurs on many sites: per line, HyperLogLog sketches of
its sites are built by the tasks and merged by the aggregation; lines whose estimate is too near
the threshold to be sure get an exact distinct count.

A widespread line may be furniture of the web (a menu, a notice, a footer), or part of
a text that itself was copied to many sites. Furniture stands in texts of their own.
So the spread is taken a second time, over *hosts* alone: texts of which widespread lines
make up at most half (by characters). What is widespread among hosts too is furniture,
and is cut from every document, however little of it is left. The body of a copied text
isn't in hosts and stays for the document-level operators, as removing it would delete
all copies, the first included.

Defined results: a null or empty text has no lines and stays as it is; a null
site counts as a site of its own; blank lines are never widespread; white space
around a line doesn't count; verdicts depend on a row's text alone, so repeated rows
and null or repeated ids don't matter; an empty table gives an empty table; other
columns pass through.

Lines are keyed by 16 bytes and texts by the digest of the whole text. Lines in too few
documents to be widespread are dropped by a plain count, before any sketch. A line that a third of all
documents hold becomes one sketch per task before its shuffle. What is common is
written to the checkpoint folder; joins with it are plain joins, whose hot keys AQE can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysweep.llm.common import staged, whole_text

#: Distinct sites from which a line counts as widespread.
MIN_SITES = 8
#: Sketches of 2^LG_K registers; relative standard error about 1.04 / sqrt(2^LG_K).
LG_K = 10
#: Estimates within this many standard errors of the threshold are counted exactly.
SIGMAS = 4
#: A text is a host when widespread lines are at most this share of its characters.
HOST_SHARE = 0.5

_EDGE = "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+\\z"


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def line_table(docs: DataFrame, text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """(text, site, place, key, chars, total): the lines that at least ``min_sites`` rows hold, written.

    ``text`` is the text's digest, ``place`` the line's number from 0 on, ``key`` the
    digest of the line without the white space around it, ``chars`` its length, ``total``
    that of all lines.
    """
    text = whole_text(text_col)
    rows = docs.select(_digest(text).alias("text"), F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"),
                       F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, _EDGE, "")).alias("lines"))
    rows = rows.withColumn("total", F.aggregate("lines", F.lit(0), lambda n, x: n + F.length(x)))
    each = rows.select("text", "site", "total", F.posexplode("lines").alias("place", "line")).where("line <> ''")
    keyed = staged(each.select("text", "site", "place", _digest(F.col("line")).alias("key"), F.length("line").alias("chars"), "total"),
                   "line-table")
    often = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites).select("key")
    # written, so that the join below is a plain one: a small table is broadcast, and a hot line's rows can be split
    return staged(keyed.join(staged(often, "often-lines"), "key", "left_semi"), "common-lines")


def line_spread(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(key, sites, exact): lines of a :func:`line_table` on at least ``min_sites`` sites.

    ``sites`` is the sketch's estimate, or the exact count where ``exact``.
    """
    spread = staged(lines.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("estimate")),
                    "line-estimates")
    margin = SIGMAS * 1.04 / (2 ** (lg_k / 2)) * min_sites
    sure = spread.where(F.col("estimate") > min_sites + margin).select(
        "key", F.col("estimate").alias("sites"), F.lit(False).alias("exact"))
    near = spread.where(F.col("estimate").between(min_sites - margin, min_sites + margin)).select("key")
    counted = (lines.join(near, "key", "left_semi").select("key", "site").distinct()
               .groupBy("key").agg(F.count(F.lit(1)).alias("sites"))
               .where(F.col("sites") >= min_sites)
               .select("key", "sites", F.lit(True).alias("exact")))
    return staged(sure.unionByName(counted), "line-spread")


def line_marks(lines: DataFrame, min_sites: int = MIN_SITES, host_share: float = HOST_SHARE) -> DataFrame:
    """(text, wide, furniture): of each text with widespread lines, the places of these and of those that are furniture."""
    wide = staged(lines.join(line_spread(lines, min_sites).select("key"), "key", "left_semi"), "widespread-lines")
    # copies of a text are one: each of its lines once
    shares = (wide.groupBy("text", "place").agg(F.first("chars").alias("chars"), F.first("total").alias("total"))
              .groupBy("text").agg(F.sum("chars").alias("chars"), F.first("total").alias("total")))
    hosts = shares.where(F.col("chars") <= F.lit(host_share) * F.col("total")).select("text")
    furniture = line_spread(wide.join(staged(hosts, "host-texts"), "text", "left_semi"), min_sites).select("key", F.lit(True).alias("__furniture"))
    flagged = wide.join(furniture, "key", "left").groupBy("text", "place").agg(F.first("__furniture").alias("__furniture"))
    return staged(flagged.groupBy("text").agg(
        F.collect_list("place").alias("wide"), F.collect_list(F.when(F.col("__furniture"), F.col("place"))).alias("furniture")),
        "line-marks")


def _marked(docs: DataFrame, marks: DataFrame, text_col: str) -> DataFrame:
    """(__row, __lines, __wide, __cut): the rows with their lines, and the places of marked ones."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                       _digest(whole_text(text_col)).alias("__digest"))
    named = marks.select(F.col("text").alias("__digest"), F.col("wide").alias("__wide"), F.col("furniture").alias("__cut"))
    none = F.array().cast("array<int>")
    joined = rows.join(named, "__digest", "left")
    text = F.coalesce(F.col("__row")[text_col].cast("string"), F.lit(""))
    return joined.select("__row", F.split(text, "\n").alias("__lines"), F.coalesce("__wide", none).alias("__wide"),
                         F.coalesce("__cut", none).alias("__cut"))


def _left(lines: Column, cut: Column) -> Column:
    """The text of the lines that aren't cut; linear in the lines."""
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), cut)
    return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")


def remove_furniture(docs: DataFrame, marks: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` without their furniture lines; every row and column stays.

    ``marks`` are those of ``docs``. ``length_col``, where given, is set to the new
    text's code points.
    """
    marked = _marked(docs, marks, text_col)
    cut = F.size("__cut") > 0
    new = marked.select("__row", cut.alias("__changed"), F.when(cut, _left(F.col("__lines"), F.col("__cut")))
                        .otherwise(F.col("__row")[text_col]).alias("__text"))

    def column(name: str) -> Column:
        old = F.col("__row")[name]
        if name == text_col:
            return F.col("__text").alias(name)
        if name == length_col:
            return F.when(F.col("__changed"), F.length("__text")).otherwise(old).cast(docs.schema[name].dataType).alias(name)
        return old.alias(name)

    return new.select(*[column(c) for c in docs.columns])


def line_report(docs: DataFrame, marks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its lines, the widespread ones, those cut, and the digest of the text left."""
    marked = _marked(docs, marks, text_col)
    return marked.select(
        F.col("__row")[id_col].alias("doc_id"),
        F.size("__lines").cast("long").alias("n_lines"),
        F.size("__wide").cast("long").alias("n_wide_lines"),
        F.size("__cut").cast("long").alias("n_cut_lines"),
        F.sha2(F.when(F.size("__cut") > 0, _left(F.col("__lines"), F.col("__cut"))).otherwise(F.array_join("__lines", "\n")),
               256).alias("text_sha256"))
