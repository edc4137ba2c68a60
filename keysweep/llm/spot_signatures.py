"""Operator 4: document fingerprints from spot signatures (SpotSigs).

A spot signature is a chain: a common word (the anchor) and the two content
words that follow it. Natural prose places anchors through its sentences,
menus and lists hardly do. A fingerprint is the sorted set of a text's
signature hashes in hex; two fingerprints are compared by the Jaccard index of
their sets. Matching partitions the fingerprints by set length and prunes:
sets whose lengths differ too much never meet, and of the others only those
that share a signature among their first ones.

Words are lower-cased runs of letters, marks and digits. A text without a
whole chain falls back to chains of three words, and one with fewer words to
the sequence of its words, so that any text with a word has a fingerprint; a
text without words has the empty one.

Defined results: a null text is read as empty; equal texts have equal
fingerprints; two empty sets are alike (1.0), an empty and a filled one are not
(0.0); ids may repeat or be null (nulls first, ties by text); an empty table
gives an empty table; other columns aren't read. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.llm.common import pinned, whole_text

#: Anchors: fixed values, function words of the languages of the corpus.
ANCHORS: dict[str, str] = {
    "en": "a an and are as at be by for from has he in is it of on or that the this to was were will with not but they you we",
    "de": "der die das und ist im in ein eine einer den dem des von zu mit für auf nicht sich als auch an es bei nach",
    "fr": "le la les un une et est du de des que qui dans pour par sur au aux ce ne pas se en il elle",
    "es": "el la los las un una y es de del que en por con para su se no al lo como más o",
}
CHAIN = 2
#: Rows per range of ids that one window holds, as an order of magnitude.
ROWS_PER_RANGE = 4096
MAX_RANGES = 4096


def anchor_words() -> list[str]:
    return sorted({w for words in ANCHORS.values() for w in words.split()})


def _spot_hashes(words: Column) -> Column:
    """Sorted distinct hashes of the signatures of a word array.

    ``k`` anchors stand before the k-th anchor, so of its position ``i`` in the
    text ``i - k`` words before it are content: that is where its chain starts
    in the array of content words.
    """
    common = anchor_words()
    content = F.filter(words, lambda w: ~w.isin(common))
    spots = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda s: s["w"].isin(common))

    # One-element arrays bind the two arrays to names, so each is built once.
    def with_content(rest: Column) -> Column:
        def chain(s, k):
            first = F.get(rest, s["i"] - k)
            second = F.get(rest, s["i"] - k + 1)
            return F.when(second.isNotNull(), F.xxhash64(s["w"], first, second))

        return F.array_compact(F.transform(spots, chain))

    chains = F.flatten(F.transform(F.array(content), with_content))
    runs = F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
                   1, F.greatest(F.size(words) - 2, F.lit(0)))
    whole = F.when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " "))))\
        .otherwise(F.array().cast("array<bigint>"))
    plain = F.when(F.size(words) > 2, runs).otherwise(whole)

    def filled(found: Column) -> Column:
        return F.sort_array(F.array_distinct(F.when(F.size(found) > 0, found).otherwise(plain)))

    return F.flatten(F.transform(F.array(chains), filled))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), "")


def spot_sets(rows: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """``rows`` with the sorted signature hashes of a text column."""
    words = f"__words_{out_col}"
    # ``pinned`` keeps the split in its own projection: the lambdas index the array.
    split = rows.withColumn(words, pinned(_words(F.col(text_col))))
    return split.withColumn(out_col, pinned(_spot_hashes(F.col(words)))).drop(words)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two sorted sets, 1.0 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def as_text(hashes: Column) -> Column:
    """The fingerprint as a string: signatures in hex, in order."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 16, "0")), ".")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spots, fingerprint): one row per document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    return spot_sets(rows, "text", "spots").select("doc_id", "spots", as_text(F.col("spots")).alias("fingerprint"))


def _as_number(ids: Column, kind: T.DataType) -> Column:
    """Ids as doubles in their order; of ids that aren't numbers, the first six bytes (equal ones share a range)."""
    if isinstance(kind, T.NumericType):
        return ids.cast("double")
    head = F.hex(F.substring(ids.cast("string").cast("binary"), 1, 6))
    return F.conv(F.rpad(head, 12, "0"), 16, 10).cast("double")


def with_next(rows: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` (doc_id, text, spots) with the next row's text and spots, in order of the id.

    Ids are cut into ranges at quantiles, a number bounded by a parameter, so
    that a window holds a few thousand rows and not the table; the last row of
    a range takes the first row of the next filled one, and the last of all the
    first of all. Equal ids fall into one range: an id that thousands of rows
    repeat is one group by its meaning (they follow each other).
    """
    ranges = min(MAX_RANGES, max(1, n_rows // ROWS_PER_RANGE))
    number = _as_number(F.col("doc_id"), rows.schema["doc_id"].dataType)
    ids = rows.select(number.alias("d"))
    cuts = ids.where("d is not null").approxQuantile(
        "d", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if ranges > 1 else []
    bounds = sorted(set(cuts))
    place = F.lit(0)
    if bounds:
        literal = F.array(*[F.lit(b) for b in bounds])
        place = F.coalesce(F.size(F.filter(literal, lambda b: b <= number)), F.lit(0))
    placed = rows.withColumn("__range", place)
    window = Window.partitionBy("__range").orderBy(F.col("doc_id").asc_nulls_first(), F.col("text"))
    step = placed.withColumn("__next", F.lead(F.struct("text", "spots")).over(window))
    # First rows of the ranges, as many as ranges: their ids, then the texts of those ids.
    firsts = placed.groupBy("__range").agg(
        F.when(F.max(F.col("doc_id").isNull()), None).otherwise(F.min("doc_id")).alias("first_id"))
    texts = (rows.select("doc_id", "text").join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("first_id")))
             .groupBy("__range").agg(F.min("text").alias("text")))
    heads = spot_sets(texts, "text", "spots").select("__range", F.struct("text", "spots").alias("__first"))
    cycle = Window.partitionBy(F.lit(0)).orderBy("__range")
    every = cycle.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = heads.select("__range", F.coalesce(
        F.lead("__first").over(cycle), F.first("__first").over(every)).alias("__head"))
    return (step.join(following, "__range").withColumn("__next", F.coalesce("__next", "__head"))
            .drop("__range", "__head"))


def edited_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text's last quarter (floor of a quarter of the code points) is
    replaced by the first as many code points of the next document.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = with_next(spot_sets(base, "text", "spots"), docs.count())
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter),
                      F.substring(F.col("__next")["text"], F.lit(1), quarter))
    cut = rows.select("doc_id", n.cast("long").alias("n_chars"), "spots", F.col("__next")["spots"].alias("next_spots"),
                      pinned(edited).alias("edited"))
    both = spot_sets(cut, "edited", "edited_spots")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("spots")).alias("fingerprint"), as_text(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"))


def similar_fingerprints(prints: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(classes, links): fingerprint classes and the pairs of classes at or above a Jaccard threshold.

    ``classes`` has (doc_id, rep): the smallest id with the same fingerprint.
    ``links`` has (a, b, likeness) between representatives, each pair once.
    Sets are partitioned by length: lengths grow by the factor 1/threshold from
    one partition to the next, so a pair lies in the same or in neighbouring
    partitions. Within one, sets meet only through a signature among the first
    ``n - ceil(threshold * n) + 1`` of both (in the order of the hashes), and a
    pair counts only at its smallest common signature, so no pair is made twice.
    """
    grouped = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("rep"))
    classes = prints.select("doc_id", "fingerprint").join(grouped, "fingerprint").select("doc_id", "rep")
    sets = (prints.join(grouped.withColumnRenamed("fingerprint", "f"),
                        (F.col("fingerprint") == F.col("f")) & (F.col("doc_id") == F.col("rep")), "left_semi")
            .dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("id"), "spots", F.size("spots").alias("n"))
            .where("n > 0"))
    part = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / threshold))).cast("int")
    head = F.slice("spots", 1, F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9).cast("int") + 1)
    keyed = sets.select("id", "spots", "n", part.alias("part"), F.explode(head).alias("spot"))
    own = keyed.select("part", "spot", F.struct("id", "n", "spots").alias("a"))
    other = keyed.select(F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"), "spot",
                         F.col("part").alias("home"), F.struct("id", "n", "spots").alias("b"))
    a, b = F.col("a"), F.col("b")
    pairs = own.join(other, ["part", "spot"]).where(
        ((F.col("home") > F.col("part")) | (a["id"] < b["id"]))
        & (a["n"] >= F.lit(threshold) * b["n"] - 1e-9) & (b["n"] >= F.lit(threshold) * a["n"] - 1e-9))
    common = pairs.select("spot", a["id"].alias("x"), b["id"].alias("y"), (a["n"] + b["n"]).alias("total"),
                          F.array_intersect(a["spots"], b["spots"]).alias("common"))
    scored = common.where(F.col("spot") == F.array_min("common")).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
        (F.size("common") / (F.col("total") - F.size("common"))).alias("likeness"))
    return classes, scored.where(F.col("likeness") >= threshold - 1e-12)
