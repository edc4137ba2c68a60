"""Operator 3: quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one long whose bits are the failed rules; policies are bit masks applied
to it later, and ablations are counts over the masks, so neither reads a text
again.

Defined results: a null or empty text has no words and fails ``few_words``; a
null ``doc_id`` and repeated rows are measured like any other row; an empty
table gives an empty ledger; columns other than the id and the text are not
read, whatever their names. All of it is DataFrame functions: one projection,
no shuffle. A very long text is one row of the projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysweep.llm.common import WORD_CHAR, pinned, whole_text, word_array

SYMBOLS = r"[#*$%&|<>]"
UPPER = r"\p{Lu}"

#: Rule name -> condition of failure over the measurements. The position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "upper_case": "2 * n_upper > word_chars",
    "long_words": "word_chars > 25 * n_words",
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules that reject a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = list(RULES)
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
V1 = Policy("v1", (*BASE.rules, "symbols", "repeated_lines"))
V2 = Policy("v2", (*V1.rules, "upper_case", "long_words"))


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows (hashes in text order) that occur twice or more.

    Equal windows are neighbours once sorted; each found start covers three
    words. Most texts repeat none, which the distinct count tells first.
    """
    tagged = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(ordered: Column) -> Column:
        def start(x, k):
            before = F.get(ordered, k - 1)["h"]
            after = F.get(ordered, k + 1)["h"]
            return F.when((x["h"] == before) | (x["h"] == after), x["i"])

        return F.array_compact(F.transform(ordered, start))

    # A one-element array binds the sorted windows to a name, so they are sorted once.
    found = F.flatten(F.transform(F.array(tagged), starts))
    covered = F.array_distinct(F.flatten(F.transform(found, lambda i: F.array(i, i + 1, i + 2))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(F.size(covered))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the measurements, ``fail_bits`` (long).

    Windows are compared by a 64-bit hash of their three words within one text.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    split = base.select(
        "doc_id", "text", word_array(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD_CHAR)).alias("lines"))
    words, lines = F.col("words"), F.col("lines")
    n = F.size(words)
    windows = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        1, F.greatest(n - 2, F.lit(0)))
    hashed = split.select("doc_id", "text", "lines", n.alias("n_words"),
                          F.length(F.array_join(words, "")).alias("word_chars"), windows.alias("windows"))
    measured = hashed.select(
        "doc_id",
        F.col("n_words").cast("long"),
        F.col("word_chars").cast("long"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("windows")).cast("long").alias("n_repeat_words"),
        F.regexp_count("text", F.lit(UPPER)).cast("long").alias("n_upper"))
    bits = F.lit(0).cast("long")
    for k, failed in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(failed), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_bits", pinned(bits))


def rejected(policy: Policy, bits: str = "fail_bits") -> Column:
    """True where the policy's mask meets a failure bit."""
    return F.col(bits).bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply_policy(entries: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept`` and the policy's version; no text is read."""
    return entries.withColumns({"kept": ~rejected(policy), "policy": F.lit(policy.version)})


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of a policy: documents failing it, and those it alone rejects.

    Entries are first counted by their masked bits (at most 2^rules rows,
    pre-aggregated before the shuffle), then the counts are split by bit.
    """
    masked = entries.select(F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits"))
    counted = masked.groupBy("bits").agg(F.count(F.lit(1)).alias("n"))
    names = list(RULES)
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit"))
                                for r in policy.rules]))
    rows = counted.select("bits", "n", rules.alias("r")).select("bits", "n", "r.rule", "r.bit")
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return rows.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(fails, F.col("n"))), F.lit(0)).alias("failing"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))), F.lit(0)).alias("only_this"))


def keep_documents(docs: DataFrame, policy: Policy = V2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents a policy rejects; all columns unchanged.

    The verdict depends on the text alone, so it is computed beside the row
    (no join): the ledger of a one-column view is the same projection.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    judged = ledger(row.select("__row", F.col(f"__row.`{text_col}`").alias("__text")), "__row", "__text")
    return judged.where(~rejected(policy)).select("doc_id.*")
