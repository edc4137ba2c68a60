"""Operator 12: fill-in-the-middle transformation by repeated-capture matching.

One full match of ``(unit)*`` by the regex library keeps every repetition of its
group: ``match.ends(1)`` is the list of ends of all units, so its length is their
number and its entries are the offsets of both cuts. Nothing is counted or walked
through in Python. A unit is any expression that matches some text greedily (a code
point by default; words or lines by parameter).

Two cuts, the form and whether a text is changed at all come from the SHA-256 of
``seed:id``, so a result depends on a row alone and not on its place or partition.
Texts are rebuilt from output and form by :func:`restored`; no cut can make a mark
appear anywhere else, as marks begin with a character that stands nowhere else in them.

Defined results: a null or empty text is plain, with no units; so is a text that
holds a mark, or that units don't cover whole (0 units); a null id is hashed as the
empty text; repeated rows give equal rows; an empty table gives an empty table;
other columns aren't read. Memory: a slice of texts, and 100 to 200 bytes for each
unit of one text; the units of a text of more than ``LONG`` characters are matched in
blocks of ``LONG`` repetitions from the last end on, which are the same units.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = r"[\x00-\U0010FFFF]"
SEED = 1
#: Of 100 texts so many are changed, and of 100 changed ones so many have their suffix first.
CHANGED, SUFFIX_FIRST = 90, 20
#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
LONG = 250_000
SLICE_BYTES = 4_000_000


class Units:
    """Ends of the units of a text."""

    def __init__(self, unit: str = UNIT):
        if regex.fullmatch(unit, ""):
            raise ValueError(f"a unit must not match the empty text: {unit!r}")
        self.whole = regex.compile(f"({unit})*")
        self.block = regex.compile(f"({unit}){{1,{LONG}}}")

    def ends(self, text: str):
        """End of each unit in order, or None when units don't cover the text."""
        if len(text) <= LONG:
            match = self.whole.fullmatch(text)
            return None if match is None else match.ends(1)
        out, at = array("q"), 0
        while at < len(text):
            match = self.block.match(text, at)
            if match is None:
                return None
            out.extend(match.ends(1))
            at = match.end()
        return out


def draws(seed: int, row_id: str | None) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits for a row."""
    digest = hashlib.sha256(f"{seed}:{row_id or ''}".encode()).digest()
    return tuple(int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12))


def transformed(text: str, numbers: tuple[int, int, int, int], units: Units, changed: int = CHANGED,
                suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = MARKS) -> tuple:
    """(n, form, prefix characters, middle characters, output) of a text."""
    ends = units.ends(text)
    n = 0 if ends is None else len(ends)
    h1, h2, h3, h4 = numbers
    if not n or h3 % 100 >= changed or any(m in text for m in marks):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a = ends[first - 1] if first else 0
    b = ends[second - 1] if second else 0
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = marks
    if h4 % 100 < suffix_first:
        return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def _check_marks(marks: tuple[str, str, str]) -> None:
    for m in marks:
        if not m or m[0] in m[1:] or any(m[0] in o[1:] or m in o for o in marks if o != m) or len(set(marks)) < 3:
            raise ValueError(f"marks must differ and hold their first characters nowhere else: {marks}")


def fill_middle(docs: DataFrame, unit: str = UNIT, seed: int = SEED, changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST,
                marks: tuple[str, str, str] = MARKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): one row per document."""
    _check_marks(marks)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(id_col).cast("string").alias("name"),
                       F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string"
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        first, size, texts = 0, 0, batch.column(2)
        for i in range(batch.num_rows):
            more = len(texts[i].as_buffer() or b"") if texts[i].is_valid else 0
            if i > first and size + more > SLICE_BYTES:
                yield batch.slice(first, i - first)
                first, size = i, 0
            size += more
        if batch.num_rows:
            yield batch.slice(first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(unit)
        for batch in batches:
            for part in slices(batch):
                made = [transformed(t or "", draws(seed, name), units, changed, suffix_first, marks)
                        for name, t in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                columns = [pa.array(list(c), t) for c, t in zip(zip(*made), types)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns],
                                                 names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(run, schema)


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in text)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text from which an output of that form was made."""
    parts = F.split(output, "|".join(map(_literal, marks)), 4)
    prefix, suffix = F.when(form == "spm", F.get(parts, 2)).otherwise(F.get(parts, 1)), F.when(
        form == "spm", F.get(parts, 1)).otherwise(F.get(parts, 2))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(parts, 3), suffix))
