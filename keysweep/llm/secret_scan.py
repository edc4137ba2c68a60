"""Operator 7: secret scan through a trigram inverted index.

From each rule's regular expression a Boolean trigram query is derived: every
match must contain all trigrams of at least one alternative of every clause.
The index holds postings (trigram, document) for the trigrams that some query
names; postings are intersected per document, and only the candidates that
satisfy a rule's query are verified with its expression. A rule without
mandatory trigrams (runs of hex digits) is verified on every text.

Defined results: a null or empty text has no spans; texts are searched whole;
repeated ids share their postings, which only adds candidates, as each row is
verified on its own text; null ids join null-safely; an empty table gives an
empty table; other columns aren't read, except by :func:`redact`, which passes
them through. Positions are code points, ends exclusive.

All DataFrame functions. The postings shuffle is a few rows per document,
merged into one mask per document by a partial aggregate; the texts meet their
masks in a sort-merge join on the unique id.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysweep.llm.common import whole_text

parser = re._parser  # the parse tree of a regular expression


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts when ``group`` has ``least`` characters or more.

    ``body`` matches what belongs to the secret after the pattern; it is redacted with it.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False
    body: str = ""


# After the header of a private key: all up to its END line (nothing with five hyphens lies between), or else
# header fields, base64 lines however they are indented or quoted, and a short last line. All loops over groups are
# possessive: Java runs these without recursion, so a key may be of any length.
_QUOTING = r"(?:[\s\\\"'`>|*#+]|(?<=\\)[nrt])"   # an escaped line break counts too
_PEM_BODY = (r"(?:[^-]*+(?:-{1,4}+[^-]++)*+-----END [A-Z ]{0,30}PRIVATE KEY-----"
             r"|(?:\s*+[A-Z][A-Za-z-]{3,20}+: [^\n]*+\n)*+"
             r"(?:(?:" + _QUOTING + r"*+,?+" + _QUOTING + r"*+[A-Za-z0-9+/=\\]{16,}+[A-Za-z0-9+/=\\\r\n]*+)++"
             r"(?:" + _QUOTING + r"*+(?:,[ \t]*+\n)?+" + _QUOTING + r"*+[A-Za-z0-9+/=]{1,15}+(?![ \t]*[A-Za-z0-9]))?+)?+)")


# The base rules are fixed values.
RULES: tuple[Rule, ...] = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=12, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=18, base=True),
    Rule("hex", r"[0-9a-f]{16,}", least=16, base=True),
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", body=_PEM_BODY),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)

MARK = "[SECRET]"
_WORD_BITS = 60
_MAX_STRINGS = 64


def _strings(seq) -> set[str] | None:
    """All strings a small sub-expression can match, or None."""
    out = {""}
    for op, arg in seq:
        name = str(op)
        if name == "LITERAL":
            more = {chr(arg)}
        elif name == "IN" and len(arg) <= 8 and all(str(k) == "LITERAL" for k, _ in arg):
            more = {chr(c) for _, c in arg}
        elif name == "BRANCH":
            parts = [_strings(x) for x in arg[1]]
            more = None if None in parts else set().union(*parts)
        elif name == "SUBPATTERN":
            more = _strings(arg[3])
        elif name == "MAX_REPEAT" and arg[1] <= 1:
            more = _strings(arg[2])
            more = more if more is None or arg[0] else more | {""}
        else:
            more = None
        if more is None or len(out) * len(more) > _MAX_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Clauses that must all hold; a clause holds when all trigrams of one alternative occur.

    Trigrams are lower case, to be looked up in lower-cased texts. An empty
    list means that the expression has no mandatory trigram.
    """
    clauses: list[list[frozenset[str]]] = []
    run = {""}

    def close():
        nonlocal run
        if all(len(s) >= 3 for s in run):
            sets = {frozenset(s.lower()[i:i + 3] for i in range(len(s) - 2)) for s in run}
            clauses.append(sorted((s for s in sets if not any(o < s for o in sets)), key=sorted))
        run = {""}

    def walk(seq):
        nonlocal run
        for op, arg in seq:
            more = _strings([(op, arg)])
            if more is not None and len(run) * len(more) <= _MAX_STRINGS:
                run = {a + b for a in run for b in more}
            elif str(op) == "SUBPATTERN":
                walk(arg[3])
            else:
                close()
                if str(op) == "MAX_REPEAT" and arg[0] >= 1:
                    walk(arg[2])
                    close()
        return

    walk(parser.parse(pattern))
    close()
    return clauses


def query_trigrams(rules: tuple[Rule, ...] = RULES) -> list[str]:
    """The trigrams that the rules' queries name, sorted."""
    return sorted({t for r in rules for clause in trigram_query(r.pattern) for alt in clause for t in alt})


def trigram_index(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (trigram, id): each row says that a document's lower-cased text holds the trigram."""
    low = docs.select(F.col(id_col).alias("id"), F.lower(whole_text(text_col)).alias("low"))
    hits = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("id", F.explode(hits).alias("trigram"))


def _bit(position: int) -> Column:
    return F.lit(1 << (position % _WORD_BITS)).cast("long")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, rules): positions of the rules whose trigram query a document satisfies.

    The postings of a document are merged into bit masks; intersecting the
    postings of an alternative is then one comparison of masks.
    """
    trigrams = query_trigrams(rules)
    place = {t: i for i, t in enumerate(trigrams)}
    words = range(len(trigrams) // _WORD_BITS + 1)

    def word(k: int) -> Column:
        bits = F.lit(0).cast("long")
        for t, i in place.items():
            if i // _WORD_BITS == k:
                bits = F.when(F.col("trigram") == t, _bit(i)).otherwise(bits)
        return F.bit_or(bits).alias(f"mask{k}")

    masks = index.groupBy("id").agg(*[word(k) for k in words])

    def holds(alternative: frozenset[str]) -> Column:
        out = F.lit(True)
        for k in words:
            need = sum(1 << (place[t] % _WORD_BITS) for t in alternative if place[t] // _WORD_BITS == k)
            if need:
                need_col = F.lit(need).cast("long")
                out = out & (F.col(f"mask{k}").bitwiseAND(need_col) == need_col)
        return out

    found = []
    for i, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if not query:
            continue
        ok = F.lit(True)
        for clause in query:
            some = F.lit(False)
            for alternative in clause:
                some = some | holds(alternative)
            ok = ok & some
        found.append(F.when(ok, F.lit(i)))
    if not found:
        return masks.select("id", F.array().cast("array<int>").alias("rules"))
    return (masks.select("id", F.array_compact(F.array(*found)).alias("rules"))
            .where(F.size("rules") > 0))


#: Elements of an array that are gone through at a time. What is built up in a pass over an array is copied at each
#: step; in two levels, the work for n elements is n * CHUNK + (n / CHUNK)^2 instead of n^2.
_CHUNK = 256


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _chunks(items: Column) -> Column:
    last = F.greatest(F.ceil(F.size(items) / _CHUNK).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda j: F.slice(items, j * _CHUNK + 1, _CHUNK))


def _scanned(items: Column, start: Column, merge) -> tuple[Column, Column]:
    """(what precedes each element, what all come to): merged in order, from ``start`` on."""
    first = F.struct(start.alias("at"), F.array().cast("array<int>").alias("each"))
    done = F.aggregate(items, first, lambda acc, x: F.struct(
        merge(acc["at"], x).alias("at"), F.concat(acc["each"], F.array(acc["at"])).alias("each")))
    return done["each"], done["at"]


def _starts(steps: Column) -> Column:
    """Where each hit starts, of (gap, hit) lengths in order."""
    def of_chunk(chunk: Column) -> Column:
        before, total = _scanned(chunk, F.lit(0), lambda at, x: at + x["gap"] + x["hit"])
        return F.struct(F.zip_with(before, chunk, lambda at, x: at + x["gap"]).alias("starts"), total.alias("total"))

    def joined(parts: Column) -> Column:
        offsets, _ = _scanned(F.transform(parts, lambda p: p["total"]), F.lit(0), lambda at, x: at + x)
        return F.flatten(F.zip_with(parts, offsets, lambda p, o: F.transform(p["starts"], lambda s: s + o)))

    return _bound(F.transform(_chunks(steps), of_chunk), joined)


def _verified(text: Column, rule: Rule, position: int) -> Column:
    """Spans of a rule in a text: the pieces between matches and the matches, added up."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    measured = matches if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))

    def steps_of(hits: Column) -> Column:
        zipped = F.arrays_zip(F.slice(F.split(text, rule.pattern), 1, F.size(hits)).alias("gap"),
                              hits.alias("hit"), (hits if rule.group == 0 else measured).alias("part"))
        return F.transform(zipped, lambda x: F.struct(
            F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"),
            (F.length(x["part"]) >= rule.least).alias("ok")))

    def spans_of(steps: Column) -> Column:
        return F.zip_with(_starts(steps), steps, lambda s, x: F.struct(
            s.alias("start"), F.lit(position).alias("rule"), (s + x["hit"]).alias("end"), x["ok"].alias("ok")))

    spans = _bound(_bound(matches, steps_of), spans_of)
    found = F.transform(F.filter(spans, lambda x: x["ok"]),
                        lambda x: F.struct(x["start"].alias("start"), x["rule"].alias("rule"), x["end"].alias("end")))
    return F.when(text.rlike(rule.pattern), found)


def _masked(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with a mark for each run of overlapping spans (sorted by start)."""
    def ended(chunk: Column) -> Column:
        return F.coalesce(F.array_max(F.transform(chunk, lambda s: s["end"])), F.lit(0))

    def piece(chunk: Column, begin: Column) -> Column:
        stop = F.greatest(begin, ended(chunk))

        def marked(own: Column) -> Column:   # the chunk's part of the text, so that no step looks for its place in all of it
            def step(acc, s):
                gap = F.substring(own, acc["at"] - begin + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
                return F.when(s["start"] >= acc["at"], F.struct(
                    s["end"].alias("at"), F.concat(acc["out"], gap, F.lit(mark)).alias("out"))
                ).otherwise(F.struct(F.greatest(s["end"], acc["at"]).alias("at"), acc["out"].alias("out")))

            start = F.struct(begin.alias("at"), F.lit("").alias("out"))
            return F.aggregate(chunk, start, step, lambda acc: acc["out"])

        return _bound(F.substring(text, begin + 1, stop - begin), marked)

    def joined(chunks: Column) -> Column:
        before, last = _scanned(F.transform(chunks, ended), F.lit(0), lambda at, x: F.greatest(at, x))
        return F.concat(F.array_join(F.zip_with(chunks, before, piece), ""), F.substring(text, last + 1, F.length(text)))

    return _bound(_chunks(spans), joined)


_SPANS = "array<struct<start:int,rule:int,end:int>>"


def find_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, text, spans): every row of ``docs`` as a struct, its text and its spans.

    ``spans`` is sorted by start, then by the rules' order; ``rule`` is the
    position in ``rules``.
    """
    index = trigram_index(docs, query_trigrams(rules), id_col, text_col)
    hits = candidates(index, rules)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), whole_text(text_col).alias("text"))
    joined = rows.join(hits, F.col("row")[id_col].eqNullSafe(F.col("id")), "left")
    empty = F.array().cast(_SPANS)
    each = []
    for i, rule in enumerate(rules):
        found = _verified(F.col("text"), rule, i)
        if trigram_query(rule.pattern):
            found = F.when(F.array_contains("rules", i), found)
        each.append(F.coalesce(found, empty))
    return joined.select("row", "text", F.array_sort(F.concat(*each)).alias("spans"))


def _joined(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["rule"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: spans per base kind, the digest of the base spans, all spans."""
    found = find_spans(docs, rules, id_col, text_col)
    base = [i for i, r in enumerate(rules) if r.base]
    spans = F.col("spans")

    def count(position: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["rule"] == position)).cast("long").alias(f"n_{rules[position].kind}")

    return found.select(
        F.col("row")[id_col].alias("doc_id"), *map(count, base),
        F.sha2(_joined(F.filter(spans, lambda s: s["rule"].isin(base)), rules), 256).alias("base_sha256"),
        _joined(spans, rules).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = MARK, id_col: str = "doc_id",
           text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; every row and column stays.

    A rule's ``body`` goes with its match: of a private key the whole block, of
    which the report names the header. Overlapping spans get one mark. ``length_col``, where given, is set to the
    new text's code points.
    """
    found = find_spans(docs, tuple(replace(r, pattern=r.pattern + r.body) for r in rules), id_col, text_col)
    masked = _masked(F.col("text"), F.col("spans"), mark)
    new = found.select("row", F.size("spans").alias("n"), F.when(F.size("spans") > 0, masked)
                       .otherwise(F.col("row")[text_col]).alias("clean"))

    def column(name: str) -> Column:
        old = F.col("row")[name]
        if name == text_col:
            return F.col("clean").alias(name)
        if name == length_col:
            return F.when(F.col("n") > 0, F.length("clean")).otherwise(old).cast(docs.schema[name].dataType).alias(name)
        return old.alias(name)

    return new.select(*[column(c) for c in docs.columns])
