"""Operator 6: licences by TF-IDF cosine to templates, inherited down directories.

A file's lines and paragraphs (its possible headers) and its whole text (it may
be a licence file) are compared with notice templates, the whole text also with
whole licences: sparse TF-IDF vectors, cosine. Weights come from the document frequencies of the templates' words,
counted over all files; a word that no template holds weighs as much as the
rarest word, which needs no vocabulary of the corpus. A part whose words are
mostly foreign can't reach the threshold, which two sums tell before a vector
is made.

A licence file licenses its directory. A file without a notice of its own
(nor "All rights reserved") inherits from the nearest directory above it that has a licence: distinct
directories are joined with the licences of their ancestors, and files with
their directory. A directory may hold a third of all files, and a top directory
lies above all others: both joins deal the rows of a key to several tasks, in
number by the table's rows, and look up a copy of the key's one row in each.

Defined results: a null or empty text has no notice and may inherit; a null
path counts as ``""`` (no directory but the root); of two licence files in one
directory the better match counts, then the name; repeated rows are judged
each; an empty table gives an empty table; other columns aren't read. Only the
template words' counts reach the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache
from importlib.resources import files as files_of
from math import log, sqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: No licence at all: it keeps a file from inheriting one, but any licence in the same file goes before it.
RESERVED = "All-Rights-Reserved"
#: Short notices as authors write them, by SPDX name.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version.",
    ),
    "LGPL-3.0": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.",),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    RESERVED: ("All rights reserved.",),
}
#: Least cosine of a line or paragraph, and of a whole text that is a licence file.
HEADER = 0.7
FILE = 0.6
#: Least cosine of a whole text to a whole licence; long texts are alike by their common words already.
TEXT = 0.85
#: Rows of one directory that meet its licence in one task, about, if it holds all of them.
DEALT = 4096

_WORD = re.compile(r"\w+")


@cache
def licence_texts() -> dict[str, tuple[str, ...]]:
    """Whole licences by SPDX name, the files in ``licences``; read by the driver."""
    folder = files_of("keysweep.llm") / "licences"
    return {f.name.removesuffix(".txt"): (f.read_text("utf-8"),) for f in sorted(folder.iterdir(), key=lambda f: f.name)}


def terms(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _vocabulary(templates: dict[str, tuple[str, ...]]) -> frozenset[str]:
    return frozenset(t for texts in templates.values() for x in texts for t in terms(x))


def term_counts(texts: DataFrame, vocabulary: frozenset[str]) -> DataFrame:
    """(term, df): texts that hold each template word; one row per word and task before the sum.

    The row of the empty term counts all texts.
    """
    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen[""] += 1
                seen.update(vocabulary.intersection(terms(text.as_py() or "")))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                         names=["term", "df"])

    return texts.mapInArrow(run, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Matcher:
    """Best template of a part of a text."""

    def __init__(self, templates: dict[str, tuple[str, ...]], counts: dict[str, int]):
        n = counts.get("", 0)
        self.foreign = log(n + 1) + 1
        self.weight = {t: log((n + 1) / (counts.get(t, 0) + 1)) + 1 for t in _vocabulary(templates)}
        self.templates = []
        for name, texts in templates.items():
            for text in texts:
                vector = {t: k * self.weight[t] for t, k in Counter(terms(text)).items()}
                norm = sqrt(sum(v * v for v in vector.values()))
                self.templates.append((name, {t: v / norm for t, v in vector.items()}))

    def best(self, words: list[str], least: float) -> tuple[float, str] | None:
        """(cosine, licence) of the best template, if it reaches ``least``; ties by name."""
        weight = self.weight
        known = [w for w in words if w in weight]
        if not known:
            return None
        counts = Counter(known)
        inside = sum((k * weight[w]) ** 2 for w, k in counts.items())
        # each foreign word counts at least once: the cosine is at most this share
        if inside < least * least * (inside + (len(words) - len(known)) * self.foreign ** 2):
            return None
        foreign = Counter(w for w in words if w not in weight)
        norm = sqrt(inside + sum((k * self.foreign) ** 2 for k in foreign.values()))
        score, name = max((min(1.0, sum(k * weight[w] * vector.get(w, 0.0) for w, k in counts.items()) / norm), name)
                          for name, vector in self.templates)
        return (score, name) if score >= least else None

    def judge(self, text: str, header: float, file: float, licences: Matcher | None = None) -> tuple[tuple[float, str] | None, tuple[float, str] | None]:
        """Best header (a line or a paragraph) and the whole text as a licence file.

        The whole text is compared with the templates and with whole ``licences``.
        """
        best, paragraph, whole = None, [], []

        def consider(words):
            nonlocal best
            found = self.best(words, header)
            if found and (best is None or (found[1] != RESERVED, found) > (best[1] != RESERVED, best)):
                best = found

        held = 0
        for line in [*text.split("\n"), ""]:
            words = terms(line)
            if words:
                consider(words)
                paragraph += words
                held += 1
            else:
                if held > 1:
                    consider(paragraph)
                whole += paragraph
                paragraph, held = [], 0
        found = [x for x in (self.best(whole, file), licences and licences.best(whole, TEXT)) if x]
        return best, max(found, default=None)


def own_licences(files: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, header: float = HEADER,
                 file: float = FILE, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path") -> DataFrame:
    """(doc_id, path, header, header_score, file, file_score): what a file itself says."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = files.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"),
                        F.col(text_col).cast("string").alias("text"))
    texts = licence_texts()
    vocabulary = _vocabulary(templates) | _vocabulary(texts)
    counts = {r["term"]: r["df"] for r in term_counts(rows.select("text"), vocabulary).collect()}
    kind = rows.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)

    def run(batches):
        matcher, licences = Matcher(templates, counts), Matcher(texts, counts)
        for batch in batches:
            found = [matcher.judge(t.as_py() or "", header, file, licences) for t in batch.column(2)]
            columns = [[x and x[i] for x in side] for side in ([f[0] for f in found], [f[1] for f in found]) for i in (1, 0)]
            types = (pa.string(), pa.float64()) * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_type), batch.column(1), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["doc_id", "path", "header", "header_score", "file", "file_score"])

    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, path string, header string, header_score double, "
                                "file string, file_score double")


def looked_up(rows: DataFrame, key: str, table: DataFrame, salts: int, place: str) -> DataFrame:
    """``rows`` left-joined with ``table`` (one row per ``key``); a key's rows are dealt by ``place`` to ``salts`` groups.

    The table's row is copied only to the groups that hold a row of its key.
    """
    dealt = rows.withColumn("__salt", F.pmod(F.xxhash64(place), F.lit(salts)))
    copies = dealt.select(key, "__salt").distinct().join(table, key)
    return dealt.join(copies, [key, "__salt"], "left").drop("__salt")


def licence_report(files: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, header: float = HEADER,
                   file: float = FILE, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path") -> DataFrame:
    """(doc_id, path, licence, score, via, from_dir) for every file; ``via`` is header, file, directory or null."""
    from keysweep.llm.common import staged

    folder = F.regexp_replace("path", "/?[^/]*$", "")
    own = staged(own_licences(files, templates, header, file, id_col, text_col, path_col)
                 .withColumns({"dir": folder, "place": F.monotonically_increasing_id()}), "licences")
    salts = 1 + own.count() // DEALT
    # One licence a directory: a partial aggregate, however many files lie in it.
    by_dir = own.where("file is not null").groupBy("dir").agg(F.max(F.struct("file_score", "file")).alias("best"))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(
        k.alias("level"), F.array_join(F.slice(parts, 1, k), "/").alias("up")))
    ancestors = own.select("dir").distinct().select("dir", F.explode(above).alias("a")).select("dir", "a.level", "a.up")
    licensed = by_dir.select(F.col("dir").alias("up"), "best")
    nearest = (looked_up(ancestors, "up", licensed, salts, "dir").where("best is not null")
               .groupBy("dir").agg(F.max_by(F.struct("up", "best"), "level").alias("near")))
    joined = looked_up(own, "dir", nearest, salts, "place")
    best = F.greatest(F.struct(F.col("file_score").alias("score"), F.col("file").alias("name"), F.lit("file").alias("via")),
                      F.struct(F.col("header_score").alias("score"), F.col("header").alias("name"), F.lit("header").alias("via")))
    own_best = F.when(F.col("header").isNull() & F.col("file").isNull(), None)\
        .when(F.col("file").isNull(), F.struct(F.col("header_score").alias("score"), F.col("header").alias("name"), F.lit("header").alias("via")))\
        .when(F.col("header").isNull() | ((F.col("header") == RESERVED) & (F.col("file") != RESERVED)), F.struct(F.col("file_score").alias("score"), F.col("file").alias("name"), F.lit("file").alias("via")))\
        .otherwise(best)
    picked = joined.select("doc_id", "path", own_best.alias("own"), "near")
    inherited = F.col("own").isNull()
    return picked.select(
        "doc_id", "path", F.when(inherited, F.col("near.best.file")).otherwise(F.col("own.name")).alias("licence"),
        F.when(inherited, F.col("near.best.file_score")).otherwise(F.col("own.score")).alias("score"),
        F.when(~inherited, F.col("own.via")).when(F.col("near").isNotNull(), "directory").alias("via"),
        F.when(inherited, F.col("near.up")).alias("from_dir"))
