"""Operator 5: packing into fixed windows by the sum-of-squares rule.

Documents are tokenized and packed into windows of ``window`` tokens, online,
partition by partition. A document is placed into the fill level that leaves
the smallest sum of squared counts of partially filled windows: putting ``s``
tokens on a window of level ``h`` takes one window from level ``h`` and adds
one at ``h + s`` (or completes it). The counts are one array over the levels;
an empty window is level 0. Documents longer than a window fill whole windows
first, and their rest is placed.

At the end of a partition some windows are still open. They stay as they are, from the
fullest on, and their gaps are filled with pieces of the emptiest, cut to measure; those
are taken apart for it, one after the other, until no gap is left. The last tokens, less than a window, are
cut into windows whose lengths are powers of two, which aren't padded. So nothing is padded at
all, and no more is taken out of its place than the gaps hold. ``placed`` tells
the pieces that lie where the rule put them.

The rows are placed where they were read: no shuffle, one pass, memory for the
open windows and for one slice of texts (a longer text is a slice of its own).
Window numbers hold the partition's number in their upper bits, so a task that
runs again gives the same rows.

Defined results: a null or empty text is the end token alone; repeated rows and
null ids are documents like others; an empty table gives an empty table; other
columns aren't read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 2048
END_TOKEN = 1
SLICE_BYTES = 2_000_000
#: Words whose tokens a task keeps from one slice to the next.
CACHE_WORDS = 400_000
#: Texts of 1000 words that the tokenizer holds at a time.
LEARN_TEXTS = 8

#: Marks that end a word after a letter or digit: ASCII without the apostrophe, which some tokens start with.
_MARK = rb"[!-&(-/:-@\[-`{-~]"
_LATIN = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
_END_MARKS = re.compile(_MARK + rb"(?:(?<=[a-z0-9].)|(?<=" + _LATIN + rb".))" + _MARK + rb"*(?=[ \t-\r]|$)")
#: Letters of ASCII and Latin-1 alone: one word of the tokenizer, whose last token has the suffix of word ends.
_LETTERS = re.compile(rb"(?:[a-z]|" + _LATIN + rb")+")

COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class WordTokens:
    """Token ids of texts, tokenizing each different word only once as long as it is known.

    The tokenizer lower-cases, drops white space and parts letters and digits
    from other characters, so the ids of a text are those of its words one
    after another, where A-Z may be lower-cased first and marks that end a word
    after an ASCII digit or a letter of ASCII or Latin-1 count as a word of their own. Texts that
    hold the start of a special token are left as they are.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        specials = self.tokenizer.get_added_tokens_decoder()
        self.separator, token = max(specials.items())
        self.token = token.content
        self.special_starts = {t.content[:2].encode() for t in specials.values()}
        self.known: dict[bytes, bytes] = {}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _special(self, text: bytes) -> bool:
        return any(s in text for s in self.special_starts)

    def _learn(self, words: list[bytes]) -> None:
        """Words of letters alone are joined by spaces, their ids parted after word ends; others by a special token."""
        if self.ends_word.any():
            self._learn_joined([w for w in words if _LETTERS.fullmatch(w)], b" ", lambda ids: self.ends_word[ids], 1)
        others, token = [w for w in words if w not in self.known], self.token.encode()
        self._learn_joined([w for w in others if token not in w], b" " + token + b" ", lambda ids: ids == self.separator, 0)
        for word in others:
            if word not in self.known:   # it holds the special token itself
                ids = self.tokenizer.encode(word.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids
                self.known[word] = np.array(ids, np.uint32).tobytes()

    def _learn_joined(self, words: list[bytes], glue: bytes, at_end, keep: int) -> None:
        """Learn words from joined texts; of a text whose ids have other than one end for each word, learn none.

        ``keep`` is 1 where the id at an end belongs to the word, and 0 where it parts two words.
        """
        groups = [words[i:i + 1000] for i in range(0, len(words), 1000)]
        for k in range(0, len(groups), LEARN_TEXTS):
            some = [glue.join(g).decode("utf-8", "surrogatepass") for g in groups[k:k + LEARN_TEXTS]]
            for group, encoded in zip(groups[k:], self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                ids = np.array(encoded.ids, np.uint32)
                ends = np.flatnonzero(at_end(ids))
                if not keep:
                    ends = np.r_[ends, len(ids)]
                elif len(ends) and ends[-1] != len(ids) - 1:
                    continue
                if len(ends) != len(group):
                    continue
                raw = ids.tobytes()
                starts, stops = (np.r_[0, ends[:-1] + 1] * 4).tolist(), ((ends + keep) * 4).tolist()
                self.known.update(zip(group, [raw[a:b] for a, b in zip(starts, stops)]))

    def words(self, text: bytes) -> list[bytes]:
        if self._special(text):
            return text.split()
        return _END_MARKS.sub(rb" \g<0>", text.lower()).split()

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        lists = [self.words(t) for t in texts]
        different = set().union(*lists)
        new = [w for w in different if w not in self.known]
        if len(self.known) + len(new) > CACHE_WORDS:
            newest = dict(islice(self.known.items(), len(self.known) // 2, None))
            self.known = newest | {w: self.known[w] for w in different if w in self.known}
        self._learn(new)
        ids_of = {w: self.known[w] for w in different}.__getitem__   # small, unlike all that is known: it stays near
        for words in lists:
            yield np.frombuffer(b"".join(map(ids_of, words)), np.uint32)


_ENCODERS: dict[str, WordTokens] = {}


def encoder_for(path: str) -> WordTokens:
    """The process's encoder: a worker that runs several tasks keeps the words it knows."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordTokens(path)
    return _ENCODERS[path]


class SumOfSquares:
    """Open windows by level; ``add`` returns the pieces of windows that are now full."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)   # the level array; level `window` stays 0
        self.open: list[list[list]] = [[] for _ in range(window)]

    def level_for(self, size: int) -> int:
        """The level whose choice changes the sum of squared counts least; the fullest on a tie."""
        levels = self.window - size
        here, there = self.count[:levels + 1], self.count[size:size + levels + 1]
        change = np.where(here > 0, 2 * (there - here) + 2, np.iinfo(np.int64).max)
        if here[levels] > 0:
            change[levels] = 1 - 2 * here[levels]
        change[0] = 2 * self.count[size] + 1
        return int(levels - np.argmin(change[::-1]))

    def add(self, piece) -> list | None:
        size = piece[2]
        level = self.level_for(size)
        if level:
            pieces = self.open[level].pop()
            self.count[level] -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            return pieces
        self.open[level + size].append(pieces)
        self.count[level + size] += 1
        return None

    def rest(self) -> list[list]:
        """The windows still open, the fullest first."""
        return [pieces for level in reversed(self.open) for pieces in level]


def filled(windows: list[list], window: int) -> Iterator[tuple[list, int]]:
    """(pieces, number of them that lie where they were): full windows made of open ones, then powers of two.

    ``windows`` are in order, the fullest first; pieces are (id, start, length, tokens, total).
    """
    def cut(piece, size):
        doc_id, start, length, ids, total = piece
        return (doc_id, start, size, ids[:size], total), (doc_id, start + size, length - size, ids[size:], total)

    def take(into, source, size):
        """Move ``size`` tokens, or all there are, from the end of ``source``; the tokens still missing."""
        while size and source:
            piece = source.pop()
            if piece[2] > size:
                piece, rest = cut(piece, size)
                source.append(rest)
            into.append(piece)
            size -= piece[2]
        return size

    first, last, loose = 0, len(windows), []
    while first < last:
        pieces = windows[first]
        own, gap = len(pieces), window - sum(p[2] for p in pieces)
        while gap and (loose or last - 1 > first):
            if not loose:
                last -= 1
                loose = windows[last]
            gap = take(pieces, loose, gap)
        if gap:
            loose = pieces
            break
        yield pieces, own
        first += 1
    size = sum(p[2] for p in loose)
    while size:
        part = 1 << size.bit_length() - 1
        pieces: list = []
        take(pieces, loose, part)
        yield pieces, 0
        size -= part


def _slices(batches) -> Iterator[tuple[list, list[bytes]]]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            text = batch.column(1)[i].as_py()
            ids.append(batch.column(0)[i].as_py())
            texts.append((text or "").encode("utf-8", "surrogatepass"))
            size += len(texts[-1])
            if size >= SLICE_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _pack(path: str, window: int, end_token: int, id_type: pa.DataType):
    def run(batches):
        placing = SumOfSquares(window)
        sequence = TaskContext.get().partitionId() << 40
        end = np.array([end_token], np.uint32)
        out: list[tuple] = []

        def crc(ids):
            return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())

        def close(pieces, own):
            nonlocal sequence
            offset = 0
            for i, (doc_id, start, length, ids, total) in enumerate(pieces):
                out.append((doc_id, start, length, crc(ids), total, sequence, offset, i < own))
                offset += length
            sequence += 1

        def flush():
            columns = list(zip(*out)) if out else [[] for _ in range(8)]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:7]], pa.array(columns[7], pa.bool_())],
                names=["doc_id", *COLUMNS, "placed"])

        for doc_ids, texts in _slices(batches):
            for doc_id, ids in zip(doc_ids, encoder_for(path).encode(texts)):
                ids = np.concatenate([ids, end])
                total = len(ids)
                at = 0
                while total - at >= window:
                    close([(doc_id, at, window, ids[at:at + window], total)], 1)
                    at += window
                if total > at:
                    full = placing.add((doc_id, at, total - at, ids[at:], total))
                    if full:
                        close(full, len(full))
            yield flush()

        for pieces, own in filled(placing.rest(), window):
            close(pieces, own)
        yield flush()
    return run


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_token: int = END_TOKEN,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, placed.

    ``tokenizer`` is the path of a tokenizers file on every machine.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = f"doc_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in COLUMNS) + ", placed boolean"
    return rows.mapInArrow(_pack(tokenizer, window, end_token, to_arrow_type(kind)), schema)
