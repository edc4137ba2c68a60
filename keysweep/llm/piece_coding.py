"""Operator 1: SentencePiece encoding and decoding for merge-type vocabularies.

A text is a row of symbols, first its characters. All adjacent pairs that the
vocabulary can join stand on an agenda ordered by score (ties: the leftmost);
the first is taken, the two symbols become one, and the pairs with its two
neighbours are entered, until the agenda is empty. Characters without a piece
become byte pieces.

Words don't interact when no piece holds a space after another character, so
each different word of a slice of an Arrow batch is encoded once. Words of up
to ``SHORT`` symbols run side by side in numpy, one agenda per row of a matrix;
longer ones (and whole texts of vocabularies where words do interact) use a
heap. Every newly encoded word is compared with the sentencepiece library in
the same batch, and a difference fails the task; decoded texts that differ
from their original (a text may hold the mark that stands for a space) are
compared with the library's ``decode``.

Defined results: a null or empty text has no ids and decodes to the empty
text; repeated rows and null ids are documents like others; an empty table
gives an empty table; other columns aren't read. Memory: one slice of texts
(a longer text is a slice of its own) and a bounded table of known words.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "\u2581"
SHORT = 24
SLICE_BYTES = 5_000_000
KNOWN_WORDS = 300_000

_NONE = np.iinfo(np.int32).max
_SHIFT = np.int64(1 << 20)


class MergeVocabulary:
    """Pieces, scores and joins of a merge-type model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        self.size = lib.get_piece_size()
        pieces = [lib.id_to_piece(i) for i in range(self.size)]
        normal = {p: i for i, p in enumerate(pieces)
                  if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))}
        self.byte_ids = np.zeros(256, np.int32)
        self.bytes_of: list[bytes] = []
        for i, p in enumerate(pieces):
            if lib.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.bytes_of.append(bytes([int(p[3:5], 16)]))
            elif normal.get(p) == i:
                self.bytes_of.append(p.replace(SPACE, " ").encode())
            else:
                self.bytes_of.append(b"")
        self.names = [str(i) for i in range(self.size)]
        #: No piece has a space after another character: words can be encoded apart.
        self.words_apart = not any(SPACE in p.lstrip(SPACE) for p in normal)
        symbols = dict(normal)
        for p in normal:
            for ch in p:
                symbols.setdefault(ch, self.size + len(symbols))
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.symbol_of[ord(s)] = i
        scores = np.array([lib.get_score(i) for i in range(self.size)])
        order = np.unique(-scores, return_inverse=True)[1]
        joins: dict[int, int] = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    joins[a * int(_SHIFT) + b] = i
        self.keys = np.array(sorted(joins), np.int64)
        self.joined = np.array([joins[k] for k in self.keys.tolist()], np.int32)
        self.rank = order[self.joined].astype(np.int32)
        self.joins = joins
        self.order = order

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of joining the symbols; rank ``_NONE`` where they don't join."""
        key = a.astype(np.int64) * _SHIFT + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(ok, self.rank[at], _NONE).astype(np.int32), self.joined[at]

    def fallback(self, symbols: np.ndarray, chars: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids for symbols in order: characters without a piece become byte pieces."""
        unknown = (symbols < 0) | (symbols >= self.size)
        if not unknown.any():
            return symbols, counts
        each, which = np.unique(chars[unknown], return_inverse=True)
        coded = [chr(c).encode("utf-8", "surrogatepass") for c in each]
        table = np.zeros((len(each), 4), np.int32)
        for r, bs in enumerate(coded):
            table[r, :len(bs)] = self.byte_ids[list(bs)]
        n_bytes = np.array([len(bs) for bs in coded])[which]
        lengths = np.ones(len(symbols), np.int64)
        lengths[unknown] = n_bytes
        ids = np.repeat(symbols, lengths)
        starts = (np.cumsum(lengths) - lengths)[unknown]
        for k in range(4):
            has = n_bytes > k
            ids[starts[has] + k] = table[which[has], k]
        owner = np.repeat(np.arange(len(counts)), counts)
        return ids, np.bincount(owner, lengths, minlength=len(counts)).astype(np.int64)


def _matrix_agenda(vocab: MergeVocabulary, chars: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encode rows of characters (padded with 0 beyond ``lengths``), one agenda per row.

    Symbols of a row are linked left and right; the column after the last one
    is a stop that joins with nothing. The smallest rank of a row, the leftmost
    on a tie, is the head of its agenda.
    """
    rows, width = chars.shape
    place = np.arange(width + 1)
    inside = place[None, :width] < lengths[:, None]
    symbols = np.full((rows, width + 1), -1, np.int32)
    symbols[:, :width] = np.where(inside, vocab.symbol_of[chars], -1)
    alive = inside.copy()
    right = np.tile(place + 1, (rows, 1))
    left = np.tile(place - 1, (rows, 1))
    rank = np.full((rows, width + 1), _NONE, np.int32)
    piece = np.zeros((rows, width + 1), np.int32)
    rank[:, :width], piece[:, :width] = vocab.pairs(symbols[:, :-1], symbols[:, 1:])
    at = np.arange(rows)
    while len(at):
        head = rank[at].argmin(axis=1)
        ok = rank[at, head] < _NONE
        at, head = at[ok], head[ok]
        if not len(at):
            break
        gone = right[at, head]
        after = right[at, gone]
        symbols[at, head] = piece[at, head]
        alive[at, gone] = False
        rank[at, gone] = _NONE
        right[at, head] = after
        left[at, after] = head
        rank[at, head], piece[at, head] = vocab.pairs(symbols[at, head], symbols[at, after])
        before = left[at, head]   # -1 is the stop column
        rank[at, before], piece[at, before] = vocab.pairs(symbols[at, before], symbols[at, head])
        rank[at, width] = _NONE
        symbols[at, width] = -1
    return vocab.fallback(symbols[:, :width][alive], chars[alive], alive.sum(axis=1))


def _heap_agenda(vocab: MergeVocabulary, text: str) -> np.ndarray:
    """The same agenda as a heap, for one long row."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    symbols = vocab.symbol_of[chars].tolist()
    n = len(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    agenda: list[tuple] = []

    def enter(a, b):
        if a >= 0 and b < n and symbols[a] >= 0 and symbols[b] >= 0:
            joined = vocab.joins.get(symbols[a] * int(_SHIFT) + symbols[b])
            if joined is not None:
                heapq.heappush(agenda, (int(vocab.order[joined]), a, b, symbols[a], symbols[b], joined))

    for i in range(n - 1):
        enter(i, i + 1)
    while agenda:
        _, a, b, was_a, was_b, joined = heapq.heappop(agenda)
        if alive[a] and alive[b] and right[a] == b and symbols[a] == was_a and symbols[b] == was_b:
            symbols[a], alive[b] = joined, False
            right[a] = right[b]
            if right[b] < n:
                left[right[b]] = a
            enter(left[a], a)
            enter(a, right[a])
    kept = np.flatnonzero(alive)
    ids, _ = vocab.fallback(np.array(symbols, np.int32)[kept], chars[kept], np.array([len(kept)]))
    return ids


def encode_units(vocab: MergeVocabulary, units: list[str]) -> list[np.ndarray]:
    """Ids of each unit, a string in which spaces are already marks."""
    out: list[np.ndarray | None] = [None] * len(units)
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    for low, high in ((0, 8), (8, 16), (16, SHORT)):
        chosen = np.flatnonzero((lengths > low) & (lengths <= high))
        if not len(chosen):
            continue
        sizes = lengths[chosen]
        flat = np.frombuffer("".join([units[i] for i in chosen]).encode("utf-32-le", "surrogatepass"), np.uint32)
        chars = np.zeros((len(chosen), high), np.int64)
        chars[np.arange(high)[None, :] < sizes[:, None]] = flat
        ids, counts = _matrix_agenda(vocab, chars, sizes)
        ends = np.cumsum(counts)
        for i, a, b in zip(chosen.tolist(), (ends - counts).tolist(), ends.tolist()):
            out[i] = ids[a:b]
    for i in np.flatnonzero(lengths > SHORT):
        out[i] = _heap_agenda(vocab, units[i])
    return [np.empty(0, np.int32) if x is None else x for x in out]


def text_units(text: str, words_apart: bool) -> list[str]:
    """The parts of a text that don't interact, each without the mark it starts with.

    A mark is put before the text and for every space; a part is a run of marks
    and the characters up to the next one.
    """
    if not text:
        return []
    if not words_apart:
        return [text.replace(" ", SPACE)]
    if "  " not in text and text[0] != " " and SPACE not in text:
        return text.split(" ")
    units, run = [], ""
    for part in text.replace(" ", SPACE).split(SPACE):
        if part:
            units.append(run + part)
            run = ""
        else:
            run += SPACE
    if run:
        units.append(run[1:])
    return units


class PieceCoder:
    """Encodes and decodes texts; words are encoded once and checked against the library."""

    def __init__(self, path: str, check: bool = True):
        self.vocab = MergeVocabulary(path)
        self.check = check
        self.known: dict[str, tuple] = {}

    def _learn(self, units: list[str]) -> None:
        found = encode_units(self.vocab, [SPACE + u for u in units])
        # The library puts its own mark before a text, but none before an empty one.
        theirs = self.vocab.library.encode([u.replace(SPACE, " ") for u in units]) if self.check else None
        table, names, known = self.vocab.bytes_of, self.vocab.names, self.known
        for k, (unit, ids) in enumerate(zip(units, found)):
            each = ids.tolist()
            if theirs is not None and unit and each != theirs[k]:
                raise ValueError(f"{unit!r}: {each} is not the library's {theirs[k]}")
            known[unit] = (ids, ",".join([names[i] for i in each]), b"".join([table[i] for i in each]))

    def coded(self, texts: list[str]) -> Iterator[tuple[str, list[tuple]]]:
        """Per text its units' (ids, ids as text, decoded bytes)."""
        lists = [text_units(t, self.vocab.words_apart) for t in texts]
        different = {u for units in lists for u in units}
        new = [u for u in different if u not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known = {u: self.known[u] for u in different if u in self.known}
        self._learn(new)
        known = self.known
        for text, units in zip(texts, lists):
            yield text, [known[u] for u in units]

    def decoded(self, text: str, parts: list[tuple]) -> str:
        raw = b"".join([p[2] for p in parts])
        out = (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "surrogatepass")
        if self.check and out != text:
            theirs = self.vocab.library.decode([i for p in parts for i in p[0].tolist()])
            if out != theirs:
                raise ValueError(f"decoded {out[:80]!r} is not the library's {theirs[:80]!r}")
        return out


_CODERS: dict[tuple, PieceCoder] = {}


def coder_for(path: str, check: bool) -> PieceCoder:
    """The process's coder: a worker that runs several tasks keeps the words it knows."""
    if (path, check) not in _CODERS:
        _CODERS[path, check] = PieceCoder(path, check)
    return _CODERS[path, check]


def _slices(batches) -> Iterator[tuple[list, list[str]]]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            ids.append(batch.column(0)[i].as_py())
            texts.append(batch.column(1)[i].as_py() or "")
            size += len(texts[-1])
            if size >= SLICE_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _over_texts(docs: DataFrame, id_col: str, text_col: str, path: str, check: bool, columns: dict, one) -> DataFrame:
    """Rows (doc_id, *columns) computed per text in Arrow batches by ``one(coder, text, parts)``."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    id_type, types = to_arrow_type(kind), [t for _, t in columns.values()]

    def run(batches):
        for ids, texts in _slices(batches):
            coder = coder_for(path, check)
            made = list(zip(*[one(coder, text, parts) for text, parts in coder.coded(texts)]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), *[pa.array(m, t) for m, t in zip(made, types)]],
                                             names=["doc_id", *columns])

    schema = ", ".join([f"doc_id {kind.simpleString()}", *[f"{c} {sql}" for c, (sql, _) in columns.items()]])
    return rows.mapInArrow(run, schema)


def encode_documents(docs: DataFrame, model: str, check: bool = True, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the whole text's ids, without begin or end ids."""
    def one(coder, text, parts):
        return (np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int32),)

    return _over_texts(docs, id_col, text_col, model, check, {"ids": ("array<int>", pa.list_(pa.int32()))}, one)


def decode_ids(vocab: MergeVocabulary, ids: list[int]) -> str:
    """The text of ids; the space put before the first word goes, broken bytes become U+FFFD."""
    raw = b"".join([vocab.bytes_of[i] for i in ids])
    return (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace")


def decode_documents(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of encoded documents; null ids decode to the empty text."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["doc_id"].dataType

    def run(batches):
        vocab = None
        for batch in batches:
            vocab = vocab or MergeVocabulary(model)
            texts = [decode_ids(vocab, ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, text string")


def coding_report(docs: DataFrame, model: str, check: bool = True, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per document."""
    def one(coder, text, parts):
        digest = hashlib.sha256(",".join([p[1] for p in parts]).encode()).hexdigest()
        back = coder.decoded(text, parts)
        return (sum(len(p[0]) for p in parts), digest, hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())

    return _over_texts(docs, id_col, text_col, model, check, {
        "n_tokens": ("long", pa.int64()), "ids_sha256": ("string", pa.string()),
        "decoded_sha256": ("string", pa.string())}, one)
