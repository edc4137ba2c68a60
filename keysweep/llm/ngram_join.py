"""Operator 2: n-gram Jaccard join in size-banded tiles with bitmap bounds.

A document is the set of its distinct word shingles. Two documents link when
the Jaccard index of their sets reaches a threshold. The join is exact:

1. Documents with equal sets form a class; from here on classes are joined.
2. Shingles have one global order: rare ones first, then by hash. By the prefix
   principle two sets of size a and b that reach the threshold t share a
   shingle among the first ``n - ceil(t n) + 1`` of each. Classes are filed
   under these shingles; a shingle that only one class files is dropped.
3. Under a shingle, classes lie in bands of set size; a tile compares a band
   with itself and with the next one, as larger ratios can't reach t. A tile
   with many classes, counted on this filing, is cut into blocks, and each pair
   of blocks is a tile.
4. In a tile, parity bitmaps (one bit per hash value modulo a width that grows
   with the set, flipped by each shingle) bound the overlap from above: differing bits are differing
   shingles. Pairs whose bound fails are out; the others connect candidates.
5. Each group of connected candidates is verified once: sizes, bitmaps, then
   the exact intersection of sorted hash arrays. Verified links give the
   components and every class's number of linked documents.

Nothing is capped. Pairs aren't emitted: tiles and groups return a row per
class. "Rare" is decided by exact counts: the shingles filed more than
``LEAST_HOT`` times (a limit raised until at most ``MAX_HOT`` shingles exceed
it, so that the table of them, broadcast, stays under 16 MB) go last.

Shingles are compared by 64-bit hashes, equal sets by a 64-bit digest.

Defined results: null and empty texts and texts without words have an empty
set, link with nothing and are their own component; a null id forms no own
component id (it takes the smallest id of its class or group, else null);
repeated rows are documents of one class; an empty table gives an empty table;
other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysweep.llm.common import staged
from keysweep.llm.components import components

#: Words per shingle and least similarity in percent, by default.
WORDS = 5
PERCENT = 80
BITS = 512
LEAST_HOT = 16
MAX_HOT = 1_000_000
#: Classes of one block of a tile, and of one block of a verified group.
TILE_BLOCK = 1024
GROUP_BLOCK = 512
#: Words held at a time while a batch is hashed.
SLICE_WORDS = 400_000

_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_lists(texts: Iterator) -> Iterator[list[list[bytes]]]:
    held, n = [], 0
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        held.append(words)
        n += len(words)
        if n >= SLICE_WORDS:
            yield held
            held, n = [], 0
    if held:
        yield held


def shingle_sets(texts: Iterator, size: int) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct 64-bit hashes of its shingles of ``size`` words.

    Bytes are lower-cased (A to Z only) and split at U+0020 and U+0009 to
    U+000D, which no other UTF-8 character contains. A text with fewer words
    is one shingle.
    """
    for lists in _word_lists(texts):
        flat = np.empty(sum(map(len, lists)), dtype=object)
        flat[:] = list(chain.from_iterable(lists))
        hashed = pd.util.hash_array(flat, categorize=False).astype(np.uint64) if len(flat) else np.empty(0, np.uint64)
        rolled = np.zeros(max(0, len(hashed) - size + 1), np.uint64)
        for k in range(size):
            rolled = rolled * _MUL + hashed[k:k + len(rolled)]
        rolled = _mix(rolled)
        at = 0
        for words in lists:
            n = len(words)
            if n >= size:
                yield np.unique(rolled[at:at + n - size + 1])
            elif n:
                few = np.uint64(n)
                for h in hashed[at:at + n]:
                    few = _mix((few * _MUL + h).reshape(1))[0]
                yield np.array([few], np.uint64)
            else:
                yield np.empty(0, np.uint64)
            at += n


def _quiet(fn):
    """Hash arithmetic wraps; numpy needn't warn about scalars."""
    def inner(*args):
        with np.errstate(over="ignore"):
            yield from fn(*args)
    return inner


def set_digest(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def parity_bits(hashes: np.ndarray) -> bytes:
    """One bit per hash value modulo the width, flipped by every hash; wider for larger sets.

    Of unlike sets about half the bits differ, whatever their size; the width
    keeps that well above the differences that linked sets may have.
    """
    width = BITS
    while 2 * width < len(hashes):
        width *= 2
    return np.packbits((np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8)).tobytes()


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _filed(hashes: np.ndarray, percent: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles a set is filed under, and which of them are hot; rare ones first, then by hash."""
    need = prefix_length(len(hashes), percent)
    take = need
    while True:
        head = hashes[:take]
        at = np.searchsorted(hot, head)
        is_hot = hot[np.minimum(at, len(hot) - 1)] == head if len(hot) else np.zeros(len(head), bool)
        cold = head[~is_hot]
        if len(cold) >= need:
            return cold[:need], np.zeros(need, bool)
        if take >= len(hashes):
            rest = head[is_hot][:need - len(cold)]
            return np.concatenate([cold, rest]), np.concatenate([np.zeros(len(cold), bool), np.ones(len(rest), bool)])
        take = min(len(hashes), 2 * take)


def _texts(batch: pa.RecordBatch, name: str) -> Iterator:
    column = batch.column(batch.schema.get_field_index(name))
    return (x.as_py() for x in column)


def _signatures(size: int):
    """(text) -> (n, key, bits) beside the id."""
    @_quiet
    def run(batches):
        for batch in batches:
            n, keys, bits = [], [], []
            for hashes in shingle_sets(_texts(batch, "text"), size):
                n.append(len(hashes))
                keys.append(set_digest(hashes) if len(hashes) else None)
                bits.append(parity_bits(hashes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), batch.column(batch.schema.get_field_index("row")),
                 pa.array(n, pa.int64()), pa.array(keys, pa.int64()), pa.array(bits, pa.binary())],
                names=["doc_id", "row", "n", "key", "bits"])
    return run


def _blobs(size: int, percent: int, buckets: int, hot: np.ndarray | None):
    """Filed shingles of a batch, packed by bucket.

    Without ``hot``: each distinct shingle of the batch and how often it is
    filed. With it: distinct (shingle, class) pairs; pairs of hot shingles go
    to buckets of their own, spread by class, as nothing is filtered there.
    """
    def pack(order_by, *columns):
        order = np.argsort(order_by, kind="stable")
        places = order_by[order]
        cuts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]]) if len(places) else np.empty(0, np.int64)
        ends = np.r_[cuts[1:], len(places)] if len(cuts) else cuts
        parts = [[c[order][a:b].tobytes() for a, b in zip(cuts, ends)] for c in columns]
        return pa.RecordBatch.from_arrays(
            [pa.array(places[cuts].astype(np.int32), pa.int32()), *[pa.array(p, pa.binary()) for p in parts]],
            names=["bucket", "tokens", "other"])

    @_quiet
    def run(batches):
        for batch in batches:
            tokens, keys, flags = [], [], []
            for hashes in shingle_sets(_texts(batch, "text"), size):
                if len(hashes):
                    filed, is_hot = _filed(hashes, percent, hot if hot is not None else np.empty(0, np.uint64))
                    tokens.append(filed)
                    if hot is not None:
                        keys.append(np.full(len(filed), set_digest(hashes), np.int64))
                        flags.append(is_hot)
            flat = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
            if hot is None:
                flat, counts = np.unique(flat, return_counts=True)
                yield pack((flat % np.uint64(buckets)).astype(np.int64), flat, counts.astype(np.int64))
                continue
            owner = np.concatenate(keys) if keys else np.empty(0, np.int64)
            is_hot = np.concatenate(flags) if flags else np.empty(0, bool)
            order = np.lexsort((owner, flat))
            flat, owner, is_hot = flat[order], owner[order], is_hot[order]
            first = np.r_[True, (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])] if len(flat) else np.empty(0, bool)
            flat, owner, is_hot = flat[first], owner[first], is_hot[first]
            bucket = (flat % np.uint64(buckets)).astype(np.int64)
            spread = buckets + (owner.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            yield pack(np.where(is_hot, spread, bucket), flat, owner)
    return run


def _gathered(pdf: pd.DataFrame, dtype) -> tuple[np.ndarray, np.ndarray]:
    return (np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["tokens"]]),
            np.concatenate([np.frombuffer(x, dtype) for x in pdf["other"]]))


def _count_tokens(pdf: pd.DataFrame) -> pd.DataFrame:
    tokens, counts = _gathered(pdf, np.int64)
    each, where = np.unique(tokens, return_inverse=True)
    total = np.bincount(where, counts).astype(np.int64)
    hot = total > LEAST_HOT
    return pd.DataFrame({"token": each[hot].view(np.int64), "n": total[hot]})


def _shared(buckets: int):
    """(shingle, class) pairs of a bucket whose shingle more than one class files; all pairs of a hot bucket."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tokens, keys = _gathered(pdf, np.int64)
        order = np.lexsort((keys, tokens))
        tokens, keys = tokens[order], keys[order]
        new = np.r_[True, (tokens[1:] != tokens[:-1]) | (keys[1:] != keys[:-1])]
        tokens, keys = tokens[new], keys[new]
        if pdf["bucket"].iloc[0] < buckets:
            same = tokens[1:] == tokens[:-1]
            keep = np.r_[False, same] | np.r_[same, False]
            tokens, keys = tokens[keep], keys[keep]
        return pd.DataFrame({"token": tokens.view(np.int64), "key": keys})
    return run


def _reach(na, nb, overlap, percent: int):
    """Whether sets of these sizes link at this (least) overlap."""
    return 100 * overlap >= percent * (na + nb - overlap)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per node 0..n-1 the smallest node of its component under the edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _words_of(bits, size: int) -> np.ndarray:
    """Bitmaps as rows of ``size`` bytes in 64-bit words; wider ones are folded (differing bits may only vanish)."""
    out = np.empty((len(bits), size // 8), np.uint64)
    lengths = np.fromiter(map(len, bits), np.int64, len(bits))
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        wide = np.frombuffer(b"".join([bits[i] for i in rows]), np.uint64).reshape(len(rows), length // size, size // 8)
        out[rows] = np.bitwise_xor.reduce(wide, axis=1)
    return out


def _compare_tiles(percent: int):
    """Rows of whole tiles -> (u, v): each class tied to a candidate of smaller rank in its tile."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["token", "band", "ci", "cj", "n", "key"], kind="stable")
        tile = np.r_[0, np.cumsum((pdf[["token", "band", "ci", "cj"]].diff().iloc[1:] != 0).any(axis=1).to_numpy())]
        bits, n = pdf["bits"].to_numpy(), pdf["n"].to_numpy()
        # a tile compares at its narrowest bitmap; rows are taken width by width
        lengths = np.fromiter(map(len, bits), np.int64, len(bits))
        narrow = np.minimum.reduceat(lengths, np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]]))[tile]
        words, position = {}, np.empty(len(pdf), np.int64)
        for size in np.unique(narrow):
            rows = np.flatnonzero(narrow == size)
            words[size], position[rows] = _words_of(bits[rows], int(size)), np.arange(len(rows))
        home, block, keys = pdf["home"].to_numpy(), pdf["block"].to_numpy(), pdf["key"].to_numpy()
        cross = (pdf["ci"] != pdf["cj"]).to_numpy()
        # pairs are folded into the tile's components from time to time; connected ones needn't be compared
        root, left, right, held = np.arange(len(pdf)), [], [], 0
        here = np.arange(len(pdf))
        step = 1
        while True:
            here = here[here + step < len(pdf)]
            # rows are sorted by size in a tile: once too large, always too large
            here = here[(tile[here] == tile[np.minimum(here + step, len(pdf) - 1)])
                        & (100 * n[here] >= percent * n[np.minimum(here + step, len(pdf) - 1)])]
            if not len(here):
                break
            a, b = here, here + step
            ok = (home[a] | home[b]) & (keys[a] != keys[b]) & (~cross[a] | (block[a] != block[b])) & (root[a] != root[b])
            a, b = a[ok], b[ok]
            differ = np.zeros(len(a), np.int64)
            for size, rows in words.items():
                own = np.flatnonzero(narrow[a] == size)
                differ[own] = np.bitwise_count(rows[position[a[own]]] ^ rows[position[b[own]]]).sum(axis=1, dtype=np.int64)
            ok = _reach(n[a], n[b], (n[a] + n[b] - differ) // 2, percent)
            left.append(a[ok])
            right.append(b[ok])
            held += int(ok.sum())
            if held >= len(pdf) or step & (step - 1) == 0:
                root, left, right, held = _roots(len(pdf), np.concatenate([np.arange(len(pdf)), *left]),
                                                 np.concatenate([root, *right])), [], [], 0
            step += 1
        root = _roots(len(pdf), np.concatenate([np.arange(len(pdf)), *left]), np.concatenate([root, *right]))
        out = pd.DataFrame({"u": keys, "v": keys[root]})
        return out[out["u"] != out["v"]].drop_duplicates()
    return run


def _verify_groups(percent: int):
    """Rows of whole blocks of candidate groups -> (key, root, links), one per class and block pair."""
    def linked(i, others, sets, sizes):
        """Positions in ``others`` whose sets reach the threshold with set ``i``."""
        flat = np.concatenate([sets[j] for j in others])
        at = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
        hits = np.add.reduceat((sets[i][at] == flat).astype(np.int64), np.r_[0, np.cumsum(sizes[others])[:-1]])
        return others[_reach(sizes[i], sizes[others], hits, percent)]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, ci, cj), rows in pdf.groupby(["root", "ci", "cj"], sort=False):
            rows = rows.drop_duplicates("key").sort_values(["n", "key"])
            keys, sizes = rows["key"].to_numpy(), rows["n"].to_numpy()
            copies, block = rows["copies"].to_numpy(), rows["block"].to_numpy()
            bits = rows["bits"].to_numpy()
            words = _words_of(bits, min(map(len, bits)))
            sets = [np.frombuffer(x, np.uint64) for x in rows["hashes"]]
            links = np.zeros(len(rows), np.int64)
            left, right = [], []
            for i in range(len(rows) - 1):
                others = np.arange(i + 1, len(rows))
                others = others[100 * sizes[i] >= percent * sizes[others]]
                if ci != cj:
                    others = others[block[others] != block[i]]
                differ = np.bitwise_count(words[others] ^ words[i]).sum(axis=1, dtype=np.int64)
                others = others[_reach(sizes[i], sizes[others], (sizes[i] + sizes[others] - differ) // 2, percent)]
                if len(others):
                    found = linked(i, others, sets, sizes)
                    links[i] += copies[found].sum()
                    links[found] += copies[i]
                    left.append(np.full(len(found), i))
                    right.append(found)
            a = np.concatenate(left) if left else np.empty(0, np.int64)
            b = np.concatenate(right) if right else np.empty(0, np.int64)
            out.append(pd.DataFrame({"key": keys, "root": keys[_roots(len(rows), a, b)], "links": links}))
        return pd.concat(out) if out else pd.DataFrame({"key": [], "root": [], "links": []})
    return run


def _wanted_sets(size: int):
    """(text, key, ...) -> the set of the text, where its digest is the key asked for."""
    @_quiet
    def run(batches):
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key")).to_pylist()
            hashes, keep = [], []
            for i, found in enumerate(shingle_sets(_texts(batch, "text"), size)):
                if len(found) and set_digest(found) == keys[i]:
                    keep.append(i)
                    hashes.append(found.tobytes())
            rest = batch.drop_columns(["text"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(hashes, pa.binary())],
                                             names=[*rest.schema.names, "hashes"])
    return run


def _blocks(df: DataFrame, count, *keep: str) -> DataFrame:
    """Rows copied to every pair of blocks (ci <= cj) that their own block takes part in."""
    placed = df.withColumn("block", F.pmod(F.xxhash64("key"), count).cast("int"))
    other = placed.withColumn("with", F.explode(F.sequence(F.lit(0), count.cast("int") - 1)))
    return other.select(*keep, "block", F.least("block", "with").alias("ci"), F.greatest("block", "with").alias("cj"))


def _banded(filed: DataFrame, percent: int) -> DataFrame:
    """Rows (with ``n``) in the tile of their own band and in that of the next smaller one."""
    # Bands a little wider than the threshold's ratio, so that rounding can't part a pair by two.
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / (percent - 1)))).cast("int")
    return filed.withColumn("b", F.explode(F.array(
        F.struct(band.alias("band"), F.lit(True).alias("home")),
        F.struct((band - 1).alias("band"), F.lit(False).alias("home"))))).select("*", "b.band", "b.home").drop("b")


def _row(id_column: Column, text: Column) -> Column:
    """A row's name: equal for rows that repeat id and text."""
    return F.xxhash64(id_column, text)


def _linked(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): (doc_id, row, n, key) per document and (key, root, first, copies, links) per class of equal sets.

    ``first`` is the class's first row (null id last, id, name), ``root`` one class of its component.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text_column = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_column.alias("text"), _row(F.col(id_col), text_column).alias("row"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    signed = staged(rows.mapInArrow(_signatures(size), f"doc_id {id_type}, row long, n long, key long, bits binary"), "ngram-sets")
    classes = staged(signed.where("key is not null").groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("first"),
        F.max("n").alias("n"), F.max("bits").alias("bits"), F.count(F.lit(1)).alias("copies")), "ngram-classes")

    # Shingles filed often, by the plain order of hashes; they go last in the order used.
    text = rows.select("text")
    packed = "bucket int, tokens binary, other binary"
    often = staged(text.mapInArrow(_blobs(size, percent, buckets, None), packed)
                   .groupBy("bucket").applyInPandas(_count_tokens, "token long, n long"), "ngram-hot")
    limit = LEAST_HOT
    while often.where(F.col("n") > limit).count() > MAX_HOT:
        limit *= 2
    hot = np.sort(np.array([r["token"] for r in often.where(F.col("n") > limit).select("token").collect()],
                           np.int64).view(np.uint64))

    shared = staged(text.mapInArrow(_blobs(size, percent, buckets, hot), packed)
                    .groupBy("bucket").applyInPandas(_shared(buckets), "token long, key long"), "ngram-filed")
    # Crowded tiles, counted on this filing: near copies also share shingles that the plain order never files.
    frequent = staged(shared.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
                      .where(F.col("n") > TILE_BLOCK).select("token"), "ngram-frequent")
    crowded = staged(_banded(shared.join(frequent, "token", "left_semi").join(classes.select("key", "n"), "key"), percent)
                     .groupBy("token", "band").agg(F.ceil(F.count(F.lit(1)) / TILE_BLOCK).cast("int").alias("c"))
                     .where(F.col("c") > 1), "ngram-crowded")
    banded = (_banded(shared.join(classes.select("key", "n", "bits"), "key"), percent)
              .join(crowded, ["token", "band"], "left").withColumn("c", F.coalesce("c", F.lit(1))))
    tiles = _blocks(banded, F.col("c"), "token", "band", "home", "key", "n", "bits", "c")
    # A cut tile is a group of its own, the others share buckets.
    place = F.xxhash64("token", "band", "ci", "cj")
    pairs = (tiles.withColumn("bucket", F.when(F.col("c") > 1, place).otherwise(F.pmod(place, F.lit(buckets)))).drop("c")
             .groupBy("bucket").applyInPandas(_compare_tiles(percent), "u long, v long"))
    groups = components(pairs)

    # Verification: every candidate group once, its sets read again from one document of each class.
    roots = groups.select(F.col("root").alias("node")).distinct()
    members = groups.unionByName(roots.select("node", F.col("node").alias("root"))).withColumnRenamed("node", "key")
    sized = members.join(members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK).cast("int").alias("c")), "root")
    asked = sized.join(classes, "key").select("key", "root", "c", "n", "bits", "copies", F.col("first.row").alias("row"))
    read = (rows.drop("doc_id").join(asked, "row").drop("row")
            .mapInArrow(_wanted_sets(size), "key long, root long, c int, n long, bits binary, copies long, hashes binary"))
    blocks = _blocks(read, F.col("c"), "key", "root", "n", "bits", "copies", "hashes")
    verified = staged(
        blocks.withColumn("bucket", F.pmod(F.xxhash64("root", "ci", "cj"), F.lit(buckets)).cast("int"))
        .groupBy("bucket").applyInPandas(_verify_groups(percent), "key long, root long, links long"), "ngram-links")
    links = verified.groupBy("key").agg(F.sum("links").alias("links"))
    joined = components(verified.select(F.col("key").alias("u"), F.col("root").alias("v")))

    named = (classes.select("key", "first", "copies").join(joined.withColumnRenamed("node", "key"), "key", "left")
             .join(links, "key", "left")
             .select("key", F.coalesce("root", "key").alias("root"), "first", "copies", F.coalesce("links", F.lit(0)).alias("links")))
    return signed.select("doc_id", "row", "n", "key"), named


def similar_documents(docs: DataFrame, size: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links), one row per document.

    ``component_id`` is the smallest id reachable by links, the own included;
    ``n_links`` counts the documents directly linked, copies one by one.
    """
    rows, named = _linked(docs, size, percent, id_col, text_col)
    smallest = named.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    labels = named.join(smallest, "root").select("key", "component_id", (F.col("copies") - 1 + F.col("links")).alias("n_links"))
    return (rows.join(labels, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def keep_first(docs: DataFrame, size: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of linked ones; all columns pass through.

    The one of the smallest id stays (of rows that share it, one; a null id
    goes last). Documents without words stay, as nothing links them. Of rows
    that repeat id and text one stays in any case.
    """
    rows, named = _linked(docs, size, percent, id_col, text_col)
    keep = (named.groupBy("root").agg(F.min("first")["row"].alias("__row"))
            .select("__row").unionByName(rows.where("key is null").select(F.col("row").alias("__row")).distinct()))
    # Repeated rows are dropped first, while still spread: afterwards the join key is all but unique.
    single = docs.dropDuplicates([id_col, text_col]).withColumn("__row", _row(F.col(id_col), F.col(text_col).cast("string")))
    return single.join(keep, "__row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
