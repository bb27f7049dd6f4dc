"""Duplicate passages by relative Lempel-Ziv parsing.

Every document is factored against the documents with smaller ids. The reference is dealt into
blocks: a window of `window` words belongs to the block of its anchor, the least hash among its
runs of `GRAM` words. Equal windows have equal anchors wherever they stand, so a document
meets exactly the blocks that can hold its passages, and nothing else. Consecutive windows of one
anchor travel as one row, the windows as hashes.

1. A task indexes the windows it reads by their first document. Windows known from a smaller id within
   the task are settled; only the others leave it. A passage that a third of all documents
   hold therefore leaves each task once.
2. Blocks with more than `BLOCK` windows, counted beforehand, are dealt over several tasks, window by window.
3. In a block, the index names each window's first source (document, place). Parsing goes greedily
   from left to right: a factor follows one source for as long as that source goes on. As an indexed
   phrase is `window` words long, every factor is long enough, and the next factor starts inside the
   last phrase of the one before; so windows lying across a factor's end are checked as well.
4. A document's factors, a few numbers each, go back to it, are laid over each other, and the words
   under them are removed.

A window is known by two independent 64-bit hashes, its own and its anchor's.

Defined results: null, empty and white-space texts have no words; a text of fewer words than the window keeps all.
Only ids count: rows that repeat an id are not sources of each other, a null id is no source and loses
nothing. Rows of equal id and text get equal results. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.guards import broadcast_if_small
from .shared import keep, text_of

WINDOW = 50
GRAM = 10
HELD = 1_000_000  # windows a task holds at once
BLOCK = 200_000  # windows of one part of a block
KNOWN_WORDS = 500_000  # words whose hashes a task remembers

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    """base to the power 0, 1, ... modulo 2**64."""
    held = _POWERS.get(base)
    if held is None or len(held) < count:
        steps = np.full(max(count, 4096), base, dtype=_U)
        steps[0] = 1
        _POWERS[base] = held = np.cumprod(steps, dtype=_U)
    return held[:count]


def _scrambled(x: np.ndarray, salt: int) -> np.ndarray:
    x = x + _U(salt)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def rolling(hashes: np.ndarray, length: int, salt: int) -> np.ndarray:
    """A hash of every run of `length` words; equal for equal runs wherever they stand."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, dtype=_U)
    mixed = _scrambled(hashes, salt)
    sums = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(mixed * _powers(_BASE, len(mixed)), dtype=_U)])
    return _scrambled((sums[length:] - sums[:-length]) * _powers(_INVERSE, count), salt + 1)


def anchors(hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The anchor of every window: the least hash among its runs of `gram` words."""
    least = rolling(hashes, gram, 17)
    span, width = 1, window - gram + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


class WordHashes:
    """64-bit hashes of words, remembered."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def of(self, text: str) -> np.ndarray:
        known, found = self.known, text.encode("utf-8", "surrogatepass").split()
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in set(found).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, found), dtype=_U, count=len(found))


def _runs(*same: np.ndarray, steps: tuple[np.ndarray, ...] = ()) -> np.ndarray:
    """Where runs start: `same` stay equal and `steps` go up by one."""
    count = len(same[0])
    new = np.ones(count, dtype=bool)
    if count > 1:
        new[1:] = False
        for values in same:
            new[1:] |= values[1:] != values[:-1]
        for values in steps:
            new[1:] |= values[1:] != values[:-1] + 1
    return np.flatnonzero(new)


def _sources(block: np.ndarray, window: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first source of every window, the least document and place with it in the block, in the order given."""
    order = np.argsort(window)
    starts = _runs(window[order], block[order])
    sizes = np.diff(np.append(starts, len(order)))
    in_order = doc[order]
    least = np.repeat(np.minimum.reduceat(in_order, starts), sizes)
    place = np.where(in_order == least, at[order], np.iinfo(np.int64).max)
    source, source_at = np.empty_like(doc), np.empty_like(at)
    source[order], source_at[order] = least, np.repeat(np.minimum.reduceat(place, starts), sizes)
    return source, source_at


def _factors(doc, key, at, source, source_at, window: int) -> list[np.ndarray]:
    """Maximal runs of known windows that follow one source: doc_id, key, start, length, source, source_start."""
    order = np.lexsort((at, key, doc))
    doc, key, at, source, source_at = (c[order] for c in (doc, key, at, source, source_at))
    starts = _runs(doc, key, source, steps=(at, source_at))
    lengths = np.diff(np.append(starts, len(doc))) + window - 1
    return [doc[starts], key[starts], at[starts], lengths.astype(np.int64), source[starts], source_at[starts]]


_FACTOR = "doc_id long, key long, start long, length long, source long, source_start long"
_FACTOR_NAMES = ["doc_id", "key", "start", "length", "source", "source_start"]
_ROW = "anchor long, doc_id long, key long, start long, windows array<long>"
_ROW_NAMES = ["anchor", "doc_id", "key", "start", "windows"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_of(docs)
    return docs.select("doc_id", F.xxhash64(text).alias("key"), text.alias("text"))


def _hashed(batch: pa.RecordBatch, hasher: WordHashes, window: int, gram: int) -> Iterator[tuple]:
    """doc_id, key, the words' hashes and the windows' anchors of the texts that have a window."""
    for doc, key, text in zip(*(c.to_pylist() for c in batch.columns)):
        hashes = hasher.of(text)
        if len(hashes) >= window:
            yield doc, key, hashes, anchors(hashes, window, gram)


def anchor_sizes(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """anchor and its number of windows, in parts of a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHashes()
        for batch in batches:
            found = [near for *_, near in _hashed(batch, hasher, window, gram)]
            if found:
                names, sizes = np.unique(np.concatenate(found), return_counts=True)
                yield pa.record_batch([pa.array(names.view(np.int64)), pa.array(sizes)], names=["anchor", "size"])

    return _keyed(docs).where("doc_id is not null").mapInArrow(count, "anchor long, size long")


def window_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Runs of windows that a task cannot settle (anchor, start, windows), and factors that it can.

    A factor has no anchor, and its length, source and source_start for windows.
    """

    def settle(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        anchor, hashed, doc, key, at = (np.concatenate(c) for c in zip(*held))
        source, source_at = _sources(anchor, hashed, doc, at)
        known = source < doc
        if known.any():
            *place, length, source, source_at = _factors(*(c[known] for c in (doc, key, at, source, source_at)), window)
            count = len(length)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(count + 1, dtype=np.int32) * 3), pa.array(np.stack([length, source, source_at], axis=1).ravel())
            )
            yield pa.record_batch([pa.nulls(count, pa.int64()), *place, lists], names=_ROW_NAMES)
        left = np.flatnonzero(~known)
        starts = _runs(anchor[left], doc[left], key[left], steps=(at[left],))
        heads = left[starts]
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(left)).astype(np.int32)), pa.array(hashed[left].view(np.int64)))
        columns = [pa.array(c[heads]) for c in (anchor.view(np.int64), doc, key, at)]
        yield pa.record_batch([*columns, lists], names=_ROW_NAMES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = WordHashes(), [], 0
        for batch in batches:
            for doc, key, hashes, near in _hashed(batch, hasher, window, gram):
                count = len(near)
                held.append((near, rolling(hashes, window, 29), np.full(count, doc), np.full(count, key), np.arange(count)))
                size += count
                if size >= HELD:
                    yield from settle(held)
                    held, size = [], 0
        if held:
            yield from settle(held)

    return _keyed(docs).where("doc_id is not null").mapInArrow(cut, _ROW)


def factors(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, key (hash of the text), start, length, source, source_start of every factor, in words."""
    sizes = anchor_sizes(docs, window, gram).groupBy("anchor").agg(F.sum("size").alias("_size"))
    hot = sizes.where(F.col("_size") > BLOCK).select(F.col("anchor").alias("_hot"), F.ceil(F.col("_size") / BLOCK).alias("_parts"))
    hot = broadcast_if_small(keep(hot))
    met = window_rows(docs, window, gram).join(hot, F.col("anchor") == F.col("_hot"), "left")
    # A hot block's windows go out one by one, each to its part; all other rows whole. Settled factors pass by.
    alone = F.transform("windows", lambda w, i: F.struct(F.pmod(w, F.col("_parts")).alias("part"), (F.col("start") + i).alias("start"), F.array(w).alias("windows")))
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("part"), "start", "windows"))
    spread = met.select("anchor", "doc_id", "key", F.inline(F.when(F.col("_parts").isNull(), whole).otherwise(alone)))
    slim = spread.select("anchor", "part", "doc_id", "key", "start", "windows")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def parsed(block, part, hashed, doc, key, at) -> Iterator[pa.RecordBatch]:
            if len(doc):
                source, source_at = _sources(block ^ _scrambled(part.view(_U), 3).view(np.int64), hashed, doc, at)
                known = source < doc
                made = _factors(*(c[known] for c in (doc, key, at, source, source_at)), window)
                yield pa.record_batch([pa.array(c) for c in made], names=_FACTOR_NAMES)

        for batch in batches:
            settled = pc.is_null(batch.column(0))
            if pc.any(settled).as_py():
                done = batch.filter(settled)
                numbers = np.asarray(done.column(5).flatten()).reshape(-1, 3)
                columns = [done.column(2), done.column(3), done.column(4), *(pa.array(np.ascontiguousarray(c)) for c in numbers.T)]
                yield pa.record_batch(columns, names=_FACTOR_NAMES)
                batch = batch.filter(pc.invert(settled))
            if batch.num_rows:
                anchor, part, doc, key, start = (np.asarray(batch.column(c)) for c in range(5))
                sizes = np.asarray(batch.column(5).value_lengths()).astype(np.int64)
                inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                anchor, part, doc, key, start = (np.repeat(c, sizes) for c in (anchor, part, doc, key, start))
                held.append((anchor, part, np.asarray(batch.column(5).flatten()), doc, key, start + inside))
                size += len(doc)
            if size >= HELD:
                # Blocks are parsed whole: the last one, which may go on, waits.
                whole = tuple(np.concatenate(c) for c in zip(*held))
                before = np.flatnonzero((whole[0] != whole[0][-1]) | (whole[1] != whole[1][-1]))
                end = before[-1] + 1 if len(before) else 0
                yield from parsed(*(c[:end] for c in whole))
                held, size = [tuple(c[end:] for c in whole)], len(whole[0]) - end
        if held:
            yield from parsed(*(np.concatenate(c) for c in zip(*held)))

    block = F.coalesce("anchor", F.xxhash64("doc_id", "start"))
    return slim.repartition(block, "part").sortWithinPartitions("anchor", "part").mapInArrow(parse, _FACTOR)


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The input's columns with n_words, n_removed, kept (the other words, joined by a space) and `spans`.

    These take the place of input columns of the same name.

    `spans` are the factors laid over each other, in words, end exclusive. A document's factors meet in one
    group, no more than it has words.
    """
    span = F.struct("start", (F.col("start") + F.col("length")).alias("end"))
    found = factors(docs, window, gram).groupBy("doc_id", "key").agg(F.array_sort(F.collect_set(span)).alias("_spans"))
    found = broadcast_if_small(keep(found)).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "_spans")
    text = text_of(docs)
    same = (docs["doc_id"] == found["_id"]) & (F.xxhash64(text) == found["_key"])
    joined = docs.join(found, same, "left").select(F.struct(*docs.columns).alias("row"), "_spans")
    place = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept, merged = [], [], [], []
            for text, spans in zip(batch.column(0).field(place).to_pylist(), batch.column(1).to_pylist()):
                found, whole = (text or "").encode("utf-8", "surrogatepass").split(), []
                for span in spans or ():
                    if whole and span["start"] <= whole[-1]["end"]:
                        whole[-1]["end"] = max(whole[-1]["end"], span["end"])
                    else:
                        whole.append(dict(span))
                left, at = [], 0
                for span in whole:
                    left += found[at : span["start"]]
                    at = span["end"]
                left += found[at:]
                counts.append(len(found))
                removed.append(len(found) - len(left))
                kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
                merged.append(whole)
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(merged, spans_type)]
            yield pa.record_batch(columns, names=["row", "n_words", "n_removed", "kept", "spans"])

    added = T.StructType.fromDDL("n_words long, n_removed long, kept string, spans array<struct<start:long,end:long>>")
    made = joined.mapInArrow(cut, T.StructType([joined.schema["row"], *added]))
    own = [F.col("row").getField(name).alias(name) for name in docs.columns if name not in added.names]
    return made.select(*own, *added.names)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    cut = without_repeats(docs.select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
