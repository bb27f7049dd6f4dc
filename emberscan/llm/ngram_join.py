"""Similarity self-join of documents on word n-grams, with PartEnum signatures.

Two sets of similarity s or more differ in at most k elements, k growing with
their sizes. Sizes fall into bands so wide that such sets lie in one band or in
neighbouring ones; a set takes part in its own band and in the next. In a band
the domain of n-grams is split by hash into groups and each group into parts. As
at most k elements differ, some group holds at most `spare` of them; all subsets
of its parts that leave out `spare` parts are enumerated, and one of them is
untouched by differences. A signature is the hash of a set's elements in one
such subset, so similar sets share one.

Only then do sets meet:

1. Equal sets are one class (a class is named by a hash of its set). A task sends
   the signatures of a class once, so hot copies cost a row per task, and of the classes it
   finds under one signature only the least: it ties the others to that itself.
2. Signatures held by two classes or more tie these into families, by a
   star around the least class of each, and connected components, band by band.
   A passage that many documents share may tie documents that are far from similar.
3. Families are compared by sketches, a bit per element of the band's largest set: bit h is the
   parity of the elements that hash to h. Sets that differ in d elements have sketches that
   differ in d bits at most, so pairs beyond the bound are out, exactly, and no set travels for them.
   What is left ties classes into kin, near copies but for rare strangers.
4. Each class's set goes to its kin; large kin are split into blocks, and
   pairs of blocks meet in different tasks (as do sketches of a large family). There all pairs are compared
   exactly by a matrix product, and what leaves are stars that connect the same.
5. Components of these links are the result.

A set needs as many subsets as its own partners, not the band's largest, can differ
in: groups go out in a fixed order until that many differences could not touch all
filled subsets so far. Of two similar sets one stops first, and one of its subsets
is untouched and is sent by the other as well. A subset without elements gives no
signature, for sets of one band would meet in it by chance. Where too few subsets
are filled and k is below `CERTAIN`, the domain is split anew (up to `SPLITS` times),
and at the last split empty subsets count too, so nothing is missed; above, similar
sets are missed only if differences touched every filled subset of both, and the
chance of that is below that of two n-grams sharing a 64-bit hash.

Defined results: null, empty and white-space texts have an empty set and link
with nothing; shorter texts than n words have one n-gram, all their words;
a repeated id is one document per row; a null id takes part and may name a
component only if no other id does; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.guards import broadcast_if_small
from .components import components
from .shared import keep, lower_ascii, text_of, words

GROUP_SPARE = 1  # differences that the enumeration within a group absorbs
GROUP_PARTS = 2
CERTAIN = 40
SPLITS = 4
BLOCK = 2048  # sets of one side of a comparison
BLOCK_ELEMENTS = 1_000_000  # and about their elements, 8 MB
SKETCH_BLOCK = 8192  # sketches of one side of a comparison
TIES = 1_000_000  # signatures that a task contracts at once
COLUMNS = 4096  # elements of one matrix product

_U = np.uint64


def _mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x + _U((0x9E3779B97F4A7C15 * (2 * salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct n-grams of a document's word hashes."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    out = np.zeros(len(hashes) - n + 1, dtype=_U)
    for k in range(n):
        out = _mixed(out * _U(3) + hashes[k : len(hashes) - n + 1 + k], k)
    return np.unique(out)


def difference_bound(a: int, b: int, percent: int) -> int:
    """The most elements two sets of these sizes and that similarity differ in."""
    return (100 - percent) * (a + b) // (100 + percent)


def band_of(size: int, percent: int) -> tuple[int, int, int]:
    """Number of the size's band, and the largest size in it and in the next."""
    number, low = 0, 1
    while True:
        high = low * 100 // percent
        if size <= high:
            return number, high, (high + 1) * 100 // percent
        number, low = number + 1, high + 1


def _signatures_in(
    band: int, k: int, differences: int, elements: np.ndarray, spare: int, parts: int
) -> list[np.ndarray]:
    """Signatures of one set in one band, whose partners there differ from it in at most `differences` elements."""
    spare = min(spare, k)
    groups = -(-(k + 1) // (spare + 1))
    parts = parts if spare else 1
    out = []
    for split in range(SPLITS if k < CERTAIN else 1):
        last = k < CERTAIN and split == SPLITS - 1
        scrambled = _mixed(elements, 101 + split)
        cell = ((scrambled >> _U(11)) % _U(groups * parts)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        starts = np.searchsorted(cell[order], np.arange(groups * parts + 1))
        sums = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(_mixed(scrambled[order], 7), dtype=_U)])
        content = (sums[starts[1:]] - sums[starts[:-1]]).reshape(groups, parts)
        filled = np.diff(starts).reshape(groups, parts)
        # Fewer differences than these leave a filled subset untouched in one of the groups so far.
        needed = np.full(groups, spare + 1) if last else np.minimum((filled > 0).sum(axis=1), spare + 1)
        needed = np.cumsum(needed)
        sent = min(int(np.searchsorted(needed, differences, side="right")) + 1, groups)
        content, filled = content[:sent], filled[:sent]
        for subset in _subsets(parts, spare):
            tag = _U((band * 64 + split) * 64 + sum(1 << p for p in subset))
            value = np.zeros(sent, dtype=_U)
            for part in subset:
                value = _mixed(value + content[:, part], part)
            value = _mixed(value ^ _mixed(np.arange(sent, dtype=_U) * _U(4096 * 4096) + tag, 3), 5)
            out.append(value if last else value[filled[:, list(subset)].sum(axis=1) > 0])
        if needed[-1] > differences:
            break
    return out


def _subsets(parts: int, spare: int) -> list[tuple[int, ...]]:
    from itertools import combinations

    return list(combinations(range(parts), parts - spare if parts > 1 else 1))


def banded_signatures(
    elements: np.ndarray, percent: int, spare: int = GROUP_SPARE, parts: int = GROUP_PARTS
) -> Iterator[tuple[int, np.ndarray]]:
    """(band, signatures) of a set in its own band and, if partners of it reach there, in the next one."""
    size, largest = len(elements), len(elements) * 100 // percent
    band, *highs = band_of(size, percent)
    for number, high in enumerate(highs, band):
        if number > band and largest <= highs[0]:
            return
        differences = difference_bound(size, min(high, largest), percent)
        found = _signatures_in(number, difference_bound(high, high, percent), differences, elements, spare, parts)
        yield number, np.unique(np.concatenate(found))


def signatures(elements: np.ndarray, percent: int, spare: int = GROUP_SPARE, parts: int = GROUP_PARTS) -> np.ndarray:
    """All signatures of a set."""
    return np.concatenate([found for _, found in banded_signatures(elements, percent, spare, parts)])


def sketch(elements: np.ndarray, high: int) -> np.ndarray:
    """Parities of the elements by hash, a bit for each element of a set of `high` or more."""
    width = 1 << max(6, (high - 1).bit_length())
    bits = np.bincount((_mixed(elements, 33) & _U(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).view(_U)


def banded_sketches(elements: np.ndarray, percent: int) -> list[np.ndarray]:
    """band, size and sketch of a set in its own band and, if partners of it reach there, in the next one."""
    size = len(elements)
    band, *highs = band_of(size, percent)
    if size * 100 // percent <= highs[0]:
        highs = highs[:1]
    return [np.concatenate([np.array([n, size], dtype=_U), sketch(elements, high)]) for n, high in enumerate(highs, band)]


def _sets(batch: pa.RecordBatch, column: int, n: int) -> Iterator[np.ndarray]:
    """The n-gram set of each row of a column of word hashes."""
    lists = batch.column(column)
    values = np.asarray(lists.flatten()).view(_U)
    ends = np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))
    begin = 0
    for end in ends:
        yield shingles(values[begin:end], n)
        begin = end


def _class_of(elements: np.ndarray) -> int:
    """A name for a set: the same for equal sets, else different but for hash collisions."""
    total = _mixed(np.array([elements.sum(dtype=_U), np.bitwise_xor.reduce(_mixed(elements, 9)), _U(len(elements))]), 11)
    return int(_mixed(np.array([total[0] * _U(3) ^ total[1] * _U(5) ^ total[2]]), 13).view(np.int64)[0])


def hashed_words(docs: DataFrame) -> DataFrame:
    """doc_id, the hashes of its words, A-Z lower-cased, and key, a hash of its text."""
    found = F.transform(words(lower_ascii(text_of(docs))), lambda w: F.xxhash64(w))
    return docs.select("doc_id", found.alias("hashes"), F.xxhash64("text").alias("key"))


def classes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, key, n_shingles, class (null for an empty set) and the class's sketches for every row."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, sketches = [], [], []
            for elements in _sets(batch, 1, n):
                sizes.append(len(elements))
                names.append(_class_of(elements) if len(elements) else None)
                sketches.append([s.view(np.int64) for s in banded_sketches(elements, percent)] if len(elements) else [])
            made = [pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.array(sketches, pa.list_(pa.list_(pa.int64())))]
            yield pa.record_batch([batch.column(0), batch.column(2), *made], names=["doc_id", "key", "n_shingles", "class", "sketches"])

    return hashed_words(docs).mapInArrow(of, "doc_id long, key long, n_shingles long, class long, sketches array<array<long>>")


def signature_rows(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(signature, class, band) of the least class a task finds under a signature; for the others (class, band, least).

    A class's signatures are made once per task that meets it, and contracted `TIES` at a time.
    """

    def contracted(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        found, owner, band = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(found)
        starts = np.flatnonzero(np.append(True, found[order[1:]] != found[order[:-1]]))
        least = np.empty_like(owner)
        least[order] = np.repeat(np.minimum.reduceat(owner[order], starts), np.diff(np.append(starts, len(found))))
        tied = owner != least
        # In the order of their classes, in which rows compress best.
        sent = [pa.array(c[~tied]) for c in (found.view(np.int64), owner, band)]
        yield pa.record_batch([*sent, pa.nulls(len(sent[0]), pa.int64())], names=["signature", "class", "band", "least"])
        if tied.any():
            star = _star(least[tied], owner[tied], band[tied])
            columns = [pa.nulls(star.num_rows, pa.int64()), star.column(1), star.column(2), star.column(0)]
            yield pa.record_batch(columns, names=["signature", "class", "band", "least"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, rows = [], 0
        for batch in batches:
            for elements in _sets(batch, 1, n):
                name = _class_of(elements) if len(elements) else None
                if name is not None and name not in seen:
                    seen.add(name)
                    for band, made in banded_signatures(elements, percent):
                        held.append((made, np.full(len(made), name, dtype=np.int64), np.full(len(made), band, dtype=np.int32)))
                        rows += len(made)
                    if rows >= TIES:
                        yield from contracted(held)
                        held, rows = [], 0
        if rows:
            yield from contracted(held)

    return hashed_words(docs).mapInArrow(of, "signature long, class long, band int, least long")


def _star(least: np.ndarray, other: np.ndarray, band: np.ndarray) -> pa.RecordBatch:
    """The same connections within each band, as stars around the least class."""
    columns = []
    for now in np.unique(band):
        here = band == now
        nodes, ends = np.unique(np.concatenate([least[here], other[here]]), return_inverse=True)
        x, y = ends[: here.sum()], ends[here.sum() :]
        label, before = np.arange(len(nodes)), None
        while before is None or not np.array_equal(label, before):
            before = label.copy()
            low = np.minimum(label[x], label[y])
            for end in (x, y):
                np.minimum.at(label, before[end], low)
                np.minimum.at(label, end, low)
            label = label[label]
        moved = label != np.arange(len(nodes))
        columns.append((nodes[label[moved]], nodes[moved], np.full(moved.sum(), now, dtype=np.int32)))
    return pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*columns)], names=["least", "class", "band"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ties (least, class, band) of a task, `TIES` at a time, each as stars."""
    held, rows = [], 0
    for batch in batches:
        held.append([np.asarray(batch.column(c)) for c in range(3)])
        rows += batch.num_rows
        if rows >= TIES:
            yield _star(*(np.concatenate(c) for c in zip(*held)))
            held, rows = [], 0
    if rows:
        yield _star(*(np.concatenate(c) for c in zip(*held)))


def families(rows: DataFrame) -> DataFrame:
    """(class, band, family) of the classes that share a signature with another; a class may be in one family per band.

    Families do not chain from band to band: what is tied is a class within a band.
    Tasks contract their ties before these are shuffled, so a signature has a row per task at most.
    """
    met = Window.partitionBy(F.coalesce("signature", F.xxhash64("class", "least")))
    tied = rows.select(F.coalesce("least", F.min("class").over(met)).alias("least"), "class", "band").where("least <> class")
    tied = tied.mapInArrow(_stars, "least long, class long, band int").distinct()
    tied = keep(tied)
    stars = tied.select(F.xxhash64("least", "band").alias("a"), F.xxhash64("class", "band").alias("b"))
    members = tied.select("class", "band").union(tied.select("least", "band")).distinct()
    named = components(stars).select("node", F.col("component").alias("family"))
    return members.withColumn("node", F.xxhash64("class", "band")).join(named, "node").select("class", "band", "family")


def _stars_of(rows: int, count: int, near_to: Callable[[int], np.ndarray]) -> list[tuple[int, int]]:
    """The links that `near_to` finds for each of the first `rows` of `count` members, as a star per component."""
    component = np.arange(count)
    for i in range(rows):
        near = near_to(i)
        met = np.unique(component[near])
        if len(met) > (component[i] in met):
            component[np.isin(component, met)] = component[i]
    _, first, member = np.unique(component, return_index=True, return_inverse=True)
    return [(int(first[c]), int(i)) for i, c in enumerate(member) if first[c] != i]


def _near_sketches(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """Stars that connect what the pairs do whose sketches, as (size, bits), leave them a chance to be similar."""
    both = np.stack(left if right is None else [*left, *right])
    sizes, bits = both[:, 0].astype(np.int64), np.ascontiguousarray(both[:, 1:])
    rows = len(left)

    def near_to(i: int) -> np.ndarray:
        low, high = (0, i) if right is None else (rows, len(bits))
        differing = np.bitwise_count(bits[low:high] ^ bits[i]).sum(axis=1, dtype=np.int64)
        return low + np.flatnonzero(differing <= (100 - percent) * (sizes[low:high] + sizes[i]) // (100 + percent))

    return _stars_of(rows, len(bits), near_to)


def _compared(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """Stars that connect what the links do among the left sets, or between left and right ones (right indices follow)."""
    sets = left if right is None else [*left, *right]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, element, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[element] > 1
    owner, element = owner[shared], element[shared]
    _, element = np.unique(element, return_inverse=True)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    rows = len(left)
    common = np.zeros((rows, len(sets) if right is None else len(right)), dtype=np.float32)
    for begin in range(0, int(element.max()) + 1 if len(element) else 0, COLUMNS):
        inside = (element >= begin) & (element < begin + COLUMNS)
        grid = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        grid[owner[inside], element[inside] - begin] = 1
        common += grid[:rows] @ (grid if right is None else grid[rows:]).T
    other = sizes if right is None else sizes[rows:]
    both = common.astype(np.int64)
    linked = 100 * both >= percent * (sizes[:rows, None] + other[None, :] - both)
    if right is None:
        linked &= np.tri(rows, k=-1, dtype=bool)
    begin = 0 if right is None else rows
    return _stars_of(rows, len(sets), lambda i: begin + np.flatnonzero(linked[i]))


def _links(sets: DataFrame, percent: int, compared: Callable = _compared) -> DataFrame:
    """Links (a, b) between classes, from (family, blocks, class, elements); `compared` finds them within two blocks."""
    blocks = F.col("blocks")
    here = F.pmod(F.xxhash64("class"), blocks)
    pairs = F.transform(
        F.sequence(F.lit(0).cast("bigint"), blocks - 1),
        lambda there: F.struct(F.least(here, there).alias("i"), F.greatest(here, there).alias("j")),
    )
    spread = sets.select("family", "class", "elements", here.alias("block"), F.explode(pairs).alias("pair"))
    keyed = spread.select("family", "pair.i", "pair.j", "block", "class", "elements")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, names = None, [], set()

        def finish() -> pa.RecordBatch | None:
            left = [row for row in held if row[0] == key[1]]
            right = [row for row in held if row[0] != key[1]] if key[1] != key[2] else None
            if right is not None and not (left and right):
                return None
            both = left + (right or [])
            found = compared([r[2] for r in left], right and [r[2] for r in right], percent) if len(both) > 1 else []
            if not found:
                return None
            ends = [[both[pair[side]][1] for pair in found] for side in (0, 1)]
            return pa.record_batch([pa.array(e, pa.int64()) for e in ends], names=["a", "b"])

        for batch in batches:
            family, i, j, block, name = (batch.column(c).to_pylist() for c in range(5))
            values = np.asarray(batch.column(5).flatten()).view(_U)
            ends = np.cumsum(np.asarray(batch.column(5).value_lengths()))
            for at, end in enumerate(ends):
                now = (family[at], i[at], j[at])
                if now != key:
                    if held and (out := finish()) is not None:
                        yield out
                    key, held, names = now, [], set()
                if name[at] not in names:
                    names.add(name[at])
                    begin = ends[at - 1] if at else 0
                    held.append((block[at], name[at], values[begin:end].copy()))
        if held and (out := finish()) is not None:
            yield out

    grouped = keyed.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
    return grouped.mapInArrow(compare, "a long, b long")


def grouped_rows(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, key, n_shingles, class, _group (null for an empty set) for every row of docs; see `join_components`."""

    slim = docs.select("doc_id", "text")

    def elements_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(class, elements) of the sets, once per task that meets a class."""
        seen: set[int] = set()
        for batch in batches:
            sets, names = [], []
            for elements in _sets(batch, 1, n):
                name = _class_of(elements) if len(elements) else None
                if name is not None and name not in seen:
                    seen.add(name)
                    sets.append(elements)
                    names.append(name)
            if sets:
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = pa.array(np.concatenate(sets).view(np.int64))
                columns = [pa.array(names, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), flat)]
                yield pa.record_batch(columns, names=["class", "elements"])

    named = keep(classes(slim, n, percent))
    tied = keep(families(signature_rows(slim, n, percent)))
    firsts = named.join(tied.select("class").distinct(), "class").groupBy("class")
    firsts = keep(firsts.agg(F.min("doc_id").alias("_id"), F.max("n_shingles").alias("size"), F.first("sketches").alias("sketches")))
    sized = firsts.select("class", "size")
    sketches = firsts.select("class", F.explode("sketches").alias("sketch")).select(
        "class", F.get("sketch", F.lit(0)).cast("int").alias("band"), F.slice("sketch", 2, F.size("sketch") - 1).alias("elements")
    )
    owners = tied.join(_blocks(tied.join(sized, "class"), SKETCH_BLOCK, 64 * BLOCK_ELEMENTS), "family")
    near = _links(sketches.join(broadcast_if_small(keep(owners)), ["class", "band"]), percent, _near_sketches)
    kin = keep(components(near).select(F.col("node").alias("class"), F.col("component").alias("family")))
    chosen = broadcast_if_small(keep(firsts.join(kin, "class").select("_id").distinct()))
    texts = slim.join(chosen, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    found = hashed_words(texts).mapInArrow(elements_of, "class long, elements array<long>")
    # A set is the largest row here: it is shuffled once, to its kin, where tasks leave out what they hold already.
    owners = kin.join(_blocks(kin.join(sized, "class"), BLOCK, BLOCK_ELEMENTS), "family")
    links = _links(found.join(broadcast_if_small(keep(owners)), "class"), percent)
    linked = components(links).select(F.col("node").alias("class"), F.col("component").alias("_group"))
    every = named.select("doc_id", "key", "n_shingles", "class")
    return every.join(linked, "class", "left").withColumn("_group", F.coalesce("_group", "class"))


def _blocks(members: DataFrame, rows: int, elements: int) -> DataFrame:
    """family and the number of blocks it is split into, from (family, size)."""
    count = F.greatest(F.ceil(F.count(F.lit(1)) / rows), F.ceil(F.sum("size") / elements))
    return members.groupBy("family").agg(count.alias("blocks"))


def join_components(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs; linked when 100 * common >= percent * union."""
    grouped = grouped_rows(docs, n, percent)
    grouped = keep(grouped)
    # Saved, so that both sides of the join are shuffles, of which adaptive execution splits a hot group.
    least = keep(grouped.where("class is not null").groupBy("_group").agg(F.min("doc_id").alias("component_id")))
    return grouped.join(least, "_group", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """One row of each component, with its own columns: the first by id, null ids last, and then by text.

    Every row whose set is empty stays. Rows are told apart by id and text; where several rows of a
    component have its least id, the first text is a partial minimum, so no component is gathered.
    """
    grouped = keep(grouped_rows(docs.select("doc_id", "text"), n, percent).where("class is not null"))
    least = grouped.groupBy("_group").agg(F.min("doc_id").alias("_least"))
    judged = grouped.join(least, "_group").select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "_group",
        F.col("doc_id").eqNullSafe(F.col("_least")).alias("_first"),
    )
    judged = keep(judged)
    several = judged.where("_first").groupBy("_group").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    ties = keep(judged.where("_first").join(several, "_group").select("_id", "_key", "_group").distinct())
    leaving = keep(judged.where("not _first").select("_id", "_key").distinct().union(ties.select("_id", "_key")))

    def same(marked: DataFrame) -> Column:
        return docs["doc_id"].eqNullSafe(marked["_id"]) & (F.xxhash64(docs["text"]) == marked["_key"])

    leaving, ties = broadcast_if_small(leaving), broadcast_if_small(ties)
    firsts = docs.join(ties, same(ties)).select("_group", *(docs[name] for name in docs.columns)).groupBy("_group")
    firsts = firsts.agg(F.min_by(F.struct(*docs.columns), "text").alias("_row")).select("_row.*")
    return docs.join(leaving, same(leaving), "left_anti").union(firsts)
