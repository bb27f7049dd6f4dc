"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine checks.

Unit vectors of cosine 0.98 lie at most 0.2 apart. A hash is the floor of a
Gaussian projection, shifted at random and divided by a width; a table's key joins
several, so far vectors rarely share a key and near ones share one in some table.

1. Equal vectors of a label are one class with a count (partial sums).
2. Each class gets a key per table; keys held by one class only are dropped.
3. Buckets are split into blocks by a hash of the class; pairs of blocks meet in
   different tasks. All cosines of a pair of blocks are one matrix product in
   double precision; a pair counts in the first table where it meets. Only sums of
   links per class and a spanning forest of them leave the task.
4. Links are added up, the forest gives the components.

With the settings here two vectors of cosine 0.98 meet with a chance above 0.998,
of 0.99 above 0.99999. Defined results: null, zero and non-finite vectors, and all with
a null label, link with nothing; vectors of different lengths have no cosine and
do not link; repeated ids are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import keep

COSINE = 0.98
TABLES = 32
PROJECTIONS = 12
WIDTH = 1.6
SEED = 20
BLOCK = 512


def _family(dimension: int, tables: int, projections: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([seed, dimension])
    return random.standard_normal((dimension, tables * projections)), random.uniform(0, width, tables * projections)


def table_keys(vectors: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """One 64-bit key per unit vector and table."""
    directions, shifts = _family(vectors.shape[1], tables, projections, width, seed)
    cells = np.floor((vectors @ directions + shifts) / width).astype(np.int64).view(np.uint64)
    cells = cells.reshape(len(vectors), tables, projections)
    keys = np.zeros((len(vectors), tables), dtype=np.uint64)
    for p in range(projections):
        keys = (keys ^ cells[:, :, p]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _usable(vector: list[float]) -> np.ndarray | None:
    """The unit vector in double precision, scaled first so that squares stay finite."""
    values = np.array(vector, dtype=np.float64)
    top = np.abs(values).max(initial=0.0)
    if not np.isfinite(top) or top == 0:
        return None
    values = values / top
    return values / np.sqrt(values @ values)


def _with_keys(tables: int, projections: int, width: float, seed: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, vectors = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            units = [None if v is None or None in v else _usable(v) for v in vectors]
            by_size: dict[int, list[int]] = {}
            for at, unit in enumerate(units):
                if unit is not None:
                    by_size.setdefault(len(unit), []).append(at)
            for rows in by_size.values():
                stack = np.stack([units[at] for at in rows])
                keys = table_keys(stack, tables, projections, width, seed)
                columns = [
                    pa.array([names[at] for at in rows], pa.int64()),
                    pa.array(list(stack), pa.list_(pa.float64())),
                    pa.array(list(keys), pa.list_(pa.int64())),
                ]
                yield pa.record_batch(columns, names=["class", "unit", "keys"])

    return make


def _meet(least_cosine: float):
    """Links among the rows of each (label, size, table, key, i, j), which arrive together."""

    def links(rows: list[tuple], i: int, j: int, table: int) -> tuple[dict[int, int], list[tuple[int, int]]]:
        left = [r for r in rows if r[0] == i]
        right = left if i == j else [r for r in rows if r[0] != i]
        if not left or not right or (i == j and len(left) < 2):
            return {}, []
        cosines = np.stack([r[3] for r in left]) @ np.stack([r[3] for r in right]).T
        linked = cosines >= least_cosine
        if i == j:
            linked &= np.tri(len(left), k=-1, dtype=bool)
        a, b = np.nonzero(linked)
        if not len(a):
            return {}, []
        keys, others = np.stack([r[4] for r in left]), np.stack([r[4] for r in right])
        first = ~(keys[a][:, :table] == others[b][:, :table]).any(axis=1)
        a, b = a[first], b[first]
        counts: dict[int, int] = {}
        weights = np.array([r[2] for r in left]), np.array([r[2] for r in right])
        for at, total in enumerate(np.bincount(a, weights[1][b], len(left)).astype(np.int64)):
            counts[left[at][1]] = int(total)
        for at, total in enumerate(np.bincount(b, weights[0][a], len(right)).astype(np.int64)):
            counts[right[at][1]] = counts.get(right[at][1], 0) + int(total)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        forest = []
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = left[x][1], right[y][1]
            if (u := root(p)) != (v := root(q)):
                parent[u] = v
                forest.append((p, q))
        return {c: n for c, n in counts.items() if n}, forest

    def batch_of(counts: dict[int, int], forest: list[tuple[int, int]]) -> pa.RecordBatch:
        a = list(counts) + [p for p, _ in forest]
        b = [None] * len(counts) + [q for _, q in forest]
        n = list(counts.values()) + [None] * len(forest)
        return pa.record_batch([pa.array(x, pa.int64()) for x in (a, b, n)], names=["a", "b", "n"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            table, bucket, i, j, block, name, weight, label, size = (batch.column(c).to_pylist() for c in range(9))
            units = batch.column(9).to_numpy(zero_copy_only=False)
            keys = batch.column(10).to_numpy(zero_copy_only=False)
            for at in range(batch.num_rows):
                now = (label[at], size[at], table[at], bucket[at], i[at], j[at])
                if now != key:
                    if len(held) > 1:
                        yield batch_of(*links(held, key[4], key[5], key[2]))
                    key, held = now, []
                held.append((block[at], name[at], weight[at], units[at], keys[at]))
        if len(held) > 1:
            yield batch_of(*links(held, key[4], key[5], key[2]))

    return meet


def near_duplicates(
    vectors: DataFrame,
    least_cosine: float = COSINE,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    seed: int = SEED,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding, label)."""
    slim = keep(
        vectors.select(
            F.monotonically_increasing_id().alias("row"), "vec_id", F.col("embedding").alias("embedding"), "label"
        )
    )
    grouped = slim.where("label is not null and embedding is not null").groupBy("label", "embedding").agg(
        F.min("row").alias("class"), F.count(F.lit(1)).alias("weight")
    )
    classes = keep(grouped)
    keyed = classes.select("class", "embedding").mapInArrow(
        _with_keys(tables, projections, width, seed), "class long, unit array<double>, keys array<long>"
    )
    hashed = keep(keyed.join(classes.select("class", "label", "weight"), "class"))
    size = F.size("unit").alias("size")
    slots = hashed.select("class", "label", size, F.posexplode("keys").alias("table", "bucket"))
    place = ["label", "size", "table", "bucket"]
    live = slots.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / BLOCK)
    here = F.pmod(F.xxhash64("class"), blocks)
    pairs = F.transform(
        F.sequence(F.lit(0).cast("bigint"), blocks - 1),
        lambda there: F.struct(F.least(here, there).alias("i"), F.greatest(here, there).alias("j")),
    )
    meeting = (
        slots.join(live, place)
        .select("class", *place[2:], here.alias("block"), F.explode(pairs).alias("_pair"))
        .join(hashed, "class")
        .select("table", "bucket", "_pair.i", "_pair.j", "block", "class", "weight", "label", size, "unit", "keys")
    )
    order = ["label", "size", "table", "bucket", "i", "j"]
    found = keep(
        meeting.repartition(*order).sortWithinPartitions(*order).mapInArrow(_meet(least_cosine), "a long, b long, n long")
    )
    links = found.where("n is not null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("_near"))
    tied = components(found.where("b is not null").select("a", "b")).withColumnsRenamed(
        {"node": "class", "component": "_group"}
    )
    member = (
        hashed.select("class", "label", "weight")
        .join(links, "class", "left")
        .join(tied, "class", "left")
        .withColumn("_group", F.coalesce("_group", "class"))
        .withColumn("_links", F.coalesce("_near", F.lit(0)) + F.col("weight") - 1)
    )
    # Rows meet their class again by what defines it.
    named = classes.select(F.col("class"), F.col("label").alias("_label"), F.col("embedding").alias("_embedding"))
    same = (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding"))
    rows = slim.join(named, same, "left").join(member.select("class", "_group", "_links"), "class", "left")
    rows = keep(rows.select("row", "vec_id", "_group", "_links"))
    least = rows.where("_group is not null").groupBy("_group").agg(F.min("vec_id").alias("component_id"))
    return (
        rows.join(least, "_group", "left")
        .select(
            "vec_id",
            F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
