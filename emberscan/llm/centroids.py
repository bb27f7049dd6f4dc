"""Lloyd's clustering with the dimensions dealt over shards, in whole numbers.

Vectors are cut into blocks of `width` components, written once, a folder per block. In a round
each task takes rows of one block and the centroids' slices of that block alone, and computes
exact partial distances to all centroids. Partial distances are added by vector over the
blocks, a sum with map-side combining, and the least total names the cluster. Each block
then takes the vectors' clusters, sums its own components by cluster and moves its own
slice of the centroids. Vectors are whole numbers floor(scale * x), so no result depends on order.

The driver holds the centroids, number of clusters times dimensions, both parameters.
The squared distance of a vector fits 64 bits while scaled components stay below `LARGEST`;
sums over vectors are decimal.

Defined results: a vector takes part if it has exactly `dimensions` components, none null,
not finite or beyond `LARGEST` when scaled; others give no row. Rows that repeat an id are vectors of
their own; a null id takes part and comes last as a starting centroid, and equal ids are ordered
by their components. With fewer vectors than clusters there are fewer clusters; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .shared import keep

SEED = "1"
WIDTH = 32
LARGEST = 1 << 27


def scaled(vectors: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """vec_id and `v`, the whole-number components, of the vectors that take part."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    sound = F.forall("embedding", lambda x: F.coalesce(F.abs(F.lit(float(scale)) * x.cast("double")) < LARGEST, F.lit(False)))
    return vectors.where((F.size("embedding") == dimensions) & sound).select("vec_id", whole.alias("v"))


def starting_centroids(kept: DataFrame, clusters: int, seed: str = SEED) -> np.ndarray:
    """The vectors with the least digests of seed and id; a top-k, so `clusters` rows reach the driver."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(digest.asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([row["v"] for row in first], dtype=np.int64)


class Shards:
    """Vectors as rows (row, at): `at` is a slice of their components; a folder per block."""

    def __init__(self, kept: DataFrame, dimensions: int, width: int):
        self.spark = kept.sparkSession
        self.bounds = [(low, min(low + width, dimensions)) for low in range(0, dimensions, width)]
        blocks = F.array(*(F.struct(F.lit(b).alias("block"), F.slice("v", low + 1, high - low).cast("array<int>").alias("at"))
                           for b, (low, high) in enumerate(self.bounds)))
        path = scratch_path(self.spark, "shards")
        rows = kept.select("row", F.explode(blocks).alias("cut")).select("row", "cut.block", "cut.at")
        rows.write.partitionBy("block").parquet(path)
        self.frames = [self.spark.read.schema("row long, at array<int>").parquet(f"{path}/block={b}") for b in range(len(self.bounds))]

    def _partial(self, block: int, centroids: np.ndarray) -> DataFrame:
        """row and the partial distance p0, p1, ... to each centroid within a block."""
        low, high = self.bounds[block]
        slices = centroids[:, low:high]
        names = [f"p{c}" for c in range(len(slices))]

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.asarray(batch.column(1).flatten()).astype(np.int64).reshape(batch.num_rows, high - low)
                parts = [np.einsum("ij,ij->i", at - one, at - one) for one in slices]
                yield pa.record_batch([batch.column(0), *map(pa.array, parts)], names=["row", *names])

        return self.frames[block].mapInArrow(measure, "row long, " + ", ".join(f"{n} long" for n in names))

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """row, cluster, distance: partial distances added over the blocks, the first least one taken."""
        parts = self._partial(0, centroids)
        for block in range(1, len(self.bounds)):
            parts = parts.union(self._partial(block, centroids))
        count = len(centroids)
        totals = parts.groupBy("row").agg(*(F.sum(f"p{c}").alias(f"p{c}") for c in range(count)))
        every = F.array(*(F.col(f"p{c}") for c in range(count)))
        least = totals.select("row", every.alias("all"), F.array_min(every).alias("distance"))
        return least.select("row", (F.array_position("all", F.col("distance")) - 1).cast("int").alias("cluster"), "distance")

    def _moved(self, block: int, clusters: DataFrame, slices: np.ndarray) -> np.ndarray:
        """The block's slice of the centroids after a round; a sum per cluster and component reaches the driver."""
        low, high = self.bounds[block]
        width, count = high - low, len(slices)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((count, width), dtype=np.int64)
            sizes = np.zeros(count, dtype=np.int64)
            for batch in batches:
                at = np.asarray(batch.column(1).flatten()).astype(np.int64).reshape(batch.num_rows, width)
                cluster = np.asarray(batch.column(0))
                np.add.at(sums, cluster, at)
                sizes += np.bincount(cluster, minlength=count)
            here = np.flatnonzero(sizes)
            lists = pa.array(sums[here].tolist(), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(here, pa.int64()), pa.array(sizes[here]), lists], names=["cluster", "n", "sums"])

        added = self.frames[block].join(clusters, "row").select("cluster", "at").mapInArrow(add, "cluster long, n long, sums array<long>")
        each = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"c{i}") for i in range(width)]
        moved = slices.copy()
        for row in added.groupBy("cluster").agg(F.sum("n").alias("n"), *each).collect():
            moved[row["cluster"]] = [int(row[f"c{i}"]) // row["n"] for i in range(width)]
        return moved

    def step(self, centroids: np.ndarray) -> np.ndarray:
        clusters = keep(self.assigned(centroids).select("row", "cluster"))
        slices = [self._moved(b, clusters, centroids[:, low:high]) for b, (low, high) in enumerate(self.bounds)]
        return np.concatenate(slices, axis=1)


def cluster(vectors: DataFrame, clusters: int, rounds: int, dimensions: int, scale: int, width: int = WIDTH) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256 of every vector that takes part."""
    spark = vectors.sparkSession
    kept = keep(scaled(vectors, dimensions, scale).withColumn("row", F.monotonically_increasing_id()))
    centroids = starting_centroids(kept, clusters)
    final = "cluster int, centroid array<long>, centroid_sha256 string, cluster_inertia long, inertia long"
    out = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256"]
    if not len(centroids):
        return kept.select("vec_id", F.lit(0).cast("bigint").alias("distance"), F.from_json(F.lit(None), final).alias("_")).select(
            "vec_id", "distance", "_.*"
        ).select(*out)
    shards = Shards(kept, dimensions, width)
    for _ in range(rounds):
        centroids = shards.step(centroids)
    placed = keep(kept.select("vec_id", "row").join(shards.assigned(centroids), "row"))
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # A row per cluster: the centroids and their sums are bounded by the parameters.
    inertia = {row["cluster"]: row["cluster_inertia"] for row in sums.collect()}
    whole = sum(inertia.values())
    rows = [
        (c, at.tolist(), hashlib.sha256(",".join(map(str, at.tolist())).encode()).hexdigest(), inertia.get(c, 0), whole)
        for c, at in enumerate(centroids)
    ]
    named = spark.createDataFrame(rows, final)
    return placed.join(F.broadcast(named), "cluster").select(*out)
