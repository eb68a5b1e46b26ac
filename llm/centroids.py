"""Dimension-sharded Lloyd clustering: no task ever needs a whole vector or a whole centroid.

Vectors are quantised to integers and laid out once, in chunks of ``CHUNK_ROWS`` rows by blocks of columns; a shard is
one block of one chunk.  A round has two steps.  The tasks of each block compute exact partial squared distances of
their rows against their slice of the centroids, ``reduceByKey`` adds the blocks of a chunk, and the sum gives every row
its nearest centroid, the smaller number in a tie.  The labels, a byte or two a row, go back to the shards of the chunk,
which are dealt out already and stay where they are; each block sums its columns by label and sets its own slice of the
new centroids to the exact floor of sum over count.  Only slices, clusters x columns numbers, pass the driver.

Arithmetic is in 64-bit integers within a chunk and in unbounded integers where chunks are added.  Chunks have equal
sizes whatever the data, so many equal vectors make no task larger.  Shards and labels are recomputed from the stored
layout if an executor is lost.  What is shuffled is laid out by byte planes, so that the shuffle's compression removes
high bytes of small numbers: about 3 bytes a row, block and centroid in each round.

Defined cases: vectors of another length, NULL vectors, and those with a NULL or non-finite component are not kept;
repeated rows and ids are vectors of their own; a NULL id is hashed as the empty string; with fewer kept vectors than
clusters each vector is a first centroid; a centroid without vectors stays; without kept vectors the result is empty;
components of which the squared distance could leave 64 bits raise an error; columns other than the id and the vector are
not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import partitions, stored

DIMS, CLUSTERS, ROUNDS, SEED = 64, 8, 10, 3
SCALE = 1024
BLOCKS = 4
CHUNK_ROWS = 4096

_LAYOUT = "chunk long, block int, ids array<long>, part binary"
_RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def pack(numbers: np.ndarray) -> bytes:
    """Integers in the narrowest of 2, 4 or 8 bytes, byte plane by byte plane."""
    most = int(np.abs(numbers).max(initial=0))
    width = next(w for w in (2, 4, 8) if most < 1 << (8 * w - 1))
    planes = np.ascontiguousarray(numbers, f"<i{width}").reshape(-1).view(np.uint8).reshape(-1, width).T
    return bytes([width]) + planes.tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<i{width}").reshape(-1).astype(np.int64)


def _sound(vector: Column, dims: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def kept(vectors: DataFrame, dims: int = DIMS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(vec_id, vector)`` of the vectors that take part."""
    vector = F.col(vector_column).cast("array<double>")
    narrow = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector"))
    return narrow.where(_sound(F.col("vector"), dims))


def quantised(values: np.ndarray, scale: float) -> np.ndarray:
    numbers = np.floor(values * scale)
    if numbers.size and np.abs(numbers).max() > np.sqrt((1 << 61) / numbers.shape[1]):
        raise ValueError("a component is too large for squared distances of 64 bits")
    return numbers.astype(np.int64)


def _laid_out(dims: int, blocks: int, scale: float, chunk_rows: int):
    """Chunks of a partition's vectors: their ids under block -1, and one shard per block."""
    cuts = np.linspace(0, dims, blocks + 1).astype(int)

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, len(batch), chunk_rows):
                part = batch.slice(at, chunk_rows)
                numbers = quantised(part["vector"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dims), scale)
                shards = [pack(numbers[:, a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.record_batch(
                    {
                        "chunk": pa.array([chunk] * (blocks + 1), pa.int64()),
                        "block": pa.array([-1, *range(blocks)], pa.int32()),
                        "ids": pa.array([part["vec_id"].to_pylist()] + [None] * blocks, pa.list_(pa.int64())),
                        "part": pa.array([None, *shards], pa.binary()),
                    }
                )
                chunk += 1

    return lay


def partial_distances(shard: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, centroids x rows, over the columns of one block."""
    squares = (shard * shard).sum(1) - 2 * (centroids @ shard.T)
    return squares + (centroids * centroids).sum(1)[:, None]


class Lloyd:
    """The dealt-out shards, and the two steps of a round over them."""

    def __init__(self, layout: DataFrame, blocks: int, tasks: int):
        self.blocks, self.tasks = blocks, tasks
        rows = layout.where("block >= 0").select("chunk", "block", "part").rdd
        self.shards = rows.map(lambda r: ((r[0], r[1]), bytes(r[2]))).partitionBy(tasks)

    def distances(self, slices: list[np.ndarray]) -> RDD:
        """Per chunk the distances of its rows from all centroids, packed."""

        def partial(shard):
            (chunk, block), part = shard
            columns = slices[block].shape[1]
            return chunk, pack(partial_distances(unpack(part).reshape(-1, columns), slices[block]))

        return self.shards.map(partial).reduceByKey(lambda a, b: pack(unpack(a) + unpack(b)), self.tasks)

    def labels(self, slices: list[np.ndarray]) -> RDD:
        k = len(slices[0])
        return self.distances(slices).mapValues(lambda d: pack(unpack(d).reshape(k, -1).argmin(0)))

    def updated(self, slices: list[np.ndarray]) -> list[np.ndarray]:
        """The slices after every vector went to its nearest centroid."""
        k, blocks = len(slices[0]), self.blocks

        def sums(pair):
            (_, block), (part, packed) = pair
            label, numbers = unpack(packed), unpack(part).reshape(-1, slices[block].shape[1])
            member = (label == np.arange(k)[:, None]).astype(np.int64)
            return block, ((member @ numbers).astype(object), member.sum(1).astype(object))

        def means(entry):
            block, (total, count) = entry
            new = [t // c if c else old for t, c, old in zip(total, count, slices[block], strict=True)]
            return block, np.array([[int(x) for x in row] for row in new], np.int64)

        to_shards = self.labels(slices).flatMap(lambda e: [((e[0], b), e[1]) for b in range(blocks)])
        member_sums = self.shards.join(to_shards.partitionBy(self.tasks), self.tasks).map(sums)
        found = dict(member_sums.reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), blocks).map(means).collect())
        return [found[b] for b in range(blocks)]


def centroid_sha256(centroids: np.ndarray) -> list[str]:
    return [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]


def lloyd(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS,
    scale: float = SCALE, blocks: int = BLOCKS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per kept row, of ``(vec_id, vector)``."""
    spark = vectors.sparkSession
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.orderBy(name, "vector").limit(clusters).select("vector").collect()
    if not first:
        return spark.createDataFrame([], _RESULT)
    centroids = quantised(np.array([r[0] for r in first], np.float64), scale)
    layout = stored(vectors.mapInArrow(_laid_out(dims, blocks, scale, chunk_rows), _LAYOUT), "shards")
    state = Lloyd(layout, blocks, max(partitions(spark), layout.rdd.getNumPartitions()))
    slices = _slices(centroids, blocks)
    for _ in range(rounds):
        slices = state.updated(slices)
    return _result(state, layout, slices)


def _slices(centroids: np.ndarray, blocks: int) -> list[np.ndarray]:
    cuts = np.linspace(0, centroids.shape[1], blocks + 1).astype(int)
    return [centroids[:, a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _result(state: Lloyd, layout: DataFrame, slices: list[np.ndarray]) -> DataFrame:
    spark, k = layout.sparkSession, len(slices[0])

    def nearest(packed: bytes):
        far = unpack(packed).reshape(k, -1)
        return bytearray(pack(far.argmin(0))), bytearray(pack(far.min(0)))

    rows = state.distances(slices).map(lambda e: (e[0], *nearest(e[1])))
    assigned = stored(spark.createDataFrame(rows, "chunk long, label binary, far binary", verifySchema=False), "assigned")

    def inertia(row):
        label, far = unpack(bytes(row[0])), unpack(bytes(row[1])).astype(object)
        return np.array([sum(far[label == c]) for c in range(k)], object)

    per_cluster = [int(x) for x in assigned.select("label", "far").rdd.map(inertia).treeReduce(add)]
    digests = pa.array(centroid_sha256(np.concatenate(slices, axis=1)))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inertias = pa.array(per_cluster, pa.int64())
        for batch in batches:
            for ids, label, far in zip(batch["ids"], batch["label"], batch["far"], strict=True):
                cluster = pa.array(unpack(label.as_py()))
                yield pa.record_batch(
                    {
                        "vec_id": ids.values,
                        "cluster": cluster.cast(pa.int32()),
                        "distance": pa.array(unpack(far.as_py())),
                        "cluster_inertia": inertias.take(cluster),
                        "inertia": pa.array([sum(per_cluster)] * len(cluster), pa.int64()),
                        "centroid_sha256": digests.take(cluster),
                    }
                )

    return layout.where("block = -1").select("chunk", "ids").join(assigned, "chunk").mapInArrow(rows_of, _RESULT)


def op12(embeddings: DataFrame) -> DataFrame:
    return lloyd(kept(embeddings))


def _oracle() -> str:
    """Ten rounds written out; exact floors by remainders."""
    far = "sum((v.x - c.x) * (v.x - c.x))"
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
  SELECT row, min_by(k, (far, k)) AS k, min(far) AS far
  FROM (SELECT v.row, c.k, {far} AS far FROM parts v JOIN c{r} c USING (i) GROUP BY v.row, c.k) GROUP BY row)"""
        )
        if r < ROUNDS:
            steps.append(
                f"""c{r + 1} AS MATERIALIZED (
  SELECT c.k, c.i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT k, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
    FROM parts JOIN a{r} USING (row) GROUP BY k, i) m USING (k, i))"""
            )
    last = ROUNDS
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, embedding AS v FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
parts AS MATERIALIZED (
  SELECT row, i, CAST(floor({SCALE} * CAST(v[i] AS DOUBLE)) AS BIGINT) AS x FROM kept, range(1, {DIMS + 1}) t(i)),
firsts AS (
  SELECT row, row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS k FROM kept
  QUALIFY k < {CLUSTERS}),
c0 AS MATERIALIZED (SELECT k, i, x FROM firsts JOIN parts USING (row)),
{", ".join(steps)},
digests AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{last} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(far AS BIGINT) AS distance,
  CAST(sum(far) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(far) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{last} JOIN kept USING (row) JOIN digests USING (k)
"""


ORACLE = _oracle()
