"""Centroid clustering with exact results, and bounds that say which vectors need looking at.

Every round assigns each vector to its nearest centroid and moves each centroid to its
vectors' mean. A vector that was looked at keeps its centroid, its exact distance and a lower
bound of its distance to any other. When centroids move, that bound must be loosened by what
another centroid may have come nearer. The full drift of a centroid is the worst case of all
of space; here the vectors of a cluster lie in a sphere, and within the sphere geometry in
the plane of its centre and the drift gives less (:func:`approach`). Vectors whose bound still
holds keep their centroid; the ambiguous ones are scanned against all centroids.

Components are integers, so sums, means and distances are exact, and a round's sums are the
last ones plus what changed hands. Vectors are never exchanged. Each round is one pass over a
table of vectors and bounds; the table is written again only after rounds that scanned many
vectors, as bounds can be taken from the round they were last written in.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tokenloom.session import scratch_path, settle

#: A round that scanned one vector in so many makes the next one write the bounds again.
STALE = 8

#: Components up to this size have squared distances that doubles hold exactly.
_SMALL = 1 << 22
#: From this size on, squared distances leave 64 bits.
_LARGEST = 1 << 32
#: What rounding may add to a bound, as a share of the numbers that it is made from.
_ROUNDING = 1e-9

_TABLE = "id long, v array<long>, cluster int, distance long, others double"
_FACTS = "slot int, amount long, top double"


class Clustering(NamedTuple):
    """Rows (id, ``cluster``, ``distance`` squared to its centroid), and the final centroids."""

    rows: DataFrame
    centroids: list[list[int]]


def approach(before: np.ndarray, after: np.ndarray, centre: np.ndarray, radius: float) -> np.ndarray:
    """How much nearer each moved centroid can have come to any point of a sphere, at most.

    For a point x and a move from p to q with midpoint m, ``|x-p| - |x-q|`` is
    ``2 (x-m)(q-p) / (|x-p| + |x-q|)``, and the sum below is at least ``|q-p|`` and at least
    ``2 |x-m|``. By the first, it is at most twice as much as x lies beyond m along the move;
    by the second, at most the drift times the cosine of x's angle to the move, seen from m.
    In the plane of the move and the sphere's centre, the sphere reaches ``radius`` further
    along the move than its centre, and its smallest angle is the centre's less
    ``asin(radius / |centre-m|)``.
    """
    move = after - before
    drift = np.sqrt((move * move).sum(axis=1))
    out = np.zeros(len(drift))
    moving = np.flatnonzero(drift > 0)
    drift, offset = drift[moving], centre - (before[moving] + after[moving]) / 2
    far = np.sqrt((offset * offset).sum(axis=1))
    along = (offset * move[moving]).sum(axis=1) / drift
    beyond = 2 * (along + radius)
    angle = np.zeros(len(moving))
    out_of = far > radius
    angle[out_of] = np.arccos(np.clip(along[out_of] / far[out_of], -1, 1)) - np.arcsin(radius / far[out_of])
    turned = drift * np.cos(np.clip(angle, 0, np.pi / 2))
    slack = _ROUNDING * (drift + far + radius)
    out[moving] = np.minimum(drift, np.maximum(0, np.minimum(beyond, turned)) + slack)
    return out


class Model(NamedTuple):
    """What a round knows: a few numbers per centroid."""

    centroids: np.ndarray  # where they are now
    drift: np.ndarray  # how far each went since the bounds were written
    looser: np.ndarray  # for the vectors of each cluster, how much nearer another centroid may have come

    @classmethod
    def since(cls, written: np.ndarray, radius: np.ndarray, centroids: np.ndarray) -> Model:
        old, new = written.astype(np.float64), centroids.astype(np.float64)
        looser = np.zeros(len(new))
        for c in range(len(new)):
            near = approach(old, new, old[c], radius[c])
            near[c] = 0
            looser[c] = near.max()
        return cls(centroids, np.sqrt(((new - old) ** 2).sum(axis=1)) * (1 + _ROUNDING), looser)


def _squares(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, a column per centroid."""
    largest = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * largest * largest * vectors.shape[1] < 1 << 53 and largest < _SMALL:
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    columns = []
    for c in centroids.tolist():
        square = sum((vectors[:, d].astype(object) - c[d]) ** 2 for d in range(len(c)))
        if len(square) and max(square) >= 1 << 63:
            raise ValueError("a squared distance does not fit in 64 bits")
        columns.append(np.array(square, np.int64))
    return np.stack(columns, axis=1)


def _own_squares(vectors: np.ndarray, cluster: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of each vector to its own centroid."""
    out = np.zeros(len(vectors), np.int64)
    for c in np.unique(cluster):
        own = np.flatnonzero(cluster == c)
        out[own] = _squares(vectors[own], centroids[c : c + 1])[:, 0]
    return out


def _assign(vectors, cluster, distance, others, model: Model):
    """(cluster, distance, others, rows scanned): vectors against the centroids as they are now.

    ``cluster`` is -1 for vectors never scanned; ``distance`` of vectors left alone is kept.
    """
    seen = np.flatnonzero(cluster >= 0)
    upper, lower = np.full(len(cluster), np.inf), np.full(len(cluster), -np.inf)
    upper[seen] = np.sqrt(distance[seen].astype(np.float64)) * (1 + _ROUNDING) + model.drift[cluster[seen]]
    lower[seen] = others[seen] - model.looser[cluster[seen]]
    # first without the vector, then with the exact distance to its own centroid, then to all
    unsure = seen[upper[seen] >= lower[seen]]
    if len(unsure):
        upper[unsure] = np.sqrt(_own_squares(vectors[unsure], cluster[unsure], model.centroids).astype(np.float64)) * (1 + _ROUNDING)
    scan = np.flatnonzero(upper >= lower)
    cluster, distance = cluster.copy(), distance.copy()
    if len(scan):
        squares = _squares(vectors[scan], model.centroids)
        nearest = squares.argmin(axis=1)  # the first of equals
        rows = np.arange(len(scan))
        cluster[scan], distance[scan] = nearest, squares[rows, nearest]
        rest = squares.astype(np.float64)
        rest[rows, nearest] = np.inf
        lower[scan] = np.sqrt(rest.min(axis=1)) * (1 - _ROUNDING)
    return cluster, distance, lower, scan


def _changes(vectors, before, after, k: int) -> np.ndarray:
    """Per cluster, what its count and its sums gained."""
    out = np.zeros((k, vectors.shape[1] + 1), np.int64)
    changed = np.flatnonzero(before != after)
    for sign, side in ((1, after), (-1, before)):
        for c in np.unique(side[changed]):
            if c >= 0:
                rows = changed[side[changed] == c]
                out[c, 0] += sign * len(rows)
                out[c, 1:] += sign * vectors[rows].sum(axis=0)
    return out


def _columns(batch: pa.RecordBatch, dim: int):
    vectors = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return vectors, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "distance", "others"))


def _pass(model: Model, dim: int, write: bool):
    """A round over the vectors of a partition: the table's new rows if asked for, then the facts.

    Facts are (slot, amount, top): per cluster the gains of its count and sums and, of written
    rows, its radius; last the rows scanned and the rows there are.
    """
    k = len(model.centroids)

    def run(batches):
        gains, radius, scanned, count = np.zeros((k, dim + 1), np.int64), np.zeros(k), 0, 0
        for batch in batches:
            vectors, before, distance, others = _columns(batch, dim)
            after, distance, lower, scan = _assign(vectors, before, distance, others, model)
            gains += _changes(vectors, before, after, k)
            scanned, count = scanned + len(scan), count + len(before)
            if write:
                kept = np.ones(len(before), bool)
                kept[scan] = False
                kept = np.flatnonzero(kept)
                distance[kept] = _own_squares(vectors[kept], after[kept], model.centroids)
                np.maximum.at(radius, after, np.sqrt(distance.astype(np.float64)) * (1 + _ROUNDING))
                empty = [pa.nulls(len(before), t) for t in (pa.int32(), pa.int64(), pa.float64())]
                new = [pa.array(after, pa.int32()), pa.array(distance), pa.array(lower)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), *new, *empty], names)
        slots = np.flatnonzero(gains.ravel())
        facts = [(int(s), int(gains.ravel()[s]), None) for s in slots]
        facts += [(gains.size + c, 0, float(radius[c])) for c in range(k)]
        facts += [(gains.size + k, scanned, None), (gains.size + k + 1, count, None)]
        columns = [pa.array(c, t) for c, t in zip(zip(*facts), (pa.int32(), pa.int64(), pa.float64()))]
        empty = [pa.nulls(len(facts), t) for t in (pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.float64())]
        yield pa.RecordBatch.from_arrays([*empty, *columns], names)

    names = ["id", "v", "cluster", "distance", "others", "slot", "amount", "top"]
    return run


def _last_pass(model: Model, dim: int):
    """The assignment alone, with exact distances."""

    def run(batches):
        for batch in batches:
            vectors, before, distance, others = _columns(batch, dim)
            after = _assign(vectors, before, distance, others, model)[0]
            distance = _own_squares(vectors, after, model.centroids)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(after, pa.int32()), pa.array(distance)], ["id", "cluster", "distance"])

    return run


def cluster_vectors(
    vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dim: int = 64, scale: int = 1024,
    id_col: str = "vec_id", vector_col: str = "embedding", stale: int = STALE,
) -> Clustering:
    """Exact Lloyd rounds over vectors of ``dim`` numbers, each number x as ``floor(scale * x)``.

    Vectors that are NULL, of another length, or hold a NULL or non-finite number are left
    out. The centroids start as the ``k`` vectors of smallest sha256 of ``seed:id`` (all
    vectors, if there are fewer; ties by vector, a NULL id last). Equal distances go to the
    smaller number, means are floored, a centroid without vectors stays. After the rounds the
    vectors are assigned once more. Repeated rows are vectors of their own; other columns are
    ignored; an empty table has no rows and no centroids. Integers of 2**32 and more, whose
    squares leave 64 bits, fail the job.
    """
    spark = vectors.sparkSession
    numbers = F.col(vector_col).cast("array<double>")
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(F.coalesce((F.size(numbers) == dim) & finite, F.lit(False)))
    too_large = F.raise_error(F.concat(F.lit("component too large in vector "), F.coalesce(F.col(id_col).cast("string"), F.lit("NULL"))))
    whole = F.transform(numbers, lambda x: F.when(F.abs(x) * scale < _LARGEST, F.floor(x * scale)).otherwise(too_large.cast("long")))
    rows = kept.select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = [r["v"] for r in rows.orderBy(rank.asc_nulls_last(), "v").limit(k).select("v").collect()]
    if not first:
        return Clustering(rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0).withColumnRenamed("id", id_col), [])

    centroids = np.array(first, np.int64)
    sums = [[0] * (dim + 1) for _ in first]
    buffers = [scratch_path(spark, f"vectors-{i}") for i in (0, 1)]  # one is read while the other is written
    table = rows.select("id", "v", F.lit(-1).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0.0).alias("others"))
    written, radius, write = centroids, np.zeros(len(first)), True
    for number in range(rounds):
        model = Model.since(written, radius, centroids)
        out = table.mapInArrow(_pass(model, dim, write), f"{_TABLE}, {_FACTS}")
        if write:
            path = buffers[number % 2] if number < 2 else next(b for b in buffers if b != path)
            out.write.mode("overwrite").parquet(path)
            out = spark.read.schema(out.schema).parquet(path)
            table = out.where("slot is null").select("id", "v", "cluster", "distance", "others")
        facts = out.where("slot is not null").groupBy("slot").agg(F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount"), F.max("top").alias("top"))
        facts = {r["slot"]: r for r in facts.collect()}
        size = len(first) * (dim + 1)
        moved = [[int(facts[s]["amount"]) if s in facts else 0 for s in range(c * (dim + 1), (c + 1) * (dim + 1))] for c in range(len(first))]
        if write:
            written, radius = centroids, np.array([facts[size + c]["top"] for c in range(len(first))])
            sums = [[a + b for a, b in zip(*pair)] for pair in zip(sums, moved)]
            current = sums
        else:  # the table still holds the assignment that the sums belong to
            current = [[a + b for a, b in zip(*pair)] for pair in zip(sums, moved)]
        centroids = np.array([[t // s[0] for t in s[1:]] if s[0] else old for s, old in zip(current, centroids.tolist())], np.int64)
        write = int(facts[size + len(first)]["amount"]) * stale >= int(facts[size + len(first) + 1]["amount"])

    model = Model.since(written, radius, centroids)
    rows = table.mapInArrow(_last_pass(model, dim), "id long, cluster int, distance long")
    return Clustering(rows.withColumnRenamed("id", id_col), centroids.tolist())


def clustering_report(vectors: DataFrame, id_col: str = "vec_id", **options) -> DataFrame:
    """Each vector with its cluster's and the whole distance sums and its centroid's digest."""
    spark = vectors.sparkSession
    found = cluster_vectors(vectors, id_col=id_col, **options)
    rows = settle(found.rows, "clusters")
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(found.centroids)]
    digests = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    # a row per centroid, whatever the input
    each = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(digests, "cluster")
    return rows.join(F.broadcast(each), "cluster").select(
        id_col, "cluster", "distance", "cluster_inertia", each.agg(F.sum("cluster_inertia")).scalar().alias("inertia"), "centroid_sha256"
    )
