"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors of cosine >= c lie within epsilon = sqrt(2 - 2c). A grid of epsilon-wide cells on
the leading principal dimensions orders them; consecutive vectors form blocks with a bounding
box. Blocks whose boxes are further apart than epsilon are provably distant and never meet;
the others are joined recursively, halving the intervals and skipping distant halves, down to
small products of matrices. The pairs that come out are exactly those of an all-pairs join.

Equal vectors are one vector with a count, and a block pair returns one row per vector, not
its pairs: how many vectors it links with, and a representative it is connected to.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tokenloom.llm.components import components
from tokenloom.session import settle

BLOCK = 1024
LEAF = 128
#: Leading principal dimensions that carry the grid.
GRID = 4


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """The leading principal axes of all unit vectors of ``dim`` numbers; sums are added in two levels."""

    def sums(batches):
        total = np.zeros((dim + 1, dim))
        for batch in batches:
            x = _unit(batch.column(0), dim)
            total[:dim] += x.T @ x
            total[dim] += x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def add(table):
        total = np.zeros((dim + 1, dim))
        for part in table.column("sums"):
            total += np.frombuffer(part.as_py()).reshape(dim + 1, dim)
        return pa.table({"sums": pa.array([total.tobytes()], pa.binary())})

    parts = vectors.select("v").mapInArrow(sums, "sums binary")
    salts = max(1, int(vectors.rdd.getNumPartitions() ** 0.5))
    parts = parts.groupBy((F.spark_partition_id() % salts).alias("salt")).applyInArrow(add, "sums binary")
    total = np.zeros((dim + 1, dim))
    for row in parts.collect():
        total += np.frombuffer(row["sums"]).reshape(dim + 1, dim)
    _, axes = np.linalg.eigh(total[:dim])
    return axes[:, ::-1][:, : min(GRID, dim)]


def _boxes_apart(lo_a, hi_a, lo_b, hi_b) -> float:
    gap = np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    return float((gap * gap).sum())


def _linked(x, y, px, py, cosine: float, far: float, same: bool):
    """(row of x, row of y) of all pairs within reach; ``same``: x is y, and pairs are counted once."""
    out_i, out_j = [], []

    def join(a: slice, b: slice):
        if same and a.start > b.start:
            return
        if _boxes_apart(px[a].min(0), px[a].max(0), py[b].min(0), py[b].max(0)) > far:
            return
        n, m = a.stop - a.start, b.stop - b.start
        if n <= LEAF and m <= LEAF:
            hit = x[a] @ y[b].T >= cosine
            i, j = np.nonzero(np.triu(hit, 1) if same and a.start == b.start else hit)
            out_i.append(i + a.start)
            out_j.append(j + b.start)
            return
        # both intervals are halved at the same places, so a self join meets each half once
        halves = [[s] if s.stop - s.start <= LEAF else [slice(s.start, (s.start + s.stop) // 2), slice((s.start + s.stop) // 2, s.stop)] for s in (a, b)]
        for left in halves[0]:
            for right in halves[1]:
                join(left, right)

    join(slice(0, len(x)), slice(0, len(y)))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_i]), np.concatenate([none, *out_j])


def _representatives(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``count`` nodes, the smallest one that the links i-j reach."""
    low = np.arange(count)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _join_blocks(dim: int, cosine: float):
    far = 2 - 2 * cosine + 1e-9

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                same = row["a"] == row["b"]
                ids = [np.frombuffer(row[f"ids_{s}"], np.int64) for s in "ab"]
                many = [np.frombuffer(row[f"many_{s}"], np.int64) for s in "ab"]
                x, y = (np.frombuffer(row[f"vecs_{s}"]).reshape(-1, dim) for s in "ab")
                px, py = (np.frombuffer(row[f"grid_{s}"]).reshape(len(v), -1) for s, v in (("a", x), ("b", y)))
                i, j = _linked(x, y, px, py, cosine, far, same)
                if not len(i):
                    continue
                if not same:
                    j = j + len(x)
                    ids, many = [np.concatenate(ids)], [np.concatenate(many)]
                ids, many = ids[0], many[0]
                links = np.bincount(i, many[j], len(ids)) + np.bincount(j, many[i], len(ids))
                low = _representatives(len(ids), i, j)
                has = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[has]), pa.array(ids[low[has]]), pa.array(links[has].astype(np.int64))], ["a", "b", "links"]
                )

    return run


def _blocks(axes: np.ndarray, dim: int):
    """Cuts a partition in grid order into blocks of one label."""

    def run(batches):
        held, label, number, part = None, None, 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            labels = table.column("label").to_numpy()
            part = table.column("part")[0].as_py()
            start = 0
            while start < len(labels):
                stop = start + int(np.searchsorted(labels[start:], labels[start], "right"))
                stop = min(stop, start + BLOCK)
                if stop == len(labels) and stop - start < BLOCK:
                    break  # may go on in the next batch
                yield _block(table.slice(start, stop - start), axes, dim, part, number)
                start, number = stop, number + 1
            held = table.slice(start) if start < len(labels) else None
        if held is not None:
            yield _block(held, axes, dim, part, number)

    return run


def _block(table: pa.Table, axes, dim: int, part: int, number: int) -> pa.RecordBatch:
    x = _unit(table.column("v").combine_chunks(), dim)
    grid = x @ axes
    return pa.RecordBatch.from_arrays(
        [
            table.column("label").combine_chunks()[:1],
            pa.array([(part << 32) + number], pa.int64()),
            pa.array([grid.min(0).tolist()], pa.list_(pa.float64())),
            pa.array([grid.max(0).tolist()], pa.list_(pa.float64())),
            pa.array([table.column("cls").to_numpy().tobytes()], pa.binary()),
            pa.array([table.column("many").to_numpy().tobytes()], pa.binary()),
            pa.array([x.tobytes()], pa.binary()),
            pa.array([grid.tobytes()], pa.binary()),
        ],
        ["label", "block", "lo", "hi", "ids", "many", "vecs", "grid"],
    )


def _links(classes: DataFrame, dim: int, cosine: float) -> DataFrame:
    """(a, b, links) of the vectors of ``dim`` numbers, once for every block pair they link in."""
    vectors = classes.where(F.col("dim") == dim)
    count = vectors.count()
    axes = _axes(vectors, dim)
    width = float(np.sqrt(2 - 2 * cosine))

    def cells(batches):
        for batch in batches:
            found = np.floor(_unit(batch.column("v"), dim) @ axes / width).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(found), pa.list_(pa.int64()))], [*batch.schema.names, "cell"])

    ordered = vectors.select("label", "cls", "many", "v").mapInArrow(cells, "label long, cls long, many long, v array<double>, cell array<long>")
    keys = ["label", *[F.col("cell")[k] for k in range(axes.shape[1])], "cls"]
    ordered = ordered.repartitionByRange(max(1, -(-count // (8 * BLOCK))), *keys).sortWithinPartitions(*keys)
    ordered = ordered.select("label", "cls", "many", "v", F.spark_partition_id().alias("part"))
    schema = "label long, block long, lo array<double>, hi array<double>, ids binary, many binary, vecs binary, grid binary"
    blocks = settle(ordered.mapInArrow(_blocks(axes, dim), schema), "ego-blocks")

    # blocks meet in the cells of the first dimension that they cover, give or take one
    span = lambda less, more: F.explode(
        F.sequence(F.floor(F.col("lo")[0] / width).cast("long") - less, F.floor(F.col("hi")[0] / width).cast("long") + more)
    ).alias("cell")
    a = blocks.select("label", F.col("block").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"), span(0, 0))
    b = blocks.select("label", F.col("block").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"), span(1, 1))
    gaps = F.zip_with(F.zip_with("lo_a", "hi_b", lambda x, y: x - y), F.zip_with("lo_b", "hi_a", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    apart = F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g * g)
    near = a.join(b, ["label", "cell"]).where((F.col("a") <= F.col("b")) & (apart <= width * width + 1e-9))
    near = near.select("a", "b").distinct()
    side = lambda s: blocks.select(F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "many", "vecs", "grid")])
    pairs = near.join(side("a"), "a").join(side("b"), "b")
    return pairs.mapInArrow(_join_blocks(dim, cosine), "a long, b long, links long")


def embedding_classes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.93
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors of one label and length link at a cosine of at least ``cosine``. A vector that is
    NULL, empty, zero or holds a NULL or non-finite number, or has no label, links with
    nothing: its component is its own id. Equal ids count as vectors of their own; a NULL id
    is never a component unless nothing else is in it, and is not kept. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("cls", F.when(usable, F.xxhash64("label", F.transform("v", lambda x: x + F.lit(0.0)))))
    classes = rows.where("cls is not null").groupBy("cls", "label", "v").agg(F.count("*").alias("many"), F.min("id").alias("low"))
    classes = settle(classes.withColumn("dim", F.size("v")), "ego-classes")
    links = spark.createDataFrame([], "a long, b long, links long")
    for (dim,) in classes.select("dim").distinct().collect():
        links = links.union(_links(classes, dim, cosine))
    links = settle(links, "ego-links")
    counts = links.groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links"))
    found = components(links.select("a", "b"))
    known = classes.select("cls", "many", "low").join(counts, "cls", "left").join(found.withColumnRenamed("id", "cls"), "cls", "left")
    known = settle(known.withColumn("component", F.coalesce("component", "cls")), "ego-known")
    lowest = known.groupBy("component").agg(F.min("low").alias("component_id"))
    known = known.join(lowest, "component").select("cls", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), "component_id")
    out = rows.select("id", "cls").join(known, "cls", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
