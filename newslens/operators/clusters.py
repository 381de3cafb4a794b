"""Clusters of vectors within a flashpoint: neighbours, components, ranks, centroids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..runtime import ship, stash

NEIGHBOURS = 10
THRESHOLD = 0.65


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def unit(vector: Column) -> Column:
    """The vector in doubles with length 1; a zero vector stays."""
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(dot(v, v))
    # over an array of one, so the norm is computed once and not for each component
    return F.element_at(F.transform(F.array(F.when(norm > 0, norm).otherwise(1.0)), lambda n: F.transform(v, lambda x: x / n)), 1)


#: Vectors of a flashpoint that one task holds twice of: all pairs of two blocks are one matrix product.
BLOCK = 8192
#: Vectors of a block that are multiplied with another block at a time, and similarities, if all of which reach the threshold a task holds them as pairs.
ROWS, SIMILARITIES = 1024, 1 << 19
#: Pivots of a flashpoint for each of its blocks, and at most.
PIVOTS, MOST_PIVOTS = 3, 192
#: Distances are compared with this much room for rounding, of cosines to 6 places among others.
ROOM = 2e-6
#: Links of a flashpoint up to which one task finds its components.
SMALL = 500_000


def _units(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows of length 1, shorter ones filled with zeros; zero vectors stay."""
    lengths = pc.list_value_length(lists).fill_null(0).to_numpy()
    units = np.zeros((len(lists), int(lengths.max(initial=0))))
    for n in np.unique(lengths[lengths > 0]):
        which = np.flatnonzero(lengths == n)
        units[which, :n] = pc.list_flatten(lists.take(pa.array(which))).to_numpy(zero_copy_only=False).reshape(len(which), n)
    norm = np.sqrt((units**2).sum(axis=1, keepdims=True))
    return units / np.where(norm > 0, norm, 1.0)


def rows_at_a_time(others: int) -> int:
    """How many vectors are multiplied with so many others at a time."""
    return max(1, min(ROWS, SIMILARITIES // max(1, others)))


def _chords(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows of a and b, which have length 1 or 0; the shorter rows count as filled with zeros."""
    n = min(a.shape[1], b.shape[1])
    square = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a[:, :n] @ b[:, :n].T
    return np.nan_to_num(np.sqrt(np.maximum(square, 0.0)))  # what holds no number is near nothing, so any distance will do


def _cells(rows: DataFrame) -> DataFrame:
    """rows (flashpoint_id, src, v, blocks) with the cell of the nearest pivot, and the distances to all pivots of the flashpoint.

    Pivots are vectors of the flashpoint, chosen by a hash. Its vectors are dealt
    to tasks of bounded size, each of which gets all its pivots.
    """
    share = F.least(F.lit(1.0), F.least(F.lit(MOST_PIVOTS), F.col("blocks") * PIVOTS) / F.col("vectors"))
    chosen = rows.where(F.pmod(F.xxhash64(F.lit(7), "src"), F.lit(1 << 30)) / float(1 << 30) < share)
    held = chosen.groupBy("flashpoint_id", "blocks").agg(F.array_sort(F.collect_set("v")).alias("pivots"))
    pivots = held.select(F.col("flashpoint_id").alias("of"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), "pivots")
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("src"), F.col("blocks")).cast("int"))
    schema = T.StructType([*(dealt.schema[x] for x in ("flashpoint_id", "src", "v")), T.StructField("cell", T.IntegerType()), T.StructField("far", T.ArrayType(T.DoubleType()))])

    def run(group: pa.Table, pivots: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        lists = pivots.combine_chunks().column("pivots").combine_chunks()
        found = _chords(_units(group.column("v").combine_chunks()), _units(lists.flatten())) if len(lists) and group.num_rows else np.zeros((group.num_rows, 0))
        cell = found.argmin(axis=1) if found.shape[1] else np.zeros(group.num_rows, dtype=np.int64)
        far = pa.ListArray.from_arrays(pa.array(np.arange(group.num_rows + 1) * found.shape[1], pa.int32()), pa.array(found.ravel()))
        return pa.table({**{x: group.column(x) for x in ("flashpoint_id", "src", "v")}, "cell": pa.array(cell, pa.int32()), "far": far})

    return dealt.groupBy("flashpoint_id", "part").cogroup(pivots.groupBy("of", "part")).applyInArrow(run, schema)


def _near_cells(celled: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(flashpoint_id, cell, members) of all cells, and (flashpoint_id, a, b), a <= b, of the pairs whose vectors can reach the threshold.

    The distance of two vectors is at least the difference of their distances to
    any pivot. So two cells are too far from each other if, for one pivot, the
    nearest of one is farther than the farthest of the other by more than the
    distance that the threshold allows.
    """
    schema = T.StructType([celled.schema["flashpoint_id"], T.StructField("cell", T.IntegerType()), T.StructField("members", T.LongType()), *(T.StructField(x, T.ArrayType(T.DoubleType())) for x in ("low", "high"))])

    def bounds(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch]).append_column("row", pa.array(np.arange(batch.num_rows)))
            for keys in rows.group_by(["flashpoint_id", "cell"]).aggregate([("row", "list")]).to_pylist():
                far = np.array([x.as_py() for x in rows.column("far").take(pa.array(keys["row_list"]))])
                out = {"flashpoint_id": [keys["flashpoint_id"]], "cell": [keys["cell"]], "members": [len(far)], "low": [far.min(axis=0).tolist()], "high": [far.max(axis=0).tolist()]}
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], rows.schema.field(f.name).type if f.name in rows.schema.names else to_arrow_type(f.dataType)) for f in schema], schema.names)

    parts = celled.select("flashpoint_id", "cell", "far").mapInArrow(bounds, schema)
    members = parts.groupBy("flashpoint_id", "cell").agg(F.sum("members").alias("members"))
    each = parts.select("flashpoint_id", "cell", F.posexplode(F.arrays_zip("low", "high")).alias("pivot", "x")).groupBy("flashpoint_id", "cell", "pivot").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    ranges = each.groupBy("flashpoint_id", "cell").agg(F.array_sort(F.collect_list(F.struct("pivot", "low", "high"))).alias("r")).select("flashpoint_id", "cell", F.transform("r", lambda x: x["low"]).alias("low"), F.transform("r", lambda x: x["high"]).alias("high"))
    cells = stash(members.join(ranges, ["flashpoint_id", "cell"], "left"), "cells")
    reach = max(0.0, 2.0 - 2.0 * max(-1.0, threshold - ROOM)) ** 0.5 + ROOM
    a, b = (cells.select("flashpoint_id", F.col("cell").alias(x), F.col("low").alias(f"low_{x}"), F.col("high").alias(f"high_{x}")) for x in "ab")
    gaps = F.zip_with(F.zip_with("low_a", "high_b", lambda x, y: x - y), F.zip_with("low_b", "high_a", lambda x, y: x - y), lambda x, y: F.greatest(x, y))
    near = a.join(b, "flashpoint_id").where("a <= b").where(~F.coalesce(F.exists(gaps, lambda x: x > reach), F.lit(False))).select("flashpoint_id", "a", "b")
    return cells.select("flashpoint_id", "cell", "members"), near


def _pairs_of_blocks(rows: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """rows with ``own``, the block of each vector, and (flashpoint_id, i, j) of the pairs of blocks, i <= j, that may hold near vectors.

    A flashpoint of one block is that. In larger ones every cell is cut into
    blocks of bounded size by a hash, and cells too far from each other share no pair.
    """
    sizes = rows.groupBy("flashpoint_id").agg(F.count(F.lit(1)).alias("vectors")).withColumn("blocks", F.ceil(F.col("vectors") / BLOCK).cast("int"))
    sized = rows.join(sizes, "flashpoint_id")
    few = sized.where("blocks = 1").select("flashpoint_id", "src", "v", F.lit(0).cast("long").alias("own"))
    alone = sizes.where("blocks = 1").select("flashpoint_id", F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"))
    if sizes.where("blocks > 1").isEmpty():
        return few, alone
    celled = stash(_cells(sized.where("blocks > 1")), "celled")
    cells, near = _near_cells(celled, threshold)
    cut = cells.withColumn("parts", F.ceil(F.col("members") / BLOCK))
    number = lambda cell, part: (F.col(cell).cast("long") * (1 << 31) + part)
    own = celled.join(cut, ["flashpoint_id", "cell"]).withColumn("own", number("cell", F.pmod(F.xxhash64("src"), F.col("parts"))))
    parts = cut.select("flashpoint_id", F.col("cell"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    left, right = (parts.select("flashpoint_id", F.col("cell").alias(c), number("cell", F.col("part")).alias(x)) for c, x in (("a", "i"), ("b", "j")))
    pairs = near.join(left, ["flashpoint_id", "a"]).join(right, ["flashpoint_id", "b"]).where("i <= j").select("flashpoint_id", "i", "j")
    return few.unionByName(own.select("flashpoint_id", "src", "v", "own")), alone.unionByName(pairs)


def _blocked(vectors: DataFrame, threshold: float, k: int | None) -> DataFrame:
    """Both directions of the pairs of one flashpoint that reach the threshold; with k only the first k of a vector in each pair of blocks.

    Every flashpoint is dealt into blocks of bounded size, and every pair of
    blocks that may hold near vectors is a group of its own.
    """
    ship(vectors.sparkSession)
    rows = vectors.select("flashpoint_id", F.col("feed_entry_id").alias("src"), F.col("embedding").cast("array<double>").alias("v"))
    dealt, pairs = _pairs_of_blocks(rows, threshold)
    meets = pairs.select("flashpoint_id", F.col("i").alias("own"), "i", "j").unionByName(pairs.where("i < j").select("flashpoint_id", F.col("j").alias("own"), "i", "j"))
    paired = dealt.join(meets, ["flashpoint_id", "own"]).select("flashpoint_id", "src", "v", "own", "i", "j")
    schema = T.StructType([paired.schema["flashpoint_id"], T.StructField("src", paired.schema["src"].dataType), T.StructField("dst", paired.schema["src"].dataType), T.StructField("sim", T.DoubleType())])

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(batches).combine_chunks()
        units, own = _units(group.column("v").combine_chunks()), group.column("own").to_numpy()
        ids = group.column("src")
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        twice = [(left, right)] if i == j else [(left, right), (right, left)]
        pieces = ((whole, b, rows_at_a_time(len(b))) for whole, b in twice)
        for a, b in ((whole[at : at + step], b) for whole, b, step in pieces for at in range(0, len(whole), step)):
            sim = np.round(units[a] @ units[b].T, 6)
            near = (sim >= threshold) & (a[:, None] != b[None, :])
            x, y = np.nonzero(near)
            found = pa.table({"src": ids.take(pa.array(a[x])), "dst": ids.take(pa.array(b[y])), "sim": pa.array(sim[x, y])})
            found = found.filter(pc.not_equal(found["src"], found["dst"]))
            if k is not None and found.num_rows:
                found = found.sort_by([("src", "ascending"), ("sim", "descending"), ("dst", "ascending")])
                src = found["src"].combine_chunks()
                first = np.concatenate(([True], pc.not_equal(src[1:], src[:-1]).to_numpy(zero_copy_only=False)))
                place = np.arange(len(first)) - np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
                found = found.filter(pa.array(place < k))
            of = pa.array([key[0].as_py()] * found.num_rows, group.schema.field("flashpoint_id").type)
            yield from found.add_column(0, "flashpoint_id", of).combine_chunks().to_batches()

    return paired.groupBy("flashpoint_id", "i", "j").applyInArrow(run, schema)


def cosine_pairs(vectors: DataFrame, threshold: float) -> DataFrame:
    """(flashpoint_id, src, dst, sim): both directions of pairs of one flashpoint with a cosine, rounded to 6 places, of at least the threshold."""
    return _blocked(vectors, threshold, None)


def knn_edges(vectors: DataFrame, k: int = NEIGHBOURS, threshold: float = THRESHOLD) -> DataFrame:
    """For each vector its k nearest of the flashpoint, as far as they reach the threshold; ties to the smaller id."""
    order = Window.partitionBy("flashpoint_id", "src").orderBy(F.desc("sim"), "dst")
    return _blocked(vectors, threshold, k).withColumn("rk", F.row_number().over(order)).where(F.col("rk") <= k).drop("rk")


def _local_components(edges: DataFrame, group: str) -> DataFrame:
    """(group, node, comp) of the nodes of edges (group, x, y): a task for each group."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        names = pa.concat_arrays([rows.column("x").combine_chunks(), rows.column("y").combine_chunks()]).unique()
        names = names.take(pc.sort_indices(names))
        x, y = (pc.index_in(rows.column(c), names).to_numpy() for c in "xy")
        label = np.arange(len(names))
        while True:
            # the smaller root of every link's two ends takes the larger one in, then all point to their root
            low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
            open_ = low < high
            if not open_.any():
                break
            np.minimum.at(label, high[open_], low[open_])
            while (label[label] != label).any():
                label = label[label]
        key = rows.column(group)[0].as_py()
        return pa.table({group: pa.array([key] * len(names), rows.schema.field(group).type), "node": names, "comp": names.take(pa.array(label))})

    schema = T.StructType([edges.schema[group], T.StructField("node", edges.schema["x"].dataType), T.StructField("comp", edges.schema["x"].dataType)])
    return edges.groupBy(group).applyInArrow(run, schema)


def components(nodes: DataFrame, edges: DataFrame, group: str = "flashpoint_id", small: int = SMALL) -> DataFrame:
    """(group, node, comp): the smallest node of the connected component, isolated nodes included.

    Groups of up to ``small`` links are solved by one task each. In larger ones
    labels spread along edges and jump to their label's label until nothing
    changes; every round is written to the shared folder, so they are no single task.
    """
    ship(nodes.sparkSession)
    links = stash(edges.select(group, F.col("src").alias("x"), F.col("dst").alias("y")), "links")
    sizes = links.groupBy(group).agg(F.count(F.lit(1)).alias("_links"))
    large = sizes.where(F.col("_links") > small).select(group)
    alone = nodes.select(group, "node")
    if large.isEmpty():
        found = _local_components(links, group)
    else:
        large = stash(large, "large")
        inner = alone.join(large, group, "left_semi")
        found = _local_components(links.join(large, group, "left_anti"), group).unionByName(_spread_components(inner, links.join(large, group, "left_semi"), group))
    return alone.join(found, [group, "node"], "left").select(group, "node", F.coalesce("comp", "node").alias("comp"))


def _spread_components(nodes: DataFrame, links: DataFrame, group: str) -> DataFrame:
    both = stash(links.unionByName(links.select(group, F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = stash(nodes.select(group, "node", F.col("node").alias("comp")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "y"), [group, "y"]).groupBy(group, F.col("x").alias("node")).agg(F.min("comp").alias("near"))
        spread = labels.join(near, [group, "node"], "left").select(group, "node", F.col("comp").alias("old"), F.coalesce(F.least("comp", "near"), "comp").alias("comp"))
        parent = spread.select(group, F.col("node").alias("comp"), F.col("comp").alias("up"))
        jumped = stash(spread.join(parent, [group, "comp"]).select(group, "node", "old", F.col("up").alias("comp")), "labels")
        done = jumped.where("old <> comp").limit(1).count() == 0
        labels = jumped.select(group, "node", "comp")
        if done:
            return labels


def rank_clusters(labels: DataFrame, group: str = "flashpoint_id") -> DataFrame:
    """labels with article_count and cluster_id: 1, 2, ... by size, then by smallest member; cluster_key is stable across runs."""
    sizes = labels.groupBy(group, "comp").agg(F.count(F.lit(1)).alias("article_count"))
    ranked = sizes.withColumn("cluster_id", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("article_count"), "comp")))
    key = F.sha2(F.concat_ws("|", F.col(group).cast("string"), F.col("comp").cast("string")), 256)
    return labels.join(ranked, [group, "comp"]).withColumn("cluster_key", key)


def cluster(vectors: DataFrame, k: int = NEIGHBOURS, threshold: float = THRESHOLD) -> DataFrame:
    """(flashpoint_id, feed_entry_id, cluster_id, article_count, cluster_key, comp) of all vectors."""
    nodes = vectors.select("flashpoint_id", F.col("feed_entry_id").alias("node"))
    return rank_clusters(components(nodes, knn_edges(vectors, k, threshold))).withColumnRenamed("node", "feed_entry_id")


def centroids(assigned: DataFrame, vectors: DataFrame) -> DataFrame:
    """(flashpoint_id, cluster_id, centroid): the unit mean of the members' unit vectors, partial sums by dimension."""
    each = assigned.select("flashpoint_id", "feed_entry_id", "cluster_id").join(vectors.select("flashpoint_id", "feed_entry_id", "embedding"), ["flashpoint_id", "feed_entry_id"])
    by_dim = each.select("flashpoint_id", "cluster_id", F.posexplode(unit(F.col("embedding")))).groupBy("flashpoint_id", "cluster_id", "pos").agg(F.avg("col").alias("m"))
    mean = by_dim.groupBy("flashpoint_id", "cluster_id").agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("p"))
    return mean.select("flashpoint_id", "cluster_id", unit(F.transform("p", lambda x: x["m"])).alias("centroid"))


def with_similarity(assigned: DataFrame, vectors: DataFrame) -> DataFrame:
    """assigned with the cosine of each member and its centroid, to 6 places; exactly 1 for clusters of one."""
    whole = assigned.join(vectors.select("flashpoint_id", "feed_entry_id", "embedding"), ["flashpoint_id", "feed_entry_id"]).join(centroids(assigned, vectors), ["flashpoint_id", "cluster_id"])
    sim = F.when(F.col("article_count") == 1, 1.0).otherwise(F.round(dot(unit(F.col("embedding")), F.col("centroid")), 6))
    return whole.withColumn("similarity", sim).drop("embedding", "centroid")
