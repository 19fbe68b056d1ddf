"""Operator 5: near-duplicate embeddings by HNSW graphs per shard, queried by every vector.

Equal vectors form one class first.  The classes are dealt to shards by hash; one task builds a
shard's graph, audits it (beams are widened until sampled queries find ``RECALL`` of the links
that a comparison with the whole shard finds), and searches the shard's own vectors in it.  Then
every vector is searched in every other shard's graph.  Candidates are verified by their cosine in
double precision.  A search hands on counts of links and the shard-local groups it reached, never
pairs, so a cluster of any size stays linear in rows; groups are united by connected components.

With n classes there are about sqrt(n) / 64 shards, so the graphs and the searches grow alike.

Defined cases: a vector that is null, empty, zero, or has null or non-finite components links with
nothing and is its own component; vectors of different lengths never link; repeated rows link with
each other; a null vec_id takes part, but names a component only if no other id does; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import hnsw
from orderflow.llm.base import shuffle_width, written
from orderflow.llm.components import components

SIMILARITY = 0.95
#: Recall that the audit asks for, its queries, the beam it begins with.
RECALL, AUDITED, BEAM = 0.99, 256, 48
#: Single-precision cosines this far below the threshold are still verified.
SLACK = 1e-4
#: The number of shards is the square root of the number of vectors over this.
SHARD_ROOT = 64

INDEX = ("size int, shard int, index binary, keys array<string>, heads array<string>, links array<long>, "
         "width int, recall double")
_INDEX = pa.schema([("size", pa.int32()), ("shard", pa.int32()), ("index", pa.binary()),
                    ("keys", pa.list_(pa.string())), ("heads", pa.list_(pa.string())),
                    ("links", pa.list_(pa.int64())), ("width", pa.int32()), ("recall", pa.float64())])


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def found_links(graph: hnsw.Graph, exact: np.ndarray, queries: np.ndarray, width: int,
                ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) of verified links, a batch of queries at a time; ``exact`` and ``queries`` in double."""
    for first in range(0, len(queries), hnsw.ADDED):
        part = queries[first:first + hnsw.ADDED]
        row, node = graph.within(part.astype(np.float32), SIMILARITY - SLACK, width)
        cosine = np.concatenate([np.einsum("pd,pd->p", part[row[i:i + 50_000]], exact[node[i:i + 50_000]])
                                 for i in range(0, len(row), 50_000)] or [np.zeros(0)])
        sure = cosine >= SIMILARITY
        yield row[sure] + first, node[sure]


def united(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give all nodes of linked groups the least label among them."""
    while True:
        low, high = np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])
        apart = low != high
        if not apart.any():
            return
        to = np.arange(len(labels))
        np.minimum.at(to, high[apart], low[apart])
        while (again := to[to] != to).any():
            to[again] = to[to[again]]
        labels[:] = to[labels]


def packed(graph: hnsw.Graph, exact: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> bytes:
    file = io.BytesIO()
    parts = {"exact": exact, "counts": counts, "labels": labels, "entry": np.array(graph.entry),
             "lowest": graph.layers[0]}
    for i, layer in enumerate(graph.layers[1:]):
        nodes = np.flatnonzero((layer >= 0).any(axis=1))
        parts |= {f"nodes{i}": nodes, f"links{i}": layer[nodes]}
    np.savez(file, **parts)
    return file.getvalue()


def unpacked(data: bytes) -> tuple[hnsw.Graph, np.ndarray, np.ndarray, np.ndarray]:
    parts = np.load(io.BytesIO(data))
    exact, layers = parts["exact"], [parts["lowest"]]
    while f"nodes{len(layers) - 1}" in parts:
        nodes, links = parts[f"nodes{len(layers) - 1}"], parts[f"links{len(layers) - 1}"]
        layer = np.full((len(exact), links.shape[1] if links.ndim == 2 else hnsw.LINKS), -1, np.int32)
        layer[nodes] = links
        layers.append(layer)
    return hnsw.Graph(exact.astype(np.float32), layers, int(parts["entry"])), exact, parts["counts"], parts["labels"]


def indexed(shard: pa.Table) -> pa.Table:
    """One shard's classes (size, shard, key, copies, vector) -> its INDEX row."""
    shard = shard.sort_by("key")
    keys = shard.column("key").to_pylist()
    exact = unit(matrix(shard.column("vector")))
    counts = shard.column("copies").to_numpy()
    graph = hnsw.build(exact.astype(np.float32))
    width, recall = hnsw.audited_width(graph, SIMILARITY, RECALL, AUDITED, BEAM)
    labels, links = np.arange(len(keys)), np.zeros(len(keys), np.int64)
    for row, node in found_links(graph, exact, exact, width):
        united(labels, row, node)
        np.add.at(links, row, np.where(row == node, 0, counts[node]))
    heads = [keys[i] for i in labels.tolist()]
    return pa.Table.from_pylist([{
        "size": exact.shape[1], "shard": shard.column("shard")[0].as_py(), "keys": keys, "heads": heads,
        "index": packed(graph, exact, counts, labels), "links": links.tolist(), "width": width,
        "recall": recall}], schema=_INDEX)


SEARCHED = "key string, links long, heads array<string>"


def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (size, shard, part), the shard's index first -> links of the queries that have some."""
    group, opened, names, width = None, None, None, 0
    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in ("size", "shard", "part", "query")}
        places = list(zip(columns["size"], columns["shard"], columns["part"]))
        at = 0
        while at < batch.num_rows:
            end = at + 1
            while end < batch.num_rows and places[end] == places[at] and columns["query"][end] == columns["query"][at]:
                end += 1
            part = batch.slice(at, end - at)
            if not columns["query"][at]:
                group, opened = places[at], unpacked(part.column("index")[0].as_py())
                names, width = part.column("keys")[0].as_py(), part.column("width")[0].as_py()
            elif group == places[at]:
                yield _search(part, opened, names, width)
            at = end


def _search(part: pa.RecordBatch, opened: tuple, names: list[str], width: int) -> pa.RecordBatch:
    graph, exact, counts, labels = opened
    keys = part.column("key").to_pylist()
    links, heads = np.zeros(len(keys), np.int64), [set() for _ in keys]
    for row, node in found_links(graph, exact, unit(matrix(part.column("vector"))), width):
        np.add.at(links, row, counts[node])
        pairs = np.unique(row * len(labels) + labels[node])
        for i, label in zip((pairs // len(labels)).tolist(), (pairs % len(labels)).tolist()):
            heads[i].add(names[label])
    some = np.flatnonzero(links).tolist()
    return pa.RecordBatch.from_arrays(
        [pa.array([keys[i] for i in some], pa.string()), pa.array(links[some], pa.int64()),
         pa.array([sorted(heads[i]) for i in some], pa.list_(pa.string()))], names=["key", "links", "heads"])


def linked(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links and component_id of every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    width = shuffle_width(spark)
    vector = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))  # no negative zero
    sound = (F.size("embedding") > 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        "embedding", lambda x: x != 0)
    rows = written(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(
        F.coalesce(sound, F.lit(False)), vector).alias("vector"))
        .withColumn("key", F.when(F.col("vector").isNotNull(), F.concat(
            F.lpad(F.hex(F.xxhash64("vector")), 16, "0"), F.lpad(F.hex(F.hash("vector")), 16, "0")))), "vec-rows")
    classes = rows.filter("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    sizes = rows.filter("key is not null").groupBy(F.size("vector").alias("size")).agg(
        F.greatest(F.ceil(F.sqrt(F.approx_count_distinct("key")) / SHARD_ROOT), F.lit(1)).cast("int").alias("shards"))
    classes = written(classes.withColumn("size", F.size("vector")).join(F.broadcast(sizes), "size")
                      .withColumn("shard", F.pmod(F.xxhash64("key"), F.col("shards")).cast("int")), "vec-classes")
    index = written(classes.select("size", "shard", "key", "copies", "vector").groupBy("size", "shard")
                    .applyInArrow(indexed, INDEX), "vec-index")
    own = index.select(F.explode(F.arrays_zip("keys", "heads", "links")).alias("x")).select(
        F.col("x.keys").alias("key"), F.col("x.heads").alias("head"), F.col("x.links").alias("links"))
    own = written(own, "vec-own")
    # queries meet each other shard's graph in a few parts, so that few shards still use all tasks
    cores = max(1, spark.sparkContext.defaultParallelism)
    parts = F.greatest(F.ceil(F.lit(2.0 * cores) / F.col("shards")), F.lit(1)).cast("int")
    queries = (classes.filter("shards > 1").withColumn("target", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
               .filter("target != shard").select(
        "size", F.col("target").alias("shard"), F.pmod(F.xxhash64("key", "target"), parts).cast("int").alias("part"),
        F.lit(True).alias("query"), "key", "vector", F.lit(None).cast("binary").alias("index"),
        F.lit(None).cast("array<string>").alias("keys"), F.lit(None).cast("int").alias("width")))
    graphs = (index.join(F.broadcast(sizes), "size").filter("shards > 1").select(
        "size", "shard", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(False).alias("query"),
        F.lit(None).cast("string").alias("key"), F.lit(None).cast("array<double>").alias("vector"),
        "index", "keys", "width"))
    met = written(graphs.unionByName(queries).repartition(width, "size", "shard", "part")
                  .sortWithinPartitions("size", "shard", "part", "query").mapInArrow(searched, SEARCHED), "vec-met")
    bridges = (met.select("key", F.explode("heads").alias("b")).join(own.select("key", "head"), "key")
               .select(F.col("head").alias("a"), "b").distinct())
    groups = components(bridges, "vec-groups")
    more = met.groupBy("key").agg(F.sum("links").alias("more"))
    classed = (own.join(more, "key", "left").join(groups, F.col("head") == F.col("node"), "left")
               .select("key", (F.col("links") + F.coalesce("more", F.lit(0))).alias("links"),
                       F.coalesce("component", "head").alias("group"))
               .join(classes.select("key", "copies"), "key"))
    placed = written(rows.select("vec_id", "key").join(classed, "key", "left"), "vec-placed")
    # written, so that the join's shuffle of a large group can be split
    least = written(placed.filter("group is not null").groupBy(F.col("group").alias("_group"))
                    .agg(F.min("vec_id").alias("least")), "vec-least")
    return (placed.join(least, F.col("group") == F.col("_group"), "left").select(
        "vec_id", F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id")))


def op5(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector row."""
    return linked(vectors).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
