"""Connected components by joining links in tasks and jumping over parents.

A state is a set of links (u, v), v < u. Its links are dealt by u; a task joins all of
its links at once and hands back stars: every vertex with the least one that the task
found linked with it. The star links of the u that were dealt to the task are those
vertices' own: each vertex has one, its parent. Then every link's v is replaced by the
parent of v, where it has one, and links are dealt again, until all links are their
vertices' own and no parent has a parent: then every component is a star around its
least member. Parents only get smaller and a vertex that has one keeps one, so rounds end.

A vertex with many links is no large group: before links are dealt, the tasks that read
them join what they hold, which leaves a vertex one v a task, and the v of many links is
only the key of a join of two stored tables, whose partitions Spark can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, written

#: Links that a task joins at once: with the stars so far, so it holds its vertices and this number of links.
AT_ONCE = 1 << 20


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(u, v): each vertex of the links a - b with the least vertex of its component, those themselves left out."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while len(x):
        # all roots take the least root that they have a link with
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(further := root[root], root):
            root = further
        x, y = root[x], root[y]
        apart = x != y
        x, y = x[apart], y[apart]
    member = np.flatnonzero(root != np.arange(len(ids)))
    return ids[member], ids[root[member]]


def _joined(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stars of all links as u and v, which u are a u of the links)."""
    none = np.empty(0, np.int64)
    u, v, keys = none, none, none
    held: list[pa.RecordBatch] = []

    def join() -> None:
        nonlocal u, v, keys
        a, b = (np.concatenate([none, *(x.column(k).to_numpy() for x in held)]) for k in (0, 1))
        keys = np.union1d(keys, a)
        u, v = stars(np.concatenate([u, a]), np.concatenate([v, b]))
        held.clear()

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= AT_ONCE:
            join()
    join()
    return u, v, np.isin(u, keys)


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    u, v, _ = _joined(batches)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    u, v, own = _joined(batches)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(own)], names=["u", "v", "own"])


def _round(links: DataFrame) -> DataFrame:
    """The links after a round, stored."""
    return written(links.repartition("u").mapInArrow(released(_dealt), "u long, v long, own boolean"), "edges")


def _settled(e: DataFrame) -> bool:
    """Whether every link is its vertex's own and no parent has a parent."""
    if e.agg(F.min("own")).first()[0] is False:
        return False
    ends = F.explode(F.array(F.struct(F.col("u").alias("at"), F.lit(1).alias("end")), F.struct(F.col("v").alias("at"), F.lit(2).alias("end")))).alias("x")
    both = e.select(ends).groupBy("x.at").agg(F.bit_or("x.end").alias("ends"))
    return both.agg(F.max("ends")).first()[0] != 3


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the least vertex reachable from each vertex that has a link; edges may repeat or be loops."""
    links = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).filter("u <> v")
    e = _round(links.mapInArrow(released(_local), "u long, v long"))
    while not _settled(e):
        parents = e.filter("own").select(F.col("u").alias("at"), F.col("v").alias("parent"))
        e = _round(e.join(parents.hint("merge"), e["v"] == parents["at"], "left").select("u", F.coalesce("parent", "v").alias("v")))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
