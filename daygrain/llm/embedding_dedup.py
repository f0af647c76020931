"""Embedding near-dedup as an exact metric range join.

Vectors are scaled to length one, where cosine >= t is distance <= eps. Pivots,
drawn from the data far from one another, partition them: a vector's home is its nearest pivot. By
the triangle inequality a vector can only have a partner at home in another
cell if it is no farther than eps from the plane between the two pivots, and it
is replicated to those cells alone. A pair is compared in the lower of its two
home cells only, so replicas go one way. Cells join independently.

A cell is compared in blocks of at most about ``BLOCK`` by ``BLOCK`` vectors, so
neither a crowded cell nor many replicas make a task grow. Within a block rows are
sorted by their distance to one of them, and only rows whose distances differ by at
most eps are compared: first in single precision with a margin far above its error,
then, what is left, in double precision. A block returns link
counts and a spanning forest of its links, never the links themselves. Equal
vectors are collapsed first and counted by their number.

The number of pivots follows the number of vectors up to ``PIVOTS``, which bounds
what the driver and every task hold; beyond it cells grow, and their blocks become
more, not larger. In high dimensions vectors
without structure lie close to most planes, replicas then approach half of all
vectors per cell and the join approaches a blockwise comparison of all pairs;
that is the price of an exact answer, and clustered data cost less.

Vectors that are null, empty, zero or hold null or non-finite components link
with nothing and form components of their own, as do vectors of different
length with each other. Rows that repeat an id are rows of their own. An empty
table gives an empty result; labels and other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import stored, table
from daygrain.llm.graph import Forest, components

COSINE = 0.95
BLOCK = 8192
#: Most pivots, and as many as there are at least from 64 vectors each on.
PIVOTS = 2048
LEAST = 8
#: Vectors a pivot is chosen from.
SPREAD = 4
#: Rounding allowance of the replication test, far above the error of double arithmetic.
SLACK = 1e-6
#: Share of a tile's pairs up to which candidates are verified one by one.
SPARSE = 0.05


def unit_rows(vectors, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length one and padded with zeros to ``width``, and their lengths before padding."""
    sizes = np.array([len(v) for v in vectors], np.int64)
    rows = np.zeros((len(sizes), width))
    for i, v in enumerate(vectors):
        rows[i, : len(v)] = v
    rows /= np.abs(rows).max(1, keepdims=True)
    rows /= np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
    return rows, sizes


def near_pairs(own: np.ndarray, some: np.ndarray, cosine: float, singles: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which rows of ``own`` and ``some`` have a cosine of at least ``cosine`` in double precision.

    ``singles`` holds the same rows in single precision. The product of two unit
    vectors of d components is off by less than (d + 4) roundings of 2**-24 there, so
    no pair is lost by the margin; candidates are verified in double precision.
    """
    margin = (own.shape[1] + 4) * 2.0**-23
    near = singles[0] @ singles[1].T >= np.float32(cosine - margin)
    n = np.count_nonzero(near)
    if n > SPARSE * near.size:
        return own @ some.T >= cosine
    if n:
        i, j = np.nonzero(near)
        near[i, j] = np.einsum("ij,ij->i", own[i], some[j]) >= cosine
    return near


def block_links(group: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of one block: for each linked vector its weighted count and an edge to the root of its tree.

    A block compares the chunk it is named after on the left with another
    chunk, or with itself.
    """
    width = max(map(len, group.vector))
    rows, sizes = unit_rows(group.vector, width)
    left = np.flatnonzero(group.chunk == group.left_chunk)
    alone = bool((group.left_chunk == group.right_chunk).iloc[0])
    right = left if alone else np.flatnonzero(group.chunk == group.right_chunk)
    copies, found = group.copies.to_numpy(), np.zeros(len(group), np.int64)
    forest = Forest(len(group))
    # Rings around one vector: rows whose distances to it differ by more than eps are farther apart than eps.
    eps = np.sqrt(2 - 2 * cosine) + SLACK
    ring = np.sqrt(np.maximum(2 - 2 * rows @ rows[left[0]], 0)) if len(left) else np.zeros(len(rows))
    left, right = (side[np.argsort(ring[side], kind="stable")] for side in (left, right))
    single, facing = rows.astype(np.float32), rows[right]
    facing_single, one_size = facing.astype(np.float32), (sizes == sizes[:1]).all()
    for at in range(0, len(left), 512):
        own = left[at : at + 512]
        first = np.searchsorted(ring[right], ring[own[0]] - eps)
        last = np.searchsorted(ring[right], ring[own[-1]] + eps, side="right")
        some = right[first:last]
        near = near_pairs(rows[own], facing[first:last], cosine, (single[own], facing_single[first:last]))
        if not one_size:
            near &= sizes[own][:, None] == sizes[some][None, :]
        if alone:
            near[np.arange(len(own)), at - first + np.arange(len(own))] = False
        linked = np.flatnonzero(near.any(1))
        for i in linked:
            forest.link(own[i], some[near[i]])
        found[own[linked]] += near[linked] @ copies[some]
        if not alone:
            hit = np.flatnonzero(near.any(0))
            found[some[hit]] += copies[own] @ near[:, hit]
    nodes, ids = np.flatnonzero(found), group.gid.to_numpy()
    roots = forest.roots(nodes)
    return pd.DataFrame({"a": ids[nodes], "b": ids[roots], "n": found[nodes]})


def spread_out(rows: np.ndarray, wanted: int) -> np.ndarray:
    """``wanted`` of the rows, each the farthest from those before it."""
    chosen, nearest = [0], 2 - 2 * rows @ rows[0]
    while len(chosen) < min(wanted, len(rows)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, 2 - 2 * rows @ rows[chosen[-1]])
    return rows[chosen]


def cells(distinct: DataFrame, pivots: np.ndarray, cosine: float) -> DataFrame:
    """``distinct`` with each vector's cell; replicas in other cells have home = false."""
    eps = np.sqrt(2 - 2 * cosine)
    apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))

    @F.pandas_udf("array<int>")
    def of_vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        """The home cell, then the lower cells that may hold a partner."""
        for vectors in batches:
            found = []
            for at in range(0, len(vectors), 1024):
                some = vectors.iloc[at : at + 1024]
                width = max([pivots.shape[1], *map(len, some)])
                wide = np.zeros((len(pivots), width))
                wide[:, : pivots.shape[1]] = pivots
                square = 2 - 2 * unit_rows(some, width)[0] @ wide.T
                home = square.argmin(1)
                beyond = square - square[np.arange(len(some)), home][:, None]  # squared distances: home and other pivot
                # Twice the distance to the plane between two pivots is ``beyond`` over their distance.
                reach = (beyond <= 2 * eps * apart[home] + SLACK) & (np.arange(len(pivots))[None] < home[:, None])
                found += [np.append(h, np.flatnonzero(r)).astype(np.int32) for h, r in zip(home, reach)]
            yield pd.Series(found)

    placed = distinct.withColumn("cells", of_vectors("vector"))
    return placed.select("gid", "vector", "copies", F.posexplode("cells").alias("nth", "cell")).select(
        "gid", "vector", "copies", "cell", (F.col("nth") == 0).alias("home")
    )


def links(distinct: DataFrame, cosine: float = COSINE, block: int = BLOCK, most: int = PIVOTS) -> DataFrame:
    """(a, b, n): each linked vector's edge to the root of its tree in a block, and the links counted there.

    ``distinct`` is a written table of different vectors: gid, vector, copies.
    """
    n = distinct.count()
    wanted = min(most, max(1, -(-n // block), min(LEAST, n // 64)))
    sample = distinct.select("vector", F.xxhash64("gid").alias("draw")).orderBy("draw").limit(SPREAD * wanted).collect()
    width = max([len(r["vector"]) for r in sample], default=1)
    pivots = spread_out(unit_rows([r["vector"] for r in sample], width)[0], wanted) if sample else np.zeros((1, width))
    placed = stored(cells(distinct, pivots, cosine), "cells")

    counts = placed.groupBy("cell").agg(
        F.ceil(F.count_if("home") / block).cast("int").alias("homes"),
        F.ceil(F.count_if(~F.col("home")) / block).cast("int").alias("others"),
    )  # one row per pivot, of which there are at most ``most``
    spread = F.pmod(F.xxhash64("gid"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("others"))).cast("int")
    # Broadcast, as a shuffle by cell would do for the blocks too and put all of a cell into one task.
    chunked = placed.join(F.broadcast(counts), "cell").withColumn(
        "chunk", F.when(F.col("home"), spread).otherwise(F.col("homes") + spread)
    )
    # A chunk of homes meets every chunk of the cell, a chunk of replicas every chunk of homes.
    meets = F.when(
        F.col("home"), F.sequence(F.lit(0), F.col("homes") + F.col("others") - 1)
    ).when(F.col("homes") > 0, F.sequence(F.lit(0), F.col("homes") - 1))
    paired = chunked.withColumn("met", F.explode(meets)).select(
        "gid", "vector", "copies", "cell", "chunk",
        F.least("chunk", "met").alias("left_chunk"), F.greatest("chunk", "met").alias("right_chunk"),
    )
    return paired.groupBy("cell", "left_chunk", "right_chunk").applyInPandas(
        lambda group: block_links(group, cosine), "a long, b long, n long"
    )


def near_duplicates(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, block: int = BLOCK,
    most: int = PIVOTS,
) -> DataFrame:
    """One row per row of ``vectors``: id, n_links and component, the smallest id that links reach."""
    v = F.col(vector)
    sound = F.size(v) > 0
    sound &= F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    marked = vectors.select(F.col(id).alias("id"), v.alias("vector"), F.coalesce(sound, F.lit(False)).alias("sound"))
    rows = stored(marked, "vectors")
    alone = rows.filter("NOT sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    rows = rows.filter("sound").withColumn("hash", F.xxhash64("vector"))
    distinct = stored(
        rows.groupBy("hash", "vector")
        .agg(F.count("*").alias("copies"), F.min("id").alias("least"))
        .withColumn("gid", F.monotonically_increasing_id()),
        "distinct",
    )
    found = stored(links(distinct.select("gid", "vector", "copies"), cosine, block, most), "links")
    roots = components(found)
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    placed = (
        distinct.join(roots, distinct["gid"] == roots["node"], "left")
        .join(counts, distinct["gid"] == counts["a"], "left")
        .select("hash", "vector", "least", F.coalesce("component", "gid").alias("root"),
                (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    least = placed.groupBy("root").agg(F.min("least").alias("component"))
    named = placed.join(least, "root").select("hash", "vector", "n_links", "component")
    return rows.join(named, ["hash", "vector"]).select("id", "n_links", "component").union(alone)


def op2(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


#: For ids that do not repeat and vectors of one length.
OP2_SQL = f"""
WITH RECURSIVE sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= {COSINE}),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id)
SELECT vec_id, count(b) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN links ON a = vec_id GROUP BY vec_id, component_id
"""
