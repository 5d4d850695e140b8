"""Embedding near-duplicates with a pivot-permutation index.

A vector is described by its nearest reference points (pivots), in order. Two vectors within
the threshold share several of their `nearest` pivots, so each vector is listed under all
but the last `shared` - 1 of them, the rarest pivots first, in inverted lists. Within a list
the pivots that two vectors share are counted first, and only pairs that share `shared` pivots
are compared by cosine in double precision; a pair is decided in the first list that holds
both. Long lists are cut into blocks. Pivots grow with the root of the
rows, so lists grow more slowly than the table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import hash_sample, written
from clicklake.llm.components import connected

THRESHOLD = 0.93
#: Rows, in the order of a hash, from which the pivots are chosen.
SAMPLE = 2048
#: Pivots are the root of the number of different vectors, within these bounds.
PIVOTS = (128, 512)
NEAREST, SHARED = 12, 4
BLOCK = 512


def usable(vector: Column) -> Column:
    """Not null, not zero, and of finite components only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(vector, lambda x: x != 0)
    return F.coalesce(vector.isNotNull() & ~bad & ~zero, F.lit(False))


def unit(vectors) -> np.ndarray:
    """Rows of length 1 in double precision, also where squares would overflow."""
    rows = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def pivots_for(rows: int) -> int:
    """How many pivots an index of so many vectors has."""
    least, most = PIVOTS
    return min(most, max(least, math.isqrt(rows)))


def choose_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Reference points far from each other: each next one is the farthest from those chosen."""
    chosen = [0]
    closest = sample @ sample[0]
    for _ in range(min(pivots, len(sample)) - 1):
        chosen.append(int(closest.argmin()))
        np.maximum(closest, sample @ sample[chosen[-1]], out=closest)
    return sample[chosen]


def _fitted(classes: DataFrame, sample: int, pivots: int) -> dict[int, np.ndarray]:
    """Pivots by dimension, from a bounded sample of the classes."""
    picked = hash_sample(classes, "cid", sample).select("cid", "vector").dropDuplicates(["cid"]).toPandas().sort_values("cid")["vector"]
    by_size: dict[int, list] = {}
    for vector in picked:
        by_size.setdefault(len(vector), []).append(vector)
    return {size: choose_pivots(unit(vectors), pivots) for size, vectors in by_size.items()}


def _described(classes: DataFrame, fitted: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """The classes with their nearest pivots in order; none where the dimension has no pivots."""

    def run(batches):
        for batch in batches:
            batch = batch.copy()
            near: list = [[-1]] * len(batch)
            sizes = batch["vector"].map(len).to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                if size in fitted:
                    close = unit(batch["vector"].iloc[at]) @ fitted[size].T
                    for row, order in zip(at, np.argsort(-close, axis=1, kind="stable")[:, :nearest], strict=True):
                        near[row] = order.tolist()
            batch["near"] = near
            yield batch

    fields = ", ".join(f"{c} {t}" for c, t in classes.dtypes)
    return classes.mapInPandas(run, f"{fields}, near array<int>")


def _membership(listed: np.ndarray, kinds: int) -> np.ndarray:
    """A row per vector, a column per pivot: 1 where the vector lists it."""
    found = np.zeros((len(listed), kinds), dtype=np.float32)
    found[np.arange(len(listed))[:, None], listed] = 1
    return found


def shared_pivots(listed: np.ndarray, kinds: int) -> np.ndarray:
    """How many pivots any two of the vectors share."""
    member = _membership(listed, kinds)
    return member @ member.T


def _candidates(near: np.ndarray, rank: np.ndarray, here: int, shared: int, prefix: int) -> np.ndarray:
    """The pairs (first place below the second) of the list of pivot `here` that it has to compare.

    They share enough pivots, and no list of a rarer pivot holds both. Vectors of one list
    have equally many pivots.
    """
    first_ones = np.sort(rank[near], axis=1)[:, :prefix]
    before = _membership(first_ones, len(rank))[:, : rank[here]]
    return np.triu((shared_pivots(near, len(rank)) >= min(shared, near.shape[1])) & (before @ before.T == 0), 1)


def _roots(linked: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links: the smallest place reachable from each place."""
    root = np.full(len(linked), -1)
    for start in range(len(linked)):
        if root[start] < 0:
            root[start], edge = start, [start]
            while edge:
                fresh = np.flatnonzero(linked[edge].any(axis=0) & (root < 0))
                root[fresh], edge = start, fresh.tolist()
    return root


def _compare(group: pd.DataFrame, rank: np.ndarray, threshold: float, shared: int, prefix: int) -> pd.DataFrame:
    """The links of one pair of blocks of a list: counts per class and one link to its local root."""
    group = group.sort_values("cid", ignore_index=True)
    here, first, second = group["pivot"].iloc[0], group["first"].iloc[0], group["second"].iloc[0]
    vectors = unit(group["vector"])
    wanted = _candidates(np.stack(group["near"]), rank, here, shared, prefix)
    if first != second:  # pairs inside one block are decided where it meets itself
        block = group["block"].to_numpy()
        wanted &= block[:, None] != block[None, :]
    linked = np.zeros(wanted.shape, dtype=bool)
    for at in np.flatnonzero(wanted.any(axis=1)):
        others = np.flatnonzero(wanted[at])
        linked[at, others] = vectors[others] @ vectors[at] >= threshold
    linked |= linked.T
    counts = linked @ group["copies"].to_numpy(dtype=np.int64)
    cid = group["cid"].to_numpy()
    out = pd.DataFrame({"cid": cid, "links": counts, "root": cid[_roots(linked)]})
    return out[out["links"] > 0]


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, pivots: int | None = None,
    nearest: int = NEAREST, shared: int = SHARED, block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of rows of vec_id, embedding and label.

    Rows with the same label that is not null are linked from a cosine of `threshold` on.
    Equal vectors are one class, compared once and counted as often as they occur. Vectors that
    are null, zero or hold null or non-finite components, and those of different
    length, link with nothing. A null vec_id can't be a component: such
    rows get no links. Repeated vec_ids are rows of their own, in one component; if their vectors
    differ, each has the links of all of them. Without `pivots` their number is that of `pivots_for`.
    """
    rows = vectors.select(
        "vec_id", "label", F.col("embedding").alias("vector"),
        (usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).alias("valid"),
    ).withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})
    key = ["label", "h1", "h2"]
    classes = written(
        rows.where("valid").groupBy(*key).agg(F.min("vec_id").alias("cid"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .withColumn("size", F.size("vector"))
    )
    pivots = pivots or pivots_for(classes.count())
    fitted = _fitted(classes, sample, pivots)
    described = written(_described(classes.select("cid", "label", "size", "copies", "vector"), fitted, nearest))

    # At most `pivots` + 1 counts: the rarest pivot comes first.
    listed = dict(described.select(F.explode("near").alias("pivot")).groupBy("pivot").count().collect())
    order = sorted(range(-1, pivots), key=lambda p: (listed.get(p, 0), p))
    rank = np.empty(pivots + 1, dtype=np.int64)  # the last place is that of -1
    rank[order] = np.arange(pivots + 1)
    prefix = max(1, nearest - shared + 1)
    ranks = F.array(*[F.lit(int(r)) for r in rank])
    place = F.transform("near", lambda p: F.struct(F.element_at(ranks, F.when(p < 0, F.lit(pivots + 1)).otherwise(p + 1)).alias("rank"), p.alias("pivot")))
    first_ones = F.slice(F.array_sort(place), 1, prefix)
    in_lists = described.withColumn("pivot", F.explode(F.transform(first_ones, lambda x: x["pivot"])))
    whose = ["label", "size", "pivot"]
    lengths = in_lists.groupBy(*whose).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    cut = in_lists.join(lengths, whose).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    meets = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meets = meets.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return _compare(group, rank, threshold, shared, prefix)

    found = written(meets.groupBy(*whose, "first", "second").applyInPandas(run, "cid long, links long, root long"))
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    graph = connected(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    known = (
        classes.select(*key, "cid", "copies").join(counts, "cid", "left")
        .join(graph, F.col("cid") == F.col("member"), "left")
        .select(*key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "cid").alias("component_id"))
    )
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.where("valid").select("vec_id", *key).join(known, key).select("vec_id", "n_links", "component_id")
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def recall(vectors: np.ndarray, threshold: float, fitted: np.ndarray, nearest: int, shared: int) -> tuple[float, float]:
    """By brute force: the share of the pairs at the threshold that share enough pivots, and of all pairs that are compared."""
    rows = unit(vectors)
    enough = shared_pivots(np.argsort(-(rows @ fitted.T), axis=1, kind="stable")[:, :nearest], len(fitted)) >= shared
    pairs = np.triu_indices(len(rows), 1)
    true = (rows @ rows.T >= threshold)[pairs]
    return (float(enough[pairs][true].mean()) if true.any() else math.nan), float(enough[pairs].mean())
