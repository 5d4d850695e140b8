"""Centroid clustering in whole numbers, by a tournament of bisectors.

For two centroids a and b the plane between them has the normal 2 * (b - a) and the threshold
|b|^2 - |a|^2: a vector is nearer to b exactly if its product with the normal is above the
threshold. Normals and thresholds of all pairs are computed once a round. A vector then takes
k - 1 sign tests: the winner so far meets the next centroid, and zero favours the winner so far, whose
number is smaller. Only the distance to the last winner is computed, exactly.

Components are whole numbers of any size. Rows whose products fit 64 bits are
worked on as such, all others as Python's numbers; sums over vectors travel as limbs of LIMB bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import written

#: Vectors whose components are below 2^HALF in size have products and distances that fit 64 bits, in 512 dimensions at most.
HALF = 25
#: Sums of limbs of so many bits fit 64 bits up to 2^33 vectors.
LIMB = 30
BATCH = 4096


def whole(vectors, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of every component, and which rows are small: those are right as 64-bit numbers.

    The other rows are 0 here; `large` has them.
    """
    rows = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    small = (np.abs(rows) < 2.0**HALF / scale).all(axis=1)
    return np.where(small[:, None], np.floor(rows * scale), 0).astype(np.int64), small


def large(vector, scale: int) -> list[int]:
    """floor(scale * x) of every component as Python's numbers; exact also where scale * x is above all doubles."""
    found = []
    for x in vector:
        over, under = float(x).as_integer_ratio()
        found.append(over * scale // under)
    return found


@dataclass
class Tournament:
    """Centroids with the normals and thresholds of all pairs."""

    centroids: list[list[int]]

    def __post_init__(self) -> None:
        self.exact = any(abs(x) >= 2**HALF for c in self.centroids for x in c)
        kind = object if self.exact else np.int64
        self.points = np.array(self.centroids, dtype=kind).reshape(len(self.centroids), -1)
        self.normals = 2 * (self.points[None, :, :] - self.points[:, None, :])
        squares = (self.points * self.points).sum(axis=1)
        self.thresholds = squares[None, :] - squares[:, None]

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row, the smaller number in ties, and its squared distance."""
        winner = np.zeros(len(rows), dtype=np.int64)
        if rows.dtype == object or self.exact:
            rows = rows.astype(object)
        for other in range(1, len(self.points)):
            normals = self.normals[winner, other]
            side = (rows * normals).sum(axis=1) if rows.dtype == object else np.einsum("nd,nd->n", rows, normals)
            winner[np.asarray(side > self.thresholds[winner, other], dtype=bool)] = other
        apart = rows - self.points[winner]
        return winner, (apart * apart).sum(axis=1)


def _batches(batch: pd.DataFrame, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the batch with their vectors as whole numbers, small ones and large ones apart."""
    for start in range(0, len(batch), BATCH):
        part = batch["vector"].iloc[start : start + BATCH]
        rows, small = whole(part, scale)
        at = np.flatnonzero(small)
        if len(at):
            yield start + at, rows[at]
        rest = np.flatnonzero(~small)
        if len(rest):
            yield start + rest, np.array([large(part.iloc[i], scale) for i in rest], dtype=object)


def _limbs(number: int) -> dict[int, int]:
    """{place: limb} with number = sum of limb << (LIMB * place); the sign is that of the number."""
    found, rest, place, sign = {}, abs(number), 0, -1 if number < 0 else 1
    while rest:
        if rest & (1 << LIMB) - 1:
            found[place] = sign * (rest & (1 << LIMB) - 1)
        rest, place = rest >> LIMB, place + 1
    return found


def _summed(vectors: DataFrame, of: Tournament, scale: int, size: int) -> dict[int, tuple[int, list[int]]]:
    """{cluster: (vectors, componentwise sums)}; k rows for each limb in use come to the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, rows in _batches(batch, scale):
                winner, _ = of.assign(rows)
                found = []
                for cluster in np.unique(winner):
                    mine = rows[winner == cluster]
                    sums: dict[int, list[int]] = {}
                    for at, total in enumerate(mine.sum(axis=0)):
                        for place, limb in _limbs(int(total)).items():
                            sums.setdefault(place, [0] * size)[at] = limb
                    sums.setdefault(0, [0] * size)
                    found += [(int(cluster), place, len(mine) if place == 0 else 0, limbs) for place, limbs in sums.items()]
                yield pd.DataFrame(found, columns=["cluster", "place", "vectors", "limbs"])

    partial = vectors.select("vector").mapInPandas(run, "cluster int, place int, vectors long, limbs array<long>")
    total = partial.groupBy("cluster", "place").agg(F.sum("vectors").alias("vectors"), *[F.sum(F.col("limbs")[at]).alias(f"d{at}") for at in range(size)])
    sums: dict[int, tuple[int, list[int]]] = {}
    for row in total.collect():
        count, so_far = sums.get(row["cluster"], (0, [0] * size))
        sums[row["cluster"]] = count + row["vectors"], [x + (row[f"d{at}"] << (LIMB * row["place"])) for at, x in enumerate(so_far)]
    return sums


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list:
    """The vectors of the k rows with the smallest sha256 of `seed:vec_id`, in that order; null ids come last.

    Only ids and hashes are sorted; then k vectors are read by id. Rows that share an id stand in the order of their components.
    """
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    order = [F.col("hash").asc_nulls_last()]
    best = vectors.select("vec_id", name.alias("hash")).orderBy(*order).limit(k).select("vec_id").distinct()
    chosen = vectors.join(F.broadcast(best), vectors["vec_id"].eqNullSafe(best["vec_id"]), "left_semi")
    counted = chosen.groupBy("vec_id", "vector").agg(F.count("*").alias("times"))
    rows = counted.withColumn("hash", name).orderBy(*order, "vector").limit(k).collect()
    return [row["vector"] for row in rows for _ in range(min(row["times"], k))][:k]


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, size: int = 64, seed: int = 2) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: a row per usable row.

    vectors has vec_id and embedding. A row is used if its embedding has `size` components, none
    of them null or not finite; x counts as floor(scale * x), and scale is a power of two, so that
    no product is rounded. The first centroids are
    the rows with the smallest hashes (see first_centroids), fewer than k if there are fewer
    rows. Each round assigns every vector to the nearest centroid, the smaller number in ties, and moves
    every centroid that has vectors to the floor of their mean; then all are assigned once more.
    Distances are squared. A distance or sum beyond 64 bits is null. Rows that share a
    vec_id are rows of their own. Other columns are not read.
    """
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fits = F.coalesce((F.size("embedding") == size) & ~odd, F.lit(False))
    kept = vectors.where(fits).select("vec_id", F.col("embedding").alias("vector"))
    centroids = [large(v, scale) for v in first_centroids(kept, k, seed)]
    schema = "vec_id long, cluster int, distance decimal(38,0)"
    if not centroids:
        placed = kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("decimal(38,0)").alias("distance"))
    else:
        for _ in range(rounds):
            for number, (count, sums) in _summed(kept, Tournament(centroids), scale, size).items():
                centroids[number] = [total // count for total in sums]
        last = Tournament(centroids)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at, rows in _batches(batch, scale):
                    winner, apart = last.assign(rows)
                    wide = [int(x) if x < 2**63 else None for x in apart]
                    yield pd.DataFrame({"vec_id": batch["vec_id"].to_numpy()[at], "cluster": winner, "distance": wide}).astype({"distance": "Int64"})

        text_id = kept.withColumn("vec_id", F.col("vec_id").cast("string"))  # so that a null turns no id into a float
        placed = text_id.mapInPandas(run, "vec_id string, cluster int, distance long").selectExpr("cast(vec_id as long) vec_id", "cluster", "distance")
        placed = written(placed)
    return _with_sums(placed, centroids)


def _with_sums(placed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """The rows with the sums of distances and the hashes of centroids: at most k rows are broadcast."""
    spark = placed.sparkSession
    texts = [",".join(map(str, c)) for c in centroids]
    hashes = [(at, hashlib.sha256(text.encode()).hexdigest()) for at, text in enumerate(texts)]
    names = spark.createDataFrame(hashes, "cluster int, centroid_sha256 string")
    # Null where a distance is: a sum without it would not be the sum.
    total = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = placed.groupBy("cluster").agg(total.alias("wide")).collect()
    known = [row["wide"] for row in sums]
    inertia = None if None in known else sum(map(int, known))
    fit = lambda x: None if x is None or int(x) >= 2**63 else int(x)
    per = spark.createDataFrame([(row["cluster"], fit(row["wide"]), fit(inertia)) for row in sums], "cluster int, cluster_inertia long, inertia long")
    found = placed.join(F.broadcast(per), "cluster").join(F.broadcast(names), "cluster")
    return found.select("vec_id", "cluster", F.col("distance").cast("long").alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")
