"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

Word shingles are numbers of a universe of 2^32; a first permutation scatters them, and
all signature coordinates come from one second permutation, shifted circularly by the
coordinate's number. Bands of coordinates put documents into buckets. In each
bucket a few pivots are compared with all others on full shingle sets, then leave;
members already known to be connected are not compared again. This repeats with more pivots
until no bucket holds two components, so every pair that shares a bucket is decided, while
a large group of copies costs a row per member and round, not a row per pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklake.llm.common import written
from clicklake.llm.components import connected, contracted

SHINGLE_WORDS = 5
BAND_ROWS = 5
#: A pair exactly at the threshold shares no band with at most this probability.
MISS = 1e-6
COLUMNS = 1 << 14
PIVOT_GROWTH = 64

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def bands_for(threshold: float, rows: int = BAND_ROWS, miss: float = MISS) -> int:
    return max(1, math.ceil(math.log(miss) / math.log(1 - threshold**rows)))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def _permuted(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def shingles(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct shingles of a text, as 64-bit hashes."""
    # On bytes, lower() and split() know ASCII letters and white space only.
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    width = min(words, len(found))
    last = len(found) - width + 1
    folded = np.full(last, width, dtype=np.uint64)
    for at in range(width):
        folded = _mixed(folded * np.uint64(0x9E3779B97F4A7C15) + hashed[at : at + last])
    return np.unique(folded)


def signature(found: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash: minima of one permutation, shifted by 0, 1, 2, ..."""
    scattered = _permuted((found ^ (found >> np.uint64(32))).astype(np.uint32) * np.uint32(0x9E3779B1))
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    least = np.full(coordinates, np.iinfo(np.uint32).max, dtype=np.uint32)
    step = max(1, COLUMNS // 16)
    for start in range(0, len(scattered), step):
        np.minimum(least, _permuted(scattered[None, start : start + step] + shifts).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, bands: int) -> np.ndarray:
    by_band = least.reshape(bands, -1).astype(np.uint64)
    folded = np.arange(bands, dtype=np.uint64)
    for at in range(by_band.shape[1]):
        folded = _mixed(folded * np.uint64(0x9E3779B97F4A7C15) + by_band[:, at])
    return folded


def _features(docs: DataFrame, bands: int, rows: int, words: int) -> DataFrame:
    """doc_id, n_shingles, digest (of the set) and bands, of rows of doc_id and text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts, digests, keys = [], [], []
            for text in batch["text"]:
                found = shingles(text, words)
                counts.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(band_keys(signature(found, bands * rows), bands).view(np.int64) if len(found) else None)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_shingles": counts, "digest": digests, "bands": keys})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_shingles long, digest binary, bands array<long>")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, digest and the whole shingle set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingles(text, words) for text in batch["text"]]
            digests = [xxhash.xxh3_128_digest(x.tobytes()) for x in found]
            yield pd.DataFrame({"cid": batch["doc_id"], "digest": digests, "shingles": [x.view(np.int64) for x in found]})

    return docs.select("doc_id", "text").mapInPandas(run, "cid long, digest binary, shingles array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of which full sets reach the similarity, those of a_twin and b_twin."""
    left = sets.select(F.col("cid").alias("a"), F.col("twin").alias("a_twin"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("cid").alias("b"), F.col("twin").alias("b_twin"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - both
    return pairs.join(right, ["b", "b_twin"]).join(left, ["a", "a_twin"]).where(both * 100 >= union * percent).select("a", "b")


def _own_shingles(sets: DataFrame) -> DataFrame:
    """cid, twin, own: how many shingles of a class occur in no other class of `sets`."""
    each = sets.select("cid", "twin", F.explode("shingles").alias("shingle"))
    alone = each.groupBy("shingle").agg(F.count("*").alias("times"), F.min("cid").alias("cid"), F.min("twin").alias("twin")).where("times = 1")
    return alone.groupBy("cid", "twin").agg(F.count("*").alias("own"))


def _several(buckets: DataFrame, percent: int) -> DataFrame:
    """The rows of buckets that can still be linked to another component in their bucket.

    Two classes of n and m shingles share s at most, the lesser of their shingles that occur
    elsewhere, and are similar only if (100 + percent) * s >= percent * (n + m).
    """
    reach = f"{100 + percent} * (n - own) - {percent} * n"
    bounds = buckets.groupBy("key").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("n").alias("least"), F.max(F.expr(reach)).alias("most")
    ).where("low < high")
    possible = buckets.join(bounds, "key").where(f"{reach} >= {percent} * least and most >= {percent} * n")
    return possible.select(*buckets.columns)


def near_duplicates(docs: DataFrame, percent: int = 85, words: int = SHINGLE_WORDS, rows: int = BAND_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, a row per row of docs.

    Documents are linked when 100 * |A and B| >= percent * |A or B| for their sets of
    word shingles; component_id is the smallest doc_id reachable over links. Equal sets are
    one class from the start, so exact copies are linked without being compared. A null or
    empty text has an empty set and is linked with nothing. A null doc_id can't be linked:
    its component is null and it is kept. Rows that repeat a doc_id are one document with
    the links of all its texts. Only doc_id and text are read.
    """
    bands = bands_for(percent / 100, rows)
    features = written(_features(docs, bands, rows, words))
    usable = features.where("doc_id is not null and digest is not null")
    # Written, so that the join of copies to their class has a shuffle of its own that Spark can split.
    classes = written(usable.groupBy("digest").agg(F.min("doc_id").alias("cid"), F.min("n_shingles").alias("n"), F.first("bands").alias("bands")))
    # A class is its smallest doc_id and, as that can have several texts, a hash of its set.
    classes = classes.withColumn("twin", F.xxhash64("digest"))
    # A band of one class only decides nothing.
    rows_of = classes.select("cid", "twin", F.col("cid").alias("comp"), "n", F.lit(0).cast("long").alias("own"), F.posexplode("bands").alias("band", "key"))
    buckets = written(_several(rows_of, percent))
    members = usable.select("doc_id", "digest").join(classes.select("digest", "cid"), "digest")
    compared = buckets.select("cid", "twin").distinct()
    columns = ["cid", "twin", "comp", "n", "own", "band", "key", "bands"]
    texts = docs.select("doc_id", "text").join(compared, F.col("doc_id") == F.col("cid"), "left_semi")
    each = _sets(texts, words).withColumn("twin", F.xxhash64("digest"))
    sets = written(each.join(compared, ["cid", "twin"], "left_semi").dropDuplicates(["cid", "twin"]))
    counted = buckets.drop("own").join(_own_shingles(sets), ["cid", "twin"], "left").withColumn("own", F.coalesce("own", F.lit(0)))
    buckets = written(_several(counted.join(classes.select("cid", "twin", "bands"), ["cid", "twin"]).select(*columns), percent))

    pivots = 1
    found: list[DataFrame] = []
    while not buckets.isEmpty():
        # Those with the fewest shingles of their own are most like the others.
        part = F.pmod(F.xxhash64("cid", "twin"), F.lit(pivots)).alias("part")
        chosen = buckets.groupBy("key", part).agg(F.min(F.struct("own", "cid", "twin", "comp", "n", "bands")).alias("pivot"))
        own = chosen.select("key", "part", F.col("pivot.cid").alias("own_cid"), F.col("pivot.twin").alias("own_twin"))
        marked = buckets.withColumn("part", part).join(own, ["key", "part"]).drop("part")
        met = marked.join(chosen.drop("part"), "key").where(
            # Two pivots of a bucket meet once, not once from either side.
            "(cid <> own_cid or twin <> own_twin or cid < pivot.cid) and"
            f" comp <> pivot.comp and {100 + percent} * least(n - own, pivot.n - pivot.own) >= {percent} * (n + pivot.n)"
            # Of the buckets that two are in, the first decides about them.
            " and forall(slice(zip_with(bands, pivot.bands, (x, y) -> x = y), 1, band), same -> not same)"
        )
        ends = F.struct("cid", "twin"), F.struct("pivot.cid", "pivot.twin")
        pairs = met.select(F.greatest(*ends).alias("a"), F.least(*ends).alias("b")).selectExpr(
            "a.cid as a", "a.twin as a_twin", "b.cid as b", "b.twin as b_twin"
        ).distinct()
        new = written(_verified(pairs, sets, percent))
        gone = chosen.select("key", F.col("pivot.cid").alias("cid"), F.col("pivot.twin").alias("twin"))
        rest = buckets.join(gone, ["key", "cid", "twin"], "left_anti")
        if not new.isEmpty():
            found.append(new)
            # Members of one component are not compared again; that some of them are not known as such yet costs comparisons alone.
            comps = contracted(reduce(DataFrame.union, found)).select(F.col("member").alias("cid"), "component")
            rest = rest.join(comps, "cid", "left").withColumn("comp", F.least("comp", "component")).drop("component")
        buckets = written(_several(rest.select(*columns), percent))
        pivots *= PIVOT_GROWTH

    copies = members.where("doc_id <> cid").select(F.col("doc_id").alias("a"), F.col("cid").alias("b"))
    graph = connected(reduce(DataFrame.union, [copies, *found]))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        features.join(graph, F.col("doc_id") == F.col("member"), "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def without_near_duplicates(docs: DataFrame, percent: int = 80, words: int = SHINGLE_WORDS) -> DataFrame:
    """The documents with one of each group of near duplicates, that of the smallest doc_id.

    Of rows that repeat a doc_id one stays. Documents without words and those
    with a null doc_id all stay. All columns are returned as they came.
    """
    kept = near_duplicates(docs, percent, words).where("kept and doc_id is not null").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("order"))
    joined = rows.join(kept, F.col("id") == F.col("kept_id"))
    one = joined.withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy("order"))).where("place = 1")
    unnamed = rows.where("id is null")
    return one.select("row.*").union(unnamed.select("row.*"))
