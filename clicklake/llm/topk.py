"""Exact top-k by inner product, with a three-phase uniform threshold.

The components of a vector are cut into slices, and the score is the sum of the slices'
partial scores. Queries and candidates meet in blocks.

1. Each block lists, per query and slice, the candidates with the largest partial
   scores; only those listed are summed, and the k-th largest sum of a query is
   its cutoff: at least k candidates reach it.
2. The cutoff goes back to the blocks. A candidate that reaches it must reach
   cutoff / slices in one slice at least, so all others are left out unsummed.
3. What is left is summed exactly, and each block hands on its k best that reach the cutoff.

The fewer the slices, the more the cutoff leaves out; of two, one holds half of any score at least.
Partial scores of all pairs are computed in both phases, as none are stored between them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklake.llm.common import written

SLICES = 2
#: Candidates listed per slice, as a multiple of k: longer lists raise the cutoff, but are summed themselves.
LISTED = 2
QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 8192
TILE = 256
EXACT_DOUBLE = 2.0**53


def usable(vector: Column) -> Column:
    """True for a vector that is not null and holds finite components only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector
    return out


class _Block:
    """One block of queries against one block of candidates."""

    def __init__(self, queries: pd.DataFrame, candidates: pd.DataFrame, slices: int) -> None:
        width = max((len(v) for frame in (queries, candidates) for v in frame["vector"]), default=0)
        left, right = _matrix(queries["vector"], width), _matrix(candidates["vector"], width)
        largest = [float(np.abs(m).max(initial=0)) for m in (left, right)]
        # Sums below 2^53 are exact in doubles, whose products are much faster.
        kind = np.float64 if width * largest[0] * largest[1] < EXACT_DOUBLE else np.int64
        self.left, self.right = left.astype(kind), np.ascontiguousarray(right.T.astype(kind))
        self.cuts = np.array_split(np.arange(width), max(1, min(slices, width)))
        self.query_id = queries["query_id"].to_numpy()
        self.vec_id = candidates["vec_id"].to_numpy()

    def tiles(self):
        """For some queries at a time: their places, the partial scores of each slice, own rows masked."""
        for start in range(0, len(self.query_id), TILE):
            at = np.arange(start, min(start + TILE, len(self.query_id)))
            same = self.query_id[at][:, None] == self.vec_id[None, :]
            yield at, [self.left[np.ix_(at, cut)] @ self.right[cut] for cut in self.cuts], same


def _listed(queries: pd.DataFrame, candidates: pd.DataFrame, k: int, slices: int) -> pd.DataFrame:
    """Phase 1: exact scores of the candidates at the head of some slice's list, the k best per query."""
    block, parts = _Block(queries, candidates, slices), []
    depth = min(LISTED * k + 1, len(block.vec_id))  # one more, as the query itself may be listed
    for at, partial, same in block.tiles():
        listed = np.zeros(same.shape, dtype=bool)
        rows = np.arange(len(at))[:, None]
        for scores in partial:
            listed[rows, np.argpartition(scores, -depth, axis=1)[:, -depth:]] = True
        row, column = np.nonzero(listed & ~same)
        score = sum(scores[row, column] for scores in partial)
        parts.append(pd.DataFrame({"query_id": block.query_id[at][row], "score": score.astype(np.int64)}))
    found = pd.concat(parts).sort_values(["query_id", "score"], ascending=[True, False])
    return found.groupby("query_id").head(k)


def _sufficient(partial: list[np.ndarray], bar: np.ndarray) -> np.ndarray:
    """Phase 2: the entries of which some partial score reaches its share of the cutoff."""
    return np.maximum.reduce(partial) >= bar // len(partial)  # partial scores are whole numbers


def _resolved(queries: pd.DataFrame, candidates: pd.DataFrame, k: int, slices: int) -> pd.DataFrame:
    """Phases 2 and 3: the k best of the block that reach the query's cutoff."""
    block, parts = _Block(queries, candidates, slices), []
    cutoff = queries["cutoff"].to_numpy(dtype=np.int64)
    for at, partial, same in block.tiles():
        bar = cutoff[at][:, None]
        row, column = np.nonzero(_sufficient(partial, bar) & ~same)
        score = sum(scores[row, column] for scores in partial)
        reach = score >= bar[row, 0]
        row, column, score = row[reach], column[reach], score[reach].astype(np.int64)
        parts.append(pd.DataFrame({"query_id": block.query_id[at][row], "vec_id": block.vec_id[column], "score": score}))
    found = pd.concat(parts).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return found.groupby("query_id").head(k)


def exact_top_k(queries: DataFrame, candidates: DataFrame, k: int, slices: int = SLICES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k largest inner products.

    queries has query_id and vector, candidates vec_id and vector, both arrays of whole
    numbers without nulls and ids that are not null. Shorter vectors count as filled up with 0.
    A candidate with the query's own id is left out; equal scores go by the smaller
    vec_id; a query with fewer candidates gets all. Scores are exact up to
    the range of a long.
    """
    many_queries, many = queries.count(), candidates.count()
    across, along = max(1, math.ceil(many_queries / QUERY_BLOCK)), max(1, math.ceil(many / CANDIDATE_BLOCK))

    def blocks(frame: DataFrame, own: str, key: str, count: int, other: str, others: int) -> DataFrame:
        placed = frame.withColumn(own, F.pmod(F.xxhash64(key), F.lit(count)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    def meet(asked: DataFrame, work, schema: str) -> DataFrame:
        left = blocks(asked, "qb", "query_id", across, "cb", along).groupBy("qb", "cb")
        right = blocks(candidates, "cb", "vec_id", along, "qb", across).groupBy("qb", "cb")

        def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            return work(a, b, k, slices) if len(a) and len(b) else pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])

        return left.cogroup(right).applyInPandas(run, schema)

    heads = meet(queries, _listed, "query_id long, score long")
    place = F.row_number().over(_by_query(F.col("score").desc()))
    kth = heads.withColumn("place", place).where(F.col("place") <= k).groupBy("query_id")
    cutoffs = kth.agg(F.when(F.count("*") >= k, F.min("score")).alias("cutoff"))
    lowest = F.lit(-(2**63)).cast("long")
    asked = written(queries.join(cutoffs, "query_id", "left").withColumn("cutoff", F.coalesce("cutoff", lowest)))
    found = meet(asked, _resolved, "query_id long, vec_id long, score long")
    rank = F.row_number().over(_by_query(F.col("score").desc(), F.col("vec_id")))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _by_query(*order: Column):
    return Window.partitionBy("query_id").orderBy(*order)
