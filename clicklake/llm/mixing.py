"""Mixing sources to target weights: repetition rates per source, copies per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklake.llm.common import hash_draw, key_text, word_count, written

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
#: A table of rates of at most so many rows is broadcast; a larger one is joined by salted key.
BROADCAST_ROWS = 10_000
SALTS = 64


def source_rates(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target, rate from rows of source and size.

    Sources by code point, null last, take the weights in turn and share all words by
    weight; a target stops at `most` times its source's size and the excess goes to
    the others by weight until none is above. This is one scan along the ratio of
    cap to weight: the sources that stop are those of the smallest ratios. A source without
    words has target and rate 0.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(listed, (place % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * float(most))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    ahead = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({
        "words": F.sum("source_size").over(everything).cast("double"),
        "cap_ahead": F.coalesce(F.sum("cap").over(ahead), F.lit(0.0)),
        "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(ahead), F.lit(0.0)),
    })
    # The share of one unit of weight if exactly the sources ahead stop at their caps.
    # It is largest at the first source that does not stop, and right there.
    per = per.withColumn("unit", (F.col("words") - F.col("cap_ahead")) / F.col("weight_left"))
    stops = F.col("cap") <= F.col("unit") * F.col("weight")
    unit = F.max(F.when(~stops, F.col("unit"))).over(everything)
    per = per.withColumn("target", F.when(stops, F.col("cap")).otherwise(unit * F.col("weight")))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    return per.select("source", "source_size", "target", rate.alias("rate"))


def _drawn(docs: DataFrame, weights: tuple[float, ...], most: int, seed: str) -> DataFrame:
    """row (the document as it came), size, source_size, target, rate, copies."""
    sized = docs.select(F.struct("*").alias("row"), word_count(F.col("text")).alias("size"))
    rates = written(source_rates(sized.select("row.source", "size"), weights, most))
    same = F.col("row.source").eqNullSafe(F.col("source"))
    if rates.count() <= BROADCAST_ROWS:
        joined = sized.join(F.broadcast(rates), same)
    else:
        salted = rates.withColumn("rate_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("row.doc_id"), F.lit(SALTS)).cast("int")
        joined = sized.withColumn("salt", salt).join(salted, same & (F.col("salt") == F.col("rate_salt")))
    draw = hash_draw(F.lit(seed), key_text(F.col("row.doc_id")))
    whole = F.floor("rate")
    extra = (draw < F.col("rate") - whole).cast("long")
    return joined.select("row", "size", "source_size", "target", "rate", (whole + extra).alias("copies"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = "mix") -> DataFrame:
    """Every row with its size, its source's size, target and rate, and its copies.

    copies is floor(rate) and one more with a probability equal to the fraction,
    drawn by a hash of seed and doc_id, so reruns agree. A null text has size 0; null
    sources are one source, last in order; rows that repeat a doc_id draw alike. Columns
    named size, source_size, target, rate or copies are replaced.
    """
    added = ["size", "source_size", "target", "rate", "copies"]
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in added]
    return _drawn(docs, weights, most, seed).select(*kept, *added)


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = "mix") -> DataFrame:
    """The mixed corpus: every document as often as `mix` decides, with all columns as they came."""
    taken = _drawn(docs, weights, most, seed).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
