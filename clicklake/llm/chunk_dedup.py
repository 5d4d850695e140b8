"""Exact dedup by content-defined chunk recipes, with column functions only.

A text without its white space is cut where its own characters say so: at the first end of
a sentence once a chunk has MIN_CHUNK characters, at MAX_CHUNK at the latest. A chunk's identifier is
a hash, verified against the contents: distinct contents are gathered once, and where two share a
hash, their place among the contents of that hash is part of the identifier. A document's
recipe is the ordered list of its identifiers, and texts are equal exactly if their recipes are. So
each distinct chunk is moved once, by the task that reads it, and documents are compared by
lists that are a hundredth of their length.

Rows that are alike in recipe, length and doc_id are counted where they are read, so neither a
group of copies nor a repeated row meets in one task.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import safe_name, written

BLANKS = " \t\n\x0b\x0c\r"
MIN_CHUNK, MAX_CHUNK = 512, 4096
#: A chunk ends behind one of these: full stops and the like of several scripts.
ENDS = ".!?;:。！？；：।؟"


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The chunks of a text, in order; together they are the text."""
    cut = f"(?s).{{{least - 1},{most - 1}}}?[{ENDS}]|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def _hashed(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def shared_hashes(texts: DataFrame, hashed=_hashed) -> DataFrame | None:
    """chunk_hash, chunk, twin: the contents that share a hash with another content, numbered. None if there are none.

    Reads the column `text`, whose white space is gone. Contents move once, those of a task that are equal as one.
    """
    each = texts.select(F.explode(chunks(F.col("text"))).alias("chunk")).withColumn("chunk_hash", hashed(F.col("chunk")))
    several = written(each.distinct().groupBy("chunk_hash").agg(F.count("*").alias("contents")).where("contents > 1"))
    if several.isEmpty():
        return None
    found = written(each.join(several, "chunk_hash", "left_semi").distinct())
    # Of n contents with one hash, each is compared with the others of that hash: n is 2 but for bad luck.
    less = found.select("chunk_hash", F.col("chunk").alias("other"))
    before = found.join(less, "chunk_hash").where("other < chunk").groupBy("chunk_hash", "chunk").agg(F.count("*").alias("twin"))
    return written(found.join(before, ["chunk_hash", "chunk"], "left").select("chunk_hash", "chunk", F.coalesce("twin", F.lit(0)).alias("twin")))


def recipes(docs: DataFrame, hashed=_hashed) -> DataFrame:
    """doc_id, n_chars, text_sha256, recipe and copies: rows alike in the first four are counted, per reading task.

    `recipe` is the list of verified identifiers: hashes, each followed by its number where
    contents share the hash.
    """
    own = docs.select(F.col("doc_id"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), normalised(F.col("text")).alias("text"))
    shared = shared_hashes(own, hashed)
    cut = own.select("doc_id", "n_chars", F.sha2("text", 256).alias("text_sha256"), chunks(F.col("text")).alias("parts"))
    named = cut.withColumn("recipe", F.transform("parts", hashed))
    if shared is not None:
        named = _disambiguated(named, shared)
    counted = named.withColumn("task", F.spark_partition_id())
    return counted.groupBy("recipe", "text_sha256", "n_chars", "doc_id", "task").agg(F.count("*").alias("copies"))


def _disambiguated(cut: DataFrame, shared: DataFrame) -> DataFrame:
    """Recipes in which hashes of several contents are followed by the content's number."""
    hashes = shared.groupBy().agg(F.collect_set("chunk_hash").alias("known"))  # two contents of one 64-bit hash are rare
    marked = cut.join(F.broadcast(hashes)).withColumn("at", F.monotonically_increasing_id())
    plain = marked.where(~F.arrays_overlap("recipe", "known")).select("doc_id", "n_chars", "text_sha256", "recipe")
    doubted = marked.where(F.arrays_overlap("recipe", "known"))
    kept = ["doc_id", "n_chars", "text_sha256"]
    each = doubted.select("at", *kept, F.posexplode("parts").alias("place", "chunk"), "recipe")
    each = each.withColumn("chunk_hash", F.element_at("recipe", F.col("place") + 1)).drop("recipe")
    told = each.join(shared, ["chunk_hash", "chunk"], "left")
    ids = F.when(F.col("twin").isNull(), F.array("chunk_hash")).otherwise(F.array("chunk_hash", "twin"))
    back = told.groupBy("at", *kept).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", ids.alias("ids")))), lambda x: x["ids"])).alias("recipe"))
    return plain.unionByName(back.select("doc_id", "n_chars", "text_sha256", "recipe"))


def exact_groups(docs: DataFrame, hashed=_hashed) -> DataFrame:
    """doc_id, n_chars, text_sha256, group_size, keep_id, kept: a row per row of docs.

    Texts are equal when they are identical without white space (U+0020, U+0009 to U+000D);
    null counts as empty, and empty texts are equal. Of equal texts stays the row with the
    most code points in its original text, then with the smallest doc_id; a null doc_id comes after
    all others, and keep_id is null where only such rows are longest. Of rows alike in doc_id and length exactly
    one is kept. Only doc_id and text are read.
    """
    rows = written(recipes(docs, hashed).withColumn("rank", _rank()))
    # Written, so that the rows of a large group join it by a shuffle that Spark can split.
    groups = written(rows.groupBy("recipe").agg(F.max("rank").alias("best"), F.max_by("doc_id", "rank").alias("keep_id"), F.sum("copies").alias("group_size")))
    marked = rows.join(groups, "recipe").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    kept = ((F.col("rank") == F.col("best")) & (F.col("copy") == 1)).alias("kept")
    return marked.select("doc_id", "n_chars", "text_sha256", "keep_id", "group_size", kept)


def _rank() -> Column:
    """The longest text first, then the smallest doc_id (null last), then the first task, as one number.

    Maxima of numbers need no sorting, as those of structs do. At most 2^31 characters, 2^64 + 1 ids and 2^24 tasks fit.
    """
    id_place = F.coalesce(F.lit(Decimal(2**63)) - F.col("doc_id").cast("decimal(20,0)"), F.lit(Decimal(0)))
    in_order = F.col("n_chars").cast("decimal(10,0)") * F.lit(Decimal(2**65)) + id_place
    return (in_order * F.lit(Decimal(2**24)) + (F.lit(2**24 - 1) - F.col("task")).cast("decimal(10,0)")).cast("decimal(38,0)")


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, in the columns of docs; one of those that agree in doc_id and text."""
    kept = exact_groups(docs).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_hash"), F.col("n_chars").alias("kept_chars"))
    row = safe_name(docs, "row")
    rows = docs.select(F.struct("*").alias(row), F.col("doc_id").alias("id"), F.sha2(normalised(F.col("text")), 256).alias("hash"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")) & (F.col("chars") == F.col("kept_chars"))
    found = rows.join(kept, same, "left_semi").groupBy("id", "hash", "chars").agg(F.min_by(row, F.xxhash64(f"{row}.text")).alias(row))
    return found.select(f"{row}.*")
