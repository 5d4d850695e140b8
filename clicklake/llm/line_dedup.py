"""Near-duplicate lines by a deletion-neighbourhood join.

Two lines are within one edit exactly if they are equal, or equal after one deletion from
each at the same place (a substitution), or if one equals the other after one deletion. So a
line's neighbourhood is the line itself and its variants with one character deleted, each
under a hashed key; a variant's key holds the place too. All members of a key are
within one edit of each other, so the smallest member of a key is all that each needs,
and a key that very many lines share costs one row per line, not one per pair.

Variants are emitted only for lines that can have a partner: of two such lines, cut in the
middle, the first or the last halves are equal, so a line whose halves occur in no other line
has none. This loses nothing. A bitmap of fixed size first keeps most other lines back where they
are, and an exact join decides about the rest. The same is then asked of PIECES pieces: two lines within
one edit agree in all but one of them, and only its characters need to be deleted. Finally the edit distance of each line to its
earliest partner is verified on the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import written

MAX_EDITS = 1
#: Shorter lines count as repeated only if they are equal: one edit makes them another line.
MIN_CHARS = 20

#: Pieces of a line, of which one edit changes at most one.
PIECES = 16
#: Bits of the map of halves that occur in several lines. More halves only let more lines pass.
BITMAP = 1 << 26

#: Two primes below 2^31 and a base for each: products fit 64 bits.
PRIMES = (np.uint64(2147483647), np.uint64(2147483629))
BASES = (1000003, 998244353)

_powers: dict[int, list[np.ndarray]] = {}


def _power_tables(length: int) -> list[np.ndarray]:
    """For each prime: powers of the base, then powers of its inverse, up to `length`."""
    size = 1 << max(10, int(length).bit_length())
    if size not in _powers:
        tables = []
        for prime, base in zip(PRIMES, BASES, strict=True):
            for factor in (base % int(prime), pow(base, -1, int(prime))):
                out = np.ones(1, dtype=np.uint64)
                while len(out) < size:  # doubling: the second half is the first times factor^n
                    out = np.concatenate([out, out * np.uint64(pow(factor, len(out), int(prime))) % prime])
                tables.append(out)
        _powers.clear()
        _powers[size] = tables
    return _powers[size]


class _Hashes:
    """Hashes of the parts of a line: sums of character times power of its place, by prime."""

    def __init__(self, line: str) -> None:
        chars = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
        self.length = len(chars)
        self.tables = _power_tables(self.length + 1)
        self.sums = []
        for prime, power in zip(PRIMES, self.tables[::2], strict=True):
            terms = chars * power[: self.length] % prime
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)]) % prime)

    @staticmethod
    def _joined(parts: list[np.ndarray]) -> np.ndarray:
        return ((parts[0] << np.uint64(31)) | parts[1]).view(np.int64)

    def whole(self) -> np.ndarray:
        return self._joined([s[-1:] for s in self.sums])

    def without_one(self) -> np.ndarray:
        """The hash of the line without its character at place 0, 1, 2, ..."""
        parts = [
            (s[:-1] + (s[-1] + prime - s[1:]) % prime * back[1]) % prime
            for s, prime, back in zip(self.sums, PRIMES, self.tables[1::2], strict=True)
        ]
        return self._joined(parts)


def trimmed_lines(text: str | None) -> list[str]:
    """All lines of a text, without white space at their ends."""
    return [line.strip(" \t\n\r\v\f") for line in (text or "").split("\n")]


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _identity(line: str) -> tuple[int, int]:
    digest = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return _signed(digest >> 64), _signed(digest & (1 << 64) - 1)


def _halves(line: str) -> list[int]:
    """Keys of which two lines within one edit share one at least.

    Lines of n and n + 1 characters share a half of n // 2, so each line has the
    halves of its own length and those of the next shorter one.
    """
    lengths = {len(line) // 2, (len(line) - 1) // 2}
    parts = [("<%d " % n + line[:n], ">%d " % n + line[len(line) - n :]) for n in lengths]
    return [_signed(xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass"))) for pair in parts for p in pair]


def _line_table(texts: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, text_hash, place, h1, h2, halves of every line that is not blank.

    h1 and h2 stand for the trimmed line; lines of less than min_chars have no halves.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                rows = []
                for doc_id, text_hash, text in batch.iloc[start : start + 500].itertuples(index=False):
                    for place, line in enumerate(trimmed_lines(text)):
                        if line:
                            rows.append((doc_id, text_hash, place, *_identity(line), _halves(line) if len(line) >= min_chars else None))
                out = pd.DataFrame(rows, columns=["doc_id", "text_hash", "place", "h1", "h2", "halves"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    # As text a null doc_id does not turn its neighbours into floating point numbers.
    schema = "doc_id long, text_hash long, place int, h1 long, h2 long, halves array<long>"
    return texts.select(F.col("doc_id").cast("string"), "text_hash", "text").mapInPandas(run, schema)


def _bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """The keys (column half) as a map of `bits` bits, merged on the executors."""
    words = keys.selectExpr(f"cast(pmod(half, {bits}) div 64 as int) as word", "shiftleft(1L, cast(pmod(half, 64) as int)) as bit")
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas()  # bits / 64 rows at most
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[rows["word"].to_numpy(dtype=np.int64)] = rows["bit"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def _lines_in(texts: DataFrame, bitmap: np.ndarray, min_chars: int) -> DataFrame:
    """h1, h2, halves, line of the lines of which some half is in the map."""
    bits = np.int64(len(bitmap) * 64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                lines = [x for text in batch["text"].iloc[start : start + 500] for x in trimmed_lines(text) if len(x) >= min_chars]
                halves = [_halves(x) for x in lines]
                keys = np.array([k for found in halves for k in found], dtype=np.int64) % bits
                in_map = (bitmap[keys // 64] >> (keys % 64).astype(np.uint64)) & np.uint64(1) > 0
                owner = np.repeat(np.arange(len(lines)), [len(found) for found in halves])
                rows = [(*_identity(lines[at]), halves[at], lines[at]) for at in np.unique(owner[in_map])]
                yield pd.DataFrame(rows, columns=["h1", "h2", "halves", "line"])

    return texts.select("text").mapInPandas(run, "h1 long, h2 long, halves array<long>, line string")


def _pieces(line: str) -> list[tuple[int, int, int]]:
    """(key, from, to): a key of all but one piece, and where in the line that piece is.

    Pieces are cut at shares of the length of the shorter of two lines, which is
    this one's or one less.
    """
    found = []
    for shorter in (len(line), len(line) - 1):
        for at in range(PIECES):
            start, stop = at * shorter // PIECES, len(line) - (shorter - (at + 1) * shorter // PIECES)
            rest = f"{shorter} {at} {line[:start]}\n{line[stop:]}"
            found.append((_signed(xxhash.xxh3_64_intdigest(rest.encode("utf-8", "surrogatepass"))), start, stop))
    return found


def _suspected(lines: DataFrame) -> DataFrame:
    """h1, h2, ranges: where the lines of h1, h2, line can differ by one edit from another one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(h1, h2, *piece) for h1, h2, line in batch.itertuples(index=False) for piece in _pieces(line)]
            yield pd.DataFrame(rows, columns=["h1", "h2", "key", "start", "stop"])

    keyed = lines.select("h1", "h2", "line").mapInPandas(run, "h1 long, h2 long, key long, start int, stop int")
    shared = keyed.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low < high")
    ranges = F.collect_set(F.struct("start", "stop")).alias("ranges")  # 2 * PIECES at most
    return keyed.join(shared.select("key"), "key").groupBy("h1", "h2").agg(ranges)


def _variants(lines: DataFrame) -> DataFrame:
    """h1, h2, first, key, place: the line itself (place -1), and it without the character at each place.

    Only places in one of the line's ranges are needed.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for h1, h2, line, ranges in batch.itertuples(index=False):
                hashed = _Hashes(line)
                wanted = np.zeros(hashed.length, dtype=bool)
                for cut in ranges:
                    wanted[cut["start"] : cut["stop"]] = True
                places = np.flatnonzero(wanted)
                keys = np.concatenate([hashed.whole(), hashed.without_one()[places]])
                yield pd.DataFrame({"h1": h1, "h2": h2, "key": keys, "place": np.append(-1, places).astype(np.int32)})

    found = lines.select("h1", "h2", "line", "ranges").mapInPandas(run, "h1 long, h2 long, key long, place int")
    return found.join(lines.select("h1", "h2", "first"), ["h1", "h2"])


def within_one_edit(line: str, other: str) -> bool:
    """Whether one edit at most parts two lines, by where they first differ: no more than their length times its logarithm."""
    short, long = sorted((line, other), key=len)
    if len(long) - len(short) > MAX_EDITS:
        return False
    low, high = 0, len(short)  # the longest common start has low to high characters
    while low < high:
        middle = (low + high + 1) // 2
        if short[low:middle] == long[low:middle]:
            low = middle
        else:
            high = middle - 1
    return short[low + (len(short) == len(long)) :] == long[low + 1 :]


def _verified(lines: pd.Series, others: pd.Series) -> pd.Series:
    return pd.Series([within_one_edit(line, other) for line, other in zip(lines, others, strict=True)], dtype=bool)


def _without(texts: pd.Series, places: pd.Series) -> pd.Series:
    """The texts without the lines at the places; null where there are none."""
    left = []
    for text, gone in zip(texts, places, strict=True):
        gone = None if text is None or gone is None else set(gone.tolist())
        left.append(None if gone is None else "\n".join(line for at, line in enumerate(text.split("\n")) if at not in gone))
    return pd.Series(left, dtype=object)


def _near_lines(texts: DataFrame, places: DataFrame, firsts: DataFrame, min_chars: int) -> DataFrame:
    """h1, h2 of the lines within one edit of an earlier line that is not equal to them."""
    keyed = places.where("halves is not null").select(F.explode("halves").alias("half"), "h1")
    shared = written(keyed.groupBy("half").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low < high").select("half"))
    passed = _lines_in(texts, _bitmap(shared, BITMAP), min_chars).dropDuplicates(["h1", "h2"])
    passed = written(passed)
    named = passed.select("h1", "h2", F.explode("halves").alias("half")).join(shared, "half", "left_semi").select("h1", "h2").distinct()
    candidates = written(passed.join(named, ["h1", "h2"], "left_semi"))
    suspected = candidates.join(_suspected(candidates), ["h1", "h2"])
    lines = written(suspected.join(firsts, ["h1", "h2"]).select("h1", "h2", "first", "line", "ranges"))
    variants = written(_variants(lines))

    # In each case the smallest member of a key is the only partner that a line needs.
    shorter = variants.where("place >= 0")
    whole = variants.where("place = -1").select("key", F.struct("h1", "h2").alias("whole"), F.col("first").alias("whole_first"))
    substituted = shorter.groupBy("key", "place").agg(F.min("first").alias("partner"), F.count("*").alias("times")).where("times > 1")
    of_substituted = shorter.join(substituted, ["key", "place"]).select("h1", "h2", "first", "partner")
    of_longer = shorter.join(whole, "key").select("h1", "h2", "first", F.col("whole_first").alias("partner"))
    longer = shorter.groupBy("key").agg(F.min("first").alias("partner"))
    of_shorter = whole.join(longer, "key").select("whole.h1", "whole.h2", F.col("whole_first").alias("first"), "partner")
    found = of_substituted.union(of_longer).union(of_shorter).where("partner < first")
    partners = found.groupBy("h1", "h2").agg(F.min("partner").alias("partner"))
    others = lines.select(F.col("first").alias("partner"), F.col("line").alias("other"))
    compared = lines.select("h1", "h2", "line").join(partners, ["h1", "h2"]).join(others, "partner")
    return compared.where(F.pandas_udf(_verified, "boolean")("line", "other")).select("h1", "h2")


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_hash, places: which lines of each document repeat an earlier line.

    Only documents with such lines have a row; text_hash is xxhash64 of the text.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    places = written(_line_table(texts, min_chars))
    at = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "place")
    firsts = written(places.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.count("*").alias("times")))
    near = written(_near_lines(texts, places, firsts.select("h1", "h2", "first"), min_chars)).withColumn("near", F.lit(True))
    known = firsts.join(near, ["h1", "h2"], "left").where("times > 1 or near")
    gone = places.select("doc_id", "text_hash", "place", "h1", "h2", at.alias("at")).join(known, ["h1", "h2"]).where("near or at <> first")
    return gone.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("places"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every row with the lines that repeat no earlier one, as row, kept_text, n_lines, n_removed.

    row is the document as it came. Lines are compared without white space at their ends and stand
    in the order of doc_id (null last), text (by hash) and place. A line goes if any
    earlier line is equal to it, or is within one edit and both have min_chars characters
    at least. Blank lines stay. A null text stays null. Rows that repeat a whole
    document (doc_id and text) are one document and come back alike; n_lines counts
    lines that are not blank.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    gone = repeated_lines(docs, min_chars)
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    joined = rows.join(gone, same, "left")
    split = F.split(F.col("row.text"), "\n")
    left = F.pandas_udf(_without, "string")(F.when(F.col("places").isNotNull(), F.col("row.text")), "places")
    solid = F.size(F.filter(split, lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    removed = F.coalesce(F.size("places"), F.lit(0))
    return joined.select(
        "row", F.when(F.col("places").isNull(), F.col("row.text")).otherwise(left).alias("kept_text"),
        F.when(F.col("row.text").isNull(), 0).otherwise(solid).cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"),
    )


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with their repeated lines taken out, in the columns of docs.

    A document of which no line is left goes: all it says stands in earlier ones. Documents
    that came without any line, their text null or blank, stay as they are. n_chars, where
    docs has it, is that of the new text.
    """
    done = dedup_lines(docs, min_chars).where("n_removed = 0 or n_removed < n_lines")
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text")}
    fields = dict(docs.dtypes)
    return done.select(*[
        (F.when(F.col("n_removed") > 0, new[c].cast(fields[c])).otherwise(F.col("row")[c]) if c in new else F.col("row")[c]).alias(c)
        for c in docs.columns
    ])
