"""Best-fit packing of tokenised documents into sequences, by large-item matching.

Lengths are whole numbers up to the capacity, so the packing is planned on the number of
pieces of each length, a table of at most `capacity` rows, and pieces then find
their place by their rank among those of their length. Pieces above a third of the
capacity fit at most twice into a sequence: the longest is matched with the longest
that still fits beside it. The others go, longest first, to the smallest gap that holds them.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import written
from clicklake.llm.sharding import number_slots

CAPACITY = 1024
END_ID = 2
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Fixed value: the vocabulary's one special token, which is found in texts as well.
SPECIAL = {"<|endoftext|>": 50256}
#: Words whose ids by tokenizers a Python worker remembers.
REMEMBERED = 1 << 18

_SPACES = re.compile(r"\s\s|^ | $")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_encoders: dict[str, Callable[[str], bytes]] = {}


class _Remembered(dict):
    """The ids of " word" by word, as little-endian 32-bit numbers."""

    def __init__(self, encode: Callable[[str], list[int]]) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encode(" " + word), dtype="<u4").tobytes()
        if len(self) < REMEMBERED and len(word) < 100:
            self[word] = ids
        return ids


def encoder(vocabulary: str) -> Callable[[str], bytes]:
    """From text to the bytes of its ids, by a byte-level BPE vocabulary.

    .tiktoken files are read by tiktoken, .json files by tokenizers; either gives the same ids for
    the same vocabulary. tiktoken gets a text whole, as a call for each word would cost it more than
    the word. tokenizers is slow on long texts: no token spans a single space between two other
    characters, so the words between such spaces are encoded on their own, and frequent ones once.
    """
    if vocabulary not in _encoders:
        if vocabulary.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(vocabulary)

            def encode(text: str) -> list[int]:
                return tokenizer.encode(text, add_special_tokens=False).ids

            remembered = _Remembered(encode)

            def whole(text: str) -> bytes:
                words = _CUT.split(text) if _SPACES.search(text) else text.split(" ")
                first = np.array(encode(words[0]), dtype="<u4").tobytes()
                return first + b"".join(map(remembered.__getitem__, words[1:]))
        else:
            import tiktoken

            with open(vocabulary, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            made = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

            def whole(text: str) -> bytes:
                return made.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()

        _encoders[vocabulary] = whole
    return _encoders[vocabulary]


def token_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, with_ids, ids, of rows of doc_id and text.

    A document is its ids and the end id; a null text counts as empty. One longer than the
    capacity is cut into pieces of the capacity, of which the first may be shorter.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            for at in range(0, len(batch), 500):
                rows = []
                for doc_id, text in batch.iloc[at : at + 500].itertuples(index=False):
                    ids = encode(text or "") + end
                    total = len(ids) // 4
                    head = (total - 1) % capacity + 1
                    for piece, stop in enumerate(range(head, total + 1, capacity)):
                        start = max(0, stop - capacity) if piece else 0
                        part = ids[4 * start : 4 * stop]
                        rows.append((doc_id, piece, start, stop - start, zlib.crc32(part), *([np.frombuffer(part, "<u4")] if with_ids else [])))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])

    schema = "doc_id string, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    pieces = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(run, schema)
    return pieces.withColumn("doc_id", F.col("doc_id").cast("long"))


class _Plan:
    """Places for counted lengths: (length, rank_from, rank_to, sequence_from, offset) each."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.sequences = capacity, 0
        self.segments: list[tuple[int, int, int, int, int]] = []
        self.used: dict[int, int] = {}
        #: gap -> runs of sequences with that gap left: (first, count)
        self.gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def put(self, length: int, count: int, sequence: int, offset: int) -> None:
        rank = self.used.get(length, 0)
        self.used[length] = rank + count
        self.segments.append((length, rank, rank + count, sequence, offset))

    def open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def leave(self, first: int, count: int, gap: int) -> None:
        if count and gap:
            self.gaps[gap].append((first, count))

    def match_large(self, left: dict[int, int]) -> None:
        for length in sorted(left, reverse=True):
            partner = min(length, self.capacity - length)
            while left[length]:
                while partner and not (left.get(partner, 0) > (partner == length)):
                    partner -= 1
                pairs = 0
                if partner:
                    pairs = left[length] // 2 if partner == length else min(left[length], left[partner])
                count = pairs or left[length]
                first = self.open(count)
                self.put(length, count, first, 0)
                if pairs:
                    self.put(partner, count, first, length)
                    left[partner] -= count
                left[length] -= count
                self.leave(first, count, self.capacity - length - (partner if pairs else 0))

    def fit_small(self, length: int, count: int) -> None:
        gap = length
        while count and gap <= self.capacity:
            if not self.gaps[gap]:
                gap += 1
                continue
            first, here = self.gaps[gap].pop()
            taken = min(here, count)
            if here > taken:
                self.gaps[gap].append((first + taken, here - taken))
            self.put(length, taken, first, self.capacity - gap)
            self.leave(first, taken, gap - length)
            count -= taken
            gap = max(length, min(gap, gap - length))  # what is left may hold another one
        each = self.capacity // length
        for full, items in ((count // each, each), (1 if count % each else 0, count % each)):
            first = self.open(full)
            for at in range(items if full else 0):
                self.put(length, full, first, at * length)
            self.leave(first, full, self.capacity - items * length)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Segments (length, rank_from, rank_to, sequence_from, offset) that place all pieces."""
    made = _Plan(capacity)
    made.match_large({length: n for length, n in counts.items() if 3 * length > capacity})
    for length in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        made.fit_small(length, counts[length])
    return made.segments


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Lengths are from 1 to the capacity. A sequence is filled from 0 without gaps. Pieces that
    agree in all columns are interchangeable. Without pieces there are no sequences.
    """
    order = ["doc_id", "piece", "start", "ids_crc32"]
    counted = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}  # capacity rows at most
    segments = plan(counted, capacity)
    schema = "length long, rank_from long, rank_to long, sequence_from long, offset long"
    places = pieces.sparkSession.createDataFrame(segments, schema)
    ranked = number_slots(pieces, "length", order, max(counted.values(), default=1))
    inside = (F.col("slot") >= F.col("rank_from")) & (F.col("slot") < F.col("rank_to"))
    placed = ranked.join(F.broadcast(places).withColumnRenamed("length", "of_length"), (F.col("length") == F.col("of_length")) & inside)
    sequence = F.col("sequence_from") + F.col("slot") - F.col("rank_from")
    return placed.withColumn("sequence_id", sequence).drop("slot", "rank_from", "rank_to", "sequence_from", "of_length")


def packed_documents(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of all documents' pieces.

    Ids are tokenised once; what is written, counted and ranked are lengths and
    checksums. `sequences` brings the ids back. Null doc_ids and repeated rows are documents too.
    """
    return pack(written(token_pieces(docs, vocabulary, capacity, with_ids=False)), capacity)


def sequences(docs: DataFrame, placed: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id and the ids of each packed sequence. A sequence has `capacity` ids at most."""
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = token_pieces(docs, vocabulary, capacity).dropDuplicates(key).withColumnRenamed("doc_id", "id")
    same = F.col("id").eqNullSafe(F.col("doc_id"))
    joined = placed.join(found, [*key[1:]]).where(same)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
