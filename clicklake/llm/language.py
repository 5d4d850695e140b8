"""Language identification with a string kernel.

The kernel of two texts is the number of character n-grams (of one to three characters) that
both contain, over the geometric mean of their numbers of n-grams. A bounded sample of
labelled texts is mapped to the Nystroem features of a few landmark texts, and kernel
ridge regression separates each language from the rest. Documents are scored in
batches: a matrix of n-gram presence times that of the landmarks, times the weights. One of the
languages is always best, so what tells a text of none is the share of its n-grams
that the sample's texts of the best language have.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The model is fitted on at most so many labelled texts, evenly from all languages.
SAMPLE_ROWS = 1600
LANDMARKS = 96
ORDERS = (1, 2, 3)
BUCKETS = 1 << 14
RIDGE = 1e-3
#: A text is of its best language if the share of its n-grams that this language has is so much, at least, of the
#: share that a hundredth of the sample's texts stay below, each held against the others. Lowest of documents without
#: their words with digits: 0.87 on sf0.1; highest of texts in other scripts 0.26, of random letters 0.75 on check_s.
ALIKE = 0.8
LOW = 0.01
#: Texts of the sample that must have an n-gram, so that keys and foreign words in one of them do not count.
TEXTS = 2
UNKNOWN = "und"
BATCH = 128

_LETTER = re.compile(r"[^\W\d_]")
_CODE = re.compile(r"\S*\d\S*")
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def has_letter(text: str | None) -> bool:
    return bool(text) and bool(_LETTER.search(text))


def presence(texts, buckets: int = BUCKETS) -> np.ndarray:
    """Which n-grams (as hashed places) each text contains, as rows of 0 and 1."""
    found = np.zeros((len(texts), buckets), dtype=np.uint8)
    for row, text in zip(found, texts, strict=True):
        chars = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for order in ORDERS:
            count = len(chars) - order + 1
            if count > 0:
                code = np.full(count, order, dtype=np.uint32)
                for at in range(order):
                    code = (code ^ chars[at : at + count]) * _FACTORS[at]
                    code ^= code >> np.uint32(15)
                row[code & np.uint32(buckets - 1)] = 1
    return found


def _scaled(found: np.ndarray) -> np.ndarray:
    rows = found.astype(np.float32)
    return rows / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))


@dataclass
class Model:
    """Kernel values with the landmarks are texts @ landmarks, scores kernel values @ weights + bias."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    seen: np.ndarray  # by language, the n-grams of its texts
    least: np.ndarray  # by language, the share of a text's n-grams that must be among them

    def scores(self, texts) -> np.ndarray:
        return self._scores(presence(texts))

    def _scores(self, found: np.ndarray) -> np.ndarray:
        return _scaled(found) @ self.landmarks @ self.weights + self.bias

    def _alike(self, found: np.ndarray, best: np.ndarray) -> np.ndarray:
        return np.array([row[self.seen[at]].sum() >= self.least[at] * row.sum() for row, at in zip(found, best, strict=True)], dtype=bool)

    def predict(self, texts) -> tuple[list[str], np.ndarray]:
        """The best language of each text, and its regression value from -1..1 moved to 0..1; 0 if the text is unlike it."""
        found = presence(texts)
        raw = self._scores(found)
        best = raw.argmax(axis=1)
        value = np.clip((raw[np.arange(len(raw)), best] + 1) / 2, 0, 1)
        alike = self._alike(found, best)
        for at in np.flatnonzero(~alike):  # keys, addresses and numbers are of no language
            words = _CODE.sub(" ", texts[at] or "")
            alike[at] = has_letter(words) and self._alike(presence([words]), best[at : at + 1])[0]
        return [self.languages[at] for at in best], np.where(alike, value, 0).astype(np.float64)


def fit(found: np.ndarray, languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """From rows of n-gram presence and their languages; landmarks are taken in turn from all languages."""
    if not len(found):
        return None
    names = sorted(set(languages))
    labels = np.array([names.index(x) for x in languages])
    turn = np.empty(len(labels), dtype=np.int64)
    for at in range(len(names)):
        turn[labels == at] = np.arange((labels == at).sum())
    marks = _scaled(found[np.argsort(turn, kind="stable")[:landmarks]]).astype(np.float64)
    values, vectors = np.linalg.eigh(marks @ marks.T)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    # Only kernel values with the landmarks are kept of all rows; the rows themselves are scaled a few at a time.
    kernel = np.concatenate([_scaled(found[at : at + BATCH]).astype(np.float64) @ marks.T for at in range(0, len(found), BATCH)])
    features = kernel @ root
    wanted = np.where(labels[:, None] == np.arange(len(names)), 1.0, -1.0)
    mean, bias = features.mean(axis=0), wanted.mean(axis=0)
    centred = features - mean
    solved = np.linalg.solve(centred.T @ centred + ridge * len(found) * np.eye(centred.shape[1]), centred.T @ (wanted - bias))
    seen, least = np.zeros((len(names), found.shape[1]), dtype=bool), np.zeros(len(names))
    for at in range(len(names)):
        rows = np.unique(np.packbits(found[labels == at], axis=1), axis=0)  # a copy would know all of its like
        rows = np.unpackbits(rows, axis=1, count=found.shape[1])
        times = rows.sum(axis=0, dtype=np.int64)
        seen[at] = times >= TEXTS
        others = rows @ (times > TEXTS).astype(np.uint32)
        least[at] = ALIKE * np.quantile(others / np.maximum(rows.sum(axis=1, dtype=np.int64), 1), LOW)
    return Model(
        names, marks.T.astype(np.float32), (root @ solved).astype(np.float32), (bias - mean @ solved).astype(np.float32), seen, least
    )


def held_out():
    """True where crc32 of doc_id as text leaves 1 when divided by 3; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """The model of the labelled documents that are not held out; none if there are none.

    Of each language the rows with the smallest hashes of doc_id are taken, sample_rows
    in all at most; beyond so many languages only the most frequent are learned. Of rows that
    repeat a doc_id one counts, the least by language and text. Only their n-gram presence comes to the driver, 2 KB a row.
    """
    usable = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    rows_of = {row["lang"]: row["count"] for row in usable.groupBy("lang").count().collect()}
    if not rows_of:
        return None
    names = sorted(rows_of, key=lambda name: (-rows_of[name], name))[:sample_rows]
    each = sample_rows // len(names)
    # A hash below the bar is that of some 4 * each rows of a language, however many it has: few rows meet to be ordered.
    share = F.create_map(*[F.lit(x) for name in names for x in (name, min(1.0, 4 * each / rows_of[name]))])
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    low = usable.select("doc_id", "lang").where(draw < share[F.col("lang")])
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = [row["doc_id"] for row in low.distinct().withColumn("place", place).where(F.col("place") <= each).collect()]
    read = usable.where(F.col("doc_id").isin(ids)).groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("row"))
    chosen = read.select("doc_id", "row.lang", "row.text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                part = batch.iloc[at : at + BATCH]
                bits = np.packbits(presence(part["text"].tolist()), axis=1)
                rows = part[["doc_id", "lang"]].assign(bits=[row.tobytes() for row in bits])
                yield rows[[has_letter(text) for text in part["text"]]]

    sample = chosen.mapInPandas(run, "doc_id long, lang string, bits binary").orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()
    if sample.empty:
        return None
    found = np.stack([np.unpackbits(np.frombuffer(bits, dtype=np.uint8)) for bits in sample["bits"]])
    return fit(found, sample["lang"].tolist())


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Every row as row, with lang_pred and score (0 to 1), from the whole text alone.

    A text that is null or has no letter is `und` with score 0, and so is every text
    where no language was learned. A text unlike all learned languages has score 0. Nothing but the text is read, and the row passes as it came.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = []
            for at in range(0, len(texts), BATCH):
                part = texts.iloc[at : at + BATCH].tolist()
                known = [model is not None and has_letter(text) for text in part]
                names, values = (model.predict(part) if any(known) else ([UNKNOWN] * len(part), np.zeros(len(part))))
                parts.append(pd.DataFrame({
                    "lang_pred": [name if ok else UNKNOWN for name, ok in zip(names, known, strict=True)],
                    "score": np.where(known, values, 0.0),
                }))
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"lang_pred": [], "score": []})

    predicted = F.pandas_udf(run, "lang_pred string, score double")
    named = docs.select(F.struct("*").alias("row"), predicted(F.col("text")).alias("predicted"))
    return named.select("row", "predicted.lang_pred", "predicted.score")


def with_known_language(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, min_score: float = 0.0) -> DataFrame:
    """The documents whose language is recognised: not `und`, and with min_score at least."""
    kept = identify(docs, train(docs, sample_rows)).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.select("row.*")
