"""Small documents with every odd case: nulls, empty and very long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import pytest
from hypothesis import settings
from pyspark.sql import functions as F

settings.register_profile("fixed", derandomize=True)
settings.load_profile("fixed")

LONG = " ".join(f"word{i % 977} und{i % 31}" for i in range(30_000))
BASE = "the quick brown fox jumps over the lazy dog while nine small birds sing in the old green tree near my house today"
ROWS = [
    (1, BASE, "en", "a"), (2, BASE, "en", "b"), (3, BASE + " again", "en", "a"), (3, BASE + " again", "en", "a"),
    (4, None, "en", "a"), (5, "", None, None), (6, " \n\t ", "en", "b"), (7, "1 2 3 ?!", "en", "c"),
    (8, LONG, None, "c"), (None, BASE, "en", None), (None, None, None, None), (9, "Über größe schöne straße im wald\nzweite zeile hier", "de", "c"),
    (10, "Zwei  Räume   und mehr <|endoftext|> x", "de", "d"), (11, "one\ntwo\none", "en", "a"), (12, BASE.upper(), "en", "d"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd documents, with extra columns named like columns that operators add or use inside."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    extra = ["size", "copies", "target", "rate", "row", "cid", "component_id", "kept", "places", "slot", "score", "lang_pred", "key", "id"]
    return docs.withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit(f"own {c}") for c in extra}).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
