"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import numpy as np
import pytest
from test_documents import check_packed, plain_components, plain_dedup, plain_targets, WORDS

import __spark_entry__ as contract
import corpus_pipeline
from clicklake.llm import language, mixing, packing
from clicklake.llm.common import hash_draw, table
from clicklake.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_agrees_with_sql(spark, key):
    import duckdb

    from checks.compare import difference

    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    assert difference(con, QUERIES[key](spark, FOLDER), ORACLES[key]) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_query_covers_its_table(spark, key):
    pages = key in ("op3_warc", "op9_html_text")
    rows = QUERIES[key](spark, FOLDER).count()
    source = table(spark, FOLDER, "pages" if pages else "embeddings" if key in ("op6_embedding_near_dedup", "op10_top_k") else "documents")
    assert rows >= source.count() or key == "op10_top_k" and rows == 25 * 20


def test_pipeline_against_plain_python(spark):
    docs = table(spark, FOLDER, "documents")
    model = language.train(docs)
    rows = sorted(map(tuple, docs.select("doc_id", "text", "source").collect()))
    scored = dict(zip([r[0] for r in rows], zip(*model.predict([r[1] for r in rows]))))
    rows = [r for r in rows if language.has_letter(r[1]) and scored[r[0]][1] >= corpus_pipeline.MIN_SCORE]
    texts = plain_dedup([r[1] for r in rows])
    had = [any(line.strip() for line in r[1].split("\n")) for r in rows]
    rows = [(r[0], text, r[2]) for r, text, some in zip(rows, texts, had) if text.strip() or not some]
    _, component = plain_components([r[:2] for r in rows], 80)
    rows = [r for r in rows if component[r[0]] == r[0]]
    sizes: dict = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORDS.findall(text))
    target = plain_targets(sizes)
    draws = {r.doc_id: r.draw for r in docs.select("doc_id", hash_draw(F.lit("mix"), F.col("doc_id").cast("string")).alias("draw")).collect()}
    encode, wanted = packing.encoder(packing.VOCABULARY), []
    for doc_id, text, source in rows:
        rate = min(float(target[source]) / sizes[source], mixing.MOST_COPIES)
        copies = int(rate) + (draws[doc_id] < rate - int(rate))
        wanted += [(doc_id, len(np.frombuffer(encode(text), "<u4")) + 1)] * copies
    found = corpus_pipeline.run(spark, FOLDER).collect()
    check_packed(found, packing.CAPACITY)
    by_doc: dict = {}
    for r in found:
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + r.length
    plain: dict = {}
    for doc_id, length in wanted:
        plain[doc_id] = plain.get(doc_id, 0) + length
    assert by_doc == plain


def test_stages_keep_the_columns_of_documents(spark):
    docs = table(spark, FOLDER, "documents").limit(40)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).dtypes == docs.dtypes, name
        assert stage(spark, docs.where("false"), FOLDER).count() == 0, name
