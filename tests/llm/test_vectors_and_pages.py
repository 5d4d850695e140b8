"""Vector search and near-dedup, archives and page texts against plain Python."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clicklake.llm import components, html_text, pivots, topk, warc
from clicklake.llm.common import table
from clicklake.session import shared_folder

FOLDER = "/root/testdata/sf0.001"
ODD = [
    (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, None, 1), (6, [0.0, 0.0], 1),
    (7, [float("nan"), 1.0], 1), (8, [None, 1.0], 1), (9, [1.0, 0.0], None), (10, [1.0, 0.39], 1), (11, [1.0, 0.0, 0.0], 1),
    (12, [], 1), (13, [3e38, 1e38], 1), (3, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (14, [float("inf"), 1.0], 1),
]
SCHEMA = "vec_id long, embedding array<float>, label int"


def test_components(spark):
    chance = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in chance.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    frame = spark.createDataFrame([*links, *links[:20], (None, 3)], "a long, b long")
    least = {v: v for pair in links for v in pair}
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    alone = {a for a, b in links if a == b} - {v for a, b in links if a != b for v in (a, b)}
    assert {r.member: r.component for r in components.connected(frame).collect()} == {v: c for v, c in least.items() if v not in alone}
    assert components.connected(frame.where("false")).count() == 0


# Near-dedup of vectors


def plain_links(vectors, labels, threshold):
    rows = pivots.unit(vectors)
    linked = (rows @ rows.T >= threshold) & (np.array(labels)[:, None] == np.array(labels))
    np.fill_diagonal(linked, False)
    return linked


@pytest.mark.parametrize("block", [512, 40])
def test_near_vectors_against_all_pairs(spark, block):
    chance = np.random.default_rng(4)
    centres = chance.normal(size=(12, 24))
    vectors = np.concatenate([c + chance.normal(size=(n, 24)) * w for c, n, w in zip(centres, chance.integers(2, 90, 12), np.linspace(0.02, 0.5, 12))])
    vectors = np.concatenate([vectors, np.repeat(vectors[:1], 60, axis=0), chance.normal(size=(150, 24))]).astype(np.float32)
    labels = [int(x) for x in chance.integers(0, 2, len(vectors))]
    linked = plain_links(vectors, labels, 0.93)
    frame = spark.createDataFrame([(i, v.tolist(), x) for i, (v, x) in enumerate(zip(vectors, labels))], SCHEMA)
    rows = pivots.near_vectors(frame, block=block).orderBy("vec_id").collect()
    assert [r.n_links for r in rows] == linked.sum(axis=1).tolist()
    root = pivots._roots(linked)
    assert [r.component_id for r in rows] == root.tolist()
    assert [r.kept for r in rows] == (root == np.arange(len(root))).tolist()


@pytest.mark.parametrize("rows", [1000, 2600, 10**9])
def test_recall_at_the_threshold_and_share_of_pairs_compared(rows):
    chance = np.random.default_rng(0)
    base = pivots.unit(chance.normal(size=(1300, 64)))
    side = chance.normal(size=base.shape)
    side = pivots.unit(side - (side * base).sum(axis=1, keepdims=True) * base)
    vectors = np.concatenate([base, 0.931 * base + np.sqrt(1 - 0.931**2) * side])
    for sample in (vectors[::2], chance.normal(size=(1300, 64))):
        fitted = pivots.choose_pivots(pivots.unit(sample), pivots.pivots_for(rows))
        found, compared = pivots.recall(vectors, pivots.THRESHOLD, fitted, pivots.NEAREST, pivots.SHARED)
        assert found >= 0.99
        assert compared < 0.05


def test_pivots_grow_with_the_root_of_the_rows():
    assert [pivots.pivots_for(n) for n in (0, 1000, 40_000, 250_000, 10**10)] == [128, 128, 200, 500, 512]


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_few_pairs_of_the_table_are_compared(folder):
    rows = [list(v) for (v,) in duckdb.sql(f"select embedding from '/root/testdata/{folder}/embeddings.parquet' where len(embedding) = 64").fetchall()]
    fitted = pivots.choose_pivots(pivots.unit(rows), pivots.pivots_for(len(rows)))
    found, compared = pivots.recall(np.array(rows), pivots.THRESHOLD, fitted, pivots.NEAREST, pivots.SHARED)
    assert not found < 1.0  # not a number where no pair is that near
    assert compared < 0.05


def test_shared_pivots_are_those_of_both_lists():
    chance = np.random.default_rng(3)
    listed = [chance.permutation(9)[:4].tolist() for _ in range(40)]
    assert pivots.shared_pivots(np.array(listed), 9).tolist() == [[len(set(a) & set(b)) for b in listed] for a in listed]


def test_near_vectors_of_odd_rows(spark):
    odd = spark.createDataFrame(ODD, SCHEMA).withColumns({"cid": F.lit("x"), "links": F.lit("y")})
    rows = pivots.near_vectors(odd).collect()
    assert len(rows) == len(ODD)
    found = {r.vec_id: (r.n_links, r.component_id) for r in rows}
    near = {1: (5, 1), 2: (5, 1), 3: (5, 1), 10: (5, 1), 13: (5, 1)}
    assert found == {**{i: (0, i) for i in (4, 5, 6, 7, 8, 9, 11, 12, 14, None)}, **near}
    assert pivots.near_vectors(odd.where("false")).count() == 0


# Top-k


def plain_top(queries, candidates, k):
    out = []
    for query_id, vector in queries:
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in candidates if i != query_id)
        out += [(query_id, rank, i, -score) for rank, (score, i) in enumerate(scored[:k], 1)]
    return out


@pytest.mark.parametrize("scale", [1, 10**8])
def test_top_k_against_all_scores(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 90)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 13)
    chance = np.random.default_rng(8)
    rows = [(i, (chance.integers(-9, 9, 11) * scale).tolist()) for i in range(260)]
    rows += [(300 + i, rows[7][1]) for i in range(120)]
    candidates = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    queries = candidates.where("vec_id % 10 = 0").withColumnRenamed("vec_id", "query_id")
    found = topk.exact_top_k(queries, candidates, 20).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == plain_top([r for r in rows if r[0] % 10 == 0], rows, 20)


@pytest.mark.parametrize(("folder", "share"), [("sf0.01", 0.25), ("sf0.1", 0.13)])
def test_the_cutoff_spares_most_sums(folder, share):
    read = f"select vec_id, list_transform(embedding, lambda x: floor(x::double * 64)::bigint) as vector from '/root/testdata/{folder}/embeddings.parquet'"
    rows = duckdb.sql(read).df()
    queries = rows[rows["vec_id"] % 20 == 0].rename(columns={"vec_id": "query_id"})
    heads = topk._listed(queries, rows, 20, topk.SLICES)
    cutoff = heads.groupby("query_id")["score"].min().reindex(queries["query_id"]).to_numpy()
    block = topk._Block(queries, rows, topk.SLICES)
    summed = [topk._sufficient(partial, cutoff[at][:, None]).mean() for at, partial, _ in block.tiles()]
    assert np.mean(summed) < share
    best = topk._resolved(queries.assign(cutoff=cutoff), rows, 20, topk.SLICES)
    assert len(best) == 20 * len(queries)


def test_top_k_of_few_and_of_none(spark):
    candidates = spark.createDataFrame([(1, [1, 2]), (2, [1]), (3, [])], "vec_id long, vector array<long>")
    queries = spark.createDataFrame([(1, [1, 2]), (9, [0, 0])], "query_id long, vector array<long>")
    assert {tuple(r) for r in topk.exact_top_k(queries, candidates, 5).collect()} == set(plain_top([(1, [1, 2]), (9, [0, 0])], [(1, [1, 2]), (2, [1, 0]), (3, [0, 0])], 5))
    assert topk.exact_top_k(queries.where("false"), candidates, 5).count() == 0
    assert topk.exact_top_k(queries, candidates.where("false"), 5).count() == 0
    frame = spark.createDataFrame([(r[0], r[1]) for r in ODD], "vec_id long, embedding array<float>")
    good = frame.where(topk.usable(F.col("embedding"))).collect()
    assert {r.vec_id for r in good} == {1, 2, 3, 4, 6, 9, 10, 11, 12, 13, None}


# Archives

PAGES = [
    (3, "http://a", "<p>x</p>"), (1, "http://b", "<p>x</p>"), (2, None, None), (4, "http://c\r\nX: y", ""), (5, "u", "é" * 200_000),
    (6, "u", "HTTP\r\n\r\nWARC/1.1\r\n"), (None, "n", "<p>x</p>"), (None, None, None), (1, "http://b", "<p>x</p>"), (7, "u", "HTTP\r\n\r\nWARC/1.1\r\n"),
]


def test_pages_come_back_from_archives(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1)).repartition(3)
    rows = warc.archived(pages).collect()
    digest = {i: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for i, (_, _, h) in enumerate(PAGES)}
    wanted = Counter()
    for at, (page_id, _, page) in enumerate(PAGES):
        same = [p for p, _, h in PAGES if (h or "") == (page or "") and p is not None]
        first = min(same)
        revisit = page_id is not None and page_id > first
        wanted[(page_id, len((page or "").encode()), digest[at], "revisit" if revisit else "response", first if revisit else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == wanted
    assert warc.archived(pages.where("false")).count() == 0


def test_archive_files(spark):
    pages = table(spark, FOLDER, "pages")
    folder = shared_folder(spark)
    manifest = warc.write_archives(pages, folder, rows_per_file=20)
    read = {r.page_id: r for r in warc.read_archives(manifest, folder).collect()}
    assert {i: bytes(r.payload) for i, r in read.items()} == {r.page_id: r.html.encode() for r in pages.collect()}
    assert max(r.records for r in manifest.collect()) <= 20
    name = manifest.first().file
    with open(f"{folder.removeprefix('file://')}/{name}", "rb") as file:
        data = file.read()
    assert data[:4] == bytes.fromhex("5d2a4d18")
    headers = [h for h, _ in warc.parse_records(data)]
    assert all(h["warc-type"] == "response" and h["warc-record-id"].startswith("<urn:uuid:") for h in headers)


# Pages


def plain_article(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body).replace("<br>", " "))
    found = (" ".join(html.unescape(block).split()) for block in blocks)
    return "\n".join(x for x in found if x)


def test_articles_of_all_pages(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    rows = html_text.extract_main_text(pages).select("row.html", "text").collect()
    assert len(rows) == 250 and all(r.text == plain_article(r.html) for r in rows)


CASES = {
    "<article><p>One.</p><div class='comments'><p>Nice!</p></div><form>Name</form><p>Two &lt;b&gt; &eacute;&nbsp;x</p></article>": "One.\nTwo <b> é x",
    "<article><header><h1>Head</h1></header><p>a<b>b</b>c<br>d</article><footer>f</footer>": "Head\nabc d",
    "<article>Unclosed <p>and cut off <a hre": "Unclosed\nand cut off",
    "<article><script>if (a<b) '</p>'</script>x<!-- <p>no</p> -->y</article>": "xy",
    "<body><header>Top</header><div>" + "<p>A long paragraph of the story itself.</p>" * 5 + "</div><div><a href=1>l</a> <a href=2>m</a></div></body>": "\n".join(["A long paragraph of the story itself."] * 5),
    "<article><p>1 < 2 and 3 > 2</p><p hidden>no</p><p data-hidden='x'>yes</p></article>": "1 < 2 and 3 > 2\nyes",
    "plain text": "plain text", "": "", "<nav>only a menu</nav>": "", "<": "<", "<<<>>>": "<<<>>>",
}


@pytest.mark.parametrize("page", CASES)
def test_odd_pages(page):
    assert html_text.main_text(page) == CASES[page]


STORY = "<article><h1>Head</h1><p>The story itself.</p></article>"
LONG = "<p>A long paragraph of the story itself.</p>" * 5
LONG_TEXT = "\n".join(["A long paragraph of the story itself."] * 5)
WRAPPED = {
    f"<div class='site has-sidebar'>{STORY}<div class='sidebar'>Side</div></div>": "Head\nThe story itself.",
    f"<div class='no-sidebar'><div id='with-menu'>{STORY}</div></div>": "Head\nThe story itself.",
    f"<form id='page'><nav>Menu</nav>{STORY}</form>": "Head\nThe story itself.",
    f"<nav><ul><li>Menu{STORY}": "Head\nThe story itself.",
    f"<div class='page no-sidebar'>{LONG}</div><div class='sidebar'>Side</div>": LONG_TEXT,
    f"<article><h1>T</h1><div class='entry has-sidebar'>{LONG}</div></article>": "T\n" + LONG_TEXT,
    f"<html><head><title>x</title><body>{STORY}": "Head\nThe story itself.",
    f"<html><head><noscript><style>p</style><body>{STORY}": "Head\nThe story itself.",
    f"<html><head><meta charset=u><title>x</title>{STORY}": "Head\nThe story itself.",
    "<article><p title='a hidden gem'>One</p><p>Two <a href=x title='class=ad hidden'>three</a></p></article>": "One\nTwo three",
    f"{STORY}<div id=comments><article>Me too</article></div>": "Head\nThe story itself.",
    f"<aside><article>Teaser</article></aside><div>{LONG}</div>": LONG_TEXT,
    f"<div>{LONG}</div><div class='post-comments'>{LONG * 2}</div>": LONG_TEXT,
    f"<div><p>A long paragraph of the story itself.</p></div><div class='ad'>{LONG}</div>": "A long paragraph of the story itself.",
}


@pytest.mark.parametrize("page", WRAPPED)
def test_no_article_is_lost_through_an_element_around_it(page):
    assert html_text.main_text(page) == WRAPPED[page]


BLOCK = "One block of the story. " * 200
MENU = "".join(f"<li><a href={i}>Item {i} of the menu</a></li>" for i in range(9))
UNMARKED = {
    f"<div>Title</div><div>{BLOCK}</div><div>Short.</div>": f"Title\n{BLOCK.strip()}\nShort.",
    f"<div><h1>Title</h1><div><p>{BLOCK}</p></div><table><tr><td>a<td>1</table><section><p>Short.</p></section><p>Last.</p></div>": f"Title\n{BLOCK.strip()}\na\n1\nShort.\nLast.",
    f"<h1>Title</h1><nav>{MENU}</nav><p>{BLOCK}</p><form>Name</form><aside>Side</aside><p>Last.</p>": f"Title\n{BLOCK.strip()}\nLast.",
    f"<div>Home of news</div><nav>{MENU}</nav><div>{BLOCK}</div><footer>f</footer><div>Imprint</div>": BLOCK.strip(),
    f"<ul>{MENU}</ul><p>First.</p><p>{BLOCK}</p><ul>{MENU}</ul>": f"First.\n{BLOCK.strip()}",
    f"<ul>{MENU}</ul>": "",
}


@pytest.mark.parametrize("page", UNMARKED)
def test_short_passages_of_an_unmarked_article_are_kept(page):
    assert html_text.main_text(page) == UNMARKED[page]


OTHERS = "<p>Someone else's words, at length.</p>" * 200
UNWANTED = [
    "<div class='comments'>{}</div>", "<section id='reader-comments'>{}</section>", "<div class='ad'>{}</div>", "<form>{}</form>",
    "<aside>{}</aside>", "<div class='box cookie-notice'>{}</div>", "<article class='comment'>{}</article>",
]


@pytest.mark.parametrize("element", UNWANTED)
@pytest.mark.parametrize("size", [1, 20, 200])
def test_what_is_no_article_goes_at_any_length(element, size):
    other = element.format("<p>Someone else's words, at length.</p>" * size)
    assert html_text.main_text(f"<article><h1>Head</h1><p>The story itself.</p>{other}</article>") == "Head\nThe story itself."
    assert html_text.main_text(f"{STORY}{other}") == html_text.main_text(f"{other}{STORY}") == "Head\nThe story itself."
    assert html_text.main_text(f"<div><h1>Head</h1>{LONG}</div>{other.replace('article', 'div')}") == "Head\n" + LONG_TEXT


SEVERAL = {
    f"<main>{STORY}<article><h2>Teaser</h2>{OTHERS}</article></main>": "Head\nThe story itself.",
    f"<article><h2>Teaser</h2>{OTHERS}</article>{STORY}": "Head\nThe story itself.",
    f"<main><h1>Head</h1><article>{LONG}</article></main>": "Head\n" + LONG_TEXT,
    f"<main><article>{LONG}</article><article><p>Teaser</p></article></main>": LONG_TEXT,
    f"<form class='search-form'><div>{LONG}</div></form><footer>f</footer>": LONG_TEXT,
    f"<div class='comments'><article>{LONG}</article></div>": "",
}


@pytest.mark.parametrize("page", SEVERAL)
def test_one_article_of_several(page):
    assert html_text.main_text(page) == SEVERAL[page]


@pytest.mark.parametrize("page", [
    "<b>" * 150_000 + "</i>" * 150_000, "<a '" * 250_000, "<a '>" * 200_000, "<div class=ad>" * 70_000, "<article>" * 100_000 + "x",
])
def test_a_megabyte_of_broken_markup_takes_no_time(page):
    start = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - start < 5


def test_windows_choose_the_article_of_pages_without_its_tag(spark, monkeypatch):
    pages = [r.html for r in table(spark, "/root/testdata/sf0.01", "pages").collect()]
    menus = [re.sub("<(/?)nav>", r"<\1div>", page) for page in pages]
    unmarked = [re.sub("</?article>", "", page) for page in menus]
    assert not any(any(html_text.stripped(page).in_article) for page in unmarked)
    assert [html_text.main_text(page) for page in unmarked] == [plain_article(page) for page in pages]
    monkeypatch.setattr(html_text, "passages", lambda lengths: [])
    assert not any(map(html_text.main_text, unmarked))
    assert [html_text.main_text(page) for page in pages] == [plain_article(page) for page in pages]


def test_pages_with_nulls_and_other_columns(spark):
    rows = [(1, None, None, "t"), (None, "u", "", "t"), (2, "u", "<article>" + "<p>" * 50_000 + "x" * 100_000, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.extract_main_text(pages).collect()
    assert [len(r.text) for r in found] == [0, 0, 100_000] and {r.row.text for r in found} == {"t"}
    assert html_text.extract_main_text(pages.where("false")).count() == 0
