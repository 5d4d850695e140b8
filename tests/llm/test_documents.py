"""Sharding, language, mixing, line dedup, packing and near duplicates against plain Python."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clicklake.llm import language, line_dedup, minhash, mixing, packing, sharding
from clicklake.llm.common import table

FOLDER = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, FOLDER, "documents")


def smallest_reachable(vertices, links):
    root = {v: v for v in vertices}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {v: find(v) for v in vertices}


# Sharding


def check_shards(frame, shards):
    rows = sharding.assign_shards(frame, shards, shards + 1).select("doc_id", "text", "size", "text_crc32", "shard", "slot", "grown_shard").collect()
    slots = defaultdict(list)
    for r in rows:
        raw = (r.text or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        assert 0 <= r.shard < shards and r.grown_shard in (r.shard, shards)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows


def test_shards_have_gapless_slots_and_grow_by_one_alone(docs, odd, none):
    rows = check_shards(docs, 16)
    assert any(r.grown_shard == 16 for r in rows)
    rows = check_shards(odd, 16)
    assert len(rows) == odd.count()
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert check_shards(none, 16) == []


def test_slots_over_many_groups(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_GROUP", 7)
    check_shards(spark.range(500).selectExpr("id as doc_id", "'x' as text"), 18)


def test_keys_move_only_into_a_subtree_that_gains_weight(spark):
    before = sharding.Tree({"r0": {"r0.a": {0: 1.0, 1: 1.0}, "r0.b": {2: 2.0}}, "r1": {"r1.a": {3: 4.0, 4: 0.0}}})
    after = sharding.Tree({"r0": {"r0.a": {0: 1.0, 1: 1.0}, "r0.b": {2: 2.0}}, "r1": {"r1.a": {3: 4.0, 4: 2.0}}})
    key = F.col("id").cast("string")
    rows = spark.range(4000).select(sharding.shard_of(key, before).alias("a"), sharding.shard_of(key, after).alias("b")).collect()
    share = Counter(r.a for r in rows)
    assert share[4] == 0 and abs(share[3] / 4000 - 0.5) < 0.04 and abs(share[2] / 4000 - 0.25) < 0.04
    assert all(r.a == r.b or r.b in (3, 4) for r in rows)


def plain_shard(key, of):
    """The leaf a key reaches by drawing -ln(u) / weight at every node, u from 48 bits of an MD5."""
    weights = {name: {rack: sum(shards.values()) for rack, shards in racks.items()} for name, racks in of.regions.items()}

    def least(children):
        def draw(name):
            u = (int(hashlib.md5(f"{key}/{name}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
            return -math.log(u) / children[name], str(name)

        return min((name for name, weight in children.items() if weight > 0), key=draw)

    region = least({name: sum(racks.values()) for name, racks in weights.items()})
    rack = least(weights[region])
    return least(of.regions[region][rack])


def test_shards_are_those_of_plain_draws(docs, odd):
    uneven = sharding.Tree({"r0": {"r0.a": {0: 1.0, 1: 2.5}, "r0.b": {2: 0.0, 5: 2.0}}, "r1": {"r1.a": {3: 4.0, 4: 0.0}}, "r2": {"r2.a": {6: 0.0}}})
    trees = [sharding.tree(16), sharding.tree(17), uneven]
    for frame in (docs, odd):
        key = sharding.key_text(F.col("doc_id"))
        rows = frame.select(key.alias("key"), *[sharding.shard_of(key, of).alias(f"s{n}") for n, of in enumerate(trees)]).collect()
        assert [tuple(r)[1:] for r in rows] == [tuple(plain_shard(r.key, of) for of in trees) for r in rows]
    placed = sharding.assign_shards(docs, 16, grown=17).collect()
    assert all((r.shard, r.grown_shard) == (plain_shard(r.doc_id, trees[0]), plain_shard(r.doc_id, trees[1])) for r in placed)


# Language


def test_language_is_found_in_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = language.identify(docs, language.train(docs)).select("row.doc_id", "row.lang", "lang_pred", "score").withColumn("held", language.held_out())
    rows = found.collect()
    held = [r for r in rows if r.held]
    assert [r.held for r in rows] == [zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows]
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_documents(odd, none):
    model = language.train(odd)
    assert model.languages == ["de", "en"]
    rows = language.identify(odd, model).select("row.*", F.col("lang_pred").alias("pred"), F.col("score").alias("value")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r.pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert r.lang_pred == "own lang_pred"
    kept = language.with_known_language(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.pred != "und" for r in rows)
    assert language.train(none) is None
    assert {r.lang_pred for r in language.identify(odd, None).collect()} == {"und"}
    assert language.with_known_language(none).count() == 0


UNLEARNED = [
    "Это русский текст о погоде и природе, который никто не изучал. Люди живут в большом городе и читают книги.",
    "今天天气很好我们去公园散步看花学习新的东西中文没有空格所以一切都连在一起", "Ζούμε σε μια μεγάλη πόλη και διαβάζουμε βιβλία κάθε βράδυ",
    "asdfgh qwerty zxcvbn kjhgfd poiuyt mnbvcx lkjhgf qazwsx edcrfv tgbyhn", "привет", "x9k2 q7zz 8kq1j kk3x",
]


def test_texts_of_unlearned_languages_go_and_all_others_stay(spark):
    import corpus_pipeline

    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = language.train(docs)
    assert max(model.predict(UNLEARNED)[1]) < corpus_pipeline.MIN_SCORE
    held_out = [i for i in range(20_000_000, 20_000_100) if zlib.crc32(str(i).encode()) % 3 == 1]
    strange = spark.createDataFrame(list(zip(held_out, UNLEARNED)), "doc_id long, text string")
    rows = docs.unionByName(strange, allowMissingColumns=True)
    kept = corpus_pipeline.known_language(spark, rows, "").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_presence_is_that_of_blended_ngrams():
    text = "aBc ab"
    grams = {text.lower()[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}
    assert language.presence([text, "", None], 1 << 20).sum(axis=1).tolist() == [len(grams), 0, 0]


# Mixing


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] * (None in sizes)
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(names)}
    left, words, target = set(names), Fraction(sum(sizes.values())), {}
    while left:
        unit = words / sum(weight[s] for s in left)
        full = {s for s in left if unit * weight[s] >= most * sizes[s]}
        if not full:
            target |= {s: unit * weight[s] for s in left}
            break
        for s in full:
            target[s] = Fraction(most * sizes[s])
            words -= target[s]
        left -= full
    return target


@pytest.mark.parametrize("salted", [False, True])
def test_mixing_meets_the_targets(docs, odd, none, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    for frame in (docs, odd):
        rows = mixing.mix(frame).select("doc_id", "text", "source", "size", "source_size", "target", "rate", "copies").collect()
        assert len(rows) == frame.count()
        sizes = Counter()
        for r in rows:
            assert r["size"] == len(WORDS.findall(r.text or ""))
            sizes[r.source] += r["size"]
        target = plain_targets(sizes)
        for r in rows:
            assert r.source_size == sizes[r.source]
            assert r.target == pytest.approx(float(target[r.source]))
            assert r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) and 0 <= r.copies <= 3
        again = mixing.mixed(frame)
        assert again.columns == frame.columns
        assert Counter(r.doc_id for r in again.collect()) == +Counter({k: sum(r.copies for r in rows if r.doc_id == k) for k in {r.doc_id for r in rows}})
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0


def test_rates_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1), ("d", 0), (None, 500)], "source string, size long")
    rows = {r.source: r for r in mixing.source_rates(sizes).collect()}
    target = plain_targets({s: r.source_size for s, r in rows.items()})
    assert {s: r.target for s, r in rows.items()} == pytest.approx({s: float(t) for s, t in target.items()})
    assert rows["d"].rate == 0


# Line dedup


def within_one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a == b or a[at + 1 :] == b[at + 1 :] or a[at:] == b[at + 1 :] or a[at + 1 :] == b[at:]


def plain_dedup(rows, least=line_dedup.MIN_CHARS):
    seen, out = [], []
    for text in rows:
        kept = []
        for line in text.split("\n"):
            bare = line.strip(" \t\r\v\f")
            if not bare or not any(bare == x or min(len(bare), len(x)) >= least and within_one_edit(bare, x) for x in seen):
                kept.append(line)
            seen += [bare] * bool(bare)
        out.append("\n".join(kept))
    return out


def test_lines_against_all_earlier_lines(spark):
    chance = random.Random(5)
    bases = ["".join(chance.choice("abcdé ") for _ in range(chance.randint(17, 45))) for _ in range(10)]

    def near(line):
        at = chance.randrange(len(line))
        return chance.choice([line[:at] + line[at + 1 :], line[:at] + "Z" + line[at:], line[:at] + "Q" + line[at + 1 :], line])

    texts = ["\n".join(chance.choice([near(near(chance.choice(bases))), " ", "short"]) for _ in range(chance.randint(0, 6))) for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = line_dedup.dedup_lines(frame).select("row.doc_id", "kept_text").orderBy("doc_id").collect()
    assert [r.kept_text for r in rows] == plain_dedup(texts)


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.text("ab", max_size=8), st.text("ab", max_size=8))
def test_one_edit_is_verified_as_by_its_definition(line, other):
    def near(a, b):
        shorter = {b[:at] + b[at + 1 :] for at in range(len(b))}
        return a == b or a in shorter or len(a) == len(b) and any(a[:at] + a[at + 1 :] == b[:at] + b[at + 1 :] for at in range(len(a)))

    assert line_dedup.within_one_edit(line, other) == (near(line, other) or near(other, line))


def test_very_long_lines(spark):
    start = time.perf_counter()
    line = "".join(chr(97 + at * at % 23) for at in range(1_000_000))
    assert line_dedup.within_one_edit(line * 10, line * 10 + "x") and not line_dedup.within_one_edit(line * 10, line * 10 + "xy")
    assert time.perf_counter() - start < 5
    rows = [(1, line), (2, line[:-1] + "?"), (3, line[:500] + line[502:]), (4, "short\n" * 50_000 + "end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.row.doc_id: r.kept_text for r in line_dedup.dedup_lines(docs).collect()}
    assert kept == {1: line, 2: "", 3: rows[2][1], 4: "short\nend"}


def test_lines_of_odd_documents(odd, none):
    done = line_dedup.dedup_lines(odd).select("row.doc_id", "row.text", "kept_text", "n_lines", "n_removed").collect()
    by_id = defaultdict(list)
    for r in done:
        by_id[r.doc_id].append(r)
    assert len(done) == odd.count() and by_id[1][0].n_removed == 0
    assert by_id[2][0].kept_text == "" and by_id[11][0].kept_text == "one\ntwo"
    assert by_id[4][0].kept_text is None and by_id[8][0].kept_text == by_id[8][0].text
    kept = line_dedup.without_repeated_lines(odd)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 3, 4, 5, 6, 7, 8, None, 9, 10, 11, 12])
    assert line_dedup.without_repeated_lines(none).count() == 0


@given(st.text(alphabet="ab\U0001f600", min_size=2, max_size=30))
def test_variant_hashes_are_those_of_the_shortened_lines(line):
    hashed = line_dedup._Hashes(line)
    expected = [line_dedup._Hashes(line[:i] + line[i + 1 :]).whole()[0] for i in range(len(line))]
    assert hashed.without_one().tolist() == expected


@given(st.text(alphabet="abc", min_size=20, max_size=60), st.integers(0, 59), st.sampled_from("xab"), st.integers(0, 2))
def test_lines_within_one_edit_share_a_half_and_a_piece(line, at, char, kind):
    at %= len(line)
    other = [line[:at] + char + line[at + 1 :], line[:at] + char + line[at:], line[:at] + line[at + 1 :]][kind]
    assert set(line_dedup._halves(line)) & set(line_dedup._halves(other))
    keys = [{key: (a, b) for key, a, b in line_dedup._pieces(x)} for x in (line, other)]
    assert keys[0].keys() & keys[1].keys()


# Packing


@cache
def _reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_tokenizer(docs):
    reference = _reference()
    texts = [r.text for r in docs.collect()] + ["", " ", "  a  b ", "a \n b\n\n c", "it's we'll  x", "<|endoftext|> a", " x  y", "\x1cq \x1c r", "日本 語 😀 é"]
    encode = packing.encoder(packing.VOCABULARY)
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids


@given(st.text(alphabet=" \n\t ab1'!sé", max_size=40))
@settings(max_examples=200, deadline=None)
def test_words_are_encoded_as_in_their_text(text):
    remembered, whole = packing.encoder(packing.VOCABULARY), packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    expected = _reference().encode(text, add_special_tokens=False).ids
    assert np.frombuffer(remembered(text), "<u4").tolist() == expected == np.frombuffer(whole(text), "<u4").tolist()


def test_ids_cost_little_more_than_the_tokenizers_own_work():
    draw = random.Random(5)
    text = " ".join("".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(60_000))
    with open(packing.VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encode = packing.encoder(packing.VOCABULARY)

    def seconds(run):
        began = time.process_time()
        run()
        return time.process_time() - began

    words = text.split(" ")
    texts = [" ".join(words[at : at + 20_000]) for at in range(0, 60_000, 20_000)]  # other words each time
    assert min(seconds(lambda: encode(x)) for x in texts) < 3 * min(seconds(lambda: plain.encode_ordinary(x)) for x in texts)


def check_packed(rows, capacity):
    ends = defaultdict(list)
    for r in rows:
        assert 1 <= r.length <= capacity
        ends[r.sequence_id].append((r.offset, r.offset + r.length))
    for spans in ends.values():
        at = 0
        for start, stop in sorted(spans):
            assert start == at
            at = stop
        assert at <= capacity
    return ends


def test_packed_documents_and_their_sequences(docs, odd, none):
    encode = packing.encoder(packing.VOCABULARY)
    for frame in (docs, odd):
        placed = packing.packed_documents(frame).cache()
        rows = placed.collect()
        ends = check_packed(rows, packing.CAPACITY)
        total = sum(r.length for r in rows)
        assert len(ends) <= total / packing.CAPACITY * 1.02 + 1
        wanted = Counter()
        for r in frame.select("doc_id", "text").collect():
            ids = np.append(np.frombuffer(encode(r.text or ""), "<u4"), packing.END_ID).astype("<u4")
            cuts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)]
            for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                wanted[(r.doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
        filled = packing.sequences(frame, placed).collect()
        assert sum(len(r.ids) for r in filled) == total and max(len(r.ids) for r in filled) <= 1024
    assert packing.packed_documents(none).count() == 0


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
@settings(deadline=None)
def test_plan_places_every_piece_once(counts):
    segments = packing.plan(counts, 60)
    used, filled = Counter(), defaultdict(list)
    for length, low, high, first, offset in segments:
        used[length] += high - low
        for at in range(high - low):
            filled[first + at].append((offset, length))
    assert used == Counter(counts)
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 60 and sum(3 * length > 60 for _, length in spans) <= 2
    # No packing has fewer: by the sum, two pieces above a third at most, one above a half, three above a quarter.
    above = lambda parts: sum(n for a, n in counts.items() if parts * a > 60)
    least = max(math.ceil(sum(a * b for a, b in counts.items()) / 60), math.ceil(above(3) / 2), above(2), math.ceil(above(4) / 3))
    assert least <= len(filled) <= 1.4 * least + 1


def fewest(lengths, capacity):
    """The least number of sequences, by trying all places."""
    best = len(lengths)

    def place(at, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if at == len(lengths):
            best = len(gaps)
            return
        for gap in {g for g in gaps if g >= lengths[at]}:
            left = list(gaps)
            left.remove(gap)
            place(at + 1, [*left, gap - lengths[at]])
        place(at + 1, [*gaps, capacity - lengths[at]])

    place(0, [])
    return best


@given(st.lists(st.integers(1, 60), min_size=1, max_size=9))
@settings(deadline=None)
def test_plan_of_few_pieces_is_near_the_best(lengths):
    sequences = max(first + high - low for _, low, high, first, _ in packing.plan(Counter(lengths), 60))
    assert sequences <= fewest(sorted(lengths, reverse=True), 60) + 1


# Near duplicates


def test_a_text_keeps_its_links_beside_another_of_its_document(spark):
    words = [f"w{i}" for i in range(400)]
    near = words[:199] + ["other"]
    rows = [(5, " ".join(words[:200])), (6, " ".join(near)), (5, " ".join(words[200:])), (7, " ".join(words[250:]))]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(5, 5), (6, 5), (7, 7)}


def plain_components(rows, percent):
    sets = {}
    for doc_id, text in rows:
        words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        grams = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        sets[doc_id] = grams
    ids = [i for i in sets if i is not None]
    shared = Counter()
    holders = defaultdict(list)
    for i in ids:
        for gram in sets[i]:
            shared.update((j, i) for j in holders[gram])
            holders[gram].append(i)
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    return {i: len(s) for i, s in sets.items()}, smallest_reachable(ids, links)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_against_all_pairs(spark, percent):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    counts, component = plain_components([(r.doc_id, r.text) for r in docs.collect()], percent)
    rows = minhash.near_duplicates(docs, percent).collect()
    assert {r.doc_id: r.component_id for r in rows} == component
    assert {r.doc_id: r.n_shingles for r in rows} == counts
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_a_group_of_copies_with_few_edits(spark):
    chance = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for doc_id in range(150):
        words = list(base)
        for _ in range(chance.randint(0, 5)):
            words[chance.randrange(len(words))] = f"x{chance.randrange(400)}"
        rows.append((doc_id, " ".join(words)))
    counts, component = plain_components(rows, 85)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    assert {r.doc_id: r.component_id for r in found} == component
    assert 1 < len(set(component.values())) < 150


def test_near_duplicates_of_odd_documents(odd, none):
    rows = minhash.near_duplicates(odd, 85).collect()
    assert len(rows) == odd.count()
    component = {r.doc_id: r.component_id for r in rows}
    assert component == {**{i: i for i in range(1, 13)}, 2: 1, 3: 1, 12: 1, None: None}
    assert {r.doc_id: r.n_shingles for r in rows if r.doc_id in (4, 5, 6, 7)} == {4: 0, 5: 0, 6: 0, 7: 1}
    kept = minhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 4, 5, 6, 7, 8, 9, 10, 11, None, None])
    assert minhash.near_duplicates(none, 85).count() == 0 and minhash.without_near_duplicates(none).count() == 0


def test_signatures_estimate_similarity():
    chance = np.random.default_rng(2)
    every = chance.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = minhash.signature(every[:2000], 4096), minhash.signature(every[1000:], 4096)
    assert abs((a == b).mean() - 1 / 3) < 0.04
