"""Chunk recipes, bisector clustering and conversation repair against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clicklake.llm import bisectors, chunk_dedup, repair
from clicklake.llm.common import table

FOLDER = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"


# Chunk recipes


def bare(text):
    return "".join(c for c in text or "" if c not in BLANKS)


def check_groups(rows, found):
    """rows: (doc_id, text) of the input; found: rows of exact_groups."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[hashlib.sha256(bare(text).encode()).hexdigest()].append((doc_id, len(text or "")))
    got = defaultdict(list)
    for r in found:
        got[r.text_sha256].append(r)
    assert set(groups) == set(got)
    for name, members in groups.items():
        longest, _, keep = min((-n, d is None, d) for d, n in members if n == max(m for _, m in members))
        assert sorted((str(r.doc_id), r.n_chars) for r in got[name]) == sorted((str(d), n) for d, n in members)
        assert {(r.keep_id, r.group_size) for r in got[name]} == {(keep, len(members))}
        assert [(r.doc_id, r.n_chars) for r in got[name] if r.kept] == [(keep, -longest)]


def test_equal_texts_are_grouped_and_the_longest_stays(spark, odd, none):
    docs = table(spark, FOLDER, "documents")
    check_groups(docs.select("doc_id", "text").collect(), chunk_dedup.exact_groups(docs).collect())
    check_groups(odd.select("doc_id", "text").collect(), chunk_dedup.exact_groups(odd).collect())
    assert chunk_dedup.exact_groups(none).collect() == []


def test_chunks_of_any_text_are_the_text_and_bounded(spark):
    texts = ["", "a", "." * 9000, "x" * 100_000, "日本。" * 5000, "😀!" * 3000, "Ab. " * 9000, "\n\n", "é" * 5000]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", chunk_dedup.chunks(F.col("text")).alias("parts")).collect()
    for r in rows:
        assert "".join(r.parts) == r.text
        assert all(len(p) <= chunk_dedup.MAX_CHUNK for p in r.parts) and all(len(p) >= chunk_dedup.MIN_CHUNK for p in r.parts[:-1])


def test_an_edit_changes_few_chunks(spark):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefghij") * rng.randint(1, 3) + rng.choice([""] * 39 + ["."]) for _ in range(40_000))
    edited = text[:20_000] + "inserted" + text[20_000:]
    rows = spark.createDataFrame([(text,), (edited,)], "text string").select(chunk_dedup.chunks(F.col("text")).alias("parts")).collect()
    assert len(set(rows[1].parts) - set(rows[0].parts)) < 6 < len(rows[0].parts) / 10


@pytest.mark.parametrize("hashed", [lambda c: F.length(c).cast("long"), lambda c: F.lit(7).cast("long"), lambda c: F.pmod(F.xxhash64(c), F.lit(3))])
def test_contents_that_share_a_hash_are_told_apart(spark, hashed):
    rows = [(i, t) for i, t in enumerate(["ab.", "cd.", "a b.", "c\td.", "", None, "ab", "x. " * 900 + "ab.", "x. " * 900 + "cd.", "x." * 900 + "cd."])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_groups(rows, chunk_dedup.exact_groups(docs, hashed).collect())


def test_repeated_rows_keep_one_and_a_hot_group_stays_whole(spark):
    docs = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 50).cast("long").alias("doc_id"),
        F.when(F.col("id") % 3 < 2, F.lit("same text.")).otherwise(F.concat(F.lit("text "), F.col("id") % 7)).alias("text"),
    )
    check_groups(docs.collect(), chunk_dedup.exact_groups(docs).collect())


def test_without_copies_keeps_whole_rows(odd, none):
    kept = chunk_dedup.without_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len({bare(r.text) for r in odd.collect()})
    assert chunk_dedup.without_copies(none).count() == 0


def test_the_query_runs_no_python_on_executors(spark):
    plan = chunk_dedup.exact_groups(table(spark, FOLDER, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Bisector tournament


def plain_lloyd(rows, k, rounds, scale, seed):
    """rows: (vec_id, components), all usable."""
    points = [(i, [math.floor(scale * x) if abs(x) < 2.0**900 else scale * int(x) for x in v]) for i, v in rows]
    order = sorted(points, key=lambda p: (p[0] is None, hashlib.sha256(f"{seed}:{p[0]}".encode()).hexdigest(), p[1]))
    centroids = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in points:
            members[nearest(v)[1]].append(v)
        for n, vs in members.items():
            centroids[n] = [sum(x) // len(vs) for x in zip(*vs)]
    placed = [(i, *nearest(v)) for i, v in points]
    per = defaultdict(int)
    for _, apart, n in placed:
        per[n] += apart
    fit = lambda x: x if x < 2**63 else None
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, fit(apart), fit(per[n]), fit(sum(per.values())), names[n]) for i, apart, n in placed]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is None, x) for x in r])


@pytest.mark.parametrize("k, rounds", [(1, 1), (4, 0), (7, 3), (100, 2)])
def test_clusters_are_those_of_plain_lloyd(spark, k, rounds):
    rng = random.Random(k)
    rows = [(i % 60 if i % 9 else None, [rng.choice([-1.5, 0.0, 0.25, 2.0, rng.gauss(0, 1)]) for _ in range(3)]) for i in range(80)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = bisectors.cluster(docs, k, rounds, 4, 3, 9)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert in_order(found.collect()) == in_order(plain_lloyd(rows, k, rounds, 4, 9))


def test_ties_repeats_and_numbers_beyond_64_bits(spark):
    rows = [(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 5.0]), (3, [0.0, 5.0]), (4, [0.0, 0.0]), (5, [1e30, -1e30]), (6, [1e300, 1.0]), (7, [2.0**40, 3.5])]
    for seed in range(4):
        found = bisectors.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 3, 2, 1, 2, seed)
        assert in_order(found.collect()) == in_order(plain_lloyd(rows, 3, 2, 1, seed))


def test_only_usable_vectors_are_clustered(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []), (8, [3.0, 4.0]), (None, [0.0, 0.5])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"cluster": F.lit("own"), "hash": F.lit(1), "vector": F.lit(2)})
    usable = [r for r in rows if r[0] in (1, 8, None)]
    assert in_order(bisectors.cluster(docs, 2, 2, 2, 2).collect()) == in_order(plain_lloyd(usable, 2, 2, 2, 2))
    assert bisectors.cluster(docs.where("false"), 2, 2, 2, 2).collect() == []
    assert [r.vec_id for r in bisectors.cluster(docs.where("vec_id is null"), 2, 2, 2, 2).collect()] == [None]


# Conversation repair


def order(row):
    return row[0] is not None, row[0] or 0, row[1], row[2]


def faults(rows):
    """rows: (turn, role, text) in order."""
    seen, found = set(), []
    for _, role, text in rows:
        solid = bare(text)
        found.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def plain_repair(rows):
    """The cheapest edits by trying all of them, for very short conversations."""
    found, best = faults(rows), None
    choices = []
    for (_, role, text), fault in zip(rows, found):
        extra = 3 if fault == "truncated" else 0
        stays = [] if fault in ("blank", "duplicate") else [(extra, "K", role, text), (3 + extra, "R", "user", text), (3 + extra, "R", "assistant", text)]
        choices.append([(4, "D", None, None), *[s for s in stays if s[2]]])
    between = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for edits in itertools.product(*choices):
        for puts in itertools.product(between, repeat=len(rows) + 1):
            cost = sum(e[0] for e in edits) + 3 * sum(map(len, puts))
            if best and cost > best[0]:
                continue
            audit, turns = "", []
            for at, put in enumerate(puts):
                audit += "I" * len(put)
                turns += [(role, "") for role in put]
                if at < len(edits):
                    audit += edits[at][1]
                    turns += [edits[at][2:]] if edits[at][1] != "D" else []
            if re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in turns)):
                best = min(best or (cost, audit, turns), (cost, audit, turns))
    return best


def check_repair(frame, rows, found):
    """rows: (conv_id, turn, role, text), each as often as it counts; short conversations are held against all edits."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn, " " if role is None else role, " " if text is None else text))
    got = {r.conv_id: r for r in found}
    assert len(got) == len(found) and set(convs) <= set(got)
    for conv, turns in convs.items():
        turns.sort(key=order)
        r, names = got[conv], faults(turns)
        numbers = [t for t, _, _ in turns if t is not None]
        assert r.gaps == (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0)
        assert [r.blank, r.duplicate, r.truncated] == [names.count(x) for x in ("blank", "duplicate", "truncated")]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
        assert r.illegal == sum(p not in ("su", "ua", "au") for p in pairs)
        if len(turns) <= 3:
            cost, audit, kept = plain_repair(turns)
            assert (r.cost, r.audit) == (cost, audit), (conv, turns)
            assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in kept).encode()).hexdigest()


def random_turns(rng, convs, most):
    texts, roles = ["Hi.", "Hi", "Yes!", " \n", "", "No?", "on\u0085", None, "a.\n"], ["user", "assistant", "system", "tool", None, "u2", ""]
    return [
        (conv, rng.choice([None, *range(4)]), rng.choices(roles, [6, 6, 3, 1, 1, 1, 1])[0], rng.choice(texts))
        for conv in range(convs) for _ in range(rng.randint(1, most))
    ]


SCHEMA = "conv_id long, turn long, role string, text string"


def test_repairs_are_the_cheapest_of_all_edits(spark):
    rows = random_turns(random.Random(3), 90, 3) + random_turns(random.Random(4), 1, 1)
    rows += [(None, 0, "user", "Hi."), (None, None, "assistant", "Ho."), (10**17 + 1, 2**62, "user", "Hi.")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("conv", "digest", "kind", "part", "seq", "cost")})
    check_repair(frame, rows, repair.repair(frame.repartition(5)).collect())
    assert repair.repair(frame.where("false")).collect() == []


def viterbi(rows):
    """Cost and audit by one turn after the other, any number of them."""
    insert = {(0, 2): "I", (0, 3): "II", (1, 2): "I", (1, 3): "II", (2, 3): "I", (3, 2): "I", **{(p, p): "" for p in range(4)}}
    best = {q: (3 * len(a), a) for (p, q), a in insert.items() if p == 0}
    for (_, role, _), fault in zip(rows, faults(rows)):
        extra, step = 3 * (fault == "truncated"), {}

        def offer(q, cost, audit):
            for (p, to), a in insert.items():
                if p == q:
                    step[to] = min(step.get(to, (10**9, "")), (cost + 3 * len(a), audit + a))

        for p, (cost, audit) in best.items():
            offer(p, cost + 4, audit + "D")
            if fault not in ("blank", "duplicate"):
                for (at, symbol), q in repair.STEP.items():
                    if at == p and role[:1] == symbol:
                        offer(q, cost + extra, audit + "K")
                    if at == p and symbol in "ua":
                        offer(q, cost + 3 + extra, audit + "R")
        best = step
    return min(best[q] for q in (0, 3) if q in best)


@pytest.mark.parametrize("block", [3, 1 << 16])
def test_long_conversations_over_many_tasks(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(block)
    rows = [(1, at // 2, rng.choice(["user", "assistant"]), rng.choice(["Hi.", f"So {at}", f"Yes {at}.", ""])) for at in range(1500)]
    rows += [(2, 5, "user", "Same.")] * 700 + [(2, 6, "assistant", "Good.")] + [(c, t, r, "Text.") for c in range(3, 9) for t, r in enumerate(("user", "assistant"))]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = repair.repair(frame).collect()
    check_repair(frame, rows, found)
    for r in found:
        mine = sorted((x[1:] for x in rows if x[0] == r.conv_id), key=order)
        assert (r.cost, r.audit) == viterbi(mine)
    turns = repair.repaired_turns(frame).collect()
    for r in found:
        mine = sorted((x.place, x.role, x.text) for x in turns if x.conv_id == r.conv_id)
        assert [x[0] for x in mine] == list(range(len(mine)))
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for _, a, b in mine).encode()).hexdigest()


def test_cells_do_not_depend_on_where_an_interval_is_cut():
    rng = random.Random(8)
    for _ in range(200):
        symbols = "".join(rng.choice("dsuaxSUAX") for _ in range(rng.randint(2, 9)))
        cells = {n: repair.combined(repair.interval(symbols[:n]), repair.interval(symbols[n:])) for n in range(1, len(symbols))}
        assert all(cell == repair.interval(symbols) for cell in cells.values())


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "system" if t else None, "Yes. No!" if c else None) for c in (None, 0, 1, 2, 3) for t in (None, 0, 1, 2, 3, 4, 5, 6)]
    got = repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r, (conv, turn, role, text) in zip(got, rows):
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = " " if text is None else text
        assert r.copies == {0: 0, 3: 2}.get(fault, 1)
        assert r.text == {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        assert r.role == ("user" if fault == 4 else " " if role is None else role)


def test_dropped_conversations_and_long_texts(spark):
    rows = [(1, 0, "user", "Hi.", 0), (2, 0, "user", "x. " * 400_000, 1), (2, 1, "assistant", "y" * 1_000_000, 1), (3, 0, "user", "A.", 3)]
    found = {r.conv_id: r for r in repair.repair(spark.createDataFrame(rows, SCHEMA + ", copies long")).collect()}
    assert tuple(found[1])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert (found[2].truncated, found[2].audit, found[2].cost) == (1, "KK", 3)
    assert (found[3].duplicate, found[3].illegal, found[3].cost, found[3].audit) == (2, 2, 11, "KDDI")
