"""Conversation structure repair by weighted CYK parsing over intervals of turns.

A repaired conversation is empty, or an optional system turn followed by pairs of user and assistant.
The symbols of the grammar are pairs of states p q of that language, and a cell holds for each pair the
cheapest edits (cost, then audit) that lead an interval of turns from p to q. In Chomsky normal form a
symbol is an edit of one turn, `pq -> edit`, or two symbols, `pq -> pr rq`. Insertions need no turn,
so the cells of single turns are closed under insertions on both sides. As the symbols are
pairs of states, an interval's cell is the same wherever it is cut, and intervals are combined
bottom-up by length: single turns, then two of them, then four, and so on.

Of two audits of one interval and cost none is the other's beginning: both have a letter for
every turn, so the longer one would hold more insertions and cost more. So the least
audit of a whole is made of least audits of its parts.

Spark sorts the turns in ranges. A long conversation spans several tasks, each of which combines
its interval; then the intervals' cells, and after them the texts, pass through one task in order.
Only the cells are held there; a text is gone once it is hashed or handed on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: 0 nothing yet, 1 behind the system turn, 2 behind a user turn, 3 behind an assistant turn.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
ORDERLY = ("su", "ua", "au")
SOLID = r"[^\x20\x09-\x0D]"
#: The last character that is not blank does not end a sentence.
OPEN_END = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"
#: Intervals of up to so many turns are looked up; those of a task are cut after BLOCK turns.
KNOWN, BLOCK = 16, 1 << 16
LEAD = 64

Cell = dict[tuple[int, int], tuple[int, str]]


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two intervals that follow each other."""
    found: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for (at, q), (more, rest) in right.items():
            if at == r and (known := found.get((p, q))) != (new := (cost + more, audit + rest)) and (known is None or new < known):
                found[p, q] = new
    return found


def _insertions() -> Cell:
    """Insertions alone, none included: no state is worth a second visit."""
    found: Cell = {(p, p): (0, "") for p in range(4)}
    for _ in range(4):
        for (p, r), (cost, audit) in list(found.items()):
            for symbol in "ua":
                q = STEP.get((r, symbol))
                if q is not None:
                    found[p, q] = min(found.get((p, q), (1 << 60, "")), (cost + INSERT, audit + "I"))
    return found


@lru_cache(maxsize=None)
def single(symbol: str) -> Cell:
    """The cell of one turn: `d` must go; s, u, a stand for its role's initial, x for any other, capitals are truncated."""
    found: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if symbol != "d":
        extra = TRUNCATED if symbol.isupper() else 0
        edits = [(symbol.lower(), extra, "K")] + [(role, REROLE + extra, "R") for role in ROLES]
        for p in range(4):
            for put, cost, letter in edits:
                q = STEP.get((p, put))
                if q is not None:
                    found[p, q] = min(found.get((p, q), (1 << 60, "")), (cost, letter))
    closure = _insertions()
    return combined(combined(closure, found), closure)


@lru_cache(maxsize=1 << 13)
def _known(symbols: str) -> Cell:
    if len(symbols) == 1:
        return single(symbols)
    half = 1 << (len(symbols) - 1).bit_length() - 1
    return combined(_known(symbols[:half]), _known(symbols[half:]))


def interval(symbols: str) -> Cell:
    """The cell of one turn or more, bottom-up by the intervals' length."""
    cells = [_known(symbols[at : at + KNOWN]) for at in range(0, len(symbols), KNOWN)]
    while len(cells) > 1:
        cells = [combined(*cells[at : at + 2]) if at + 1 < len(cells) else cells[at] for at in range(0, len(cells), 2)]
    return cells[0]


def cheapest(cell: Cell | None) -> tuple[int, str]:
    """Cost and audit of the whole conversation; without turns nothing is done."""
    return min(cell[0, q] for q in FINAL if (0, q) in cell) if cell else (0, "")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: turns with the faults that a checksum of conv_id and turn deals out.

    A null role or text is one space, and so is a null id or turn in the checksum. copies is 0 for a
    turn that is dropped and 2 for one that is repeated.
    """
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    fault = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _keyed(turns: DataFrame) -> DataFrame:
    """The turns with what sorts them: turn (null first), then role and text by their first characters and a digest."""
    body = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return turns.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"), "role", "text", "copies",
        F.substring("role", 1, LEAD).alias("lead_role"), F.substring("text", 1, LEAD).alias("lead_text"),
        F.sha2(body, 256).alias("digest"),
    )


def _order() -> list[Column]:
    return [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("lead_role"), F.col("lead_text"), F.col("digest")]


def _flagged(keyed: DataFrame) -> DataFrame:
    """Distinct turns with their number of copies, whether they are blank or cut off, and whether an earlier turn says the same."""
    dropped = F.col("copies") == 0
    only = {c: F.when(dropped, F.lit(None)).otherwise(F.col(c)) for c in ("turn", "lead_role", "lead_text", "digest")}
    slim = keyed.select(
        "conv", *[value.alias(c) for c, value in only.items()], "copies",
        (~F.col("text").rlike(SOLID)).alias("blank"), F.col("text").rlike(OPEN_END).alias("open"),
    )
    flags = ["blank", "open"]
    same = ["conv", "turn", "lead_role", "lead_text", "digest"]
    rows = slim.withColumns({c: ~dropped & F.col(c) for c in flags}).groupBy(*same, *flags).agg(F.sum("copies").alias("copies"))
    first = F.when(F.count("turn") == F.count("*"), F.min("turn")).alias("first_turn")
    again = rows.where("digest is not null").groupBy("conv", "digest").agg(F.count("*").alias("turns"), first).where("turns > 1")
    again = again.select(F.col("conv").alias("of"), F.col("digest").alias("said"), "first_turn", "turns")
    joined = rows.join(again, F.col("conv").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("said")), "left")
    return joined.select(*same, *flags, "copies", (F.col("turns").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))).alias("again"))


#: What an interval of turns is summed up as; the cells as two lists, in the order of _PAIRS.
_PAIRS = [(p, q) for p in range(4) for q in range(4)]
_SUMMARY = "turns long, blank long, duplicate long, truncated long, illegal long, distinct long, low string, high string, first string, last string"
_COUNTS = ["turns", "blank", "duplicate", "truncated", "illegal", "distinct"]
_INTERVAL = f"conv string, part int, seq int, {_SUMMARY}, costs array<long>, audits array<string>"


class _Summary:
    """Counts, ends and cell of an interval of turns, which may be empty."""

    def __init__(self) -> None:
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.low = self.high = self.first = self.last = None
        self.symbols: list[str] = []
        self.cell: Cell | None = None

    def add(self, row) -> None:
        """A distinct turn with all its copies: the first may stay, the others repeat it."""
        if not row.copies:
            return
        copies, counts, initial = int(row.copies), self.counts, (row.lead_role or "")[:1]
        turn = None if row.turn is None else int(row.turn)
        counts["turns"] += copies
        if row.blank:
            counts["blank"] += copies
        else:
            counts["duplicate"] += copies - (not row.again)
            counts["truncated"] += not row.again and row.open
        counts["illegal"] += (copies - 1) * (initial + initial not in ORDERLY) + (self.first is not None and self.last + initial not in ORDERLY)
        if turn is not None:
            counts["distinct"] += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.first, self.last = initial if self.first is None else self.first, initial
        kept = initial if initial in ("s", "u", "a") else "x"
        self.symbols.append("d" if row.blank or row.again else kept.upper() if row.open else kept)
        if copies > 1:
            self._close()
            self.cell = combined(self.cell, _power("d", copies - 1))
        elif len(self.symbols) >= 4096:
            self._close()

    def _close(self) -> None:
        if self.symbols:
            mine, self.symbols = interval("".join(self.symbols)), []
            self.cell = mine if self.cell is None else combined(self.cell, mine)

    def row(self) -> tuple:
        self._close()
        cells = [self.cell.get(pair) for pair in _PAIRS] if self.cell else None
        low, high = (None if turn is None else str(turn) for turn in (self.low, self.high))
        return (
            *self.counts.values(), low, high, self.first, self.last,
            [c[0] if c else None for c in cells] if cells else None, [c[1] if c else None for c in cells] if cells else None,
        )

    def follow(self, row) -> None:
        """The interval that comes next, as row() gave it."""
        if row.first is None:
            return
        for name in _COUNTS:
            self.counts[name] += int(getattr(row, name))
        self.counts["illegal"] += self.first is not None and self.last + row.first not in ORDERLY
        if row.low is not None:
            self.counts["distinct"] -= self.high is not None and int(row.low) == self.high
            self.low, self.high = int(row.low) if self.low is None else self.low, int(row.high)
        self.first, self.last = row.first if self.first is None else self.first, row.last
        mine = {pair: (int(cost), audit) for pair, cost, audit in zip(_PAIRS, row.costs, row.audits, strict=True) if audit is not None}
        self.cell = mine if self.cell is None else combined(self.cell, mine)

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.counts["distinct"]


def _power(symbol: str, times: int) -> Cell:
    """The cell of `times` equal turns, by doubling."""
    found, square = None, single(symbol)
    while times:
        if times & 1:
            found = square if found is None else combined(found, square)
        times >>= 1
        if times:
            square = combined(square, square)
    return found


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator:
    """The rows of all batches; what is missing is None."""
    for batch in batches:
        yield from batch.astype(object).where(batch.notna(), None).itertuples(index=False)


def _intervals(flagged: DataFrame) -> DataFrame:
    """Each conversation's intervals in order, several where its turns lie in several tasks or are many."""
    ranged = flagged.repartitionByRange(*_order()).sortWithinPartitions(*_order()).withColumn("part", F.spark_partition_id())
    columns = [c.split()[0] for c in _INTERVAL.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, current, seq, summary = [], None, 0, None
        for row in _rows(batches):
            if summary is None or row.conv != current or summary.counts["turns"] >= BLOCK:
                if summary is not None:
                    done.append((current, row.part, seq, *summary.row()))
                    seq += 1
                current, summary = row.conv, _Summary()
                if len(done) >= 2000 or done and len(done[-1][-1] or "") and len(done[-1][-1][0] or "") > 1000:
                    yield pd.DataFrame(done, columns=columns, dtype=object)
                    done = []
            summary.add(row)
            part = row.part
        if summary is not None:
            done.append((current, part, seq, *summary.row()))
            yield pd.DataFrame(done, columns=columns, dtype=object)

    # As text a null turn does not turn its neighbours into floating point numbers.
    return ranged.withColumn("turn", F.col("turn").cast("string")).mapInPandas(run, _INTERVAL)


def _in_order(turns: DataFrame) -> DataFrame:
    """For each conversation its intervals, then its turns with their texts, one after the other in one task."""
    keyed = _keyed(turns)
    found = _intervals(_flagged(keyed)).withColumn("kind", F.lit(0))
    texts = keyed.where("copies > 0").withColumn("kind", F.lit(1))
    both = found.unionByName(texts, allowMissingColumns=True).repartition("conv")
    within = [F.col("conv").asc_nulls_first(), "kind", "part", "seq", *_order()[1:]]
    return both.sortWithinPartitions(*within).drop("turn", "lead_role", "lead_text", "digest", "part", "seq")


class _Repair:
    """One conversation: its intervals' summary, then its turns by the audit."""

    def __init__(self, conv) -> None:
        self.conv, self.summary, self.plan, self.at, self.state, self.place = conv, _Summary(), None, 0, 0, 0

    def _put(self, edit: str, role: str, text: str, symbol: str) -> tuple:
        self.state = STEP[self.state, symbol]
        self.place += 1
        return self.conv, self.place - 1, edit, role, text

    def _wanted(self) -> str:
        return "a" if self.state == 2 else "u"

    def inserted(self) -> Iterator[tuple]:
        if self.plan is None:
            self.plan = cheapest(self.summary.cell)
        audit = self.plan[1]
        while self.at < len(audit) and audit[self.at] == "I":
            self.at += 1
            yield self._put("insert", ROLES[self._wanted()], "", self._wanted())

    def turn(self, row) -> Iterator[tuple]:
        for _ in range(int(row.copies)):
            yield from self.inserted()
            letter = self.plan[1][self.at]
            self.at += 1
            if letter == "K":
                yield self._put("keep", row.role, row.text, row.role[:1])
            elif letter == "R":
                yield self._put("rerole", ROLES[self._wanted()], row.text, self._wanted())


def _repairs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[_Repair, Iterator[tuple]]]:
    """For every turn and every end of a conversation: the conversation, and its repaired turns that come next."""
    current = None
    for row in _rows(batches):
        if current is None or row.conv != current.conv:
            if current is not None:
                yield current, current.inserted()
            current = _Repair(row.conv)
        if row.kind == 0:
            current.summary.follow(row)
        else:
            yield current, current.turn(row)
    if current is not None:
        yield current, current.inserted()


def repaired_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit (keep, rerole or insert), role, text of the repaired conversations."""
    kind = dict(turns.dtypes)["conv_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, held = [], 0
        for _, rows in _repairs(batches):
            for row in rows:
                done.append(row)
                held += len(row[-1])
                if held > 1 << 22 or len(done) >= 5000:
                    yield pd.DataFrame(done, columns=["conv_id", "place", "edit", "role", "text"])
                    done, held = [], 0
        if done:
            yield pd.DataFrame(done, columns=["conv_id", "place", "edit", "role", "text"])

    found = _in_order(_with_copies(turns)).mapInPandas(run, "conv_id string, place long, edit string, role string, text string")
    return found.withColumn("conv_id", F.col("conv_id").cast(kind))


def repair(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: a row per conversation.

    turns has conv_id, turn, role and text, and may have copies: how often the row counts (0: not, but
    its conversation is in the result). A null role or text is one space. A conversation's turns
    stand in the order of turn (null first), then of role and text. Of a turn's faults the first
    counts: blank, duplicate (an earlier turn has its role and text), truncated (its last character that is not blank is
    none of .!?). Roles are judged by their first character; an empty role can't be kept.
    gaps are the numbers missing between the least and the largest turn.

    The audit has a letter per edit, in order: K keeps a turn, R makes it user or assistant, D deletes it, I
    inserts one without text. Of the audits of least cost it is the least in ASCII. repaired_sha256 is that of the lines role:text.
    A null conv_id is a conversation. One without turns has zeros and an empty audit.
    """
    kind = dict(turns.dtypes)["conv_id"]
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, digest, current = [], None, None

        def ended(one: _Repair) -> tuple:
            counts = one.summary.counts
            found = [counts[c] for c in ("blank", "duplicate", "truncated", "illegal")]
            return (one.conv, one.summary.gaps(), *found, *one.plan, digest.hexdigest())

        for one, rows in _repairs(batches):
            if one is not current:
                if current is not None:
                    done.append(ended(current))
                    if len(done) >= 2000 or len(current.plan[1]) > 1000:
                        yield pd.DataFrame(done, columns=names)
                        done = []
                current, digest = one, hashlib.sha256()
            for _, place, _, role, text in rows:
                digest.update((("\n" if place else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        if current is not None:
            done.append(ended(current))
        if done:
            yield pd.DataFrame(done, columns=names)

    schema = "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _in_order(_with_copies(turns)).mapInPandas(run, schema).withColumn("conv_id", F.col("conv_id").cast(kind))


def _with_copies(turns: DataFrame) -> DataFrame:
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return turns.select("conv_id", "turn", *texts, copies.cast("long").alias("copies"))
