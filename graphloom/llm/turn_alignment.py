"""Repair of conversations by aligning their turns with the strings of a grammar.

A repaired conversation has the role initials ``(s?(ua)+)?``: of each length there is one such string at most, so a
conversation is aligned with the string of each feasible length (Wagner-Fischer: keep, rerole, delete, insert). As the
strings end alike, one table of costs over (turns left, characters left) holds the alignments with all lengths. A cell
is computed only if a path through it can cost as little as the incumbent, the cost of a quick repair (Ukkonen's band).
The cheapest lengths are traced, from the first turn on and taking the least letter that stays cheapest, and the least
of these audits is the answer.

Conversations of up to ``ROWS`` turns and ``BYTES`` of text are aligned whole, in a stream of sorted rows. Longer ones
are cut into blocks: each block gives the costs between the grammar's states at its two ends, these combine by
(min, +), and each block then traces its own turns against the costs of what follows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import sized_broadcast, stored

#: Costs of the edits, and of a truncated turn that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: A conversation of more turns or bytes of text is cut into blocks of turns.
ROWS, BYTES, BLOCK = 1024, 4_000_000, 512
#: States of the grammar: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
_INF = 1 << 40
#: A turn is a letter: role initial (s, u, a, other) in lower case, upper case if truncated, or D if it must go.
MUST_GO = "D"
_WHITE = " \t\n\x0b\x0c\r"


# -- alignment of one stretch of turns ----------------------------------------------------------
def _greedy(codes: str, state: int, last: int) -> int:
    """The cost of a quick repair from one state to another: a missing role is inserted, a wrong one replaced."""
    cost = 0
    for code in codes:
        if code == MUST_GO:
            cost += DELETE
            continue
        cost += TRUNCATED * code.isupper()
        initial = code.lower()
        if state == START and initial == "s":
            state = SYSTEM
            continue
        expected = "a" if state == USER else "u"
        if initial in "ua" and initial != expected:
            cost += INSERT
            state = USER if initial == "u" else ASSISTANT
            continue
        cost += REROLE * (initial != expected)
        state = USER if expected == "u" else ASSISTANT
    for _ in range(3):
        if state == last:
            return cost
        cost += INSERT
        state = ASSISTANT if state == USER else USER
    return _INF


class _Table:
    """Costs of aligning codes[i:] with the last k characters of the alternating string that ends in ``last``."""

    def __init__(self, codes: str, last: int, limit: int):
        n = len(codes)
        self.codes, self.last = codes, last
        kept = np.array([c != MUST_GO for c in codes], bool)
        cut = np.array([c != MUST_GO and c.isupper() for c in codes], bool)
        left = np.append(np.cumsum(kept[::-1])[::-1], 0)
        cut_left = np.append(np.cumsum(cut[::-1])[::-1], 0)
        forced = int(DELETE * (~kept).sum() + TRUNCATED * cut.sum())
        slack = max(0, limit - forced)
        more = slack // INSERT
        # deleting a truncated turn costs one more than keeping it, deleting another costs all of DELETE
        cheap = DELETE - TRUNCATED
        fewer = np.where(
            cut_left * cheap >= slack, slack // cheap, cut_left + np.maximum(slack - cut_left * cheap, 0) // DELETE
        )
        self.low = np.maximum(0, left - fewer).tolist()
        self.high = (left + more).tolist()
        first = np.arange(self.low[n], self.high[n] + 1)
        rows: list[np.ndarray] = [first * INSERT]
        for i in range(n - 1, -1, -1):
            low, high = self.low[i], self.high[i]
            below, at = rows[-1], self.low[i + 1]
            k = np.arange(low, high + 1)
            base = self._shifted(below, at, k) + DELETE
            code = codes[i]
            if code != MUST_GO:
                price = TRUNCATED * code.isupper()
                initial = code.lower()
                match = np.where(
                    (k % 2 == 1) == (last == ASSISTANT),
                    price if initial == "a" else price + REROLE,
                    price if initial == "u" else price + REROLE,
                )
                base = np.minimum(base, self._shifted(below, at + 1, k) + np.where(k > 0, match, _INF))
            rows.append(np.minimum.accumulate(base - INSERT * k) + INSERT * k)
        self.rows = [r.tolist() for r in rows[::-1]]

    @staticmethod
    def _shifted(below: np.ndarray, at: int, k: np.ndarray) -> np.ndarray:
        out = np.full(len(k), _INF)
        a, b = max(int(k[0]), at), min(int(k[-1]) + 1, at + len(below))
        if a < b:
            out[a - int(k[0]) : b - int(k[0])] = below[a - at : b - at]
        return out

    def cost(self, i: int, k: int) -> int:
        return self.rows[i][k - self.low[i]] if self.low[i] <= k <= self.high[i] else _INF

    def first_is_user(self, k: int) -> bool:
        return (k % 2 == 0) == (self.last == ASSISTANT)

    def match(self, i: int, k: int) -> int:
        """What it costs to put turn i at the k-th place from the end."""
        code = self.codes[i]
        if code == MUST_GO:
            return _INF
        return TRUNCATED * code.isupper() + REROLE * (code.lower() != ("u" if self.first_is_user(k) else "a"))

    def trace(self, i: int, k: int) -> str:
        """The least of the cheapest edits from turn i on."""
        out, n = [], len(self.codes)
        while i < n or k:
            here = self.cost(i, k)
            if i < n and self.cost(i + 1, k) + DELETE == here:
                out.append("D")
                i += 1
            elif k and self.cost(i, k - 1) + INSERT == here:
                out.append("I")
                k -= 1
            else:
                out.append("K" if self.codes[i].lower() == ("u" if self.first_is_user(k) else "a") else "R")
                i, k = i + 1, k - 1
        return "".join(out)


def _system_costs(codes: str, table: _Table, k: int) -> list[int]:
    """For each turn i the cost of codes[i:] if a system turn is still to come and k characters follow it."""
    out = [_INF]
    for i in range(len(codes) - 1, -1, -1):
        kept = TRUNCATED * codes[i].isupper() + table.cost(i + 1, k) if codes[i] in "sS" else _INF
        out.append(min(out[-1] + DELETE, kept))
    return out[::-1]


def align(codes: str, state: int = START, after: tuple[int, ...] = (0, _INF, _INF, 0)) -> tuple[int, str, int]:
    """Cost, least audit and last state of the cheapest way through ``codes`` from ``state``.

    ``after`` is what the conversation costs from each state on behind these turns; by default it ends there.
    """
    limit = min(_greedy(codes, state, s) + after[s] for s in (USER, ASSISTANT))
    all_gone = DELETE * len(codes)
    if after[state] < _INF:
        limit = min(limit, all_gone + after[state])
    if state == START and after[SYSTEM] < _INF:
        limit = min(limit, *[all_gone - DELETE + TRUNCATED * c.isupper() + after[SYSTEM] for c in codes if c in "sS"], _INF)
    if limit >= _INF:
        return _INF, "", state
    found: list[tuple[int, _Table | None, int, bool, int]] = []  # cost, table, characters, after a system turn, last state
    if after[state] < _INF:
        found.append((all_gone + after[state], None, 0, False, state))
    for last in (USER, ASSISTANT):
        if after[last] >= _INF:
            continue
        table = _Table(codes, last, limit - after[last])
        for k in range(max(1, table.low[0]), table.high[0] + 1):
            if table.first_is_user(k) == (state != USER):
                found.append((table.cost(0, k) + after[last], table, k, False, last))
        if state == START and any(c in "sS" for c in codes):
            for k in range(1, max(table.high) + 1):
                if table.first_is_user(k):
                    found.append((_system_costs(codes, table, k)[0] + after[last], table, k, True, last))
    if state == START and after[SYSTEM] < _INF:
        kept = [all_gone - DELETE + TRUNCATED * c.isupper() for c in codes if c in "sS"]
        if kept:
            found.append((min(kept) + after[SYSTEM], None, 0, True, SYSTEM))
    best = min(f[0] for f in found)
    audits = [(_audit(codes, *f[1:4]), f[4]) for f in found if f[0] == best]
    audit, last = min(audits)
    return best, audit, last


def _audit(codes: str, table: _Table | None, k: int, system: bool) -> str:
    if not system:
        return table.trace(0, k) if table else "D" * len(codes)
    if table:
        costs, i = _system_costs(codes, table, k), 0
        while costs[i + 1] + DELETE == costs[i]:
            i += 1
        return "D" * i + "K" + table.trace(i + 1, k)
    prices = {i: c.isupper() for i, c in enumerate(codes) if c in "sS"}
    at = max(i for i, p in prices.items() if p == min(prices.values()))
    return "D" * at + "K" + "D" * (len(codes) - at - 1)


@lru_cache(maxsize=50_000)
def align_short(codes: str) -> tuple[int, str]:
    return align(codes)[:2]


# -- the turns ----------------------------------------------------------------------------------
def letter_of(role: Column, text: Column) -> Column:
    """The letter of a turn whose role and text are not seen before; blank texts give MUST_GO."""
    first = F.substring(role, 1, 1)
    initial = F.when(first.isin("s", "u", "a"), first).otherwise("x")
    body = F.rtrim(text, F.lit(_WHITE))
    ended = F.right(body, F.lit(1)).isin(".", "!", "?")
    return F.when(body == "", MUST_GO).when(ended, initial).otherwise(F.upper(initial))


def _role_initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "x"


_LEGAL = {"su", "ua", "au"}


class _Conversation:
    """Faults and letters of the turns of one conversation, in order."""

    def __init__(self) -> None:
        self.roles, self.texts, self.codes = [], [], []
        self.seen: set[tuple[str, str]] = set()
        self.turns: set[int] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, letter: str) -> None:
        if letter == MUST_GO:
            self.blank += 1
        elif (role, text) in self.seen:
            self.duplicate += 1
            letter = MUST_GO
        else:
            self.truncated += letter.isupper()
        self.seen.add((role, text))
        if self.roles:
            self.illegal += _role_initial(self.roles[-1]) + _role_initial(role) not in _LEGAL
        self.roles.append(role)
        self.texts.append(text)
        self.codes.append(letter)
        if turn is not None:
            self.turns.add(turn)

    def gaps(self) -> int:
        return max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0


class _Rendering:
    """The repaired turns, one after the other, as the letters of an audit name them."""

    def __init__(self) -> None:
        self.place, self.after_system = 0, 0

    def put(self, letters: str, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """Role, text and edit of the repaired turns that one turn and the insertions around it give."""
        for edit in letters:
            if edit == "D":
                continue
            if edit == "K":
                if self.place == 0 and role[:1] == "s":
                    self.after_system = 1
                yield role, text, edit
            else:
                expected = "assistant" if (self.place - self.after_system) % 2 else "user"
                yield expected, text if edit == "R" else "", edit
            self.place += 1


def _pieces(audit: str, turns: int) -> list[str]:
    """The audit cut behind each turn's own letter; insertions at the end belong to the last turn."""
    out, start = [], 0
    for i, edit in enumerate(audit):
        if edit != "I":
            out.append(audit[start : i + 1])
            start = i + 1
    if out and start < len(audit):
        out[-1] += audit[start:]
    return out


REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
TURNS = "conv_id long, place long, role string, text string, edit string"
_COLUMNS = [c.split(" ")[0] for c in REPORT.split(", ")]


def _long(value: int) -> int | None:
    return value if value < 2**63 else None


def _finish(conv_id: int | None, c: _Conversation, as_turns: bool) -> Iterator[tuple]:
    cost, audit = align_short("".join(c.codes)) if len(c.codes) <= 64 else align("".join(c.codes))[:2]
    rendering = _Rendering()
    repaired = (
        item for piece, role, text in zip(_pieces(audit, len(c.codes)), c.roles, c.texts) for item in rendering.put(piece, role, text)
    )
    if as_turns:
        for place, item in enumerate(repaired):
            yield (conv_id, place, *item)
        return
    digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text, _ in repaired).encode())
    yield (conv_id, _long(c.gaps()), c.blank, c.duplicate, c.truncated, c.illegal, cost, audit, digest.hexdigest())


def _batches(rows: Iterator[tuple], ddl_names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows gathered into batches of some thousand rows or some megabytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= 4096 or size > 8_000_000:
            yield pa.record_batch([pa.array(col, t) for col, t in zip(zip(*held), types)], names=ddl_names)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(col, t) for col, t in zip(zip(*held), types)], names=ddl_names)


_REPORT_TYPES = [pa.int64()] * 7 + [pa.string()] * 2
_TURN_TYPES = [pa.int64()] * 2 + [pa.string()] * 3


def _whole(rows: DataFrame, as_turns: bool) -> DataFrame:
    """Conversations aligned whole: a stream of rows sorted by conversation and turn, one conversation held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answers() -> Iterator[tuple]:
            open_, conv = None, _Conversation()
            for batch in batches:
                for conv_id, turn, role, text, letter in zip(*[c.to_pylist() for c in batch.columns]):
                    if open_ is None or open_[0] != conv_id:
                        if open_ is not None:
                            yield from _finish(open_[0], conv, as_turns)
                        open_, conv = (conv_id,), _Conversation()
                    if letter is not None:  # else only the mark that the conversation exists
                        conv.add(turn, role, text, letter)
            if open_ is not None:
                yield from _finish(open_[0], conv, as_turns)

        if as_turns:
            yield from _batches(answers(), ["conv_id", "place", "role", "text", "edit"], _TURN_TYPES)
        else:
            yield from _batches(answers(), _COLUMNS, _REPORT_TYPES)

    sorted_ = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return sorted_.select("conv_id", "turn", "role", "text", "letter").mapInArrow(run, TURNS if as_turns else REPORT)


def _blocks(rows: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Long conversations: their rows with a rising place, and per block of rows its letters in order."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.repartitionByRange(parts, "conv_id", "turn", "role", F.left("text", F.lit(64)))
    spread = spread.sortWithinPartitions("conv_id", "turn", "role", "text")
    placed = stored(spread.withColumn("place", F.monotonically_increasing_id()), "turns")
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    first = placed.groupBy("conv_id", same.alias("same")).agg(F.min("place").alias("first")).select("first")
    small = placed.select("conv_id", "turn", "place", "letter", F.substring("role", 1, 1).alias("initial"))
    judged = small.join(first, F.col("place") == F.col("first"), "left")
    blank = F.col("letter") == MUST_GO
    judged = judged.select(
        "conv_id", "place", blank.alias("blank"), (~blank & F.col("first").isNull()).alias("duplicate"),
        F.when(F.col("first").isNull(), MUST_GO).otherwise(F.col("letter")).alias("letter"),
        F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x").alias("initial"),
    )
    entries = F.array_sort(F.collect_list(F.struct("place", "letter", "initial")))
    blocks = judged.groupBy("conv_id", F.expr(f"place div {block}").alias("block")).agg(
        entries.alias("e"), F.sum(F.col("blank").cast("long")).alias("blank"), F.sum(F.col("duplicate").cast("long")).alias("duplicate"),
    )
    blocks = blocks.select(
        "conv_id", "block", "blank", "duplicate", F.col("e")["place"].alias("places"),
        F.array_join(F.col("e")["letter"], "").alias("codes"), F.array_join(F.col("e")["initial"], "").alias("initials"),
    )
    return placed, stored(blocks, "blocks")


def _crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The costs from each state before a block to each state behind it."""
    for batch in batches:
        out = []
        for codes in batch.column(2).to_pylist():
            costs = []
            for state in range(4):
                for last in range(4):
                    after = tuple(0 if s == last else _INF for s in range(4))
                    costs.append(align(codes, state, after)[0])
            out.append(costs)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], names=["conv_id", "block", "costs"])


def _values(pieces: pd.DataFrame) -> pd.DataFrame:
    """What a conversation costs behind each of its blocks, from each state."""
    pieces = pieces.sort_values("block")
    after, out = np.array([0, _INF, _INF, 0]), []
    for costs in reversed(pieces["costs"].tolist()):
        out.append(after.tolist())
        after = np.minimum((np.array(costs).reshape(4, 4) + after).min(axis=1), _INF)
    return pd.DataFrame(
        {"conv_id": pieces["conv_id"].astype("Int64"), "block": pieces["block"], "after": out[::-1], "total": int(after[START])}
    )


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each state before a block its least audit and the state behind it."""
    for batch in batches:
        audits, lasts = [], []
        for codes, after in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            found = [align(codes, state, tuple(after)) for state in range(4)]
            audits.append([f[1] for f in found])
            lasts.append([f[2] for f in found])
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(audits, pa.list_(pa.string())), pa.array(lasts, pa.list_(pa.int32()))],
            names=["conv_id", "block", "audits", "lasts"],
        )


def _chained(pieces: pd.DataFrame) -> pd.DataFrame:
    """The state before each block."""
    pieces = pieces.sort_values("block")
    state, out = START, []
    for lasts in pieces["lasts"].tolist():
        out.append(state)
        state = int(lasts[state])
    return pd.DataFrame({"conv_id": pieces["conv_id"].astype("Int64"), "block": pieces["block"], "state": out})


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for places, audit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield pa.record_batch([pa.array(places, pa.int64()), pa.array(_pieces(audit, len(places)), pa.string())], names=["place", "letters"])


def _rendered(as_turns: bool):
    """Rows in order of conversation and place, as repaired turns or as one digest per conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answers() -> Iterator[tuple]:
            open_, rendering, digest = None, _Rendering(), hashlib.sha256()
            for batch in batches:
                for conv_id, letters, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                    if open_ is None or open_[0] != conv_id:
                        if open_ is not None and not as_turns:
                            yield open_[0], digest.hexdigest()
                        open_, rendering, digest = (conv_id,), _Rendering(), hashlib.sha256()
                    for new_role, new_text, edit in rendering.put(letters, role, text):
                        if as_turns:
                            yield conv_id, rendering.place, new_role, new_text, edit
                        else:
                            digest.update(b"\n" * (rendering.place > 0) + f"{new_role}:{new_text}".encode())
            if open_ is not None and not as_turns:
                yield open_[0], digest.hexdigest()

        if as_turns:
            yield from _batches(answers(), ["conv_id", "place", "role", "text", "edit"], _TURN_TYPES)
        else:
            yield from _batches(answers(), ["conv_id", "repaired_sha256"], [pa.int64(), pa.string()])

    return run


def _cut(rows: DataFrame, as_turns: bool, block: int) -> DataFrame:
    """Conversations too long to be held whole: blocks of turns, whose costs meet by (min, +)."""
    placed, blocks = _blocks(rows, block)
    crossings = stored(
        blocks.select("conv_id", "block", "codes").mapInArrow(_crossings, "conv_id long, block long, costs array<long>"), "crossings"
    )
    values = stored(
        crossings.groupBy("conv_id").applyInPandas(lambda p: _values(p), "conv_id long, block long, after array<long>, total long"), "values"
    )
    behind = values.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "after", "total")
    here = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    traced = blocks.join(behind, here).select("conv_id", "block", "codes", "after").mapInArrow(
        _traced, "conv_id long, block long, audits array<string>, lasts array<int>"
    )
    traced = stored(traced, "traced")
    states = traced.select("conv_id", "block", "lasts").groupBy("conv_id").applyInPandas(lambda p: _chained(p), "conv_id long, block long, state int")
    states = states.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "state")
    chosen = stored(
        traced.join(states, here).select("conv_id", "block", F.get("audits", F.col("state")).alias("audit")), "audits"
    )
    named = chosen.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "audit")
    letters = blocks.join(named, here).select("places", "audit").mapInArrow(_exploded, "place long, letters string")
    ordered = placed.join(letters, "place").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    ordered = ordered.select("conv_id", "letters", "role", "text")
    if as_turns:
        return ordered.mapInArrow(_rendered(True), TURNS)
    digests = ordered.mapInArrow(_rendered(False), "conv_id long, repaired_sha256 string")

    inside = F.expr(
        "size(filter(sequence(1, length(initials) - 1), i -> i > 0 and substring(initials, i, 2) not in ('su', 'ua', 'au')))"
    )
    inside = F.when(F.length("initials") > 1, inside).otherwise(0)
    truncated = F.length(F.regexp_replace("codes", "[^SUAX]", ""))
    sums = blocks.groupBy("conv_id").agg(
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum(truncated.cast("long")).alias("truncated"),
        F.sum(inside.cast("long")).alias("inside"),
        F.array_sort(F.collect_list(F.struct("block", F.left("initials", F.lit(1)).alias("f"), F.right("initials", F.lit(1)).alias("l")))).alias("ends"),
    )
    between = F.expr(
        "size(filter(sequence(1, size(ends)), i -> i < size(ends) and concat(ends[i - 1].l, ends[i].f) not in ('su', 'ua', 'au')))"
    )
    sums = sums.select("conv_id", "blank", "duplicate", "truncated", (F.col("inside") + between).cast("long").alias("illegal"))
    numbers = placed.groupBy("conv_id", "turn").agg(F.count(F.lit(1))).groupBy("conv_id").agg(
        F.coalesce(
            (F.max("turn").cast("decimal(38,0)") - F.min("turn").cast("decimal(38,0)") + 1 - F.count("turn")).try_cast("long"),
            F.when(F.count("turn") == 0, F.lit(0).cast("long")),
        ).alias("gaps")
    )
    audits = chosen.groupBy("conv_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("block", "audit")))["audit"], "").alias("audit")
    )
    totals = values.groupBy("conv_id").agg(F.first("total").alias("cost"))
    out = sums
    for other in (numbers, audits, totals, digests):
        other = other.withColumnRenamed("conv_id", "c")
        out = out.join(other, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    return out.select(*_COLUMNS)


def _repair(
    turns: DataFrame, conversations: DataFrame | None, as_turns: bool, max_rows: int, max_bytes: int, block: int
) -> DataFrame:
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("letter", letter_of(F.col("role"), F.col("text")))
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text") + F.octet_length("role")).alias("size"))
    long_ = stored(sizes.where((F.col("n") > max_rows) | (F.col("size") > max_bytes)).select(F.col("conv_id").alias("c")), "long")
    several = long_.count()
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    short = rows
    if several:
        short = rows.join(sized_broadcast(long_, several), same, "left_anti")
    if conversations is not None:
        marks = conversations.select(F.col("conv_id").cast("long")).distinct()
        if several:
            marks = marks.join(sized_broadcast(long_, several), same, "left_anti")
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("letter", "string"))]
        short = short.unionByName(marks.select("conv_id", *nothing))
    out = _whole(short, as_turns)
    if several:
        out = out.unionByName(_cut(rows.join(sized_broadcast(long_, several), same, "left_semi"), as_turns, block))
    return out


def repair(
    turns: DataFrame, conversations: DataFrame | None = None, max_rows: int = ROWS, max_bytes: int = BYTES, block: int = BLOCK
) -> DataFrame:
    """One row per conversation: its faults, the cost of the cheapest repair, the audit and the repaired text's SHA-256.

    Reads conv_id, turn, role and text; other columns are ignored. A null role or text is one space. Turns are taken by
    turn, null before all; equal turns by role and text. Repeated rows are turns that stand next to each other. A role that is
    empty or begins otherwise than s, u or a is never kept. Rows without conv_id are one conversation; conversations
    of ``conversations`` without rows get zeros, an empty audit and the hash of the empty string. gaps that are no long
    are null. An empty table gives no rows. Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. A conversation of more than ``max_rows`` turns or ``max_bytes`` bytes is aligned in blocks of ``block``
    turns, with the same result. Only the hash takes the rows of a long conversation one after the other, as SHA-256 must.
    """
    return _repair(turns, conversations, False, max_rows, max_bytes, block)


def repaired_turns(turns: DataFrame, max_rows: int = ROWS, max_bytes: int = BYTES, block: int = BLOCK) -> DataFrame:
    """The turns of the repaired conversations: conv_id, place (from 0), role, text and edit (K, R or I).

    Everything else as for ``repair``; conversations whose turns are all deleted have no rows.
    """
    return _repair(turns, None, True, max_rows, max_bytes, block)


def damage(turns: DataFrame) -> DataFrame:
    """Turns with faults planted by the checksum of conversation and turn: conv_id, turn, role, text.

    A null conversation, turn, role or text is one space, but null ids and turns stay null in the result.
    """
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(name) % 20).alias("fault"),
    ).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")
