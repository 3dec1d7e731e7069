"""Repair of the roles of a conversation at the least cost.

A legal conversation begins with a user, perhaps after one system turn; then assistant and user take turns. Each turn
as it stands may be kept, given another role, merged into the turn before it, or preceded by an empty turn of the
role that is missing. Dynamic programming over the states of this automaton finds the cheapest way.

The cost of a stretch of turns is a matrix over the states at its two ends, and matrices of neighbouring stretches
combine by (min, +). Conversations are therefore cut into blocks of rows: each block gives one matrix per
conversation, the few matrices of a long conversation give the state at every cut, and each block then finds its own
turns. No task holds more than a block of turns, however long a conversation is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import stored

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
#: States that may follow each state, and in which a conversation may end.
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
ENDS = (USER, ASSISTANT)
#: Costs: another role for a turn, a role for a turn of none or an unknown one, a merge, an empty turn.
RELABEL, ASSIGN, MERGE, EMPTY = 4.0, 2.0, 1.0, 3.0
#: Other names of the roles.
ALIASES = {
    "system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "prompter": USER,
    "assistant": ASSISTANT, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT,
}
#: Rows of a block.
BLOCK = 4096
_INF = float("inf")


def role_of(name: str | None) -> int:
    """The state of a role's name; START for none or an unknown one."""
    return ALIASES.get((name or "").strip().lower(), START)


def _moves(role: int) -> list[list[tuple[float, str, int] | None]]:
    """For each state before and after a turn of this role the cheapest cost, action and inserted role (or 0)."""
    found: list[list[tuple[float, str, int] | None]] = [[None] * 4 for _ in range(4)]

    def offer(a: int, b: int, cost: float, action: str, empty: int = 0) -> None:
        if found[a][b] is None or cost < found[a][b][0]:  # of equal costs the first offered stays
            found[a][b] = (cost, action, empty)

    for a in range(4):
        for b in (SYSTEM, USER, ASSISTANT):
            label = 0.0 if role == b else ASSIGN if role == START else RELABEL
            name = "keep" if role == b else "assign" if role == START else "relabel"
            if b in FOLLOWS[a]:
                offer(a, b, label, name)
            if a == b:
                offer(a, b, label + MERGE, "merge")
            for m in FOLLOWS[a]:
                if b in FOLLOWS[m]:
                    offer(a, b, label + EMPTY, f"insert+{name}", m)
    return found


MOVES = [_moves(role) for role in range(4)]
COSTS = np.array([[[m[0] if m else _INF for m in row] for row in moves] for moves in MOVES])
#: What it costs to end in each state: after a system turn an empty user turn is put.
END_COST = np.array([_INF if s == START else 0.0 if s in ENDS else EMPTY for s in range(4)])


def stretch_costs(roles: np.ndarray) -> np.ndarray:
    """The matrix of a stretch of turns."""
    total = np.where(np.eye(4, dtype=bool), 0.0, _INF)
    for role in roles:
        total = (total[:, :, None] + COSTS[role][None]).min(axis=1)
    return total


def best_states(roles: np.ndarray, first: int, last: int) -> list[int]:
    """The states after each turn on the cheapest way from ``first`` to ``last``; of equal ones the smaller state."""
    ahead = [np.full(4, _INF)]
    ahead[0][first] = 0.0
    for role in roles:
        ahead.append((ahead[-1][:, None] + COSTS[role]).min(axis=0))
    out, state = [], last
    for i in range(len(roles), 0, -1):
        out.append(state)
        state = int((ahead[i - 1] + COSTS[roles[i - 1]][:, state]).argmin())
    return out[::-1]


def cut_states(matrices: list[np.ndarray]) -> list[int]:
    """The state before the first stretch, at every cut, and after the last, on the cheapest way through all."""
    ahead = [np.array([0.0, _INF, _INF, _INF])]
    for m in matrices:
        ahead.append((ahead[-1][:, None] + m).min(axis=0))
    states = [int((ahead[-1] + END_COST).argmin())]
    for i in range(len(matrices), 0, -1):
        states.append(int((ahead[i - 1] + matrices[i - 1][:, states[-1]]).argmin()))
    return states[::-1]


def render(role: int, text: str | None, action: str, empty: int, ends_after: bool = False) -> str:
    """The text of one turn in the chat format; a merged turn goes on behind a blank line."""
    body = text or ""
    if action == "merge":
        out = f"\n\n{body}"
    else:
        out = f"<|{ROLES[empty]}|>\n" * bool(empty) + f"<|{ROLES[role]}|>\n{body}"
    return out + ("\n<|user|>\n" if ends_after else "")


REPAIRED = (
    "conv_id long, turn long, place long, role string, action string, inserted string, cost double, rendered string"
)


def repair(turns: DataFrame) -> DataFrame:
    """Each turn of ``turns`` with its repaired role and its part of the rendered conversation.

    Reads conv_id, turn, role and text; other columns are ignored. Turns are taken in the order of turn (null before
    all), then role and text, so repeated rows stand next to each other and are merged or told apart like any turns. A
    null or unknown role is assigned one; a null text is empty; rows without conv_id are one conversation. A
    conversation of system turns alone gets an empty user turn behind it. An empty table gives no rows. Returns
    conv_id, turn, place (rises within a conversation), role, action (keep, assign, relabel, merge, or insert+ one of
    these), inserted (the role of the empty turn before, or null), cost and rendered; joined in the order of place,
    with a line end between turns that are not merged, the parts of rendered are the conversation.
    """
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a conversation of any length is spread over ranges of its turns
    spread = rows.repartitionByRange(parts, "conv_id", "turn", F.xxhash64("role", "text")).sortWithinPartitions(
        "conv_id", "turn", F.xxhash64("role", "text"), "role", "text"
    )
    numbered = spread.withColumn("place", F.monotonically_increasing_id())
    numbered = stored(numbered.withColumn("block", F.expr(f"place div {BLOCK}")), "turns")

    def summarise(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place")
        codes = block["role"].map(role_of).to_numpy(np.int64)
        found = []
        for name, at in block.groupby(block["conv_id"].astype("Int64"), dropna=False, sort=False).indices.items():
            found.append((None if pd.isna(name) else int(name), int(block["block"].iloc[0]), stretch_costs(codes[at]).ravel().tolist()))
        return pd.DataFrame(found, columns=["conv_id", "block", "costs"]).astype({"conv_id": "Int64"})

    stretches = stored(
        numbered.groupBy("block").applyInPandas(lambda b: summarise(b), "conv_id long, block long, costs array<double>"),
        "stretches",
    )

    def connect(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values("block")
        states = cut_states([np.array(c).reshape(4, 4) for c in pieces["costs"]])
        last = np.arange(len(pieces)) == len(pieces) - 1
        return pd.DataFrame(
            {"conv_id": pieces["conv_id"], "block": pieces["block"], "first": states[:-1], "last": states[1:], "ending": last}
        ).astype({"conv_id": "Int64"})

    cuts = "conv_id long, block long, first int, last int, ending boolean"
    # conversations within one block need no grouping by conversation; of the others there is a row per block
    several = stretches.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    sized = stretches.join(several.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    single = sized.where("n = 1").select("conv_id", "block", "costs")

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = [cut_states([np.array(c).reshape(4, 4)]) for c in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [
                    batch.column(0), batch.column(1), pa.array([s[0] for s in states], pa.int32()),
                    pa.array([s[1] for s in states], pa.int32()), pa.array([True] * len(states)),
                ],
                names=["conv_id", "block", "first", "last", "ending"],
            )

    long_ = sized.where("n > 1").drop("n").groupBy("conv_id").applyInPandas(lambda p: connect(p), cuts)
    ends = stored(single.mapInArrow(alone, cuts).unionByName(long_), "cuts")

    def finish(key: tuple, block: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place")
        names = block["conv_id"].astype("Int64")
        edge = {None if pd.isna(c) else int(c): (f, t, e) for c, f, t, e in zip(edges["conv_id"].astype("Int64"), edges["first"], edges["last"], edges["ending"])}
        codes = block["role"].map(role_of).to_numpy(np.int64)
        texts = [None if t is None or t != t else t for t in block["text"]]
        out = {k: [None] * len(block) for k in ("role", "action", "inserted", "cost", "rendered")}
        for name, at in names.groupby(names, dropna=False, sort=False).indices.items():
            first, last, ending = edge[None if pd.isna(name) else int(name)]
            before = first
            for i, state in zip(at, best_states(codes[at], first, last)):
                cost, action, empty = MOVES[codes[i]][before][state]
                closes = bool(ending) and i == at[-1] and state not in ENDS
                out["role"][i], out["action"][i], out["inserted"][i] = ROLES[state], action, ROLES[empty] or None
                out["cost"][i] = cost + END_COST[state] * closes
                out["rendered"][i] = render(state, texts[i], action, empty, closes)
                before = state
        return pd.DataFrame({"conv_id": names, "turn": block["turn"].astype("Int64"), "place": block["place"], **out})

    return numbered.groupBy("block").cogroup(ends.groupBy("block")).applyInPandas(lambda k, b, e: finish(k, b, e), REPAIRED)


def conversations(repaired: DataFrame) -> DataFrame:
    """conv_id, text and cost: the rendered conversations, for those that fit into one row."""
    joint = F.concat(F.when(F.col("action") == "merge", "").otherwise("\n"), F.col("rendered"))
    pieces = F.array_sort(F.collect_list(F.struct("place", joint.alias("part"), "cost")))
    grouped = repaired.groupBy("conv_id").agg(pieces.alias("p"))
    return grouped.select(
        "conv_id", F.substring(F.array_join(F.col("p")["part"], ""), 2, 2**31 - 1).alias("text"),
        F.aggregate(F.col("p")["cost"], F.lit(0.0), lambda a, x: a + x).alias("cost"),
    )
