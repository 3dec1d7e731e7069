"""Alignment of turns with the grammar, against an exhaustive search that knows nothing of tables and bands."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from graphloom.llm import turn_alignment
from graphloom.llm.queries import QUERIES


def cheapest(letters):
    """The least (cost, audit) over all edits, by recursion over the turn and the last initial put."""

    @functools.lru_cache(None)
    def best(i, last, inserted):
        found = []
        expected = "a" if last == "u" else "u"
        if i == len(letters) and last in ("", "a"):
            found.append((0, ""))
        if inserted < 3:
            rest = best(i, expected, inserted + 1)
            found += [(rest[0] + 3, "I" + rest[1])] if rest else []
        if i < len(letters):
            letter = letters[i]
            rest = best(i + 1, last, 0)
            found += [(rest[0] + 4, "D" + rest[1])] if rest else []
            if letter != "D":
                ways = [(0, "K", expected)] if letter.lower() == expected else [(3, "R", expected)]
                ways += [(0, "K", "s")] if last == "" and letter.lower() == "s" else []
                for cost, edit, put in ways:
                    rest = best(i + 1, put, 0)
                    found += [(rest[0] + cost + 3 * letter.isupper(), edit + rest[1])] if rest else []
        return min(found, default=None)

    return best(0, "", 0)


def report_by_hand(rows, damaged=True):
    """The contract over (conv_id, turn, role, text), written out."""
    answers, out = {}, {}
    for conv, turn, role, text in rows:
        answers.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20 if damaged else 9
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        answers[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    for conv, turns in answers.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, letters, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, role, text in turns:
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            ends = re.findall(r"[^\x20\x09-\x0D]", text)
            if not ends:
                counts["blank"] += 1
                letter = "D"
            elif (role, text) in seen:
                counts["duplicate"] += 1
                letter = "D"
            elif ends[-1] not in ".!?":
                counts["truncated"] += 1
                letter = letter.upper()
            seen.add((role, text))
            letters.append(letter)
        pairs = [(a[1][:1], b[1][:1]) for a, b in zip(turns, turns[1:])]
        known = [t[0] for t in turns if t[0] is not None]
        cost, audit = cheapest("".join(letters))
        m = sum(e != "D" for e in audit)
        target = ["system"] * (m % 2) + ["user", "assistant"] * (m // 2)
        parts, at, place = [], iter(turns), 0
        for edit in audit:
            turn = None if edit == "I" else next(at)
            if edit != "D":
                role = turn[1] if edit == "K" else target[place]
                parts.append(f"{role}:{turn[2] if turn else ''}")
                place += 1
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0, counts["blank"], counts["duplicate"], counts["truncated"],
            sum("".join(p) not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(parts).encode()).hexdigest(),
        )
    return out


def found(df):
    return {r.conv_id: tuple(r[1:]) for r in df.select(*turn_alignment._COLUMNS).collect()}


def test_alignment_is_the_cheapest_and_least():
    rng = random.Random(5)
    for _ in range(1500):
        letters = "".join(rng.choice("suaxSUAXDuaua") for _ in range(rng.randint(0, 9)))
        assert turn_alignment.align(letters)[:2] == cheapest(letters), letters


@pytest.mark.parametrize("n", [60, 200])
def test_long_alignment(n):
    rng = random.Random(n)
    letters = "s" + "".join(rng.choice("uaxUAD") if rng.random() < 0.25 else "ua"[i % 2] for i in range(n))
    assert turn_alignment.align(letters)[:2] == cheapest(letters)


def test_query_against_the_contract(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op13_turn_alignment"](spark, folder)
    assert found(df) == report_by_hand(rows) and df.count() == len({r[0] for r in rows})


def _odd_turns(rng, conversations=60, turns=14):
    texts = ["Hello.", "Yes!", "why", "", " \t\n", "No. ", "Hello", None, "\x0b", "日本。", "日本?", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "unknown"]
    return [
        (rng.choice([None, *range(conversations)]), rng.choice([None, *range(9)]), rng.choice(roles[:3] * 4 + roles), rng.choice(texts))
        for _ in range(conversations * turns)
    ]


def _frame(spark, rows):
    schema = "conv_id long, turn long, role string, text string, letter int, place int, block int, c int, n int"
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], schema)


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = _odd_turns(random.Random(1))
    rows += rows[:40]
    df = _frame(spark, rows)
    got = found(turn_alignment.repair(turn_alignment.damage(df), df.select("conv_id")))
    assert got == report_by_hand(rows)


def test_blocks_give_what_whole_conversations_give(spark):
    rows = _odd_turns(random.Random(2), 4, 60)
    df = _frame(spark, rows)
    expected = report_by_hand(rows, damaged=False)
    assert found(turn_alignment.repair(df, df.select("conv_id"), max_rows=20, block=8)) == expected
    whole = {tuple(r) for r in turn_alignment.repaired_turns(df).collect()}
    cut = {tuple(r) for r in turn_alignment.repaired_turns(df, max_rows=20, block=8).collect()}
    assert whole == cut
    for conv, e in expected.items():
        text = "\n".join(f"{r[2]}:{r[3]}" for r in sorted((r for r in whole if r[0] == conv), key=lambda r: r[1]))
        assert hashlib.sha256(text.encode()).hexdigest() == e[-1]


def test_all_dropped_and_empty(spark):
    dropped = next(i for i in range(10_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = _frame(spark, [(dropped, 0, "user", "Hi.")])
    got = found(turn_alignment.repair(turn_alignment.damage(df), df.select("conv_id")))
    assert got == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    empty = _frame(spark, [])
    assert found(turn_alignment.repair(turn_alignment.damage(empty), empty.select("conv_id"))) == {}
