"""Repairs against all edit sequences, against a walk over states, and whole tables against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest

from agrispark.llm import conversations as C

GOOD = re.compile(r"(s?(ua)+)?\Z")


def brute(turns, most=3):
    """Cost and audit by trying every sequence of edits; turns: (role initial, fault)."""
    slots = [x for n in range(most + 1) for x in product("ua", repeat=n)]
    found = None
    choices = []
    for role, wrong in turns:
        extra = 3 if wrong == "truncated" else 0
        own = [(4, "D", "")]
        if wrong not in ("blank", "duplicate"):
            own += [(extra, "K", role), (3 + extra, "R", "u"), (3 + extra, "R", "a")]
        choices.append(own)
    for edits in product(*choices):
        for gaps in product(slots, repeat=len(turns) + 1):
            roles, audit, cost = "", "", 0
            for k, gap in enumerate(gaps):
                roles, audit, cost = roles + "".join(gap), audit + "I" * len(gap), cost + 3 * len(gap)
                if k < len(edits):
                    roles, audit, cost = roles + edits[k][2], audit + edits[k][1], cost + edits[k][0]
            if GOOD.match(roles) and (found is None or (cost, audit) < found):
                found = (cost, audit)
    return found


def walked(turns):
    """The same by a walk over the states of the pattern, turn by turn."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def insertions(at):
        for _ in range(4):
            for (f, r), to in step.items():
                if r != "s" and f in at:
                    new = (at[f][0] + 3, at[f][1] + "I")
                    at[to] = min(at.get(to, new), new)
        return at

    at = insertions({"": (0, "")})
    for role, wrong in turns:
        extra, after = 3 if wrong == "truncated" else 0, {}
        for state, (cost, audit) in at.items():
            moves = [(state, 4, "D")]
            if wrong not in ("blank", "duplicate"):
                moves += [(step.get((state, role)), extra, "K")] + [(step.get((state, r)), 3 + extra, "R") for r in "ua"]
            for to, price, edit in moves:
                if to is not None:
                    new = (cost + price, audit + edit)
                    after[to] = min(after.get(to, new), new)
        at = insertions(after)
    return min(at[s] for s in ("", "a") if s in at)


FAULTS = ["", "", "", "blank", "duplicate", "truncated"]


def parsed(turns):
    return C.best(C.over([C.leaf(r, w) for r, w in turns]))


def test_every_edit_sequence_of_short_conversations():
    rng = random.Random(5)
    for n in (0, 1, 2):
        for _ in range(40):
            turns = [(rng.choice("suat"), rng.choice(FAULTS)) for _ in range(n)]
            assert parsed(turns) == brute(turns), turns


def test_long_conversations_by_states():
    rng = random.Random(6)
    for n in (3, 4, 7, 50, 301):
        for _ in range(60):
            turns = [(rng.choice("suaut"), rng.choice(FAULTS)) for _ in range(n)]
            assert parsed(turns) == walked(turns)


def plain(rows):
    """The contract's columns of (conv_id, turn, role, text) in plain Python."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = by[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, turns, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in own:
            core = re.sub(r"[\x20\x09-\x0D]", "", text)
            wrong = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            turns.append((role[:1], wrong))
            if wrong:
                counts[wrong] += 1
        given = [t for t, _, _ in own if t is not None]
        gaps = max(given) - min(given) + 1 - len(set(given)) if given else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = walked(turns)
        left, at, n = iter(own), 0, len(audit) - audit.count("D")
        lines = []
        for e in audit:
            role, text = ("", "") if e == "I" else next(left)[1:]
            if e != "D":
                lines.append(f"{role if e == 'K' else 'user' if at % 2 == n % 2 else 'assistant'}:{text}")
                at += 1
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def same(df, rows):
    got = df.collect()
    assert len(got) == len({r["conv_id"] for r in got})
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got} == plain(rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in docs.select("conv_id", "turn", "role", "text").collect()]
    same(C.op12_conversation_repair(spark, "/root/testdata/sf0.01"), rows)


def odd_rows():
    rng = random.Random(7)
    rows = [(None, None, None, None), (None, 1, "user", "A."), (3, None, "user", "x"), (3, None, "user", "x"), (4, 2**62, "", "Q?"), (4, -(2**62), "tool", "\t"), (5, 1, "s", "é!" * 40_000)]
    rows += [(9, rng.choice([None, *range(400)]), rng.choice(["system", "user", "assistant", None, "x"]), rng.choice(["Yes.", "No", "Why?", "", None, f"{rng.random()}!"])) for _ in range(1500)]
    return rows + [(c, t, rng.choice(["user", "assistant"]), f"T{t}.") for c in range(10, 60) for t in range(rng.randint(1, 9))]


@pytest.mark.parametrize("held", [C.HELD, 20])
def test_nulls_ties_repeats_hot_conversation(spark, monkeypatch, held):
    monkeypatch.setattr(C, "HELD", held)
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, h string, n int").repartition(7)
    same(C.with_digests(C.Repair(C.damaged(df))), rows)


def test_repaired_turns(spark):
    df = spark.createDataFrame([("a", 0, "user", "Hi."), ("a", 1, "user", "Hi."), ("a", 2, "user", "Yes?"), ("b", 0, "assistant", "Hm.")], "conv_id string, turn int, role string, text string")
    repair = C.repaired(df)
    turns = sorted(tuple(r) for r in repair.turns().collect())
    assert turns == [("a", 0, "K", "user", "Hi."), ("a", 1, "R", "assistant", "Yes?"), ("b", 0, "I", "user", ""), ("b", 1, "K", "assistant", "Hm.")]
    report = {r["conv_id"]: r for r in repair.report().collect()}
    assert report["b"]["audit"] == "IK" and report["b"]["cost"] == 3
    assert report["a"]["audit"] == "KDR" and report["a"]["cost"] == 7 and report["a"]["duplicate"] == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.with_digests(C.Repair(C.damaged(df))).count() == 0
