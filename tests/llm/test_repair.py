"""Conversation repair against a brute-force search over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from freightlens.llm import conversation_repair as repair
from tests.llm.cases import clashing

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def facts_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, faults):
    """All edit scripts with at most two insertions between rows, by dynamic programming over all suffixes kept whole."""
    grammar, names = re.compile(r"(s?(ua)+)?"), {"u": "user", "a": "assistant"}
    starts = {"": 0, "s": 1, "u": 2, "a": 3}
    legal = {(0, "s"), (0, "u"), (1, "u"), (2, "a"), (3, "u")}
    best = {}

    def go(k, state, inserted):
        if (k, state, inserted) in best:
            return best[k, state, inserted]
        options = []
        if inserted < 2:
            options += [(2 + c, "I" + e, [names[r] + ":", *lines]) for r in "ua" if (state, r) in legal for c, e, lines in go(k, starts[r], inserted + 1)]
        if k == len(rows):
            options += [(0, "", [])] if state in (0, 3) else []
        else:
            _, _, role, text = rows[k]
            options += [(3 + c, "D" + e, lines) for c, e, lines in go(k + 1, state, 0)]
            if faults[k] not in ("blank", "duplicate"):
                extra = faults[k] == "truncated"
                if (state, role[:1]) in legal:
                    options += [(extra + c, "K" + e, [f"{role}:{text}", *lines]) for c, e, lines in go(k + 1, starts[role[:1]], 0)]
                options += [(2 + extra + c, "R" + e, [f"{names[r]}:{text}", *lines]) for r in "ua" if (state, r) in legal for c, e, lines in go(k + 1, starts[r], 0)]
        best[k, state, inserted] = [min(options)] if options else []
        return best[k, state, inserted]

    cost, audit, lines = go(0, 0, 0)[0]
    assert grammar.fullmatch("".join(x[0] for x in lines))
    return cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def expected(rows):
    """By conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    out = {conv: (0, 0, 0, 0, 0, 0, "", EMPTY) for conv, *_ in rows}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())
    kept = after_damage(rows)
    for conv in {r[0] for r in kept}:
        own = sorted((r for r in kept if r[0] == conv), key=order)
        turns = {r[1] for r in own} - {None}
        faults = facts_of(own)
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, *cheapest(own, faults))
    return out


def found(frame):
    rows = frame.collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def conversations(seed, n):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "Ünder"])
            text = rng.choice(["Yes.", "No", "What? ", " ", "", None, "A line.\nAnd more!", "wörd", "ok?\t"])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, turn + 2, None]), role, text))
    return rows + rows[5:9] + [(n, None, "user", "Hi."), (n + 1, None, None, None), (n + 2, 10**6, "user", "x" * 200_000 + ".")]


def test_a_search_over_all_edits_agrees(spark):
    rows = conversations(1, 120)
    frame = clashing(spark.createDataFrame(rows, SCHEMA), "conv", "n", "block", "audit", "rows")
    got = found(repair.repair(repair.damaged(frame), frame))
    assert got == expected(rows)


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_a_conversation_of_many_blocks_and_ranges(spark, block):
    rows = [r for r in conversations(2, 12)]
    rng = random.Random(block)
    rows += [(50, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["One.", "two", f"Three {t}!", " "])) for t in range(90)]
    rows += [(51, 3, "user", "Same.")] * 40
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(repair.repair(repair.damaged(frame), frame, block=block)) == expected(rows)


def test_no_more_than_two_inserted_rows_are_needed():
    # A third insertion closes a cycle of the grammar, so a search with more finds nothing cheaper.
    facts = [("a", False, True), ("s", True, False), ("u", False, False), ("u", False, True), ("s", False, False)]
    few = repair.ended(repair.shortest(facts))[:2]
    before, repair.MOST_INSERTS = repair.MOST_INSERTS, 5
    for f in (repair.inserts, repair.arcs, repair.endings):
        f.cache_clear()
    try:
        assert repair.ended(repair.shortest(facts))[:2] == few
    finally:
        repair.MOST_INSERTS = before
        for f in (repair.inserts, repair.arcs, repair.endings):
            f.cache_clear()


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "Hello."), (2, 0, "user", "Hi!")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit(1).cast("long"))
    for block in (1, 100):
        got = {}
        for r in sorted(repair.repaired(frame, block=block).collect(), key=lambda r: (r["conv"], r["range"], r["block"])):
            got.setdefault(r.conv, []).extend(r.lines)
        assert got == {"=1": ["system:Be kind.", "user:", "assistant:Hello."], "=2": ["user:Hi!", "assistant:"]}


def test_nothing(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert found(repair.repair(repair.damaged(frame), frame)) == {}


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(repair.op13_conversation_repair(spark, path)) == expected(rows)
