"""Repair of conversations by weighted finite-state composition.

Three machines are composed lazily: an acceptor of a conversation's rows (what of each row matters: its role's initial,
whether it must go, whether it is truncated), a transducer of edits (Keep, Rerole, Delete a row; Insert one, at most two
in a row, as three would hold a cycle of the grammar), and an acceptor of role initials `(s?(ua)+)?`. Weights are pairs
(cost, labels), added up along a path and compared by cost, then by the text of labels; the shortest path is found in
the order of rows. Of two paths to a state one label text is never the beginning of the other unless costs differ, as
both end with a row's label, so the smaller beginning stays the smaller.

Rows are sorted by conversation and turn over ranges, not gathered by conversation: a range's rows stream through a task,
and a conversation that lies in one range and one block of `block` rows is solved there. Of others each block becomes a
small machine of its own: for each state that it may begin in and end in the least weight. The blocks' costs and the
order of their labels (some bytes a block) meet by conversation, where the path through the blocks is chosen; blocks then
give their labels and repaired rows. Only the hash of a conversation's text goes through one task, row by row, as a hash
is made in order. Rows that are equal in all that counts are one row with a number until they are edited.

Nulls: a null role or text is one space; a null id is a conversation, null turns come first. Rows of one turn (ties) are
ordered by role and text. Empty texts are blank. A very long text is one row. An empty table has no conversations; one
without rows after damage has zeros, no labels and the hash of the empty text. Extra columns don't matter.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CHARS, tidy, written

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Costs of the edits, and of a truncated row that stays.
COST, TRUNCATED = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}, 1
MOST_INSERTS = 2

#: The grammar's states, by the initial last read, and its arcs; it ends in START and A.
START, S, U, A = range(4)
GRAMMAR = {START: {"s": S, "u": U}, S: {"u": U}, U: {"a": A}, A: {"u": U}}
FINAL = (START, A)
NAMES = {"u": "user", "a": "assistant"}

#: Rows and characters of a block.
BLOCK, BLOCK_CHARS = 2048, 4 << 20


@cache
def inserts(state: int) -> list[tuple[str, int]]:
    """(roles' initials, state after) of no, one and more inserted rows."""
    out = [("", state)]
    for _ in range(MOST_INSERTS):
        roles, at = out[-1]
        role = next(r for r in GRAMMAR[at] if r in NAMES)
        out.append((roles + role, GRAMMAR[at][role]))
    return out


@cache
def arcs(state: int, initial: str, must_go: bool, truncated: bool) -> list[tuple[int, str, int, str]]:
    """(cost, labels, state after, roles: inserted ones, then the row's or "-") of a row, with what is inserted before it."""
    out = []
    for roles, at in inserts(state):
        before, cost = INSERT * len(roles), COST[INSERT] * len(roles)
        out.append((cost + COST[DELETE], before + DELETE, at, roles + "-"))
        if must_go:
            continue
        cost += TRUNCATED * truncated
        for role, after in GRAMMAR[at].items():
            if role == initial:
                out.append((cost + COST[KEEP], before + KEEP, after, roles + "="))
            if role in NAMES:
                out.append((cost + COST[REROLE], before + REROLE, after, roles + role))
    return out


@cache
def endings(state: int) -> list[tuple[int, str, str]]:
    """(cost, labels, roles) of what is inserted after the last row."""
    return [(COST[INSERT] * len(roles), INSERT * len(roles), roles) for roles, at in inserts(state) if at in FINAL]


def shortest(rows: Iterable[tuple[str, bool, bool]], begin: int = START) -> dict[int, tuple[int, str, tuple]]:
    """For each state that rows can end in: least cost, labels, and the path (a linked list of roles by row, the last first)."""
    found: dict[int, tuple[int, str, tuple]] = {begin: (0, "", ())}
    for row in rows:
        after: dict[int, tuple[int, str, tuple]] = {}
        for state, (cost, labels, path) in found.items():
            for more, own, to, roles in arcs(state, *row):
                best = after.get(to)
                if best is None or (cost + more, labels + own) < best[:2]:
                    after[to] = (cost + more, labels + own, (roles, path))
        found = after
    return found


def unwound(path: tuple) -> list[str]:
    out = []
    while path:
        roles, path = path
        out.append(roles)
    return out[::-1]


def edited(rows: Iterable[tuple[str, str]], path: list[str]) -> Iterator[str]:
    """The repaired rows as `role:text`."""
    for (role, text), step in zip(rows, path, strict=True):
        for r in step[:-1]:
            yield NAMES[r] + ":"
        if step[-1] != "-":
            yield f"{role if step[-1] == '=' else NAMES[step[-1]]}:{text}"


# Rows and what of them matters.


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, n) after damage, by crc32(`conv_id:turn`) % 20; n: how often in a row."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20
    rows = conversations.select("conv_id", "turn", or_space("role").alias("role"), or_space("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"))


def judged(rows: DataFrame) -> DataFrame:
    """Different rows with n, and what is wrong with them: blank, truncated, and whether their first is a duplicate of an earlier turn's."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    bare = F.rtrim(F.col("text"), F.lit(SPACE_CHARS))
    rows = rows.withColumn("blank", bare == "").withColumn("truncated", (bare != "") & ~F.right(bare, F.lit(1)).isin(".", "!", "?"))
    # A text is known by its hash (256 bits), so that texts move once.
    rows = rows.withColumn("said", F.sha2(F.concat(F.hex("role"), F.lit(":"), F.hex("text")), 256))
    turn = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    again = rows.groupBy("conv_id", "said").agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1").select(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("said") == F.col("_said"))
    seen = F.coalesce(F.col("first") != turn, F.lit(False))
    return rows.join(again, same, "left").select("conv_id", "turn", "role", "text", "n", "blank", "truncated", seen.alias("seen"))


def counted(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated) by sums of the judged rows."""
    sums = lambda c: F.coalesce(F.sum(c), F.lit(0))
    doubles = F.when(F.col("seen"), F.col("n")).otherwise(F.col("n") - 1)
    turns = rows.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"), F.sum(F.when(~F.col("blank"), doubles).otherwise(0)).alias("duplicate"), F.sum(F.when(F.col("truncated") & ~F.col("seen"), 1).otherwise(0)).alias("truncated")
    )
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), *(sums(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")))


@dataclass
class Piece:
    """Rows of a conversation that follow one another."""

    rows: list[tuple[str, str]] = field(default_factory=list)
    facts: list[tuple[str, bool, bool]] = field(default_factory=list)

    @property
    def illegal(self) -> int:
        pairs = itertools.pairwise(f[0] for f in self.facts)
        return sum((one, two) not in LEGAL for one, two in pairs)


LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_MOVED = "conv string, whole boolean, range int, block int, illegal long, cost long, audit string, hash string, machine string, rows string"
_FIELDS = pa.schema([("conv", pa.string()), ("whole", pa.bool_()), ("range", pa.int32()), ("block", pa.int32()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("hash", pa.string()), ("machine", pa.string()), ("rows", pa.string())])


def ended(found: dict[int, tuple[int, str, tuple]]) -> tuple[int, str, tuple, str]:
    """The best whole path: cost, labels, roles by row, and roles after the last row."""
    whole = ((cost + more, labels + own, path, roles) for state, (cost, labels, path) in found.items() for more, own, roles in endings(state))
    return min(whole, key=lambda x: x[:2])


def solved(piece: Piece) -> tuple[dict, list[str]]:
    """A whole conversation's results and repaired rows."""
    cost, audit, path, after = ended(shortest(piece.facts))
    lines = [*edited(piece.rows, unwound(path)), *(NAMES[r] + ":" for r in after)]
    return {"illegal": piece.illegal, "cost": cost, "audit": audit, "hash": hashlib.sha256("\n".join(lines).encode()).hexdigest()}, lines


def machine_of(piece: Piece) -> str:
    """A block as a machine: for each state to begin in (state, cost) by the order of labels, and the first and last initial."""
    table = {}
    for begin in GRAMMAR:
        found = shortest(piece.facts, begin)
        table[begin] = [(to, found[to][0]) for to in sorted(found, key=lambda s: found[s][1])]
    return json.dumps({"table": table, "ends": [piece.facts[0][0], piece.facts[-1][0]]})


def in_order(rows: DataFrame, block: int = BLOCK, block_chars: int = BLOCK_CHARS, lines: bool = False) -> DataFrame:
    """Solved conversations (whole), and the blocks of those that go over several ranges or blocks. lines: keep the former's repaired rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, first, held, blocks, at, size, done, due = TaskContext.get().partitionId(), True, None, 0, Piece(), 0, [], 0

        def closed(goes_on: bool) -> dict:
            # The first and the last conversation of a range may go on in others.
            if blocks or goes_on or first:
                return {"conv": held, "whole": False, "range": number, "block": blocks, "illegal": at.illegal, "machine": machine_of(at), "rows": json.dumps([at.rows, at.facts])}
            found, repaired = solved(at)
            return {"conv": held, "whole": True, "rows": json.dumps(repaired) if lines else None, **found}

        for batch in batches:
            for conv, role, text, n, blank, seen, cut in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for k in range(n):
                    new = conv != held
                    if at.rows and (new or len(at.rows) >= block or size >= block_chars):
                        done.append(closed(not new))
                        due, at, size = due + size, Piece(), 0
                        first, blocks = first and not new, 0 if new else blocks + 1
                    held = conv
                    at.rows.append((role, text))
                    at.facts.append((role[:1], blank or seen or k > 0, cut))
                    size += len(text)
                    if len(done) >= 256 or due >= block_chars:
                        yield pa.RecordBatch.from_pylist(done, _FIELDS)
                        done, due = [], 0
        if at.rows:
            done.append(closed(True))
        if done:
            yield pa.RecordBatch.from_pylist(done, _FIELDS)

    keys = ["conv_id", "turn", "role", "text"]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return placed.select(conv_key(F.col("conv_id")).alias("conv"), "role", "text", "n", "blank", "seen", "truncated").mapInArrow(tidy(run), _MOVED)


def conv_key(c: Column) -> Column:
    """An id as text, null apart from all texts."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def through(blocks: DataFrame) -> DataFrame:
    """(conv, range, block, begin, to, after, illegal, cost) of each block: the path's states, what is inserted at the end, and the conversation's totals in its first block."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["range"], r["block"]))
        machines = [json.loads(r["machine"]) for r in rows]
        # From the end: the least cost from each state on, and where each block's path goes then.
        least, after = {}, {}
        for state in GRAMMAR:
            cost, _, roles = min(endings(state), default=(None, "", ""))
            if cost is not None:
                least[state], after[state] = cost, roles
        chosen = []
        for m in reversed(machines):
            # Lists are in the order of labels, so of equal costs the first is the smaller.
            to = {int(s): min(found, key=lambda x: x[1] + least[x[0]]) for s, found in m["table"].items()}
            chosen.append(to)
            least = {s: cost + least[t] for s, (t, cost) in to.items()}
        state, total, out = START, least[START], []
        between = sum((a["ends"][1], b["ends"][0]) not in LEGAL for a, b in itertools.pairwise(machines))
        for k, (r, to) in enumerate(zip(rows, reversed(chosen), strict=True)):
            begin, state = state, to[state][0]
            last = k == len(rows) - 1
            out.append({"conv": r["conv"], "range": r["range"], "block": r["block"], "begin": begin, "to": state, "after": after[state] if last else "", "illegal": r["illegal"] + (between if not k else 0), "cost": total if not k else 0})
        return pa.Table.from_pylist(out, pa.schema([("conv", pa.string()), ("range", pa.int32()), ("block", pa.int32()), ("begin", pa.int32()), ("to", pa.int32()), ("after", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64())]))

    return blocks.select("conv", "range", "block", "illegal", "machine").groupBy("conv").applyInArrow(run, "conv string, range int, block int, begin int, to int, after string, illegal long, cost long")


def told(blocks: DataFrame) -> DataFrame:
    """Blocks (with begin, to, after) with their labels and repaired rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows, facts = json.loads(r.pop("rows"))
                _, labels, path = shortest(map(tuple, facts), r.pop("begin"))[r.pop("to")]
                after = r.pop("after")
                lines = [*edited(rows, unwound(path)), *(NAMES[x] + ":" for x in after)]
                yield pa.RecordBatch.from_pylist([r | {"labels": labels + INSERT * len(after), "lines": lines}], pa.schema([*(batch.schema.field(c) for c in ("conv", "range", "block", "illegal", "cost")), ("labels", pa.string()), ("lines", pa.list_(pa.string()))]))

    return blocks.select("conv", "range", "block", "illegal", "cost", "rows", "begin", "to", "after").mapInArrow(run, "conv string, range int, block int, illegal long, cost long, labels string, lines array<string>")


def hashed(parts: DataFrame) -> DataFrame:
    """(conv, illegal, cost, audit, hash): the blocks of a conversation stream through a task in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, total, labels, begun = None, None, None, [], False

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"conv": conv, **total, "audit": "".join(labels), "hash": state.hexdigest()}], pa.schema([("conv", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("hash", pa.string())]))

        for batch in batches:
            for r in batch.to_pylist():
                if r["conv"] != conv:
                    if state:
                        yield row()
                    conv, state, total, labels, begun = r["conv"], hashlib.sha256(), {"illegal": 0, "cost": 0}, [], False
                for line in r["lines"]:
                    state.update(("\n" * begun + line).encode())
                    begun = True
                labels.append(r["labels"])
                total = {k: v + r[k] for k, v in total.items()}
        if state:
            yield row()

    placed = parts.repartition("conv").sortWithinPartitions("conv", "range", "block")
    return placed.select("conv", "illegal", "cost", "labels", "lines").mapInArrow(run, "conv string, illegal long, cost long, audit string, hash string")


def repair(rows: DataFrame, ids: DataFrame, **blocks: int) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each of ids (conv_id), from rows (conv_id, turn, role, text, n)."""
    facts = written(judged(rows))
    found = written(in_order(facts, **blocks))
    solutions = found.where("whole").select("conv", "illegal", "cost", "audit", "hash").unionByName(hashed(parts_of(found)))
    out = ids.select("conv_id").distinct().withColumn("conv", conv_key(F.col("conv_id")))
    out = out.join(counted(facts).withColumn("conv", conv_key(F.col("conv_id"))).drop("conv_id"), "conv", "left").join(solutions, "conv", "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("hash", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def parts_of(found: DataFrame) -> DataFrame:
    """The repaired blocks of conversations of several blocks."""
    blocks = found.where("NOT whole")
    path = written(through(blocks))
    return told(blocks.drop("illegal", "cost").join(path, ["conv", "range", "block"]))


def repaired(rows: DataFrame, **blocks: int) -> DataFrame:
    """(conv, range, block, lines array): the repaired rows, `role:text`, of each conversation with rows, in the order of range and block. conv: "=" and the id, or empty."""
    found = written(in_order(written(judged(rows)), lines=True, **blocks))
    whole = found.where("whole").select("conv", F.lit(0).alias("range"), F.lit(0).alias("block"), F.from_json("rows", "array<string>").alias("lines"))
    return whole.unionByName(parts_of(found).select("conv", "range", "block", "lines"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(damaged(conversations), conversations)


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
#: The same in DuckDB's SQL: states 0 to 3 are nothing, s, u and a; a recursion over the rows keeps the least (cost, labels, text) of each state.
OP13_SQL = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
k AS (SELECT o.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: CAST(unicode(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM o, crc),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS twin FROM k WHERE kind <> 0),
r AS (SELECT *, row_number() OVER w AS pos, lag(left(role, 1)) OVER w || left(role, 1) AS pair, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, twin) > 1 AS again, rtrim(text, {_SPACES}) AS bare FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, twin)),
f AS (SELECT *, bare = '' AS blank, bare <> '' AND again AS dup, bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS cut FROM r),
facts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS dup, count(*) FILTER (cut) AS cut, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
ins(state, cost, letters, lines, mid) AS (VALUES (0, 0, '', '', 0), (0, 2, 'I', 'user:' || chr(10), 2), (0, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 3), (1, 0, '', '', 1), (1, 2, 'I', 'user:' || chr(10), 2), (1, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 3),
  (2, 0, '', '', 2), (2, 2, 'I', 'assistant:' || chr(10), 3), (2, 4, 'II', 'assistant:' || chr(10) || 'user:' || chr(10), 2), (3, 0, '', '', 3), (3, 2, 'I', 'user:' || chr(10), 2), (3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 3)),
act(mid, letter, cost, role, next) AS (VALUES (0, 'K', 0, 's', 1), (0, 'K', 0, 'u', 2), (1, 'K', 0, 'u', 2), (2, 'K', 0, 'a', 3), (3, 'K', 0, 'u', 2), (0, 'R', 2, 'user', 2), (1, 'R', 2, 'user', 2), (2, 'R', 2, 'assistant', 3), (3, 'R', 2, 'user', 2), (0, 'D', 3, '', 0), (1, 'D', 3, '', 1), (2, 'D', 3, '', 2), (3, 'D', 3, '', 3)),
p AS (SELECT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS state, {{c: CAST(0 AS BIGINT), a: '', x: ''}} AS best FROM facts
  UNION ALL SELECT conv_id, pos, next, min(best) FROM (
    SELECT f.conv_id, f.pos, act.next, {{c: CAST(p.best.c + ins.cost + act.cost + CASE WHEN f.cut AND letter <> 'D' THEN 1 ELSE 0 END AS BIGINT), a: p.best.a || ins.letters || letter, x: p.best.x || ins.lines || CASE letter WHEN 'D' THEN '' WHEN 'K' THEN f.role || ':' || f.text || chr(10) ELSE act.role || ':' || f.text || chr(10) END}} AS best
    FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.pos = p.pos + 1 JOIN ins ON ins.state = p.state JOIN act ON act.mid = ins.mid AND (letter = 'D' OR (NOT f.blank AND NOT f.dup AND (letter = 'R' OR act.role = left(f.role, 1))))) GROUP BY conv_id, pos, next),
ends(state, cost, letters, lines) AS (VALUES (0, 0, '', ''), (1, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (2, 2, 'I', 'assistant:' || chr(10)), (3, 0, '', '')),
e AS (SELECT p.conv_id, min({{c: p.best.c + ends.cost, a: p.best.a || ends.letters, x: p.best.x || ends.lines}}) AS best FROM p JOIN facts ON facts.conv_id IS NOT DISTINCT FROM p.conv_id AND p.pos = facts.n JOIN ends ON ends.state = p.state GROUP BY p.conv_id)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(dup, 0) AS duplicate, coalesce(cut, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(left(best.x, length(best.x) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS i LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM i.conv_id
"""
