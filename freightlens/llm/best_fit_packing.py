"""Packing of documents into sequences by a grouping genetic algorithm on islands with elite migration.

Texts become token ids, an end id after each; longer ones than a sequence are cut, the first piece taking what is left
over. Pieces of one length are interchangeable, so what has to be packed is a histogram of at most `capacity` lengths,
whatever the number of documents. It is packed in levels: with `copies` the number of pieces over `slots`, a level's
instance has (count of the length // copies) slots of each length, some thousands in all, and its solution holds
`copies` times. Remainders, and what lay in the instance's worst filled sequences, go to the next level, whose copies are
fewer; the last one has one copy. All pieces are packed, none is left out or sampled.

An instance is solved by islands, each a row with a population that a task evolves. Chromosomes are lists of groups
(sequences). Crossover injects whole well-filled groups of one parent into the other, removes the groups that hold a slot
twice by that, and puts the displaced slots back by best fit; a mutation dissolves the emptiest groups. After each epoch
an island's best chromosome migrates to the next island. Evolution ends early when a solution has as few sequences as the
sum of lengths allows.

Then every piece takes the slot of its rank among the pieces of its length: its number within its task plus the counts of
the tasks before, so no length's rows meet in one task, and slots and levels (bounded by the parameters) are broadcast.

Null and empty texts are their end id alone. A text of any length is encoded in parts, cut where the tokenizer cuts too.
Pieces of equal length (ties) take slots in the order of their tasks and rows; repeated rows are documents of their own,
and an id may be null or of any type. An empty table has no pieces. Extra columns don't matter, whatever their names.
"""

from __future__ import annotations

import os
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stretches, tidy, written

CAPACITY, END_ID = 1024, 2
#: An instance has so many slots, up to twice as many in the last level, and what was held back.
SLOTS = 8192
#: Sequences of a level with copies are held back for the next level when less than this part of them is full, at most HELD slots.
WELL_FILLED, HELD = 0.998, 512
#: One in so many pieces waits for a later level: what copies leave over has all lengths alike, and packs badly by itself.
LATER = 8
ISLANDS, POPULATION, EPOCHS, OFFSPRING = 4, 6, 3, 64


class Encoder:
    """Token ids of texts by a tokenizer file. Words that repeat are encoded once, as many as the memory's bound allows.

    A space between two characters that aren't white space always begins a token, so the text is cut there; a mark after
    a letter does too, so a word with a mark at its end is the word and the mark. Keys of words are without the space
    that all but the first have; a first word's key begins with one.
    """

    _CUT, _MARKS = re.compile(r"(?<=\S)(?= \S)"), ".,;:!?"
    #: A space beside other white space.
    _IRREGULAR = r" [\s\v\x1c-\x1f\x{85}\p{Z}]|[\s\v\x1c-\x1f\x{85}\p{Z}] "

    def __init__(self, path: str, most: int = 1_200_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.special = {x.content: k for k, x in self.tokenizer.get_added_tokens_decoder().items()}
        alone = {c: self.tokenizer.encode(c, add_special_tokens=False).ids for c in self._MARKS}
        self.marks = {c: ids[0] for c, ids in alone.items() if len(ids) == 1}
        # What a byte-level vocabulary's tokens have in bytes: a character stands for each.
        levels = type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel"
        self.bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64) if levels else None
        for token, k in self.tokenizer.get_vocab().items() if levels else ():
            self.bytes[k] = len(token)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.start, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encode(self, keys: list[str]) -> None:
        """Learns some words: plain ones are encoded together and told apart by the bytes of their tokens, others one by one."""
        odd = {k for k in keys if not k or k[0].isspace() or k[-1].isspace()} if self.bytes is not None else set(keys)
        plain = [k for k in keys if k not in odd] if odd else keys
        if plain and not self._together(plain):
            odd = set(keys)
        rest = list(odd)
        words = [k[1:] if k[:1] == " " else " " + k for k in rest]
        found = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        self._add(rest, np.fromiter((i for x in found for i in x), np.uint32), np.fromiter(map(len, found), np.int64, len(found)))

    def _together(self, keys: list[str], most: int = 64) -> bool:
        """Learns words that begin and end without white space, some in one text; tells if that could be."""
        texts = [" " + " ".join(keys[a : a + most]) for a in range(0, len(keys), most)]
        if any(s in t for s in self.special for t in texts):
            return False
        ids = np.concatenate([np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        upto = np.cumsum(self.bytes[ids])
        ends = np.cumsum(pc.binary_length(pa.array(keys, pa.string())).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        at = np.searchsorted(upto, ends)
        if at[-1] + 1 != len(ids) or not np.array_equal(upto[at], ends):
            return False
        self._add(keys, ids, np.diff(at, prepend=-1))
        return True

    def _add(self, keys: list[str], flat: np.ndarray, size: np.ndarray) -> None:
        self.known.update(zip(keys, range(len(self.known), len(self.known) + len(keys)), strict=True))
        self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(size) - size))
        self.size, self.flat = np.concatenate((self.size, size)), np.concatenate((self.flat, flat))

    def _learn(self, keys: list[str]) -> None:
        new = set(keys).difference(self.known)
        if len(self.known) + 2 * len(new) > self.most:
            self._clear()
            new = set(keys)
        marked = [k for k in new if k[-1:] in self.marks and k[-2:-1].isalpha()]
        plain = list(new.difference(marked).union(k[:-1] for k in marked).difference(self.known))
        if plain:
            self._encode(plain)
        if marked:
            at = np.fromiter((self.known[k[:-1]] for k in marked), np.int64, len(marked))
            size = self.size[at] + 1
            flat = self._gather(at, size)
            flat[np.cumsum(size) - 1] = [self.marks[k[-1]] for k in marked]
            self._add(marked, flat, size)

    def _gather(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        before = np.cumsum(size) - size
        place = np.repeat(self.start[at] - before, size) + np.arange(int(size.sum()))
        return self.flat.take(place, mode="clip")

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a string column; a null one has none."""
        texts = pc.fill_null(texts, "")
        odd = np.flatnonzero(pc.match_substring_regex(texts, self._IRREGULAR).to_numpy(zero_copy_only=False))
        out = self._of(pc.split_pattern(texts, " "))
        if len(odd):
            lists = [self._CUT.split(t) for t in texts.take(pa.array(odd)).to_pylist()]
            for k, ids in zip(odd.tolist(), self._of(pa.array([[x[0], *(u[1:] for u in x[1:])] for x in lists], pa.list_(pa.string()))), strict=True):
                out[k] = ids
        return out

    def _of(self, lists: pa.ListArray) -> list[np.ndarray]:
        """The ids of lists of words."""
        first, coded = lists.offsets.to_numpy(), lists.values.dictionary_encode()
        words, firsts = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), [" " + x for x in lists.values.take(lists.offsets[:-1]).to_pylist()]
        self._learn([*words, *firsts])
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]
        at[first[:-1]] = [self.known[x] for x in firsts]
        size = self.size[at]
        ids, upto = self._gather(at, size), np.concatenate(([0], np.cumsum(size)))[first]
        return [ids[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True)]

    def long(self, text: str, part: int = 1 << 20) -> np.ndarray:
        """The ids of a text of any length, encoded in parts."""
        out, at = [], 0
        while at < len(text):
            cut = self._CUT.search(text, at + part) if at + part < len(text) else None
            upto = cut.start() if cut else len(text)
            out += self(pa.array([text[at:upto]]))
            at = upto
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """A worker's encoder; what it has learnt serves the tasks after."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all but the first have `capacity`."""
    first = n % capacity or capacity
    return [(0, min(first, n)), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth) of each piece, and its ids if they are kept: part is its task, nth its number among the task's pieces of its length."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode, seen = TaskContext.get().partitionId(), encoder(tokenizer), [0] * (capacity + 1)
        for batch in batches:
            column = batch.column(1)
            for a, b in stretches(column, 8 << 20):
                texts = column.slice(a, b - a)
                found = encode(texts) if b - a > 1 else [encode.long(texts[0].as_py() or "")]
                rows = []
                for k, ids in enumerate(found):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for piece, (start, n) in enumerate(cuts(len(ids), capacity)):
                        own = ids[start : start + n]
                        rows.append((k, piece, start, n, zlib.crc32(own.tobytes()), seen[n], own if keep_ids else None))
                        seen[n] += 1
                k, piece, start, n, crc, nth, own = zip(*rows, strict=True)
                columns = [batch.column(0).slice(a, b - a).take(pa.array(k)), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, n, crc)), pa.array([part] * len(rows), pa.int64()), pa.array(nth, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
                if keep_ids:
                    columns, names = [*columns, pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, part long, nth long" + ", ids array<long>" * keep_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), schema)


class Groups:
    """A chromosome while it is built: sequences of slots, and which sequence has how much room."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.groups, self.room = sizes, [], []
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask, self.capacity = 0, capacity

    def add(self, group: list[int], room: int | None = None) -> None:
        self.groups.append(group)
        self.room.append(self.capacity - sum(map(self.sizes.__getitem__, group)) if room is None else room)
        self._open(len(self.groups) - 1)

    def _open(self, g: int) -> None:
        room = self.room[g]
        self.by_room[room].append(g)
        self.mask |= 1 << room

    def best_fit(self, slots: list[int], rng: random.Random | None = None) -> None:
        """Each slot, largest first, goes where the least room is left; a bit for each room that some sequence has finds it. rng: sizes count as a little larger at random, which puts slots in another order."""
        order = self.sizes
        if rng:
            spread = rng.choice((0.02, 0.1, 0.3))
            order = {s: self.sizes[s] * (1 + spread * rng.random()) for s in slots}
        for s in sorted(slots, key=order.__getitem__, reverse=True):
            size = self.sizes[s]
            wide = self.mask >> size
            if not wide:
                self.add([s])
                continue
            room = size + (wide & -wide).bit_length() - 1
            g = self.by_room[room].pop()
            if not self.by_room[room]:
                self.mask &= ~(1 << room)
            self.groups[g].append(s)
            self.room[g] = room - size
            self._open(g)

    def fitness(self) -> tuple[int, int]:
        """Smaller is better: the number of sequences, then how evenly they are filled (a few that are nearly empty can still be dissolved)."""
        return len(self.groups), -sum((self.capacity - r) ** 2 for r in self.room)

    def chromosome(self) -> np.ndarray:
        out = np.zeros(len(self.sizes), np.int32)
        for g, group in enumerate(self.groups):
            out[group] = g
        return out

    @classmethod
    def of(cls, chromosome: np.ndarray, sizes: list[int], capacity: int) -> Groups:
        out = cls(sizes, capacity)
        for group in groups_of(chromosome):
            out.add(group)
        return out


def groups_of(chromosome: np.ndarray) -> list[list[int]]:
    order = np.argsort(chromosome, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(chromosome[order])) + 1)]


def crossed(one: Groups, two: Groups, rng: random.Random) -> Groups:
    """A child of `one` with well-filled groups of `two`; up to a quarter of its groups, the emptiest, are dissolved."""
    ranked = sorted(range(len(two.groups)), key=two.room.__getitem__)
    best = ranked[: max(1, len(ranked) // 2)]
    chosen = rng.sample(best, max(1, len(best) // rng.choice((4, 16, 64))))
    taken = bytearray(len(one.sizes))
    child, displaced, left = Groups(one.sizes, one.capacity), [], []
    for g in chosen:
        child.add(list(two.groups[g]), two.room[g])
        for s in two.groups[g]:
            taken[s] = 1
    for g, group in enumerate(one.groups):
        if any(map(taken.__getitem__, group)):
            displaced += [s for s in group if not taken[s]]
        else:
            left.append(g)
    left.sort(key=one.room.__getitem__, reverse=True)
    dissolved = min(len(left), rng.randint(1, max(8, len(left) // 4)))
    for g in left[:dissolved]:
        displaced += one.groups[g]
    for g in left[dissolved:]:
        child.add(list(one.groups[g]), one.room[g])
    child.best_fit(displaced, rng)
    return child


def beginning(sizes: list[int], capacity: int, rng: random.Random, plain: bool) -> Groups:
    """Best fit of all slots, the largest first; unless plain, after some random slots have been given a sequence each."""
    start = Groups(sizes, capacity)
    alone = set() if plain else set(rng.sample(range(len(sizes)), len(sizes) // 8))
    for s in sorted(alone):
        start.add([s])
    start.best_fit([s for s in range(len(sizes)) if s not in alone])
    return start


def least(sizes: list[int], capacity: int) -> int:
    """No packing has fewer sequences: the sum of lengths, and slots of more than half a sequence each need their own."""
    return max(-(-sum(sizes) // capacity), sum(2 * s > capacity for s in sizes))


def evolved(population: list[Groups], offspring: int, rng: random.Random) -> list[Groups]:
    """The population after some children, each of which takes the place of the worst if it is better; the best first."""
    bound = least(population[0].sizes, population[0].capacity)
    ranked = sorted(((c.fitness(), k, c) for k, c in enumerate(population)), key=lambda x: x[:2])
    for k in range(offspring):
        if ranked[0][0][0] <= bound or len(ranked) < 2:
            break
        one, two = rng.sample(ranked, 2)
        child = crossed(one[2], two[2], rng)
        found = (child.fitness(), len(population) + k, child)
        if found[0] < ranked[-1][0] and all(found[0] != x[0] for x in ranked):
            ranked = sorted([*ranked[:-1], found], key=lambda x: x[:2])
    return [x[2] for x in ranked]


_STATE = "island int, epoch int, sequences int, elite binary, others binary"
_STATE_FIELDS = pa.schema([("island", pa.int32()), ("epoch", pa.int32()), ("sequences", pa.int32()), ("elite", pa.binary()), ("others", pa.binary())])


def solved(spark: SparkSession, sizes: list[int], capacity: int = CAPACITY, islands: int = ISLANDS, population: int = POPULATION, epochs: int = EPOCHS, offspring: int = OFFSPRING, seed: int = 11) -> np.ndarray:
    """The sequence of each slot, by islands that evolve in tasks of their own and pass their best chromosome on after each epoch."""
    n = len(sizes)

    def step(epoch: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    rng = random.Random(f"{seed} {row['island']} {epoch}")
                    if epoch:
                        held = np.frombuffer(row["elite"] + row["others"], np.int32).reshape(-1, n)
                        guest = np.frombuffer(row["guest"], np.int32)
                        own = [Groups.of(c, sizes, capacity) for c in [*held[:-1], guest]]  # the guest takes the place of the worst
                    else:
                        own = [beginning(sizes, capacity, rng, plain=not row["island"] and not k) for k in range(population)]
                    best, *others = evolved(own, offspring, rng)
                    out = {"island": row["island"], "epoch": epoch, "sequences": len(best.groups), "elite": best.chromosome().tobytes(), "others": b"".join(c.chromosome().tobytes() for c in others)}
                    yield pa.RecordBatch.from_pylist([out], _STATE_FIELDS)

        return run

    state = spark.range(0, islands, 1, islands).select(F.col("id").cast("int").alias("island"))
    for epoch in range(epochs):
        if epoch:
            guests = state.select(F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"), F.col("elite").alias("guest"))
            state = state.join(guests, "island").repartition(islands, "island")
        state = written(state.mapInArrow(step(epoch), _STATE))
        if state.agg(F.min("sequences").alias("n")).first().n <= least(sizes, capacity):
            break
    return np.frombuffer(state.orderBy("sequences", "island").select("elite").first().elite, np.int32)


def levels_of(spark: SparkSession, counts: dict[int, int], capacity: int = CAPACITY, slots: int = SLOTS, **how) -> tuple[list[tuple], list[tuple]]:
    """How pieces of each length (counts) are packed: levels (length, level, low, high, per_copy, first_id, ids_per_copy), and slots (level, length, slot, sequence, offset).

    Of the pieces of a length, those of rank low to high - 1 are a level's; rank - low is copy * per_copy + slot.
    """
    left, used, first, levels, places = Counter({s: n for s, n in counts.items() if s < capacity and n}), Counter(), 0, [], []
    if counts.get(capacity):
        levels.append((capacity, 0, 0, counts[capacity], 1, 0, 1))
        places.append((0, capacity, 0, 0, 0))
        first = counts[capacity]
    level = 1
    while left:
        copies = max(1, min(sum(left.values()) // slots, max(left.values())))
        mine = {s: (n if copies == 1 else n - n // LATER) // copies for s, n in left.items()}
        sizes = [s for s in sorted(mine, reverse=True) for _ in range(mine[s])] or [max(left, key=left.__getitem__)]
        fill = lambda group: sum(sizes[x] for x in group)
        groups = sorted(groups_of(solved(spark, sizes, capacity, **how)), key=fill)
        held = 0
        while copies > 1 and len(groups) > 1 and fill(groups[0]) < WELL_FILLED * capacity and held + len(groups[0]) <= HELD:
            held += len(groups.pop(0))
        taken = Counter()
        for g, group in enumerate(groups):
            offset = 0
            for x in group:
                places.append((level, sizes[x], taken[sizes[x]], g, offset))
                taken[sizes[x]] += 1
                offset += sizes[x]
        for s, n in taken.items():
            levels.append((s, level, used[s], used[s] + n * copies, n, first, len(groups)))
            used[s] += n * copies
            left[s] -= n * copies
        left = +left
        first += copies * len(groups)
        level += 1
    return levels, places


def packed(found: DataFrame, capacity: int = CAPACITY, **how) -> DataFrame:
    """Pieces (a written table) with sequence_id and offset. Their histogram, of at most `capacity` rows, comes to the driver."""
    spark = found.sparkSession
    tally = written(found.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), few=True)
    counts = {r.length: r.n for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    levels, places = levels_of(spark, counts, capacity, **how)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = tally.select("length", "part", F.coalesce(before, F.lit(0)).alias("_before"))
    rows = found.join(starts, ["length", "part"]).withColumn("_rank", F.col("nth") + F.col("_before"))
    # Both have as many rows as the parameters allow: levels times lengths, and slots of all levels.
    about = F.broadcast(spark.createDataFrame(levels, "length long, _level int, _low long, _high long, _each long, _first long, _ids long"))
    slots = F.broadcast(spark.createDataFrame(places, "_level int, length long, _slot long, _sequence long, offset long"))
    rows = rows.join(about, "length").where("_rank >= _low AND _rank < _high").withColumn("_at", F.col("_rank") - F.col("_low"))
    rows = rows.withColumn("_slot", F.col("_at") % F.col("_each")).join(slots, ["_level", "length", "_slot"])
    copy = F.floor(F.col("_at") / F.col("_each"))
    names = [c for c in found.columns if c not in ("part", "nth")]
    return rows.select(*names, (F.col("_first") + copy * F.col("_ids") + F.col("_sequence")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False, **how) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces, with their ids if keep_ids."""
    return packed(written(pieces(docs, tokenizer, id_col, text_col, capacity, end_id, keep_ids)), capacity, **how)


def sequences(rows: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts): the sequences of packed pieces with ids, their documents and where each begins."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return rows.groupBy("sequence_id").agg(parts.alias("_p")).select("sequence_id", F.flatten("_p.ids").alias("ids"), F.col("_p.doc_id").alias("doc_ids"), F.col("_p.offset").alias("starts"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
