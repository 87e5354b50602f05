"""SimHash near-dedup: tiled exact comparison of fingerprints in words of 64 bits.

Equal fingerprints are one node from the start, so copies never meet each other. Words within `radius` bits agree in one
of radius + 1 bands and differ by `radius` at most in their number of set bits; so fingerprints meet in cells of (band,
its value, range of bit counts), each with the next range as guests: tile pairs whose bit counts differ by more than
the radius are never formed. Cells of over `tile` members are cut in tiles by hash, and each pair of tiles is work of
its own. Groups of cells hold a number of rows that does not grow with the corpus. Inside a tile pair numpy compares
with exclusive-or and bit counts in blocks ordered by bit count, skipping blocks that are out of reach, and only a
spanning forest of the links leaves it, never all pairs of a group.

Where a similarity is asked for (`Likeness.least`), fingerprints only propose and the texts decide. Two texts that share
0.8 of their shingles differ in about 10 of 64 bits; bands of so large a radius would be 5 bits wide, so texts meet in
cells of equal min-hashes there (`bands` of `rows` each), and wider fingerprints are compared in those cells as above.
Nodes are texts of equal words. The components of what is proposed are cut in tiles, and all pairs of a tile that are
within the radius are decided by their sets of shingle hashes. What is left are pairs between tiles of one component:
they are decided in those cells that still hold several parts. A pair whose parts are joined already isn't tried, so
the work for a group of copies is a forest, and only forests leave a task.

Components: labels spread by alternating large-star and small-star steps over (node, node) rows in written tables, until
every row leads to a root; nothing is collected.

Null and empty texts have the fingerprint zero and link like any other. Repeated rows are copies. Rows with a null id
get their component; a component with null ids alone has a null label. Ties are settled by the smallest id. A text of
any length is hashed as a whole, some MB of texts at a time. An empty table has no rows. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import mix, pieces_of, power_of_two, stretches, texts_of, tidy, written

SHINGLE, RADIUS, TILE = 3, 2, 8192
#: Rows of a group of cells, and shingle hashes of a tile whose texts are compared.
GROUP_ROWS, TILE_HASHES = 4096, 1 << 21
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Likeness:
    """What links two texts: fingerprints of `words` words of 64 bits within `radius` bits of each other.

    least: they must also share this much of their different shingles; fingerprints are then of different shingles, and
    meet where `rows` min-hashes of one of `bands` bands agree. At a similarity of 0.8 all bands miss a pair in 14,000.
    """

    shingle: int = SHINGLE
    radius: int = RADIUS
    words: int = 1
    least: float | None = None
    bands: int = 24
    rows: int = 5


EXACT_BITS = Likeness()
#: At a similarity of 0.8 about 39 of 256 bits differ (deviation 6).
CONFIRMED = Likeness(shingle=5, radius=64, words=4, least=0.8)


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of `shingle` words, repeats included; a text of fewer words is one run."""
    digest, out, held = xxhash.xxh64_intdigest, [], []
    for piece in pieces_of(text):
        tokens = held + piece.translate(_FOLD).split()
        if len(tokens) >= shingle:
            joined = b" ".join(tokens)
            ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
            starts = np.concatenate(([0], ends[:-shingle]))
            out.append(np.fromiter([digest(joined[s:e], 42) for s, e in zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)], np.uint64, len(tokens) - shingle + 1))
        held = tokens[len(tokens) - shingle + 1 :] if len(tokens) >= shingle else tokens
    if not out:
        return np.array([digest(b" ".join(held), 42)] if held else [], np.uint64)
    return np.concatenate(out)


def bits_of(hashes: np.ndarray, words: int = 1) -> list[int]:
    """A fingerprint's words of 64 bits. A bit is 1 if it is set in over half of the hashes.

    The first word takes the hashes themselves, each further one a finaliser's values of them.
    """
    out = []
    for k in range(words):
        own = hashes if not k else mix(hashes + np.uint64(k))
        ones = np.zeros(64, np.int64)
        for at in range(0, len(own), 1 << 14):
            ones += np.unpackbits(own[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(int(np.packbits(ones * 2 > len(own), bitorder="little").view("<u8")[0]))
    return out


def cells_of(hashes: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """(texts, bands): a number for each band of each text's min-hashes. Every text has hashes."""
    flat = np.concatenate(hashes)
    start = np.cumsum([0, *map(len, hashes[:-1])])
    rng = np.random.default_rng(5)
    turn, times = rng.integers(0, 1 << 63, (2, bands * rows), dtype=np.uint64)
    out = np.empty((len(hashes), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(hashes), band, np.uint64)
        for k in range(band * rows, (band + 1) * rows):
            key = mix(key + np.minimum.reduceat((flat ^ turn[k]) * (times[k] | np.uint64(1)), start))
        out[:, band] = key
    return out


def node_of(text: bytes) -> int:
    """A number for a text's words: equal for texts that differ in the case of A-Z and white space alone."""
    state, gap = xxhash.xxh64(seed=7), b""
    for piece in pieces_of(text):
        if tokens := piece.translate(_FOLD).split():
            state.update(gap + b" ".join(tokens))
            gap = b" "
    return state.intdigest()


_PRINT = StructType([StructField("th", LongType()), StructField("node", LongType()), StructField("bits", ArrayType(LongType())), StructField("size", LongType()), StructField("cells", ArrayType(LongType()))])


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col))


def fingerprints(docs: DataFrame, like: Likeness = EXACT_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, node long, bits array of long, size long, cells array of long) of each row, as signed numbers.

    th: a hash of the text as it is. node: the fingerprint, or a number of the text's words where texts decide.
    size: the number of shingles. cells: where texts decide, the min-hash bands.
    """
    own = docs.select(id_col, text_hash(text_col).alias("th"), F.col(text_col).alias("__text"))
    signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))

    def lists(a: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]), pa.array(np.ascontiguousarray(a).reshape(-1).view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in stretches(batch.column("__text"), 2 << 20):
                texts = texts_of(batch.column("__text").slice(a, b - a))
                hashes = [shingle_hashes(t, like.shingle) for t in texts]
                size = [len(h) for h in hashes]
                if like.least:
                    hashes = [np.unique(h) for h in hashes]
                    size = [len(h) for h in hashes]
                    node = [node_of(t) for t in texts]
                    # A text without words is alike no other; its cells are its own.
                    cells = cells_of([h if len(h) else np.zeros(1, np.uint64) for h in hashes], like.bands, like.rows)
                bits = np.array([bits_of(h, like.words) if len(h) else [0] * like.words for h in hashes], np.uint64).reshape(-1, like.words)
                if not like.least:
                    node, cells = bits[:, 0], np.zeros((len(texts), 0), np.uint64)
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(a, b - a) for k in (0, 1)), signed(node), lists(bits), pa.array(size, pa.int64()), lists(cells)], [id_col, *(f.name for f in _PRINT.fields)])

    return own.mapInArrow(tidy(run), StructType([docs.schema[id_col], *_PRINT.fields]))


def _near(a: np.ndarray, b: np.ndarray | None, radius: int, sizes: np.ndarray | None = None, ratio: float = 0.0, block: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of a (or of a and b) within radius bits, as places in both together, block by block.

    sizes, ratio: the smaller size must be at least ratio times the larger.
    """
    every = a if b is None else np.concatenate((a, b))
    bits = np.bitwise_count(every).sum(1, dtype=np.int64)
    rows = np.argsort(bits[: len(a)], kind="stable")
    columns = rows if b is None else len(a) + np.argsort(bits[len(a) :], kind="stable")
    for i in range(0, len(rows), block):
        r = rows[i : i + block]
        for j in range(i if b is None else 0, len(columns), block):
            c = columns[j : j + block]
            if bits[c[0]] - bits[r[-1]] > radius or bits[r[0]] - bits[c[-1]] > radius:
                continue
            apart = sum(np.bitwise_count(every[r, k][:, None] ^ every[c, k][None, :]).astype(np.uint16) for k in range(every.shape[1]))
            x, y = np.nonzero(apart <= radius)
            x, y = r[x], c[y]
            if sizes is not None:
                near = np.minimum(sizes[x], sizes[y]) >= ratio * np.maximum(sizes[x], sizes[y])
                x, y = x[near], y[near]
            yield x, y


def _join(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Roots after the links x-y are added; parent and the result are flat."""
    while len(x := x[new := parent[x] != parent[y]]):
        y = y[new]
        low = np.minimum(parent[x], parent[y])
        np.minimum.at(parent, parent[x], low)
        np.minimum.at(parent, parent[y], low)
        while not np.array_equal(up := parent[parent], parent):
            parent = up
    return parent


def forest(a: np.ndarray, b: np.ndarray | None, radius: int, sizes: np.ndarray | None = None, ratio: float = 0.0, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the linked rows of a (or of a and b), as places in both together."""
    parent = np.arange(len(a) + (0 if b is None else len(b)))
    for x, y in _near(a, b, radius, sizes, ratio, block):
        parent = _join(parent, x, y)
    linked = np.flatnonzero(parent != np.arange(len(parent)))
    return linked, parent[linked]


CELL = ["cell", "range"]


def _members(nodes: DataFrame, like: Likeness) -> DataFrame:
    """nodes with (cell long, range int, guest boolean): a row for each cell of a node."""
    if like.least:
        return nodes.withColumn("cell", F.explode("cells")).withColumns({"range": F.lit(0), "guest": F.lit(False)}).drop("cells")
    cut = [64 * k // (like.radius + 1) for k in range(like.radius + 2)]
    masks = [((1 << (high - low)) - 1) << low for low, high in zip(cut, cut[1:], strict=False)]
    word, signed = F.col("bits")[0], lambda m: m - (1 << 64) if m >> 63 else m
    home = F.floor(F.bit_count(word) / (like.radius + 1)).cast("int")
    cell = lambda k, more: F.struct(F.xxhash64(F.lit(k), word.bitwiseAND(F.lit(signed(masks[k])))).alias("cell"), (home + more).alias("range"), F.lit(more == 1).alias("guest"))
    return nodes.withColumn("c", F.explode(F.array(*(cell(k, more) for k in range(len(masks)) for more in (0, 1))))).select(*(c for c in nodes.columns if c != "cells"), "c.*")


def _tiled(members: DataFrame, sizes: DataFrame, key: list[str]) -> DataFrame:
    """members with own, their tile, and i, j, a pair of tiles, for each pair that their tile is in. sizes: key and tiles int."""
    rows = members.join(sizes, key).withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    return rows.withColumn("p", F.explode(pair)).withColumns({"i": F.col("p.i"), "j": F.col("p.j")}).drop("p", "tiles")


def _dealt(rows: DataFrame, key: list[str], groups: int) -> DataFrame:
    """rows with deal, one number for many small cells, so that a group is worth a call; within it cells stay apart."""
    return rows.withColumn("deal", F.pmod(F.xxhash64(*key, "i", "j"), F.lit(groups)))


def _spans(table: pa.Table, key: list[str]) -> Iterator[np.ndarray]:
    """The places of each cell's (or pair of tiles') rows."""
    name = [table.column(c).to_numpy() for c in (*key, "i", "j")]
    order = np.lexsort(name)
    edge = np.flatnonzero(np.concatenate(([True], *[np.any([c[order][1:] != c[order][:-1] for c in name], 0)], [True])))
    for s, e in zip(edge[:-1], edge[1:], strict=True):
        if e - s > 1:
            yield order[s:e]


def _words(table: pa.Table) -> np.ndarray:
    flat = table.column("bits").combine_chunks().flatten().to_numpy()
    return flat.view(np.uint64).reshape(table.num_rows, -1)


_EDGES = "a long, b long"


def _edges(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    both = np.unique(np.concatenate([np.stack((np.minimum(a, b), np.maximum(a, b)), 1) for a, b in pairs] or [np.zeros((0, 2), np.int64)]), axis=0)
    return pa.table({"a": pa.array(np.ascontiguousarray(both[:, 0])), "b": pa.array(np.ascontiguousarray(both[:, 1]))})


def links(nodes: DataFrame, like: Likeness = EXACT_BITS, tile: int = TILE) -> DataFrame:
    """(a, b long): a spanning forest, or more, of the nodes (node, bits, size, cells) within the radius, each cell for itself."""
    members = _members(nodes.select("node", "cells") if like.least else nodes.select("node", "bits", "cells"), like)
    # Cells without a member at home or with one member have no pairs; only of large cells tiles are cut.
    sizes = members.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"), F.min("guest").alias("guests_only")).where("n > 1 AND NOT guests_only")
    sizes = written(sizes.select(*CELL, "n", F.ceil(F.col("n") / tile).cast("int").alias("tiles")), few=True)
    tiled = sizes.agg(F.sum(F.col("n") * F.col("tiles")).alias("n")).first().n or 0  # each member goes to as many pairs of tiles as there are tiles
    rows = _tiled(members, sizes.drop("n"), CELL)
    if like.least:
        rows = rows.join(nodes.select("node", "bits", "size"), "node")
    rows = _dealt(rows, CELL, power_of_two(max(1 << 10, tiled / GROUP_ROWS)))

    def run(table: pa.Table) -> pa.Table:
        every, node = _words(table), table.column("node").to_numpy()
        size = table.column("size").to_numpy() if like.least else None
        guest, own = table.column("guest").to_numpy(zero_copy_only=False), table.column("own").to_numpy()
        one, two = table.column("i").to_numpy(), table.column("j").to_numpy()
        got = []

        def meet(a: np.ndarray, b: np.ndarray | None) -> None:
            if len(a) and (b is None or len(b)):
                at = a if b is None else np.concatenate((a, b))
                x, y = forest(every[a], None if b is None else every[b], like.radius, None if size is None else size[at], like.least or 0)
                got.append((node[at[x]], node[at[y]]))

        for at in _spans(table, CELL):
            i, j = one[at[0]], two[at[0]]
            homes, guests = at[~guest[at]], at[guest[at]]
            if i == j:
                meet(homes, None)
                meet(homes, guests)
            else:  # homes of one tile with homes and guests of the other
                p, q = homes[own[homes] == i], homes[own[homes] == j]
                meet(p, q)
                meet(p, guests[own[guests] == j])
                meet(q, guests[own[guests] == i])
        return _edges(got)

    return rows.groupBy("deal").applyInArrow(run, _EDGES)


def _dealt_anew(sums: DataFrame) -> DataFrame:
    """Sums by a, with a as a computed column: a join then deals both sides anew, and adaptive execution can split a hot node's rows."""
    return sums.select(F.col("a").bitwiseXOR(F.lit(0)).alias("a"), "m")


def components(edges: DataFrame) -> DataFrame:
    """(node, root long): each linked node with its component's smallest one, that one included, by large-star and small-star."""
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), few=True)
    ends = lambda e: e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("b", F.lit(0), F.lit(1)))
    while True:
        # Done when each node has one way up, and no way up leads to a node that has one itself.
        seen = ends(edges).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if seen.where("up > 1 OR up = 1 AND down = 1").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(seen.where("up = 0").select("node", "node"))
        # Large star: each node's larger neighbours go to its smallest neighbour. Small star: its smaller ones and itself do.
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(_dealt_anew(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(_dealt_anew(low), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        edges = written(small.distinct(), few=True)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", like: Likeness = EXACT_BITS, tile: int = TILE) -> DataFrame:
    """(id, fp long, component_id): component_id is the smallest id that links of bits reach, its own included."""
    fps = written(fingerprints(docs, like, id_col, text_col).select(id_col, "node", "bits", "cells"))
    nodes = written(fps.groupBy("node").agg(F.min(id_col).alias("least"), F.first("bits").alias("bits"), F.first("cells").alias("cells")), few=True)
    roots = components(links(nodes, like, tile))
    of = nodes.select("node", "least").join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    labels = of.join(of.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return fps.join(labels.select("node", "component_id"), "node").select(id_col, F.col("node").alias("fp"), "component_id")


class _Sets:
    """Shingle sets of a cell's texts as numbers, made when the first pair is tried."""

    def __init__(self, packed: list[bytes]):
        sets = [np.frombuffer(x, np.uint64) for x in packed]
        self.n = np.fromiter(map(len, sets), np.int64, len(sets))
        self.start = np.cumsum(self.n) - self.n
        different, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.flat, self.mark = flat.astype(np.int32), np.zeros(len(different), bool)

    def alike(self, x: int, y: np.ndarray, least: float) -> np.ndarray:
        """Which texts y share `least` of their different shingles with x."""
        own = self.flat[self.start[x] : self.start[x] + self.n[x]]
        self.mark[own] = True
        both = np.zeros(len(y), np.int64)
        step = max(1, (1 << 20) // max(1, int(self.n[y].max())))
        for k in range(0, len(y), step):
            n = self.n[y[k : k + step]]
            first = np.cumsum(n) - n
            at = np.repeat(self.start[y[k : k + step]] - first, n) + np.arange(int(n.sum()))
            both[k : k + step] = np.add.reduceat(self.mark[self.flat[at]], first, dtype=np.int64) if len(at) else 0
        self.mark[own] = False
        return both + 1e-9 >= least * (self.n[x] + self.n[y] - both)


def decided(a: np.ndarray, b: np.ndarray | None, part: np.ndarray, packed: list[bytes], like: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of parts that links between them join, a forest: rows of a (or of a and b) within the radius are tried by their sets if their parts are apart."""
    names, label = np.unique(part, return_inverse=True)
    parent, sets, got = np.arange(len(names)), None, [np.zeros((2, 0), np.int64)]
    size = np.fromiter((len(x) // 8 for x in packed), np.int64, len(packed))
    for x, y in _near(a, b, like.radius, size, like.least):
        new = parent[label[x]] != parent[label[y]]
        x, y = x[new], y[new]
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        edge = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1], [True]))) if len(x) else []
        for s, e in zip(edge[:-1], edge[1:], strict=True):
            others = y[s:e][parent[label[y[s:e]]] != parent[label[x[s]]]]
            if not len(others):
                continue
            sets = sets or _Sets(packed)
            others = others[sets.alike(int(x[s]), others, like.least)]
            roots = np.unique(parent[label[others]])
            if len(roots):
                own = parent[label[x[s]]]
                got.append(np.stack((np.full(len(roots), own), roots)))
                parent[np.isin(parent, roots)] = own
    x, y = np.concatenate(got, 1)
    return names[x], names[y]


def _confirmed(rows: DataFrame, key: list[str], groups: int, like: Likeness) -> DataFrame:
    """(a, b): parts that confirmed links join. rows: key, i, j, own, node, part, bits, hashes."""

    def run(table: pa.Table) -> pa.Table:
        every, part, hashes = _words(table), table.column("part").to_numpy(), table.column("hashes").combine_chunks()
        own, one, two = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        got = []
        for at in _spans(table, key):
            a, b = (at, None) if one[at[0]] == two[at[0]] else (at[own[at] == one[at[0]]], at[own[at] == two[at[0]]])
            if len(a) and (b is None or len(b)):
                both = a if b is None else np.concatenate((a, b))
                got.append(decided(every[a], None if b is None else every[b], part[both], hashes.take(pa.array(both)).to_pylist(), like))
        return _edges(got)

    return _dealt(rows.select(*key, "i", "j", "own", "part", "bits", "hashes"), key, groups).groupBy("deal").applyInArrow(run, _EDGES)


def shingle_sets(rows: DataFrame, like: Likeness) -> DataFrame:
    """rows with `text` replaced by hashes, the different shingles' hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in stretches(batch.column("text"), 2 << 20):
                some = batch.slice(a, b - a)
                sets = pa.array([np.unique(shingle_hashes(t, like.shingle)).tobytes() for t in texts_of(some.column("text"))], pa.binary())
                yield some.drop_columns(["text"]).append_column("hashes", sets)

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.mapInArrow(tidy(run), f"{kept}, hashes binary")


def similar(docs: DataFrame, nodes: DataFrame, text_col: str, like: Likeness, tile: int = TILE, tile_hashes: int = TILE_HASHES) -> DataFrame:
    """(node, root) of the nodes that confirmed links join to others. docs: (name, text); nodes: (node, name, bits, size, cells), the name of one row of each."""
    proposed = written(components(links(nodes, like, tile)).withColumnRenamed("root", "part"), few=True)
    chosen = nodes.join(proposed, "node").select("name", F.struct("node", "part", "bits").alias("of"))
    # Rows are found by name, which equal texts with other ids don't share, so a large group of copies isn't one task's.
    texts = docs.select("name", F.coalesce(text_col, F.lit("")).alias("text")).join(chosen, "name")
    texts = texts.groupBy("name").agg(F.first("of").alias("of"), F.first("text").alias("text")).select("of.*", "text")
    sets = written(shingle_sets(texts, like), "none")

    # A component of many texts is cut in tiles; what a tile holds is decided there.
    parts = sets.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("hashes")).alias("bytes"))
    tiles = F.greatest(F.ceil(F.col("n") / tile), F.ceil(F.col("bytes") / (8 * tile_hashes)), F.lit(1)).cast("int")
    parts = parts.select("part", tiles.alias("tiles"))
    total = sets.agg(F.sum(F.octet_length("hashes")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    groups = power_of_two(max(1 << 8, total.n / GROUP_ROWS, (total.b or 0) / (4 * tile_hashes)))
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    rows = sets.join(parts, "part").select("node", F.col("part").alias("cell"), F.col("node").alias("part"), "bits", "hashes", own.alias("own"), "tiles")
    rows = rows.withColumns({"i": F.col("own"), "j": F.col("own"), "range": F.lit(0)})
    inside = written(components(_confirmed(rows, CELL, groups, like)), few=True)
    large = parts.where("tiles > 1").select("part")
    if large.isEmpty():
        return inside

    # Texts of one component in different tiles: they meet in the cells that hold several of the parts found so far.
    left = sets.join(large, "part").select("node", "bits", "hashes").join(inside.withColumnRenamed("root", "part"), "node", "left")
    left = written(left.withColumn("part", F.coalesce("part", "node")), "none")
    members = _members(nodes.select("node", "cells").join(left.select("node", "part", F.octet_length("hashes").alias("bytes")), "node"), like)
    mixed = members.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q")
    rows = _tiled(members.select("node", *CELL), mixed.select(*CELL, tiles.alias("tiles")), CELL).join(left, "node")
    between = components(_confirmed(rows, CELL, groups * 4, like)).withColumnsRenamed({"node": "part", "root": "top"})
    every = inside.withColumnRenamed("root", "part").union(left.select("node", "part")).distinct()
    return every.join(between, "part", "left").select("node", F.coalesce("top", "part").alias("root"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", like: Likeness = CONFIRMED, tile: int = 4096, tile_hashes: int = TILE_HASHES) -> DataFrame:
    """docs without near duplicates: of each component one row with its smallest id stays (a null id counts as the largest)."""
    fps = fingerprints(docs, like, id_col, text_col)
    least = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "th")).alias("least")
    nodes = fps.groupBy("node").agg(least, *(F.first(c).alias(c) for c in ("bits", "size", "cells")))
    # A row is known by its id and its text, as ids may be null or used again; of equal rows one stays.
    name = lambda i, h: F.concat_ws(":", h.cast("string"), i.cast("string"))
    nodes = written(nodes.withColumn("name", name(F.col("least.id"), F.col("least.th"))), few=True)
    own = docs.withColumn("__name", name(F.col(id_col), text_hash(text_col)))
    roots = similar(own.select(F.col("__name").alias("name"), text_col), nodes, text_col, like, tile, tile_hashes)
    found = nodes.select("node", "least", "name").join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root"))
    stays = found.agg(F.min(F.struct("least", "name")).alias("m")).select(F.col("m.name").alias("__name"))
    one = Window.partitionBy("__name").orderBy(F.xxhash64(*docs.columns))
    left = own.join(stays, "__name", "left_semi")
    return left.withColumn("__twin", F.row_number().over(one)).where("__twin = 1").select(*docs.columns)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint of 3-word shingles and the smallest document that links of 2 bits reach."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
