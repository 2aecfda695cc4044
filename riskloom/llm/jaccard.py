"""Jaccard join of documents on word n-grams with count-vector R-trees (operator 10).

A document's set is its distinct shingles (A-Z as a-z; a text of fewer words has its whole sequence as
the one shingle; without words the set is empty and linked with nothing).  Two documents link when the
Jaccard similarity of their sets is at least the threshold t.

1. Equal sets are one point from here on, named by its smallest doc_id.
2. Cells.  Sets linked at t differ in at most D = (1 - t) / t * (the smaller size) shingles.  Hashing
   shingles into more than D blocks leaves a block in which both agree, so points meet in a cell for
   every (size class, block, sum of the block's hashes); a block that is empty counts only for sets
   with too few others.  No linked pair is missed, and a passage that many documents share fills a
   block alone only by chance.  These rows, many a document, are the most that is shuffled: they hold a
   short name of the set, and points whose short names are equal meet in a cell of their own.
3. Count vectors.  Each point's shingles are hashed into groups, more of them for larger sets (with few a
   group would hold so many that any two large sets look alike); the counts are its place.  A vector folds
   to fewer groups, so that points of any two sizes compare.  Two points share at most the sum, over the
   groups, of the smaller count.  In a cell the points are in
   an R-tree whose nodes hold the greatest counts below them; a search goes down where the summed
   minima still reach what the threshold asks.
4. Verification on the whole shingle sets.  A cell's points are first held against the cell's
   smallest, which joins a group of near copies by as many pairs as it has members.  Cells that still
   hold separate parts are bundled by their smallest point, so that two points that share many cells meet
   in few bundles, and each bundle is searched by one tree: first on the packed counts, which leaves the
   points that may be linked across parts; then, with those points' whole sets at hand, on as many groups
   as the sets are large, every pair that is left being verified there and then unless it is joined
   already.  Only links that join two parts are put out: fewer than a bundle has points.
   Bundles too large for a task are searched cell by cell on ``GROUPS`` groups, their pairs held against
   the packed counts again and verified after a shuffle.
5. Components of the links.

Null ids: their rows come back with a null component and link nothing.  Rows that share an id are one
document with several texts, linked with whatever one of them is linked with.  Null texts are empty; an empty table gives no row; only doc_id and text
are read.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import drop_ids, id_side, materialize, text_chunks, texts
from riskloom.llm.components import components
from riskloom.llm.words import mix, shingle_sets

#: The least groups of a packed count vector, the most, and the shingles of a group on average (up to the most groups).
GROUPS, MOST_GROUPS, GROUP_SHINGLES = 128, 1 << 15, 4
#: Counts are kept in a byte; this one stands for itself and all greater, and bounds nothing.
FULL = 255
LEAF = 16
#: The first size of a class is this many times that of the class below.
CLASS_FACTOR = 1.25
#: Points of a cell that one task searches by a tree; larger cells are split by their tree's order.
CELL_POINTS = 4096
#: Points and shingles (8 bytes each) of a bundle that one task searches; larger ones go by cells.
BUNDLE_POINTS, BUNDLE_SHINGLES = 4096, 1 << 23
#: The most groups of a bundle's count vectors, and counts (4 bytes each) of a bundle.
BUNDLE_GROUPS, BUNDLE_COUNTS = 4096, 1 << 22
#: Bits of the short names of sets (of ``s1``, the lowest), 32 at most.
NAME_BITS = 32
#: Bytes of text whose shingles are made at a time.
CHUNK_BYTES = 1 << 18

_GROUP, _BLOCK = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


class Threshold:
    """Bounds of one Jaccard threshold, given in hundredths so that comparisons are exact."""

    def __init__(self, percent: int):
        self.percent = percent
        self.firsts = [1]

    def linked(self, shared: int, a: int, b: int) -> bool:
        return 100 * shared >= self.percent * (a + b - shared)

    def differing(self, smaller: int) -> int:
        """The most shingles in which a set of this size and a linked one no smaller differ."""
        return (100 - self.percent) * smaller // self.percent

    def first_of_class(self, k: int) -> int:
        while len(self.firsts) <= k:
            self.firsts.append(max(self.firsts[-1] + 1, math.ceil(self.firsts[-1] * CLASS_FACTOR)))
        return self.firsts[k]

    def class_of(self, size: int) -> int:
        while self.firsts[-1] <= size:
            self.first_of_class(len(self.firsts))
        return bisect_right(self.firsts, size) - 1

    def blocks(self, k: int) -> tuple[int, int]:
        """(blocks, most differing shingles) of pairs whose smaller set is in class k.  Some blocks
        more than the pigeonhole needs keep enough of them filled."""
        d = self.differing(self.first_of_class(k + 1) - 1)
        return d + 1 + d // 12 + (1 if d else 0), d

    def classes(self, size: int) -> list[int]:
        """The classes in which a set of this size meets others: its own as the smaller of a pair,
        and each below that holds the smallest set it can be linked with."""
        own = self.class_of(size)
        least = -(-self.percent * size // 100)
        return list(range(self.class_of(max(least, 1)), own + 1))


def set_name(hashes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that name a set of hashes, as signed longs."""
    a = np.bitwise_xor.reduce(mix(hashes)) if hashes.size else np.uint64(0)
    b = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(hashes.size)).sum(dtype=np.uint64)
    return int(np.array([a]).view(np.int64)[0]), int(np.array([b]).view(np.int64)[0])


def cell_keys(hashes: np.ndarray, threshold: Threshold) -> np.ndarray:
    """The cells (64-bit names) in which a set meets those it may be linked with."""
    out = []
    for k in threshold.classes(len(hashes)):
        m, d = threshold.blocks(k)
        block = ((hashes * _BLOCK) >> np.uint64(32)) % np.uint64(m)
        sums = np.zeros(m, np.uint64)
        np.add.at(sums, block.astype(np.int64), mix(hashes))
        filled = np.bincount(block.astype(np.int64), minlength=m) > 0
        if filled.sum() > d:  # a block in which both agree is among the filled ones
            own = np.flatnonzero(filled)
        else:
            own = np.arange(m)
        out.append(mix(mix(sums[own] + np.uint64(k)) + own.astype(np.uint64) * _GROUP))
    return np.concatenate(out)


def group_counts(hashes: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount(((hashes * _GROUP) >> np.uint64(40)).astype(np.int64) % groups, minlength=groups)


def groups_of(size: int) -> int:
    """The groups, a power of two, of the packed vector of a set of ``size``."""
    groups = GROUPS
    while groups < MOST_GROUPS and groups * GROUP_SHINGLES < size:
        groups *= 2
    return groups


def count_vector(hashes: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    return np.minimum(group_counts(hashes, groups), FULL).astype(np.uint8)


def widths(column: pa.Array) -> np.ndarray:
    """The groups of each packed vector."""
    return pc.binary_length(column).to_numpy().astype(np.int64)


def count_vectors(column: pa.Array, groups: int | None = None) -> np.ndarray:
    """A row of counts for each packed vector, all folded to ``groups`` (those of the shortest, or fewer
    where there are many vectors); a full count bounds nothing."""
    width = widths(column)
    if groups is None:
        groups = int(width.min())
        while groups > GROUPS and groups * len(width) > BUNDLE_COUNTS:
            groups //= 2
    packed, out = column.to_pylist(), np.empty((len(width), groups), np.int32)
    for w in np.unique(width):
        for at in pieces(np.flatnonzero(width == w), BUNDLE_COUNTS // int(w)):
            counts = np.frombuffer(b"".join([packed[i] for i in at]), np.uint8).reshape(-1, w).astype(np.int32)
            counts[counts == FULL] = 1 << 20
            out[at] = counts.reshape(len(at), -1, groups).sum(1)
    return out


def pieces(places: np.ndarray, size: int) -> list[np.ndarray]:
    size = max(1, size)
    return [places[i : i + size] for i in range(0, len(places), size)]


class CountTree:
    """An R-tree over count vectors, packed bottom-up; nodes hold the greatest counts below them and
    the least and greatest set size."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        self.vectors, self.sizes = vectors, sizes
        self.order = tile_order(vectors, sizes)
        self.levels = []  # from the leaves up: (greatest counts, least size, greatest size)
        high, low, top = vectors[self.order], sizes[self.order], sizes[self.order]
        while True:
            cut = np.arange(0, len(high), LEAF)
            high, low, top = np.maximum.reduceat(high, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(top, cut)
            self.levels.append((high, low, top))
            if len(high) == 1:
                break

    def search(self, vector: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Places of the points that may be linked with a set of ``size`` at ``vector``."""
        at = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -2, -1):
            if level >= 0:
                high, low, top = (x[at] for x in self.levels[level])
            else:
                points = self.order[at]
                high, low, top = self.vectors[points], self.sizes[points], self.sizes[points]
            bound = np.minimum(high, vector).sum(1, dtype=np.int64)
            may = (bound * (100 + percent) >= percent * (size + low)) & (low * percent <= 100 * size) & (top * 100 >= percent * size)
            at = at[may]
            if level < 0:
                return self.order[at]
            n = len(self.order) if level == 0 else len(self.levels[level - 1][0])
            at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
            at = at[at < n]
        return at


def tile_order(vectors: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sort-tile order: by size into slices, in a slice by the group that varies most."""
    order = np.argsort(sizes, kind="stable")
    width = LEAF * max(1, int(math.sqrt(len(order) / LEAF)))
    out = []
    for i in range(0, len(order), width):
        part = order[i : i + width]
        group = int(vectors[part].var(0).argmax())
        out.append(part[np.argsort(vectors[part, group], kind="stable")])
    return np.concatenate(out)


def document_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (set size), s1, s2 (the set's name) of every row."""

    def name(batches):
        for batch in batches:
            for chunk in text_chunks(batch, limit=CHUNK_BYTES):
                sets = shingle_sets(chunk.column("text"), words, True)
                names = [set_name(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([a for a, _ in names], pa.int64()), pa.array([b for _, b in names], pa.int64())],
                    names=["doc_id", "n", "s1", "s2"],
                )

    return docs.mapInArrow(name, "doc_id long, n long, s1 long, s2 long")


def cell_rows(docs: DataFrame, words: int, threshold: Threshold) -> DataFrame:
    """cell, name: the cells of every set by its short name; sets that repeat within a chunk come once."""
    cut = 64 - NAME_BITS

    def cells(batches):
        for batch in batches:
            for chunk in text_chunks(batch, limit=CHUNK_BYTES):
                keys, names, seen = [], [], set()
                for s in shingle_sets(chunk.column("text"), words, True):
                    if s.size and (name := set_name(s)[0]) not in seen:
                        seen.add(name)
                        own = cell_keys(s, threshold)
                        keys.append(own)
                        names.append(np.full(len(own), name, np.int64) << cut >> cut)
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(names).astype(np.int32))], names=["cell", "name"])

    return docs.mapInArrow(cells, "cell long, name int")


def shared_cells(rows: DataFrame, points: DataFrame) -> DataFrame:
    """cell, node of the cells (``rows``: cell, name) in which different points meet."""
    by_cell = Window.partitionBy("cell")
    shared = rows.withColumn("lo", F.min("name").over(by_cell)).withColumn("hi", F.max("name").over(by_cell)).filter("lo < hi").select("cell", "name").distinct()
    short = points.select(F.shiftright(F.shiftleft("s1", 64 - NAME_BITS), 64 - NAME_BITS).cast("int").alias("name"), "node")
    # A cell that holds one name may still hold several points of that name.
    alike = short.groupBy("name").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("name")
    same = short.join(alike, "name").select(F.xxhash64("name").alias("cell"), "node")
    return shared.join(short, "name").select("cell", "node").union(same).distinct()


def described(docs: DataFrame, words: int, what: str, of: Callable[[np.ndarray], bytes]) -> DataFrame:
    """node, s1, s2 and the column ``what``, packed by ``of`` from the set, of documents (doc_id,
    text); the node is the doc_id."""

    def pack(batches):
        for batch in batches:
            for chunk in text_chunks(batch, limit=CHUNK_BYTES):
                sets = shingle_sets(chunk.column("text"), words, True)
                names = [set_name(s) for s in sets]
                columns = [chunk.column("doc_id"), pa.array([a for a, _ in names], pa.int64()), pa.array([b for _, b in names], pa.int64()), pa.array([of(s) for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "s1", "s2", what])

    return docs.mapInArrow(pack, f"node long, s1 long, s2 long, {what} binary")


class Sets:
    """The sets of chosen nodes, computed from their texts when they are asked for; ``points`` (s1, s2,
    n, node) says which."""

    def __init__(self, docs: DataFrame, points: DataFrame, words: int):
        self.docs, self.points, self.words = docs, points, words

    def column(self, nodes: DataFrame, what: str, of: Callable[[np.ndarray], bytes]) -> DataFrame:
        """A written table: node, n and ``what`` of ``nodes`` (one column)."""
        wanted = materialize(nodes.select(F.col(nodes.columns[0]).alias("__node")).distinct(), "wanted")
        own = self.docs.join(id_side(wanted), self.docs["doc_id"] == F.col("__node"), "left_semi")
        found = described(own, self.words, what, of).join(self.points, ["s1", "s2", "node"])
        return materialize(found.dropDuplicates(["node", "s1", "s2"]).select("node", "n", what), what)


def bounded(pairs: DataFrame, vectors: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and summed minima do not rule out."""
    side = lambda x, key: vectors.select(F.col("node").alias(key), F.col("n").alias(f"{x}n"), F.col("counts").alias(f"{x}c"))

    def may_link(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = batch.column("xc"), batch.column("yc")
                sizes = batch.column("xn").to_numpy() + batch.column("yn").to_numpy()
                groups, may = np.minimum(widths(x), widths(y)), np.zeros(batch.num_rows, bool)
                for g in np.unique(groups):
                    for at in pieces(np.flatnonzero(groups == g), BUNDLE_COUNTS // int(g)):
                        shared = np.minimum(*(count_vectors(c.take(pa.array(at)), int(g)) for c in (x, y))).sum(1, dtype=np.int64)
                        may[at] = shared * (100 + percent) >= percent * sizes[at]
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(may)) for c in batch.columns[:2]], names=["a", "b"])

    near = pairs.join(side("x", "a"), "a").join(side("y", "b"), "b")
    near = near.filter((F.col("xn") * percent <= F.col("yn") * 100) & (F.col("yn") * percent <= F.col("xn") * 100)).select("a", "b", "xn", "yn", "xc", "yc")
    return near.mapInArrow(may_link, "a long, b long")


def narrow(vectors: DataFrame) -> DataFrame:
    """``vectors`` (node, n, counts) folded to ``GROUPS`` groups."""

    def fold(batches):
        for batch in batches:
            for at in pieces(np.arange(batch.num_rows), BUNDLE_COUNTS // GROUPS):
                part = batch.slice(at[0], len(at))
                counts = np.minimum(count_vectors(part.column("counts"), GROUPS), FULL).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([part.column("node"), part.column("n"), pa.array([c.tobytes() for c in counts], pa.binary())], names=["node", "n", "counts"])

    return vectors.select("node", "n", "counts").mapInArrow(fold, "node long, n long, counts binary")


def verified(pairs: DataFrame, sets: Sets, threshold: Threshold) -> DataFrame:
    """a, b of the pairs of nodes that are linked, by their whole sets."""
    pairs = materialize(pairs, "near")
    whole = sets.column(pairs.select("a").union(pairs.select("b")), "hashes", lambda s: s.astype("<u8").tobytes())

    def linked(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("xh"), batch.column("yh"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                keep.append(threshold.linked(np.intersect1d(x, y, assume_unique=True).size, x.size, y.size))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    side = lambda new, key: whole.select(F.col("node").alias(key), F.col("hashes").alias(new))
    joined = pairs.join(side("xh", "a"), "a").join(side("yh", "b"), "b").select("a", "b", "xh", "yh")
    return materialize(joined.mapInArrow(linked, "a long, b long"), "linked")


def open_cells(cells: DataFrame, parts: DataFrame) -> DataFrame:
    """A written table: cell, node, part of the cells that hold separate parts.  ``cells`` (cell, node),
    ``parts`` (node, part); a node without a part is its own."""
    placed = cells.join(parts, "node", "left").select("cell", "node", F.coalesce("part", "node").alias("part"))
    split = placed.groupBy("cell").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi")
    return materialize(placed.join(split.select("cell"), "cell"), "open")


def bundles(cells: DataFrame, points: DataFrame) -> DataFrame:
    """A written table: leader, node, part, large of the points of ``cells`` (cell, node, part).  A
    bundle is the cells of one smallest point; it is large if one task should not search it."""
    first = cells.groupBy("cell").agg(F.min("node").alias("leader"))
    rows = materialize(cells.join(first, "cell").select("leader", "node", "part").distinct(), "bundles")
    load = rows.join(points.groupBy("node").agg(F.max("n").alias("n")), "node").groupBy("leader").agg(F.count("*").alias("points"), F.sum("n").alias("shingles"))
    large = (F.col("points") > BUNDLE_POINTS) | (F.col("shingles") > BUNDLE_SHINGLES)
    return materialize(rows.join(load.select("leader", large.alias("large")), "leader"), "loads")


def may_link(rows: DataFrame, vectors: DataFrame, percent: int) -> DataFrame:
    """leader, node, part of the points that the packed counts of their bundle let be linked with a
    point of another part."""

    def search(group: pa.Table) -> pa.Table:
        counts = count_vectors(group.column("counts").combine_chunks())
        part, size = group.column("part").to_numpy(), group.column("n").to_numpy()
        tree, keep = CountTree(counts, size), np.zeros(len(part), bool)
        for i in range(len(part)):
            found = tree.search(counts[i], int(size[i]), percent)
            keep[i] = (part[found] != part[i]).any()
        return group.select(["leader", "node", "part"]).filter(pa.array(keep))

    own = rows.join(vectors, "node").select("leader", "node", "part", "n", "counts")
    return own.groupBy("leader").applyInArrow(search, "leader long, node long, part long")


def spanning_links(part: np.ndarray, sets: list[np.ndarray], threshold: Threshold) -> list[tuple[int, int]]:
    """Links (as places) that join the parts of a bundle as far as its sets are linked."""
    size = np.array([len(x) for x in sets], np.int64)
    groups = min(max(1 << int(size.mean()).bit_length(), GROUPS), BUNDLE_GROUPS)
    while groups > GROUPS and groups * len(sets) > BUNDLE_COUNTS:  # fewer groups only let more pairs through to their sets
        groups //= 2
    counts = np.empty((len(sets), groups), np.int32)
    for i, x in enumerate(sets):
        counts[i] = group_counts(x, groups)
    tree, label, links = CountTree(counts, size), np.unique(part, return_inverse=True)[1], []
    for i in range(len(sets)):
        found = tree.search(counts[i], int(size[i]), threshold.percent)
        for j in np.sort(found[(found > i) & (label[found] != label[i])]):
            if label[j] != label[i] and threshold.linked(np.intersect1d(sets[i], sets[j], assume_unique=True).size, size[i], size[j]):
                links.append((i, int(j)))
                label[label == label[j]] = label[i]
    return links


def bundle_links(rows: DataFrame, vectors: DataFrame, sets: Sets, threshold: Threshold) -> DataFrame:
    """a, b: a written table of links that join parts, at most one fewer than a bundle has points."""
    left = materialize(may_link(rows, vectors, threshold.percent), "may")
    whole = sets.column(left.select("node"), "hashes", lambda s: s.astype("<u8").tobytes())

    def search(group: pa.Table) -> pa.Table:
        node = group.column("node").to_numpy()
        own = [np.frombuffer(x.as_buffer(), "<u8") for x in group.column("hashes")]
        links = np.array(spanning_links(group.column("part").to_numpy(), own, threshold), np.int64).reshape(-1, 2)
        return pa.table({"a": node[links[:, 0]], "b": node[links[:, 1]]})

    met = left.join(whole.select("node", "hashes"), "node").select("leader", "node", "part", "hashes")
    return materialize(met.groupBy("leader").applyInArrow(search, "a long, b long"), "linked")


def tree_pairs(cells: DataFrame, vectors: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of a cell whose summed minima may reach the threshold and that are not yet in one
    part.  ``cells``: cell, node, part of cells that hold separate parts."""
    points = cells.groupBy("cell").agg(F.count("*").alias("points"))
    open_ = materialize(cells.join(points, "cell").join(vectors, "node"), "open")
    schema = "a long, b long"

    def search(group: pa.Table, own: np.ndarray) -> pa.Table:
        """Pairs of an own point with another: of its own kind, or else of the other kind."""
        counts = count_vectors(group.column("counts").combine_chunks())
        node, part, size = (group.column(c).to_numpy() for c in ("node", "part", "n"))
        tree_side = np.flatnonzero(~own) if not own.all() else np.arange(len(node))
        tree, a, b = CountTree(counts[tree_side], size[tree_side]), [], []
        for i in np.flatnonzero(own):
            found = tree_side[tree.search(counts[i], int(size[i]), percent)]
            found = found[(part[found] != part[i]) & ((node[found] > node[i]) | ~own[found])]
            a.append(np.minimum(node[found], node[i]))
            b.append(np.maximum(node[found], node[i]))
        none = [np.zeros(0, np.int64)]
        return pa.table({"a": np.concatenate(a or none), "b": np.concatenate(b or none)})

    def search_cell(group: pa.Table) -> pa.Table:
        return search(group, np.ones(group.num_rows, bool))

    def search_tiles(group: pa.Table) -> pa.Table:
        return search(group, group.column("own").to_numpy(zero_copy_only=False))

    columns = ["node", "part", "n", "counts"]
    found = open_.filter(F.col("points") <= CELL_POINTS).select("cell", *columns).groupBy("cell").applyInArrow(search_cell, schema)
    large = open_.filter(F.col("points") > CELL_POINTS)
    if not large.isEmpty():
        # Cut into runs of sizes, each met by itself and by those after it within the threshold's reach.
        rank = F.row_number().over(Window.partitionBy("cell").orderBy("n", "node")) - 1
        tiled = materialize(large.select("cell", F.floor(rank / CELL_POINTS).cast("long").alias("tile"), *columns), "tiles")
        spans = tiled.groupBy("cell", "tile").agg(F.min("n").alias("least"), F.max("n").alias("most"))
        left, right = spans.toDF("cell", "i", "il", "im"), spans.toDF("cell", "j", "jl", "jm")
        meet = left.join(right, "cell").filter((F.col("i") <= F.col("j")) & (F.col("jl") * percent <= F.col("im") * 100)).select("cell", "i", "j")
        one = tiled.withColumnRenamed("tile", "i").join(meet, ["cell", "i"]).select("cell", "i", "j", F.lit(True).alias("own"), *columns)
        two = tiled.withColumnRenamed("tile", "j").join(meet.filter("i < j"), ["cell", "j"]).select("cell", "i", "j", F.lit(False).alias("own"), *columns)
        found = found.unionByName(one.unionByName(two).groupBy("cell", "i", "j").applyInArrow(search_tiles, schema))
    return found.distinct()


def jaccard_components(docs: DataFrame, words: int, percent: int, *, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    threshold = Threshold(percent)
    docs = texts(docs, id_col, text_col)
    named = materialize(document_sets(docs, words), "sets")
    filled = named.filter("n > 0 and doc_id is not null")
    points = materialize(filled.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("node")), "points")
    # Rows of one id are one document: its sets' nodes hang on it.
    repeated = filled.groupBy("doc_id").agg(F.min("s1").alias("lo"), F.max("s1").alias("hi")).filter("lo < hi").select("doc_id")
    several = filled.join(repeated, "doc_id").join(points, ["s1", "s2", "n"]).select(F.col("doc_id").alias("a"), F.col("node").alias("b"))

    rows = cell_rows(docs.filter("doc_id is not null"), words, threshold)
    members = materialize(shared_cells(rows, points), "members")
    # The same points often meet in many cells: of cells with the same members one is enough.
    mark = lambda seed: F.bit_xor(F.xxhash64("node", F.lit(seed)))
    alike = members.groupBy("cell").agg(mark(1).alias("m1"), mark(2).alias("m2"), F.count("*").alias("points"), F.min("node").alias("leader"))
    chosen = alike.groupBy("m1", "m2", "points", "leader").agg(F.min("cell").alias("cell")).filter("points > 1")
    cells = materialize(members.join(chosen.select("cell", "leader"), "cell"), "cells")

    sets = Sets(docs, points, words)
    vectors = sets.column(cells.select("node"), "counts", lambda s: count_vector(s, groups_of(len(s))).tobytes())
    hung = cells.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    stars = verified(bounded(hung, vectors, percent), sets, threshold)
    parts = components(stars).select("node", F.col("component").alias("part"))
    apart = open_cells(cells.select("cell", "node"), parts)
    met = bundles(apart, points)
    rest = bundle_links(met.filter("not large"), vectors, sets, threshold)
    large = met.filter("large").select("leader").distinct()
    if not large.isEmpty():
        first = apart.groupBy("cell").agg(F.min("node").alias("leader")).join(large, "leader")
        pairs = tree_pairs(apart.join(first.select("cell"), "cell"), narrow(vectors), percent)
        rest = rest.union(verified(bounded(pairs, vectors, percent), sets, threshold))
    labels = components(stars.union(rest).union(several))

    whole = named.join(points, ["s1", "s2", "n"], "left").join(labels, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return whole.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, words: int, percent: int, *, id_col="doc_id", text_col="text") -> DataFrame:
    """``docs``, all columns, with one document of each component: the one of the smallest id.  Rows
    that repeat that id (or have none) stay."""
    found = jaccard_components(docs, words, percent, id_col=id_col, text_col=text_col)
    return drop_ids(docs, found.filter("component_id <> doc_id").select("doc_id"), id_col)


JACCARD_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
rep AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM sh WHERE len(s) > 0 GROUP BY 1),
x AS (SELECT rep, len(s) AS n, unnest(s) AS s FROM rep),
pairs AS (SELECT a.rep AS a, b.rep AS b FROM x a JOIN x b ON a.s = b.s AND a.rep < b.rep AND b.n * 100 >= a.n * 90 AND a.n * 100 >= b.n * 90
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
sym AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(node, seen) AS (SELECT rep, rep FROM rep UNION SELECT sym.b, reach.seen FROM reach JOIN sym ON sym.a = reach.node WHERE reach.seen < sym.b),
label AS (SELECT node, min(seen) AS c FROM reach GROUP BY 1)
SELECT sh.doc_id, len(sh.s) AS n_shingles, coalesce(label.c, sh.doc_id) AS component_id
FROM sh LEFT JOIN rep ON list_sort(sh.s) = rep.s LEFT JOIN label ON label.node = rep.rep"""
