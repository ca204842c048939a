"""Near-duplicate components by b-bit MinHash.

Each distinct shingle set gets `hashes` minima. Bands of `rows` minima put sets into buckets; the low
`bits` of every minimum, packed in bit planes, are the signature. Sets in one bucket are compared by
signature (bit counts, corrected for the chance that low bits agree by themselves), and those that may
reach the similarity are confirmed on full shingle sets.

No bucket is turned into all its pairs. First every set tries a few of its buckets' pivots (a bucket's
smallest id). Then bucket mates not yet in one component are compared by signature, in cells of bounded
size; components that may be linked become groups. In each group full sets are compared, again in
cells, the likeliest first. From each cell only as many pairs leave as connect what is connected in it,
so what is written grows with the sets, not with their pairs. Equal sets are one node from the start,
however many rows have them.

A pair of exactly the similarity 0.75 shares no bucket with a chance of (1 - 0.75**4)**32 = 5e-6, and is
let go by its signature (five standard deviations below) with one of 3e-7.

Edge cases: null and empty texts, and texts without words, have no shingles and are linked with
nothing. A row without an id is returned with no component and kept. Repeated rows are returned as
often as they come, with one component. Rows that repeat an id with another text are documents of
their own, told apart by a 64-bit hash of the text: each has its own links, and a component_id that
two of them have in common does not say that they are linked (`labelled` does). An empty table gives an empty table. Other columns of the input are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesync.llm import shingles
from tablesync.llm.base import discard, own_name, settled


@dataclass(frozen=True)
class MinHash:
    width: int = 5  # words in a shingle
    percent: int = 75  # least similarity of a link
    hashes: int = 128
    rows: int = 4  # minima in a band
    bits: int = 4  # low bits kept of a minimum
    cutoff: float = 0.55  # estimated similarity from which a pair is confirmed or refuted on full sets
    tries: int = 3  # pivots each set is compared with at first
    cell: int = 512  # sets of one side of a cell

    @property
    def planes(self) -> list[str]:
        return [f"s{i}" for i in range(self.bits * self.hashes // 64)]


def signatures(docs: DataFrame, key: str, text: str, p: MinHash) -> DataFrame:
    """id, mark (a hash of the text), n_shingles, a 128-bit digest of the shingle set (d1, d2), the signature's words, band keys."""
    random = np.random.default_rng(977)
    factor = random.integers(0, 2**32, p.hashes, dtype=np.uint32) | np.uint32(1)
    offset = random.integers(0, 2**32, p.hashes, dtype=np.uint32)
    place = random.integers(0, 2**63, p.hashes, dtype=np.uint64) | np.uint64(1)
    bands = p.hashes // p.rows

    def minima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        high = (values >> np.uint64(32)).astype(np.uint32)
        found = np.empty((len(starts), p.hashes), dtype=np.uint32)
        for j in range(p.hashes):
            found[:, j] = np.minimum.reduceat(high * factor[j] + offset[j], starts)
        return found

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, last, values, at in shingles.shingle_sets(part.column(2), p.width):
                n, sizes = last - first, np.diff(at)
                full = np.flatnonzero(sizes)
                digest = np.zeros((n, 2), dtype=np.uint64)
                planes = np.zeros((n, len(p.planes)), dtype=np.int64)
                keys = np.zeros((n, bands), dtype=np.int64)
                if len(full):
                    starts = at[:-1][full]
                    digest[full, 0] = np.add.reduceat(values, starts)
                    digest[full, 1] = np.add.reduceat(shingles.mix(values + np.uint64(1)), starts)
                    low = minima(values, starts)
                    mixed = shingles.mix(low.astype(np.uint64) * place).reshape(len(full), bands, p.rows).sum(axis=2, dtype=np.uint64)
                    keys[full] = shingles.mix(mixed + np.arange(bands, dtype=np.uint64)).view(np.int64)
                    packed = [np.packbits((low >> np.uint32(b)) & np.uint32(1), axis=1) for b in range(p.bits)]
                    planes[full] = np.ascontiguousarray(np.concatenate(packed, axis=1)).view(np.int64)
                has = np.where(sizes > 0, bands, 0)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).slice(first, n), part.column(1).slice(first, n), pa.array(sizes, pa.int64()),
                    pa.array(digest[:, 0].view(np.int64)), pa.array(digest[:, 1].view(np.int64)),
                    *[pa.array(planes[:, i]) for i in range(planes.shape[1])],
                    pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(has))), pa.int32()), pa.array(keys[full].ravel())),
                ], ["id", "mark", "n_shingles", "d1", "d2", *p.planes, "bands"])

    used = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    words = ", ".join(f"{c} bigint" for c in p.planes)
    return used.mapInArrow(run, f"id bigint, mark bigint, n_shingles bigint, d1 bigint, d2 bigint, {words}, bands array<bigint>")


def _estimate(p: MinHash, a: str, b: str):
    """Similarity estimated from the share of minima whose low bits agree, less those that agree by chance."""
    words = len(p.planes) // p.bits
    differ = sum((
        F.bit_count(F.expr(" | ".join(f"({a}.s{i + k * words} ^ {b}.s{i + k * words})" for k in range(p.bits))))
        for i in range(words)), F.lit(0))
    chance = 2.0**-p.bits
    return ((1 - differ / p.hashes) - chance) / (1 - chance)


def _close(p: MinHash, a: str, b: str):
    """Whether the sizes of two sets allow the similarity at all."""
    return (100 * F.least(F.col(f"{a}.n"), F.col(f"{b}.n"))) >= p.percent * F.greatest(F.col(f"{a}.n"), F.col(f"{b}.n"))


def confirmed(pairs: DataFrame, texts: DataFrame, p: MinHash) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have the similarity."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sets = []
            for column in (2, 3):
                sets.append([v[s:e] for _, _, v, at in shingles.shingle_sets(part.column(column), p.width) for s, e in zip(at[:-1], at[1:])])
            keep = [_linked(x, y, p) for x, y in zip(*sets)]
            yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    sides = [texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}")) for c in ("a", "b")]
    rows = pairs.select("a", "b").join(sides[1], "b").join(sides[0], "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(run, "a bigint, b bigint")


def connected(pairs: DataFrame) -> DataFrame:
    """id and label of every node of the pairs (a, b); the label is the smallest id of its component.

    In each step a node joins its smallest neighbour, and edges go on between the joined nodes only, so
    nodes at least halve and edges melt away. Hubs are met by partial minima only.
    """
    edges = settled(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    labels = settled(edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().withColumn("label", F.col("id")), "labels")
    while not edges.isEmpty():
        # Of each edge the larger node learns of the smaller one; nodes that learn of none stay.
        up = settled(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("near")), "parents")
        top = up.select(F.col("node").alias("near"), F.col("near").alias("far"))
        up = settled(up.join(top, "near", "left").select("node", F.coalesce("far", "near").alias("up")), "parents")
        of = lambda c: up.select(F.col("node").alias(c), F.col("up").alias(f"up_{c}"))
        moved = edges.join(of("a"), "a", "left").join(of("b"), "b").select(F.coalesce("up_a", "a").alias("x"), F.col("up_b").alias("y"))
        after = settled(moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        found = labels.join(up.withColumnRenamed("node", "label"), "label", "left").select("id", F.coalesce("up", "label").alias("label"))
        found = settled(found, "labels")
        discard(edges, labels, up)
        edges, labels = after, found
    return labels


def _groups(parts: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first `keys` columns, of batches sorted by them."""
    rest: list[pa.RecordBatch] = []
    last = None
    for part in parts:
        if not part.num_rows:
            continue
        rows = np.column_stack([c.to_numpy() for c in part.columns[:keys]])
        cuts = [0, *(np.flatnonzero((rows[1:] != rows[:-1]).any(axis=1)) + 1).tolist(), len(rows)]
        for a, z in zip(cuts[:-1], cuts[1:]):
            if rest and (rows[a] != last).any():
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(part.slice(a, z - a))
            last = rows[a]
    if rest:
        yield pa.Table.from_batches(rest)


def _forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """As many of the pairs as connect what all of them connect."""
    parent: dict[int, int] = {}
    kept = []
    for a, b in pairs.tolist():
        x, y = _root(parent, a), _root(parent, b)
        if x != y:
            parent[y] = x
            kept.append((a, b))
    return kept


def _root(parent: dict[int, int], x: int) -> int:
    while (up := parent.get(x, x)) != x:
        parent[x] = parent.get(up, up)
        x = up
    return x


def _cells(members: DataFrame, group: str, p: MinHash) -> DataFrame:
    """Rows (group, id, label) dealt to cells (group, column, line) of bounded size.

    In a cell, rows of side 1, outside the group's largest component, meet rows of side 0. Together the
    cells of a group bring each row outside together with every other row.
    """
    counts = members.groupBy(group, "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = counts.groupBy(group).agg(
        F.sum("n").alias("all"), (F.sum("n") - F.max("n")).alias("outside"), F.max_by("label", "n").alias("main")).filter("outside > 0")
    blocks = lambda n: F.ceil(F.col(n) / p.cell).cast("long")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    rows = members.join(mixed, group).withColumns({"columns": blocks("all"), "lines": blocks("outside"), "out": F.col("label") != F.col("main")})
    rows = rows.withColumns({"column": F.pmod(F.xxhash64("id", F.lit(1)), F.col("columns")), "line": F.pmod(F.xxhash64("id", F.lit(2)), F.col("lines"))})
    kept = [group, "column", "line", "side", "id", "label"]
    every = rows.withColumn("line", upto("lines")).withColumn("side", F.lit(0).cast("long"))
    outside = rows.filter("out").withColumn("column", upto("columns")).withColumn("side", F.lit(1).cast("long"))
    return every.select(kept).union(outside.select(kept))


def _likeness(p: MinHash, x: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated similarities of rows (label, n, signature); -1 in one component or where sizes forbid a link."""
    words, chance = len(p.planes) // p.bits, 2.0**-p.bits
    differ = np.zeros((len(x), len(others)), dtype=np.int64)
    for w in range(words):
        differing = np.zeros((len(x), len(others)), dtype=np.int64)
        for k in range(p.bits):
            plane = 2 + w + k * words
            differing |= x[:, plane, None] ^ others[None, :, plane]
        differ += np.bitwise_count(differing)
    like = ((1 - differ / p.hashes) - chance) / (1 - chance)
    least, most = np.minimum(x[:, 1, None], others[:, 1]), np.maximum(x[:, 1, None], others[:, 1])
    like[(x[:, 0, None] == others[:, 0]) | (100 * least < p.percent * most)] = -1
    return like


def _likely(p: MinHash, cell: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of side 1, rows of side 0, estimates) of a cell's pairs that may reach the similarity."""
    side = cell.column("side").to_numpy()
    rows = np.column_stack([cell.column(c).to_numpy() for c in ("label", "n", *p.planes)])
    out, others = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
    for i in range(0, len(out), 64):
        like = _likeness(p, rows[out[i : i + 64]], rows[others])
        a, b = np.nonzero(like >= p.cutoff)
        yield out[i : i + 64][a], others[b], like[a, b]


def _pairs(parts: Iterator[list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int]] = []
    for found in parts:
        held += found
        if len(held) >= 50_000:
            yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], pa.int64()) for i in (0, 1)], ["a", "b"])
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], pa.int64()) for i in (0, 1)], ["a", "b"])


def likely_components(members: DataFrame, nodes: DataFrame, p: MinHash) -> DataFrame:
    """Pairs of components (a, b) with bucket mates whose signatures allow the similarity.

    Per cell only as many pairs as connect all such components of the cell.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(cell: pa.Table) -> list[tuple[int, int]]:
            label = cell.column("label").to_numpy()
            pairs = [np.column_stack((label[x], label[y])) for x, y, _ in _likely(p, cell) if len(x)]
            return _forest(np.unique(np.concatenate(pairs), axis=0)) if pairs else []

        yield from _pairs(found(cell) for cell in _groups(parts, 3))

    cells = _cells(members, "bucket", p).join(nodes.select("id", "n", *p.planes), "id").select("bucket", "column", "line", "side", "label", "n", *p.planes)
    return cells.repartition("bucket", "column", "line").sortWithinPartitions("bucket", "column", "line").mapInArrow(run, "a bigint, b bigint").distinct()


def links_between(groups: DataFrame, nodes: DataFrame, texts: DataFrame, p: MinHash) -> DataFrame:
    """Links (a, b) between components of one group, confirmed on full shingle sets.

    Per cell only as many links as connect all that are linked in the cell; the likeliest pairs are
    tried first, and pairs that are connected by then are not tried.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(cell: pa.Table) -> list[tuple[int, int]]:
            likely = list(_likely(p, cell))
            x, y, like = (np.concatenate([f[i] for f in likely]) for i in range(3)) if likely else ([], [], [])
            if not len(x):
                return []
            ids, label = cell.column("id").to_numpy(), cell.column("label").to_numpy()
            used = np.unique(np.concatenate((x, y)))
            text = cell.column("text").combine_chunks().take(pa.array(used))
            sets = dict(zip(used.tolist(), (v[s:e] for _, _, v, at in shingles.shingle_sets(text, p.width) for s, e in zip(at[:-1], at[1:]))))
            parent: dict[int, int] = {}
            kept = []
            for k in np.lexsort((y, x, -like)).tolist():
                i, j = int(x[k]), int(y[k])
                a, b = _root(parent, int(label[i])), _root(parent, int(label[j]))
                if a != b and _linked(sets[i], sets[j], p):
                    parent[b] = a
                    kept.append((int(ids[i]), int(ids[j])))
            return kept

        yield from _pairs(found(cell) for cell in _groups(parts, 3))

    cells = _cells(groups, "group", p).join(nodes.select("id", "n", *p.planes), "id").join(texts, "id")
    cells = cells.select("group", "column", "line", "side", "id", "label", "n", *p.planes, "text")
    return cells.repartition("group", "column", "line").sortWithinPartitions("group", "column", "line").mapInArrow(run, "a bigint, b bigint")


def _linked(x: np.ndarray, y: np.ndarray, p: MinHash) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= p.percent * (len(x) + len(y) - both)


def labelled(docs: DataFrame, key: str, text: str, p: MinHash = MinHash()) -> DataFrame:
    """Per row: id, mark (a hash of its text), n_shingles, label (of its component) and component_id.

    Two rows are in one component if they have one label; component_id is the smallest id of a label's rows.
    Rows without shingles or without an id have no label.
    """
    rows = settled(signatures(docs, key, text, p).withColumn("row", F.monotonically_increasing_id()), "minhash-signatures")
    full = rows.filter("n_shingles > 0 AND id IS NOT NULL")
    # A node is a distinct shingle set; the number of one of its rows names it, whatever ids its rows have.
    classes = full.groupBy("d1", "d2", "n_shingles").agg(F.min("row").alias("node"), F.min("id").alias("least"))
    first = full.join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    nodes = settled(first.select(F.col("row").alias("id"), F.col("id").alias("of"), "mark", F.col("n_shingles").alias("n"), *p.planes, "bands"), "minhash-nodes")

    placed = nodes.select("id", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).filter("pivot < last")
    members = settled(placed.join(shared.select("bucket", "pivot"), "bucket"), "minhash-buckets")

    # Every set against the few pivots with which it shares most buckets.
    tried = members.filter("id <> pivot").groupBy(F.col("pivot").alias("a"), F.col("id").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    most = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("shared"), "a"))
    tried = tried.withColumn("rank", most).filter(F.col("rank") <= p.tries).select("a", "b")
    x, y = nodes.select(F.col("id").alias("a"), "n", *p.planes).alias("x"), nodes.select(F.col("id").alias("b"), "n", *p.planes).alias("y")
    likely = tried.join(y, "b").join(x, "a").filter(_close(p, "x", "y") & (_estimate(p, "x", "y") >= p.cutoff)).select("a", "b")
    # One text per node, however often its row is repeated.
    named = nodes.join(members.select("id").distinct(), "id", "left_semi").select("id", "of", "mark")
    texts = docs.select(F.col(key).cast("long").alias("of"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    texts = settled(texts.join(named, ["of", "mark"]).select("id", "text").dropDuplicates(["id"]), "minhash-texts")
    labels = connected(settled(confirmed(likely, texts, p), "minhash-links"))

    # What is not in one component yet: components that may be linked form groups, and the links in each
    # group are found on full sets.
    label = F.coalesce("label", "id").alias("label")
    open_members = settled(members.select("bucket", "id").join(labels, "id", "left").select("bucket", "id", label), "minhash-open")
    likely = settled(likely_components(open_members, nodes, p), "minhash-likely")
    groups = connected(likely).select(F.col("id").alias("label"), F.col("label").alias("group"))
    in_groups = settled(open_members.select("id", "label").distinct().join(groups, "label"), "minhash-groups")
    links = settled(links_between(in_groups, nodes, texts, p), "minhash-links")
    # A link joins the components of its ends.
    of = lambda c: in_groups.select(F.col("id").alias(c), F.col("label").alias(f"label_{c}"))
    joined = links.join(of("a"), "a").join(of("b"), "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    merged = connected(joined).select(F.col("id").alias("label"), F.col("label").alias("merged"))
    ids = open_members.select("id", "label").distinct().join(merged, "label", "left")
    labels = settled(ids.select("id", F.coalesce("merged", "label").alias("label")), "minhash-labels")

    known = classes.join(labels.withColumnRenamed("id", "node"), "node", "left").select("d1", "d2", "n_shingles", F.coalesce("label", "node").alias("label"), "least")
    known = settled(known, "minhash-classes")
    smallest = known.groupBy("label").agg(F.min("least").alias("component_id"))
    known = known.join(smallest, "label").select("d1", "d2", "n_shingles", "label", "component_id")
    discard(texts, members, open_members, in_groups, nodes)
    kept = ["id", "mark", "n_shingles", "label", "component_id"]
    alone = rows.filter("n_shingles = 0 OR id IS NULL").select("id", "mark", "n_shingles", F.lit(None).cast("long").alias("label"), F.col("id").alias("component_id"))
    return full.select("id", "mark", "n_shingles", "d1", "d2").join(known, ["d1", "d2", "n_shingles"], "left").select(kept).union(alone)


def components(docs: DataFrame, key: str, text: str, p: MinHash = MinHash()) -> DataFrame:
    """Per row: key, n_shingles, component_id (the smallest key reachable over links), kept (key = component_id)."""
    return labelled(docs, key, text, p).select(
        F.col("id").alias(key), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, key: str, text: str, p: MinHash = MinHash()) -> DataFrame:
    """Of each component the row of the smallest key (then hash of the text), and all rows that are in none.

    Rows that repeat key and text stay once, rows that repeat a key with other texts are judged by their own
    text, and rows without a key all stay.
    """
    rows = settled(labelled(docs, key, text, p).select("id", "mark", "label", "component_id"), "minhash-rows")
    heads = rows.filter("id = component_id")
    several = heads.groupBy("label").agg(F.min("mark").alias("best"), F.max("mark").alias("last")).filter("best < last")
    gone = rows.filter("id <> component_id").select("id", "mark").union(heads.join(several, "label").filter("mark <> best").select("id", "mark"))
    at, mark = own_name("id"), own_name("mark")
    gone = gone.distinct().withColumnsRenamed({"id": at, "mark": mark})
    named = docs.filter(F.col(f"`{key}`").isNotNull()).withColumns({at: F.col(f"`{key}`").cast("long"), mark: F.xxhash64(F.col(f"`{text}`"))})
    kept = named.join(gone, [at, mark], "left_anti").dropDuplicates([at, mark])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns]).union(docs.filter(F.col(f"`{key}`").isNull()))
