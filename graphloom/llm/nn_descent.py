"""Near-duplicate vectors by NN-descent.

A graph of near neighbours is begun with a forest of random hyperplanes and refined: the neighbours of a vector, and
the vectors it is a neighbour of, are compared with each other, and who finds a nearer one takes it into the list. The
lists are searched with vectors rounded to bytes; links are kept by the exact cosine. A list whose entries all are
links is saturated: it is enlarged to all links within its component, counted in blocks, without a row per pair. An
audit compares a fixed set of vectors with all others; while it misses links, more trees are planted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import BROADCAST_ROWS, components, sized_broadcast, stored

THRESHOLD = 0.95
#: Neighbours in a list, and vectors a vector is told of that have it in their lists.
NEIGHBOURS = 8
#: Nearest others that a leaf or a neighbourhood proposes to each of its members.
PROPOSED = 4
#: Vectors of a leaf: on average, and at most; a larger leaf is cut in the order of the hyperplanes beyond its own.
LEAF, LARGEST_LEAF = 48, 256
#: Hyperplanes of a tree.
PLANES = 32
#: Trees planted first, and the most; the audit decides.
TREES, MOST_TREES = 8, 64
#: How much rounding to bytes may take from a cosine near the threshold.
MARGIN = 0.03
#: A round that adds at most this share of new links is the last.
STILL = 0.001
#: Vectors compared with all others by the audit, and the share of their links that must have been found.
AUDITED, ENOUGH = 256, 0.95
#: Rows of the blocks in which saturated components are compared.
BLOCK_ROWS, BLOCK_COLUMNS = 512, 2048

_PAIRS = "v long, u long, s float"


def _pairs(v: np.ndarray, u: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(v, pa.int64()), pa.array(u, pa.int64()), pa.array(s.astype(np.float32))], names=["v", "u", "s"])


def _matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(dtype, copy=False)


def _units(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that tiny and huge entries keep their direction."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _bytes_units(column: pa.Array) -> np.ndarray:
    """Vectors rounded to bytes, made units again."""
    size = len(column[0].as_py())
    q = np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(-1, size).astype(np.float32)
    return q / np.linalg.norm(q, axis=1, keepdims=True)


# -- the first graph ----------------------------------------------------------------------------
def _nearest_in(v: np.ndarray, z: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each vector its ``most`` nearest others of a leaf."""
    s = z @ z.T
    np.fill_diagonal(s, -2.0)
    most = min(most, len(v) - 1)
    near = np.argpartition(-s, most - 1, axis=1)[:, :most]
    at = np.repeat(np.arange(len(v)), most)
    return v[at], v[near.ravel()], s[at, near.ravel()]


def forest(vecs: DataFrame, n: int, trees: range, width: int) -> DataFrame:
    """(v, u, s): near vectors found in the leaves of the trees; a leaf is a run of vectors on the same sides."""
    depth = min(PLANES, max(1, math.ceil(math.log2(max(2, n) / LEAF)))) if n > LEAF else 0

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = [np.random.default_rng((7, t)).standard_normal((width, PLANES)).astype(np.float32) for t in trees]
        powers = 1 << np.arange(PLANES - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                z = _bytes_units(batch.column(1))
                for t, p in zip(trees, planes):
                    code = ((z @ p) > 0) @ powers
                    yield pa.record_batch(
                        [pa.array(np.full(len(z), t, np.int32)), pa.array(code), batch.column(0), batch.column(1)], names=["tree", "code", "v", "q"]
                    )

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            tree, code = table["tree"].to_numpy(), table["code"].to_numpy() >> (PLANES - depth)
            v, z = table["v"].to_numpy(), _bytes_units(table["q"].combine_chunks())
            starts = np.flatnonzero(np.r_[True, (tree[1:] != tree[:-1]) | (code[1:] != code[:-1])])
            found = []
            for a, b in zip(starts, np.r_[starts[1:], len(v)]):
                for c in range(a, b, LARGEST_LEAF):
                    d = min(b, c + LARGEST_LEAF)
                    c = max(a, d - LARGEST_LEAF) if d == b else c  # the last cut reaches back
                    if d - c > 1:
                        found.append(_nearest_in(v[c:d], z[c:d], PROPOSED))
            if found:
                yield _pairs(*[np.concatenate(x) for x in zip(*found)])

        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if rows >= 8 * LARGEST_LEAF:  # close at a change of leaf, if this batch has one
                tree, code = batch["tree"].to_numpy(), batch["code"].to_numpy() >> (PLANES - depth)
                before = held[-1]
                same = (tree == before["tree"][-1].as_py()) & (code == before["code"][-1].as_py() >> (PLANES - depth))
                cut = len(same) if same.all() else int(np.argmin(same))
                if cut == len(same) and rows < 64 * LARGEST_LEAF:
                    held.append(batch)
                    rows += batch.num_rows
                    continue
                held.append(batch.slice(0, cut))
                yield from finish()
                batch, rows = batch.slice(cut), 0
                if not batch.num_rows:
                    continue
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield from finish()

    coded_rows = vecs.select("v", "q").mapInArrow(coded, "tree int, code long, v long, q binary")
    parts = int(vecs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = coded_rows.repartitionByRange(parts, "tree", "code", "v").sortWithinPartitions("tree", "code", "v")
    return runs.mapInArrow(leaves, _PAIRS)


def nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each list (v, u, s, fresh); a pair found several times is fresh if it always was."""
    once = pairs.repartition("v").groupBy("v", "u").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("s"), "u"))
    return once.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


# -- neighbours of neighbours -------------------------------------------------------------------
def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows as tables of whole groups of the first column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = batch.column(0).to_numpy()
        cut = int(np.flatnonzero(last == last[-1])[0])
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        elif held and held[-1].column(0)[-1].as_py() != last[0]:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _introduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each neighbourhood proposed to each other, where one is fresh and one would take the other."""
    for table in _groups(batches):
        at, x = table["at"].to_numpy(), table["x"].to_numpy()
        fresh, floor = table["fresh"].to_numpy(zero_copy_only=False), table["floor"].to_numpy()
        z = _bytes_units(table["q"].combine_chunks())
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        sizes = np.diff(np.r_[starts, len(at)])
        width = int(sizes.max())
        step = max(1, 2_000_000 // (width * z.shape[1]))
        for g in range(0, len(starts), step):
            place = starts[g : g + step, None] + np.arange(width)
            there = np.arange(width) < sizes[g : g + step, None]
            place = np.where(there, place, 0)
            m = z[place]
            s = m @ m.transpose(0, 2, 1)
            names, new = x[place], fresh[place] & there
            usable = there[:, :, None] & there[:, None, :] & (names[:, :, None] != names[:, None, :])
            usable &= (new[:, :, None] | new[:, None, :]) & (s > floor[place][:, :, None])
            s = np.where(usable, s, -2.0)
            most = min(PROPOSED, width)
            near = np.argpartition(-s, most - 1, axis=2)[:, :, :most]
            best = np.take_along_axis(s, near, axis=2)
            i, j, k = np.nonzero(best > -2.0)
            if len(i):
                v, u, found = names[i, j], names[i, near[i, j, k]], best[i, j, k]
                _, once = np.unique(np.stack([v, u]), axis=1, return_index=True)
                yield _pairs(v[once], u[once], found[once])


def refined(vecs: DataFrame, graph: DataFrame, k: int) -> DataFrame:
    """One round: the graph with what neighbours of neighbours add to it."""
    back = graph.select(F.col("u").alias("at"), F.col("v").alias("x"), "fresh")
    order = F.xxhash64("at", "x")
    told = back.withColumn("_r", F.row_number().over(Window.partitionBy("at").orderBy(order))).where(F.col("_r") <= k).drop("_r")
    members = graph.select(F.col("v").alias("at"), F.col("u").alias("x"), "fresh").union(told)
    floors = graph.groupBy(F.col("v").alias("w")).agg(F.when(F.count(F.lit(1)) >= k, F.min("s")).alias("floor"))
    known = vecs.select("v", "q").join(floors, F.col("v") == F.col("w"), "left")
    known = known.select(F.col("v").alias("w"), "q", F.coalesce("floor", F.lit(-1.0).cast("float")).alias("floor"))
    active = members.groupBy("at", "x").agg(F.max("fresh").alias("fresh"))
    with_vectors = active.join(known, F.col("x") == F.col("w")).select("at", "x", "fresh", "floor", "q")
    groups = with_vectors.repartition("at").sortWithinPartitions("at", "x")
    proposals = groups.mapInArrow(_introduced, _PAIRS).withColumn("fresh", F.lit(True))
    return nearest(graph.withColumn("fresh", F.lit(False)).unionByName(proposals), k)


def neighbour_graph(vecs: DataFrame, n: int, width: int, trees: range, graph: DataFrame | None = None, k: int = NEIGHBOURS) -> DataFrame:
    """(v, u, s): the refined lists. The driver sees the number of likely links of each round only."""
    planted = forest(vecs, n, trees, width).withColumn("fresh", F.lit(True))
    if graph is not None:
        planted = planted.unionByName(graph.withColumn("fresh", F.lit(False)))
    graph = stored(nearest(planted, k), "neighbours")
    likely = F.col("s") >= THRESHOLD - MARGIN
    while True:
        graph = stored(refined(vecs, graph, k), "neighbours")
        found = graph.agg(F.count(F.when(likely, 1)).alias("all"), F.count(F.when(likely & F.col("fresh"), 1)).alias("new")).first()
        if found["new"] <= STILL * found["all"]:
            return graph


# -- links --------------------------------------------------------------------------------------
def exact_links(vecs: DataFrame, graph: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b: the likely pairs whose exact cosine reaches the threshold."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _units(_matrix(batch.column(2))), _units(_matrix(batch.column(3)))
                near = np.einsum("ij,ij->i", x, y) >= threshold
                yield pa.record_batch(batch.columns[:2], names=["a", "b"]).filter(pa.array(near))

    pairs = graph.where(F.col("s") >= threshold - MARGIN).select(F.least("v", "u").alias("a"), F.greatest("v", "u").alias("b")).distinct()
    left = vecs.select(F.col("v").alias("a"), F.col("embedding").alias("x"))
    right = vecs.select(F.col("v").alias("b"), F.col("embedding").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(judged, "a long, b long")


def _centres(members: DataFrame) -> DataFrame:
    """(c, centre): the direction in the middle of each component, added up before anything is shuffled."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = _units(_matrix(batch.column(1)))
                names, at = np.unique(batch.column(0).to_numpy(), return_inverse=True)
                sums = np.zeros((len(names), z.shape[1]))
                np.add.at(sums, at, z)
                i = np.tile(np.arange(z.shape[1], dtype=np.int32), len(names))
                yield pa.record_batch([pa.array(np.repeat(names, z.shape[1])), pa.array(i), pa.array(sums.ravel())], names=["c", "i", "e"])

    parts = members.select("c", "embedding").mapInArrow(added, "c long, i int, e double")
    sums = parts.groupBy("c", "i").agg(F.sum("e").alias("e"))
    return sums.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("i", "e")))["e"].alias("centre"))


def component_links(members: DataFrame, threshold: float, width: int) -> DataFrame:
    """(v, m): to how many vectors of other classes each member of a saturated component (c, v, n, embedding) is linked.

    Two members within half the threshold's angle of the centre are linked. The others, the outer ones, are compared
    with all members in blocks, inside tasks; nothing is emitted but counts.
    """
    angle = math.acos(threshold)
    centres = stored(_centres(members), "centres")
    count = centres.count()
    centres = F.broadcast(centres) if count * width <= 8 * BROADCAST_ROWS else centres

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _matrix(batch.column(3)), _matrix(batch.column(4))
                norm = np.linalg.norm(y, axis=1)
                cosine = np.einsum("ij,ij->i", _units(x), y) / np.where(norm > 0, norm, 1.0)
                inner = (norm > 0) & (np.arccos(np.clip(cosine, -1.0, 1.0)) <= angle / 2 - 1e-6)
                yield pa.record_batch([*batch.columns[:4], pa.array(inner)], names=["c", "v", "n", "embedding", "inner"])

    placed = members.join(centres, "c").select("c", "v", "n", "embedding", "centre")
    placed = stored(placed.mapInArrow(angles, "c long, v long, n long, embedding array<double>, inner boolean"), "members")
    sizes = placed.groupBy("c").agg(
        F.count(F.when(~F.col("inner"), 1)).alias("outer"), F.count(F.lit(1)).alias("size"), F.sum(F.when(F.col("inner"), F.col("n"))).alias("inside")
    )
    sizes = sizes.withColumn("row_blocks", F.ceil(F.col("outer") / BLOCK_ROWS)).withColumn("column_blocks", F.ceil(F.col("size") / BLOCK_COLUMNS))
    sizes = stored(sizes, "sizes")
    sizes = sized_broadcast(sizes, count)
    implied = placed.where("inner").join(sizes, "c").select("v", (F.col("inside") - F.col("n")).alias("m"))

    outer = sizes.where("outer > 0")
    known = placed.join(outer, "c")
    block = lambda blocks: F.pmod(F.xxhash64("v"), F.col(blocks))
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    rows = known.where("not inner").select("c", "v", "n", "embedding", block("row_blocks").alias("i"), every("column_blocks").alias("j"))
    columns = known.select(
        F.col("c").alias("c_"), F.col("v").alias("v"), F.col("n").alias("n"), F.col("embedding").alias("embedding"), "inner",
        block("column_blocks").alias("j_"), every("row_blocks").alias("i_"),
    )

    def compared(rows: pd.DataFrame, columns: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(columns):
            return pd.DataFrame({"v": pd.Series(dtype="int64"), "m": pd.Series(dtype="int64")})
        x, y = _units(np.stack(rows["embedding"].to_numpy())), _units(np.stack(columns["embedding"].to_numpy()))
        a, b = rows["v"].to_numpy(), columns["v"].to_numpy()
        near = (x @ y.T >= threshold) & (a[:, None] != b[None, :])
        inner = columns["inner"].to_numpy(bool)
        return pd.DataFrame(
            {"v": np.r_[a, b[inner]], "m": np.r_[near @ columns["n"].to_numpy(), (near.T @ rows["n"].to_numpy())[inner]].astype("int64")}
        )

    facing = rows.groupBy("c", "i", "j").cogroup(columns.groupBy("c_", "i_", "j_"))
    counts = facing.applyInPandas(lambda r, c: compared(r, c), "v long, m long")
    return implied.unionByName(counts).groupBy("v").agg(F.sum("m").alias("m"))


def audit(vecs: DataFrame, linked: DataFrame, threshold: float) -> float:
    """The share of the links of ``AUDITED`` vectors, chosen by hash, that are found. 1 where they have none."""
    asked = vecs.select("v", "embedding", F.xxhash64("v").alias("h")).orderBy("h", "v").limit(AUDITED).drop("h")
    asked = asked.join(linked, "v", "left").select("v", "embedding", F.coalesce("m", F.lit(0)).alias("m")).collect()  # AUDITED rows
    if not asked:
        return 1.0
    held = vecs.sparkSession.sparkContext.broadcast((np.array([r.v for r in asked]), _units(np.array([r.embedding for r in asked], float))))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, z = held.value
        total = np.zeros(len(names), np.int64)
        for batch in batches:
            if batch.num_rows:
                near = (_units(_matrix(batch.column(2))) @ z.T >= threshold) & (batch.column(0).to_numpy()[:, None] != names[None, :])
                total += batch.column(1).to_numpy() @ near
        yield pa.record_batch([pa.array(names), pa.array(total)], names=["v", "m"])

    true = vecs.select("v", "n", "embedding").mapInArrow(counted, "v long, m long").groupBy("v").agg(F.sum("m").alias("m"))
    there = {r.v: r.m for r in true.collect()}  # AUDITED rows
    links = sum(there.values())
    return sum(min(r.m, there[r.v]) for r in asked) / links if links else 1.0


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Each vector with the number of vectors it is linked with and its component.

    Reads the id and the vector; other columns are ignored. Vectors are linked when the cosine of their doubles is at
    least ``threshold``. Vectors that are null, empty, zero, hold null or non-finite entries, or have another length than
    most, are linked with nothing and are their own component. Equal vectors are one vertex and linked with each other;
    repeated rows are vectors of their own. A null id is larger than all others and stays null where a component has no
    other. An empty table gives no rows. Returns vec_id, n_links, component_id, kept, recall (the audit's, one value).
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    usable = F.coalesce(~bad & F.exists("embedding", lambda e: e != 0.0), F.lit(False))
    lengths = rows.where(usable).groupBy(F.size("embedding").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("width")).first()
    width = first.width if first else 0
    usable = usable & (F.size("embedding") == width)

    classes = rows.where(usable).groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    def rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(3))
                q = np.rint(127.0 * (x / np.abs(x).max(axis=1, keepdims=True))).astype(np.int8)
                yield pa.record_batch([*batch.columns, pa.array([r.tobytes() for r in q], pa.binary())], names=["v", "least", "n", "embedding", "q"])

    numbered = classes.select(F.monotonically_increasing_id().alias("v"), "least", "n", "embedding")
    vecs = stored(numbered.mapInArrow(rounded, "v long, least long, n long, embedding array<double>, q binary"), "vectors")
    count = vecs.count()

    graph, planted, trees = None, 0, TREES
    while True:
        graph = neighbour_graph(vecs, count, width, range(planted, trees), graph.drop("fresh") if graph is not None else None)
        linked, labels = _linked(vecs, graph, threshold, width)
        recall = audit(vecs, linked.select("v", "m"), threshold)
        if recall >= ENOUGH or trees >= MOST_TREES:
            break
        planted, trees = trees, 2 * trees

    known = vecs.select("embedding", "least", "n", "v").join(labels, "v", "left").join(linked, "v", "left")
    least = known.groupBy(F.coalesce("c", "v").alias("root")).agg(F.min("least").alias("component_id"))
    known = known.withColumn("root", F.coalesce("c", "v")).join(least, "root").select(
        F.col("embedding").alias("e"), (F.coalesce("m", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    found = rows.where(usable).join(known, F.col("embedding") == F.col("e")).select("vec_id", "n_links", "component_id")
    lone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(lone).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"), F.lit(recall).alias("recall")
    )


def _linked(vecs: DataFrame, graph: DataFrame, threshold: float, width: int) -> tuple[DataFrame, DataFrame]:
    """(v, m), the links of each vector with other classes, and (v, c), the components of more than one class."""
    links = stored(exact_links(vecs, graph, threshold), "links")
    labels = components(links)
    both = links.select("a", "b").union(links.select("b", "a"))
    weights = vecs.select(F.col("v").alias("b"), "n")
    several = both.join(weights, "b").groupBy("a").agg(F.sum("n").alias("m"), F.count(F.lit(1)).alias("others"))
    # a list is saturated when it is full of links
    full = several.where(F.col("others") >= NEIGHBOURS).select(F.col("a").alias("v"))
    saturated = stored(labels.join(full, "v").select("c").distinct(), "saturated")
    some = saturated.count()
    sparse = several.select(F.col("a").alias("v"), "m")
    if not some:
        return stored(sparse, "linked"), labels
    inside = labels.join(sized_broadcast(saturated, some), "c")
    dense = component_links(inside.join(vecs, "v").select("c", "v", "n", "embedding"), threshold, width)
    return stored(sparse.join(inside, "v", "left_anti").unionByName(dense), "linked"), labels
