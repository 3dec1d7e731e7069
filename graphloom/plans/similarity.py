"""Scores of given vertex pairs from their common neighbours: Adamic-Adar (2003) and Jaccard.

Pairs are an input, as in a call for two nodes; they are never made from a vertex's neighbour list. Vertices are dealt
into colours by hash; the lists of neighbours of one colour of first ends and one of second ends meet, packed, with the
pairs between them, and each neighbour of the end with fewer of them is looked up in the other end's list there. So no
row is made for a neighbour that is looked up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.plans.packed import PROBES_AT_ONCE, Keys, Routed, colour, distinct, joined, longs, met, passed_on, sent, spans, starts
from graphloom.plans.projection import degrees
from graphloom.session import written

#: Edges that a task sorts; edges of either side and pairs in one place.
EDGES_PER_TASK, EDGES_PER_PLACE, PAIRS_PER_PLACE = 2_000_000, 3_000_000, 1_000_000
#: Buckets of vertices whose edges are counted before anything is dealt out.
_BUCKETS = 1 << 14
#: Kinds of what meets: lists of either end, their neighbours that are null, and pairs.
_LISTS, _NULLS, _PAIRS = (0, 1), (2, 3), 4


def _common(pairs: DataFrame, edges: DataFrame, weighed: bool) -> DataFrame:
    """``a, b, degree_a, degree_b, common, score`` of each pair without nulls.

    ``common`` counts common neighbours; ``score`` adds up 1 / ln(degree) over them where ``weighed``. The list of a
    vertex with more neighbours than a place holds is cut into slices by the neighbours' hash, whose counts are added up.
    """
    bucket = F.pmod(F.xxhash64("src"), F.lit(_BUCKETS))  # no vertex has more edges than the fullest bucket
    size = degrees(edges.select(bucket.alias("src"))).agg(F.sum("degree").alias("n"), F.max("degree").alias("most")).first()
    parts = max(1, math.ceil((size["n"] or 0) / EDGES_PER_TASK))
    slices = max(1, math.ceil((size["most"] or 0) / EDGES_PER_PLACE))
    pairs = pairs.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).where("a IS NOT NULL AND b IS NOT NULL")
    held = edges.select(F.col("src").cast("bigint"), F.col("dst").cast("bigint")).where("src IS NOT NULL")
    width = 3 if weighed else 2

    def by_end(table: pa.Table) -> Routed:
        src, z = longs(table["src"]), longs(table["dst"])
        yield 0, colour(src, parts) * slices + colour(z, slices), [src, z]

    def null_ends(table: pa.Table) -> Routed:  # they count as neighbours, but no two are the same
        src, n = np.unique(longs(table["src"]), return_counts=True)
        yield 1, colour(src, parts) * slices, [src, n]

    def wanted(table: pa.Table) -> Routed:
        for kind, end in ((2, "a"), (3, "b")):
            ids = distinct(longs(table[end]))
            for s in range(slices):
                yield kind, colour(ids, parts) * slices + s, [ids]

    def by_neighbour(table: pa.Table) -> Routed:
        src, z = longs(table["src"]), longs(table["dst"])
        yield 0, colour(z, parts) * slices + colour(src, slices), [z, src]

    def counted(table: pa.Table) -> Routed:
        ids, n = np.unique(longs(table["src"]), return_counts=True)
        for s in range(slices):
            yield 1, colour(ids, parts) * slices + s, [ids, n]

    def with_degree(place: int, kinds: dict) -> Routed:
        z, src = joined(kinds.get(0), 2)
        ids, n = joined(kinds.get(1), 2)
        ids, at = np.unique(ids, return_inverse=True)
        degree = np.zeros(len(ids) + 1, np.int64)
        np.add.at(degree, at, n)
        where = np.searchsorted(ids, z)
        where[(where == len(ids)) | (np.r_[ids, 0][where] != z)] = len(ids)
        yield 0, colour(src, parts) * slices + colour(z, slices), [src, z, degree[where]]

    def lists_of_wanted(place: int, kinds: dict) -> Routed:
        rows, (ids, n) = joined(kinds.get(0), width), joined(kinds.get(1), 2)
        for side in (0, 1):
            keep = distinct(joined(kinds.get(2 + side), 1)[0])
            there = np.isin(rows[0], keep)
            yield _LISTS[side], np.full(int(there.sum()), place), [c[there] for c in rows]
            there = np.isin(ids, keep)
            yield _NULLS[side], np.full(int(there.sum()), place), [ids[there], n[there]]

    ends = held.where("dst IS NOT NULL")
    by_src = passed_on([sent(ends, by_neighbour), sent(held, counted)], with_degree) if weighed else sent(ends, by_end)
    lists = written(
        passed_on([by_src, sent(held.where("dst IS NULL"), null_ends), sent(pairs, wanted)], lists_of_wanted), "lists"
    )
    rows = max((r["rows"] for r in lists.groupBy("kind").agg(F.sum("n").alias("rows")).collect()), default=0)
    sides = max(1, math.ceil(rows / EDGES_PER_PLACE / slices), math.ceil(math.sqrt(pairs.count() / PAIRS_PER_PLACE)))

    def side_of(vertex: np.ndarray) -> np.ndarray:
        return colour(vertex, parts) * sides // parts

    def dealt(table: pa.Table) -> Routed:
        a, b = longs(table["a"]), longs(table["b"])
        first = np.lexsort((b, a))
        a, b = a[first], b[first]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        a, b = a[new], b[new]
        for s in range(slices):
            yield _PAIRS, (side_of(a) * sides + side_of(b)) * slices + s, [a, b]

    part, piece = F.floor(F.col("place") / slices), F.col("place") % slices
    side, other = F.floor(part * sides / parts), F.explode(F.sequence(F.lit(0), F.lit(sides - 1)))
    first = F.col("kind").isin(_LISTS[0], _NULLS[0])
    spread = lists.select(side.alias("side"), piece.alias("piece"), other.alias("other"), "kind", "n", "packed").select(
        ((F.when(first, F.col("side") * sides + F.col("other")).otherwise(F.col("other") * sides + F.col("side"))) * slices
         + F.col("piece")).cast("int").alias("place"), "kind", "n", "packed",
    )
    got = met(
        [spread, sent(pairs, dealt)], lambda place, kinds: _scores(kinds, weighed),
        "a bigint, b bigint, degree_a bigint, degree_b bigint, common bigint, score double",
    )
    if slices > 1:
        got = got.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("degree_a", "degree_b", "common", "score")])
    return got


def _narrow(column: np.ndarray) -> np.ndarray:
    return column.astype(np.int32) if len(column) and -(2**31) <= column.min() and column.max() < 2**31 else column


class _Lists:
    """Lists of neighbours of some vertices, each sorted: ``names`` are sorted, ``begin`` and ``size`` say where."""

    def __init__(self, parts: list | None, nulls: list | None, weighed: bool):
        rows = joined(parts, 3 if weighed else 2)
        at = starts(rows[0])
        names, self.z, self.weight = rows[0][at], rows[1], _narrow(rows[2]) if weighed else None
        size = np.diff(np.r_[at, len(rows[0])])
        self.order = np.argsort(names)
        self.names, self.at, self.lengths = names[self.order], at, size  # the last two in the order of the lists
        self.nulls, self.more = joined(nulls, 2)

    def places(self, vertices: np.ndarray) -> np.ndarray:
        """Which list is a vertex's; the one past the end is empty."""
        where = np.searchsorted(self.names, vertices)
        found = np.r_[self.order, len(self.order)][where]
        found[np.r_[self.names, 0][where] != vertices] = len(self.order)
        return found

    def degrees(self, vertices: np.ndarray) -> np.ndarray:
        total = np.r_[self.lengths, 0][self.places(vertices)]
        if len(self.nulls):
            ids, at = np.unique(self.nulls, return_inverse=True)
            n = np.zeros(len(ids) + 1, np.int64)
            np.add.at(n, at, self.more)
            where = np.searchsorted(ids, vertices)
            where[np.r_[ids, 0][where] != vertices] = len(ids)
            total = total + n[where]
        return total


def _hits(few: _Lists, many: _Lists, of_few: np.ndarray, of_many: np.ndarray, span: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pair, neighbour's place among those of ``few``) of all neighbours that are in both lists of a pair."""
    key = np.repeat(np.arange(len(many.lengths)) * span, many.lengths) + many.z  # sorted, as the lists are
    keys = Keys(key)
    length, begin = np.r_[few.lengths, 0][of_few], np.r_[few.at, 0][of_few]
    for a, b, ends, at in spans(begin, length, PROBES_AT_ONCE):
        hit = keys.found(np.repeat(of_many[a:b] * span, length[a:b]) + few.z[at])
        yield np.searchsorted(ends, hit, side="right") + a, at[hit]


def _scores(kinds: dict, weighed: bool) -> dict[str, np.ndarray]:
    a, b = joined(kinds.get(_PAIRS), 2)
    order = np.lexsort((a, b))
    a, b = a[order], b[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)]
    a, b = a[new], b[new]
    of_a, of_b = (_Lists(kinds.pop(_LISTS[n], None), kinds.pop(_NULLS[n], None), weighed) for n in (0, 1))
    low = min((int(x.z.min()) for x in (of_a, of_b) if len(x.z)), default=0)
    span = max((int(x.z.max()) for x in (of_a, of_b) if len(x.z)), default=0) - low + 1
    if span * (1 + max(len(of_a.lengths), len(of_b.lengths))) < 1 << 62:
        for x in (of_a, of_b):
            x.z -= low
            x.z = _narrow(x.z)
    else:  # ids too far apart for a key of one long: their ranks instead
        ids = distinct(np.r_[of_a.z, of_b.z])
        of_a.z, of_b.z, span = np.searchsorted(ids, of_a.z), np.searchsorted(ids, of_b.z), len(ids)
    at_a, at_b = of_a.places(a), of_b.places(b)
    size_a, size_b = np.r_[of_a.lengths, 0][at_a], np.r_[of_b.lengths, 0][at_b]
    common, score = np.zeros(len(a), np.int64), np.zeros(len(a))
    there = (size_a > 0) & (size_b > 0)
    for few, many, at_few, at_many, mine in ((of_a, of_b, at_a, at_b, there & (size_a <= size_b)), (of_b, of_a, at_b, at_a, there & (size_a > size_b))):
        mine = np.flatnonzero(mine)
        for pair, at in _hits(few, many, at_few[mine], at_many[mine], span) if len(mine) else ():
            if not len(pair):
                continue
            first, last = int(pair[0]), int(pair[-1]) + 1
            common[mine[first:last]] += np.bincount(pair - first, minlength=last - first)
            if weighed:
                degree = few.weight[at]
                weight = np.where(degree > 1, 1.0 / np.log(np.maximum(degree, 2)), 0.0)
                score[mine[first:last]] += np.bincount(pair - first, weight, last - first)
    return {"a": a, "b": b, "degree_a": of_a.degrees(a), "degree_b": of_b.degrees(b), "common": common, "score": score}


def _with_null_ends(scored: DataFrame, pairs: DataFrame) -> DataFrame:
    """A pair with an end that is null stays, as one without common neighbours."""
    nulls = pairs.select("a", "b").where("a IS NULL OR b IS NULL").distinct()
    return scored.unionAll(nulls.select("a", "b", F.lit(0.0).alias("score")))


def adamic_adar(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """``a, b, score``: the sum of 1 / ln(degree) over common neighbours. ``edges`` has both directions."""
    return _with_null_ends(_common(pairs, edges, True).select("a", "b", "score"), pairs)


def jaccard(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """``a, b, score``: common neighbours over all neighbours; 0 where neither end has any."""
    union = F.col("degree_a") + F.col("degree_b") - F.col("common")
    score = F.when(union > 0, F.col("common") / union).otherwise(0.0)
    return _with_null_ends(_common(pairs, edges, False).select("a", "b", score.alias("score")), pairs)
