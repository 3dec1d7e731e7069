"""Near-duplicates by order MinHash.

The k-mers of a text are its runs of five words, each labelled with how often it stood before in the text, so that
repeats count. A sketch row takes the few k-mers with the smallest hashes under one seed and keeps them in the order
of the text; texts that agree in a row are candidates. Texts of few k-mers are candidates where they share a k-mer of their
prefixes, which loses none of them. Candidates are verified by an alignment of their labelled k-mers within a band. A
label occurs once in a text, so the alignment is a longest increasing run of places.

The similarity of two texts with m and n k-mers is L / (m + n - L), where L is the length of the longest sequence of
labelled k-mers that both have in the same order; texts are near-duplicates from 0.8 on. Such texts differ by at most
max(m, n) - ceil(0.8 * max(m, n)) places at every aligned k-mer, so the band of that width loses nothing.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import BROADCAST_ROWS, components, kept_rows, released, sized_broadcast, stored, word_list

#: Words of a k-mer, k-mers of a sketch row, rows of a sketch. A pair of similarity 0.8 of long texts agrees in a row
#: with probability 0.26 and misses all rows with probability 0.00006 (texts of little more than SHORT k-mers: 0.00012).
K, PICKED, ROWS = 5, 6, 32
SIMILARITY = 0.8
#: A text of at most so many k-mers has every text that is near to it as a candidate.
SHORT = 50
#: Members, and strays, of a block in which strays are compared.
BLOCK = 256
_SEEDS = np.random.default_rng(2024).integers(1, 1 << 63, size=(ROWS, 2), dtype=np.uint64) | np.uint64(1)


def labelled_kmers(words: list[bytes], k: int = K) -> np.ndarray:
    """The k-mers of the words with their occurrence labels, as unsigned 64-bit hashes in the order of the text.

    Fewer words than k, but not none, are one k-mer.
    """
    if not words:
        return np.zeros(0, np.uint64)
    number = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    h = np.fromiter((number[w] for w in words), np.uint64, len(words))
    width = min(k, len(h))
    kmers = np.zeros(len(h) - width + 1, np.uint64)
    for j in range(width):
        kmers = (kmers ^ h[j : j + len(kmers)]) * np.uint64(0x9E3779B97F4A7C15)
        kmers ^= kmers >> np.uint64(29)
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(ranked)), 0))
    label = np.empty(len(kmers), np.uint64)
    label[order] = (np.arange(len(ranked)) - first).astype(np.uint64)
    return kmers + label * np.uint64(0xD6E8FEB86659FD93)


def sketch(kmers: np.ndarray, picked: int = PICKED) -> np.ndarray:
    """One signed 64-bit key per row: the row's smallest k-mers in the order of the text."""
    n = min(picked, len(kmers))
    keys = np.arange(1, ROWS + 1, dtype=np.uint64)
    at_once = max(1, 2_000_000 // len(kmers))  # rows, so that a long text needs no more memory
    for first in range(0, ROWS, at_once):
        a, b = _SEEDS[first : first + at_once].T[:, :, None]
        h = (kmers ^ a) * b
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        places = np.argpartition(h, n - 1, axis=1)[:, :n] if n < len(kmers) else np.tile(np.arange(n), (len(h), 1))
        places.sort(axis=1)
        key = keys[first : first + at_once]
        for x in kmers[places].T:
            key[:] = (key ^ x) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
            key ^= key >> np.uint64(31)
    return keys.view(np.int64)


def prefix(kmers: np.ndarray) -> np.ndarray:
    """The k-mers with the smallest hashes, as many as make two near-duplicates share one, as signed 64-bit keys.

    Two near-duplicates share L >= 0.8 * max(m, n) k-mers in one order. Of its n k-mers a text has at most n - ceil(0.8 * n)
    others, so the smallest of the shared ones is among the first n - ceil(0.8 * n) + 1 of either text.
    """
    return np.sort(kmers)[: band_width(len(kmers), len(kmers)) + 1].view(np.int64)


def bucket_keys(kmers: np.ndarray) -> np.ndarray:
    """The keys of a text: its prefix if it or a text near to it is short, its sketch if it is not short."""
    keys = []
    if SIMILARITY * len(kmers) <= SHORT + 1e-9:
        keys.append(prefix(kmers))
    if len(kmers) > SHORT:
        keys.append(sketch(kmers))
    return np.concatenate(keys)


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """The length of the longest sequence of labelled k-mers in the order of both texts, at most ``band`` places apart."""
    _, at, to = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(at - to) <= band
    at, to = at[near], to[near]
    tails: list[int] = []
    for place in to[np.argsort(at)].tolist():
        i = bisect_left(tails, place)
        if i == len(tails):
            tails.append(place)
        else:
            tails[i] = place
    return len(tails)


def band_width(m: int, n: int, similarity: float = SIMILARITY) -> int:
    longest = max(m, n)
    return longest - int(np.ceil(similarity * longest - 1e-9))


def is_similar(m: int, n: int, common: int, similarity: float = SIMILARITY) -> bool:
    return common >= similarity * (m + n - common) - 1e-9


SKETCHED = "doc_id long, text_key long, v binary, n int, keys array<long>"


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, v (names the sequence of words; null: no words), n (k-mers) and bucket keys of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, numbers, keys = [], [], []
            for text in batch.column(2).to_pylist():
                ws = word_list(text)
                kmers = labelled_kmers(ws)
                names.append(xxhash.xxh3_128_digest(b" ".join(ws)) if ws else None)
                numbers.append(len(kmers))
                keys.append(bucket_keys(kmers).tolist() if ws else [])
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(names, pa.binary()), pa.array(numbers, pa.int32()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "v", "n", "keys"],
            )

    key = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select(F.col("doc_id").cast("long"), key.alias("text_key"), "text").mapInArrow(released(run), SKETCHED)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The links among the pairs (a, b).

    Each pair gets both texts by two joins; a text that many pairs share is spread by adaptive skew handling and is
    taken apart once for the pairs of a batch that stand together.
    """
    right = pairs.join(texts.select(F.col("v").alias("vb"), F.col("text").alias("tb")), F.col("b") == F.col("vb"))
    both = right.join(texts.select(F.col("v").alias("va"), F.col("text").alias("ta")), F.col("a") == F.col("va"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kmers = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b, ta, tb = (batch.column(i) for i in range(4))
            linked = []
            for i in range(batch.num_rows):
                if (name := a[i].as_py()) != last:
                    last, kmers = name, labelled_kmers(word_list(ta[i].as_py()))
                linked.append(linked_kmers(kmers, labelled_kmers(word_list(tb[i].as_py()))))
            keep = pa.array(linked, pa.bool_())
            yield pa.record_batch([a.filter(keep), b.filter(keep)], names=["a", "b"])

    return both.select("a", "b", "ta", "tb").mapInArrow(released(align), LINKS)


LINKS = "a binary, b binary"


def linked_kmers(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the alignment of two texts within the band makes them near-duplicates."""
    m, n = len(a), len(b)
    return is_similar(m, n, min(m, n)) and is_similar(m, n, aligned(a, b, band_width(m, n)))


def compared(block: pd.DataFrame) -> pd.DataFrame:
    """The links between the members and the strays of a block (v, c, text, stray) that are of different classes.

    The k-mers that two texts share are counted for all members at once; pairs that share enough are aligned.
    """
    block = block.drop_duplicates(["v", "stray"])
    kmers = [labelled_kmers(word_list(t)) for t in block["text"]]
    names, classes, stray = block["v"].tolist(), block["c"].tolist(), block["stray"].to_numpy(bool)
    members = np.flatnonzero(~stray)
    sizes = np.array([len(kmers[i]) for i in members])
    owner = np.repeat(np.arange(len(members)), sizes)
    flat = np.concatenate([kmers[i] for i in members]) if len(members) else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    found = []
    for s in np.flatnonzero(stray):
        low, high = np.searchsorted(flat, kmers[s]), np.searchsorted(flat, kmers[s], side="right")
        runs = high - low
        at = np.repeat(low - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
        common = np.bincount(owner[at], minlength=len(members))
        for j in np.flatnonzero(common >= SIMILARITY * (sizes + len(kmers[s]) - common) - 1e-9):
            i = members[j]
            if classes[i] != classes[s] and linked_kmers(kmers[i], kmers[s]):
                found.append((min(names[i], names[s]), max(names[i], names[s])))
    return pd.DataFrame(found, columns=["a", "b"])


def _lengths_fit(m: Column, n: Column) -> Column:
    """L is at most the smaller number of k-mers."""
    return F.least(m, n) >= SIMILARITY * F.greatest(m, n) - 1e-9


def texts_of(docs: DataFrame, sketched: DataFrame, members: DataFrame) -> DataFrame:
    """The stored text of each v of ``members``."""
    wanted = sketched.join(members, "v").groupBy("v").agg(F.min("text_key").alias("k"))
    wanted = stored(wanted, "wanted")
    n = wanted.count()
    keyed = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    if n <= BROADCAST_ROWS:  # then only the wanted texts are shuffled
        keyed = keyed.join(F.broadcast(wanted.select("k")), F.col("text_key") == F.col("k"), "left_semi")
    found = keyed.join(wanted, F.col("text_key") == F.col("k"))
    return stored(found.groupBy("v").agg(F.first("text").alias("text")), "near_texts")


def links(docs: DataFrame, sketched: DataFrame, texts_seen: DataFrame) -> DataFrame:
    """The links (a, b) between different texts that connect each class of near-duplicates, and no others.

    The head of a bucket is its text that shares most buckets with most texts. First every text is compared with the
    heads of its buckets: a group of copies falls together by as many comparisons as it has texts. Texts of the class
    of their head need no further links; each other text, a stray, is compared with all the texts that share its head.
    """
    buckets = texts_seen.select("v", "n", F.explode("keys").alias("key"))
    sizes = buckets.groupBy(F.col("key").alias("k")).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stored(buckets.join(sizes, F.col("key") == F.col("k")).drop("k"), "buckets")
    weight = shared.groupBy(F.col("v").alias("w_v")).agg(F.sum("size").alias("w"))
    weighed = shared.join(weight, F.col("v") == F.col("w_v"))
    head = F.max_by(F.struct(F.col("v").alias("a"), F.col("n").alias("na")), F.struct("w", "v"))
    heads = stored(weighed.groupBy(F.col("key").alias("hk")).agg(head.alias("h")).select("hk", "h.*"), "heads")
    met = shared.join(heads, F.col("key") == F.col("hk")).groupBy("a", "v").agg(F.first("na").alias("na"), F.first("n").alias("n"))
    families = stored(met, "families")
    star = families.where((F.col("v") != F.col("a")) & _lengths_fit(F.col("n"), F.col("na"))).select("a", F.col("v").alias("b"))
    texts = texts_of(docs, sketched, shared.select("v").distinct())
    first = stored(verified(star, texts), "star_links")
    classes = stored(components(first), "star_classes")
    second = stored(stray_links(families.select("a", "v"), classes, texts), "stray_links")
    return first.union(second).distinct()


def stray_links(families: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of the texts (v) that are not in the class of their head (a) to any text of the same head.

    The members and the strays of a head are dealt into blocks by hash, and every block of members meets every block
    of strays in a task of its own, which gives links only: pairs are no rows, and no task holds a whole group.
    """
    of_v = classes.select(F.col("v").alias("cv"), "c")
    of_a = classes.select(F.col("v").alias("ca"), F.col("c").alias("head_c"))
    placed = families.join(of_v, F.col("v") == F.col("cv"), "left").join(of_a, F.col("a") == F.col("ca"), "left")
    placed = placed.select("a", "v", F.coalesce("c", "v").alias("c"), F.coalesce("head_c", "a").alias("head_c"))
    placed = stored(placed.select("a", "v", "c", (F.col("c") != F.col("head_c")).alias("stray")), "placed")
    size = placed.groupBy(F.col("a").alias("sa")).agg(F.count(F.lit(1)).alias("all"), F.count_if("stray").alias("strays"))
    size = size.where("strays > 0").select(
        "sa", F.ceil(F.col("all") / BLOCK).cast("int").alias("nm"), F.ceil(F.col("strays") / BLOCK).cast("int").alias("ns")
    )
    open_ = placed.join(size, F.col("a") == F.col("sa")).withColumn("h", F.xxhash64("v"))
    member_block, stray_block = F.pmod("h", "nm").cast("int"), F.pmod("h", "ns").cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = open_.select("a", "v", "c", F.lit(False).alias("stray"), member_block.alias("m"), every("ns").alias("s"))
    strays = open_.where("stray").select("a", "v", "c", "stray", every("nm").alias("m"), stray_block.alias("s"))
    blocks = members.unionByName(strays).join(texts.withColumnRenamed("v", "tv"), F.col("v") == F.col("tv")).drop("tv")
    return blocks.groupBy("a", "m", "s").applyInPandas(lambda b: compared(b), LINKS)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` with its class of near-duplicates.

    Reads doc_id and text; other columns are ignored. Texts with the same words are one; a class is all that is
    connected by links of similarity 0.8 or more. Null texts and texts without words are classes of their own, by
    row. The class is named by its smallest doc_id that is not null; rows that repeat a doc_id in a class are all
    marked kept alike, and where all doc_ids of a class are null, class_id is null and all are kept. An empty table
    gives an empty result. Returns doc_id, class_id, class_size, n_links (links found to other texts, at least those
    that connect the class), kept and text_key (the hash of the text).
    """
    docs = docs.select("doc_id", "text")
    sketched = stored(sketches(docs), "sketches")
    known = sketched.where("v is not null")
    seen = known.groupBy("v").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("keys").alias("keys")
    )
    seen = stored(seen, "texts")
    found = stored(links(docs, sketched, seen), "near_links")
    classes = components(found)
    degree = found.select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n_links"))
    named = classes.join(degree, "v").select(F.col("v").alias("cv"), "c", "n_links")
    of = seen.select("v", "first_id", "copies").join(named, F.col("v") == F.col("cv"), "left")
    of = stored(of.select("v", "first_id", "copies", F.coalesce("c", "v").alias("c"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "classes")
    groups = of.groupBy("c").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"))
    answer = of.select("v", "c", "n_links").join(groups, "c").select(F.col("v").alias("av"), "class_id", "class_size", "n_links")
    repeated = stored(answer.where("class_size > 1"), "repeated")
    rows = sketched.select("doc_id", "text_key", "v").join(sized_broadcast(repeated), F.col("v") == F.col("av"), "left")
    alone = F.col("av").isNull()
    class_id = F.when(alone, F.col("doc_id")).otherwise(F.col("class_id"))
    return rows.select(
        "doc_id", class_id.alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce(F.col("doc_id") == class_id, class_id.isNull()).alias("kept"), "text_key",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the one with its smallest doc_id, with all their columns."""
    found = near_duplicates(docs).where("class_size > 1").select("doc_id", F.col("text_key").alias("key"), "kept")
    return kept_rows(docs, found, F.xxhash64(F.coalesce("text", F.lit(""))))
