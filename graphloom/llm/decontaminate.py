"""Benchmark passages in documents, through a positional inverted index of the documents' words.

The index has one posting (text, position) per word that occurs in the benchmark; no other list is ever read. Each
window of an item is looked up by its two rarest words: their lists, shifted by the words' offsets in the item, are
intersected, which leaves the few places where the whole phrase is compared. Everything here is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphloom.llm.common import BROADCAST_ROWS, folded_words, kept_rows, sized_broadcast, stored, words

#: Words of a window.
WINDOW = 13
#: Lists that are intersected before a phrase is compared.
RAREST = 2
#: A document is contaminated if 1 / SHARE of its words are hit.
SHARE = 20


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """Items that have words: item (a key of the row), item_id as text (null: ``null``), ws, fw."""
    rows = benchmark.select(
        F.xxhash64("item_id", "text").alias("item"),
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
        words(F.col("text")).alias("ws"),
        folded_words(F.col("text")).alias("fw"),
    )
    return rows.where(F.size("ws") > 0).dropDuplicates(["item", "item_id"])


def item_terms(items: DataFrame) -> DataFrame:
    return items.select("item", F.posexplode("fw").alias("ipos", "word")).select(
        "item", "ipos", F.xxhash64("word").alias("term")
    )


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Stored postings of ``docs`` (doc_id, text) for the given terms: text_key, pos, term.

    The last word of each text has a row in any case, marked by ``last`` and with the doc_id, so the index has the
    length of every text; a text without words has a row without position. Copies of a text share their text_key.
    """
    ws = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), folded_words(F.col("text")).alias("ws"))
    sized = ws.withColumn("n", F.size("ws"))
    each = sized.select("doc_id", "text_key", "n", F.posexplode_outer("ws").alias("pos", "word")).select(
        "doc_id", "text_key", "pos", F.xxhash64("word").alias("t"), (F.coalesce("pos", F.lit(-1)) == F.col("n") - 1).alias("last")
    )
    known = sized_broadcast(terms.select("term").distinct())
    found = each.join(known, F.col("t") == F.col("term"), "left").where("last or term is not null")
    return stored(found.select(F.when(F.col("last"), F.col("doc_id")).alias("doc_id"), "text_key", "pos", "term", "last"), "postings")


def windows(items: DataFrame, index: DataFrame, window: int = WINDOW) -> DataFrame:
    """Stored windows all of whose words are in the index: item, item_id, off, len, phrase, and their rarest words.

    ``rare`` has the positions (in the item) and terms of the ``RAREST`` words with the shortest lists.
    """
    count = index.where("term is not null").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    terms = item_terms(items).join(count, "term")
    spans = items.select(
        "item", "item_id", "ws", F.explode(F.sequence(F.lit(0), F.greatest(F.size("ws") - window, F.lit(0)))).alias("off"),
        F.least(F.size("ws"), F.lit(window)).alias("len"),
    ).select("item", "item_id", "off", "len", F.array_join(F.slice("ws", F.col("off") + 1, F.col("len")), " ").alias("phrase"))
    inside = spans.select("item", "item_id", "off", F.explode(F.sequence("off", F.col("off") + F.col("len") - 1)).alias("ipos"))
    ranked = inside.join(terms, ["item", "ipos"]).withColumn(
        "rank", F.row_number().over(Window.partitionBy("item", "item_id", "off").orderBy("n", "ipos"))
    )
    rare = ranked.groupBy("item", "item_id", "off").agg(
        F.count(F.lit(1)).alias("present"),
        F.array_sort(F.collect_list(F.when(F.col("rank") <= RAREST, F.struct("rank", "ipos", "term")))).alias("rare"),
    )
    found = spans.join(rare, ["item", "item_id", "off"]).where("present = len").drop("present")
    n = items.agg(F.sum(F.greatest(F.size("ws") - window + 1, F.lit(1)))).first()[0] or 0
    return stored(found, "windows", n)


def _hits(index: DataFrame, spans: DataFrame) -> DataFrame:
    """Postings of the rarest words, shifted by their offsets: text_key, item, ipos, delta."""
    anchors = spans.select("item", F.explode("rare").alias("r")).select("item", "r.ipos", F.col("r.term").alias("t")).distinct()
    anchors = stored(anchors, "anchors", RAREST * spans.count())
    found = index.where("term is not null").join(sized_broadcast(anchors), F.col("term") == F.col("t"))
    return found.select("text_key", "item", "ipos", (F.col("pos") - F.col("ipos")).alias("delta"))


def candidates(index: DataFrame, spans: DataFrame) -> DataFrame:
    """Places where all the rarest words of a window stand at their offsets: text_key, item_id, start, len, phrase.

    Grouping by place is the intersection of the shifted lists; copies of a text fall together before the shuffle.
    """
    place = _hits(index, spans).groupBy("text_key", "item", "delta").agg(F.collect_set("ipos").alias("there"))
    first = place.select("text_key", "item", "delta", "there", F.explode("there").alias("ipos"))
    by_rarest = spans.withColumn("ipos", F.col("rare")[0]["ipos"]).withColumn("others", F.col("rare")["ipos"])
    met = first.join(sized_broadcast(by_rarest), ["item", "ipos"]).where(
        F.size(F.array_except("others", "there")) == 0
    )
    return met.select("text_key", "item_id", (F.col("delta") + F.col("off")).alias("start"), "len", "phrase").where("start >= 0")


def near_matches(docs: DataFrame, benchmark: DataFrame, slop: int = 3, window: int = WINDOW) -> DataFrame:
    """Proximity matches: windows whose rarest words stand in a text within ``slop`` words of their offsets.

    Returns doc_id, item_id, off and gap, the smallest difference of the shifted positions (0 for a phrase that may
    be whole). Texts and items without words match nothing; a window whose words are not all in the index is left out.
    """
    items = benchmark_items(benchmark)
    index = build_index(docs, item_terms(items))
    spans = windows(items, index, window)
    hits = stored(_hits(index, spans).distinct(), "hits").withColumn("cell", F.floor(F.col("delta") / (slop + 1)))
    ends = spans.select(
        "item", "item_id", "off", F.col("rare")[0]["ipos"].alias("p1"), F.element_at(F.col("rare"), -1)["ipos"].alias("p2")
    )
    one = hits.join(ends, (hits.item == ends["item"]) & (hits.ipos == ends.p1)).select(
        "text_key", "item_id", ends["item"].alias("it"), "off", "p2", F.col("delta").alias("d1"),
        F.explode(F.expr("array(cell - 1, cell, cell + 1)")).alias("near_cell"),
    )
    two = hits.select(F.col("text_key").alias("k"), "item", "ipos", F.col("delta").alias("d2"), "cell")
    both = one.join(
        two, (one.text_key == two.k) & (one.it == two["item"]) & (one.p2 == two.ipos) & (one.near_cell == two.cell)
    ).where(F.abs(F.col("d1") - F.col("d2")) <= slop)
    gaps = both.groupBy("text_key", "item_id", "off").agg(F.min(F.abs(F.col("d1") - F.col("d2"))).alias("gap"))
    ids = index.where("last").select("doc_id", F.col("text_key").alias("k"))
    return gaps.join(ids, gaps.text_key == ids.k).select("doc_id", "item_id", "off", "gap")


def _compared(ws: Column, places: Column) -> Column:
    """The places whose whole phrase stands in the text, in order."""
    here = F.filter(places, lambda p: F.array_join(F.slice(ws, p["start"] + 1, p["len"]), " ") == p["phrase"])
    return F.array_sort(here)


def _covered(matches: Column) -> Column:
    """The number of words inside any of the matches, which are sorted by start."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, m: Column) -> Column:
        end = m["start"] + m["len"]
        more = F.greatest(F.lit(0), end - F.greatest(acc["end"], m["start"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + more).alias("n"))

    return F.aggregate(matches, zero, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each row of ``docs`` with its words that lie in a window of a benchmark item.

    Reads doc_id and text of ``docs``, item_id and text of ``benchmark``; other columns are ignored. Null texts have no
    words, match nothing and are clean. An item shorter than the window is one window; several items with one text
    all count. Rows that repeat a doc_id or a text are judged each for itself. Empty tables give no match. Returns
    doc_id, n_words, n_hit, n_items, items_sha256 (of the sorted item_ids, joined by commas), contaminated, text_key,
    and matches: (start, len, phrase, item_id) of every exact phrase match.
    """
    docs = docs.select("doc_id", "text")
    items = stored(benchmark_items(benchmark.select("item_id", "text")), "items", benchmark.count())
    index = build_index(docs, item_terms(items))
    spans = windows(items, index, window)
    places = candidates(index, spans).groupBy(F.col("text_key").alias("k")).agg(
        F.collect_set(F.struct("start", "len", "phrase", "item_id")).alias("places")
    )
    places = stored(places, "places", index.where("last").count())
    keyed = docs.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    n = places.count()
    if n <= BROADCAST_ROWS:  # then only texts with such a place are shuffled
        keyed = keyed.join(F.broadcast(places.select("k")), F.col("text_key") == F.col("k"), "left_semi")
    read = keyed.join(places, F.col("text_key") == F.col("k"))
    ws = read.select("doc_id", "text_key", "places", words(F.col("text")).alias("ws"))
    met = ws.select("doc_id", "text_key", F.size("ws").cast("long").alias("n_words"), _compared(F.col("ws"), F.col("places")).alias("matches"))
    other = index.where("last").join(sized_broadcast(places.select("k"), n), F.col("text_key") == F.col("k"), "left_anti")
    clean = other.select("doc_id", "text_key", F.coalesce(F.col("pos") + 1, F.lit(0)).cast("long").alias("n_words")).withColumn(
        "matches", F.array().cast(met.schema["matches"].dataType)
    )
    found = met.unionByName(clean).select(
        "doc_id", "text_key", "n_words", _covered(F.col("matches")).alias("n_hit"),
        F.array_sort(F.array_distinct(F.col("matches")["item_id"])).alias("ids"), "matches",
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "text_key", "matches",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = contamination(docs, benchmark).where("contaminated").select("doc_id", F.col("text_key").alias("key"))
    return kept_rows(docs, bad.distinct().withColumn("kept", F.lit(False)), F.xxhash64(F.coalesce("text", F.lit(""))))
