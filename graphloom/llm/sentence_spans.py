"""Repeated passages removed by sliding sentence spans.

A text is cut into units: sentences, and within a sentence before each word whose hash is the smallest of the words up
to ``REACH`` places before and behind it. Such a place depends on these words alone, so a passage is cut alike whatever
stands around it, but for its first and last few words. A character of a script without spaces is a word.
A span is a run of at least ``SPAN_UNITS`` units and ``SPAN_WORDS`` words. Every shortest span that begins at a unit,
and every shortest span that ends at one, is hashed from its words; spans are counted over all texts, and the units of
each occurrence but the first are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.chunks import by_size
from graphloom.llm.common import BROADCAST_ROWS, stored, word_list

#: Units and words of a span at least.
SPAN_UNITS, SPAN_WORDS = 3, 15
#: Places before and behind a word among which its hash is the smallest where a unit begins.
REACH = 4
SLICE_CHARS = 1_000_000
#: Words whose hashes are remembered.
MEMORY = 200_000
#: A sentence ends behind its last full stop, question or exclamation mark before white space, behind a full-width one,
#: or at a line's end.
_SENTENCE = re.compile(r"[^\n]*?(?:[.!?]+(?=\s)|(?:[。！？｡]|．(?!\d))+[.!?。！？｡」』”’）]*|\n|$)\s*")
#: Thai to Tibetan, Myanmar, Khmer, kana and the ideographs.
_UNSPACED_SET = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_UNSPACED = re.compile(f"[{_UNSPACED_SET}]")
_PIECE = re.compile(f"[{_UNSPACED_SET}]\\s*|[^\\s{_UNSPACED_SET}]+\\s*")


def unit_words(unit: str) -> list[bytes]:
    """The words of a unit; a character of a script without spaces is one."""
    return word_list(unit if unit.isascii() else _UNSPACED.sub(r" \g<0> ", unit))


def _hash(piece: str, known: dict[str, int]) -> int:
    found = known.get(piece)
    if found is None:
        if len(known) >= MEMORY:
            known.clear()
        ws = word_list(piece)
        found = known[piece] = xxhash.xxh3_64_intdigest(b" ".join(ws)) if ws else -1
    return found


def units(text: str | None, known: dict[str, int] | None = None) -> list[str]:
    """The units of a text; joined they are the text. Of equal smallest hashes those more than REACH apart cut."""
    known = {} if known is None else known
    out: list[str] = []
    for sentence in _SENTENCE.findall(text or ""):
        parts = _PIECE.findall(sentence)
        if len(parts) <= 2 * REACH:
            if sentence:
                out.append(sentence)
            continue
        lead = len(sentence) - sum(map(len, parts))
        found = [_hash(p, known) for p in parts]
        starts = [i for i, x in enumerate(found) if x >= 0]  # a piece without words belongs to the one before
        h = [found[i] for i in starts]
        last, cuts = -REACH, [0]
        for i in range(REACH, len(h) - REACH):
            if i - last > REACH and h[i] == min(h[i - REACH : i + REACH + 1]):
                cuts.append(starts[i])
                last = i
        cuts.append(len(parts))
        cut = ["".join(parts[a:b]) for a, b in zip(cuts, cuts[1:])]
        cut[0] = sentence[:lead] + cut[0]
        out += cut
    return out


def spans(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first unit, last unit (places in the text's units) and 128-bit hash of every shortest span of the texts.

    Units without words do not count.
    """
    words = [unit_words(u) for parts in texts for u in parts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    digests = b"".join([xxhash.xxh3_128_digest(b" ".join(ws)) for ws in words])
    hashes = np.frombuffer(digests, ">u8").reshape(-1, 2).astype(np.uint64)
    counts = np.fromiter(map(len, words), np.int64, len(words))
    real = np.flatnonzero(counts)
    owner, place, hashes, counts = owner[real], place[real], hashes[real], counts[real]
    n = len(real)
    begin, end = np.searchsorted(owner, owner), np.searchsorted(owner, owner, side="right")  # of each unit's text
    total = np.append(0, np.cumsum(counts))
    number = np.arange(n)
    forward = np.maximum(np.searchsorted(total, total[:-1] + SPAN_WORDS) - 1, number + SPAN_UNITS - 1)
    backward = np.minimum(np.searchsorted(total, total[1:] - SPAN_WORDS, side="right") - 1, number - SPAN_UNITS + 1)
    ahead, behind = forward < end, backward >= begin
    both = np.unique(np.concatenate([number[ahead] * n + forward[ahead], backward[behind] * n + number[behind]]))
    first, last = both // max(n, 1), both % max(n, 1)
    length = last - first + 1
    out = np.repeat(length.astype(np.uint64)[:, None], 2, axis=1)
    for j in range(int(length.max(initial=0))):
        on = np.flatnonzero(length > j)
        step = (out[on] ^ hashes[first[on] + j]) * np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
        out[on] = step ^ (step >> np.uint64(31))
    return owner[first], place[first], place[last], out


SPANS = "h1 long, h2 long, doc_id long, text_key long, first int, last int"


def span_table(docs: DataFrame) -> DataFrame:
    """Every span of every text. A row of the table is named by its doc_id and the hash of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for a, texts in by_size(batch.column(2), SLICE_CHARS):
                row, first, last, hashes = spans([units(t, known) for t in texts])
                row, hashes = pa.array(row + a), hashes.view(np.int64)
                yield pa.record_batch(
                    [
                        pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), batch.column(0).take(row), batch.column(1).take(row),
                        pa.array(first, pa.int32()), pa.array(last, pa.int32()),
                    ],
                    names=["h1", "h2", "doc_id", "text_key", "first", "last"],
                )

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, SPANS)


def repeated_units(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and the sorted first and last units of every span that stands at an earlier place as well.

    Occurrences are counted, and the first is found, before the shuffle, so a span that a third of all texts hold is
    one row of each task. The first is that of the smallest doc_id (null before all), then text_key, then unit. Repeated
    spans grow with the texts, so they are joined by shuffling both sides at any size.
    """
    found = stored(span_table(docs), "spans")
    where = F.struct("doc_id", "text_key", "first")
    whole = found.groupBy("h1", "h2").agg(F.min(where).alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1")
    whole = stored(whole.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "origin"), "repeated_spans")
    met = found.join(whole, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")))
    later = met.where(~where.eqNullSafe(F.col("origin")))
    runs = F.collect_set(F.struct("first", "last"))
    return later.groupBy("doc_id", "text_key").agg(F.array_sort(runs).alias("runs"))




def remove_repeats(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` without the units that a repeated span covers.

    Reads doc_id and text; other columns are ignored. A null text counts as empty. Texts of fewer than three units
    have no span and stay as they are. In a repeated copy all that the spans cover goes, which may leave the empty
    text. Rows that repeat both doc_id and text are one document to this operator and both keep their spans; rows that
    repeat the doc_id alone are told apart by their texts. An empty table gives no rows. Returns doc_id, text,
    n_removed (units) and removed, the runs of text that were taken out.
    """
    docs = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    runs = stored(repeated_units(docs), "repeated_units")
    names = runs.select(F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_key"), "runs")
    same = F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_key") == F.col("r_key"))
    n = runs.count()
    keys = names.select("r_id", "r_key")
    if n <= BROADCAST_ROWS:  # then only texts that lose something are shuffled
        touched = docs.join(F.broadcast(keys), same, "left_semi").join(names, same)
        whole = docs.join(F.broadcast(keys), same, "left_anti")
    else:
        touched = docs.join(names, same)
        whole = docs.join(keys, same, "left_anti")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            texts, removed, sizes = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts = units(text, known)
                gone = np.zeros(len(parts) + 1, np.int64)
                np.add.at(gone, [r["first"] for r in found], 1)
                np.add.at(gone, [r["last"] + 1 for r in found], -1)
                out = np.cumsum(gone[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], out.view(np.int8), [0]])))
                texts.append("".join(p for p, o in zip(parts, out) if not o))
                removed.append(["".join(parts[a:b]) for a, b in zip(edges[::2], edges[1::2])])
                sizes.append(int(out.sum()))
            yield pa.record_batch(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(sizes, pa.int32()), pa.array(removed, pa.list_(pa.string()))],
                names=["doc_id", "text", "n_removed", "removed"],
            )

    kind = "doc_id long, text string, n_removed int, removed array<string>"
    changed = touched.select("doc_id", "text", "runs").mapInArrow(cut, kind)
    nothing: list[Column] = [F.lit(0).alias("n_removed"), F.array().cast("array<string>").alias("removed")]
    return changed.unionByName(whole.select("doc_id", "text", *nothing))
