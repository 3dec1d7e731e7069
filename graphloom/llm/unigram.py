"""Unigram pieces: Viterbi over a double-array trie, byte fallback, and decoding.

The piece file at hand is one of merges, so its scores are ranks and not logarithms of probabilities. ``load_pieces``
therefore gives the piece of rank r the score log(1 / (r + 2.7)) less the logarithm of the sum of these over all
ranks, after Zipf's law; any other scores can be put in their place.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.chunks import by_size, spaced_chunks
from graphloom.llm.common import released

#: Fixed values of the piece format: the mark of a space, and how much less than the worst piece an unknown character scores.
MARK, UNKNOWN_PENALTY = "▁", 10.0
#: Shift of the ranks in Zipf's law.
ZIPF_SHIFT = 2.7
#: Kinds of pieces.
NORMAL, UNKNOWN, CONTROL, BYTE = range(4)
#: Chunks of more characters are encoded one by one, as their table would be mostly empty.
LONG = 48
SLICE_CHARS, MEMORY = 500_000, 300_000
#: New chunks whose tables are filled at a time.
AT_ONCE = 5_000


@dataclass
class Pieces:
    """Pieces by id with their scores and kinds, and the double-array trie of the normal ones.

    From state s the character with code c leads to t = base[s] + c if check[t] = s; leaf[t] is the piece that ends
    there, or -1. State 0 is the root; code 0 is for characters of no piece.
    """

    texts: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    codes: dict[str, int] = field(default_factory=dict)
    base: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    check: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    leaf: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    longest: int = 0

    @property
    def unknown_score(self) -> float:
        return float(self.scores[self.kinds == NORMAL].min()) - UNKNOWN_PENALTY

    def byte_ids(self) -> list[int]:
        """The piece of each byte."""
        found = {int(self.texts[i][3:5], 16): int(i) for i in np.flatnonzero(self.kinds == BYTE)}
        return [found[b] for b in range(256)]


def build_trie(pieces: Pieces) -> Pieces:
    """Fill in the double array: the children of a state go to the first free places that fit them all."""
    normal = [(pieces.texts[i], int(i)) for i in np.flatnonzero(pieces.kinds == NORMAL)]
    seen: dict[str, int] = {}
    for text, _ in normal:
        for c in text:
            seen[c] = seen.get(c, 0) + 1
    codes = {c: k for k, c in enumerate(sorted(seen, key=lambda c: (-seen[c], c)), 1)}
    tree: dict = {}
    for text, i in normal:
        node = tree
        for c in text:
            node = node.setdefault(codes[c], {})
        node[0] = i  # code 0 leads nowhere, so it may hold the piece
    size = 1 << 16
    base, check, leaf = [0] * size, [-1] * size, [-1] * size
    check[0] = 0
    low, sparse, queue = 1, 1, [(0, tree)]  # places before ``low`` are taken, before ``sparse`` most
    while queue:
        state, node = queue.pop()
        children = sorted(c for c in node if c)
        if 0 in node:
            leaf[state] = node[0]
        if not children:
            continue
        while low < size and check[low] != -1:
            low += 1
        place, tries = low if len(children) == 1 else sparse, 0
        while True:
            top = place + children[-1] - children[0]
            if top >= size:
                more = max(size, top + 1 - size)
                base += [0] * more
                check += [-1] * more
                leaf += [-1] * more
                size += more
            offset = place - children[0]
            if place > 0 and check[place] == -1 and all(check[offset + c] == -1 for c in children):
                break
            place += 1
            tries += 1
        if tries > 50 and len(children) > 1:
            sparse = place - 25
        base[state] = offset
        for c in children:
            check[offset + c] = state
        queue += [(offset + c, node[c]) for c in children]
    margin = len(codes) + 1  # a base may be negative: a step before the first place ends among these, which are free
    pieces.codes = codes
    pieces.base = np.array(base, np.int32)
    pieces.check = np.array(check + [-1] * margin, np.int32)
    pieces.leaf = np.array(leaf + [-1] * margin, np.int32)
    pieces.longest = max((len(t) for t, _ in normal), default=0)
    return pieces


def load_pieces(path: str) -> Pieces:
    """The pieces of a model file, scored by their ranks, with their trie. Its size is that of the vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    kinds = [
        BYTE if model.is_byte(i) else CONTROL if model.is_control(i) else UNKNOWN if model.is_unknown(i) else NORMAL
        for i in ids
    ]
    ranks = np.array([-model.get_score(i) for i in ids])
    weights = 1 / (np.maximum(ranks, 0) + ZIPF_SHIFT)
    total = weights[np.array(kinds) == NORMAL].sum()
    return build_trie(Pieces([model.id_to_piece(i) for i in ids], np.log(weights / total), np.array(kinds)))


def marked_chunks(text: str) -> list[str]:
    """The chunks of a text, each of which follows a mark: that of its space, or the one put before the text."""
    chunks = spaced_chunks(text) if text else []
    if len(chunks) > 1 and not chunks[0]:  # the text begins with a space, so two marks stand together
        chunks[:2] = [f" {chunks[1]}"]
    return chunks


class Viterbi:
    """The best-scored pieces of chunks. Of equal scores the one found from the earliest start stays."""

    def __init__(self, pieces: Pieces, memory: int = MEMORY):
        self.p, self.memory = pieces, memory
        self.bytes = pieces.byte_ids()
        self.unknown = pieces.unknown_score
        self.known: dict[str | tuple[str], tuple[int, ...]] = {}
        self.base, self.check, self.leaf = pieces.base.tolist(), pieces.check.tolist(), pieces.leaf.tolist()
        self.score = pieces.scores.tolist()
        self.ids = list(range(len(pieces.texts)))  # remembered pieces share these objects

    def one(self, chunk: str) -> tuple[int, ...]:
        """The pieces of one marked chunk, character by character."""
        n, codes = len(chunk), [self.p.codes.get(c, 0) for c in chunk]
        best, back, piece = [0.0] + [-math.inf] * n, [0] * (n + 1), [-1] * (n + 1)
        for i in range(n):
            state, single = 0, False
            for j in range(i, min(n, i + self.p.longest)):
                c = codes[j]
                to = self.base[state] + c
                if not c or self.check[to] != state:
                    break
                state, found = to, self.leaf[to]
                if found >= 0:
                    single |= j == i
                    score = best[i] + self.score[found]
                    if score > best[j + 1]:
                        best[j + 1], back[j + 1], piece[j + 1] = score, i, found
            if not single and best[i] + self.unknown > best[i + 1]:
                best[i + 1], back[i + 1], piece[i + 1] = best[i] + self.unknown, i, -1
        out: list[int] = []
        while n:
            found = piece[n]
            out += [found] if found >= 0 else [self.bytes[b] for b in reversed(self.plain(chunk[back[n] : n]))]
            n = back[n]
        return tuple(reversed(out))

    def many(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """The pieces of short marked chunks, position by position for all of them at once."""
        base, check, leaf, scores, longest = self.p.base, self.p.check, self.p.leaf, self.p.scores, self.p.longest
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        n, rows = int(size.max()), len(chunks)
        get = self.p.codes.get
        code = np.zeros((rows, n + 1), np.int32)
        code[np.arange(n + 1) < size[:, None]] = np.fromiter((get(c, 0) for x in chunks for c in x), np.int32, int(size.sum()))
        best = np.full((rows, n + 1), -np.inf)
        best[:, 0] = 0
        back, piece = np.zeros((rows, n + 1), np.int16), np.full((rows, n + 1), -1, np.int32)
        for i in range(n):
            row = np.flatnonzero(size > i)
            single = np.zeros(rows, bool)
            state = np.zeros(len(row), np.int32)
            for j in range(i, min(n, i + longest)):
                c = code[row, j]
                to = base[state] + c
                on = (c > 0) & (check[to] == state)
                row, state = row[on], to[on]
                if not len(row):
                    break
                found = leaf[state]
                ends = found >= 0
                at, found = row[ends], found[ends]
                if j == i:
                    single[at] = True
                score = best[at, i] + scores[found]
                better = score > best[at, j + 1]
                at = at[better]
                best[at, j + 1], back[at, j + 1], piece[at, j + 1] = score[better], i, found[better]
            at = np.flatnonzero((size > i) & ~single)
            score = best[at, i] + self.unknown
            better = score > best[at, i + 1]
            at = at[better]
            best[at, i + 1], back[at, i + 1], piece[at, i + 1] = score[better], i, -1
        out = []
        for chunk, k, links, ids in zip(chunks, size.tolist(), back.tolist(), piece.tolist()):
            found: list[int] = []
            while k:
                at, p = links[k], ids[k]
                found += [self.ids[p]] if p >= 0 else [self.bytes[b] for b in reversed(self.plain(chunk[at:k]))]
                k = at
            out.append(tuple(reversed(found)))
        return out

    @staticmethod
    def plain(unknown: str) -> bytes:
        """The bytes of an unknown character; the mark of a literal mark in the text is taken off again."""
        return (MARK if unknown == LITERAL else unknown).encode("utf-8", "surrogatepass")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. A mark that stands in the text itself goes through byte fallback."""
        split = [marked_chunks(t) for t in texts]
        new = {c for chunks in split for c in chunks}.difference(self.known)
        if new and len(new) + len(self.known) > self.memory:
            self.known.clear()
            new = {c for chunks in split for c in chunks}
        marked = {c: MARK + c.replace(MARK, LITERAL).replace(" ", MARK) for c in new}
        short = [c for c in new if len(marked[c]) <= LONG]
        short.sort(key=len)
        for a in range(0, len(short), AT_ONCE):
            part = short[a : a + AT_ONCE]
            self.known.update(zip(part, self.many([marked[c] for c in part])))
        self.known.update((c, self.one(marked[c])) for c in new if len(marked[c]) > LONG)
        known = self.known
        return [np.array([i for c in chunks for i in known[c]], np.int32) for chunks in split]


#: Stands for a mark in the text itself while a chunk is encoded; a text's own character of this code is treated alike.
LITERAL = "\U0010ffff"


def decoder(pieces: Pieces) -> list[bytes]:
    """The bytes that each id stands for."""
    return [
        bytes([int(t[3:5], 16)]) if k == BYTE
        else b"" if k == CONTROL
        else " ⁇ ".encode() if k == UNKNOWN
        else t.replace(MARK, " ").encode()
        for t, k in zip(pieces.texts, pieces.kinds)
    ]


def decode(ids: list[int], table: list[bytes]) -> str:
    """The text of the ids without the space that was put before it. Bytes that are no UTF-8 give U+FFFD."""
    text = b"".join([table[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


ENCODED = "doc_id long, ids array<int>, n_tokens long, n_bytes long, ids_crc32 long, round_trip boolean"


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """The pieces of each text, decoded again to compare.

    Reads doc_id and text; other columns are ignored. A null or empty text has no pieces and decodes to the empty
    text. Rows that repeat a doc_id or a text are encoded each for itself; an empty table gives no rows. Every text
    comes back whole, but for U+10FFFF, which decodes as the mark. Returns doc_id, ids, n_tokens, n_bytes (tokens that
    are single bytes), ids_crc32 (of the ids as little-endian 32-bit integers) and round_trip, whether the text came back.
    The trie is built once and broadcast; its size is that of the vocabulary.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load_pieces(path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        viterbi, table, is_byte = Viterbi(pieces), decoder(pieces), pieces.kinds == BYTE
        for batch in batches:
            for a, texts in by_size(batch.column(1), SLICE_CHARS):
                ids = viterbi.encode(texts)
                ends = np.cumsum([0, *map(len, ids)])
                same = [decode(i.tolist(), table) == t for i, t in zip(ids, texts)]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(a, len(texts)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids))),
                        pa.array(np.diff(ends), pa.int64()),
                        pa.array([int(is_byte[i].sum()) for i in ids], pa.int64()),
                        pa.array([zlib.crc32(i.astype("<i4").tobytes()) for i in ids], pa.int64()),
                        pa.array(same, pa.bool_()),
                    ],
                    names=["doc_id", "ids", "n_tokens", "n_bytes", "ids_crc32", "round_trip"],
                )

    texts = F.coalesce("text", F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long"), texts).mapInArrow(released(encode), ENCODED)
