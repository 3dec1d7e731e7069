"""Token ids as Simple-8b words in shard files.

A 64-bit word has a selector in its top four bits, which says how many ids of how many bits the other 60 hold. Ids
are packed in blocks of fixed length, so a reader can decode any block, and all words of one selector at once. An id of
more than 60 bits stands in a list beside the words; its word has the escape selector and the place in that list.
A shard is one binary value: a header, the ends of its documents, the offsets of its blocks, the escapes, the words.
Shards are rows of a Parquet table, which any executor can write and read and which a failed task leaves no part of.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphloom.llm.chunks import chunk_lists, slices_by_size
from graphloom.llm.common import sized_broadcast, stored

#: Fixed values of the format: ids per word and bits per id, by selector from 1; selector 0 is the escape.
PACKINGS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
COUNTS = np.array([1] + [n for n, _ in PACKINGS], dtype=np.int64)
#: The least id that is too wide for the packing of selector 1, 2, ...
LIMITS = np.array([1 << bits for _, bits in PACKINGS], dtype=np.uint64)
#: The number of limits that an id reaches, for ids of two bytes.
NEEDS = np.searchsorted(LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)
#: Places behind a block that its last word can reach.
MARGIN = PACKINGS[0][0]
MAGIC = b"S8BW"
HEADER = struct.Struct("<4sIqqqq")  # magic, block length, documents, ids, escapes, words
BLOCK = 1024
#: Characters that are encoded at a time, ids of a shard, and pieces whose ids are remembered.
SLICE_CHARS, SHARD_IDS, MEMORY = 24_000_000, 1 << 20, 600_000
#: New pieces that are encoded as one text, and such texts at a time.
TOGETHER, AT_ONCE = 1000, 20
#: Fixed values of the tokenizer files: how a space and a new line are written in a token.
SPACE, LINE = "Ġ", "Ċ"
#: Marks that may be cut off a word, and the letters and digits they are cut off (an apostrophe may belong to its word).
MARKS = ".,;:!?*&#$%"
_WORD = np.array([chr(b).isalnum() and b < 0x80 for b in range(256)])
#: Second bytes, behind 0xC3, of the letters from À to ÿ; the byte of a new line.
_LATIN = np.array([0x80 <= b <= 0xBF and b not in (0x97, 0xB7) for b in range(256)])
_LINE = 0x0A


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of the ids (unsigned 64-bit), the offset of each block's first word, and the escaped ids.

    Each word takes as many ids as it can hold. The widest id of every run of 2, 3, ... 60 ids is found for all places
    at once; then one word of every block is placed at a time.
    """
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    blocks, row = -(-n // block), block + MARGIN  # places beyond a block's end hold zeros and need no bits
    laid = _laid_out(ids, blocks, block)
    widest = NEEDS[laid] if int(ids.max()) < len(NEEDS) else np.searchsorted(LIMITS, laid, side="right").astype(np.uint8)
    fitting, length = np.zeros((blocks, block), np.uint8), 1
    for selector in range(len(PACKINGS), 0, -1):  # what fits a word of many ids fits all words of fewer
        count, _ = PACKINGS[selector - 1]
        while length < count:
            step = min(length, count - length)
            more = widest.copy()
            np.maximum(widest[:, :-step], widest[:, step:], out=more[:, :-step])
            widest, length = more, length + step
        fits = widest[:, :block] < selector
        if not fits.any():
            break
        fitting += fits
    choice = np.where(fitting > 0, len(PACKINGS) + 1 - fitting, 0).astype(np.uint8).ravel()
    at, heads = np.arange(0, n, block, dtype=np.int64), []
    ends = np.minimum(at + block, n)
    while len(at):  # one word of every unfinished block
        heads.append(at)
        at = at + COUNTS[choice[at]]
        going = at < ends
        if not going.all():
            at, ends = at[going], ends[going]
    start = np.sort(np.concatenate(heads))
    owner, chosen = start // block, choice[start]
    words = chosen.astype(np.uint64) << np.uint64(60)
    escaped = np.flatnonzero(chosen == 0)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    flat, place = laid.ravel(), start + owner * (row - block)
    for selector in np.flatnonzero(np.bincount(chosen)):
        if not selector:
            continue
        count, bits = PACKINGS[selector - 1]
        mine = np.flatnonzero(chosen == selector)
        head = place[mine]
        held = flat[head]
        for k in range(1, count):
            held |= flat[head + k] << np.uint64(k * bits)
        words[mine] |= held
    return words, np.searchsorted(owner, np.arange(blocks)), ids[start[escaped]]


def unpack(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ids of the words, all words of a selector at a time."""
    if not n:
        return np.zeros(0, dtype=np.uint64)
    blocks, row = -(-n // block), block + MARGIN
    chosen = (words >> np.uint64(60)).astype(np.int64)
    held = COUNTS[chosen]
    before = np.cumsum(held) - held
    words_of = np.diff(offsets, append=len(words))
    place = before + np.repeat(np.arange(blocks) * row - before[offsets], words_of)
    low = words & np.uint64((1 << 60) - 1)
    laid = np.zeros(blocks * row, dtype=np.uint64)
    for selector in np.flatnonzero(np.bincount(chosen)):
        mine = np.flatnonzero(chosen == selector)
        head, value = place[mine], low[mine]
        if selector == 0:
            laid[head] = escapes[value.astype(np.int64)]
            continue
        count, bits = PACKINGS[selector - 1]
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):  # what a block's last word has beyond its end falls into the margin
            laid[head + k] = (value >> np.uint64(k * bits)) & mask
    return laid.reshape(blocks, row)[:, :block].ravel()[:n]


def _laid_out(ids: np.ndarray, blocks: int, block: int) -> np.ndarray:
    """A row of ids for each block, with zeros behind them."""
    laid = np.zeros((blocks, block + MARGIN), np.uint64)
    full = len(ids) // block
    laid[:full, :block] = ids[: full * block].reshape(full, block)
    if full < blocks:
        laid[full, : len(ids) - full * block] = ids[full * block :]
    return laid


def write_shard(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets, escapes = pack(ids)
    ends = np.cumsum(np.asarray(lengths, dtype=np.int64))
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    names = np.array([d or 0 for d in doc_ids], dtype=np.int64)
    parts = (names, known, ends, offsets, escapes, words)
    return HEADER.pack(MAGIC, BLOCK, len(doc_ids), len(ids), len(escapes), len(words)) + b"".join(
        x.astype(x.dtype.newbyteorder("<")).tobytes() for x in parts
    )


def read_shard(shard: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """The documents' ids, where their tokens end, and the tokens."""
    magic, block, n_docs, n_ids, n_escapes, n_words = HEADER.unpack_from(shard)
    if magic != MAGIC:
        raise ValueError("not a shard of Simple-8b words")
    at, found = HEADER.size, []
    blocks = -(-n_ids // block)
    for kind, n in (("<i8", n_docs), ("u1", n_docs), ("<i8", n_docs), ("<i8", blocks), ("<u8", n_escapes), ("<u8", n_words)):
        found.append(np.frombuffer(shard, dtype=kind, count=n, offset=at))
        at += found[-1].nbytes
    names, known, ends, offsets, escapes, words = found
    doc_ids = [int(d) if k else None for d, k in zip(names, known)]
    return doc_ids, ends, unpack(words, offsets, escapes, n_ids, block)


@lru_cache(maxsize=1)
def shared_encoder(path: str) -> ChunkEncoder:
    """The encoder of this Python process, which goes on from task to task."""
    return ChunkEncoder(path)


class ChunkEncoder:
    """Encodes texts with a tokenizer whose tokens never reach over a space that follows a word.

    Chunks are cut further into pieces: before marks that end a chunk or a line behind a letter or digit, and before the
    new line. A mark that the tokenizer does not set apart from letters, or that an added token has, cuts nothing. The ids of a
    piece are remembered, as bytes, until the memory is full; pieces that are new then are encoded each time.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer, self.memory = Tokenizer.from_file(path), memory
        names = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())]
        self.spaced = np.array([bool(t) and t.startswith(SPACE) for t in names])
        self.lined = np.array([t == LINE for t in names])
        self.marks = "".join(m for m in MARKS if self._apart(m))
        self.is_mark = np.isin(np.arange(256), list(self.marks.encode()))
        self.known, self.ids = pa.array([], pa.string()), _as_binary(np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _apart(self, mark: str) -> bool:
        """Whether the tokenizer always cuts before ``mark`` behind a letter or digit, and before a new line behind it."""
        parts, split = (f"a{mark}", f"é{mark}{mark}", f"0{mark}", f"0{mark}\na", "a\na", "0\na"), self.tokenizer.pre_tokenizer
        added = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        if split is None or mark in added or "\n" in added:
            return False
        found = [[text[a:b] for _, (a, b) in split.pre_tokenize_str(text)] for text in parts]
        return found == [["a", mark], ["é", mark * 2], ["0", mark], ["0", mark, "\n", "a"], ["a", "\n", "a"], ["0", "\n", "a"]]

    def _cut(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all chunks (no slice of a column), and where each chunk's pieces begin and the last ones end.

        The cuts are found in the bytes, which the pieces share with the chunks.
        """
        edges = np.frombuffer(chunks.buffers()[1], np.int32, len(chunks) + 1)
        data = np.frombuffer(chunks.buffers()[2] or b"", np.uint8, int(edges[-1]))
        word, mark = _WORD[data], self.is_mark[data]
        word[1:] |= (data[:-1] == 0xC3) & _LATIN[data[1:]]
        begins = np.zeros(len(data) + 1, bool)
        begins[edges] = True
        at = np.flatnonzero(mark)  # runs of marks: their first and last places
        heads = np.diff(at, prepend=-2) > 1
        heads |= begins[at]
        first, after = at[heads], at[np.append(heads[1:], True)[: len(at)]] + 1
        ending = begins[after] | (np.append(data, 0)[after] == _LINE)
        runs = first[ending & ~begins[first] & word[first - 1]]
        lines = np.flatnonzero(data == _LINE) if self.marks else runs[:0]
        lines = lines[~begins[lines] & (word | mark)[lines - 1]]
        cuts = np.sort(np.concatenate([runs, lines]))
        behind = np.searchsorted(edges, cuts, side="right")
        pieces = np.insert(edges, behind, cuts)
        column = pa.StringArray.from_buffers(len(pieces) - 1, pa.py_buffer(pieces), chunks.buffers()[2] or pa.py_buffer(b""))
        return column, np.arange(len(edges)) + np.cumsum(np.bincount(behind, minlength=len(edges)))

    def _learn(self, pieces: pa.Array) -> pa.Array:
        """The ids of new pieces. Those of a kind whose first token can be told are encoded many at a time."""
        order: list[np.ndarray] = []
        flat: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        rest = np.ones(len(pieces), bool)
        for kind, first in (("^ [^ ]+$", self.spaced), ("^\n[!-~À-ÿ]+$", self.lined)):
            mine = np.flatnonzero(pc.match_substring_regex(pieces, kind).to_numpy(zero_copy_only=False))
            joined = pieces.take(pa.array(mine))
            data, ends = memoryview(joined.buffers()[2] or b""), np.frombuffer(joined.buffers()[1], np.int32, len(mine) + 1).tolist()
            groups = [(a, min(a + TOGETHER, len(mine))) for a in range(0, len(mine), TOGETHER)]
            for some in (groups[i : i + AT_ONCE] for i in range(0, len(groups), AT_ONCE)):
                texts = [str(data[ends[a] : ends[b]], "utf-8") for a, b in some]
                for (a, b), found in zip(some, self._ids(texts)):
                    begins = np.flatnonzero(first[found])
                    if len(begins) == b - a and not begins[0]:
                        order.append(mine[a:b])
                        flat.append(found)
                        sizes.append(np.diff(begins, append=len(found)))
                        rest[mine[a:b]] = False
        others = np.flatnonzero(rest)
        texts = pieces.take(pa.array(others)).to_pylist()
        for a in range(0, len(texts), TOGETHER):
            found = self._ids(texts[a : a + TOGETHER])
            order.append(others[a : a + TOGETHER])
            flat += found
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        place = np.empty(len(pieces), np.int64)
        place[np.concatenate(order)] = np.arange(len(pieces))
        return _as_binary(np.concatenate(flat), np.append(0, np.cumsum(np.concatenate(sizes)))).take(pa.array(place))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunk_ids(self, chunks: pa.Array) -> pa.Array:
        """The ids of each chunk as bytes. What is known stands first in the dictionary, so its codes are known as well."""
        pieces, ends = self._cut(chunks)
        n = len(self.known)
        coded = pa.concat_arrays([self.known, pieces]).dictionary_encode()
        ids = self.ids
        if len(coded.dictionary) > n:
            new = coded.dictionary.slice(n)
            found = self._learn(new)
            ids, room = pa.concat_arrays([ids, found]), self.memory - n
            if room > 0:
                self.known = coded.dictionary if room >= len(new) else pa.concat_arrays([self.known, new.slice(0, room)])
                self.ids = ids if room >= len(new) else pa.concat_arrays([self.ids, found.slice(0, room)])
        ids = ids.take(coded.indices.slice(n))
        offsets = _offsets(ids)[ends]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(chunks), [None, pa.py_buffer(offsets), ids.buffers()[2]])

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each closed by ``end``, and the number of ids of each text.

        Equal chunks are one entry of an Arrow dictionary, and ids are copied as bytes: Python meets new pieces only.
        """
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        lists = chunk_lists(texts.cast(pa.string()))
        last = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)
        coded = lists.flatten().dictionary_encode()
        names, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).copy()
        begins = np.append(0, last[:-1])  # a chunk that begins a text has no space before it
        begin_names, which = np.unique(code[begins], return_inverse=True)
        code[begins] = len(names) + which
        spaced = pc.binary_join_element_wise("", names, " ")
        ids = self._chunk_ids(pa.concat_arrays([spaced, names.take(pa.array(begin_names))]))
        closed = pa.concat_arrays([ids, _as_binary(np.array([end], np.uint32), np.array([0, 1]))])
        out = closed.take(pa.array(np.insert(code, last, len(ids))))
        total = _offsets(out)[last + np.arange(1, len(texts) + 1)] // 4
        return np.frombuffer(out.buffers()[2], np.uint32, int(total[-1])), np.diff(total, prepend=0)


def _as_binary(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Ranges of 32-bit ids as values of bytes, which Arrow copies whole."""
    buffers = [None, pa.py_buffer(ends * 4), pa.py_buffer(ids)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, buffers)


def _offsets(column: pa.Array) -> np.ndarray:
    """Where the values of a column of bytes that was just made (no slice) begin and end."""
    return np.frombuffer(column.buffers()[1], np.int64, len(column) + 1)


SHARDS = "part int, number int, n_ids long, shard binary"
TOKENS = "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>"


def encode_shards(docs: DataFrame, path: str, end: int = 0) -> DataFrame:
    """The stored shards of ``docs`` (doc_id, text) in ascending order of doc_id.

    ``path`` names a tokenizer file that lies in the same place on every executor; ``end`` closes each document.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange(parts, F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie, F.col("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = shared_encoder(path), TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def shard() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            blob = write_shard(names, np.concatenate(sizes), flat)
            return pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(flat)], pa.int64()), pa.array([blob], pa.binary())],
                names=["part", "number", "n_ids", "shard"],
            )

        for batch in batches:
            names_of = batch.column(0).to_pylist()
            first = 0
            for texts in slices_by_size(batch.column(1), SLICE_CHARS):
                flat, n = encoder.encode(texts, end)
                ends = np.append(0, np.cumsum(n))
                a = 0
                while a < len(n):  # the documents up to the one that fills the shard
                    b = min(int(np.searchsorted(ends[1:], ends[a] + SHARD_IDS - held)) + 1, len(n))
                    names += names_of[first + a : first + b]
                    sizes.append(n[a:b])
                    ids.append(flat[ends[a] : ends[b]])
                    held += int(ends[b] - ends[a])
                    a = b
                    if held >= SHARD_IDS:
                        yield shard()
                        number += 1
                        names, sizes, ids, held = [], [], [], 0
                first += len(texts)
        if names:
            yield shard()

    return stored(rows.mapInArrow(encode, SHARDS), "token_shards")


def read_documents(shards: DataFrame, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and (if wanted) the ids of each document, from the shards.

    ``start`` counts the ids of all documents before it. What is summed for it is one row per shard.
    """
    whole = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    base = whole.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    begun = shards.select("part", "number", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("within"))
    begun = begun.join(sized_broadcast(base), F.col("part") == F.col("p")).select(
        F.col("part").alias("p"), F.col("number").alias("q"), (F.col("base") + F.col("within")).alias("begin")
    )
    placed = shards.join(sized_broadcast(begun), (F.col("part") == F.col("p")) & (F.col("number") == F.col("q")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, shard in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids, ends, ids = read_shard(memoryview(shard.as_buffer()))
                firsts = np.append(0, ends[:-1]) if len(ends) else ends
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(firsts, ends)]
                columns = [
                    pa.array(doc_ids, pa.int64()), pa.array(firsts + begin, pa.int64()), pa.array(ends - firsts, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    kind = TOKENS if with_ids else TOKENS.rpartition(",")[0]
    return placed.select("begin", "shard").mapInArrow(decode, kind)


def token_files(docs: DataFrame, path: str, end: int = 0, with_ids: bool = False) -> DataFrame:
    """Encode every text, write the shards, read them back: one row per document.

    Reads doc_id and text; other columns are ignored. A null text counts as empty and has the end id only. Documents
    without an id come first; rows that repeat a doc_id stand next to each other in the order of their texts' hashes.
    An empty table gives no shard and no row. Returns doc_id, start, n_tokens (with the end id), ids_crc32 and, if
    wanted, the ids.
    """
    return read_documents(encode_shards(docs.select("doc_id", "text"), path, end), with_ids)
