"""Texts cut at spaces into chunks that a tokenizer encodes independently of each other."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: A space after white space: the plain cut would divide a run.
_RUN = re.compile(r"\s ")
#: The same for Arrow, whose class of white space is smaller (fixed values: the code points Python counts as such).
_RUN_CLASS = "[\t-\r\x1c-\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}] "


def spaced_chunks(text: str) -> list[str]:
    """The text cut before each space that follows something else than white space.

    The first chunk is as it stands in the text; of the others the leading space is left out, so
    ``" ".join(chunks)`` is the text. A run of white space stays in one chunk.
    """
    parts = text.split(" ")
    if not _RUN.search(text):
        return parts
    chunks = parts[:1]
    for part in parts[1:]:
        before = chunks[-1]
        if before and not before[-1].isspace():
            chunks.append(part)
        else:
            chunks[-1] = f"{before} {part}"
    return chunks


def chunk_lists(texts: pa.Array) -> pa.ListArray:
    """``spaced_chunks`` of each text of a column without nulls; texts without runs are cut all at once."""
    lists = pc.split_pattern(texts, " ")
    runs = pc.match_substring_regex(texts, _RUN_CLASS).to_numpy(zero_copy_only=False)
    if not runs.any():
        return lists
    cut = [spaced_chunks(t) if run else None for t, run in zip(texts.to_pylist(), runs)]
    return pc.if_else(pa.array(runs), pa.array(cut, lists.type), lists)


def slices_by_size(column: pa.Array, limit: int) -> Iterator[pa.Array]:
    """Ranges of about ``limit`` bytes of a column; a longer text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and size + n > limit:
            yield column.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(column):
        yield column.slice(start)


def by_size(column: pa.Array, limit: int) -> Iterator[tuple[int, list[str]]]:
    """The first place and the texts of ranges of about ``limit`` bytes; a longer text is a range of its own."""
    start = 0
    for part in slices_by_size(column, limit):
        yield start, part.to_pylist()
        start += len(part)
