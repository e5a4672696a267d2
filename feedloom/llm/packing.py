"""Packing of tokenised documents into sequences of equal length, balanced by attention cost."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedloom.llm.common import modest, slices, strings
from feedloom.llm.tokens import encoder

#: Documents packed together, about; each such group is one task's work at a time.
GROUP = 4096


def cost(length, linear: float = 1.0, quadratic: float = 1.0 / 1024):
    """Estimated work of a piece: linear in its tokens, plus attention among them."""
    return linear * length + quadratic * length * length


def balance(lengths: np.ndarray, capacity: int, linear: float = 1.0, quadratic: float = 1.0 / 1024):
    """Assign documents shorter than ``capacity`` to as few sequences as their tokens fill.

    In descending order each goes to the sequence of lowest cost that has room for the whole; where none
    has, it is cut and its first part fills the sequence of lowest cost with any room.
    Returns (document, start in it, length, sequence, offset) arrays, and the number of sequences.
    """
    count = -(-int(lengths.sum()) // capacity)
    room, spent = np.full(count, capacity), np.zeros(count)
    out = []
    for document in np.argsort(-lengths, kind="stable").tolist():
        left, start = int(lengths[document]), 0
        while left:
            fits = room >= left
            open_ = fits if fits.any() else room > 0
            sequence = int(np.argmin(np.where(open_, spent, np.inf)))
            length = min(left, int(room[sequence]))
            out.append((document, start, length, sequence, capacity - int(room[sequence])))
            room[sequence] -= length
            spent[sequence] += cost(length, linear, quadratic)
            start, left = start + length, left - length
    return np.array(out, np.int64).reshape(-1, 5).T, count


_PIECE_COLUMNS = ["group", "id", "start", "length", "ids_crc32", "doc_tokens", "ids"]


def _pieces(path: str, capacity: int, end_id: int, groups: int, added: bool):
    """Rows (id, salt, text) -> whole sequences as they are, and the rest of each document with its ids."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(path, added=added)
        # How often each salt came here: equal rows are dealt one after another to different groups, whichever is the first.
        seen: dict[int, int] = {}
        for batch in batches:
            for part in slices(batch, 2, 1 << 22):
                rows = []
                for place, (salt, ids) in enumerate(zip(part.column(1).to_pylist(), library.encode(strings(part.column(2))))):
                    again = seen[salt] = seen.get(salt, -1) + 1
                    salt += again
                    ids += end
                    total = len(ids) // 4
                    for number, start in enumerate(range(0, total, capacity)):
                        piece = ids[4 * start:4 * (start + capacity)]
                        short = len(piece) < 4 * capacity
                        rows.append((
                            (salt + number) % groups, place, start, len(piece) // 4, zlib.crc32(piece), total,
                            piece if short else None,
                        ))
                group, place, *rest = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group, pa.int64()), part.column(0).take(pa.array(place))]
                    + [pa.array(values, pa.int64()) for values in rest[:-1]] + [pa.array(rest[-1], pa.binary())],
                    _PIECE_COLUMNS)
    return cut


def _packer(capacity: int, linear: float, quadratic: float):
    def pack(rows: pa.Table) -> pa.Table:
        base = rows["group"][0].as_py() << 32
        ids = rows["ids"].to_pylist()
        start, length = rows["start"].to_numpy(), rows["length"].to_numpy()
        short = np.flatnonzero([x is not None for x in ids])
        full = np.flatnonzero([x is None for x in ids])
        # Equal documents come in any order; the order of their rows must not depend on it.
        short = short[np.lexsort((rows["ids_crc32"].to_numpy()[short], rows["id"].combine_chunks().fill_null(0).to_numpy()[short]))] \
            if pa.types.is_integer(rows["id"].type) else short
        (document, begin, size, sequence, offset), count = balance(length[short], capacity, linear, quadratic)
        row = short[document]
        crc = [zlib.crc32(ids[r][4 * b:4 * (b + n)]) for r, b, n in zip(row.tolist(), begin.tolist(), size.tolist())]
        row_of = np.concatenate([row, full])
        return pa.table({
            "id": rows["id"].take(pa.array(row_of)),
            "start": np.concatenate([start[row] + begin, start[full]]),
            "length": np.concatenate([size, length[full]]),
            "ids_crc32": np.concatenate([np.array(crc, np.int64), rows["ids_crc32"].to_numpy()[full]]),
            "doc_tokens": rows["doc_tokens"].to_numpy()[row_of],
            "sequence_id": base + np.concatenate([sequence, count + np.arange(len(full))]),
            "offset": np.concatenate([offset, np.zeros(len(full), np.int64)]),
        })
    return pack


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *,
    capacity: int = 1024, end_id: int = 0, linear: float = 1.0, quadratic: float = 1.0 / 1024, group: int = GROUP,
    added: bool = False,
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset): where each piece of each document lies.

    A document is its ids, then ``end_id``; null or empty text has that one id. Whole sequences are cut from
    its front as they are, what is left is packed with that of about ``group`` others, so the padding is under
    one sequence a group. A document's ids lie in exactly one piece each. Repeated rows are packed each;
    null ids stay null. No other column is read. ``added`` is that of ``tokens.Encoder``.
    """
    rows = modest(docs).select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("salt"), F.col(text_col).alias("text"))
    groups = max(1, -(-docs.count() // group))
    kind = rows.schema["id"].dataType.simpleString()
    pieces = rows.mapInArrow(
        _pieces(tokenizer, capacity, end_id, groups, added),
        f"group long, id {kind}, start long, length long, ids_crc32 long, doc_tokens long, ids binary",
    )
    return pieces.groupBy("group").applyInArrow(
        _packer(capacity, linear, quadratic),
        f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
