"""Texts of few letters as bytes of two or four bits a letter, for rows that travel."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

#: Bytes before the letters: bits a letter, length (2), the set of letters as bits from ``!`` on (8).
_HEAD = 11


def _rows(column) -> tuple:
    """Of an Arrow column of texts or bytes: its bytes, and where each row begins and how long it is (nulls are empty)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.binary()), b"")
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8), at[:-1], np.diff(at)


def _matrix(data, start, width: int):
    """Rows of one width; without a copy if they follow each other."""
    import numpy as np

    if len(start) and start[-1] - start[0] == (len(start) - 1) * width and (np.diff(start) == width).all():
        return data[start[0] : start[0] + len(start) * width].reshape(len(start), width)
    return data[start[:, None] + np.arange(width)]


def _joined(column, groups: list[tuple], kind):
    """An Arrow column out of (row numbers, matrix of their bytes), null where ``column`` is."""
    import numpy as np
    import pyarrow as pa

    size = np.zeros(len(column) + 1, np.int64)
    for rows, cells in groups:
        size[rows + 1] = cells.shape[1]
    at = np.cumsum(size)
    data = np.empty(at[-1], np.uint8)
    for rows, cells in groups:
        _matrix_put(data, at[rows], cells)
    valid = None if not column.null_count else pa.array(column.is_valid().to_numpy(zero_copy_only=False)).buffers()[1]
    return pa.Array.from_buffers(kind, len(column), [valid, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)], column.null_count)


def _matrix_put(data, start, cells) -> None:
    import numpy as np

    if cells.shape[0] * cells.shape[1] == len(data):
        data[:] = cells.ravel()
    else:
        data[start[:, None] + np.arange(cells.shape[1])] = cells


def _sets(data) -> list[tuple[int, list[int]]]:
    """Bits a letter, and the letters (from ``!`` to `` ` ``) that take them: the most frequent, four if most are of them, and sixteen."""
    import numpy as np

    n = np.bincount(data, minlength=256)[33:97]
    most = [33 + k for k in np.argsort(-n, kind="stable").tolist() if n[k]]
    return [(b, sorted(most[: 1 << b])) for b in (2, 4) if b == 4 or n[[k - 33 for k in most[:4]]].sum() > 0.75 * len(data)]


def _pack(texts, letters: bytes | None = None):
    """``letters``: the four that take two bits, with none of four; by default those that are frequent in ``texts``."""
    import numpy as np
    import pyarrow as pa

    data, start, size = _rows(texts)
    sets = [(2, sorted(letters))] if letters else _sets(data)
    groups = []
    for width in np.unique(size).tolist():
        rows = np.flatnonzero(size == width)
        for b, some in sets if _HEAD + width // 2 < width < 1 << 16 else ():
            table = np.full(256, 255, np.uint8)
            table[some] = np.arange(len(some), dtype=np.uint8)
            each = 8 // b
            rank = np.zeros((len(rows), -(-width // each) * each), np.uint8)
            rank[:, :width] = table[_matrix(data, start[rows], width)]
            good = rank.max(axis=1) < 255
            if not good.all():
                rank = rank[good]
            if len(rank):
                v = rank.view(f"<u{each}")  # the letters of a byte, the first one lowest
                body = v << 4 | v >> 8 if b == 4 else v << 6 | v >> 4 | v >> 14 | v >> 24
                cells = np.empty((len(rank), _HEAD + body.shape[1]), np.uint8)
                cells[:, :_HEAD] = np.array([b, width & 255, width >> 8, *sum(1 << k - 33 for k in some).to_bytes(8, "little")], np.uint8)
                cells[:, _HEAD:] = body.astype(np.uint8)
                groups.append((rows[good], cells))
                rows = rows[~good]
            if not len(rows):
                break
        if len(rows):
            groups.append((rows, np.hstack([np.zeros((len(rows), 1), np.uint8), _matrix(data, start[rows], width)])))
    return _joined(texts, groups, pa.binary())


def _unpack(packed):
    import numpy as np
    import pyarrow as pa

    data, start, size = _rows(packed)
    groups, mode = [], np.zeros(len(size), np.int64)
    mode[size > 0] = data[start[size > 0]]
    raw = np.flatnonzero((mode == 0) & (size > 0))
    for width in np.unique(size[raw]).tolist():
        rows = raw[size[raw] == width]
        groups.append((rows, _matrix(data, start[rows], width)[:, 1:]))
    rest = np.flatnonzero(mode)
    heads = data[start[rest][:, None] + np.arange(_HEAD)]
    while len(rest):  # those with the head of the first; there are few, for reads of a batch share lengths and letters
        one = heads[0].tobytes()
        same = (heads == heads[0]).all(axis=1)
        rows, rest, heads = rest[same], rest[~same], heads[~same]
        b, width, some = one[0], int.from_bytes(one[1:3], "little"), int.from_bytes(one[3:], "little")
        each, letters = 8 // b, [33 + k for k in range(64) if some >> k & 1]
        table = np.zeros((256, each), np.uint8)
        for k in range(each):
            at = np.arange(256) >> (8 - b - k * b) & ((1 << b) - 1)
            table[:, k] = np.array(letters + [0] * (16 - len(letters)), np.uint8)[at]
        body = _matrix(data, start[rows], int(size[rows[0]]))[:, _HEAD:]
        text = table.view(f"<u{each}").ravel()[body].view(np.uint8).reshape(len(rows), -1)
        groups.append((rows, text[:, :width]))
    return _joined(packed, groups, pa.string())


def packed(text: Column, letters: str | None = None) -> Column:
    """A text as bytes: two bits a letter if it has only the four letters that are frequent around it, four bits if the sixteen, else as it is.

    The letters are named in the bytes, so any text is kept. Equal texts may have other bytes elsewhere, but with
    ``letters`` (four), which alone take two bits, they have the same.
    """
    four = letters and letters.encode()

    def of(texts):
        return _pack(texts, four)

    return F.arrow_udf(of, "binary", ArrowUDFType.SCALAR)(text)


def unpacked(data: Column) -> Column:
    """The text of ``packed`` bytes."""
    return F.arrow_udf(_unpack, "string", ArrowUDFType.SCALAR)(data)
