"""Helpers the operators share: reading tables, packing texts, splitting and hashing words.

Row conventions used by every operator, unless its docstring says otherwise: a NULL text
is the empty text; rows that repeat are judged one by one; a NULL doc_id stays NULL in
the result; only the named columns are read, so other columns never clash.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A-Z to a-z, all other bytes as they are
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BYTE = np.arange(256)
# white space of the word rules: tab, line feed, vertical tab, form feed, return, space
IS_SPACE = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13))
# bytes between alphanumeric words: ASCII that is neither a digit nor a lower-case letter
IS_BREAK = (_BYTE < 128) & ~((_BYTE >= 48) & (_BYTE <= 57)) & ~((_BYTE >= 97) & (_BYTE <= 122))

# odd multiplier of the rolling sums; 3 modulo 8, so that differences of its powers keep
# nearly all of their bits
_STEP = np.uint64(0x9E3779B97F4A7C13)
_STEP_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))
# the lowest bytes of eight, by their number
_LOW_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)
_VALUES = np.random.default_rng(20240613).integers(0, 1 << 64, 256, dtype=np.uint64)

# Arrow types of the columns that functions over texts give
_ARROW = {
    "long": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(name: str, columns: list[str]) -> str:
    """The name, with underscores before it if a column has it already."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name = f"_{name}"
    return name


def doc_remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text modulo `modulus`; a NULL id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def in_sample(share: Column, *key: Column) -> Column:
    """True for that share of all keys, the same keys in every run."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < share * (1 << 30)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


_POWERS: dict[str, np.ndarray] = {}


def _powers(factor: np.uint64, n: int) -> np.ndarray:
    row = np.full(n, factor)
    row[0] = 1
    return np.multiply.accumulate(row)


def step_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, for n positions at least."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = (n >> 18) + 1 << 18
        for key, factor in (("up", _STEP), ("down", _STEP_INVERSE)):
            low = _powers(factor, 1 << 12)
            high = _powers((low[-1:] * factor)[0], size >> 12)
            _POWERS[key] = np.multiply.outer(high, low).ravel()
    return _POWERS["up"], _POWERS["down"]


def pack(blobs: list[bytes], joint: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """All bytes with one joint after each text, and the start of each text."""
    data = np.frombuffer(joint.join(blobs) + joint, dtype=np.uint8)
    starts = np.cumsum([0] + [len(b) + 1 for b in blobs[:-1]]) if blobs else np.zeros(0, int)
    return data, np.asarray(starts, dtype=np.int64)


def word_bounds(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes that are no breaks."""
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = np.frombuffer(data.tobytes().translate((~breaks).tobytes()), dtype=np.int8)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; equal spans have equal hashes anywhere."""
    up, down = step_powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + lengths)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, for many short spans; equal spans have equal hashes anywhere.

    Eight bytes at a time, so the work follows the spans; those over 64 bytes go by their sums.
    """
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    eight = np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64) * _STEP)
    long = np.flatnonzero(sizes > 64)
    going = np.flatnonzero(sizes <= 64) if len(long) else np.arange(len(sizes))
    for at in range(0, 64, 8):
        if at:
            going = going[sizes[going] > at]
        if not len(going):
            break
        left = np.minimum(sizes[going] - at, 8)
        out[going] = mix(out[going] ^ (eight[starts[going] + at] & _LOW_BYTES[left]))
    if len(long):
        last = np.cumsum(sizes[long])
        body = np.concatenate([data[i:j] for i, j in zip(starts[long].tolist(), ends[long].tolist())])
        out[long] = span_hashes(body, last - sizes[long], last)
    return out


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned values as differences, all first bytes, then all second bytes, and so
    on; the high ones are nearly all zero, which Spark's own compression takes out."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return steps.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def unpack_sorted(blob: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(blob, dtype=np.uint8).reshape(width, len(blob) // width)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind)[:, 0], dtype=kind)


def pack_planes(values: np.ndarray, width: int) -> bytes:
    """The low `width` bytes of unsigned values, all first bytes, then all second ones, and so
    on: bytes that are mostly zero then lie together and compress away."""
    table = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize)
    return table[:, :width].T.tobytes()


def unpack_planes(blob: bytes, width: int, kind) -> np.ndarray:
    planes = np.frombuffer(blob, dtype=np.uint8).reshape(width, len(blob) // width)
    table = np.zeros((planes.shape[1], np.dtype(kind).itemsize), dtype=np.uint8)
    table[:, :width] = planes.T
    return table.view(kind)[:, 0]


def squeeze(planes: bytes, width: int) -> bytes:
    """Planes of bytes, each compressed if that makes it shorter, after their lengths; of a
    plane of zeros nothing is kept."""
    n = len(planes) // width
    return _squeezed(planes, n, width, [(0, n)])[0]


def squeeze_runs(values: np.ndarray, width: int, runs: list[tuple[int, int]]) -> list[bytes]:
    """The squeezed planes of each run of values, from its first to before its last."""
    return _squeezed(pack_planes(values, width), len(values), width, runs)


def _squeezed(planes: bytes, total: int, width: int, runs: list[tuple[int, int]]) -> list[bytes]:
    press = zstandard.ZstdCompressor(level=1, write_content_size=True, write_checksum=False)
    head = struct.Struct(f"<{width + 1}I")
    # planes without any byte are not looked at run by run
    used = [planes.count(0, i * total, (i + 1) * total) < total for i in range(width)]
    out = []
    for first, last in runs:
        n = last - first
        zeros, parts = bytes(n), []
        for i in range(width):
            part = planes[i * total + first : i * total + last] if used[i] else zeros
            parts.append(b"" if part == zeros else min(part, press.compress(part), key=len))
        out.append(head.pack(n, *map(len, parts)) + b"".join(parts))
    return out


def spread_out(blob: bytes, width: int) -> bytes:
    """The planes that were squeezed."""
    return b"".join(_spread([blob], width)[1][0])


def spread_runs(blobs: list[bytes], width: int, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of all squeezed runs, one after another, and the number of each run."""
    counts, parts = _spread(blobs, width)
    counts = np.array(counts, dtype=np.int64)
    total = int(counts.sum())
    table = np.zeros((total, np.dtype(kind).itemsize), dtype=np.uint8)
    for i in range(width):
        plane = np.frombuffer(b"".join([p[i] for p in parts]), dtype=np.uint8)
        if plane.any():
            table[:, i] = plane
    return table.view(kind).reshape(total), counts


def _spread(blobs: list[bytes], width: int) -> tuple[list[int], list[list[bytes]]]:
    """The number of values of each blob, and its planes."""
    press = zstandard.ZstdDecompressor()
    head = struct.Struct(f"<{width + 1}I")
    counts, planes = [], []
    for blob in blobs:
        n, *sizes = head.unpack_from(blob)
        at, parts = head.size, []
        for size in sizes:
            part = blob[at : at + size]
            # a plane of zeros takes no bytes
            parts.append(bytes(n) if not size else part if size == n else press.decompress(part))
            at += size
        counts.append(n)
        planes.append(parts)
    return counts, planes


def slices(sizes: list[int], limit: int) -> list[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to `limit` or one item."""
    out, first, total = [], 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            out.append((first, i))
            first, total = i, 0
        total += size
    if first < len(sizes):
        out.append((first, len(sizes)))
    return out


def text_parts(texts: pa.Array, limit: int) -> Iterator[list[str | None]]:
    """The texts in consecutive parts of `limit` bytes or one text. A batch of Spark's holds a
    number of rows, however long; only a part of it is turned into Python strings at a time."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for first, last in slices(sizes, limit):
        yield texts[first:last].to_pylist()


def struct_array(kind: str, parts: Iterable[list[Sequence]]) -> pa.Array:
    """All rows of the parts as one array of structs; `kind` has the columns as in DDL."""
    names, types = zip(*(column.split() for column in kind.split(", ")))
    out = []
    for rows in chain([[]], parts):
        columns = zip(*rows) if rows else [()] * len(names)
        arrays = [pa.array(c, _ARROW[t]) for c, t in zip(columns, types)]
        out.append(pa.StructArray.from_arrays(arrays, names))
    return pa.concat_arrays(out)


def text_bytes(texts) -> list[bytes]:
    return [t.encode() if t is not None and t == t else b"" for t in texts]


def pressed(texts: pd.Series) -> pd.Series:
    """Each text compressed, NULL as the empty one."""
    press = zstandard.ZstdCompressor(level=3)
    return pd.Series([press.compress(t) for t in text_bytes(texts)], dtype=object)


def unpressed(texts: pd.Series) -> list[bytes]:
    press = zstandard.ZstdDecompressor()
    return [press.decompress(t) for t in texts]
