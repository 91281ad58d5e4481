"""What the operators share: the working folder, folds, and word hashes over whole batches of texts."""

from __future__ import annotations

import functools
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from wayforge.session import shared_folder

#: ASCII capitals to small letters, as bytes.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def work_dir(spark: SparkSession) -> str:
    """The folder shared by driver and executors."""
    return f"{shared_folder(spark)}/wayforge"


class Staging:
    """Written tables in the shared folder: they cut lineage and outlive lost executors.

    ``keep`` writes a table and reads it back; ``drop`` deletes what is no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}", 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def keep(self, df: DataFrame, name: str, **options) -> DataFrame:
        path = self.path(name)
        df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_at = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            delete(self.spark, t._staged_at)

    def clear(self) -> None:
        delete(self.spark, self.root)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def fold(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null ids are in fold 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % n, F.lit(0))


def columns_of(df: DataFrame, *without: str) -> list[Column]:
    """The columns of df but those named, whatever their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in without]


def row_hash(df: DataFrame, *seed: Column) -> Column:
    """A hash of the whole row; maps and variants, which have none, are hashed as JSON."""

    def plain(t: DataType) -> bool:
        if isinstance(t, ArrayType):
            return plain(t.elementType)
        return all(plain(f.dataType) for f in t.fields) if isinstance(t, StructType) else not isinstance(t, MapType | VariantType)

    return F.xxhash64(*seed, *(c if plain(f.dataType) else F.to_json(F.struct(c)) for c, f in zip(columns_of(df), df.schema.fields)))


# -- word hashes ---------------------------------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at once; longer texts are cut between words.
CHUNK = 1 << 19
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables() -> list[np.ndarray]:
    if not _powers:
        up, down = np.full(CHUNK + 1, _BASE, np.uint64), np.full(CHUNK + 1, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers.extend([np.multiply.accumulate(up), np.multiply.accumulate(down), mix(np.arange(1, 257, dtype=np.uint64))])
    return _powers


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    up, down, table = _tables()
    raw = np.frombuffer(data, np.uint8)
    if len(raw) > CHUNK:  # one word longer than a chunk: fold it, chunk by chunk
        parts, last = [_piece(data[i : i + CHUNK]) for i in range(0, len(data), CHUNK)], np.uint64(0)
        with np.errstate(over="ignore"):
            for h, _ in parts:
                last = mix(np.asarray([last * np.uint64(31) + h[0]], np.uint64))[0]
        return np.asarray([last], np.uint64), np.asarray([0], np.int64)
    inside = np.empty(len(raw) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[raw], out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(table[raw] * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def word_hashes(data: bytes, table: bytes = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes and byte offsets of the words (runs without ASCII white space) of data, its bytes mapped by table first."""
    data = data.translate(table)
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        if end < len(data):
            cut = max(data.rfind(b, at, end) for b in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
            if cut > at:
                end = cut
            else:  # no white space in the whole chunk
                after = [i for b in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f") if (i := data.find(b, end)) >= 0]
                end = min(after, default=len(data))
                lead = len(data[at:end]) - len(data[at:end].lstrip())
                if lead:
                    at += lead
                    continue
        h, s = _piece(data[at:end])
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def batches(texts: list[bytes], limit: int = CHUNK):
    """(first, last) bounds of runs of texts of about ``limit`` bytes, so that arrays stay small."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= limit:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def hashed_texts(texts: list[bytes], table: bytes = LOWER):
    """Yields, per text, the hashes of its words."""
    for a, b in batches(texts):
        data = b"\n".join(texts[a:b])
        h, s = word_hashes(data, table)
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts[a:b])])
        cuts = np.searchsorted(s, bounds)
        for i in range(b - a):
            yield h[cuts[i] : cuts[i + 1]]


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words; with fewer words, of the whole sequence; of none, nothing."""
    if len(h) == 0:
        return h
    n = min(n, len(h))
    out = h[: len(h) - n + 1].copy()
    for i in range(1, n):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + h[i : len(h) - n + 1 + i])
    return mix(out + np.uint64(n))


def small(batches, rows: int = 1000):
    """Arrow batches cut into slices, so that a worker holds few texts as Python objects."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def as_texts(column) -> list[str | None]:
    """An Arrow string column as strings; bytes that are not UTF-8 become U+FFFD."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x if x is None else x.decode("utf-8", "replace") for x in column.cast(pa.binary()).to_pylist()]


def as_bytes(column) -> list[bytes]:
    """An Arrow string column as bytes; nulls as empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


# -- numbers in compressed blocks ------------------------------------------------------------------------------------


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting beats the hash table of np.unique on 64-bit hashes."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def places(keys: np.ndarray, want: np.ndarray, bits: int = 64) -> np.ndarray:
    """Places of ``want`` in sorted distinct keys that hold all of them; keys are hashes of so many bits, spread evenly."""
    if not len(want):
        return np.zeros(0, np.int64)
    width = len(keys).bit_length()
    shift = np.uint64(bits - width)
    at = np.searchsorted(keys >> shift, np.arange((1 << width) + 1, dtype=np.uint64))[(want >> shift).astype(np.int64)]
    todo = np.flatnonzero(keys[at] != want)
    while len(todo):
        at[todo] += 1
        todo = todo[keys[at[todo]] != want[todo]]
    return at


@functools.cache
def packer(level: int | None = None):
    """A Zstandard compressor of the level, or without one a decompressor."""
    import zstandard

    return zstandard.ZstdDecompressor() if level is None else zstandard.ZstdCompressor(level=level)


def encode(values: np.ndarray) -> bytes:
    """Unsigned integers byte plane by byte plane, compressed."""
    values = np.ascontiguousarray(values)
    return packer(1).compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()) if len(values) else b""


def decode(data: bytes, kind) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    raw = np.frombuffer(packer().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def encode_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as their differences."""
    return encode(np.diff(keys, prepend=np.uint64(0)))


def decode_keys(data: bytes) -> np.ndarray:
    return np.cumsum(decode(data, np.uint64), dtype=np.uint64)


def block_edges(blocks: int, bits: int = 64, first: int = 0, last: int | None = None) -> np.ndarray:
    """Lower bounds of equal ranges of keys, or of those from ``first`` to before ``last``."""
    return np.asarray([(k << bits) // blocks for k in range(first, blocks if last is None else last)], dtype=np.uint64)
