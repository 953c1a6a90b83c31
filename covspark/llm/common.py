"""Helpers shared by the operators: the shared folder, reading tables, Arrow text as numpy bytes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that one numpy step handles at once; a longer single text is taken alone.
SLICE_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a scratch folder only for a local session without one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="covspark-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def source_key(column: str = "source"):
    """A non-null join key: null and every string stay apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))


def crc_mod(column: str, mod: int):
    """crc32 of an id as text, modulo ``mod``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % mod


def bit_filter(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bit set over the top ``bits`` bits of the 64-bit keys: 2 ** bits / 64 words, however many keys there are."""
    top = keys.select(F.shiftrightunsigned(column, 64 - bits).alias("t"))
    got = (top.groupBy(F.shiftright("t", 6).alias("w"))
           .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("t") % 64).cast("int"))).alias("b")).toPandas())
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[got["w"].to_numpy(np.int64)] = got["b"].to_numpy(np.int64).view(np.uint64)
    return words


def in_filter(words: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Which keys (unsigned) may be in the set; others surely are not."""
    t = keys >> np.uint64(64 - bits)
    return ((words[(t >> np.uint64(6)).astype(np.int64)] >> (t & np.uint64(63))) & np.uint64(1)).astype(bool)


# -- text as numpy ------------------------------------------------------------

def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n+1 offsets of an Arrow string column (null: empty)."""
    arr = arr.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_slices(batch: pa.RecordBatch, column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of at most ``limit`` bytes of text (one row at least): (rows, bytes, offsets)."""
    data, offsets = text_bytes(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (wrapping arithmetic)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_TABLE = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93)) | _U(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base and of its inverse modulo 2**64."""
    if len(_powers[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, _U)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """cum[i]: polynomial hash of data[:i]; ``span_hash`` takes differences of it."""
    p, _ = powers(len(data))
    cum = np.zeros(len(data) + 1, _U)
    np.cumsum(_TABLE[data] * p[:len(data)], out=cum[1:])
    return cum


def span_hash(cum: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of data[begin:end], alike wherever the same bytes stand."""
    _, inv = powers(len(cum))
    return mix((cum[end] - cum[begin]) * inv[begin] + (end - begin).astype(_U) * _U(0xA24BAED4963EE407))


def word_spans(data: np.ndarray, offsets: np.ndarray,
               gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and the first word of each row (n+1).  ``gaps``: the bytes between words; by
    default a word is ``[^\\x20\\x09-\\x0D]+``."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = ~gaps[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    begin = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return begin, end, np.searchsorted(begin, offsets)


_STEP = [mix(np.array([k], _U))[0] | _U(1) for k in range(11, 11 + 8)]


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word shingles of each row, words lower-cased in A-Z, and row offsets (n+1).

    A row with fewer words has its whole sequence as one shingle; without words it has none."""
    begin, end, first = word_spans(data, offsets)
    w = span_hash(prefix_hash(LOWER[data]), begin, end)
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    out = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    full = np.zeros(max(0, len(w) - width + 1), _U)
    for k in range(width if len(full) else 0):
        full += w[k:k + len(full)] * _STEP[k]
    at = np.arange(out[-1]) - np.repeat(out[:-1] - first[:-1], count)
    short = np.repeat(n < width, count)
    h = np.zeros(int(out[-1]), _U)
    h[~short] = mix(full[at[~short]])
    for row in np.flatnonzero((n > 0) & (n < width)):
        s = _U(0)
        with np.errstate(over="ignore"):
            for k in range(int(n[row])):
                s += w[first[row] + k] * _STEP[k]
            h[out[row]] = mix(np.array([s + _U(int(n[row])) * _STEP[7]], _U))[0]
    return h, out


def add_text_columns(docs: DataFrame, added: str, fn, keep: list[str] | None = None,
                     limit: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with the columns of the DDL ``added``, made by ``fn(rows, bytes, offsets) -> arrays`` slice by
    slice from ``text``.  Input columns that have one of the new names are replaced."""
    new = SparkSession.getActiveSession().createDataFrame([], added).schema
    names = [f.name for f in new.fields]
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in names]
    given = docs.select(*[F.col(f"`{c}`") for c in keep],
                        *([] if "text" in keep else [F.col("text")]))
    schema = given.select(*[F.col(f"`{c}`") for c in keep]).schema
    for f in new.fields:
        schema = schema.add(f)
    out_names = [*keep, *names]

    def run(batches):
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text", limit):
                made = fn(rows, data, offsets)
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], *made], names=out_names)

    return given.mapInArrow(run, schema)
