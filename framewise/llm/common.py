"""Helpers shared by the operators of this subpackage.

Words are hashed with numpy straight from Arrow's UTF-8 buffers: a byte class
says which bytes belong to a word, a prefix sum of byte codes times powers of
an odd number gives each word's 64-bit hash.  No Python object is made per
word, and long texts are hashed in blocks of bounded size.
"""

from __future__ import annotations

import functools
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.session import release_scratch, scratch_path

#: White space of the text contracts: U+0020 and U+0009 to U+000D.
SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])
SPACE_CHARS = SPACE_BYTES.decode()
#: Bytes hashed in one block.
BLOCK = 1 << 20
#: Bytes of text in one Arrow batch handed to Python.
BATCH_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_UPPER = "".join(map(chr, range(65, 91)))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the Python stages by bytes, so that a run of
    very long texts does not fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def write_scratch(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """A written table in the shared folder, read back with its known schema.
    ``tasks``: write with so many tasks at most, for a table of known size."""
    path = scratch_path(df.sparkSession, name)
    (df.coalesce(tasks) if tasks else df).write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._scratch = path
    return back


def drop_scratch(df: DataFrame) -> None:
    """Delete a table of ``write_scratch`` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(name: str) -> str:
    """A column name that no input column clashes with."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _UPPER.lower())


def keep_scratch(spark: SparkSession, since: int, *frames: DataFrame) -> None:
    """Delete the scratch tables written after the mark ``since`` but for those
    of ``frames``, which a result still reads."""
    release_scratch(spark, since, [f._scratch for f in frames])


def small_enough(df: DataFrame, limit_rows: int) -> bool:
    """Whether a written table has at most ``limit_rows`` rows (read from its
    file footers), the check before any broadcast."""
    return df.count() <= limit_rows


def maybe_broadcast(df: DataFrame, limit_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are within the bound;
    beyond it the join shuffles.  Rows are fixed-width keys."""
    return F.broadcast(df) if small_enough(df, limit_rows) else df


# ---------------------------------------------------------------- Arrow texts

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    a = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = a.buffers()
    off = np.frombuffer(offsets, np.int64)[a.offset:a.offset + len(a) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def flat(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=4)
def byte_codes(words: str, lower: bool) -> np.ndarray:
    """For each byte a non-zero random code, or 0 if it is no word byte.
    ``words``: "space" (all but white space) or "alnum" (digits, letters and
    everything beyond ASCII).  ``lower``: A-Z get the codes of a-z."""
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    if lower:
        codes[65:91] = codes[97:123]
    if words == "space":
        codes[list(SPACE_BYTES)] = 0
    else:
        keep = np.zeros(256, bool)
        keep[48:58] = keep[97:123] = keep[128:] = True
        keep[65:91] = lower
        codes[~keep] = 0
    return codes


def _powers(of: int) -> np.ndarray:
    p = np.full(BLOCK, of, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def word_hashes(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray):
    """Hash of every word, its byte start and end, and for each text the index
    of its first word (one entry more than texts)."""
    up, down = _tables()
    n, at, parts = len(data), 0, []
    is_word = codes != 0
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    while at < n:
        end = min(n, at + BLOCK)
        if end < n and is_word[data[end - 1]] and is_word[data[end]] and not first[end]:
            gaps = np.flatnonzero(~is_word[data[at:end]] | first[at + 1:end + 1])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # one word longer than a block: hash it by itself
                stop = end
                while stop < n and is_word[data[stop]] and not first[stop]:
                    stop += 1
                parts.append(_long_word(data[at:stop], codes, at))
                at = stop
                continue
        v = codes[data[at:end]]
        inside = v != 0
        breaks = first[at:end]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | breaks[1:]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | breaks[1:]
        s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        total = np.zeros(end - at + 1, np.uint64)
        np.cumsum(v * up[:end - at], out=total[1:])
        parts.append((mix((total[e] - total[s]) * down[s]), s + at, e + at))
        at = end
    if parts:
        h, s, e = (np.concatenate(x) for x in zip(*parts, strict=True))
    else:
        h, s, e = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return h, s, e, np.searchsorted(s, offsets)


def _long_word(data: np.ndarray, codes: np.ndarray, at: int):
    up, _ = _tables()
    total = np.uint64(0)
    step = np.uint64(pow(_BASE, BLOCK, 1 << 64))
    factor = np.uint64(1)
    with np.errstate(over="ignore"):
        for i in range(0, len(data), BLOCK):
            part = data[i:i + BLOCK]
            total += np.sum(codes[part] * up[:len(part)], dtype=np.uint64) * factor
            factor *= step
    return mix(np.array([total], np.uint64)), np.array([at]), np.array([at + len(data)])


def signed(x: np.ndarray) -> np.ndarray:
    """Hashes as Spark's signed longs."""
    return x.view(np.int64)
