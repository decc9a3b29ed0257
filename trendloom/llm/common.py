"""Shared helpers: scratch tables in the cluster's shared folder, Arrow batches cut by bytes, and vectorised word hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of every contract here: space, tab, LF, VT, FF, CR.
WS_CLASS = r"[\x20\x09-\x0D]+"
NON_WS_CLASS = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one vectorised step handles; a longer document is a step of its own.
SLICE_BYTES = 1 << 21
#: Rows per Arrow batch, so that a batch of ordinary documents stays within a few MB.
ARROW_ROWS = 1024
#: Keys that a join may broadcast because each holds more than one part in so many of all rows.
HOT_KEYS = 2000


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the session names; it must be set, since a folder of one machine loses rows on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and spark.sparkContext.master.startswith("local"):
        root = spark.conf.get("spark.sql.warehouse.dir")  # driver and executors are one process here
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root.rstrip("/")


def materialize(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write df as Parquet below the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/trendloom/{uuid.uuid4().hex}/{tag}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the Arrow batches that Python workers get, never raising a smaller setting, and let workers import this package."""
    env, home = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if home not in (paths := env.get("PYTHONPATH", "").split(":")):
        env["PYTHONPATH"] = ":".join(filter(None, [*paths, home]))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def let(value: Column, body) -> Column:
    """body(v) with v bound to value, which is computed once even where body uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def rows_at_most(df: DataFrame, limit: int) -> bool:
    """Whether df has at most limit rows; reads no more than limit + 1 of them."""
    return df.limit(limit + 1).count() <= limit


def checked_broadcast(df: DataFrame, limit: int = 2000) -> DataFrame:
    """A broadcast hint where df is known to be small; otherwise df itself, and the planner shuffles."""
    return F.broadcast(df) if rows_at_most(df, limit) else df


def split_join(left: DataFrame, right: DataFrame, on: list[str], rows: str, total: int, how: str = "inner") -> DataFrame:
    """left joined with right, which has one row for each key and in `rows` how many rows of left have that key.

    Keys of more than 1 / HOT_KEYS of all `total` rows of left, so HOT_KEYS at most, are joined by broadcast, and no task
    gets all rows of a hot key; the others are shuffled. right should be materialised.
    """
    key = F.xxhash64(*on)
    hot = [r.h for r in right.filter(F.col(rows) > max(1, total // HOT_KEYS)).select(key.alias("h")).distinct().collect()]  # HOT_KEYS at most
    if not hot:
        return left.join(right, on, how)
    spread = left.filter(key.isin(hot)).join(F.broadcast(right.filter(key.isin(hot))), on, how)
    return spread.unionByName(left.filter(~key.isin(hot)).join(right.filter(~key.isin(hot)), on, how))


# --- numpy over the UTF-8 bytes of an Arrow string column -------------------------------------------------------

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
IS_WS = np.zeros(256, bool)
IS_WS[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POWERS or len(_POWERS["p"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for key, base in (("p", _P), ("q", _P_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps)
    return _POWERS["p"], _POWERS["q"]


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Prefix sums from which span_hashes gets the hash of any span of buf."""
    p, _ = _powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * p[: len(buf)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end)."""
    _, q = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * q[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def text_slices(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) over an Arrow string column, about SLICE_BYTES each; null is empty."""
    import pyarrow as pa

    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + SLICE_BYTES, "right")) - 1)
        yield i, j, raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row of each) of the maximal runs of non-white bytes; no run crosses a row's end."""
    n = len(buf)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    word = ~IS_WS[buf]
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    inner = offs[(offs > 0) & (offs < n)]
    begin[inner] = word[inner]
    end[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1
