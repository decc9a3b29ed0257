"""Exact removal of long repeats with a logarithmic family of suffix arrays.

Suffixes enter at anchors: the k-byte strings that are smallest by hash among those of some `length`-byte string. Which
strings are anchors depends on the bytes around them alone, so equal strings hold equal anchors wherever they stand, and
only about one suffix in 77 is indexed. Suffixes are ordered by fingerprint rather than by the alphabet (which are equal
matters here, not which is smaller), and dealt over tasks by it.

An index family takes suffixes in batches. Each batch becomes a sorted array; it is scanned for neighbours that match,
merge-scanned against the arrays of the existing levels for matches, and what is new becomes a level; levels of equal
size merge, so that sizes are geometric. Two rounds use it. The first takes each anchor's suffix with what stands before
it, as far as strings of `length` bytes that hold the anchor reach: matches are repeats as a whole. The second takes, of
anchors whose k bytes also begin other surroundings, one anchor of each surroundings, and of these every suffix that
begins a string of `length` bytes holding the anchor: matches of that length are repeated strings, and the farthest and
nearest of each anchor give the interval that its repeats cover. There, bytes of both are compared before it counts.
Surroundings that are equal are counted before they are dealt out; prefixes with very many different surroundings are
dealt by their strings' fingerprints instead of by prefix, so no task holds them all.

Equality in the first round is of 128 bits of fingerprint, in the second of bytes.

Nulls, empties: null text is empty; texts shorter than `length` lose nothing; a null doc_id is an ordinary value;
repeated rows repeat each other and so lose all that is long enough; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BYTE, _powers, materialize, mix, prefix_sums, small_batches, span_hashes, text_slices


@dataclass(frozen=True)
class SuffixParams:
    length: int = 200
    anchor: int = 48
    #: Suffixes of one batch of the family, about.
    batch_keys: int = 1 << 18
    #: Anchors, and surroundings, that one task indexes, about.
    task_anchors: int = 500_000
    task_rows: int = 8_000
    #: Different surroundings of one prefix beyond which their strings are dealt over tasks.
    group_rows: int = 20_000


class IndexFamily:
    """Suffix arrays of geometric sizes: sorted keys of distinct suffixes, and a number for each."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Takes a batch and returns its matches as pairs of numbers (of the batch, of the suffix that was there before)."""
        order = np.argsort(keys, kind="stable")
        keys, numbers = keys[order], numbers[order]
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        group = np.cumsum(first) - 1
        single, own = keys[first], numbers[first]
        before, open_ = own.copy(), np.arange(len(own))
        for level, theirs in self.levels:
            at = np.minimum(np.searchsorted(level, single[open_]), len(level) - 1)
            same = level[at] == single[open_]
            before[open_[same]] = theirs[at[same]]
            open_ = open_[~same]
        match = ~first
        match[np.flatnonzero(first)[before != own]] = True
        matches = numbers[match], before[group[match]]
        keys, numbers = single[open_], own[open_]
        while self.levels and len(self.levels[-1][0]) <= len(keys):
            level, own = self.levels.pop()
            keys, numbers = np.concatenate([level, keys]), np.concatenate([own, numbers])
            order = np.argsort(keys, kind="stable")  # two sorted runs: a merge
            keys, numbers = keys[order], numbers[order]
        if len(keys):
            self.levels.append((keys, numbers))
        return matches


def _sliding(v: np.ndarray, w: int, best=np.minimum) -> np.ndarray:
    """Minimum (or maximum) of each w consecutive values."""
    n = len(v)
    pad = np.full(-n % w, np.uint64(0xFFFFFFFFFFFFFFFF) if best is np.minimum else np.uint64(0))
    blocks = np.concatenate([v, pad]).reshape(-1, w)
    head = best.accumulate(blocks, axis=1).reshape(-1)
    tail = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(tail[: n - w + 1], head[w - 1 : n])


def anchors(buf: np.ndarray, offs: np.ndarray, p: SuffixParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, 64-bit prefix keys, rows) of the indexed suffixes."""
    n, w = len(buf), p.length - p.anchor + 1
    none = np.zeros(0, np.int64)
    if n < p.length:
        return none, np.zeros(0, np.uint64), none
    sums = prefix_sums(buf)
    _, q = _powers(n + 1)
    m = n - p.anchor + 1
    key = mix((sums[p.anchor :] - sums[:m]) * q[:m]) | np.uint64(1)
    del sums
    low = _sliding(key, w)
    ends = np.repeat(offs[1:], np.diff(offs))[: len(low)]
    low[np.arange(len(low)) + p.length > ends] = 0  # strings that lie in no one row
    # the least key of some string: the largest of the minima of all strings that hold it is its own
    edge = np.zeros(w - 1, np.uint64)
    place = np.flatnonzero(_sliding(np.concatenate([edge, low, edge]), w, np.maximum) == key)
    return place, key[place], np.searchsorted(offs, place, "right") - 1


def _occurrences(docs: DataFrame, p: SuffixParams) -> DataFrame:
    """key, around (a hash of the surroundings), doc_id, version, pos of each anchor."""
    import pyarrow as pa
    from pyspark.sql.types import IntegerType, LongType

    before = p.length - p.anchor
    schema = docs.select("doc_id", "version").schema
    for name, kind in (("key", LongType()), ("around", LongType()), ("pos", IntegerType())):
        schema = schema.add(name, kind)

    def run(batches):
        for batch in batches:
            for i, _, buf, offs in text_slices(batch.column("text")):
                place, keys, row = anchors(buf, offs, p)
                first, end = np.maximum(offs[row], place - before), np.minimum(offs[row + 1], place + p.length)
                around = mix(span_hashes(prefix_sums(buf), first, end) + (place - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                at, pos = pa.array(row + i), place - offs[row]
                arrays = [batch.column("doc_id").take(at), batch.column("version").take(at), *(pa.array(x.view(np.int64)) for x in (keys, around)), pa.array(pos.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])

    return docs.select("doc_id", "version", "text").mapInArrow(run, schema)


KINDS_SCHEMA = "key long, around long, place long, n long"


def _long_columns(batch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns]


def _matched(p: SuffixParams):
    """A function over batches of (key, around, place, n): distinct suffixes with their surroundings, and how often each stands."""
    import pyarrow as pa

    def run(batches):
        family, held, size, total = IndexFamily(), [], 0, []
        kept: list[list[np.ndarray]] = []
        have = 0

        def take():
            nonlocal held, size, have
            key, around, place, n = (np.concatenate(c) for c in zip(*held, strict=True))
            number = np.arange(have, have + len(key))
            ours, theirs = family.add(mix(key ^ mix(around)), number)
            count = n.astype(np.int64)
            new = np.ones(len(key), bool)
            new[ours - have] = False
            kept.append([key, around, place, new])
            total.append(count)
            have += len(key)
            held, size = [], 0
            return ours, theirs

        pairs = []
        for batch in batches:
            held.append(_long_columns(batch))
            size += batch.num_rows
            if size >= p.batch_keys:
                pairs.append(take())
        if held:
            pairs.append(take())
        if not have:
            return
        count = np.concatenate(total)
        for ours, theirs in pairs:
            np.add.at(count, theirs, count[ours])
        key, around, place, new = (np.concatenate(c) for c in zip(*kept, strict=True))
        columns = [pa.array(c[new].view(np.int64)) for c in (key, around, place)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(count[new])], names=["key", "around", "place", "n"])

    return run


def _place():
    return F.xxhash64("version", "pos")


def _kinds(found: DataFrame, rows: int, p: SuffixParams) -> DataFrame:
    """key, around, place (of one of them), n of each distinct suffix with its surroundings; equal ones are counted before they are dealt out."""
    small = found.select("key", "around", _place().alias("place"), F.lit(1).cast("long").alias("n")).mapInArrow(_matched(p), KINDS_SCHEMA)
    return small.repartition(rows // p.task_anchors + 1, "key", "around").mapInArrow(_matched(p), KINDS_SCHEMA)


def _surroundings(docs: DataFrame, chosen: DataFrame, p: SuffixParams) -> DataFrame:
    """key, doc_id, version, pos, left, right, around (bytes) of the chosen anchors (doc_id, version, pos, key)."""
    import pyarrow as pa
    from pyspark.sql.types import BinaryType, IntegerType, LongType

    before, width = p.length - p.anchor, 2 * p.length - p.anchor
    schema = docs.select("doc_id", "version").schema
    for name, kind in (("key", LongType()), ("pos", IntegerType()), ("left", IntegerType()), ("right", IntegerType()), ("around", BinaryType())):
        schema = schema.add(name, kind)

    def run(batches):
        for batch in batches:
            lists = batch.column("at")
            counts = np.diff(np.asarray(lists.offsets))
            flat = lists.flatten()
            pos_all, key_all = (np.asarray(flat.field(i)) for i in (0, 1))
            row_all = np.repeat(np.arange(batch.num_rows), counts)
            for i, j, buf, offs in text_slices(batch.column("text")):
                lo, hi = np.searchsorted(row_all, [i, j])
                for s in range(lo, hi, 20_000):
                    e = min(hi, s + 20_000)
                    pos, key, row = pos_all[s:e].astype(np.int64), key_all[s:e], row_all[s:e]
                    a = offs[row - i] + pos
                    around = buf[np.clip(a[:, None] + np.arange(-before, p.length), 0, len(buf) - 1)]
                    offsets = pa.array(np.arange(0, (len(a) + 1) * width, width, dtype=np.int32)).buffers()[1]
                    blob = pa.Array.from_buffers(pa.binary(), len(a), [None, offsets, pa.py_buffer(around.tobytes())])
                    left, right = np.minimum(before, pos), np.minimum(p.length, offs[row - i + 1] - a)
                    at = pa.array(row)
                    arrays = [batch.column("doc_id").take(at), batch.column("version").take(at), pa.array(key), *(pa.array(x.astype(np.int32)) for x in (pos, left, right)), blob]
                    yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])

    by = chosen.groupBy("doc_id", "version").agg(F.sort_array(F.collect_set(F.struct("pos", "key"))).alias("at"))  # a text's own anchors
    by = by.select(F.col("doc_id").alias("d"), F.col("version").alias("v"), "at")
    on = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v"))
    return docs.join(by.hint("shuffle_hash"), on).select("doc_id", "version", "text", "at").mapInArrow(run, schema)


def window_hashes(around: np.ndarray, left: np.ndarray, right: np.ndarray, p: SuffixParams) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, validity), rows x (length - anchor + 1): column L is the string that begins L bytes before the anchor."""
    before = p.length - p.anchor
    power, inverse = _powers(around.shape[1] + 1)
    at, reach = before - np.arange(before + 1), np.arange(before + 1)
    hashes = np.empty((len(around), before + 1), np.uint64)
    for i in range(0, len(around), 2_000):  # the prefix sums are eight times the bytes
        part = around[i : i + 2_000]
        sums = np.zeros((len(part), around.shape[1] + 1), np.uint64)
        np.cumsum(_BYTE[part] * power[: around.shape[1]], axis=1, out=sums[:, 1:])
        hashes[i : i + 2_000] = mix((sums[:, at + p.length] - sums[:, at]) * inverse[at])
    return hashes, (reach <= left[:, None]) & (p.length - reach <= right[:, None])


def _as_matrix(column) -> np.ndarray:
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]].reshape(len(column), -1)


class Repeats:
    """The index family over all strings of some anchors' surroundings, and the interval of repeats of each anchor."""

    def __init__(self, p: SuffixParams):
        self.p, self.family, self.width = p, IndexFamily(), p.length - p.anchor + 1
        self.around: list[np.ndarray] = []
        self.rows = 0
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, key: np.ndarray, around: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        hashes, ok = window_hashes(around, left, right, self.p)
        reach = np.arange(self.width, dtype=np.uint64)
        flat = mix(hashes + mix(key[:, None] + reach) * np.uint64(0x9E3779B97F4A7C15))[ok]  # strings match at one place from one anchor
        numbers = np.flatnonzero(ok.reshape(-1)) + self.rows * self.width
        ours, theirs = self.family.add(flat, numbers)
        self.around.append(around)
        self.rows += len(key)
        # of the strings of one anchor that match, the nearest and the farthest are enough
        for mine, other in ((ours, theirs), (theirs, ours)):
            row = mine // self.width
            for order in (np.lexsort((mine, row)), np.lexsort((-mine, row))):
                first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
                self.pairs.append((mine[first], other[first]))

    def intervals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, nearest reach, farthest reach) of the rows that have a repeat, with bytes compared."""
        if not self.pairs:
            return (np.zeros(0, np.int64),) * 3
        around, w, size = np.concatenate(self.around), self.width, self.p.length
        mine, other = (np.concatenate(c) for c in zip(*self.pairs, strict=True))
        low, high = np.full(self.rows, w), np.full(self.rows, -1)
        for s in range(0, len(mine), 20_000):
            m, o = mine[s : s + 20_000], other[s : s + 20_000]
            same = np.ones(len(m), bool)
            for x in range(0, size, 50):  # a string begins (width - 1 - reach) bytes into the surroundings
                step = np.arange(x, min(size, x + 50))
                same &= (around[(m // w)[:, None], (w - 1 - m % w)[:, None] + step] == around[(o // w)[:, None], (w - 1 - o % w)[:, None] + step]).all(1)
            np.minimum.at(low, m[same] // w, m[same] % w)
            np.maximum.at(high, m[same] // w, m[same] % w)
        rows = np.flatnonzero(high >= 0)
        return rows, low[rows], high[rows]


def _resolve(near: DataFrame, p: SuffixParams) -> DataFrame:
    """doc_id, version, start, end from surroundings; all of one prefix are in one partition."""
    import pyarrow as pa
    from pyspark.sql.types import IntegerType

    schema = near.select("doc_id", "version").schema.add("start", IntegerType()).add("end", IntegerType())

    def run(batches):
        found, ids, pos = Repeats(p), [], []
        for batch in batches:
            for s in range(0, batch.num_rows, 2_000):
                b = batch.slice(s, 2_000)
                found.add(b.column("key").to_numpy().view(np.uint64), _as_matrix(b.column("around")), b.column("left").to_numpy(), b.column("right").to_numpy())
            ids.append(batch.select(["doc_id", "version"]))
            pos.append(batch.column("pos").to_numpy())
        if not ids:
            return
        rows, low, high = found.intervals()
        every, at = pa.Table.from_batches(ids).take(pa.array(rows)), np.concatenate(pos)[rows]
        columns = [every.column(c).combine_chunks() for c in ("doc_id", "version")]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) and c.num_chunks else c for c in columns]
        if len(rows):
            yield pa.RecordBatch.from_arrays([*columns, pa.array((at - high).astype(np.int32)), pa.array((at - low + p.length).astype(np.int32))], names=[f.name for f in schema.fields])

    return near.mapInArrow(run, schema)


def _resolve_hot(hot: DataFrame, p: SuffixParams) -> DataFrame:
    """The same for prefixes of very many surroundings: strings are counted by hash, which combines before the shuffle."""
    import pyarrow as pa

    def strings(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 2_000):
                b = batch.slice(s, 2_000)
                hashes, ok = window_hashes(_as_matrix(b.column("around")), b.column("left").to_numpy(), b.column("right").to_numpy(), p)
                row, reach = np.nonzero(ok)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([b.column(c).take(at) for c in ("doc_id", "version", "key", "pos")] + [pa.array(reach.astype(np.int64)), pa.array(hashes[ok].view(np.int64))], names=["doc_id", "version", "key", "pos", "reach", "h"])

    schema = hot.select("doc_id", "version", "key", "pos").schema.add("reach", "long").add("h", "long")
    each = hot.mapInArrow(strings, schema)
    by = ["key", "reach", "h"]
    twice = each.groupBy(*by).agg(F.count("*").alias("n")).filter("n > 1").select(*by)
    found = each.join(twice, by, "left_semi").groupBy("doc_id", "version", "key", "pos").agg(F.max("reach").alias("hi"), F.min("reach").alias("lo"))
    return found.select("doc_id", "version", (F.col("pos") - F.col("hi")).cast("int").alias("start"), (F.col("pos") - F.col("lo") + p.length).cast("int").alias("end"))


def repeats(docs: DataFrame, params: SuffixParams | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that stay), for each row of docs."""
    import pyarrow as pa
    from pyspark.sql.types import BinaryType, LongType, StringType

    p = params or SuffixParams()
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("version", F.xxhash64("doc_id", "text"))
    found = materialize(_occurrences(docs, p), "occurrences")
    kinds = materialize(_kinds(found, found.count(), p), "kinds")
    open_keys = kinds.groupBy("key").agg(F.count("*").alias("k"), F.min("n").alias("least")).filter("k > 1 AND least = 1").select("key", "k")
    told = kinds.join(open_keys, "key", "left").filter("n > 1 OR k IS NOT NULL")
    sent = F.col("k").isNotNull() & ((F.col("n") == 1) | (_place() == F.col("place")))  # one anchor of each surroundings
    marked = found.join(told, ["key", "around"]).select("doc_id", "version", "pos", "key", "k", (F.col("n") > 1).alias("whole"), sent.alias("sent"))
    marked = materialize(marked.filter("whole OR sent"), "marked")
    spans = marked.filter("whole").select("doc_id", "version", (F.col("pos") - (p.length - p.anchor)).alias("start"), (F.col("pos") + p.length).alias("end"))
    chosen = marked.filter("sent").select("doc_id", "version", "pos", "key", "k")
    size = chosen.count()
    if size:
        near = _surroundings(docs, chosen, p)
        hot = materialize(chosen.filter(F.col("k") > p.group_rows).select("key").distinct(), "hot")
        parts = size // p.task_rows + 1
        if hot.isEmpty():
            spans = spans.unionByName(_resolve(near.repartition(parts, "key"), p))
        else:
            near = materialize(near, "near")
            spans = spans.unionByName(_resolve(near.join(hot, "key", "left_anti").repartition(parts, "key"), p))
            spans = spans.unionByName(_resolve_hot(near.join(hot, "key", "left_semi"), p))
    per_row = materialize(spans, "spans").groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # at most a row's own anchors
    per_row = per_row.select(F.col("doc_id").alias("d"), F.col("version").alias("v"), F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))
    joined = docs.join(per_row.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")), "left").select("doc_id", "text", "starts", "ends")
    schema = docs.select("doc_id").schema.add("n_bytes", LongType()).add("n_removed", LongType()).add("n_spans", LongType()).add("kept_sha256", StringType()).add("kept", BinaryType())

    def cut(batches):
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for text, starts, ends in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                raw, merged = text.encode(), []
                for a, b in sorted(zip(starts or [], ends or [], strict=True)):
                    a, b = max(0, a), min(len(raw), b)
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                left = b"".join(raw[a:b] for a, b in zip([0, *(b for _, b in merged)], [*(a for a, _ in merged), len(raw)], strict=True))
                for column, value in zip(out, (len(raw), len(raw) - len(left), len(merged), hashlib.sha256(left).hexdigest(), left), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names=[f.name for f in schema.fields])

    return joined.mapInArrow(cut, schema)
