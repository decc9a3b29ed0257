"""Near-duplicates by one-permutation MinHash with optimal densification, banded buckets and star-shaped candidates.

A document's set is hashed once; the hash's top bits name one of `bins` bins and each bin keeps its minimum. Empty bins
borrow from bins that a fixed random sequence names, the same for all documents (optimal densification). Bands of the
sketch are bucket keys. In each bucket every member is a candidate of one centre only, the smallest id; candidates are
confirmed on the full sets.

A star can miss a link between two members that are both too far from its centre. Members of buckets that still hold
several components are therefore looked at again by an exact rule: two sets that are alike enough share one of their
rarest shingles (of n, the n - ceil(n * percent / 100) + 1 rarest). Each such shingle is a bucket; stars are drawn there,
and then the members of different components that a bucket still holds are paired where sizes, the shingle's place among
the rarest, and the distance of two 512-bit images of the sets leave an intersection large enough possible. These bounds
never exclude a link, so none between members of one sketch bucket is lost, and few pairs pass that aren't links. Keys of
many rows are broadcast or dealt into parts, never gathered in one task.

Documents with equal sets are one node from the start, so exact copies cost one sketch. Nulls, empties: null or blank
text has an empty set and is linked with nothing; texts of fewer words than a shingle have one shingle; repeated rows are
answered one by one; different texts of one doc_id are each linked on their own, and what both are linked with is one
component; a null doc_id takes no part (component_id null, kept false); extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, materialize, mix, prefix_sums, small_batches, span_hashes, split_join, text_slices, word_spans
from .graph import components, contracted

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Columns of a set's image, 64 bits each.
N_IMAGE = 8
IMAGE = [f"b{i}" for i in range(N_IMAGE)]


@dataclass(frozen=True)
class NearDupParams:
    shingle: int = 5
    #: Linked if 100 * intersection >= percent * union.
    percent: int = 85
    bins: int = 128
    bands: int = 25
    rows: int = 5
    #: Candidates of one centre that one task confirms, about.
    star_rows: int = 500
    #: Rows of one shingle's bucket that one task pairs with the bucket's other rows, about.
    bucket_rows: int = 4_000


def shingle_sets(column, p: NearDupParams):
    """Yields (first row, end row, counts, hashes): each row's distinct shingle hashes, sorted, one row after the other."""
    for i, j, buf, offs in text_slices(column):
        buf = LOWER[buf]
        starts, ends, doc = word_spans(buf, offs)
        words = span_hashes(prefix_sums(buf), starts, ends)
        n_words = np.bincount(doc, minlength=j - i)
        m = len(words) - p.shingle + 1
        if m > 0:
            inside = doc[:m] == doc[p.shingle - 1 :]
            h = np.zeros(m, np.uint64)
            for k in range(p.shingle):
                h = (h ^ words[k : k + m]) * np.uint64(0x9FB21C651E98DF25) + np.uint64(k + 1)
                h ^= h >> np.uint64(29)
            h, owner = mix(h[inside]), doc[:m][inside]
        else:
            h, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero((n_words > 0) & (n_words < p.shingle))
        if len(short):
            first = np.searchsorted(doc, short)
            one = np.full(len(short), 0x1234567, np.uint64)
            for k in range(p.shingle - 1):
                has = n_words[short] > k
                one[has] = mix((one[has] ^ words[first[has] + k]) * np.uint64(0xA0761D6478BD642F) + np.uint64(k))
            at = np.searchsorted(owner, short)
            h, owner = np.insert(h, at, one), np.insert(owner, at, short)
        bounds = np.searchsorted(owner, np.arange(j - i + 1))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            h[a:b].sort()
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        yield i, j, np.bincount(owner[new], minlength=j - i), h[new]


def densified(sketch: np.ndarray) -> np.ndarray:
    """Fills empty bins from non-empty ones that a sequence of hashes of the bin names."""
    bins = sketch.shape[1]
    row, col = np.nonzero((sketch == _EMPTY) & (sketch != _EMPTY).any(1, keepdims=True))
    source = sketch.copy()
    attempt = 1
    while len(row):
        at = (mix(col.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        got = source[row, at]
        hit = got != _EMPTY
        sketch[row[hit], col[hit]] = got[hit] + np.uint64(attempt)
        row, col, attempt = row[~hit], col[~hit], attempt + 1
    return sketch


def sketches(counts: np.ndarray, hashes: np.ndarray, p: NearDupParams) -> np.ndarray:
    """Bucket keys (rows x bands) of sets given as by shingle_sets; rows with an empty set hold no meaning."""
    owner = np.repeat(np.arange(len(counts)), counts)
    bin_of = (hashes >> np.uint64(64 - int(p.bins).bit_length() + 1)).astype(np.int64)
    cell = owner * p.bins + bin_of
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]  # sorted hashes: the first of a bin is its minimum
    sketch = np.full((len(counts), p.bins), _EMPTY, np.uint64)
    sketch.reshape(-1)[cell[first]] = hashes[first] >> np.uint64(1)
    sketch = densified(sketch)
    keys = np.zeros((len(counts), p.bands), np.uint64)
    for r in range(p.rows):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + sketch[:, r * p.bands : (r + 1) * p.bands])
    return keys


def _fingerprints(counts: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set."""
    ends, out = np.cumsum(counts), []
    for salt in (1, 2):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(h * np.uint64(2 * salt + 1) + np.uint64(salt)))])
        out.append((total[ends] - total[ends - counts]).view(np.int64))
    return out


def images(counts: np.ndarray, h: np.ndarray) -> np.ndarray:
    """512-bit images (rows x 8): a bit is set if a shingle of the set falls on it."""
    bits = np.zeros((len(counts), 64 * N_IMAGE), bool)
    bits[np.repeat(np.arange(len(counts)), counts), (h & np.uint64(64 * N_IMAGE - 1)).astype(np.int64)] = True
    return np.packbits(bits, axis=1).view(np.int64)


def _signatures(docs: DataFrame, p: NearDupParams) -> DataFrame:
    """doc_id, n_shingles, a 128-bit fingerprint of the set, and the bucket keys."""
    import pyarrow as pa

    small_batches(docs.sparkSession)
    from pyspark.sql.types import ArrayType, LongType

    schema = docs.select("doc_id").schema.add("n_shingles", LongType()).add("fp1", LongType()).add("fp2", LongType()).add("keys", ArrayType(LongType()))

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, counts, h in shingle_sets(batch.column("text"), p):
                keys = np.ascontiguousarray(sketches(counts, h, p)).view(np.int64).reshape(-1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, p.bands, dtype=np.int32)), pa.array(keys))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(counts.astype(np.int64)), *map(pa.array, _fingerprints(counts, h)), lists], names=[f.name for f in schema.fields])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _full_sets(docs: DataFrame, ids: DataFrame, p: NearDupParams) -> DataFrame:
    """doc_id, sid (of one set of it), the set and its image, for the documents in ids."""
    import pyarrow as pa
    from pyspark.sql.types import ArrayType, LongType

    schema = docs.select("doc_id").schema.add("sid", LongType()).add("shingles", ArrayType(LongType()))
    for name in IMAGE:
        schema = schema.add(name, LongType())

    def run(batches):
        for batch in batches:
            own = batch.column("doc_id")
            for i, j, counts, h in shingle_sets(batch.column("text"), p):
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(h.view(np.int64)))
                image = np.ascontiguousarray(images(counts, h).T)
                yield pa.RecordBatch.from_arrays([own.slice(i, j - i), pa.array(_fingerprints(counts, h)[0]), lists, *map(pa.array, image)], names=[f.name for f in schema.fields])

    asked = docs.select("doc_id", "text").join(ids.hint("shuffle_hash"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return asked.mapInArrow(run, schema)


def _confirmed(pairs: DataFrame, sets: DataFrame, p: NearDupParams) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough; a centre with many candidates is dealt out in parts."""
    many = pairs.groupBy("b").agg(F.count("*").alias("n")).filter(F.col("n") > p.star_rows).select("b", (F.col("n") / p.star_rows).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(0)) + 1
    left = pairs.join(many, "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), parts).cast("int").alias("part"))
    left = left.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")).join(many, "b", "left").select("b", "sb", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))).alias("part"))
    both = F.size(F.array_intersect("sa", "sb"))
    shared = left.join(right, ["b", "part"]).select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), both.alias("x"))
    return shared.filter(100 * F.col("x") >= p.percent * (F.col("na") + F.col("nb") - F.col("x"))).select("a", "b").distinct()


def _rarest(sets: DataFrame, p: NearDupParams) -> DataFrame:
    """s, doc_id, sid, n, i: the shingles of each set of which two sets that are alike enough share one, i before each."""
    each = sets.select("doc_id", "sid", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    count = materialize(each.groupBy("s").agg(F.count("*").alias("df")), "shingles")
    total = count.agg(F.sum("df")).first()[0] or 0
    every = split_join(each, count, ["s"], "df", total)
    ranked = every.groupBy("doc_id", "sid", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("r"))  # one set's shingles
    first = F.slice("r", F.lit(1), (F.col("n") - F.ceil(F.col("n") * F.lit(p.percent) / 100) + 1).cast("int"))
    return ranked.select("doc_id", "sid", "n", F.posexplode(first).alias("i", "r")).filter("r.df > 1").select(F.col("r.s").alias("s"), "doc_id", "sid", "n", "i")


def _may_link(p: NearDupParams, x: str, y: str) -> Column:
    """Whether two rows of one shingle's bucket, in different components, can be alike enough."""
    a, b = (lambda name: F.col(f"{x}.{name}")), (lambda name: F.col(f"{y}.{name}"))
    sizes = a("n") + b("n")
    left = F.least(a("n") - a("i"), b("n") - b("i"))  # if this is the first shingle that both have
    apart = sum((F.bit_count(a(k).bitwiseXOR(b(k))) for k in IMAGE), F.lit(0))  # at most the symmetric difference
    return (a("c") != b("c")) & ((100 + p.percent) * left >= p.percent * sizes) & ((100 + p.percent) * (sizes - apart) >= 2 * p.percent * sizes)


def _named(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with c, the component of doc_id."""
    return rows.join(found.withColumnRenamed("v", "doc_id"), "doc_id", "left").withColumn("c", F.coalesce("c", "doc_id"))


def _still_mixed(rows: DataFrame, by: list[str]) -> DataFrame:
    """The rows of buckets that hold several components, with n_rows of their bucket."""
    rows = materialize(rows, "rows")
    kinds = rows.groupBy(*by).agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n_rows")).filter("lo <> hi").select(*by, "n_rows")
    return split_join(rows, materialize(kinds, "mixed"), by, "n_rows", rows.count())


def near_duplicates(docs: DataFrame, params: NearDupParams | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, one row for each row of docs (doc_id, text)."""
    p = params or NearDupParams()
    sig = materialize(_signatures(docs, p), "signatures")
    some = sig.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = materialize(some.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_docs")), "classes")
    reps = some.join(classes.select(F.col("rep").alias("doc_id"), "fp1", "fp2"), ["doc_id", "fp1", "fp2"]).dropDuplicates(["doc_id", "fp1", "fp2"])
    members = materialize(reps.select("doc_id", F.posexplode("keys").alias("band", "key")), "members")
    stars = members.groupBy("band", "key").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last"), F.count("*").alias("n_rows")).filter("centre <> last").drop("last")
    buckets = materialize(split_join(members, materialize(stars, "stars"), ["band", "key"], "n_rows", members.count()).select("band", "key", "doc_id", "centre"), "buckets")
    sets = materialize(_full_sets(docs, buckets.select("doc_id").distinct(), p), "sets")
    tested = buckets.filter("doc_id <> centre").select(F.col("doc_id").alias("a"), F.col("centre").alias("b")).distinct()
    found = components(materialize(_confirmed(materialize(tested, "pairs"), sets, p), "links"))
    # a centre has been compared with all members; what may still be linked is members of different components
    own = _named(buckets.filter("doc_id <> centre").select("band", "key", "doc_id"), found)
    open_ids = materialize(_still_mixed(own, ["band", "key"]).select("doc_id").distinct(), "open")
    near = sets.join(open_ids, "doc_id", "left_semi")
    rare = _still_mixed(_named(_rarest(near, p), found), ["s"])
    rare = materialize(rare.drop("n_rows").join(near.select("doc_id", "sid", *IMAGE), ["doc_id", "sid"]), "rare")
    facts = F.struct("doc_id", "n", "i", "c", *IMAGE)
    centres = rare.groupBy("s").agg(F.min(facts).alias("y"), F.count("*").alias("n_rows"))
    drawn = split_join(rare.select("s", facts.alias("x")), materialize(centres, "centres"), ["s"], "n_rows", rare.count()).filter(_may_link(p, "x", "y"))
    drawn = materialize(drawn.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct(), "pairs")
    found = contracted(found, materialize(_confirmed(drawn, sets, p), "links"))
    rest = materialize(_still_mixed(_named(rare.drop("c"), found), ["s"]).withColumn("parts", (F.col("n_rows") / p.bucket_rows).cast("int") + 1), "rest")
    one = rest.select("s", F.pmod(F.xxhash64("doc_id", "sid"), "parts").cast("int").alias("part"), facts.alias("x"))
    other = rest.select("s", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), facts.alias("y"))
    pairs = one.join(other, (one["s"] == other["s"]) & (one["part"] == other["part"]) & (F.col("x.doc_id") > F.col("y.doc_id")) & _may_link(p, "x", "y"))
    pairs = materialize(pairs.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct(), "pairs")
    found = contracted(found, materialize(_confirmed(pairs, sets, p), "links"))
    named = materialize(classes.join(found.withColumnRenamed("v", "rep"), "rep", "left").select("fp1", "fp2", "n_docs", F.coalesce("c", "rep").alias("root")), "roots")
    out = split_join(some.select("doc_id", "n_shingles", "fp1", "fp2"), named, ["fp1", "fp2"], "n_docs", sig.count()).select("doc_id", "n_shingles", F.col("root").alias("component_id"))
    alone = sig.filter("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
