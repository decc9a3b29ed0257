"""Exact top-k inner-product search: exhaustive term-at-a-time accumulation.

Queries come in chunks of a bounded size, which are broadcast one after another; each task inverts its block of rows into postings by
dimension, the sparse query rows scatter weight * posting into dense score arrays, partition selection keeps k rows a
query, and a window merges the tasks' lists.

Nulls, empties: vectors that are null, or hold a null or non-finite component, take no part; empty vectors score 0;
missing dimensions count as 0; rows that share the query's vec_id are its own and no candidates; a query id that
repeats is answered once, for its smallest vector; equal candidate rows stay as many rows; ties go to the smaller
vec_id; fewer than k candidates: all; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small_batches


@dataclass(frozen=True)
class TopKParams:
    k: int = 10
    scale: float = 1024.0
    #: Queries of one broadcast, and of one dense score array.
    chunk: int = 16_384
    block: int = 256


def valid(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantised(vec: Column, scale: float) -> Column:
    return F.transform(vec, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : min(len(v), width)] = v[:width]
    return out


def accumulate(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores of all rows for all queries, one dimension's postings at a time."""
    scores = np.zeros((len(queries), len(rows)), np.int64)
    for d in range(queries.shape[1]):
        terms = np.flatnonzero(queries[:, d])
        posting = np.flatnonzero(rows[:, d])
        if not len(terms) or not len(posting):
            continue
        add = np.multiply.outer(queries[terms, d], rows[posting, d])
        if len(posting) == len(rows):
            scores[terms] += add
        else:
            scores[np.ix_(terms, posting)] += add
    return scores


def select(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def topk(vectors: DataFrame, is_query: Column, params: TopKParams | None = None) -> DataFrame:
    """query_id, rank, vec_id, score over vectors(vec_id, embedding)."""
    import pyarrow as pa

    p = params or TopKParams()
    spark = vectors.sparkSession
    small_batches(spark, 4096)
    v = vectors.filter(F.col("vec_id").isNotNull() & valid(F.col("embedding"))).select("vec_id", quantised(F.col("embedding"), p.scale).alias("q"))
    asked = v.filter(is_query).groupBy("vec_id").agg(F.min("q").alias("q"))
    n_chunks = -(-asked.count() // p.chunk)
    schema = "query_id long, vec_id long, score long"
    parts = []
    for i in range(n_chunks):
        got = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_chunks)) == i).collect()  # about p.chunk rows
        width = max((len(r.q) for r in got), default=0)
        sent = spark.sparkContext.broadcast((np.array([r.vec_id for r in got], np.int64), matrix([r.q for r in got], width)))

        def run(batches, sent=sent, width=width):
            qid, q = sent.value
            best: list = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(qid)
            for batch in batches:
                ids = np.asarray(batch.column("vec_id").to_numpy(zero_copy_only=False), np.int64)
                column = batch.column("q")
                flat, offs = np.asarray(column.values), np.asarray(column.offsets)
                if width and len(ids) and (np.diff(offs) == width).all():
                    rows = flat[offs[0] : offs[-1]].reshape(len(ids), width)
                else:
                    rows = matrix(column.to_pylist(), width)
                for b in range(0, len(qid), p.block):
                    scores = accumulate(q[b : b + p.block], rows)
                    for n, row in enumerate(scores, b):
                        old_ids, old = best[n]
                        other = ids != qid[n]
                        both_ids, both = (ids, row) if other.all() else (ids[other], row[other])
                        at = select(both, both_ids, p.k)
                        both_ids, both = np.concatenate([old_ids, both_ids[at]]), np.concatenate([old, both[at]])
                        at = select(both, both_ids, p.k)
                        best[n] = both_ids[at], both[at]
            sizes = [len(x) for x, _ in best]
            if sum(sizes):
                arrays = [np.repeat(qid, sizes), np.concatenate([x for x, _ in best]), np.concatenate([s for _, s in best])]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["query_id", "vec_id", "score"])

        parts.append(materialize(v.mapInArrow(run, schema), "lists"))
        sent.unpersist()
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for x in parts[1:]:
        found = found.unionByName(x)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= p.k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024.0::DOUBLE * x::DOUBLE) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
