"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts come from the labelled rows (a bounded sample of them, see max_train_docs). The log-probability matrix (buckets x
languages, float32) is broadcast in blocks of languages. Documents are scored in batches in numpy, whole: the n-grams of
all texts of a batch are the sparse rows, each n-gram gathers its matrix row, and the sums are taken by document.

Nulls, empties: null text, or text without a letter, is `und` with score 0; null langs teach nothing, nor do rows of a
null doc_id; without any labelled row everything is `und`; a long text is scored in steps that overlap, so no n-gram is
lost or made up; repeated rows are predicted one by one; ties go to the language first in order; extra columns are
ignored, or kept in `row`, whatever their names.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

UND = "und"


@dataclass(frozen=True)
class LangIdParams:
    n_buckets: int = 1 << 15
    orders: tuple[int, ...] = (1, 2, 3)
    alpha: float = 0.5
    #: Bound on the labelled rows that are learned from; beyond it a share of them is taken by a hash of doc_id.
    max_train_docs: int = 20_000
    #: Languages of one broadcast block of the matrix.
    block_langs: int = 64
    #: Characters of one vectorised step.
    step_chars: int = 1 << 17


_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """By code point of the basic plane: the lower-case letter, or a space for what is no letter."""
    if not _TABLE:
        table = np.full(1 << 16, 32, np.uint16)
        for cp in range(1 << 16):
            if unicodedata.category(c := chr(cp))[0] == "L":
                low = c.lower()
                table[cp] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else cp
        _TABLE.append(table)
    return _TABLE[0]


def _chars(text: str) -> np.ndarray:
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    high = cps >= 1 << 16
    out = _letters()[np.minimum(cps, 0xFFFF)].astype(np.uint32)
    if high.any():  # beyond the basic plane: letters keep their code point
        out[high] = [cp if chr(cp).isalpha() else 32 for cp in cps[high].tolist()]
    return out


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(characters, number of the text of each): each text between spaces, runs of non-letters taken as one space."""
    own = [_chars(" " + t + " ") for t in texts]
    c = np.concatenate(own)
    row = np.repeat(np.arange(len(own), dtype=np.int32), [len(x) for x in own])
    new = np.ones(len(c), bool)
    new[1:] = (c[1:] != 32) | (c[:-1] != 32) | (row[1:] != row[:-1])
    return c[new], row[new]


def _grams(c: np.ndarray, row: np.ndarray, p: LangIdParams) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of each n-gram that holds a letter and lies in one text, by order and in steps."""
    reach = max(p.orders)
    for at in range(0, len(c), p.step_chars):
        end = min(len(c), at + p.step_chars)
        part, owner = c[at : end + reach - 1], row[at : end + reach - 1]
        h = np.zeros(len(part), np.uint32)
        letter = np.zeros(len(part), bool)
        for n in range(1, reach + 1):
            m = min(len(part) - n + 1, end - at)
            if m <= 0:
                break
            h = h[:m] * np.uint32(0x01000193) ^ (part[n - 1 : n - 1 + m] * np.uint32(0x9E3779B1))
            letter = letter[:m] | (part[n - 1 : n - 1 + m] != 32)
            if n in p.orders:
                ok = letter & (owner[:m] == owner[n - 1 : n - 1 + m])
                b = h ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
                b = (b ^ (b >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                b = (b ^ (b >> np.uint32(12))) & np.uint32(p.n_buckets - 1)
                yield b[ok], owner[:m][ok]


def _batches(texts: list[str | None], p: LangIdParams) -> Iterator[list[int]]:
    """Numbers of the texts that have characters, about a step's worth at a time."""
    held, n = [], 0
    for i, t in enumerate(texts):
        if t:
            held.append(i)
            n += len(t)
            if n >= p.step_chars:
                yield held
                held, n = [], 0
    if held:
        yield held


def gram_counts(texts: list[str], p: LangIdParams) -> np.ndarray:
    """Counts by bucket of the n-grams of texts."""
    out = np.zeros(p.n_buckets, np.int64)
    for part in _batches(texts, p):
        for b, _ in _grams(*_joined([texts[i] for i in part]), p):
            out += np.bincount(b, minlength=p.n_buckets)
    return out


def _training(docs: DataFrame, train: Column, p: LangIdParams) -> DataFrame:
    rows = docs.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = rows.count()
    if n > p.max_train_docs:
        share = int(p.max_train_docs / n * (1 << 30))
        rows = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)) < share)
    return rows.select("lang", "text")


def fit(docs: DataFrame, train: Column, params: LangIdParams | None = None) -> tuple[list[str], np.ndarray]:
    """(languages in order, log-probability matrix with a last column for the prior); all languages of the rows learned from."""
    import pyarrow as pa

    p = params or LangIdParams()
    small_batches(docs.sparkSession)

    def count(batches):
        for batch in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                n = gram_counts(texts, p)
                at = np.flatnonzero(n)
                arrays = [pa.array([lang] * (len(at) + 1), pa.string()), pa.array([*at.tolist(), -1], pa.int32()), pa.array([*n[at].tolist(), len(texts)], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "bucket", "n"])

    counted = _training(docs, train, p).mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    of = {}
    for r in counted.collect():  # n-grams of max_train_docs documents at most
        of.setdefault(r.lang, {})[r.bucket] = r.n
    langs = sorted(of)
    if not langs:
        return [], np.zeros((0, p.n_buckets + 1), np.float32)
    prior = np.array([of[k].pop(-1) for k in langs], np.float64)
    logp = np.empty((len(langs), p.n_buckets + 1), np.float32)
    for i, k in enumerate(langs):
        n = np.zeros(p.n_buckets)
        n[list(of[k])] = list(of[k].values())
        logp[i, :-1] = np.log(n + p.alpha) - np.log((n + p.alpha).sum())
    logp[:, -1] = np.log(prior / prior.sum())
    return langs, logp


def predict_texts(texts: list[str | None], langs: list[str], blocks: list[np.ndarray], p: LangIdParams) -> tuple[list[str], np.ndarray]:
    """(language, posterior) of each text; blocks: rows of the matrix by bucket, some languages each."""
    out, score = [UND] * len(texts), np.zeros(len(texts))
    if not langs:
        return out, score
    for part in _batches(texts, p):
        c, row = _joined([texts[i] for i in part])
        sums = np.concatenate([np.repeat(b[-1:].astype(np.float64), len(part), 0) for b in blocks], 1)
        for bucket, owner in _grams(c, row, p):
            if not len(bucket):
                continue
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            at = 0
            for block in blocks:
                width = block.shape[1]
                for k in range(0, width, 8):  # a few languages at a time bound what is gathered
                    sums[owner[first], at + k : at + min(width, k + 8)] += np.add.reduceat(block[bucket, k : k + 8].astype(np.float64), first, axis=0)
                at += width
        has = np.bincount(row[c != 32], minlength=len(part)) > 0
        sums -= sums.max(1, keepdims=True)
        best = sums.argmax(1)
        post = 1 / np.exp(sums).sum(1)
        for n, i in enumerate(part):
            if has[n]:
                out[i], score[i] = langs[best[n]], float(post[n])
    return out, score


def predict(docs: DataFrame, langs: list[str], logp: np.ndarray, params: LangIdParams | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """row (the columns `keep`), lang_pred and score of every row."""
    import pyarrow as pa

    p = params or LangIdParams()
    spark = docs.sparkSession
    small_batches(spark)
    sent = [spark.sparkContext.broadcast(np.ascontiguousarray(logp[i : i + p.block_langs].T)) for i in range(0, len(langs), p.block_langs)]
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), "text")
    schema = row.select("row").schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        for batch in batches:
            pred, score = predict_texts(batch.column("text").to_pylist(), langs, [x.value for x in sent], p)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(pred, pa.string()), pa.array(score)], names=["row", "lang_pred", "score"])

    return row.mapInArrow(run, schema)


def fold(mod: int) -> Column:
    """crc32 of doc_id as text, modulo mod."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod


def identify(docs: DataFrame, params: LangIdParams | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    langs, logp = fit(docs, fold(5) != 0, params)
    held = F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out")
    out = predict(docs, langs, logp, params)
    return out.select("row.doc_id", "lang_pred", "score").select("doc_id", held, "lang_pred", "score")
