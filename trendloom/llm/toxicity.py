"""Toxicity of whole texts behind a noisy channel: obfuscated words are decoded before they are scored.

A character trigram model is counted over all documents. Where a text shows letters written as digits or signs,
letters set apart, or letters repeated, that stretch becomes a lattice (what each sign may stand for, or that it stands
for nothing; that a separator stands for nothing or for the end of a word) and Viterbi finds the likeliest spelling under
the channel and the character model, however long the stretch is. The restored text is scored by the words, and beginnings
of words, that labelled documents show to be toxic, also where such a word stands in several pieces; a logistic curve
through their weights gives a score from 0 to 1.

Nulls, empties: null or empty text has no evidence and gets the score of such; without labels of both kinds the score
is the share of toxic labels, or 0; a doc_id labelled twice counts by its largest label; repeated texts teach once;
extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches
from .langid import _chars, fold


@dataclass(frozen=True)
class ToxicityParams:
    #: Bound on the labelled documents that are learned from; beyond it a share is taken by a hash of doc_id.
    max_train_docs: int = 20_000
    #: A feature is learned if at least so many of the learned documents have it, so the lexicon is bounded by them.
    min_docs: int = 3
    #: Least log-likelihood-ratio statistic of a feature.
    min_evidence: float = 10.0
    prefixes: tuple[int, ...] = (5, 6, 7, 8)
    threshold: float = 0.7


#: What a sign may stand for.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e"}
#: Costs (nats) of the channel's ways to write a letter.
SIGN_COST, DROP_COST, REPEAT_COST, KEEP_REPEAT_COST, DROP_SIGN_COST = 1.0, 0.2, 0.3, 1.5, 3.0
_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_INDEX = {c: i + 1 for i, c in enumerate(_LETTERS)}
N_CHARS = len(_LETTERS) + 1
_TO_INDEX = np.zeros(256, np.int64)
for _c, _i in _INDEX.items():
    _TO_INDEX[ord(_c)] = _i
_WORD = re.compile(r"[^\W\d_]+")
#: Stretches worth decoding: single letters set apart by anything, letters and signs mixed, a letter twice in a row.
_SUSPECT = re.compile(
    r"(?<![^\W_])[a-zß-ÿ0-9@$!|+€](?:(?:[^\w@$!|+€]|_)+[a-zß-ÿ0-9@$!|+€]){2,}(?![^\W_])"
    r"|(?<![^\W_])(?=[0-9@$!|+€]*[a-zß-ÿ])(?=[a-zß-ÿ]*[0-9@$!|+€])[a-zß-ÿ0-9@$!|+€]+(?![^\W_])"
    r"|\b[^\W\d_]*([^\W\d_])\1[^\W\d_]*"
)


class CharModel:
    """Trigram log-probabilities over letters and a boundary."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(N_CHARS, N_CHARS, N_CHARS).astype(np.float64)
        two, one = c.sum(2, keepdims=True), c.sum((0, 1))
        back = (c.sum(0) + 0.5 * (one + 1) / (one.sum() + N_CHARS)) / (c.sum((0, 2))[:, None] + 0.5)
        self.logp = np.log((c + 2 * back[None]) / (two + 2)).astype(np.float32)
        self.cache: dict[str, str] = {}

    def decode(self, text: str) -> str:
        """The likeliest spelling of an obfuscated stretch of lower-case text; spaces where words end in it."""
        if len(text) > 60:
            return self._viterbi(text)
        if text not in self.cache:
            if len(self.cache) > 50_000:
                self.cache.clear()
            self.cache[text] = self._viterbi(text)
        return self.cache[text]

    def _viterbi(self, text: str) -> str:
        logp = self.logp
        #: by the last two letters: score, and the letters so far as a chain from the last one
        states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        last = ""
        for c in text:
            new: dict[tuple[int, int], tuple[float, tuple]] = {}

            def put(state, score, out, new=new):
                if state not in new or score > new[state][0]:
                    new[state] = (score, out)

            letters = [(c, 0.0)] if c in _INDEX else [(x, SIGN_COST) for x in SIGNS.get(c, "")]
            for (a, b), (score, out) in states.items():
                if not letters:  # a separator stands for nothing or ends a word
                    put((a, b), score - DROP_COST, out)
                    if b:
                        put((0, 0), score + float(logp[a, b, 0]), (" ", out))
                    continue
                for x, cost in letters:
                    i = _INDEX[x]
                    again = c == last
                    put((b, i), score + float(logp[a, b, i]) - cost - (KEEP_REPEAT_COST if again else 0.0), (x, out))
                    if again and out and out[0] == x:
                        put((a, b), score - REPEAT_COST, out)
                if cost and not c.isdigit():  # a sign for nothing
                    put((a, b), score - DROP_SIGN_COST, out)
            states, last = new, c
        chain = max(((score + (float(logp[a, b, 0]) if b else 0.0), out) for (a, b), (score, out) in states.items()), key=lambda x: x[0])[1]
        letters = []
        while chain:
            letters.append(chain[0])
            chain = chain[1]
        return "".join(reversed(letters)).strip()


def char_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over the letters of all whole texts; at most N_CHARS ** 3 numbers reach the driver."""
    import pyarrow as pa

    small_batches(docs.sparkSession)

    def count(batches):
        total = np.zeros(N_CHARS**3, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if not text:
                    continue
                c = _chars(text)
                x = np.concatenate([[0, 0], np.where(c < 256, _TO_INDEX[np.minimum(c, 255)], 0), [0]])
                # between words one boundary stands for both places before a letter
                code = (x[:-2] * N_CHARS + x[1:-1]) * N_CHARS + x[2:]
                fix = (x[1:-1] == 0) & (x[:-2] != 0)
                code[fix] = x[2:][fix]
                total += np.bincount(code, minlength=N_CHARS**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["code", "n"])

    out = np.zeros(N_CHARS**3, np.int64)
    for r in docs.select("text").mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        out[r.code] = r.n
    return out


def restore(text: str, model: CharModel) -> str:
    """Lower-case text with its obfuscated stretches decoded."""

    def spelt(m):
        found = model.decode(m[0])
        return m[0] if found == m[0] else f"{m[0]} {found}"

    return _SUSPECT.sub(spelt, text.lower())


def features(word: str, p: ToxicityParams) -> list[str]:
    return [word, *("^" + word[:n] for n in p.prefixes if len(word) > n)]


class Scorer:
    """Weights of features and the curve from evidence to score."""

    def __init__(self, weights: dict[str, float], p: ToxicityParams):
        self.weights, self.p = weights, p
        self.begin = {(k[1:] if k[0] == "^" else k)[: min(p.prefixes)] for k in weights}
        #: Proper beginnings of the lexicon's words, which may be pieces of them.
        self.pieces = {k[:n] for k in weights if k[0] != "^" for n in range(1, len(k))}
        self.curve = np.zeros(4)

    def evidence(self, restored: str) -> list[float]:
        """Numbers that the curve takes: sum of word weights, the same by length, words; empty texts too."""
        tokens = _WORD.findall(restored)
        words = set(tokens)
        words.update(self.joined(tokens))
        n = min(self.p.prefixes)
        total = 0.0
        for w in sorted(w for w in words if w[:n] in self.begin):
            total += max((self.weights.get(f, 0.0) for f in features(w, self.p)), default=0.0)
        size = math.log(2 + len(words))
        return [1.0, total, total / size, size]

    def joined(self, tokens: list[str]) -> list[str]:
        """Words of the lexicon that stand in pieces, one after another."""
        out = []
        for i, word in enumerate(tokens):
            if word in self.pieces:
                for k in range(i + 1, len(tokens)):
                    word += tokens[k]
                    if word in self.weights:
                        out.append(word)
                    if word not in self.pieces:
                        break
        return out

    def score(self, restored: str) -> float:
        z = float(np.dot(self.evidence(restored), self.curve))
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def _training_rows(docs: DataFrame, labels: DataFrame, train: Column, p: ToxicityParams) -> DataFrame:
    marked = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(train)
    n = marked.count()
    if n > p.max_train_docs:
        marked = marked.filter(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) < int(0.95 * p.max_train_docs / n * (1 << 30)))
    rows = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")  # at most about max_train_docs ids
    return rows.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, train: Column, model: CharModel, params: ToxicityParams | None = None) -> Scorer:
    """Learns from the labelled rows that `train` (over doc_id) admits."""
    import pyarrow as pa

    p = params or ToxicityParams()
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    rows = materialize(_training_rows(docs, labels, train, p), "toxic_training")

    def count(batches):
        n: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                seen = set()
                for w in set(_WORD.findall(restore(text or "", sent.value))):
                    seen.update(features(w, p))
                n[min(1, max(0, toxic))].update(seen)
        for toxic, counter in n.items():
            items = list(counter.items())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in items], pa.string()), pa.array([toxic] * len(items), pa.int32()), pa.array([v for _, v in items], pa.int64())], names=["f", "toxic", "n"])

    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        scorer = Scorer({}, p)
        share = min(1 - 1e-6, max(1e-6, bad / max(1, bad + good)))
        scorer.curve = np.array([math.log(share / (1 - share)), 0.0, 0.0, 0.0])
        return scorer
    by = rows.mapInArrow(count, "f string, toxic int, n long").groupBy("f").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"))
    expected = (F.col("a") + F.col("b")) * (bad / (bad + good))
    evidence = 2 * (F.col("a") * F.log(F.col("a") / expected) + F.when(F.col("b") > 0, F.col("b") * F.log(F.col("b") / ((F.col("a") + F.col("b")) * (good / (bad + good))))).otherwise(0.0))
    weight = F.log(((F.col("a") + 0.1) / (bad + 0.2)) / ((F.col("b") + 0.1) / (good + 0.2)))
    strong = by.filter((F.col("a") >= p.min_docs) & (F.col("a") > expected)).select("f", evidence.alias("g"), weight.alias("w")).filter((F.col("g") >= p.min_evidence) & (F.col("w") > 2))
    scorer = Scorer({r.f: r.w for r in strong.collect()}, p)
    weigh = spark.sparkContext.broadcast(scorer)

    def evidence_of(batches):
        for batch in batches:
            found = np.array([weigh.value.evidence(restore(t or "", sent.value)) for t in batch.column("text").to_pylist()]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([*(pa.array(found[:, i]) for i in range(4)), batch.column("toxic")], names=["e0", "e1", "e2", "e3", "toxic"])

    got = np.array(sorted(tuple(r) for r in rows.mapInArrow(evidence_of, "e0 double, e1 double, e2 double, e3 double, toxic int").collect()))  # at most about max_train_docs rows of five numbers
    x, y = got[:, :4], np.clip(got[:, 4], 0, 1)
    beta = np.zeros(4)
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(4), x.T @ (y - q) - 1e-3 * beta)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    scorer.curve = beta
    return scorer


def score(docs: DataFrame, model: CharModel, scorer: Scorer, with_text: bool = False) -> DataFrame:
    """doc_id, score (and the restored text) of every row."""
    import pyarrow as pa
    from pyspark.sql.types import DoubleType, StringType

    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast((model, scorer))
    schema = docs.select("doc_id").schema.add("score", DoubleType())
    if with_text:
        schema = schema.add("restored", StringType())

    def run(batches):
        chars, own = sent.value
        for batch in batches:
            texts = [restore(t or "", chars) for t in batch.column("text").to_pylist()]
            arrays = [batch.column("doc_id"), pa.array([own.score(t) for t in texts], pa.float64())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string())] if with_text else arrays, names=[f.name for f in schema.fields])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, params: ToxicityParams | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out documents are not used."""
    p = params or ToxicityParams()
    model = CharModel(char_counts(docs))
    scorer = fit(docs, labels, fold(3) != 1, model, p)
    out = score(docs, model, scorer)
    return out.select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= p.threshold).cast("int").alias("predicted"))
