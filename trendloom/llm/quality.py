"""Quality rules by distribution divergence: JVM expressions only, no Python on the executors.

A document's histogram over character classes and its histogram over a language's common words are compared with the
language's references by Jensen-Shannon distance (square root, base 2, 0 to 1). References are sums over all documents
of that language in the table itself that pass the base rules and the length guards.

Nulls, empties: null text has no words and fails the base rules; a null or unlisted lang is compared as `und`, over
character classes only; short documents (below the guards) are judged by the base rules alone; a language without a
reference (empty table) rejects nothing; repeated rows are judged one by one; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NON_WS_CLASS, WS_CLASS, let, materialize

#: Frequent function words by language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "as", "with", "be", "by"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no"],
}
CLASSES = ["upper", "lower", "digit", "punct", "symbol", "white", "other"]
SHINGLE = 8


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 20
    max_repeat_percent: int = 30
    #: Length guards of the two histograms.
    min_class_chars: int = 150
    min_common_words: int = 50
    max_class_distance: float = 0.26
    max_word_distance: float = 0.33
    common_words: dict[str, list[str]] = field(default_factory=lambda: COMMON_WORDS)

    @property
    def n_common(self) -> int:
        return max(map(len, self.common_words.values()), default=0)

    def vocabularies(self) -> dict[str, list[str]]:
        """The lists, filled up to one length with what is no word."""
        return {k: v + [""] * (self.n_common - len(v)) for k, v in self.common_words.items()}


def _count(text: Column, keep: str) -> Column:
    """Characters of text in the class `keep` (a regular expression's bracket content)."""
    return F.length(F.regexp_replace(text, f"[^{keep}]+", "")).cast("long")


def repeated_words(words: Column) -> Column:
    """Words covered by 8-word windows that occur twice or more in the array, the first occurrence included."""

    def covered(hashes: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            twin = lambda x, k: (F.get(s, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, k + 1)["h"].eqNullSafe(x["h"]))
            places = F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))
            gaps = lambda p: F.transform(p, lambda v, k: F.coalesce(F.least(F.lit(SHINGLE), F.get(p, k + 1) - v), F.lit(SHINGLE)).cast("long"))
            return let(places, lambda p: F.aggregate(gaps(p), F.lit(0).cast("long"), lambda a, b: a + b))

        order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(order, of_sorted))

    windows = let(
        F.transform(words, lambda x: F.xxhash64(x)),
        lambda wh: let(F.transform(F.sequence(F.lit(1), F.size(wh) - (SHINGLE - 1)), lambda i: F.xxhash64(F.slice(wh, i, SHINGLE))), covered),
    )
    return F.when(F.size(words) > SHINGLE, windows).otherwise(F.lit(0).cast("long"))


def features(docs: DataFrame, p: QualityParams) -> DataFrame:
    """Base counts and both histograms of every whole text, a few dozen bytes a document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    ref = F.when(F.col("lang").isin(*p.common_words), F.col("lang")).otherwise("und")
    vocab = F.lit(None).cast("array<string>")
    for lang, words in p.vocabularies().items():
        vocab = F.when(F.col("lang") == lang, F.array(*map(F.lit, words))).otherwise(vocab)
    d = docs.select("doc_id", ref.alias("ref_lang"), vocab.alias("vocab"), text.alias("t"), F.array_remove(F.split(text, WS_CLASS), "").alias("w"))
    common = let(F.filter(F.transform("w", lambda x: F.lower(x)), lambda x: F.array_contains(F.col("vocab"), x)), lambda f: F.transform(F.col("vocab"), lambda v: F.size(f) - F.size(F.array_remove(f, v))))
    d = d.select(
        "doc_id",
        "ref_lang",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length("t").cast("long").alias("n_chars"),
        _count(F.col("t"), "#*$%&|<>").alias("n_symbols"),
        let(F.filter(F.split("t", "\n"), lambda x: x.rlike(NON_WS_CLASS)), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
        _count(F.col("t"), r"\p{Lu}").alias("c_upper"),
        _count(F.col("t"), r"\p{Ll}").alias("c_lower"),
        _count(F.col("t"), "0-9").alias("c_digit"),
        _count(F.col("t"), r".,;:!?'\"()\-").alias("c_punct"),
        common.alias("common"),
    )
    rest = F.col("n_chars") - F.col("c_upper") - F.col("c_lower") - F.col("c_digit") - F.col("c_punct") - F.col("n_symbols")
    base_failed = (F.col("n_words") < p.min_words) | (100 * F.col("n_repeat_words") > p.max_repeat_percent * F.col("n_words"))
    return (
        d.withColumn("c_symbol", F.col("n_symbols"))
        .withColumn("c_white", F.col("n_chars") - F.col("word_chars"))
        .withColumn("c_other", rest - (F.col("n_chars") - F.col("word_chars")))
        .withColumn("base_failed", base_failed)
    )


def references(feats: DataFrame, p: QualityParams) -> DataFrame:
    """One row per reference language: at most len(common_words) + 1 rows, whatever the input."""
    good = feats.filter(~F.col("base_failed") & (F.col("n_chars") >= p.min_class_chars))
    counts = [F.sum(F.element_at("common", i + 1)).alias(f"w{i}") for i in range(p.n_common)]
    agg = good.groupBy("ref_lang").agg(*[F.sum(f"c_{c}").alias(f"r_{c}") for c in CLASSES], F.sum("n_words").alias("r_words"), *counts)
    return agg.select("ref_lang", F.array(*[F.col(f"r_{c}") for c in CLASSES]).alias("ref_classes"), F.array(*[F.coalesce(F.col(f"w{i}"), F.lit(0)) for i in range(p.n_common)]).alias("ref_common"), "r_words")


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts of one length; null where either sums to 0."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def of(a: Column, b: Column) -> Column:
        pairs = F.zip_with(a, b, lambda x, y: F.struct(F.try_divide(x, total(a)).alias("x"), F.try_divide(y, total(b)).alias("y")))
        cells = F.transform(pairs, lambda c: 0.5 * part(c["x"], (c["x"] + c["y"]) / 2) + 0.5 * part(c["y"], (c["x"] + c["y"]) / 2))
        return F.when((total(a) > 0) & (total(b) > 0), F.sqrt(F.greatest(F.lit(0.0), total(cells))))

    as_double = lambda a: F.transform(a, lambda x: x.cast("double"))
    return let(as_double(p), lambda a: let(as_double(q), lambda b: of(a, b)))


def quality(docs: DataFrame, params: QualityParams | None = None) -> DataFrame:
    """doc_id, base counts, base_failed, both distances and the verdict, one row for each row of docs (doc_id, text, lang)."""
    p = params or QualityParams()
    feats = materialize(features(docs, p), "quality_features")
    refs = F.broadcast(references(feats, p))  # at most one row for each listed language and one more
    j = feats.join(refs, "ref_lang", "left")
    own_classes = F.array(*[F.col(f"c_{c}") for c in CLASSES])
    with_rest = lambda a, n: F.concat(F.transform(a, lambda x: x.cast("double")), F.array((n - F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)).cast("double")))
    class_distance = F.when(F.col("n_chars") >= p.min_class_chars, js_distance(own_classes, F.col("ref_classes")))
    word_distance = F.when(
        (F.col("n_words") >= p.min_common_words) & (F.col("ref_lang") != "und"),
        js_distance(with_rest(F.col("common"), F.col("n_words")), with_rest(F.col("ref_common"), F.col("r_words"))),
    )
    j = j.withColumn("class_distance", class_distance).withColumn("word_distance", word_distance)
    far = (F.coalesce("class_distance", F.lit(0.0)) > p.max_class_distance) | (F.coalesce("word_distance", F.lit(0.0)) > p.max_word_distance)
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "word_distance", "ref_lang")


def oracle(p: QualityParams | None = None) -> str:
    """The contract's columns in DuckDB SQL."""
    p = p or QualityParams()
    vocab = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in p.vocabularies().items()) + " END"
    ws = "[^\\x20\\x09-\\x0D]+"
    count = lambda keep: f"length(regexp_replace(t, '[^{keep}]+', '', 'g'))"

    def distance(a: str, b: str) -> str:
        x, y = f"({a}[i] / list_sum({a}))", f"({b}[i] / list_sum({b}))"
        part = lambda u: f"CASE WHEN {u} > 0 THEN 0.5 * {u} * log2({u} / (({x} + {y}) / 2)) ELSE 0 END"
        return f"CASE WHEN list_sum({a}) > 0 AND list_sum({b}) > 0 THEN sqrt(greatest(0, list_sum(list_transform(range(1, len({a}) + 1), lambda i: {part(x)} + {part(y)})))) END"

    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, CASE WHEN lang IN {tuple(p.common_words)} THEN lang ELSE 'und' END AS ref_lang,
         {vocab} AS vocab, regexp_extract_all(coalesce(text, ''), '{ws}') AS w FROM documents),
g AS (SELECT rid, unnest(range(1, len(w) - {SHINGLE - 2})) AS i FROM d WHERE len(w) > {SHINGLE}),
r AS (SELECT rid, i FROM (SELECT g.rid, g.i, count(*) OVER (PARTITION BY g.rid, w[g.i : g.i + {SHINGLE - 1}]) AS c FROM g JOIN d USING (rid)) WHERE c > 1),
cov AS (SELECT rid, sum(k) AS n FROM (SELECT rid, least({SHINGLE}, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, {SHINGLE})) AS k FROM r) GROUP BY rid),
f AS (
  SELECT d.rid, doc_id, ref_lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) AS n_chars, {count("#*$%&|<>")} AS n_symbols,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{ws}'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{ws}')))) AS n_dup_lines,
         coalesce(cov.n, 0) AS n_repeat_words, {count("\\p{Lu}")} AS up, {count("\\p{Ll}")} AS lo, {count("0-9")} AS di, {count(".,;:!?''\"()\\-")} AS pu,
         list_transform(vocab, lambda v: len(list_filter(w, lambda x: lower(x) = v))) AS common
  FROM d LEFT JOIN cov USING (rid)),
q AS (
  SELECT *, [up, lo, di, pu, n_symbols, n_chars - word_chars, word_chars - up - lo - di - pu - n_symbols]::DOUBLE[] AS c, list_append(common, n_words - list_sum(common))::DOUBLE[] AS m,
         n_words < {p.min_words} OR 100 * n_repeat_words > {p.max_repeat_percent} * n_words AS base_failed FROM f),
ref AS (
  SELECT ref_lang, [{", ".join(f"sum(c[{i + 1}])" for i in range(len(CLASSES)))}] AS rc, [{", ".join(f"sum(m[{i + 1}])" for i in range(p.n_common + 1))}] AS rm
  FROM q WHERE NOT base_failed AND n_chars >= {p.min_class_chars} GROUP BY ref_lang),
j AS (
  SELECT q.*, CASE WHEN n_chars >= {p.min_class_chars} THEN {distance("c", "rc")} END AS cd, CASE WHEN n_words >= {p.min_common_words} AND ref_lang <> 'und' THEN {distance("m", "rm")} END AS wd
  FROM q LEFT JOIN ref USING (ref_lang))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND coalesce(cd, 0) <= {p.max_class_distance} AND coalesce(wd, 0) <= {p.max_word_distance} AS kept FROM j
"""
