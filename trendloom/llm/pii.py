"""Personal data by pattern, and terms that reveal it by corpus co-occurrence (information-theoretic sanitisation).

Base spans are e-mail addresses, IPv4 addresses, payment cards and phone numbers. Their values are the protected
entities. A term's disclosure of an entity is its pointwise mutual information with it over the entity's own
information content, log(n_te * N / ((n_t + 1/2) * n_e)) / log(N / n_e), from counts over all documents: n_te documents
have the term near the entity, n_t the term, n_e the entity. It nears 1 where the term only occurs with the entity. Terms
at or above `remove_at` are removed wherever they stand, terms at or above `generalise_at` become their word class. Every
pair counts, also one of a single document. The half (Krichevsky and Trofimov's prior) smooths by the term's document
frequency: a word of one document beside an entity of one document is evidence from 159 documents up, a word of two beside
an entity of one from 94,000 up. Copies of a document raise n_te, n_t and n_e alike.

Nulls, empties: null text is empty; repeated rows are treated alike, one by one; rows with one doc_id and one text are
one document in the counts; a null doc_id is an ordinary value; extra columns are kept by sanitise and ignored elsewhere.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, rows_at_most, small_batches

KINDS = ("email", "ip", "card", "phone")
TERM = "term"


@dataclass(frozen=True)
class PiiParams:
    #: Words on either side of an entity that count as near.
    near: int = 6
    remove_at: float = 0.97
    generalise_at: float = 0.92
    filter_bits: int = 1 << 23
    #: One in so many documents is counted first, some thousand of them in a task; the result does not depend on either.
    first_part: int = 16
    first_rows: int = 10_000
    #: Revealing terms that are sent to the workers as they are; more of them are found by joins.
    send_terms: int = 200_000


_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W\d_]{3,}")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def emails(text: str) -> list[tuple[int, int]]:
    """As the pattern's leftmost matches: the run of local characters before each @, and the longest domain after it."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at)
        at = text.find("@", max(at + 1, done))
    return out


def _luhn(digits: str) -> bool:
    d = [ord(c) - 48 for c in reversed(digits)]
    return (sum(d[::2]) + sum(_DOUBLED[x] for x in d[1::2])) % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping spans by kind, in code points."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = emails(text)
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _NON_DIGIT.sub("", m[0])) <= 19 and _luhn(d):
            out["card"].append(m.span())
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(x := part.lstrip("0")) <= 3 and int(x or 0) <= 255 for part in m[0].split(".")):
                out["ip"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NON_DIGIT.sub("", m[0])) <= 15:
                out["phone"].append(m.span())
    return out


def joined(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in sorted(spans.get(k, [])))


def words_of(text: str) -> tuple[list[int], list[int]]:
    """Starts and ends of a text's words."""
    found = [m.span() for m in _WORD.finditer(text)]
    return [a for a, _ in found], [b for _, b in found]


def surroundings(text: str, words: tuple[list[int], list[int]], start: int, end: int, near: int) -> list[str]:
    """The lower-case words next to a span, `near` on either side or all there are; words that overlap it are none."""
    starts, ends = words
    before, after = bisect_right(ends, start), bisect_left(starts, end)
    return [text[starts[i] : ends[i]].lower() for i in (*range(max(0, before - near), before), *range(after, min(len(starts), after + near)))]


def _mentions(docs: DataFrame, p: PiiParams) -> DataFrame:
    """term, entity, doc of each word near each entity; a row without a term for each entity."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            out: tuple[list, ...] = ([], [], [])
            for doc, text in zip(batch.column("version").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = base_spans(text)
                words = words_of(text) if any(found.values()) else None
                for kind, spans in found.items():
                    for a, b in spans:
                        entity = f"{kind}:{text[a:b].lower() if kind == 'email' else _NON_DIGIT.sub('.' if kind == 'ip' else '', text[a:b])}"
                        for term in [None, *set(surroundings(text, words, a, b, p.near))]:
                            for column, value in zip(out, (term, entity, doc), strict=True):
                                column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.string(), pa.string(), pa.int64()), strict=True)], names=["term", "entity", "doc"])

    return docs.select("version", "text").mapInArrow(run, "term string, entity string, doc long")


def _bits(terms: DataFrame, n: int) -> np.ndarray:
    """A bitmap of fixed size over the terms' crc32, combined by words of 64 bits: n / 64 rows at most."""
    bit = F.crc32(F.col("term").cast("binary")) % n
    one = F.expr("shiftleft(1L, cast(b % 64 as int))")
    words = np.zeros(n // 64, np.int64)
    for r in terms.select(bit.alias("b")).groupBy(F.expr("b div 64").alias("at")).agg(F.bit_or(one).alias("bits")).collect():
        words[r["at"]] = r["bits"]
    return np.packbits(np.unpackbits(words.view(np.uint8), bitorder="little"))


def _has(bits: np.ndarray, word: str) -> bool:
    b = zlib.crc32(word.encode("utf-8", "surrogatepass")) % (len(bits) * 8)
    return bool(bits[b >> 3] >> (7 - (b & 7)) & 1)


def _document_counts(docs: DataFrame, terms: DataFrame, p: PiiParams) -> DataFrame:
    """term, n: in how many documents each of the terms stands; a few other terms too, as the bitmap lets them through."""
    import pyarrow as pa

    sent = docs.sparkSession.sparkContext.broadcast(_bits(terms, p.filter_bits))

    def run(batches):
        n: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                n.update(w for w in {w.lower() for w in set(_WORD.findall(text))} if _has(sent.value, w))
            if len(n) > 200_000:
                yield emit(n)
                n = Counter()
        yield emit(n)

    def emit(n):
        return pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["term", "n"])

    return docs.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _disclosure(n_te: Column, n_t: Column, n_e: Column, n: int) -> Column:
    return F.try_divide(F.log(n_te * F.lit(float(n)) / ((n_t + F.lit(0.5)) * n_e)), F.log(F.lit(float(n)) / n_e))


def revealing_terms(docs: DataFrame, p: PiiParams) -> DataFrame:
    """term, action (`remove` or `generalise`), disclosure; docs as _prepared gives them."""
    near = materialize(_mentions(docs, p), "mentions")
    joint = near.filter(F.col("term").isNotNull()).groupBy("term", "entity").agg(F.countDistinct("doc").alias("n_te"))
    entities = near.groupBy("entity").agg(F.countDistinct("doc").alias("n_e"))
    # in how many documents a term is near any entity: at most n_t, so disclosure is at most what follows from it; words
    # that this leaves below the line need no count over all documents
    anywhere = near.filter(F.col("term").isNotNull()).groupBy("term").agg(F.countDistinct("doc").alias("n_any"))
    n = docs.count()
    # entities of equal counts say the same of a term: a common word has a few rows here, not one for each entity
    joint = materialize(joint.join(entities, "entity").select("term", "n_te", "n_e").distinct().join(anywhere, "term"), "joint")
    enough = _disclosure(F.col("n_te"), F.col("n_least"), F.col("n_e"), n) >= p.generalise_at
    possible = materialize(joint.withColumnRenamed("n_any", "n_least").filter(enough), "possible")
    # a part of the documents, read by few tasks, bounds n_t from below as well: it takes out common words, which every
    # task would count, and leaves the rare ones
    part = docs.filter(F.pmod(F.xxhash64("version"), F.lit(p.first_part)) == 0).coalesce(n // (p.first_part * p.first_rows) + 1)
    few = _document_counts(part, possible.select("term").distinct(), p).withColumnRenamed("n", "n_few")
    possible = possible.join(few, "term", "left").withColumn("n_least", F.greatest("n_least", F.coalesce("n_few", F.lit(0))))
    possible = materialize(possible.filter(enough).drop("n_few"), "possible")
    if possible.isEmpty():
        return possible.select("term", F.lit("").alias("action"), F.lit(0.0).alias("disclosure"))
    j = possible.join(_document_counts(docs, possible.select("term").distinct(), p), "term")
    found = j.groupBy("term").agg(F.max(_disclosure(F.col("n_te"), F.greatest("n", "n_te"), F.col("n_e"), n)).alias("disclosure")).filter(F.col("disclosure") >= p.generalise_at)
    return materialize(found.select("term", F.when(F.col("disclosure") >= p.remove_at, "remove").otherwise("generalise").alias("action"), "disclosure"), "revealing")


def _term_spans(docs: DataFrame, terms: DataFrame, p: PiiParams) -> DataFrame:
    """doc_id, version, terms: where revealing terms stand, for the documents that have any."""
    import pyarrow as pa
    from pyspark.sql.types import LongType, StringType

    sent = docs.sparkSession.sparkContext.broadcast(_bits(terms, p.filter_bits))
    schema = docs.select("doc_id", "version").schema.add("term", StringType()).add("start", LongType()).add("end", LongType())

    def run(batches):
        for batch in batches:
            row, out = [], ([], [], [])
            for i, text in enumerate(batch.column("text").to_pylist()):
                for m in _WORD.finditer(text):
                    if _has(sent.value, w := m[0].lower()):
                        row.append(i)
                        for column, value in zip(out, (w, m.start(), m.end()), strict=True):
                            column.append(value)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("version").take(at), *(pa.array(c, k) for c, k in zip(out, (pa.string(), pa.int64(), pa.int64()), strict=True))], names=[f.name for f in schema.fields])

    hits = docs.select("doc_id", "version", "text").mapInArrow(run, schema).join(terms.select("term", "action"), "term")
    return hits.groupBy("doc_id", "version").agg(F.array_distinct(F.collect_list(F.struct("start", "end", "action"))).alias("terms"))  # at most a text's words


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("version"))


def _standing(text: str, terms: dict[str, str]) -> list[dict]:
    """Where the given terms stand in a text."""
    if not any(w.lower() in terms for w in set(_WORD.findall(text))):
        return []
    return [{"start": m.start(), "end": m.end(), "action": terms[w]} for m in _WORD.finditer(text) if (w := m[0].lower()) in terms]


def _with_terms(docs: DataFrame, p: PiiParams):
    """row (docs' own columns, whatever their names), text and terms, and None; or with null terms, and a broadcast of all terms and actions."""
    small_batches(docs.sparkSession)
    own = _prepared(docs)
    terms = revealing_terms(own, p)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = docs.select(row.alias("row"), F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id"), F.xxhash64("doc_id", "text").alias("version"))
    if rows_at_most(terms, p.send_terms):
        every = {r.term: r.action for r in terms.select("term", "action").collect()}  # at most send_terms
        return named.select("row", "text", F.lit(None).cast("array<struct<start:bigint,end:bigint,action:string>>").alias("terms")), docs.sparkSession.sparkContext.broadcast(every)
    found = materialize(_term_spans(own, terms, p), "term_spans").select(F.col("doc_id").alias("d"), F.col("version").alias("v"), "terms")
    on = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v"))
    return named.join(found, on, "left").select("row", "text", "terms"), None


def _all_spans(text: str, terms: list[dict] | None) -> tuple[dict[str, list[tuple[int, int]]], dict[tuple[int, int], str]]:
    """Base spans with the terms that overlap none of them, and the terms' actions."""
    spans, action = base_spans(text), {}
    taken = sorted(s for v in spans.values() for s in v)
    for t in sorted(terms or [], key=lambda t: (t["start"], t["end"])):
        a, b = t["start"], t["end"]
        if not any(x < b and a < y for x, y in taken):
            spans.setdefault(TERM, []).append((a, b))
            action[a, b] = t["action"]
    return spans, action


def find(docs: DataFrame, params: PiiParams | None = None) -> DataFrame:
    """doc_id, counts, base_sha256, spans, n_terms of every row of docs(doc_id, text)."""
    import pyarrow as pa
    from pyspark.sql.types import LongType, StringType

    p = params or PiiParams()
    schema = docs.select("doc_id").schema
    for k in (*KINDS, TERM):
        schema = schema.add(f"n_{k}" if k != TERM else "n_terms", LongType())
    schema = schema.add("base_sha256", StringType()).add("spans", StringType())
    own, sent = _with_terms(docs.select("doc_id", "text"), p)

    def run(batches):
        for batch in batches:
            counts: list[list[int]] = [[] for _ in range(5)]
            base, every = [], []
            for text, terms in zip(batch.column("text").to_pylist(), batch.column("terms").to_pylist(), strict=True):
                spans, _ = _all_spans(text, _standing(text, sent.value) if sent else terms)
                for column, k in zip(counts, (*KINDS, TERM), strict=True):
                    column.append(len(spans.get(k, [])))
                base.append(hashlib.sha256(joined(spans, KINDS).encode()).hexdigest())
                every.append(joined(spans, (*KINDS, TERM)))
            yield pa.RecordBatch.from_arrays([batch.column("row").field("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(every, pa.string())], names=[f.name for f in schema.fields])

    return own.select(F.struct("row.doc_id").alias("row"), "text", "terms").mapInArrow(run, schema)


def clean(text: str, terms: list[dict] | None) -> str:
    """Text with each span replaced by its kind, terms removed or replaced by their word class."""
    spans, action = _all_spans(text, terms)
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, v in spans.items() for a, b in v):
        if a < at:  # kinds may overlap: what is left of the later one goes with the earlier
            at = max(at, b)
            continue
        word = text[a:b]
        what = {"remove": "", "generalise": "[Name]" if word[:1].isupper() else "[word]"}[action[a, b]] if kind == TERM else f"[{kind.upper()}]"
        out += [text[at:a], what]
        at = b
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, params: PiiParams | None = None) -> DataFrame:
    """docs with personal data and revealing terms taken out of text; null text stays null, n_chars follows the text."""
    import pyarrow as pa

    p = params or PiiParams()
    own, sent = _with_terms(docs, p)
    schema = docs.schema
    at = {c: i for i, c in enumerate(docs.columns)}

    def run(batches):
        for batch in batches:
            columns = batch.column("row").flatten()
            nulls = columns[at["text"]].is_null().to_pylist()
            texts = [None if null else clean(t, _standing(t, sent.value) if sent else x) for t, x, null in zip(batch.column("text").to_pylist(), batch.column("terms").to_pylist(), nulls, strict=True)]
            columns[at["text"]] = pa.array(texts, pa.string())
            if "n_chars" in at:
                old = columns[at["n_chars"]]
                columns[at["n_chars"]] = pa.array([n if t is None else len(t) for n, t in zip(old.to_pylist(), texts, strict=True)], old.type)
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    docs_columns = list(docs.columns)
    return own.mapInArrow(run, schema)
