"""Best-fit packing by length-histogram planning.

Documents are tokenised where they lie and only (length, checksum) leaves the tokeniser. The histogram of piece
lengths (at most `capacity` rows, whatever the input) is packed best-fit decreasing over counts on the driver; pieces
then take the planned slots by their rank within their length, which is a prefix sum over hash sub-buckets and a
row_number inside each, so that one hot length is never one task.

Nulls, empties: null text is an empty text, whose only id is the separator; repeated rows are packed as often as they
occur; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small_batches


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@dataclass(frozen=True)
class PackingParams:
    capacity: int = 2048
    separator_id: int = 0
    #: A file of the `tokenizers` library that all executors can read; its pre-tokenizer is byte-level with the usual pattern.
    tokenizer_path: str | None = None
    #: Pieces that one sub-bucket of a length holds, about.
    bucket_rows: int = 1_000
    #: Words whose ids a worker remembers, about; beyond that it forgets those that were not met for half as many new ones.
    cache_words: int = 400_000


#: ASCII characters that are no letters, digits or blanks; the pattern has more to say about apostrophes.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class ByteChars(dict):
    """The byte-level pre-tokenizer's characters for a character's bytes."""

    #: A byte that is no visible latin-1 character is shown by the next character from 256 on.
    SHOWN = {b: 256 + n for n, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}

    def __missing__(self, char: str) -> str:
        self[char] = char.encode().decode("latin-1").translate(self.SHOWN)  # as many as there are letters
        return self[char]


class WordCache:
    """Ids (little-endian uint32) of words; a word stands after a blank, unless it begins with the line feed before it.

    Letters after a blank are one unit of the pre-tokenizer's pattern, so the tokenizer's model gets them at once.
    """

    def __init__(self, tok, limit: int):
        self.encode = lambda s: array("I", tok.encode(s, add_special_tokens=False).ids).tobytes()
        self.model, self.chars, self.limit = tok.model, ByteChars(), limit
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}  # what `now` was when it held half the limit
        self.marks = {c * n: self.encode(c * n) for c in _MARKS for n in range(1, 5)}
        self.line = self.encode("\n")

    def ids(self, words: list[str]) -> bytes:
        """The ids of words that follow each other."""
        if len(self.now) >= self.limit // 2:
            self.old, self.now = self.now, {}
        out = list(map(self.now.get, words))
        for k in [k for k, x in enumerate(out) if x is None]:
            out[k] = self.word(words[k])
        return b"".join(out)

    def letters(self, blank: str, word: str) -> bytes:
        shown = blank + (word if word.isascii() else "".join([self.chars[c] for c in word]))
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def word(self, word: str) -> bytes:
        ids = self.now.get(word)
        if ids is not None:
            return ids
        ids = self.old.get(word)
        if ids is None:
            if word.isalpha():
                ids = self.letters("Ġ", word)
            elif (mark := self.marks.get(word[len(core := word.rstrip(_MARKS)) :])) and core.lstrip("\n").isalpha():  # letters and the marks after them are units of their own
                return self.word(core) + mark
            elif word[0] != "\n":
                ids = self.encode(" " + word)
            else:
                ids = self.line + (self.letters("", word[1:]) if word[1:].isalpha() else self.encode(word[1:]))
        if len(word) <= 40:
            self.now[word] = ids
        return ids


#: Characters that might be white space to the byte-level pattern, other than blank and line feed.
_EXOTIC = re.compile(r"[^ -~\n¡-ᙿ]")


class Tokens:
    """Ids of the tokenizer file, word by word from a cache where blanks and line feeds surely part tokens."""

    def __init__(self, path: str, cache_words: int):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        self.encode = lambda s: tok.encode(s, add_special_tokens=False).ids
        self.words = WordCache(tok, cache_words)

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian uint32."""
        if not text:
            return b""
        if text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n " in text or " \n" in text or "\n\n" in text or _EXOTIC.search(text):
            return array("I", self.encode(text)).tobytes()
        # now each blank begins a token, and each line feed is one
        return self.words.ids(("\n" + text.replace("\n", " \n")).split(" "))[4:]


_TOKENS: dict[tuple, Tokens] = {}


def tokens(path: str, cache_words: int) -> Tokens:
    if (path, cache_words) not in _TOKENS:
        _TOKENS[path, cache_words] = Tokens(path, cache_words)
    return _TOKENS[path, cache_words]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: whole sequences, but for a first piece that may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, p: PackingParams) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    import pyarrow as pa

    small_batches(docs.sparkSession)
    path = p.tokenizer_path or default_tokenizer()
    schema = docs.select("doc_id").schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    end = array("I", [p.separator_id]).tobytes()

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tok = tokens(path, p.cache_words)
        for batch in batches:
            row, out = [], ([], [], [], [])
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = tok.ids(text or "") + end
                for n, (start, length) in enumerate(cut(len(ids) // 4, p.capacity)):
                    row.append(i)
                    for column, value in zip(out, (n, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])), strict=True):
                        column.append(value)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names=[f.name for f in schema.fields])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, first sequence, items in each sequence, offset of the first).

    Bins that look alike are one group (first sequence, how many, room left), so work follows the number of lengths,
    not of pieces. A run's ranks end where the next run of its length begins.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> groups (first sequence, how many)
    runs, opened = [], 0
    open_room: list[int] = []  # sorted keys of room
    from bisect import bisect_left, insort

    def put(left: int, first: int, many: int) -> None:
        if many and left:
            if left not in room:
                room[left] = []
                insort(open_room, left)
            room[left].append((first, many))

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        while todo:
            at = bisect_left(open_room, length)
            if at < len(open_room):
                left = open_room[at]
                first, many = room[left].pop()
                if not room[left]:
                    del room[left], open_room[at]
            else:
                left, first = capacity, opened
                many = -(-todo // (capacity // length))
                opened += many
            each = left // length
            full = min(many, todo // each)
            if full:
                runs.append((length, rank, first, each, capacity - left))
                rank, todo = rank + full * each, todo - full * each
                put(left - each * length, first, full)
            if full < many and todo and todo < each:
                runs.append((length, rank, first + full, each, capacity - left))
                put(left - todo * length, first + full, 1)
                rank, todo, full = rank + todo, 0, full + 1
            put(left, first + full, many - full)
    return runs


def place(found: DataFrame, runs: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """sequence_id and offset of pieces that know their rank within their length."""
    import pyarrow as pa

    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    sent = found.sparkSession.sparkContext.broadcast(table)  # a few rows for each length
    schema = found.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    def run(batches):
        t = sent.value
        keys = (t[:, 0] << 44) | t[:, 1]
        for batch in batches:
            length, rank = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False), np.int64) for c in ("length", "rank"))
            own = t[np.searchsorted(keys, (length << 44) | rank, "right") - 1]
            nth = rank - own[:, 1]
            seq, off = own[:, 2] + nth // own[:, 3], own[:, 4] + nth % own[:, 3] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in schema.fields[:-2]), pa.array(seq), pa.array(off)], names=[f.name for f in schema.fields])

    return found.mapInArrow(run, schema)


def pack(docs: DataFrame, params: PackingParams | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    p = params or PackingParams()
    got = materialize(pieces(docs, p), "pieces")
    spark = docs.sparkSession
    histogram = {r.length: r.n for r in got.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    parts = F.broadcast(spark.createDataFrame([(k, n // p.bucket_rows + 1) for k, n in histogram.items()], "length long, parts long"))
    got = got.join(parts, "length").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), "parts")).drop("parts")
    counts = got.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    # prefix sums in two steps, so that no task has all buckets of a hot length
    counts = counts.withColumn("upper", F.expr("bucket div 1000"))
    earlier = lambda by, c: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(c).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tops = counts.groupBy("length", "upper").agg(F.sum("n").alias("n")).select("length", "upper", earlier(["length"], "upper").alias("base"))
    starts = counts.select("length", "bucket", "upper", earlier(["length", "upper"], "bucket").alias("inner")).join(tops, ["length", "upper"])
    starts = starts.select("length", "bucket", (F.col("base") + F.col("inner")).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = got.withColumn("nth", F.row_number().over(inside)).join(starts, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth") - 1).alias("rank"))
    return place(ranked, plan(histogram, p.capacity))
