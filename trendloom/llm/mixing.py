"""Mixing sources to target weights by hierarchical budgeting: DataFrame expressions only.

A token budget goes down the tree domain -> language -> source in proportion to weights. A node can take no more than
`max_epochs` times its documents' tokens, a subtree no more than its leaves together; what a node can't take goes to
its siblings in proportion to theirs, and reaches its parent's siblings only when all of them are full. (Each level is
one water-filling over capacities of whole subtrees, in integers.) A leaf then takes its documents in whole epochs and
the token-prefix of one more, in an order drawn anew by seed and epoch.

The prefix is found without sorting a leaf: documents fall into buckets of their order key, sums by bucket name the one
bucket that holds the cut, and only that is ordered. The rule by leaf is a few columns, so texts are never shuffled.

Nulls, empties: null text has 0 tokens; null lang or source is `und` or `unknown`, a leaf of its own; documents with
one doc_id share a place in the order and are taken together; a leaf of no tokens takes whole epochs of nothing and all
its documents at once; an empty table gives no rows; extra columns are kept by select_documents and ignored elsewhere,
also those named like columns used here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NON_WS_CLASS, checked_broadcast, materialize

LEAF = ["domain", "language", "src"]


@dataclass(frozen=True)
class MixParams:
    #: Share of the table's tokens that the mixture has.
    budget_percent: int = 80
    max_epochs: int = 3
    seed: int = 20240229
    #: A source's domain: its trailing number modulo this, `d0`, `d1`, ...; without a number `d_other`.
    n_domains: int = 4
    domain_weights: dict[str, int] = field(default_factory=lambda: {"d0": 4, "d1": 3, "d2": 2})
    language_weights: dict[str, int] = field(default_factory=lambda: {"en": 5, "de": 2, "fr": 2})
    source_weights: dict[str, int] = field(default_factory=lambda: {"src0": 2, "src5": 3})
    #: Of whatever is not listed.
    default_weight: int = 1
    #: Documents of one bucket of a leaf's order, about.
    bucket_rows: int = 2_000


def _leaf_columns(p: MixParams) -> list[Column]:
    number = F.regexp_extract(F.coalesce("source", F.lit("")), r"([0-9]{1,9})$", 1)
    domain = F.when(number == "", F.lit("d_other")).otherwise(F.concat(F.lit("d"), (F.expr("try_cast(regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) AS BIGINT)") % p.n_domains).cast("string")))
    return [domain.alias("domain"), F.coalesce("lang", F.lit("und")).alias("language"), F.coalesce("source", F.lit("unknown")).alias("src")]


def _weight(column: str, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default).cast("long")
    for name, w in weights.items():
        out = F.when(F.col(column) == name, F.lit(w).cast("long")).otherwise(out)
    return out


def _fill(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Adds `alloc` to nodes(parents, name, budget, w, cap): water-filling among the children of each parent."""
    siblings = Window.partitionBy(*(parents or [F.lit(0)]))
    order = siblings.orderBy(F.col("cap") / F.col("w"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    n = (
        nodes.withColumn("i", F.row_number().over(order))
        .withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("heavy", F.sum("w").over(siblings) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("open", F.when(F.col("cap") * F.col("heavy") > F.col("left") * F.col("w"), F.col("i")))
        .withColumn("first_open", F.min("open").over(siblings))
        .withColumn("share", F.max(F.when(F.col("i") == F.col("first_open"), F.struct("left", "heavy"))).over(siblings))
    )
    alloc = F.when(F.col("first_open").isNull() | (F.col("i") < F.col("first_open")), F.col("cap")).otherwise(F.expr("(share.left * w) div share.heavy"))
    return n.withColumn("alloc", alloc).select(*parents, name, "alloc")


def allocations(leaves: DataFrame, p: MixParams) -> DataFrame:
    """The leaves with `alloc`, the tokens that each gives to the mixture."""
    leaves = leaves.withColumn("cap", F.col("tokens") * p.max_epochs)
    domains = leaves.groupBy("domain").agg(F.sum("tokens").alias("tokens"), F.sum("cap").alias("cap"))
    domains = domains.withColumn("budget", F.expr(f"(sum(tokens) over (partition by 0) * {p.budget_percent}) div 100")).withColumn("w", _weight("domain", p.domain_weights, p.default_weight))
    upper = _fill(domains, [], "domain").withColumnRenamed("alloc", "budget")
    languages = leaves.groupBy("domain", "language").agg(F.sum("cap").alias("cap")).join(upper, "domain")
    languages = languages.withColumn("w", _weight("language", p.language_weights, p.default_weight))
    middle = _fill(languages, ["domain"], "language").withColumnRenamed("alloc", "budget")
    own = leaves.join(middle, ["domain", "language"]).withColumn("w", _weight("src", p.source_weights, p.default_weight))
    return leaves.join(_fill(own, ["domain", "language"], "src"), LEAF)


def _order_key(p: MixParams) -> Column:
    """Place of a document in the epoch `full` of its leaf."""
    return F.md5(F.concat_ws(":", F.lit(str(p.seed)), F.col("full").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def _bucket(key: Column) -> Column:
    return F.shiftrightunsigned(F.conv(F.substring(key, 1, 7), 16, 10).cast("long") * F.col("parts"), 28)


def tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NON_WS_CLASS)).cast("long")


def rules(docs: DataFrame, p: MixParams) -> DataFrame:
    """By leaf: whole epochs, and where the prefix of the next one ends (bucket, and order key inside it)."""
    meta = materialize(docs.select("doc_id", *_leaf_columns(p), tokens(F.col("text")).alias("n_tokens")), "tokens")
    leaves = materialize(meta.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")), "leaves")
    got = allocations(leaves, p)
    full = F.when(F.col("tokens") > 0, F.expr("alloc div tokens")).otherwise(F.lit(p.max_epochs).cast("long"))
    got = got.withColumn("full", full).withColumn("rest", F.when(F.col("tokens") > 0, F.col("alloc") - F.col("full") * F.col("tokens")).otherwise(F.lit(0)))
    got = got.withColumn("parts", F.least(F.expr(f"n div {p.bucket_rows}") + 1, F.lit(1 << 28)))
    got = materialize(got.select(*LEAF, "full", "rest", "parts", "alloc"), "allocations")
    placed = meta.join(checked_broadcast(got.filter("rest > 0")), LEAF).withColumn("key", _order_key(p)).withColumn("bucket", _bucket(F.col("key")))
    sums = placed.groupBy(*LEAF, "rest", "bucket").agg(F.sum("n_tokens").alias("t"))
    upto = Window.partitionBy(*LEAF).orderBy("bucket")
    sums = sums.withColumn("end", F.sum("t").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    cut = sums.filter(F.col("end") > F.col("rest")).groupBy(*LEAF).agg(F.min_by(F.struct("bucket", (F.col("end") - F.col("t")).alias("before")), "bucket").alias("c"))
    cut = materialize(cut.select(*LEAF, F.col("c.bucket").alias("bucket"), F.col("c.before").alias("before")), "cuts")
    inside = placed.join(checked_broadcast(cut), [*LEAF, "bucket"])
    running = F.sum("n_tokens").over(Window.partitionBy(*LEAF).orderBy("key").rangeBetween(Window.unboundedPreceding, 0))
    last = inside.withColumn("end", F.col("before") + running).filter(F.col("end") <= F.col("rest")).groupBy(*LEAF).agg(F.max("key").alias("last_key"))
    out = got.join(cut.select(*LEAF, F.col("bucket").alias("cut_bucket")), LEAF, "left").join(last, LEAF, "left")
    return materialize(out.select(*LEAF, "full", "parts", "alloc", "cut_bucket", "last_key"), "rules")


def with_copies(docs: DataFrame, p: MixParams) -> DataFrame:
    """row (docs' own columns, whatever their names), doc_id, leaf and `copies`, the epochs that the document is in."""
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", *_leaf_columns(p))
    j = named.join(checked_broadcast(rules(docs, p)), LEAF)
    key = _order_key(p)
    bucket = _bucket(key)
    taken = (bucket < F.col("cut_bucket")) | ((bucket == F.col("cut_bucket")) & (key <= F.col("last_key")))
    return j.withColumn("copies", F.col("full") + F.coalesce(taken, F.lit(False)).cast("long"))


def mixture(docs: DataFrame, params: MixParams | None = None) -> DataFrame:
    """doc_id, domain, language, src, n_tokens, copies of the documents that the mixture has."""
    p = params or MixParams()
    out = with_copies(docs.select("doc_id", "text", "lang", "source"), p).filter("copies > 0")
    return out.select("doc_id", *LEAF, tokens(F.col("row.text")).alias("n_tokens"), "copies")


def select_documents(docs: DataFrame, params: MixParams | None = None) -> DataFrame:
    """The mixture's documents with their own columns, as often as they are in it."""
    out = with_copies(docs, params or MixParams()).filter("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth_copy")).select("row.*")


def oracle(p: MixParams | None = None) -> str:
    """The same in DuckDB SQL, with a plain ordering of each leaf."""
    p = p or MixParams()
    case = lambda c, w: "CASE " + " ".join(f"WHEN {c} = '{k}' THEN {v}" for k, v in w.items()) + f" ELSE {p.default_weight} END"

    def fill(nodes: str, parent: str, name: str) -> str:
        by = f"PARTITION BY {parent}" if parent else ""
        own = f"{parent}, {name}" if parent else name
        prior = f"OVER ({by} ORDER BY cap::DOUBLE / w, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        return f"""(
  SELECT {own}, CASE WHEN first_open IS NULL OR i < first_open THEN cap ELSE (max(CASE WHEN i = first_open THEN lft END) OVER ({by}) * w) // (max(CASE WHEN i = first_open THEN heavy END) OVER ({by})) END AS alloc
  FROM (SELECT *, min(CASE WHEN cap * heavy > lft * w THEN i END) OVER ({by}) AS first_open
    FROM (SELECT *, row_number() OVER ({by} ORDER BY cap::DOUBLE / w, {name}) AS i, budget - coalesce(sum(cap) {prior}, 0) AS lft,
                 sum(w) OVER ({by}) - coalesce(sum(w) {prior}, 0) AS heavy FROM {nodes})))"""

    return f"""
WITH meta AS (
  SELECT doc_id, CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' THEN 'd_other'
      ELSE concat('d', CAST(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS BIGINT) % {p.n_domains}) END AS domain,
    coalesce(lang, 'und') AS language, coalesce(source, 'unknown') AS src,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
leaves AS (SELECT domain, language, src, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) AS BIGINT) * {p.max_epochs} AS cap FROM meta GROUP BY ALL),
d0 AS (SELECT domain, sum(cap) AS cap, (sum(sum(tokens)) OVER () * {p.budget_percent}) // 100 AS budget, {case("domain", p.domain_weights)} AS w FROM leaves GROUP BY domain),
d1 AS (SELECT * FROM {fill("d0", "", "domain")}),
l0 AS (SELECT domain, language, sum(cap) AS cap, {case("language", p.language_weights)} AS w, any_value(alloc) AS budget FROM leaves JOIN d1 USING (domain) GROUP BY domain, language),
l1 AS (SELECT * FROM {fill("l0", "domain", "language")}),
s0 AS (SELECT domain, language, src, cap, {case("src", p.source_weights)} AS w, alloc AS budget FROM leaves JOIN l1 USING (domain, language)),
s1 AS (SELECT * FROM {fill("s0", "domain, language", "src")}),
plan AS (SELECT domain, language, src, CASE WHEN tokens > 0 THEN alloc // tokens ELSE {p.max_epochs} END AS epochs,
    CASE WHEN tokens > 0 THEN alloc % tokens ELSE 0 END AS rest FROM leaves JOIN s1 USING (domain, language, src)),
placed AS (SELECT *, md5(concat_ws(':', '{p.seed}', CAST(CAST(epochs AS BIGINT) AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), ''))) AS k FROM meta JOIN plan USING (domain, language, src)),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, language, src ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM placed)
SELECT doc_id, domain, language, src, n_tokens, CAST(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM run WHERE epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END > 0
"""
