"""The domain's relations over the driver's tables, as SQL that Spark and DuckDB read alike ({table} stands for a table)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a table's files for each part that its rows are dealt to.
PART_BYTES = 4 << 20

ITEMS = """
SELECT CAST(o.o_orderkey AS STRING) AS item_id, o.o_orderkey AS seq,
       CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'instagram' ELSE 'youtube' END AS source,
       c.c_name AS handle, CAST(floor(CASE WHEN c.c_acctbal < 0 THEN 0 ELSE c.c_acctbal * 150 END) AS BIGINT) AS followers,
       (o.o_orderkey * 7) % 5000 AS likes, (o.o_orderkey * 13) % 300 AS comments, (o.o_orderkey * 31) % 20000 AS views,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE concat('T', CAST(o.o_orderkey % 5000 AS STRING)) END AS url_tag,
       CASE o.o_orderstatus WHEN 'F' THEN 'hashtag_tracking' WHEN 'O' THEN 'influencer_fixed' ELSE 'bollywood_decode' END AS source_type,
       CAST(o.o_orderdate AS DATE) AS post_date, o.o_orderdate + INTERVAL '1' MINUTE * (o.o_orderkey % 1440) AS posted_at
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
"""

GROUPS = """
SELECT CAST(l.l_orderkey AS STRING) AS item_id,
       row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey) - 1 AS canonical_index,
       CAST(floor(l.l_quantity) AS BIGINT) % 8 AS n_objects, l.l_discount * 5 AS area,
       CASE p.p_type WHEN 'ECONOMY' THEN 'Kurta' WHEN 'SMALL' THEN 'A-line Kurta' WHEN 'MEDIUM' THEN ' saree' WHEN 'PROMO' THEN 'Co-ord' WHEN 'LARGE' THEN 'lehenga' ELSE 'poncho' END AS upper_word,
       CASE p.p_size % 6 WHEN 0 THEN 'palazzo' WHEN 1 THEN 'Salwar' WHEN 2 THEN 'jeans' WHEN 3 THEN 'skirt' ELSE NULL END AS lower_word,
       CASE p.p_size % 5 WHEN 0 THEN 'dupatta' WHEN 1 THEN 'Nehru' ELSE NULL END AS outer_word,
       CASE WHEN l.l_suppkey % 5 = 0 THEN FALSE WHEN l.l_suppkey % 7 = 0 THEN NULL ELSE TRUE END AS upper_is_ethnic,
       CASE WHEN l.l_partkey % 4 = 0 THEN TRUE WHEN l.l_partkey % 4 = 1 THEN NULL ELSE FALSE END AS lower_is_ethnic,
       l.l_linestatus = 'F' AS dress_as_single, p.p_partkey % 9 = 0 AS is_co_ord_set,
       CASE p.p_size % 10 WHEN 0 THEN 'Cotton' WHEN 1 THEN 'silk' WHEN 2 THEN 'Chanderi' WHEN 3 THEN 'linen blend' WHEN 5 THEN 'georgette' WHEN 7 THEN 'satin' WHEN 8 THEN 'net' WHEN 4 THEN 'denim' ELSE NULL END AS fabric_word,
       CASE p.p_partkey % 8 WHEN 0 THEN 'plain' WHEN 1 THEN 'Woven' WHEN 2 THEN 'print' WHEN 3 THEN 'zardozi' WHEN 4 THEN 'block print' WHEN 5 THEN 'mirror-work' WHEN 6 THEN 'unheard of' ELSE NULL END AS technique_word,
       CASE p.p_size % 7 WHEN 0 THEN 'straight' WHEN 1 THEN 'a_line' WHEN 2 THEN 'flared' WHEN 3 THEN 'boxy' WHEN 4 THEN 'tiered' ELSE NULL END AS silhouette,
       concat('#', substring(md5(CAST(p.p_partkey % 300 AS STRING)), 1, 6)) AS hex, l.l_tax AS tax
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
"""

#: One tag of an item, with mixed case, signs, noise and words that no vocabulary has.
TAGS = """
SELECT CAST(l.l_orderkey AS STRING) AS item_id, row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey) AS pos,
       CASE l.l_partkey % 16 WHEN 0 THEN '#KurtaSet' WHEN 1 THEN '#saree' WHEN 2 THEN '#cottonkurta' WHEN 3 THEN 'love' WHEN 4 THEN '#reelsindia' WHEN 5 THEN '#haul'
         WHEN 6 THEN '#blockprint' WHEN 7 THEN '##Diwali' WHEN 8 THEN '#ootd' WHEN 9 THEN '#palazzo' WHEN 10 THEN '#akshayatritiya' ELSE concat('#new', CAST(extract(year FROM o.o_orderdate) * 100 + extract(month FROM o.o_orderdate) AS STRING)) END AS tag
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

#: What is said of an item in words.
CAPTIONS = """
SELECT CAST(o.o_orderkey AS STRING) AS item_id, concat('Look of the day: ',
       CASE o.o_orderkey % 12 WHEN 0 THEN 'Kurta Set' WHEN 1 THEN 'ready to wear SAREE' WHEN 2 THEN 'band collar top' WHEN 3 THEN 'Anarkali' WHEN 4 THEN 'nothing' WHEN 5 THEN 'mulmul Dress'
         WHEN 6 THEN 'hand block print' WHEN 7 THEN 'office wear' WHEN 8 THEN 'Diwali party' WHEN 9 THEN 'weekend trip' WHEN 10 THEN 'denim' ELSE 'plain linen' END,
       CASE WHEN o.o_orderkey % 3 = 0 THEN concat(' @Brand', CAST(o.o_custkey % 40 AS STRING)) ELSE '' END,
       CASE WHEN o.o_orderkey % 9 = 0 THEN concat(' with @brand', CAST(o.o_custkey % 23 AS STRING), ' @nobody') ELSE '' END) AS caption
FROM {orders} o
"""

BRANDS = """
SELECT CAST(s.s_suppkey AS STRING) AS brand_id, concat('brand', CAST(s.s_suppkey AS STRING)) AS handle, s.s_name AS name,
       CASE s.s_nationkey % 3 WHEN 0 THEN 'value' WHEN 1 THEN 'mid' ELSE 'premium_everyday' END AS tier
FROM {supplier} s
"""

#: Brands of an item, one row for each line that names one.
ITEM_BRANDS = """
SELECT CAST(l.l_orderkey AS STRING) AS item_id, s.s_name AS name FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
"""

#: Snapshots of an external id's counter.
SNAPSHOTS = """
SELECT CASE WHEN e.event_type IN ('click', 'view') THEN 'instagram' ELSE 'youtube' END AS source, concat('U', CAST(e.user_id AS STRING), e.event_type) AS url_tag,
       e.event_id AS snapshot_id, e.ts AS collected_at, CAST(floor(e.value * 10) AS BIGINT) + e.event_id AS metric
FROM {events} e
"""

#: A daily history by cluster.
HISTORY = """
SELECT concat(e.event_type, '__k', CAST(e.user_id % 10 AS STRING)) AS cluster, CAST(e.ts AS DATE) AS d, CAST(count(*) AS BIGINT) AS posts,
       CAST(sum(floor(e.value)) AS BIGINT) AS views, CAST(sum(e.event_id % 7) AS BIGINT) AS tags, round(sum(e.value), 2) AS score
FROM {events} e GROUP BY 1, 2
"""

ACCOUNTS = """
SELECT concat(e.event_type, '__k', CAST(e.user_id % 10 AS STRING)) AS cluster, CAST(e.ts AS DATE) AS d, concat('a', CAST((e.user_id * 7 + e.event_id) % 900 AS STRING)) AS account
FROM {events} e
"""

#: A weekly history by cluster over all years.
WEEKLY = """
SELECT concat(p.p_type, '__', CAST(p.p_size % 6 AS STRING)) AS cluster, CAST(date_trunc('week', l.l_shipdate) AS DATE) AS week, round(sum(l.l_discount * 100), 4) AS score, CAST(count(*) AS BIGINT) AS n
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey GROUP BY 1, 2
"""

RELATIONS = {
    "items": ITEMS, "groups": GROUPS, "tags": TAGS, "captions": CAPTIONS, "brands": BRANDS, "item_brands": ITEM_BRANDS,
    "snapshots": SNAPSHOTS, "history": HISTORY, "accounts": ACCOUNTS, "weekly": WEEKLY,
}

#: Relations of lines that are grouped by item.
BY_ITEM = ("groups", "tags", "item_brands")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(df: DataFrame) -> int:
    """How many parts the rows of a table are dealt to: the session's number, more if its files are large, so that what a task holds doesn't grow with them."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def _by_item(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A relation of lines with the rows of its text. Lines are dealt by item_id once: what numbers an item's lines, groups them or joins items finds them together."""
    join = re.search(r"\{lineitem\} l JOIN \{(\w+)\} (\w) ON l\.(\w+) = \w\.(\w+)", text)
    other, name, left, right = join.groups()
    lines, more = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, other)
    item, n = F.col("l_orderkey").cast("string"), parts(lines)
    if left == "l_orderkey":  # the same key
        rows = lines.withColumn("item_id", item).repartition(n, "item_id").join(more.withColumn("item_id", F.col(right).cast("string")), "item_id")
    else:
        rows = lines.join(more, F.col(left) == F.col(right)).withColumn("item_id", item).repartition(n, "item_id")
    text = re.sub(rf"\b{name}\.(?={name}_)", "l.", text.replace(join.group(), "{lines} l"))
    return spark.sql(text.replace("CAST(l.l_orderkey AS STRING) AS item_id", "l.item_id").replace("PARTITION BY l.l_orderkey", "PARTITION BY l.item_id"), lines=rows)


def relation(spark: SparkSession, sf_dir: str, name: str, by_item: bool = True) -> DataFrame:
    """A relation of RELATIONS as a DataFrame; by_item: one of lines is dealt by item_id."""
    text = RELATIONS[name]
    if by_item and name in BY_ITEM:
        return _by_item(spark, sf_dir, text)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", text))})


def with_relations(body: str) -> str:
    """SQL for DuckDB: body with the relations that it names as common table expressions."""
    used = [n for n in RELATIONS if re.search(rf"\b{n}\b", body)]
    ctes = ", ".join(f"{n} AS ({re.sub(r'[{}]', '', RELATIONS[n])})" for n in used)
    body = body.strip()
    if not ctes:
        return body
    return f"WITH {ctes}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {ctes} {body}"
