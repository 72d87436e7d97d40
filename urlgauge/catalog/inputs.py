"""Views over the given tables that the registered queries share, for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans import ordered
from ..sources.tables import spread

TABLES = ["lineitem", "pages", "labels", "events", "embeddings"]
# Suffix rules of the registered queries: ordinary ones plus three private suffixes.
RULES = ["com", "net", "org", "co.uk", "example.com", "example.net", "example.org"]
ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]

URLS_V = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_discount, l_extendedprice,
 case l_partkey % 6
  when 0 then concat('https://www.supplier', cast(l_suppkey as string), '.com/part/', cast(l_partkey as string), '?ref=', cast(l_orderkey as string))
  when 1 then concat('http://192.0.2.', cast(l_suppkey % 256 as string), '/paypal/login', cast(l_linenumber as string), '.php')
  when 2 then concat('http://secure-apple-', cast(l_suppkey as string), '.xyz//account/', cast(l_partkey as string))
  when 3 then concat('https://xn--pple-', cast(l_suppkey % 90 + 10 as string), 'd.com/signin/', cast(l_partkey as string))
  when 4 then concat(' bit.ly/', cast(l_partkey as string))
  else concat('HTTP://User', cast(l_linenumber as string), '@Shop.Supplier', cast(l_suppkey as string), '.CO.UK:8080/a%20b/', cast(l_partkey as string), '#top')
 end as url,
 case when l_returnflag = 'R' then 'phishing'
      when l_returnflag = 'A' and l_linestatus = 'O' then 'defacement'
      when l_returnflag = 'A' then 'malware' else 'benign' end as original_label
from lineitem"""

# URLs that exercise every reason for rejection, one row per line item.
EDGE_V = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
 case (l_partkey + l_linenumber) % 13
  when 0 then concat('http://a', cast(l_suppkey as string), '.com:', cast(64500 + l_partkey as string), '/')
  when 1 then concat('http:///path', cast(l_partkey as string))
  when 2 then concat('http://a b', cast(l_suppkey as string), '.com/')
  when 3 then concat('http://[::1/', cast(l_partkey as string))
  when 4 then ''
  when 5 then concat('http://a', cast(l_suppkey as string), '.com/', chr(1), cast(l_partkey as string))
  when 6 then concat('http://a.com:x', cast(l_linenumber as string), '/')
  when 7 then concat('ftp://files', cast(l_suppkey as string), '.org/', cast(l_partkey as string))
  when 8 then concat('a', cast(l_suppkey as string), '.com:/')
  when 9 then concat('http://User', cast(l_linenumber as string), '@A', cast(l_suppkey as string), '.com/?')
  when 10 then concat('http://[2001:db8::', cast(l_linenumber as string), ']:8080/', cast(l_partkey as string))
  when 11 then concat('http://a', cast(l_suppkey as string), '.com/#')
  else concat('  HTTP://a', cast(l_suppkey as string), '.com/  ')
 end as url,
 case when l_linenumber = 7 then '' when l_linenumber = 6 then ' PHISHING '
      when l_returnflag = 'R' then 'Phishing'
      when l_returnflag = 'A' then 'malware' else 'benign' end as original_label
from lineitem"""

ALL_URLS = f"select url from pages union select url from ({URLS_V}) v"

HISTORY_V = """
select event_id + 1 as id, concat('https://', event_type, cast(user_id as string), '.Example.com/') as url,
 least(greatest(value, 0), 100) as trust_score, 100 - least(greatest(value, 0), 100) as risk_percent,
 case user_id % 5 when 0 then 'Lower predicted risk' when 1 then 'Potential phishing'
  when 2 then 'Safe' when 3 then 'risky' else 'unknown' end as status, ts
from events"""

SCORED_V = f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, url,
 case when original_label = 'benign' then 0 else 1 end as label, model,
 case when model = 'coarse' then round(l_discount * 10, 2)
      else round((l_extendedprice - floor(l_extendedprice / 1000) * 1000) / 1000, 6) end as probability,
 case when url like 'https:%' then 1 else 0 end as uses_https
from ({URLS_V}) v, (select 'coarse' as model union all select 'fine' as model) m"""


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(scan(spark, sf_dir, name))


def view(spark: SparkSession, sf_dir: str, sql: str, read=table) -> DataFrame:
    """Run a view's text over the given tables."""
    used = [n for n in TABLES if f"from {n}" in sql]
    for name in used:
        sql = sql.replace(f"from {name}", f"from {{{name}}}")
    return spark.sql(sql, **{n: read(spark, sf_dir, n) for n in used})


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url")


def all_urls(spark, sf_dir):
    return view(spark, sf_dir, ALL_URLS)


def every_url(spark, sf_dir):
    """The distinct URLs of all views, dealt out anew: the tasks of the distinct have few bytes, but much work on URLs."""
    rows = view(spark, sf_dir, f"{ALL_URLS} union select url from ({EDGE_V}) e")
    return rows.repartition(max(32, 4 * spark.sparkContext.defaultParallelism), "url")


def scored(spark, sf_dir):
    """Two models' scores per row; the models are the elements of a two-element array."""
    rows = view(spark, sf_dir, URLS_V)
    price = F.col("l_extendedprice")
    pairs = F.array(
        F.struct(F.lit("coarse").alias("model"), F.round(F.col("l_discount") * 10, 2).alias("probability")),
        F.struct(F.lit("fine").alias("model"),
                 F.round((price - F.floor(price / 1000) * 1000) / 1000, 6).alias("probability")))
    return rows.select(
        *ROW_KEY, "url", F.when(F.col("original_label") == "benign", 0).otherwise(1).alias("label"),
        F.when(F.col("url").startswith("https:"), 1).otherwise(0).alias("uses_https"),
        F.inline_outer(pairs))


_held: dict = {}


def held(spark, sf_dir, name, make) -> DataFrame:
    """A shared intermediate table, written once per session to the checkpoint folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _held:
        _held[key] = make(spark, sf_dir)
    return _held[key]


def raw(spark, sf_dir):
    """The larger source: URL list with source rows numbered by its unique key.

    Numbering lays the rows out and writes them, so the scan isn't dealt out before and nothing is written after."""
    return held(spark, sf_dir, "raw", lambda s, d: ordered.number_rows(
        view(s, d, URLS_V, scan), ROW_KEY, "source_row"))


def raw_edges(spark, sf_dir):
    return held(spark, sf_dir, "edges", lambda s, d: ordered.number_rows(
        view(s, d, EDGE_V, scan), ROW_KEY, "source_row"))


def history(spark, sf_dir):
    return view(spark, sf_dir, HISTORY_V)


def learnable(spark, sf_dir):
    """Rows with a label that the URL text determines."""
    return view(spark, sf_dir, URLS_V).withColumn(
        "label", F.when((F.col("l_partkey") % 6).isin(1, 2, 3), 1).otherwise(0))


