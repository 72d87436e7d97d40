"""The operators as registered queries over the given tables, with SQL twins where SQL can say them."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (chat, context_tree, decontaminate, exact_dedup, licences, merkle, mixing,
               page_text, pii, ranked_search, sharding, simhash, toxicity)


#: Licences that the licence query takes as accepted.
ACCEPTED = {"mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id_hash(modulus: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op1_exact_dedup(spark, sf_dir):
    """A fresh index, filled with all documents; the result is what the batch was told, which is written."""
    name = f"exact_index_{uuid4().hex[:12]}"
    told = exact_dedup.ExactIndex(spark, name).add(_table(spark, sf_dir, "documents")).drop("known")
    spark.sql(f"drop table {name}")
    return told


def op2_lm_score(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return context_tree.score_documents(docs, _id_hash(10) == 0)


def op3_sharding(spark, sf_dir):
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), 8)


def op4_toxicity(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, _id_hash(5) != 0)
    return model.score(docs.select("doc_id", "text")).select(
        "doc_id", (_id_hash(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_chat_format(spark, sf_dir):
    said = F.lit("\\### Assistant: </turn> ok")
    more = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(turn).cast("bigint").alias("turn"),
                 F.lit(role).alias("role"), said.alias("text")) for turn, role in enumerate(("user", "assistant"))])))
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    # Every row is a message of its own, equal ones too: no msg is given.
    log = rows.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"),
                      F.lit(None).cast("string").alias("msg"), "role", "text")
    return chat.digests(chat.render(chat.fold_events(log)))


def op6_simhash(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op7_mixing(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source")


def op8_pii(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return pii.digests(pii.find(docs, pii.fit(docs)))


def op9_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_licences(spark, sf_dir):
    """`required` and `permitted` have one entry for each expression, joined by semicolons."""
    found = licences.scan_documents(_table(spark, sf_dir, "documents"), accepted=ACCEPTED)
    return found.drop("expressions").withColumn("required", F.array_join("required", ";")).withColumn(
        "permitted", F.array_join(F.transform("permitted", lambda p: p.cast("string")), ";"))


def op11_html_text(spark, sf_dir):
    return page_text.main_text(_table(spark, sf_dir, "pages"))


def op12_merkle_manifest(spark, sf_dir):
    """Rows whose id's hash is divisible by five show a text with its capitals lower-cased."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    altered = merkle.leaf_digest(text=F.translate("text", capitals, capitals.lower()))
    return merkle.verify(_table(spark, sf_dir, "documents"), F.when(_id_hash(5) == 0, altered))


def op13_ranked_search(spark, sf_dir):
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=50)


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_lm_score, op3_sharding, op4_toxicity, op5_chat_format, op6_simhash, op7_mixing,
    op8_pii, op9_decontaminate, op10_licences, op11_html_text,
    op12_merkle_manifest, op13_ranked_search, pipeline)}

OP1_SQL = r"""
with t as (select doc_id, coalesce(text, '') as text, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as h
  from documents),
g as (select h, count(*) as group_size, first(doc_id order by length(text) desc, doc_id) as keep_id from t group by h)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, h as text_sha256 from t join g using (h)"""

OP5_SQL = r"""
with c as (select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
p as (select *, replace(replace(text, '&', '&amp;'), '<', '&lt;') as body from c)
select conv_id, count(*) as n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
 coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
 sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
 sum(length('<turn ' || role || '>' || body || '</turn>' || chr(10)))::bigint as formatted_chars
from p group by conv_id"""

OP7_SQL = r"""
with recursive t as (select doc_id, source, md5('mix:' || cast(doc_id as varchar)) as o,
  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size,
  (array[5, 2, 1])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight from t group by source),
levels as (
  select 0 as round, (select sum(source_size) from s)::double / (select sum(weight) from s)::double as level
  union all
  select round + 1, (((select sum(source_size) from s) - (select coalesce(sum(3 * source_size), 0) from s where 3 * source_size <= level * weight))::double
   / (select sum(weight) from s where 3 * source_size > level * weight)::double)
  from levels where round < (select count(*) from s)
   and exists (select 1 from s where 3 * source_size > level * weight)),
a as (select source, source_size, least(3.0::double * source_size, (select max(level) from levels) * weight) as target from s),
b as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from a),
r as (select t.*, source_size, target, whole, greatest(0, round(target)::bigint - whole * source_size) as rest,
  (sum(size) over (partition by t.source order by o, doc_id) - size)::bigint as before
  from t join b on t.source is not distinct from b.source)
select doc_id, size, source_size, target, (whole * size + least(size, greatest(0, rest - before)))::bigint as taken from r"""

#: For pages as the tables hold them: an article of p and h1, in which only b and br occur besides.
OP11_SQL = r"""
with a as (select page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1),
  '</?(p|h1)>', chr(1), 'g') as body from pages),
b as (select page_id, url, array_to_string(list_filter(list_transform(
  string_split(regexp_replace(replace(body, '<br>', ' '), '<[^>]*>', '', 'g'), chr(1)),
  lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) as coded from a),
c as (select page_id, url, regexp_replace(replace(replace(replace(replace(coded, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
  '&#x27;', chr(39)), '&amp;?', '&', 'g') as text from b)
select page_id, url, text, length(text) as n_chars from c"""

#: Levels, links and climb by recursion; `leaf` and `claim` are the digests of the rows as stored and as presented.
OP12_SQL = r"""
with recursive crc as (select *, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda x: ord(x)::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, k: if(x & 1 = 1, xor(x >> 1, 3988292384), x >> 1))), 4294967295) as crc from documents),
shown as (select *, case when crc % 5 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
  else text end as presented from crc),
fields as (select *, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
  || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head from shown),
l as (select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
  sha256(head || coalesce(strlen(presented) || ':' || presented, '-')) as claim,
  row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as number,
  count(*) over (partition by source) as total from fields),
up as (
  select source, 0 as level, number, leaf as digest, total from l
  union all
  select source, level + 1, number // 16, sha256(string_agg(digest, '' order by number)), (total + 15) // 16
  from up where total > 1 group by source, level, number // 16, total),
subroots as (select source, level as height, digest,
  row_number() over (order by source nulls first) - 1 as rank, count(*) over () as total from up where total = 1),
top as (
  select 0 as level, rank as number, digest, total from subroots
  union all
  select level + 1, number // 16, sha256(string_agg(digest, '' order by number)), (total + 15) // 16
  from top where total > 1 group by level, number // 16, total),
runs as (select source, level, number // 16 as run, list(digest order by number) as digests from up where total > 1 group by all),
top_runs as (select level, number // 16 as run, list(digest order by number) as digests from top where total > 1 group by all),
climb as (
  select doc_id, source, leaf, number, 0 as level, claim as fold, '' as proof from l
  union all
  select doc_id, c.source, leaf, c.number // 16, c.level + 1,
    sha256(array_to_string(digests[:c.number % 16], '') || fold || array_to_string(digests[c.number % 16 + 2:], '')),
    proof || array_to_string(digests[:c.number % 16], '') || array_to_string(digests[c.number % 16 + 2:], '')
  from climb c join runs r on r.source is not distinct from c.source and r.level = c.level and r.run = c.number // 16),
over as (
  select doc_id, leaf, s.digest as subroot, s.rank as number, 0 as level, fold, proof
  from climb c join subroots s on s.source is not distinct from c.source and s.height = c.level
  union all
  select doc_id, leaf, subroot, c.number // 16, c.level + 1,
    sha256(array_to_string(digests[:c.number % 16], '') || fold || array_to_string(digests[c.number % 16 + 2:], '')),
    proof || array_to_string(digests[:c.number % 16], '') || array_to_string(digests[c.number % 16 + 2:], '')
  from over c join top_runs r on r.level = c.level and r.run = c.number // 16)
select doc_id, leaf, subroot, digest as root, sha256(proof) as proof_sha256, fold as folded_root, fold = digest as verified
from over o join top t on t.total = 1 and t.level = o.level"""

OP13_SQL = r"""
with d as (select row_number() over () as r, doc_id,
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
i as (select row_number() over () as q, item_id,
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from benchmark),
words as (select r, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
tf as (select r, doc_id, term, count(*) as tf from words group by all),
lengths as (select r, sum(tf)::bigint as n from tf group by r),
s as (select count(*) as docs, sum(n)::bigint as total from lengths),
w as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, s group by term, docs),
asked as (select distinct q, item_id, term from (select q, item_id,
  unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from i)),
scores as (select q, item_id, r, doc_id,
  sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))))::bigint as score
  from asked join w using (term) join tf using (term) join lengths using (r), s group by all),
ranked as (select item_id, row_number() over (partition by q order by score desc, doc_id)::int as rank, doc_id, score
  from scores where score > 0)
select * from ranked where rank <= 50"""

ORACLES = {"op1_exact_dedup": OP1_SQL, "op5_chat_format": OP5_SQL, "op7_mixing": OP7_SQL,
           "op11_html_text": OP11_SQL, "op12_merkle_manifest": OP12_SQL, "op13_ranked_search": OP13_SQL}
