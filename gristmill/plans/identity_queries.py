"""Queries that match records with what is known: canonical names, several keys, quotations, nearest vectors, copies, cycles and bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import physics, text as fn, unicode as forms
from ..operators import graph, identity, quotations, tables as ops
from ..streaming import events as streams
from .registry import query, read

_NORMAL = r"regexp_replace(regexp_replace(lower(trim({0})), '\s+', ' ', 'g'), '^[ .,;:!?]+|[ .,;:!?]+$', '', 'g')"


@query(f"""
with m as (select p_partkey, case p_partkey % 5 when 0 then p_name when 1 then upper(p_name) || ' ,' when 2 then p_type when 3 then 'Fresh  ' || p_name else 'unknown ' || p_partkey end as mention from part),
a as (select p_name as key, min(p_partkey) as id from part group by 1), c as (select {_NORMAL.format('p_type')} as key, min(p_partkey) as id from part group by 1),
n as (select *, {_NORMAL.format('mention')} as normal from m), s as (select *, trim(regexp_replace(replace(' ' || normal || ' ', ' fresh ', ' '), '\\s+', ' ', 'g')) as bare from n)
select p_partkey, mention, coalesce(x.id, y.id, c.id, z.id) as id,
  case when x.id is not null then 1.0 when y.id is not null then 0.95 when c.id is not null then 0.9 when z.id is not null then 0.7 end::double as confidence,
  case when x.id is not null then 'exact' when y.id is not null then 'normalised' when c.id is not null then 'canonical' when z.id is not null then 'stripped' end as method
from s left join a x on mention = x.key left join a y on normal = y.key left join c on normal = c.key left join a z on bare = z.key
""")
def canonical_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of parts: as listed, in normal form, by the canonical name, or without modifiers; the first that hits counts."""
    p = read(spark, sf_dir, "part")
    turn = F.col("p_partkey") % 5
    mention = F.when(turn == 0, F.col("p_name")).when(turn == 1, F.concat(F.upper("p_name"), F.lit(" ,"))).when(turn == 2, F.col("p_type")).when(turn == 3, F.concat(F.lit("Fresh  "), "p_name")).otherwise(F.concat(F.lit("unknown "), "p_partkey"))
    m = p.select("p_partkey", mention.alias("mention"))
    normal = fn.normal_name(F.col("mention"))
    listed = lambda key: p.select(key.alias("key"), F.col("p_partkey").alias("id"))
    levels = [(F.col("mention"), listed(F.col("p_name")), 1.0), (normal, listed(fn.normal_name(F.col("p_name"))), 0.95), (normal, listed(fn.normal_name(F.col("p_type"))), 0.9), (fn.without_modifiers(normal, ("fresh",)), listed(fn.normal_name(F.col("p_name"))), 0.7)]
    return ops.cascade(m, levels, ["exact", "normalised", "canonical", "stripped"]).select("p_partkey", "mention", "id", "confidence", "method")


@query("""
with k as (select c_custkey, c_nationkey || ':' || floor(c_acctbal / 100)::bigint as a, c_mktsegment || ':' || floor(c_acctbal / 20)::bigint as b, floor(c_acctbal / 8)::bigint::varchar as c from customer),
known as (select * from k where c_custkey % 2 = 0), ka as (select a, min(c_custkey) as ia from known group by 1), kb as (select b, min(c_custkey) as ib from known group by 1), kc as (select c, min(c_custkey) as ic from known group by 1),
h as (select c_custkey, ia, ib, list_distinct(list_filter([ia, ib, ic], lambda x: x is not null)) as ids from k left join ka using (a) left join kb using (b) left join kc using (c) where c_custkey % 2 = 1)
select c_custkey, case when len(ids) = 1 then ids[1] end as match_id, case when len(ids) = 0 then 'none' when len(ids) > 1 then 'conflict' when coalesce(ia, ib) is not null then 'strong' else 'weak' end as match from h
""")
def identity_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with odd keys among those with even keys, by two strong keys and a weak one."""
    cell = lambda width: F.floor(F.col("c_acctbal") / width).cast("string")
    k = read(spark, sf_dir, "customer").select("c_custkey", F.concat_ws(":", "c_nationkey", cell(100)).alias("a"), F.concat_ws(":", "c_mktsegment", cell(20)).alias("b"), cell(8).alias("c"))
    return identity.resolve(k.where("c_custkey % 2 = 1"), k.where("c_custkey % 2 = 0"), "c_custkey", ["a", "b"], ["c"]).select("c_custkey", "match_id", "match")


@query()
def citation_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How whole benchmark items fit the documents that quote them: as they stand, in normal form, or with up to a tenth of other characters."""
    found = quotations.quoted(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")
    return found.withColumn("item_id", F.col("item_id").cast("long"))


@query(r"""
select strip_accents(lower(w)) as word, count(*) as n from (select unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as w from documents) group by 1
""")
def folded_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents without case and accents. Words are counted first, so only different ones are folded."""
    words = read(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("w"))
    counted = words.groupBy(F.lower("w").alias("w")).agg(F.count("*").alias("n"))
    return counted.groupBy(forms.without_accents(F.col("w")).alias("word")).agg(F.sum("n").alias("n"))


@query("""
with s as (select q.vec_id, e.vec_id as other, round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 9) as sim from embeddings q, embeddings e where q.vec_id % 20 = 0 and e.vec_id % 20 <> 0),
t as (select *, row_number() over (partition by vec_id order by sim desc, other) as k from s)
select vec_id, other as nearest_id, round(sim, 6) as similarity, case when sim > 0.9 then 'duplicate' when sim > 0.75 then 'similar' else 'novel' end as verdict from t where k = 1
""")
def embed_cross_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New vectors (one in twenty) against all others."""
    e = read(spark, sf_dir, "embeddings")
    found = identity.nearest(e.where("vec_id % 20 = 0"), e.where("vec_id % 20 <> 0"), "vec_id", "embedding")
    return found.select("vec_id", "nearest_id", F.round("similarity", 6).alias("similarity"), identity.novelty(F.col("similarity")).alias("verdict"))


@query()
def registered_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts taken up in order under two strong keys that overlap and a weak one; a plain loop over the same rows is the test."""
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part").select("p_partkey", F.when(k % 3 == 0, F.concat(F.lit("x"), F.floor(k / 12))).alias("code"), F.when(k % 4 < 2, F.concat(F.lit("y"), F.floor(k * 7 / 50))).alias("number"), F.when(k % 5 < 3, F.concat("p_name", "p_brand", F.lit("p_size"))).alias("name"))
    return identity.registered(p, "p_partkey", ["code", "number"], ["name"]).select("p_partkey", "entry", "outcome")


@query("select min(doc_id) as doc_id, count(*) as n_copies from documents group by text, lang, source")
def exact_row_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of equal rows; digests are shuffled, not texts."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "lang", "source")
    return d.groupBy("digest", "lang", "source").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies")).select("doc_id", "n_copies")


@query("""
with recursive e as (select p_partkey as src, (p_partkey * 13 + p_size) % 200 as dst from part),
w as (select src as origin, dst as place from e where src < 200 union select origin, dst from w join e on place = src)
select src, dst, src in (select origin from w where origin = place) as cyclic from e
""")
def edge_dag_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges with whether they lie on a cycle; each part has one edge out, so there is nothing between cycles."""
    edges = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("src"), ((F.col("p_partkey") * 13 + F.col("p_size")) % 200).alias("dst"))
    free, cyclic = graph.acyclic_part(edges)
    return free.withColumn("cyclic", F.lit(False)).unionByName(cyclic.withColumn("cyclic", F.lit(True))).select("src", "dst", "cyclic")


@query("""
with recursive e as (select p_partkey as src, p_partkey // 2 as dst from part where p_partkey > 0 union select p_partkey, p_partkey * 5 // 7 from part where p_partkey > 0 union select p_partkey, (p_partkey * 3 + 1) % 20 from part where p_partkey % 20 < 9),
r as (select src as a, dst as b from e where src < 20 union select a, dst from r join e on src = b),
nodes as (select src as node from e union select dst from e),
s as (select node, least(node, coalesce((select min(x.b) from r x join r y on x.a = node and y.a = x.b and y.b = node), node)) as scc, exists (select 1 from r where a = node and b = node) as cyclic from nodes),
c as (select distinct x.scc as src, y.scc as dst from e join s x on x.node = e.src join s y on y.node = e.dst where x.scc <> y.scc),
l as (select scc as node, 0::bigint as level from s where scc not in (select dst from c) union select c.dst, level + 1 from l join c on c.src = l.node)
select s.node, max(level) as level, any_value(cyclic) as cyclic from s join l on l.node = s.scc group by 1
""")
def task_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks by the longest path of dependencies that leads to them, tasks on a cycle as one; cyclic is true on a cycle alone."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("src"))
    down = p.where("src > 0").select("src", F.explode(F.array(F.floor(F.col("src") / 2), F.floor(F.col("src") * 5 / 7))).alias("dst"))
    round_ = p.where("src % 20 < 9").select("src", ((F.col("src") * 3 + 1) % 20).alias("dst"))
    return graph.levels(down.unionByName(round_))


@query("""
select p_partkey, concat_ws(';', case when p_size is null then 'p_size missing' when p_size < 3 then 'p_size below 3' when p_size > 40 then 'p_size above 40' end,
  case when p_retailprice is null then 'WARN: p_retailprice missing' when p_retailprice < 950 then 'WARN: p_retailprice below 950' end) as issues, coalesce(p_size between 3 and 40, false) as ok from part
""")
def bounds_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = physics.bounds_issues({"p_size": (3, 40, False), "p_retailprice": (950, None, True)})
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(issues, ";").alias("issues"), physics.passed(issues).alias("ok"))


@query("select event_id, event_type from events")
def stream_dedup_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that brings every event twice; keyed state lets the first through."""
    return streams.run_once(spark, f"{sf_dir}/events.parquet", lambda e: streams.first_of_each(e.unionByName(e), ["event_id"]).select("event_id", "event_type"))


@query("""
with recursive t as (select user_id, event_type, row_number() over (partition by user_id order by ts, event_id) as k from events where event_type in ('view', 'click', 'purchase')),
m as (select distinct user_id, 0::bigint as k, 'pending' as state, 0::bigint as attempts from t union all
  select m.user_id, t.k, case when state in ('pending', 'failed') and event_type = 'view' then 'in_progress' when state = 'in_progress' and event_type = 'purchase' then 'done'
    when state = 'in_progress' and event_type = 'click' then case when attempts <= 2 then 'failed' else 'dead_letter' end else state end, attempts + (state in ('pending', 'failed') and event_type = 'view')::bigint
  from m join t on t.user_id = m.user_id and t.k = m.k + 1)
select user_id, arg_max(state, k) as state, max(attempts) as attempts from m group by 1
""")
def stream_task_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as tasks: a view begins one, a click fails it, a purchase ends it; the last update of each."""
    updates = streams.run_once(spark, f"{sf_dir}/events.parquet", lambda e: streams.tasks(e, "user_id", "event_type", ["ts", "event_id"], "view", "click", "purchase"), "update")
    return updates.groupBy("user_id").agg(F.max_by("state", "seen").alias("state"), F.max("attempts").alias("attempts"))


@query("""
select l_partkey, l_returnflag as source, string_agg(distinct l_suppkey::varchar, ',' order by l_suppkey::varchar) as ids from lineitem group by 1, 2
""")
def external_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers of each part by return flag, as a map that is laid out in rows again."""
    items = read(spark, sf_dir, "lineitem").withColumn("supplier", F.col("l_suppkey").cast("string"))
    return ops.multimap(items, "l_partkey", "l_returnflag", "supplier").select("l_partkey", F.explode("ids").alias("source", "v")).select("l_partkey", "source", F.array_join("v", ",").alias("ids"))
