"""Queries that look things up: cascades by id, alias, name and suffix, maps, containment, chunks, ordinals, references, nearest vectors; and paths over the graph tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import physics
from ..operators import identity, tables as ops
from ..streaming import events as streams
from .registry import query, read


@query("""
with c as (select p_partkey as id, replace(p_name, ' ', '_') as slug, lower(p_brand) as alias, split_part(p_name, ' ', 2) as name from part where p_partkey % 4 > 0),
i as (select slug as key, max(id) as id from c group by 1), a as (select alias as key, max(id) as id from c group by 1), n as (select name as key, max(id) as id from c group by 1),
q as (select p_partkey, case p_partkey % 5 when 0 then replace(p_name, ' ', '_') when 1 then lower(p_brand) when 2 then split_part(p_name, ' ', 2) when 3 then 'very_fresh_' || replace(p_name, ' ', '_') else 'unheard_of' end as item from part),
s as (select p_partkey, min(k) as k from (select p_partkey, item, unnest(range(1, 5)) as k from q) x where k < len(string_split(item, '_')) and exists (select 1 from n where n.key = array_to_string(list_reverse(list_reverse(string_split(item, '_'))[1:k]), '_')) group by 1)
select q.p_partkey, coalesce(i.id, a.id, n.id, m.id) as id, case when i.id is not null then 1.0 when a.id is not null or n.id is not null then 0.95 when m.id is not null then 0.75 end as confidence, case when i.id is not null then 'id' when a.id is not null then 'alias' when n.id is not null then 'name' when m.id is not null then 'suffix' else 'none' end as method
from q left join i on i.key = item left join a on a.key = item left join n on n.key = item left join s using (p_partkey) left join n m on m.key = array_to_string(list_reverse(list_reverse(string_split(item, '_'))[1:s.k]), '_')
""")
def link_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By id, by alias, by name, then by the shortest suffix of one to four words that is a name; of entries with one key the last counts."""
    p = read(spark, sf_dir, "part")
    c = p.where("p_partkey % 4 > 0").select(F.col("p_partkey").alias("id"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("slug"), F.lower("p_brand").alias("alias"), F.split("p_name", " ")[1].alias("name"))
    item = F.expr("case p_partkey % 5 when 0 then replace(p_name, ' ', '_') when 1 then lower(p_brand) when 2 then split_part(p_name, ' ', 2) when 3 then concat('very_fresh_', replace(p_name, ' ', '_')) else 'unheard_of' end")
    return identity.link(p.select("p_partkey", item.alias("item")), "p_partkey", "item", c, "id", [("id", "slug", 1.0), ("alias", "alias", 0.95), ("name", "name", 0.95)], ("suffix", "name", 0.75, 4)).drop("item")


@query("""
with m(original, name, best, field, ord) as (values ('ECONOMY', 'Brand#1', 'MF-T01', 'k', 1), ('ECONOMY', 'Brand#1', 'MF-T03', 'Ea', 2), ('PROMO', 'Brand#2', 'MF-K01', 'Km', 3), ('LARGE', 'Brand#7', 'MF-M02', 'aw', 4), ('SMALL', 'Brand#9', null, null, 5)),
l as (select original, name, arg_max(coalesce(best, ''), ord) as best, arg_max(coalesce(field, ''), ord) as field from m group by 1, 2)
select p_type, case when best is null then 'unmatched' when best = '' then 'no formula' else best || ':' || field end as outcome, count(*) as n, min(p_partkey) as first_row from part left join l on original = p_type and name = p_brand group by 1, 2
""")
def map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map with a key of two columns, in which later entries replace earlier ones; what it lacks is counted."""
    m = spark.createDataFrame([("ECONOMY", "Brand#1", "MF-T01", "k", 1), ("ECONOMY", "Brand#1", "MF-T03", "Ea", 2), ("PROMO", "Brand#2", "MF-K01", "Km", 3), ("LARGE", "Brand#7", "MF-M02", "aw", 4), ("SMALL", "Brand#9", None, None, 5)], "p_type string, p_brand string, best string, field string, ord int")
    last = m.groupBy("p_type", "p_brand").agg(F.max_by(F.struct("best", "field"), "ord").alias("to"))
    outcome = F.when(F.col("to").isNull(), "unmatched").when(F.col("to.best").isNull(), "no formula").otherwise(F.concat_ws(":", "to.best", "to.field"))
    return read(spark, sf_dir, "part").join(ops.small(last), ["p_type", "p_brand"], "left").groupBy("p_type", outcome.alias("outcome")).agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_row"))


@query("""
with s as (select l_orderkey, string_agg(p_name, ' ' order by l_linenumber, p_partkey) as items from lineitem join part on p_partkey = l_partkey group by 1)
select o_orderkey, contains(coalesce(items, ''), 'red ring') or contains(coalesce(items, ''), 'gizmo') as hit, case when contains(coalesce(items, ''), 'red ring') then 'red ring' when contains(coalesce(items, ''), 'gizmo') then 'gizmo' end as first_word from orders left join s on l_orderkey = o_orderkey
""")
def items_contain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an order's items, written one after the other, hold any of some words."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    items = read(spark, sf_dir, "lineitem").join(p, "l_partkey").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "p_name"))).alias("x"))
    text = F.coalesce(F.array_join(F.transform("x", lambda i: i["p_name"]), " "), F.lit(""))
    words = ("red ring", "gizmo")
    first = F.coalesce(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in words])
    return read(spark, sf_dir, "orders").select("o_orderkey").join(items, "o_orderkey", "left").select("o_orderkey", first.isNotNull().alias("hit"), first.alias("first_word"))


@query("""
with n as (select doc_id, lang, row_number() over (order by doc_id) as line from documents), l as (select event_id as line, arg_min(event_type, ts) as label from events group by 1)
select doc_id, line, coalesce(label, 'unlabelled') as label from n left join l using (line)
""")
def ordinal_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels by the number of a record's line: lines are numbered over all files in their order, and met by that number."""
    d = ops.numbered(read(spark, sf_dir, "documents").select("doc_id", F.lit(1).alias("_all")), ["_all"], ["doc_id"], "line")
    label = read(spark, sf_dir, "events").groupBy(F.col("event_id").alias("line")).agg(F.min_by("event_type", "ts").alias("label"))
    return d.join(label, "line", "left").select("doc_id", "line", F.coalesce("label", F.lit("unlabelled")).alias("label"))


@query("""
with c as (select 'c' || conv_id || '_' || turn as id, 'chunk_' || (conv_id * 10 + turn) as other, text from conversations), r as (select o_orderkey, case when o_orderkey % 3 = 0 then 'chunk_' || o_orderkey else 'c' || o_custkey || '_1' end as source from orders)
select o_orderkey, source, length(coalesce(a.text, b.text, '')) as n_chars from r left join c a on a.id = source left join c b on b.other = source
""")
def chunk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record's chunk by its id or by its number; '' if there is none."""
    c = read(spark, sf_dir, "conversations")
    chunks = c.select(F.explode(F.array(F.concat(F.lit("c"), F.col("conv_id"), F.lit("_"), F.col("turn")), F.concat(F.lit("chunk_"), F.col("conv_id") * 10 + F.col("turn")))).alias("source"), F.char_length("text").alias("n"))
    k = F.col("o_orderkey")
    r = read(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 == 0, F.concat(F.lit("chunk_"), k)).otherwise(F.concat(F.lit("c"), F.col("o_custkey"), F.lit("_1"))).alias("source"))
    return r.join(chunks, "source", "left").select("o_orderkey", "source", F.coalesce("n", F.lit(0)).cast("long").alias("n_chars"))


@query("select vec_id, label from embeddings b where not exists (select 1 from embeddings a where a.vec_id < b.vec_id and list_cosine_similarity(a.embedding::double[], b.embedding::double[]) > 0.45)")
def cosine_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that resemble no earlier row, dropped ones included; the bound is low, as the vectors resemble each other little."""
    e = read(spark, sf_dir, "embeddings")
    return e.join(identity.resembling_earlier(e, "vec_id", "embedding", 0.45), "vec_id", "left_anti").select("vec_id", "label")


@query("""
with k as (select vec_id, 'v' || vec_id as slug, embedding::double[] as e from embeddings where vec_id % 2 = 0), q as (select vec_id as q, case when vec_id % 3 = 0 then 'v' || (vec_id - 1) else '?' end as said, embedding::double[] as e from embeddings where vec_id % 2 = 1),
s as (select q, k.vec_id, round(list_cosine_similarity(q.e, k.e), 9) as s, row_number() over (partition by q order by round(list_cosine_similarity(q.e, k.e), 9) desc, k.vec_id) as r from q, k)
select q.q as vec_id, coalesce(x.vec_id, case when s.s >= 0.4 then s.vec_id end) as found, case when x.vec_id is not null then 'exact' when s.s >= 0.4 then 'near' else 'none' end as how from q left join k x on x.slug = said left join s on s.q = q.q and r = 1
""")
def resolve_substitutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name that is known is taken; only the rest is looked for among the vectors."""
    e = read(spark, sf_dir, "embeddings")
    known = e.where("vec_id % 2 = 0").withColumn("slug", F.concat(F.lit("v"), "vec_id"))
    q = e.where("vec_id % 2 = 1").withColumn("said", F.when(F.col("vec_id") % 3 == 0, F.concat(F.lit("v"), F.col("vec_id") - 1)).otherwise("?"))
    met = q.join(known.select(F.col("slug").alias("said"), F.col("vec_id").alias("hit")), "said", "left").select("vec_id", "hit", "embedding")
    near = identity.nearest(met.where("hit is null"), known, "vec_id", "embedding").where("similarity >= 0.4").select("vec_id", F.col("nearest_id").alias("near"))
    how = F.when(F.col("hit").isNotNull(), "exact").when(F.col("near").isNotNull(), "near").otherwise("none")
    return met.drop("embedding").join(near, "vec_id", "left").select("vec_id", F.coalesce("hit", "near").alias("found"), how.alias("how"))


@query("""
with g as (select distinct l_orderkey from lineitem where l_returnflag = 'R')
select o_orderkey, g.l_orderkey is not null as has_result from orders left join g on g.l_orderkey = o_orderkey where o_orderstatus <> 'P'
""")
def truth_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with at least one result, and those without."""
    g = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(True).alias("has")).distinct()
    return read(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select("o_orderkey").join(g, "o_orderkey", "left").select("o_orderkey", F.coalesce("has", F.lit(False)).alias("has_result"))


@query("""
with p as (select conv_id, turn, length(text) as value from conversations), t as (select conv_id, turn, 'heat {step' || (turn - 1) || '.value} to {step' || (turn + 2) || '.value}' as command from conversations where turn > 0)
select t.conv_id, t.turn, 'heat ' || coalesce(a.value::varchar, '{step' || (t.turn - 1) || '.value}') || ' to {step' || (t.turn + 2) || '.value}' as command, 1 + (a.value is null)::bigint as unresolved from t left join p a on a.conv_id = t.conv_id and a.turn = t.turn - 1
""")
def step_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands name outputs of steps; those of earlier steps are filled in, others stay and are counted."""
    c = read(spark, sf_dir, "conversations")
    command = F.concat(F.lit("heat {step"), F.col("turn") - 1, F.lit(".value} to {step"), F.col("turn") + 2, F.lit(".value}"))
    return identity.filled_in(c.where("turn > 0").select("conv_id", "turn", command.alias("command")), c.select("conv_id", "turn", F.char_length("text").cast("string").alias("value")), "conv_id", "turn", "command", "value")


@query("""
select p_partkey, p_name, coalesce(string_agg(distinct s_name, ',' order by s_name), '') as parents, count(distinct l_suppkey) as n_parents from part left join lineitem on l_partkey = p_partkey left join supplier on s_suppkey = l_suppkey where p_size < 8 group by 1, 2
""")
def items_with_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, s = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "supplier")
    up = l.select("l_partkey", "l_suppkey").distinct().join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.array_join(F.sort_array(F.collect_set("s_name")), ",").alias("parents"), F.countDistinct("l_suppkey").alias("n_parents"))
    return read(spark, sf_dir, "part").where("p_size < 8").select("p_partkey", "p_name").join(up, "p_partkey", "left").select("p_partkey", "p_name", F.coalesce("parents", F.lit("")).alias("parents"), F.coalesce("n_parents", F.lit(0)).cast("long").alias("n_parents"))


@query("""
with e as (select distinct p_partkey, p_brand || ':' || p_type as parent from part)
select a.p_partkey, string_agg(b.p_partkey::varchar, ',' order by b.p_partkey) filter (where b.p_partkey <> a.p_partkey) as siblings from e a join e b using (parent) group by 1
""")
def substitutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item's siblings: written once for each parent, and each child's own id cut out; of the few items of several parents, the siblings of all are gathered."""
    e = read(spark, sf_dir, "part").select("p_partkey", F.concat("p_brand", F.lit(":"), "p_type").alias("parent")).where("parent is not null").distinct()
    ids = F.transform(F.sort_array(F.collect_list("p_partkey")), lambda x: x.cast("string"))
    lists = e.groupBy("parent").agg(F.concat(F.lit(","), F.array_join(ids, ","), F.lit(",")).alias("all"))
    of = e.groupBy("p_partkey").agg(F.collect_list("parent").alias("parents"))
    own = F.concat(F.lit(","), F.col("p_partkey").cast("string"), F.lit(","))
    others = F.btrim(F.replace("all", own, F.lit(",")), F.lit(","))
    one = of.where(F.size("parents") == 1).select("p_partkey", F.col("parents")[0].alias("parent")).join(lists, "parent").select("p_partkey", F.nullif(others, F.lit("")).alias("siblings"))
    several = of.where(F.size("parents") > 1).select("p_partkey", F.explode("parents").alias("parent"))
    met = several.join(e.select("parent", F.col("p_partkey").alias("other")), "parent").groupBy("p_partkey").agg(F.sort_array(F.collect_list(F.when(F.col("other") != F.col("p_partkey"), F.col("other")))).alias("all"))
    gathered = F.array_join(F.transform("all", lambda x: x.cast("string")), ",")
    return one.unionByName(met.select("p_partkey", F.nullif(gathered, F.lit("")).alias("siblings")))


@query("""
select user_id, phenomenon, string_agg(distinct tool, ',' order by tool) as tools, count(*) as n_steps from (select user_id, event_id, case when event_type = 'view' and value >= 50 then 'browning' when event_type = 'click' and value <= 80 then 'drying' end as phenomenon, ['oven', 'pan', 'pot'][event_id % 4 + 1] as tool from events) where phenomenon is not null group by 1, 2
""")
def step_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What steps trigger, and the tools of what is triggered; a step may have none."""
    kind, v = F.col("event_type"), F.col("value")
    phn = ops.first_rule([((kind == "view") & (v >= 50), "browning"), ((kind == "click") & (v <= 80), "drying")])
    tool = F.get(F.array(F.lit("oven"), F.lit("pan"), F.lit("pot")), (F.col("event_id") % 4).cast("int"))
    g = read(spark, sf_dir, "events").select("user_id", phn.alias("phenomenon"), tool.alias("tool")).where("phenomenon is not null").groupBy("user_id", "phenomenon")
    return g.agg(F.nullif(F.array_join(F.sort_array(F.collect_set("tool")), ","), F.lit("")).alias("tools"), F.count("*").alias("n_steps"))


@query("""
with s as (select o_custkey, count(distinct o_orderkey) as steps, count(distinct l_partkey) as items, count(distinct l_suppkey) as tools from orders join lineitem on l_orderkey = o_orderkey group by 1)
select c_custkey, c_name, steps, items, tools from customer join s on o_custkey = c_custkey where steps >= 3 and items >= 5 and tools >= 2
""")
def full_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipes that have all parts of the chain."""
    o, l = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    each = l.select("l_orderkey", "l_partkey", "l_suppkey").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    s = each.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.size(F.collect_set("o_orderkey")).alias("steps"), F.size(F.collect_set("l_partkey")).alias("items"), F.size(F.collect_set("l_suppkey")).alias("tools"))
    return read(spark, sf_dir, "customer").select("c_custkey", "c_name").join(s.where("steps >= 3 and items >= 5 and tools >= 2"), "c_custkey").select("c_custkey", "c_name", *[F.col(c).cast("long").alias(c) for c in ("steps", "items", "tools")])


@query("select p_partkey, p_name from part where contains(lower(p_name), 'giz') order by p_name, p_partkey limit 2")
def recipe_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").where(F.contains(F.lower("p_name"), F.lit("giz"))).select("p_partkey", "p_name").orderBy("p_name", "p_partkey").limit(2)


@query("""
with c as (select 'orphan customers' as check_, count(*) as n, 0.4 as bound, (select count(*) from customer) as total from customer where c_custkey not in (select o_custkey from orders) union all select 'broken lines', count(*), 0, (select count(*) from lineitem) from lineitem where l_orderkey not in (select o_orderkey from orders)
union all select 'duplicate names', count(*), 0.01, (select count(*) from supplier) from (select s_name from supplier group by 1 having count(*) > 1) union all select 'null languages', count(*), 0.05, (select count(*) from documents) from documents where lang is null
union all select 'enum', count(*), 0, (select count(*) from orders) from orders where o_orderstatus not in ('F', 'O', 'P') union all select 'range', count(*), 0.001, (select count(*) from lineitem) from lineitem where l_quantity not between 1 and 50 union all select 'self loops', count(*), 0, (select count(*) from events) from events where event_id = user_id and event_id > 5)
select check_, n, case when n = 0 then 'PASS' when n <= bound * total then 'WARN' else 'FAIL' end as status from c
""")
def quality_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven checks; what is within its bound is a warning."""
    t = {n: read(spark, sf_dir, n) for n in ("customer", "orders", "lineitem", "supplier", "documents", "events")}
    checks = {
        "orphan customers": (t["customer"].join(t["orders"], F.col("c_custkey") == F.col("o_custkey"), "left_anti"), 0.4, "customer"), "broken lines": (t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "left_anti"), 0.0, "lineitem"),
        "duplicate names": (t["supplier"].groupBy("s_name").count().where("count > 1"), 0.01, "supplier"), "null languages": (t["documents"].where("lang is null"), 0.05, "documents"), "enum": (t["orders"].where("o_orderstatus not in ('F', 'O', 'P')"), 0.0, "orders"),
        "range": (t["lineitem"].where("l_quantity not between 1 and 50"), 0.001, "lineitem"), "self loops": (t["events"].where("event_id = user_id and event_id > 5"), 0.0, "events"),
    }
    return ops.audited([(name, bad, bound, t[of]) for name, (bad, bound, of) in checks.items()])


@query("""
with a as (select user_id as k, event_type, value, ts, event_id from events where event_id % 7 > 0), r as (select *, row_number() over (partition by k, event_type order by ts desc, event_id desc) as r, count(*) over (partition by k, event_type) as n from a where event_type in ('view', 'click'))
select k, event_type, value, n as acks from r where r = 1
""")
def ack_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid acknowledgements, one row for each key: a repeated one changes the row, and adds none."""
    a = read(spark, sf_dir, "events").where("event_id % 7 > 0 and event_type in ('view', 'click')").select(F.col("user_id").alias("k"), "event_type", "value", "ts", "event_id")
    g = a.groupBy("k", "event_type").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"), F.count("*").alias("acks"))
    return g.select("k", "event_type", "value", "acks")


@query("select user_id, event_type, count(*) as n, max(event_id) as last from events group by 1, 2")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same files with one checkpoint: the second takes up where the first ended, so no event counts twice."""
    return streams.run_twice(spark, f"{sf_dir}/events.parquet", lambda e: e.select("user_id", "event_type", "event_id")).groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))


@query(f"""
with h as (select p_partkey, p_size as s, 60.0 * p_size as t from part), w as (select *, 20 + 80 * (1 - exp(-t / 1800)) as core from h), k as (select *, 1e10 * exp(-70000 / ({physics.R} * (core + 273.15))) as rate from w), d as (select *, 1 - exp(-rate * t) as done from k)
select p_partkey, round(core, 6) as core, round(rate * 1e6, 6) as rate, round(done, 6) as done, round(1 / (1 + exp((core + 273.15 - 335) / ({physics.R} * 335 * 335 / 400000.0))), 6) as native, case when done > 0.5 then 'cooked' else 'raw' end as verdict from d
""")
def scenario_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formulas whose outputs feed the next: time to core temperature, to a rate, to what is done."""
    t = F.col("p_size") * 60.0
    h = read(spark, sf_dir, "part").select("p_partkey", t.alias("t"), (20 + 80 * (1 - F.exp(-t / 1800))).alias("core"))
    k = h.withColumn("rate", physics.evaluate("MF-T03", A=1e10, Ea=70000.0, T_K=F.col("core") + 273.15)).withColumn("done", 1 - F.exp(-F.col("rate") * F.col("t")))
    native = physics.evaluate("MF-T06", T_K=F.col("core") + 273.15, Td_K=335.0, dH=400000.0)
    return k.select("p_partkey", F.round("core", 6).alias("core"), F.round(F.col("rate") * 1e6, 6).alias("rate"), F.round("done", 6).alias("done"), F.round(native, 6).alias("native"), F.when(F.col("done") > 0.5, "cooked").otherwise("raw").alias("verdict"))


@query("select vec_id as query_id, near as vec_id, similarity, rank from (select q.vec_id, e.vec_id as near, e.label, round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 6) as similarity, row_number() over (partition by q.vec_id order by round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 6) desc, e.vec_id) as rank from embeddings q, embeddings e where q.vec_id % 100 = 0) where rank <= 50 and label <= 3")
def knn_post_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 nearest of each query vector first, and of those the wanted labels: there may be fewer than 50."""
    e = read(spark, sf_dir, "embeddings")
    near = identity.nearest_rows(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", 50, places=6).withColumnRenamed("vec_id", "query_id")
    wanted = e.where("label <= 3").select(F.col("vec_id").alias("nearest_id"))
    return near.join(wanted, "nearest_id").select("query_id", F.col("nearest_id").alias("vec_id"), "similarity", "rank")
