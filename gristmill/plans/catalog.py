"""All registered queries over the given tables, and the DuckDB SQL of each that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import physics, text as fn
from ..operators import graph, identity, tables as ops
from ..streaming import events as streams
from . import file_queries, formula_queries, graph_queries, identity_queries, ingredient_queries, lookup_queries, record_queries, search_queries, stat_queries, text_queries  # noqa: F401  (they register their queries)
from .registry import ORACLES, QUERIES, query, read  # noqa: F401

_DISTRIBUTION = """
select l_returnflag, l_linestatus, count(*) as n, count(distinct l_suppkey) as n_books, min(v) as min, {q5} as p5, {q25} as p25, {q50} as median, {q75} as p75, {q95} as p95, max(v) as max,
  round(avg(v), 6) as mean, round(case when count(*) > 1 then stddev_samp(v) else 0 end, 6) as stdev
from (select l_returnflag, l_linestatus, l_suppkey, l_quantity as v from lineitem{where}) group by 1, 2
"""
_Q = {f"q{q}": f"list_sort(list(v))[least(count(*) - 1, floor({q} * count(*) / 100))::int + 1]" for q in (5, 25, 50, 75, 95)}


@query(_DISTRIBUTION.format(where="", **_Q))
def value_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.distribution(read(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", "l_suppkey")


@query("""
with kept as (select * from lineitem where not (l_returnflag = 'R' and (l_quantity < 5 or l_quantity > 40))), d as (select l_returnflag, l_linestatus, count(*) as dropped from lineitem where l_returnflag = 'R' and (l_quantity < 5 or l_quantity > 40) group by 1, 2)
select x.*, coalesce(dropped, 0) as dropped_by_rule from (""" + _DISTRIBUTION.format(where="", **_Q).replace("from lineitem", "from kept") + ") x left join d using (l_returnflag, l_linestatus)")
def outlier_filter_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distribution after a rule has dropped values, and how many it dropped."""
    bounds, by = spark.createDataFrame([("R", 5.0, 40.0)], "l_returnflag string, low double, high double"), ["l_returnflag", "l_linestatus"]
    lines = read(spark, sf_dir, "lineitem")
    kept = ops.within_bounds(lines, bounds, ["l_returnflag"], "l_quantity")
    n = lines.groupBy(*by).agg(F.count("l_quantity").alias("_all"))
    return ops.distribution(kept, by, "l_quantity", "l_suppkey").join(n, by).withColumn("dropped_by_rule", F.col("_all") - F.col("n")).drop("_all")


_RULES = ((1, "view", 50.0, None, "browning"), (2, "click", None, 80.0, "drying"), (3, "purchase", 20.0, 90.0, "freezing"), (4, "view", 90.0, None, "browning"), (5, "click", 10.0, None, "browning"))


@query("""
with r(rule, action, low, high, phenomenon) as (values (1, 'view', 50.0, null, 'browning'), (2, 'click', null, 80.0, 'drying'), (3, 'purchase', 20.0, 90.0, 'freezing'), (4, 'view', 90.0, null, 'browning'), (5, 'click', 10.0, null, 'browning'))
select user_id, phenomenon, count(*) as n, string_agg(distinct cast(rule as varchar), '+' order by cast(rule as varchar)) as rules, max(value) as most
from events join r on event_type = action and (low is null or value >= low) and (high is null or value <= high) group by 1, 2
""")
def step_rule_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(_RULES, "rule int, action string, low double, high double, phenomenon string")
    e = read(spark, sf_dir, "events")
    met = e.join(ops.small(rules), (e.event_type == rules.action) & (rules.low.isNull() | (e.value >= rules.low)) & (rules.high.isNull() | (e.value <= rules.high)))
    return met.groupBy("user_id", "phenomenon").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set(F.col("rule").cast("string"))), "+").alias("rules"), F.max("value").alias("most"))


@query("""
with b as (select p_brand as key, min(p_partkey) as id from part group by 1), t as (select p_type as key, min(p_partkey) as id from part group by 1),
w as (select *, split_part(p_name, ' ', 1) as k0, p_type as k1 from part)
select p_partkey, coalesce(b.id, t.id) as id, case when b.id is not null then 1.0 when t.id is not null then 0.75 end as confidence,
  case when b.id is not null then 'brand' when t.id is not null then 'type' end as method
from w left join b on w.k0 = b.key left join t on w.k1 = t.key
""")
def cascade_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    index = lambda c: p.select(F.col(c).alias("key"), F.col("p_partkey").alias("id"))
    return ops.cascade(p, [(F.split("p_name", " ")[0], index("p_brand"), 1.0), (F.col("p_type"), index("p_type"), 0.75)], ["brand", "type"]).select("p_partkey", "id", "confidence", "method")


@query("""
with k as (select c_custkey as id, 'segment' as name, c_mktsegment || ':' || c_nationkey as value from customer union all select c_custkey, 'balance', cast(cast(floor(c_acctbal) as bigint) as varchar) from customer)
select name, value, count(distinct id) as n_ids, min(id) as least_id from k where value is not null and value <> '' group by 1, 2 having count(distinct id) > 1
""")
def identity_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select("c_custkey", F.concat_ws(":", "c_mktsegment", "c_nationkey").alias("segment"), F.floor("c_acctbal").alias("balance"))
    return ops.conflicts(c, "c_custkey", ["segment", "balance"])


@query("""
with c(start_, end_, name, ord) as (values (1, 900, 'roots', 1), (800, 5000, 'leaves', 2), (6000, 12000, 'seeds', 3), (10000, 14000, 'oils', 4))
select chapter, count(*) as n_orders, min(o_orderkey) as first_order
from (select o_orderkey, (select name from c where o_orderkey between start_ and end_ order by ord desc limit 1) as chapter from orders) group by 1
""")
def page_chapter_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    chapters = spark.createDataFrame([(1, 900, "roots", 1), (800, 5000, "leaves", 2), (6000, 12000, "seeds", 3), (10000, 14000, "oils", 4)], "start long, end long, name string, ord int")
    found = ops.in_interval(read(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", chapters)
    return found.groupBy(F.col("name").alias("chapter")).agg(F.count("*").alias("n_orders"), F.min("o_orderkey").alias("first_order"))


@query("""
select n_name as nation, count(distinct o_orderkey) as n_orders, count(distinct l_partkey) as n_parts, count(distinct p_type) as n_types
from region join nation on n_regionkey = r_regionkey join customer on c_nationkey = n_nationkey join orders on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey
where r_name <> 'EUROPE' group by 1 having count(distinct o_orderkey) >= 5
""")
def path_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part's nations are the bits of whole numbers, so what a task keeps is a row for each part and not for each nation and part; types come to the parts after that."""
    t = {n: read(spark, sf_dir, n) for n in ("region", "nation", "customer", "orders", "lineitem", "part")}
    named = t["nation"].join(t["region"].where("r_name <> 'EUROPE'"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("nation"))
    numbered = named.withColumn("no", F.dense_rank().over(Window.orderBy("nation")) - 1)  # a row for each nation
    nations = numbered.select("n_nationkey", "nation", F.expr("no div 64").alias("word"), F.expr("shiftleft(1L, cast(no % 64 as int))").alias("bit"))
    path = (
        t["orders"].select("o_orderkey", "o_custkey").join(t["customer"].select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "word", "bit")
    )
    lines, parts = t["lineitem"].select("l_orderkey", "l_partkey"), t["part"].select("p_partkey", "p_type")
    tasks = ops.tasks_for(lines)
    path = path.repartition(tasks, "o_orderkey")
    held = lines.repartition(tasks, "l_orderkey").join(path, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_partkey", "word").agg(F.bit_or("bit").alias("bits"))
    names = F.broadcast(nations.select("nation", "word", "bit").distinct())
    each = held.join(parts.distinct(), F.col("l_partkey") == F.col("p_partkey")).join(names, "word").where("bits & bit <> 0")
    types = each.groupBy("nation", "p_type").agg(F.count("*").alias("n_parts")).groupBy("nation").agg(F.sum("n_parts").alias("n_parts"), F.count("*").alias("n_types"))
    known = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi").select("l_orderkey").repartition(tasks, "l_orderkey")
    orders = path.join(known, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").distinct().join(names, ["word", "bit"]).groupBy(F.col("nation").alias("_nation")).agg(F.count("*").alias("n_orders"))
    return orders.where("n_orders >= 5").join(types, F.col("_nation").eqNullSafe(F.col("nation"))).select("nation", "n_orders", "n_parts", "n_types")


@query("""
select a.p_brand as brand_a, b.p_brand as brand_b, count(distinct l1.l_orderkey) as n_orders
from lineitem l1 join part a on a.p_partkey = l1.l_partkey join lineitem l2 on l1.l_orderkey = l2.l_orderkey join part b on b.p_partkey = l2.l_partkey
where a.p_brand < b.p_brand group by 1, 2 having count(distinct l1.l_orderkey) >= 5 order by n_orders desc, brand_a, brand_b limit 15
""")
def path_topk_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, p = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part")
    brands = l.join(p, l.l_partkey == p.p_partkey).select("l_orderkey", "p_brand").distinct()
    pairs = brands.alias("a").join(brands.alias("b"), "l_orderkey").where("a.p_brand < b.p_brand").select(F.col("a.p_brand").alias("brand_a"), F.col("b.p_brand").alias("brand_b"))
    return pairs.groupBy("brand_a", "brand_b").agg(F.count("*").alias("n_orders")).where("n_orders >= 5").orderBy(F.desc("n_orders"), "brand_a", "brand_b").limit(15)


@query("""
select c_custkey, count(o_orderkey) as n_orders, max(case when o_orderstatus = 'F' then o_totalprice end) as top_final
from customer left join orders on o_custkey = c_custkey and o_totalprice > 1000 group by 1
""")
def optional_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = read(spark, sf_dir, "customer").select("c_custkey"), read(spark, sf_dir, "orders").where("o_totalprice > 1000")
    return c.join(o, c.c_custkey == o.o_custkey, "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_orders"), F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("top_final"))


@query("select s_suppkey as src, (select count(*) from supplier b where b.s_nationkey = a.s_nationkey and b.s_suppkey <> a.s_suppkey) as n_siblings from supplier a")
def siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.siblings(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("src"), F.col("s_nationkey").cast("long").alias("dst")))


@query("select c_custkey as id from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that no pending order leads to."""
    edges = read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("src"), F.col("o_custkey").alias("dst"))
    return graph.orphans(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), edges)


@query("""
select 'lineitem-orders' as edge, count(*) as n, count(*) filter (where o_orderkey is null) as broken from lineitem left join orders on o_orderkey = l_orderkey
union all select 'labels-documents', count(*), count(*) filter (where d.doc_id is null) from labels l left join documents d on d.doc_id = l.doc_id
""")
def referential_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    def held(name: str, child: DataFrame, key: str, parent: DataFrame, id: str) -> DataFrame:
        known = parent.select(F.col(id).alias("_k")).distinct()
        return child.join(known, child[key] == F.col("_k"), "left").agg(F.count("*").alias("n"), F.count_if(F.col("_k").isNull()).alias("broken")).select(F.lit(name).alias("edge"), "n", "broken")

    return held("lineitem-orders", read(spark, sf_dir, "lineitem"), "l_orderkey", read(spark, sf_dir, "orders"), "o_orderkey").unionByName(held("labels-documents", read(spark, sf_dir, "labels"), "doc_id", read(spark, sf_dir, "documents"), "doc_id"))


@query("""
select 'text' as field, count(*) as n, sum(case when text is null or text = '' then 1 else 0 end)::bigint as n_null, round(avg(case when text is null or text = '' then 1 else 0 end), 6) as rate from documents
union all select 'lang', count(*), sum(case when lang is null or lang = '' then 1 else 0 end)::bigint, round(avg(case when lang is null or lang = '' then 1 else 0 end), 6) from documents
union all select 'source', count(*), sum(case when source is null or source = '' then 1 else 0 end)::bigint, round(avg(case when source is null or source = '' then 1 else 0 end), 6) from documents
""")
def null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.null_rates(read(spark, sf_dir, "documents"), ["text", "lang", "source"])


@query("select node, count(*) as degree from (select l_partkey as node from lineitem union all select l_suppkey + 10000000 from lineitem) group by 1")
def node_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.degrees(read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src"), (F.col("l_suppkey") + 10000000).alias("dst")))


@query("select text, doc_id, source, lang from (select *, row_number() over (partition by text order by source nulls first, doc_id, lang) as k from documents) where k = 1")
def source_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts the first by source and id. Texts meet by their digest; of those that are equal in a task, one is moved."""
    d = read(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("_h")).agg(F.first("text").alias("text"), F.min(F.struct("source", "doc_id", "lang")).alias("x"))
    return d.select("text", "x.doc_id", "x.source", "x.lang")


@query("""
select word, sum(c)::bigint as n, round(sum(c * case when source = 'src1' then 1.5 else 1.0 end), 6) as weighted, count(distinct source) as n_sources
from (select source, word, count(*) as c from (select source, unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from documents) group by 1, 2) group by 1
""")
def weighted_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = read(spark, sf_dir, "documents").select("source", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).groupBy("source", "word").agg(F.count("*").alias("c"))
    weight = F.when(F.col("source") == "src1", 1.5).otherwise(1.0)
    return words.groupBy("word").agg(F.sum("c").alias("n"), F.round(F.sum(F.col("c") * weight), 6).alias("weighted"), F.countDistinct("source").alias("n_sources"))


@query("""
with m as (select d.source, not regexp_matches(text, '[#$%&*!]{2,}') as p, quality = 1 as a from documents d join labels l using (doc_id)),
c as (select source, count(*) filter (where p and a) as tp, count(*) filter (where p and not a) as fp, count(*) filter (where not p and a) as fn, count(*) filter (where not p and not a) as tn from m group by 1)
select *, round(case when tp + fp > 0 then tp / (tp + fp) else 0 end, 3) as precision_, round(case when tp + fn > 0 then tp / (tp + fn) else 0 end, 3) as recall from c
""")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id").select("source", (~F.col("text").rlike(r"[#$%&*!]{2,}")).alias("p"), (F.col("quality") == 1).alias("a"))
    c = m.groupBy("source").agg(F.count_if(F.col("p") & F.col("a")).alias("tp"), F.count_if(F.col("p") & ~F.col("a")).alias("fp"), F.count_if(~F.col("p") & F.col("a")).alias("fn"), F.count_if(~F.col("p") & ~F.col("a")).alias("tn"))
    share = lambda a, b: F.round(F.when(F.col(a) + F.col(b) > 0, F.col(a) / (F.col(a) + F.col(b))).otherwise(0.0), 3)
    return c.withColumns({"precision_": share("tp", "fp"), "recall": share("tp", "fn")})


@query(r"""
select doc_id, case when regexp_matches(text, '(?m)^\S+( \| \S+)+') then 'table' when regexp_matches(text, '[A-Z]{3,}!! ') then 'shouting' when regexp_matches(text, '[#$%&*]{3}') then 'symbols' when length(text) < 100 then 'short' else 'clean' end as bucket from documents
""")
def triage_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    rules = [(t.rlike(r"(?m)^\S+( \| \S+)+"), "table"), (t.rlike(r"[A-Z]{3,}!! "), "shouting"), (t.rlike(r"[#$%&*]{3}"), "symbols"), (F.char_length(t) < 100, "short")]
    return read(spark, sf_dir, "documents").select("doc_id", ops.first_rule(rules, "clean").alias("bucket"))


@query("select event_type, count(*) as n, sum(cast(json_extract(props, '$.k') as bigint))::bigint as k_sum, min(cast(json_extract(props, '$.k') as bigint)) as k_min from events group by 1")
def json_extract_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k long")["k"])
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("k_sum"), F.min("k").alias("k_min"))


@query(r"""
select page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
  '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[ \t\n\r\f\v]+', ' ', 'g')) as plain from pages
""")
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", fn.plain_text(F.col("html")).alias("plain"))


@query("""
with c as (select label, i, avg(x) as m from (select label, unnest(embedding)::double as x, unnest(range(1, len(embedding) + 1)) as i from embeddings) group by 1, 2),
a as (select label as anchor, list(m order by i) as v from c group by 1),
s as (select vec_id, anchor, list_cosine_similarity(embedding::double[], v) as s from embeddings, a)
select vec_id, anchor, round(s, 6) as similarity, rank from (select *, row_number() over (partition by vec_id order by round(s, 6) desc, anchor) as rank from s) where rank <= 3
""")
def anchor_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings")
    means = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    anchors = means.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda p: p["m"]).alias("v"))
    best = identity.nearest_of(e.select("vec_id", "embedding"), anchors, "vec_id", "embedding", "label", "v", 3)
    return best.select("vec_id", F.col("known").alias("anchor"), "similarity", "rank")


@query("""
with k as (select *, lower(trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g'))) as k from documents where text is not null)
select min(doc_id) as doc_id, count(*) as n, left(string_agg(distinct source, ',' order by source), 500) as sources, max(length(text)) as longest, arg_min(lang, (-length(text), doc_id)) as lang_of_longest, sha256(k) as key from k group by k
""")
def glossary_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of one term (the whole text, without case and white space) are merged: all sources, and what the longest one says, the first of equally long ones."""
    key = F.sha2(F.lower(F.trim(F.regexp_replace("text", r"[ \t\n\r]+", " "))), 256)
    n = F.char_length("text").cast("long")
    d = read(spark, sf_dir, "documents").where("text is not null").groupBy(key.alias("key"))
    out = d.agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources"), F.max(n).alias("longest"), F.min_by("lang", F.struct(-n, "doc_id")).alias("lang_of_longest"))
    return out.withColumn("sources", F.substring("sources", 1, 500))


@query("""
select unit, count(*) as n, round(sum(case unit when 'kg' then q when 'g' then q * 1e-3 when 'lb' then q * 0.45359237 when 'C' then q + 273.15 end), 4) as total, count(*) filter (where unit = 'cup') as unknown
from (select l_quantity as q, ['cup', 'kg', 'g', 'lb', 'C', 'cup', 'kg'][l_linenumber] as unit from lineitem) group by 1
""")
def normalize_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("q"), F.get(F.array(*map(F.lit, ["cup", "kg", "g", "lb", "C", "cup", "kg"])), F.col("l_linenumber") - 1).alias("unit"))
    return l.groupBy("unit").agg(F.count("*").alias("n"), F.round(F.sum(fn.si_value(F.col("q"), F.col("unit"))), 4).alias("total"), F.count_if(F.col("unit") == "cup").alias("unknown"))


@query("""
select l_returnflag, round(avg(5e9 * exp(-60000 / (8.314462618 * (l_quantity + 273.15)))), 6) as arrhenius, round(avg(l_discount * 100 / (l_discount * 100 + l_quantity)), 6) as michaelis, round(avg(4.76 + log10((l_tax + 0.01) / (l_discount + 0.01))), 6) as ph,
  round(avg(pow(10, -17.44 * (l_quantity - 20) / (51.6 + l_quantity - 20))), 6) as wlf, round(avg(2.5 + 1.2 * pow(l_quantity, 0.6)), 6) as herschel, round(avg(pow(10, (l_quantity + 71.1) / 10 - 10) * 60 / 60), 6) as f_value
from lineitem group by 1
""")
def physics_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, d, t = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    e = lambda name, **k: F.round(F.avg(physics.evaluate(name, **k)), 6)
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        e("MF-T03", A=5e9, Ea=60000.0, T_K=q + 273.15).alias("arrhenius"), e("MF-K01", Vmax=1.0, S=d * 100, Km=q).alias("michaelis"), e("MF-M04", pKa=4.76, acid=d + 0.01, base=t + 0.01).alias("ph"),
        e("MF-R05", T=q, Tg=20.0).alias("wlf"), e("MF-R02", tau0=2.5, K=1.2, rate=q, n=0.6).alias("herschel"), e("MF-K04", T=q + 71.1, Tref=100.0, z=10.0, seconds=60.0).alias("f_value"),
    )


@query("""
select conv_id, turn, role, printf('%d_r%04d', conv_id, row_number() over (partition by conv_id order by turn)) as seq_id from conversations
""")
def sequential_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = ops.numbered(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id"], ["turn"], "seq")
    return turns.select("conv_id", "turn", "role", F.format_string("%d_r%04d", "conv_id", "seq").alias("seq_id"))


@query("select * from (select o_custkey, o_orderkey, o_totalprice, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rank from orders) where rank <= 10")
def keep_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.top_n(read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 10).drop("o_orderdate")


@query("""
with e as (select user_id, event_type, ts, value, try_cast(value as decimal(28, 10)) as exact from events),
s as (select user_id, event_type, count(*) as calls, sum(exact) as cost, sum(value) filter (where exact is null) as other, sum(exact) filter (where ts >= timestamp '2024-01-24') as last_week, sum(value) filter (where exact is null and ts >= timestamp '2024-01-24') as last_other from e group by 1, 2)
select user_id, event_type, calls, coalesce(round(cost, 4)::double + other, round(cost, 4)::double, other) as cost, coalesce(round(last_week, 4)::double + last_other, round(last_week, 4)::double, last_other) as last_week, coalesce(cost::double + other > 500, cost > 500, other > 500) as over_budget from s
""")
def cost_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs are summed as decimals, so neither a rounding nor the bound depends on the order of the rows; what is no decimal (NaN, infinite, too large) is added as it is."""
    recent = F.col("ts") >= F.lit("2024-01-24").cast("timestamp_ntz")
    e = read(spark, sf_dir, "events").withColumn("exact", F.col("value").try_cast("decimal(28,10)"))
    other = F.when(F.col("exact").isNull(), F.col("value"))
    s = e.groupBy("user_id", "event_type").agg(F.count("*").alias("calls"), F.sum("exact").alias("cost"), F.sum(other).alias("other"), F.sum(F.when(recent, F.col("exact"))).alias("week"), F.sum(F.when(recent, other)).alias("week_other"))
    total = lambda c, o: F.coalesce(F.round(c, 4).cast("double") + F.col(o), F.round(c, 4).cast("double"), o)
    over = F.coalesce(F.col("cost").cast("double") + F.col("other") > 500, F.col("cost") > 500, F.col("other") > 500)
    return s.select("user_id", "event_type", "calls", total("cost", "other").alias("cost"), total("week", "week_other").alias("last_week"), over.alias("over_budget"))


@query("""
select l_returnflag, l_linestatus, count(*) as n, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, grouping(l_returnflag, l_linestatus) as level from lineitem group by rollup (l_returnflag, l_linestatus)
""")
def rollup_qc(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return read(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum(revenue), 2).alias("revenue"), F.grouping_id().alias("level"))


@query("select time_bucket(interval 1 hour, ts) as hour, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.run_once(spark, f"{sf_dir}/events.parquet", lambda e: e.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "event_type", "n", "total"), "complete")


@query("""
with g as (select user_id, ts, case when ts - lag(ts) over w > interval 30 minute or lag(ts) over w is null then 1 else 0 end as new from events window w as (partition by user_id order by ts)),
s as (select user_id, ts, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from g)
select user_id, min(ts) as first_event, count(*) as n from s group by user_id, k
""")
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user with no gap of more than 30 minutes between them; a user may have most of the events."""
    e = ops.lagged(read(spark, sf_dir, "events").select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"], "ts", "last", keep_ranges=True)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    marked = e.withColumn("new", F.when(F.col("last").isNull() | (micros("ts") - micros("last") > 1_800_000_000), 1).otherwise(0).cast("long"))
    return ops.running(marked, ["user_id"], ["ts", "event_id"], "new", "k").groupBy("user_id", "k").agg(F.min("ts").alias("first_event"), F.count("*").alias("n")).drop("k")


FLAGSHIP = path_distinct_counts
