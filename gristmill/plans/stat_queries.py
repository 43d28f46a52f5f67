"""Queries that count and rank: ontology and routing statistics, coverage, scores, frequencies, gates, slots, samples and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import identity, records, tables as ops
from .registry import query, read


@query("""
with m as (select p_partkey, p_type as original, p_brand, p_size as occurrences, case when p_retailprice >= 950 then p_brand end as best, p_size % 6 = 0 as candidate from part),
f as (select original, best, sum(occurrences)::bigint as n from m where best is not null group by 1, 2 order by n desc, 1, 2 limit 20)
select 'outcome' as part, case when best is not null then 'mapped' when candidate then 'candidate' else 'none' end as name, sum(occurrences)::bigint as n, count(*) as items from m group by 2
union all select 'flow', original || '>' || best, n, 1 from f union all select 'group', original, sum(occurrences)::bigint, count(*) from m where candidate and best is null group by 2
""")
def ontology_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by outcome, the 20 widest flows from an old name to the best one, and the groups of candidates."""
    m = read(spark, sf_dir, "part").select(F.col("p_type").alias("original"), F.col("p_size").cast("long").alias("n"), F.when(F.col("p_retailprice") >= 950, F.col("p_brand")).alias("best"), (F.col("p_size") % 6 == 0).alias("candidate"))
    said = ops.first_rule([(F.col("best").isNotNull(), "mapped"), (F.col("candidate"), "candidate")], "none")
    of = lambda df, part, name: df.groupBy(name.alias("name")).agg(F.sum("n").alias("n"), F.count("*").alias("items")).select(F.lit(part).alias("part"), "name", "n", "items")
    flows = m.where("best is not null").groupBy("original", "best").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "original", "best").limit(20)
    return of(m, "outcome", said).unionByName(flows.select(F.lit("flow").alias("part"), F.concat_ws(">", "original", "best").alias("name"), "n", F.lit(1).cast("long").alias("items"))).unionByName(of(m.where("candidate and best is null"), "group", F.col("original")))


@query("select lower(p_name) as item, count(*) as freq, string_agg(distinct p_brand, ',' order by p_brand) as books, count(*) filter (where p_type = 'PROMO') as promo, count(*) filter (where p_type = 'LARGE') as large, arg_min(p_partkey, p_partkey) as first_id from part group by 1")
def seed_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a seed occurs, in which books, in which categories, and its first id."""
    g = read(spark, sf_dir, "part").groupBy(F.lower("p_name").alias("item"))
    return g.agg(F.count("*").alias("freq"), F.array_join(F.sort_array(F.collect_set("p_brand")), ",").alias("books"), F.count_if(F.col("p_type") == "PROMO").alias("promo"), F.count_if(F.col("p_type") == "LARGE").alias("large"), F.min("p_partkey").alias("first_id"))


_PHN = ("browning", "drying", "freezing", "rising", "setting")


@query("""
with t as (select event_id, user_id, unnest(list_filter([case when value > 60 then 'browning' end, case when value < 20 then 'drying' end, case when event_type = 'purchase' and value > 40 then 'freezing' end], lambda x: x is not null)) as phn from events),
a as (select unnest(['browning', 'drying', 'freezing', 'rising', 'setting']) as phn)
select a.phn, count(event_id) as n, count(distinct user_id) as n_users, count(event_id) < 5 as low, 0.5 as score, round(100.0 * any_value(c.covered) / any_value(c.n), 2) as coverage_pct
from a left join t using (phn), (select count(*) as n, count(*) filter (where value > 60 or value < 20 or (event_type = 'purchase' and value > 40)) as covered from events) c group by 1
""")
def routing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for each phenomenon, those without any included, and what share of the rows has one at all."""
    v, kind = F.col("value"), F.col("event_type")
    tags = F.array_compact(F.array(F.when(v > 60, "browning"), F.when(v < 20, "drying"), F.when((kind == "purchase") & (v > 40), "freezing")))
    e = read(spark, sf_dir, "events").select("event_id", "user_id", tags.alias("tags"))
    counted = e.select("user_id", F.explode("tags").alias("phn")).groupBy("phn").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("n_users"))
    share = e.agg(F.round(100.0 * F.count_if(F.size("tags") > 0) / F.count("*"), 2).alias("coverage_pct"))  # one row
    every = spark.createDataFrame([(p,) for p in _PHN], "phn string")
    out = F.broadcast(every).join(counted, "phn", "left").join(F.broadcast(share), F.lit(True))
    n = F.coalesce("n", F.lit(0))
    return out.select("phn", n.cast("long").alias("n"), F.coalesce("n_users", F.lit(0)).cast("long").alias("n_users"), (n < 5).alias("low"), F.lit(0.5).alias("score"), "coverage_pct")


@query("""
with s as (select vec_id, label, list_cosine_similarity(embedding::double[], lag(embedding::double[]) over (order by vec_id)) as top from embeddings)
select label, count(*) as n, count(*) filter (where top >= 0.1) as matched, round(count(*) filter (where top >= 0.1) / count(*), 4) as match_rate, round(avg(top), 6) as mean_all, round(avg(top) filter (where top >= 0.1), 6) as mean_matched from s group by 1
""")
def match_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows match the one before them, how well, for each domain."""
    from ..functions.text import cosine

    e = ops.numbered(read(spark, sf_dir, "embeddings").withColumn("_all", F.lit(1)), ["_all"], ["vec_id"], "k").select("vec_id", "label", "embedding", "k")
    before = e.select((F.col("k") + 1).alias("k"), F.col("embedding").alias("last"))
    s = e.join(before, "k", "left").select("label", F.when(F.col("last").isNotNull(), cosine(F.col("embedding"), F.col("last"))).alias("top"))
    hit = F.col("top") >= 0.1
    return s.groupBy("label").agg(F.count("*").alias("n"), F.count_if(hit).alias("matched"), F.round(F.count_if(hit) / F.count("*"), 4).alias("match_rate"), F.round(F.avg("top"), 6).alias("mean_all"), F.round(F.avg(F.when(hit, F.col("top"))), 6).alias("mean_matched"))


@query("""
with m as (select user_id % 3 as model, value > 50 as p, event_type in ('view', 'purchase') as a, value from events), c as (select model, count(*) filter (where p and a) as tp, count(*) filter (where p and not a) as fp, count(*) filter (where not p and a) as fn, count(*) filter (where not p and not a) as tn, avg(value) as speed from m group by 1),
s as (select *, tp / (tp + fp) as pr, tp / (tp + fn) as re from c), t as (select *, 0.5 * re + 0.3 * (1 - fn / (tp + fn)) + 0.2 * least(1, 40 / speed) as score from s)
select model, tp, fp, fn, tn, round(pr, 3) as precision_, round(re, 3) as recall, round(2 * pr * re / (pr + re), 3) as f1, round(fn / (tp + fn), 3) as fn_rate, round(fp / (fp + tn), 3) as fp_rate, round(score, 6) as composite, rank() over (order by round(score, 6) desc, model) = 1 as winner from t
""")
def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion counts, precision, recall, F1, rates of both errors, and a composite that picks the winner."""
    p, a = F.col("value") > 50, F.col("event_type").isin("view", "purchase")
    c = read(spark, sf_dir, "events").groupBy((F.col("user_id") % 3).alias("model")).agg(F.count_if(p & a).alias("tp"), F.count_if(p & ~a).alias("fp"), F.count_if(~p & a).alias("fn"), F.count_if(~p & ~a).alias("tn"), F.avg("value").alias("speed"))
    share = lambda x, y: F.when(x + y > 0, x / (x + y)).otherwise(0.0)
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    s = c.withColumns({"_p": share(tp, fp), "_r": share(tp, fn)}).withColumn("_s", F.round(0.5 * F.col("_r") + 0.3 * (1 - share(fn, tp)) + 0.2 * F.least(F.lit(1.0), 40 / F.col("speed")), 6))
    best = s.agg(F.max_by("model", F.struct("_s", -F.col("model"))).alias("best"))  # one row
    f1 = F.when(F.col("_p") + F.col("_r") > 0, 2 * F.col("_p") * F.col("_r") / (F.col("_p") + F.col("_r"))).otherwise(0.0)
    return s.join(F.broadcast(best), F.lit(True)).select("model", "tp", "fp", "fn", "tn", F.round("_p", 3).alias("precision_"), F.round("_r", 3).alias("recall"), F.round(f1, 3).alias("f1"), F.round(share(fn, tp), 3).alias("fn_rate"), F.round(share(fp, tn), 3).alias("fp_rate"), F.col("_s").alias("composite"), (F.col("model") == F.col("best")).alias("winner"))


@query("""
with p as (select l_orderkey as k, list(distinct l_partkey % 12) as pred from lineitem group by 1), g as (select l_orderkey as k, list(distinct l_suppkey % 12) as gt, count(*) as n, count(*) filter (where l_quantity > 25) as sure from lineitem group by 1)
select k, len(list_intersect(pred, gt)) as overlap, round(len(list_intersect(pred, gt)) / len(gt), 4) as coverage, len(gt) - len(list_intersect(pred, gt)) as missed, len(pred) - len(list_intersect(pred, gt)) as extra, round(100.0 * sure / n, 2) as complete_pct, case when sure / n >= 0.8 then 'high' when sure / n >= 0.5 then 'medium' else 'low' end as confidence from p join g using (k)
""")
def formula_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was found of what is true, what is missed and what is too much, as set operations on small arrays."""
    g = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set(F.col("l_partkey") % 12).alias("pred"), F.collect_set(F.col("l_suppkey") % 12).alias("gt"), F.count("*").alias("n"), F.count_if(F.col("l_quantity") > 25).alias("sure"))
    both, share = F.size(F.array_intersect("pred", "gt")), F.col("sure") / F.col("n")
    return g.select("k", both.cast("long").alias("overlap"), F.round(both / F.size("gt"), 4).alias("coverage"), F.size(F.array_except("gt", "pred")).cast("long").alias("missed"), F.size(F.array_except("pred", "gt")).cast("long").alias("extra"), F.round(100.0 * F.col("sure") / F.col("n"), 2).alias("complete_pct"), F.when(share >= 0.8, "high").when(share >= 0.5, "medium").otherwise("low").alias("confidence"))


@query("""
with r as (select source, case n_chars % 4 when 0 then 0.9 when 1 then 0.25 when 2 then 0.5 end as precision_, n_chars % 4 = 3 as error, n_chars % 10 / 10 as faith from documents)
select source, count(*) as n, count(*) filter (where error) as errors, round(avg(precision_) filter (where not error), 6) as mean_precision, round(avg(faith) filter (where not error), 6) as mean_faith from r group by 1
""")
def answer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means over rows without error of scores that are read from a judge's words; no number in them counts as 0.5."""
    said = F.expr("case n_chars % 4 when 0 then 'Score: 0.9 of 1' when 1 then 'about .25' when 2 then 'cannot say' else 'timeout' end")
    score = F.coalesce(F.regexp_extract(said, r"(\d*\.\d+|\d+)", 1).try_cast("double"), F.lit(0.5))
    r = read(spark, sf_dir, "documents").select("source", score.alias("p"), (F.col("n_chars") % 4 == 3).alias("error"), (F.col("n_chars") % 10 / 10).alias("faith"))
    ok = ~F.col("error")
    return r.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("error")).alias("errors"), F.round(F.avg(F.when(ok, F.col("p"))), 6).alias("mean_precision"), F.round(F.avg(F.when(ok, F.col("faith"))), 6).alias("mean_faith"))


@query("""
with m as (select conv_id, turn, len(string_split(text, ' ')) as tokens from conversations), w as (select *, sum(tokens) over (partition by conv_id order by turn desc rows unbounded preceding) as used from m)
select conv_id, sum(tokens)::bigint as tokens, count(*) as n, min(turn) filter (where used <= 150) as oldest_visible, string_agg(case when used <= 150 then turn::varchar end, ',' order by turn) as visible from w group by 1
""")
def visible_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation's tokens, and the newest messages that fit 150 of them, in their order."""
    m = read(spark, sf_dir, "conversations").select("conv_id", "turn", (-F.col("turn")).alias("newest"), F.size(F.split("text", " ")).cast("long").alias("tokens"))
    seen = F.when(F.col("used") <= 150, F.col("turn"))
    w = ops.running(m, ["conv_id"], ["newest"], "tokens", "used")
    turns = F.array_join(F.transform(F.sort_array(F.collect_list(seen)), lambda t: t.cast("string")), ",")
    return w.groupBy("conv_id").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"), F.min(seen).alias("oldest_visible"), F.nullif(turns, F.lit("")).alias("visible"))


@query("""
select user_id, event_type, count(*) as n, count(*) > 30 as super from events group by 1, 2 having count(*) > 12
""")
def super_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes with many ends of edges; those with very many are flagged."""
    return read(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n")).where("n > 12").withColumn("super", F.col("n") > 30)


@query("""
select distinct phn, mf from (select case when event_type = 'view' and value >= 50 then 'browning' when event_type = 'click' and value <= 80 then 'drying' when event_type = 'purchase' then 'freezing' end as phn, unnest(case event_type when 'view' then ['MF-T03', 'MF-K01'] when 'click' then ['MF-M02'] else ['MF-T05', 'MF-T03'] end) as mf from events) where phn is not null
""")
def rule_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The different pairs of a phenomenon and a formula that governs it."""
    kind, v = F.col("event_type"), F.col("value")
    phn = ops.first_rule([((kind == "view") & (v >= 50), "browning"), ((kind == "click") & (v <= 80), "drying"), (kind == "purchase", "freezing")])
    mf = F.when(kind == "view", F.array(F.lit("MF-T03"), F.lit("MF-K01"))).when(kind == "click", F.array(F.lit("MF-M02"))).otherwise(F.array(F.lit("MF-T05"), F.lit("MF-T03")))
    return read(spark, sf_dir, "events").select(phn.alias("phn"), F.explode(mf).alias("mf")).where("phn is not null").distinct()


@query("""
with b as (select source, count(*) as pages, round(100.0 * count(*) filter (where lang = 'en') / count(*), 1) as a_pct, round(100.0 * count(*) filter (where n_chars < 200) / count(*), 1) as skip_pct, round(100.0 * count(*) filter (where quality = 0) / count(*), 1) as error_pct, min(n_chars) as shortest, round(avg(n_chars), 2) as mean_chars from documents left join labels using (doc_id) group by 1),
d as (select source, count(*) as dups from (select source, n_chars, lang from documents group by 1, 2, 3 having count(*) > 1) group by 1)
select b.*, coalesce(dups, 0) as dups, a_pct >= 5 and skip_pct <= 40 as signal_gate, error_pct < 10 as final_gate, case when skip_pct <= 40 and error_pct < 10 then 'pass' when skip_pct <= 40 or error_pct < 10 then 'warn' else 'fail' end as status from b left join d using (source)
""")
def book_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gates of a book: enough signal and not too much skipped, few errors, and how many composite keys are there twice."""
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    pct = lambda c: F.round(100.0 * F.count_if(c) / F.count("*"), 1)
    b = d.groupBy("source").agg(F.count("*").alias("pages"), pct(F.col("lang") == "en").alias("a_pct"), pct(F.col("n_chars") < 200).alias("skip_pct"), pct(F.col("quality") == 0).alias("error_pct"), F.min("n_chars").alias("shortest"), F.round(F.avg("n_chars"), 2).alias("mean_chars"))
    keys = read(spark, sf_dir, "documents").groupBy("source", "n_chars", "lang").count().where("count > 1").groupBy("source").agg(F.count("*").alias("dups"))
    skip, error = F.col("skip_pct") <= 40, F.col("error_pct") < 10
    return b.join(keys, "source", "left").withColumns({"dups": F.coalesce("dups", F.lit(0)).cast("long"), "signal_gate": (F.col("a_pct") >= 5) & skip, "final_gate": error, "status": ops.first_rule([(skip & error, "pass"), (skip | error, "warn")], "fail")})


@query("""
with live as (select *, row_number() over (partition by o_orderpriority order by o_orderdate, o_orderkey) as k from orders where o_orderdate > timestamp '2001-01-01'), x as (select o_orderpriority, count(*) as expired from orders where o_orderdate <= timestamp '2001-01-01' group by 1)
select o_orderpriority as resource, o_orderkey as holder, k, k <= 3 as admitted, expired from live join x using (o_orderpriority) where k <= 6
""")
def slot_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locks whose time is over are gone; of the others the first three of a resource are let in, and the next three wait."""
    o, until = read(spark, sf_dir, "orders"), F.lit("2001-01-01").cast("timestamp_ntz")
    live = ops.top_n(o.where(F.col("o_orderdate") > until).select("o_orderpriority", "o_orderkey", "o_orderdate"), ["o_orderpriority"], [F.col("o_orderdate"), F.col("o_orderkey")], 6)
    gone = o.where(F.col("o_orderdate") <= until).groupBy("o_orderpriority").agg(F.count("*").alias("expired"))
    return live.join(gone, "o_orderpriority").select(F.col("o_orderpriority").alias("resource"), F.col("o_orderkey").alias("holder"), F.col("rank").alias("k"), (F.col("rank") <= 3).alias("admitted"), "expired")


@query("""
with r as (select lang, doc_id, n_chars > 800 as hit, row_number() over (partition by lang, n_chars > 800 order by md5(doc_id || ':7'), doc_id) as k from documents where lang is not null), h as (select * from r where k <= case when hit then 6 else 4 end), n as (select lang, count(*) as n from h group by 1),
rest as (select lang, doc_id, hit, row_number() over (partition by lang order by md5(doc_id || ':7'), doc_id) as k from r where k > case when hit then 6 else 4 end)
select lang, doc_id, hit, false as topped_up from h union all select lang, doc_id, hit, true from rest join n using (lang) where rest.k <= 10 - n.n
""")
def topped_up_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six long and four short documents of a language, in a seeded order; what a stratum lacks is filled up from the rest."""
    d = read(spark, sf_dir, "documents").where("lang is not null").select("lang", "doc_id", (F.col("n_chars") > 800).alias("hit"), F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":7"))).alias("h"))
    return records.topped_up(d, ["lang"], "hit", {True: 6, False: 4}, ["h", "doc_id"]).select("lang", "doc_id", "hit", "topped_up")


@query("""
with a as (select distinct l_partkey % 500 as k from lineitem where l_returnflag = 'R'), b as (select distinct l_partkey % 500 as k from lineitem where l_returnflag = 'A' and l_quantity < 3)
select 'both' as what, count(*) as n, min(k) as least from (select k from a intersect select k from b) union all select 'first only', count(*), min(k) from (select k from a except select k from b) union all select 'either', count(*), min(k) from (select k from a union select k from b)
""")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").withColumn("k", F.col("l_partkey") % 500)
    a, b = lines.where("l_returnflag = 'R'").select("k").distinct(), lines.where("l_returnflag = 'A' and l_quantity < 3").select("k").distinct()
    told = lambda name, df: df.agg(F.count("*").alias("n"), F.min("k").alias("least")).select(F.lit(name).alias("what"), "n", "least")
    return told("both", a.intersect(b)).unionByName(told("first only", a.exceptAll(b))).unionByName(told("either", a.union(b).distinct()))


@query("""
select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as place from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r from orders) where r <= 5
""")
def newest_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's five newest orders, told from the oldest on."""
    few = ops.top_n(read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 5)
    return few.withColumn("place", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).cast("long")).select("o_custkey", "o_orderkey", "place")  # five rows in a window


@query("""
with u as (select 'customer' as kind, c_custkey as id, c_name as name, c_acctbal as balance, null as url from customer union all select 'supplier', s_suppkey, s_name, s_acctbal, null from supplier union all select 'page', page_id, null, null, url from pages)
select kind, count(*) as n, count(name) as named, round(sum(balance), 2) as balance, count(url) as with_url from u group by 1
""")
def source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with different columns as one table."""
    parts = [
        read(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")),
        read(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")), read(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), "url"),
    ]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2], allowMissingColumns=True)
    return u.groupBy("kind").agg(F.count("*").alias("n"), F.count("name").alias("named"), F.round(F.sum("balance"), 2).alias("balance"), F.count("url").alias("with_url"))


@query("""
with s as (select c.conv_id, c.turn, c.conv_id || '__c' || turn as recipe, p.pos, p.step, lower(split_part(p.step, ' ', 1)) as slug from conversations c, unnest(string_split(text, '. ')) with ordinality as p(step, pos) where text is not null)
select 'recipes' as table_, count(distinct recipe) as n, max(recipe) as last from s union all select 'steps', count(*), max(recipe || '_' || pos) from s union all select 'has_step', count(*), max(recipe || '>' || pos) from s
union all select 'uses_ingredient', count(*), max(k) from (select distinct recipe || '>' || slug as k from s where slug <> '') union all select 'ingredients', count(distinct slug), max(slug) from s where slug <> ''
""")
def recipe_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipes taken apart into five tables, and what is in each."""
    c = read(spark, sf_dir, "conversations").where("text is not null")
    s = c.select(F.concat(F.col("conv_id").cast("string"), F.lit("__c"), F.col("turn").cast("string")).alias("recipe"), F.posexplode(F.split("text", r"\. ")).alias("pos", "step")).withColumns({"pos": F.col("pos") + 1, "slug": F.lower(F.split_part("step", F.lit(" "), F.lit(1)))})
    used = s.where("slug <> ''")
    tables = {
        "recipes": s.select(F.col("recipe").alias("k")).distinct(), "steps": s.select(F.concat_ws("_", "recipe", "pos").alias("k")), "has_step": s.select(F.concat_ws(">", "recipe", "pos").alias("k")),
        "uses_ingredient": used.select(F.concat_ws(">", "recipe", "slug").alias("k")).distinct(), "ingredients": used.select(F.col("slug").alias("k")).distinct(),
    }
    told = [t.agg(F.count("*").alias("n"), F.max("k").alias("last")).select(F.lit(name).alias("table_"), "n", "last") for name, t in tables.items()]
    return told[0].unionByName(told[1]).unionByName(told[2]).unionByName(told[3]).unionByName(told[4])


@query("""
with c as (select label, i, avg(x) as m from (select label, unnest(embedding)::double as x, unnest(range(1, len(embedding) + 1)) as i from embeddings) group by 1, 2), a as (select label as anchor, list(m order by i) as v from c group by 1),
s as (select vec_id, anchor, round(list_cosine_similarity(embedding::double[], v), 6) as s from embeddings, a), t as (select *, row_number() over (partition by vec_id order by s desc, anchor) as r from s), k as (select vec_id, max(s) as top, string_agg(anchor::varchar, ',' order by r) filter (where s > 0.45) as a45, string_agg(anchor::varchar, ',' order by r) filter (where s > 0.40) as a40 from t where r <= 3 group by 1)
select vec_id, coalesce(a45, a40) as tags, case when a45 is not null then 0.45 when a40 is not null then 0.4 end as threshold, top from k
""")
def threshold_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three nearest anchors of each vector; the first of two thresholds that any of them passes gives the tags."""
    e = read(spark, sf_dir, "embeddings")
    means = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    anchors = means.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda p: p["m"]).alias("v"))
    best = identity.nearest_of(e.select("vec_id", "embedding"), anchors, "vec_id", "embedding", "label", "v", 3).groupBy("vec_id").agg(F.sort_array(F.collect_list(F.struct("rank", "known", "similarity"))).alias("x"))
    over = lambda t: F.array_join(F.transform(F.filter("x", lambda a: a["similarity"] > t), lambda a: a["known"].cast("string")), ",")
    high, low = F.nullif(over(0.45), F.lit("")), F.nullif(over(0.40), F.lit(""))
    return best.select("vec_id", F.coalesce(high, low).alias("tags"), F.when(high.isNotNull(), 0.45).when(low.isNotNull(), 0.4).alias("threshold"), F.array_max(F.transform("x", lambda a: a["similarity"])).alias("top"))
