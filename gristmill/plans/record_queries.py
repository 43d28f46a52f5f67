"""Queries over records: rule chains, gates, decision trees, merges, batches, quotas and tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import graph, quotations, records, tables as ops
from ..streaming import events as streams
from .registry import query, read


@query(r"""
select page_id, reason not like 'veto%' and reason <> 'drop' as keep, reason from (select page_id, case when contains(url, '/en/') then 'exempt' when length(html) < 400 then 'veto: short' when len(regexp_extract_all(html, '<a ')) >= 10 then 'veto: index'
  when regexp_matches(html, '[0-9]+ ?(kg|mg|°C)') then 'unit' when len(string_split(html, '|')) > 6 then 'table' when contains(html, '<p>') then 'prose' else 'drop' end as reason from pages)
""")
def page_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exempt pages first, then vetoes, then signals; the first rule that holds is the reason."""
    html = F.col("html")
    rules = [
        (F.contains("url", F.lit("/en/")), "exempt"), (F.char_length(html) < 400, "veto: short"), (F.regexp_count(html, F.lit("<a ")) >= 10, "veto: index"), (html.rlike("[0-9]+ ?(kg|mg|°C)"), "unit"),
        (F.size(F.split(html, r"\|")) > 6, "table"), (F.contains(html, F.lit("<p>")), "prose"),
    ]
    told = read(spark, sf_dir, "pages").select("page_id", ops.first_rule(rules, "drop").alias("reason"))
    return told.select("page_id", (~F.col("reason").startswith("veto") & (F.col("reason") != "drop")).alias("keep"), "reason")


@query("select doc_id, item_id from documents d join benchmark b on b.text <> '' and contains(d.text, b.text)")
def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that quote a whole benchmark item as it stands."""
    found = quotations.quoted(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")
    return found.where("fit = 'exact'").select("doc_id", F.col("item_id").cast("long").alias("item_id"))


@query("""
select doc_id, concat_ws(';', case when lang is null or lang = '' then 'missing field: lang' end, case when source is null or source = '' then 'missing field: source' end, case when text is null or text = '' then 'missing field: text' end) as errors from documents
""")
def schema_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.array_join(records.field_errors(["lang", "source", "text"]), ";").alias("errors"))


@query("""
select p_brand, n_variants, string_agg(p_name, ',' order by length(p_name), p_name) as kept from
(select p_brand, p_name, count(*) over (partition by p_brand) as n_variants, row_number() over (partition by p_brand order by length(p_name), p_name) as r from (select distinct p_brand, p_name from part where p_name not like 'red %')) where r <= 5 group by 1, 2
""")
def trimmed_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Junk variants go; of the others the five shortest stay."""
    v = read(spark, sf_dir, "part").where(~F.col("p_name").startswith("red ")).select("p_brand", "p_name").distinct()
    five = ops.top_n(v, ["p_brand"], [F.char_length("p_name"), F.col("p_name")], 5).groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("rank", "p_name"))).alias("k"))
    return v.groupBy("p_brand").agg(F.count("*").alias("n_variants")).join(five, "p_brand").select("p_brand", "n_variants", F.array_join(F.transform("k", lambda x: x["p_name"]), ",").alias("kept"))


@query(r"""
select conv_id, turn, array_to_string(list_filter([case when regexp_matches(lower(text), 'tion') then 'oxidation' end, case when regexp_matches(lower(text), 'the|les') then 'article' end, case when regexp_matches(text, '[0-9]') then 'number' end], lambda x: x is not null), ',') as routes,
  array_to_string(regexp_extract_all(lower(text), '[a-z]{3,20}'), ' ') as tokens from conversations
""")
def keyword_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, low = F.col("text"), F.lower("text")
    routes = F.array_compact(F.array(F.when(low.rlike("tion"), "oxidation"), F.when(low.rlike("the|les"), "article"), F.when(t.rlike("[0-9]"), "number")))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(routes, ",").alias("routes"), F.array_join(F.regexp_extract_all(low, F.lit("[a-z]{3,20}"), F.lit(0)), " ").alias("tokens"))


@query("""
select source, n, blank_pct, mean_chars, case when blank_pct < 20 and mean_chars > 200 then 'pass' when blank_pct < 40 then 'warn' else 'fail' end as status from (select source, count(*) as n,
  round(100.0 * (count(*) filter (where text is null or length(text) < 50)) / count(*), 1) as blank_pct, round(avg(length(text)), 4) as mean_chars from documents group by 1)
""")
def ocr_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    length = F.char_length("text")
    g = read(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.round(100.0 * F.count_if(length.isNull() | (length < 50)) / F.count("*"), 1).alias("blank_pct"), F.round(F.avg(length), 4).alias("mean_chars"))
    return g.withColumn("status", ops.first_rule([((F.col("blank_pct") < 20) & (F.col("mean_chars") > 200), "pass"), (F.col("blank_pct") < 40, "warn")], "fail"))


@query("""
select c_custkey, case when n = 0 then 'not_started' when n_f = n then 'done' when n_p > 0 then 'review' when n_f > 0 then 'running' else 'queued' end as phase from (select c_custkey, count(o_orderkey) as n, count(*) filter (where o_orderstatus = 'F') as n_f, count(*) filter (where o_orderstatus = 'P') as n_p
from customer left join orders on o_custkey = c_custkey group by 1)
""")
def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count_if(F.col("o_orderstatus") == "P").alias("p"))
    rules = [(F.col("n").isNull(), "not_started"), (F.col("f") == F.col("n"), "done"), (F.col("p") > 0, "review"), (F.col("f") > 0, "running")]
    return read(spark, sf_dir, "customer").select("c_custkey").join(o, "c_custkey", "left").select("c_custkey", ops.first_rule(rules, "queued").alias("phase"))


@query("""
with v1(b, t, field, conf) as (values ('Brand#1', 'ECONOMY', 'k', 0.9), ('Brand#2', 'PROMO', 'cp', 0.6), ('Brand#3', 'ECONOMY', 'ea', 0.87)), v2(t, field, conf) as (values ('PROMO', 'cp', 0.95), ('STANDARD', 'rho', 0.5))
select p_partkey, case when v1.conf >= 0.85 then v1.field when v1.conf is null and v2.conf >= 0.85 then v2.field end as field, case when v1.conf >= 0.85 then 'accept' when v1.conf is not null then 'review' when v2.conf >= 0.85 then 'rescued' when v2.conf is not null then 'low' else 'no_match' end as outcome
from part left join v1 on b = p_brand and v1.t = p_type left join v2 on v2.t = p_type
""")
def fallback_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first map's answer, or else the second map's; how sure they are decides what becomes of it."""
    v1 = spark.createDataFrame([("Brand#1", "ECONOMY", "k", 0.9), ("Brand#2", "PROMO", "cp", 0.6), ("Brand#3", "ECONOMY", "ea", 0.87)], "p_brand string, p_type string, f1 string, c1 double")
    v2 = spark.createDataFrame([("PROMO", "cp", 0.95), ("STANDARD", "rho", 0.5)], "p_type string, f2 string, c2 double")
    met = read(spark, sf_dir, "part").join(ops.small(v1), ["p_brand", "p_type"], "left").join(ops.small(v2), "p_type", "left")
    rules = [(F.col("c1") >= 0.85, "accept"), (F.col("c1").isNotNull(), "review"), (F.col("c2") >= 0.85, "rescued"), (F.col("c2").isNotNull(), "low")]
    return met.select("p_partkey", F.when(F.col("c1") >= 0.85, F.col("f1")).when(F.col("c1").isNull() & (F.col("c2") >= 0.85), F.col("f2")).alias("field"), ops.first_rule(rules, "no_match").alias("outcome"))


@query("""
with x as (select p_name as item, 'part' as src, 1 as f from part union all select 'Small ' || p_type, 'type', 0 from part)
select lower(item) as item_key, sum(f)::bigint as frequency, string_agg(distinct src, ',' order by src) as sources from x group by 1
""")
def external_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items met by their lower-cased name; external ones add a source, and new ones begin at frequency 0."""
    p = read(spark, sf_dir, "part")
    every = p.select(F.col("p_name").alias("item"), F.lit("part").alias("src"), F.lit(1).alias("f")).unionByName(p.select(F.concat(F.lit("Small "), "p_type").alias("item"), F.lit("type").alias("src"), F.lit(0).alias("f")))
    return every.groupBy(F.lower("item").alias("item_key")).agg(F.sum("f").alias("frequency"), F.array_join(F.sort_array(F.collect_set("src")), ",").alias("sources"))  # two sources


@query("""
with t as (select *, row_number() over (partition by conv_id, role order by turn) as k from conversations), q as (select * from t where role = 'user'), a as (select * from t where role = 'assistant')
select conv_id, k, q.turn as asked, a.turn as answered, case when a.turn is null then 'open' when q.turn is null then 'leftover' else 'filled' end as state from q full join a using (conv_id, k)
""")
def placeholder_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The i-th user turn of a conversation takes its i-th answer; what is left over on either side stays."""
    t = ops.numbered(read(spark, sf_dir, "conversations").select("conv_id", "role", "turn"), ["conv_id", "role"], ["turn"], "k")
    q, a = t.where("role = 'user'").select("conv_id", "k", F.col("turn").alias("asked")), t.where("role = 'assistant'").select("conv_id", "k", F.col("turn").alias("answered"))
    return q.join(a, ["conv_id", "k"], "full").withColumn("state", ops.first_rule([(F.col("answered").isNull(), "open"), (F.col("asked").isNull(), "leftover")], "filled"))


@query("""
select o_orderkey, case when r.done is not null then 'done' when o_orderdate < timestamp '1998-01-01' then 'expired' when o_orderstatus = 'O' then 'pending' else 'nudge' end as state
from orders left join (select l_orderkey, min(l_shipdate) as done from lineitem where l_linestatus = 'F' group by 1) r on l_orderkey = o_orderkey
""")
def task_timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("done"))
    rules = [(F.col("done").isNotNull(), "done"), (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"), "expired"), (F.col("o_orderstatus") == "O", "pending")]
    return read(spark, sf_dir, "orders").join(r, "o_orderkey", "left").select("o_orderkey", ops.first_rule(rules, "nudge").alias("state"))


@query("""
select o_orderkey, count(l_partkey) as n_deps, coalesce(bool_and(coalesce(p_size > 5, false)) filter (where l_partkey is not null), true) as ready from orders left join lineitem on l_orderkey = o_orderkey left join part on p_partkey = l_partkey where o_orderstatus = 'P' group by 1
""")
def dependency_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending tasks with the number of their dependencies and whether all are done; a task without any is ready."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") > 5).alias("ok"))
    deps = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey").join(p, "l_partkey", "left").groupBy("o_orderkey").agg(F.count("l_partkey").alias("n"), F.bool_and(F.coalesce("ok", F.lit(False))).alias("all"))
    return read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").join(deps, "o_orderkey", "left").select("o_orderkey", F.coalesce("n", F.lit(0)).cast("long").alias("n_deps"), F.coalesce("all", F.lit(True)).alias("ready"))


@query("""
with recursive r as (select o_orderkey as src, o_orderkey // 2 as root, 1 as steps from orders where o_orderstatus = 'F' and o_orderkey > 0 union all select r.src, o_orderkey // 2, steps + 1 from r join orders on o_orderkey = r.root where o_orderstatus = 'F' and o_orderkey > 0)
select src, min(root) as root, max(steps)::bigint as steps from r group by 1
""")
def redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_orderkey > 0")
    return graph.redirected(o.select(F.col("o_orderkey").alias("src"), F.floor(F.col("o_orderkey") / 2).alias("dst")))


@query("select p_brand, p_type, count(*) as n, min(p_partkey) as first_row, arg_min(p_name, p_partkey) filter (where p_size > 10) as sample from part group by 1, 2")
def unique_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_row"), F.min_by("p_name", F.when(F.col("p_size") > 10, F.col("p_partkey"))).alias("sample"))


@query("""
select *, case when n = 1 then 'noop' when n_types > 3 then 'identity_conflict' when n_types > 1 then 'split' else 'merge' end as decision from
(select lower(trim(p_name)) as cluster, count(*) as n, count(distinct p_type) as n_types, min(p_partkey) filter (where p_size = m) as canonical from (select *, max(p_size) over (partition by lower(trim(p_name))) as m from part) group by 1)
""")
def cluster_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of one name: merged, split or in conflict; the most complete one, first on a tie, is canonical."""
    best = F.max_by("p_partkey", F.struct("p_size", -F.col("p_partkey")))
    g = read(spark, sf_dir, "part").groupBy(F.lower(F.trim("p_name")).alias("cluster")).agg(F.count("*").alias("n"), F.countDistinct("p_type").alias("n_types"), best.alias("canonical"))
    return g.withColumn("decision", ops.first_rule([(F.col("n") == 1, "noop"), (F.col("n_types") > 3, "identity_conflict"), (F.col("n_types") > 1, "split")], "merge"))


@query(r"""
with k as (select *, regexp_replace(lower(trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g'))), '[ .;!?]+$', '') as s from documents where text is not null)
select lang, sha256(s) as statement, count(*) as frequency, round(avg(n_chars), 3) as mean_chars, count(distinct source) as n_sources, min(doc_id) as first_doc from k group by lang, s
""")
def statement_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each whole statement occurs, without case, white space and end marks. Statements meet by their digest."""
    s = F.regexp_replace(F.lower(F.trim(F.regexp_replace("text", r"[ \t\n\r]+", " "))), r"[ .;!?]+$", "")
    d = read(spark, sf_dir, "documents").where("text is not null").groupBy("lang", F.sha2(s, 256).alias("statement"))
    return d.agg(F.count("*").alias("frequency"), F.round(F.avg("n_chars"), 3).alias("mean_chars"), F.countDistinct("source").alias("n_sources"), F.min("doc_id").alias("first_doc"))


@query("""
select conv_id, unnest(string_split(text, '. ')) as step, generate_subscripts(string_split(text, '. '), 1) - 1 as pos, turn, conv_id || '_r' || turn || '_' || left(md5(conv_id || '|' || turn || '|' || role), 6) as recipe_id from conversations
""")
def recipe_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each step, under an id made of place and hash."""
    c = read(spark, sf_dir, "conversations")
    hashed = F.substring(F.md5(F.concat_ws("|", "conv_id", "turn", "role")), 1, 6)
    return c.select("conv_id", "turn", F.concat(F.concat_ws("_r", "conv_id", "turn"), F.lit("_"), hashed).alias("recipe_id"), F.posexplode(F.split("text", r"\. ")).alias("pos", "step")).withColumn("pos", F.col("pos").cast("long"))


@query("select o_orderpriority, count(*) filter (where o_orderstatus = 'F') as F, count(*) filter (where o_orderstatus = 'O') as O, count(*) filter (where o_orderstatus = 'P') as P from orders group by 1")
def pivot_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count("o_orderstatus")).na.fill(0)


@query("""
select source, count(*) as n, round(avg(length(text)), 2) as mean, min(length(text)) as shortest, max(length(text)) as longest, count(*) filter (where length(text) < 50) as under_50, count(*) filter (where length(text) < 150) as under_150 from documents where text is not null and trim(text) <> '' group by 1
""")
def chunk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.char_length("text").cast("long")
    return read(spark, sf_dir, "documents").where("text is not null and trim(text) <> ''").groupBy("source").agg(F.count("*").alias("n"), F.round(F.avg(n), 2).alias("mean"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.count_if(n < 50).alias("under_50"), F.count_if(n < 150).alias("under_150"))


@query("""
select p_brand, count(*) as n, count(*) filter (where dev <= 10) as passed, round(avg(dev), 4) as mean_deviation from (select p_brand, abs(p_retailprice - 950) / 950 * 100 as dev, row_number() over (partition by p_brand order by p_partkey) as r from part) where r <= 30 group by 1
""")
def benchmark_pass_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each group the first 30 rows, as the benchmark has it."""
    first = ops.top_n(read(spark, sf_dir, "part"), ["p_brand"], [F.col("p_partkey")], 30).withColumn("dev", F.abs(F.col("p_retailprice") - 950) / 950 * 100)
    return first.groupBy("p_brand").agg(F.count("*").alias("n"), F.count_if(F.col("dev") <= 10).alias("passed"), F.round(F.avg("dev"), 4).alias("mean_deviation"))


@query("select o_orderpriority, arg_min(o_orderkey, (o_orderdate, o_orderkey)) as claimed, count(*) as waiting from orders where o_orderstatus = 'O' group by 1")
def queue_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").where("o_orderstatus = 'O'").groupBy("o_orderpriority").agg(F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("claimed"), F.count("*").alias("waiting"))


@query("select conv_id, turn, (row_number() over (partition by conv_id order by turn) - 1) // 3 as batch, conv_id || '_' || ((row_number() over (partition by conv_id order by turn) - 1) // 3) as batch_key from conversations")
def fixed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = ops.numbered(read(spark, sf_dir, "conversations").select("conv_id", "turn"), ["conv_id"], ["turn"], "seq")
    return turns.select("conv_id", "turn", F.floor((F.col("seq") - 1) / 3).alias("batch")).withColumn("batch_key", F.concat_ws("_", "conv_id", "batch"))


@query("select lang, doc_id, rank from (select lang, doc_id, row_number() over (partition by lang order by md5(doc_id || ':42'), doc_id) as rank from documents) where rank <= 5")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five documents of each language, in the order of a seeded hash."""
    d = read(spark, sf_dir, "documents").select("lang", "doc_id", F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":42"))).alias("h"))
    return ops.top_n(d, ["lang"], [F.col("h"), F.col("doc_id")], 5).drop("h")


@query("""
select user_id, count(*) as calls, round(max(day), 4) as dearest_day, count(*) filter (where day > 200) as over_budget from (select user_id, sum(value) over (partition by user_id order by ts range between interval 1 day preceding and current row) as day from events) group by 1
""")
def rolling_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("user_id", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    days = ops.rolling(e, ["user_id"], "us", "value", 86_400_000_000, "day")
    return days.groupBy("user_id").agg(F.sum("n").alias("calls"), F.round(F.max("day"), 4).alias("dearest_day"), F.sum(F.when(F.col("day") > 200, F.col("n")).otherwise(0)).alias("over_budget"))


@query("""
select o_custkey, count(*) as n, count(*) filter (where used <= 5e5) as admitted from (select o_custkey, sum(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding) as used from orders) group by 1
""")
def quota_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs in order of their time, until a customer's quota is used up."""
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return ops.running(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", "used").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("used") <= 5e5).alias("admitted"))


@query("""
with t as (select max(ts) as now from events) select user_id, arg_max(event_type, (ts, event_id)) as last_event, max(ts) as last_seen, max(ts) < any_value(now) - interval 2 hour as stale from events, t group by 1
""")
def stale_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    last = e.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_event"), F.max("ts").alias("last_seen"))
    now = e.agg(F.max("ts").alias("now"))  # one row
    return last.join(F.broadcast(now), F.lit(True)).withColumn("stale", F.col("last_seen") < F.col("now") - F.expr("interval 2 hours")).drop("now")


@query("""
with g as (select user_id, ts, case when ts - lag(ts) over w >= interval 30 minute or lag(ts) over w is null then 1 else 0 end as new from events window w as (partition by user_id order by ts)),
s as (select user_id, ts, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from g)
select user_id, min(ts) as first_event, count(*) as n from s group by user_id, k
""")
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = lambda e: e.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").cast("timestamp_ntz").alias("first_event"), "n")
    return streams.run_once(spark, f"{sf_dir}/events.parquet", plan, "complete")


@query(r"""
with r as (select doc_id, source as domain, trim(text) as chunk, string_split(text, chr(10))[1] as statement, string_split(text, chr(10)) as steps,
  trim(case doc_id % 5 when 0 then substr(text, 3, 40) when 1 then replace(upper(substr(text, 3, 40)), ' ', '  ') when 2 then translate(substr(text, 3, 40), 'g', 'x') when 3 then '' else 'nowhere to be found' end) as citation,
  case doc_id % 4 when 0 then 'fact_atom' when 1 then 'causal_chain' when 2 then 'guess' else 'mathematical_law' end as kind from documents where lang = 'en' and text is not null),
n as (select *, regexp_replace(regexp_replace(lower(citation), '[\s-]', '', 'g'), '[^\x00-\x7F]', '~', 'g') as q, regexp_replace(regexp_replace(lower(chunk), '[\s-]', '', 'g'), '[^\x00-\x7F]', '~', 'g') as t from r),
k as (select doc_id, regexp_matches(statement, '[0-9]') as has_number, domain in (select source from documents group by 1 having count(*) >= 50) as valid_domain, citation <> '' as has_citation,
  citation <> '' and (contains(chunk, citation) or (q <> '' and contains(t, q)) or (length(q) >= 5 and length(q) <= length(t) and list_contains(list_transform(range(0, case when length(q) >= 5 then length(t) - length(q) + 1 else 0 end), lambda i: hamming(substr(t, i + 1, length(q)), q) <= greatest(1, length(q) // 10)), true))) as citation_in_chunk,
  kind <> 'guess' as valid_type, kind <> 'causal_chain' or len(steps) >= 2 as causal_chain_format from n)
select *, valid_domain and has_citation and citation_in_chunk and valid_type and causal_chain_format as passes from k
""")
def record_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements with the domain, citation, kind and steps that they came with, each held against its six rules; domains are those of many documents."""
    d, k, t = read(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text")
    cite = F.when(k % 5 == 0, F.substring(t, 3, 40)).when(k % 5 == 1, F.replace(F.upper(F.substring(t, 3, 40)), F.lit(" "), F.lit("  "))).when(k % 5 == 2, F.translate(F.substring(t, 3, 40), "g", "x")).when(k % 5 == 3, "").otherwise("nowhere to be found")
    kind = F.when(k % 4 == 0, "fact_atom").when(k % 4 == 1, "causal_chain").when(k % 4 == 2, "guess").otherwise("mathematical_law")
    r = d.where("lang = 'en' and text is not null").select("doc_id", F.col("source").alias("domain"), t.alias("chunk"), F.split(t, "\n")[0].alias("statement"), F.split(t, "\n").alias("steps"), cite.alias("citation"), kind.alias("kind"))
    domains = d.groupBy(F.col("source").alias("domain")).agg(F.count("*").alias("n")).where("n >= 50")
    return records.checked(r, domains).select("doc_id", "has_number", "valid_domain", "has_citation", "citation_in_chunk", "valid_type", "causal_chain_format", "passes")


_ARRIVES = "epoch_us(ts) // 259200000000 + (event_id % 11 = 0)::int * 2"  # every third day a batch; some events come two batches late


def _arrivals(spark: SparkSession, sf_dir: str) -> str:
    day = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 259200)
    return streams.arranged(read(spark, sf_dir, "events").withColumn("_arrives", day + F.when(F.col("event_id") % 11 == 0, 2).otherwise(0)), "_arrives")


@query("""
with w as (select date_trunc('millisecond', max(ts)) - interval 1 hour as w from events),
e as (select user_id, event_type, ts, coalesce(lead(ts) over (partition by user_id order by ts), w) as until, lag(event_type) over (partition by user_id order by ts) as before, lag(ts) over (partition by user_id order by ts) as prior from events, w),
due as (select user_id, case when k <= 3 then 'nudge' else 'failed' end as kind, least(k, 3) as n, ts + k * interval 6 hour as "at" from e, (select unnest([1, 2, 3, 4]) as k) where event_type <> 'purchase' and ts + k * interval 6 hour <= until)
select user_id, kind, n::integer as n, "at" from due union all select user_id, 'done', 0, ts from e where event_type = 'purchase' and before <> 'purchase' and ts < prior + interval 24 hour
""")
def stream_reminders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users who haven't purchased are nudged after six hours without an event, three times at most, and then fail; timers of event time, no new event is needed."""
    made = streams.run_once(spark, f"{sf_dir}/events.parquet", lambda e: streams.reminders(e, "user_id", "event_type", "purchase", "6 hours"))
    return made.withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("""
with w as (select date_trunc('millisecond', max(ts)) - interval 1 hour as w from events where event_type in ('view', 'purchase')),
x as (select *, lead(ts) over (partition by user_id order by ts) as following, lead(event_type) over (partition by user_id order by ts) as next_type, lag(ts) over (partition by user_id order by ts) as prior, lag(event_type) over (partition by user_id order by ts) as before from events where event_type in ('view', 'purchase'))
select user_id, 'granted' as kind, ts as "at" from x where event_type = 'view'
union all select user_id, 'expired', ts + interval 2 hour from x, w where event_type = 'view' and ts + interval 2 hour <= coalesce(following, w)
union all select user_id, 'released', ts from x where event_type = 'purchase' and before = 'view' and ts < prior + interval 2 hour
""")
def stream_leases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view takes or renews a user's own place for two hours, a purchase gives it back; places fall free when their time is over."""
    plan = lambda e: streams.leases(e.where("event_type in ('view', 'purchase')"), "user_id", "user_id", "event_type", "view", "2 hours", 1)
    made = streams.run_once(spark, f"{sf_dir}/events.parquet", plan)
    return made.select("user_id", "kind", F.col("at").cast("timestamp_ntz").alias("at"))


@query(f"""
with b as (select *, {_ARRIVES} as arrives from events), m as (select arrives, max(ts) as top from b group by 1),
t as (select b.*, (select max(top) from m where m.arrives < b.arrives) - interval 1 day as mark from b)
select event_id, coalesce(ts < mark, false) as late from t
""")
def stream_late_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that come a day or more behind those before their trigger are set aside, and the others go on."""
    in_time, late = streams.split_late(spark, _arrivals(spark, sf_dir), "1 day")
    return in_time.select("event_id", F.lit(False).alias("late")).unionByName(late.select("event_id", F.lit(True).alias("late")))


@query(f"""
with b as (select *, dense_rank() over (order by {_ARRIVES}) as arrives from events), m as (select arrives, date_trunc('millisecond', max(ts)) as top from b group by 1),
t as (select b.*, (select max(top) from m where m.arrives < b.arrives - 1) - interval 1 day as mark from b),
s as (select event_type, time_bucket(interval 6 hour, ts) - k * interval 6 hour as start, mark from t, (select unnest([0, 1]) as k))
select event_type, start, count(*) as n from s where coalesce(start + interval 12 hour > mark, true) and start + interval 12 hour <= (select max(top) from m) - interval 1 day group by 1, 2
""")
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of twelve hours, one every six, each given once when the watermark has passed it; events that come later for it are dropped."""
    made = streams.run_once(spark, _arrivals(spark, sf_dir), lambda e: streams.windowed(e, ["event_type"], "12 hours", "6 hours"), files_per_trigger=1)
    return made.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""
with top as (select max(ts) - interval 8 hour as w from events), v as (select event_id, user_id, ts from events where event_type = 'view'), p as (select user_id, ts from events where event_type = 'purchase')
select v.event_id, min(p.ts) as answered, count(p.ts) = 0 as expired from v left join p on p.user_id = v.user_id and p.ts >= v.ts and p.ts <= v.ts + interval 4 hour where v.ts < (select w from top) group by 1
""")
def stream_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views as tasks and purchases as their results, as two streams: a view with no purchase within four hours comes out as expired."""
    def plan(e: DataFrame) -> DataFrame:
        of = lambda kind, *columns: e.where(F.col("event_type") == kind).select(*columns)
        return streams.matched(of("view", "event_id", "user_id", "ts"), of("purchase", "user_id", "ts"), "user_id", "4 hours")

    made = streams.run_once(spark, _arrivals_in_order(spark, sf_dir), plan, files_per_trigger=1)
    top = read(spark, sf_dir, "events").agg((F.max("ts") - F.expr("interval 8 hours")).alias("w"))  # one row; later tasks may still be open
    settled = made.withColumn("ts", F.col("ts").cast("timestamp_ntz")).join(F.broadcast(top), F.col("ts") < F.col("w"))
    return settled.groupBy("event_id").agg(F.min("result_ts").cast("timestamp_ntz").alias("answered"), (F.count("result_ts") == 0).alias("expired"))


def _arrivals_in_order(spark: SparkSession, sf_dir: str) -> str:
    week = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 604800)
    return streams.arranged(read(spark, sf_dir, "events").withColumn("_arrives", week), "_arrives")


@query(r"""
select doc_id, len(regexp_extract_all(text, '[0-9A-Za-z_]+')) as n_words, len(regexp_extract_all(text, '[\x{4e00}-\x{9fff}]')) as n_cjk, left(sha256(source || ':' || doc_id || ':' || left(text, 80)), 16) as hash_id from documents where text is not null and source is not null
""")
def text_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    hashed = F.substring(F.sha2(F.concat_ws(":", "source", "doc_id", F.substring(t, 1, 80)), 256), 1, 16)
    return read(spark, sf_dir, "documents").where("text is not null and source is not null").select("doc_id", F.regexp_count(t, F.lit("[0-9A-Za-z_]+")).cast("long").alias("n_words"), F.regexp_count(t, F.lit(r"[\x{4e00}-\x{9fff}]")).cast("long").alias("n_cjk"), hashed.alias("hash_id"))


@query("""
with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents),
n as (select *, sum(case when length(line) between 1 and 30 then 1 else 0 end) over (partition by doc_id order by pos rows unbounded preceding) as section from l)
select doc_id, section::bigint as section, min(line) filter (where length(line) between 1 and 30) as title, count(*) as n_lines, sum(length(line))::bigint as n_chars from n group by 1, 2
""")
def heading_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of up to 30 characters are headings."""
    return records.sections(read(spark, sf_dir, "documents"), "doc_id", "text", r"^.{1,30}$")


@query()
def gapped_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short lines are headings, but only six lines or more after the last that counted."""
    return records.gapped_sections(read(spark, sf_dir, "documents"), "doc_id", "text", r"^.{1,30}$", 6)


@query()
def chunk_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = records.packed(F.split("text", "\n"), 800)
    return read(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.posexplode(chunks).alias("chunk", "text"))


@query()
def heat_slabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") / 2000 + 0.005).alias("half"), F.lit(1.4e-7).alias("alpha"), F.lit(0.5).alias("k"), F.lit(50.0).alias("h"), F.lit(5.0).alias("T0"), (F.col("p_retailprice") / 20 + 40).alias("Tinf"), F.lit(600.0).alias("t"))
    return records.heat_slab(p, "p_partkey")
