"""Path, optional, top-k and audit queries of a property graph. Orders stand for recipes, their lines for steps, parts for ingredients, nations for phenomena."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import tables as ops
from .registry import query, read


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, p = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part")
    return l.join(p, l.l_partkey == p.p_partkey)


_FIRST = "(select {by}, string_agg(v, ',' order by v) as {name} from (select {by}, v, row_number() over (partition by {by} order by v) as r from (select distinct {by}, {value} as v from {table}) where v is not null) where r <= {n} group by {by})"


@query("""
select l_orderkey as o_orderkey, count(*) as n_steps, min(l_linenumber) as first_step from lineitem join part on p_partkey = l_partkey
where l_orderkey in (select o_orderkey from orders) and (lower(p_type) in ('economy', 'promo') or contains(lower(p_name), 'ring')) group by 1
""")
def steps_by_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    action = F.lower("p_type").isin("economy", "promo") | F.contains(F.lower("p_name"), F.lit("ring"))
    steps = _steps(spark, sf_dir).where(action).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_steps"), F.min("l_linenumber").alias("first_step"))
    return steps.join(read(spark, sf_dir, "orders"), "o_orderkey", "left_semi")


@query("""
select n_name as nation, (select count(distinct c_custkey) from customer where c_nationkey = n_nationkey) as n_customers, (select count(distinct s_suppkey) from supplier where s_nationkey = n_nationkey) as n_suppliers from nation
""")
def independent_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides are counted before they meet, so that no product of customers and suppliers arises."""
    c = read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.countDistinct("c_custkey").alias("c"))
    s = read(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.countDistinct("s_suppkey").alias("s"))
    met = read(spark, sf_dir, "nation").join(c, "n_nationkey", "left").join(s, "n_nationkey", "left")
    return met.select(F.col("n_name").alias("nation"), F.coalesce("c", F.lit(0)).cast("long").alias("n_customers"), F.coalesce("s", F.lit(0)).cast("long").alias("n_suppliers"))


@query("select doc_id, source, n_chars from documents where doc_id in (select doc_id from labels where toxic = 1)")
def principles_of_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").where("toxic = 1"), "doc_id", "left_semi").select("doc_id", "source", "n_chars")


@query("""
select l_orderkey, l_linenumber, substring(p_name, 1, 80) as step from lineitem join part on p_partkey = l_partkey
where l_quantity > 40 and l_discount <= 0.02 and l_returnflag = 'R' and l_tax > 0.05 or p_size = 7
""")
def hot_short_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AND binds before OR: rows of size 7 escape the other conditions."""
    bound = (F.col("l_quantity") > 40) & (F.col("l_discount") <= 0.02) & (F.col("l_returnflag") == "R") & (F.col("l_tax") > 0.05)
    return _steps(spark, sf_dir).where(bound | (F.col("p_size") == 7)).select("l_orderkey", "l_linenumber", F.substring("p_name", 1, 80).alias("step"))


@query(f"""
select n_name as term, count(s_suppkey) as n_targets, any_value(targets) as targets from nation left join supplier on s_nationkey = n_nationkey
left join {_FIRST.format(by='s_nationkey', name='targets', value='s_name', table='supplier', n=5)} f on f.s_nationkey = n_nationkey group by n_nationkey, n_name
""")
def term_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    counts, few = s.groupBy("n_nationkey").agg(F.count("s_suppkey").alias("n")), ops.first_distinct(s, ["n_nationkey"], "s_name", 5, "targets")
    met = read(spark, sf_dir, "nation").join(counts, "n_nationkey", "left").join(few, "n_nationkey", "left")
    return met.select(F.col("n_name").alias("term"), F.coalesce("n", F.lit(0)).cast("long").alias("n_targets"), "targets")


@query("select p_partkey, p_name, p_type from part where contains(lower(p_name), 'widget')")
def targets_of_substrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").where(F.contains(F.lower("p_name"), F.lit("widget"))).select("p_partkey", "p_name", "p_type")


@query("select p_name as term, count(*) as n, count(distinct p_brand) as n_brands from part group by 1 having count(distinct p_brand) >= 5 order by n_brands desc, n desc, term limit 10")
def most_translated_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = read(spark, sf_dir, "part").groupBy(F.col("p_name").alias("term")).agg(F.count("*").alias("n"), F.countDistinct("p_brand").alias("n_brands"))
    return counts.where("n_brands >= 5").orderBy(F.desc("n_brands"), F.desc("n"), "term").limit(10)


@query("select l_returnflag, p_brand, count(*) as n from lineitem join part on p_partkey = l_partkey where contains(p_name, 'ring') group by 1, 2")
def targets_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steps(spark, sf_dir).where(F.contains("p_name", F.lit("ring"))).groupBy("l_returnflag", "p_brand").agg(F.count("*").alias("n"))


@query(f"""
select p_partkey, first_order, n_suppliers, suppliers from part left join (select l_partkey, min(l_orderkey) as first_order, count(distinct l_suppkey) as n_suppliers from lineitem group by 1) u on u.l_partkey = p_partkey
left join {_FIRST.format(by='l_partkey', name='suppliers', value='l_suppkey::varchar', table='lineitem', n=10)} f on f.l_partkey = p_partkey
""")
def ingredient_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part with the first order that uses it and its first suppliers; parts that no order uses stay."""
    l = read(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    uses = l.groupBy("p_partkey").agg(F.min("l_orderkey").alias("first_order"), F.countDistinct("l_suppkey").alias("n_suppliers"))
    return read(spark, sf_dir, "part").select("p_partkey").join(uses, "p_partkey", "left").join(ops.first_distinct(l, ["p_partkey"], "l_suppkey", 10, "suppliers"), "p_partkey", "left")


@query("select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice from lineitem where l_returnflag = 'R' order by l_quantity desc, l_extendedprice desc, l_orderkey, l_linenumber, l_partkey limit 5")
def hottest_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return hot.orderBy(F.desc("l_quantity"), F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey").limit(5)


@query("select event_id, case when event_type <> 'click' then value end as duration from events order by duration desc nulls first, event_id limit 10")
def longest_unknown_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null counts as the largest value."""
    d = F.when(F.col("event_type") != "click", F.col("value")).alias("duration")
    return read(spark, sf_dir, "events").select("event_id", d).orderBy(F.desc_nulls_first("duration"), "event_id").limit(10)


@query("""
select l_orderkey as o_orderkey, count(distinct p_brand) as n_tools, string_agg(distinct p_brand, ',' order by p_brand) as tools from lineitem join part on p_partkey = l_partkey
group by 1 having count(distinct p_brand) >= 3 order by n_tools desc, o_orderkey limit 5
""")
def most_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best are chosen by count, and only their brands are gathered."""
    pairs = _steps(spark, sf_dir).select(F.col("l_orderkey").alias("o_orderkey"), "p_brand").distinct()
    best = pairs.groupBy("o_orderkey").agg(F.count("*").alias("n_tools")).where("n_tools >= 3").orderBy(F.desc("n_tools"), "o_orderkey").limit(5)
    return pairs.join(F.broadcast(best), "o_orderkey").groupBy("o_orderkey", "n_tools").agg(F.array_join(F.sort_array(F.collect_list("p_brand")), ",").alias("tools"))  # five rows


@query("select p_type as phenomenon, count(distinct l_orderkey) as n_orders from lineitem join part on p_partkey = l_partkey group by 1 order by n_orders desc, phenomenon limit 10")
def most_triggered(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _steps(spark, sf_dir).groupBy(F.col("p_type").alias("phenomenon")).agg(F.countDistinct("l_orderkey").alias("n_orders"))
    return counts.orderBy(F.desc("n_orders"), "phenomenon").limit(10)


@query("""
select c_mktsegment as book, count(distinct o_orderkey) as n_orders, count(distinct p_type) as n_phenomena from customer join orders on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey group by 1
""")
def book_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    path = _steps(spark, sf_dir).select("l_orderkey", "p_type").distinct().join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return path.groupBy(F.col("c_mktsegment").alias("book")).agg(F.countDistinct("o_orderkey").alias("n_orders"), F.countDistinct("p_type").alias("n_phenomena"))


@query(f"""
select o_orderkey, o_orderpriority, c_name as book, ingredients from orders left join customer on c_custkey = o_custkey
left join {_FIRST.format(by='l_orderkey', name='ingredients', value='p_name', table='lineitem join part on p_partkey = l_partkey', n=10)} f on f.l_orderkey = o_orderkey
""")
def recipe_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = ops.first_distinct(_steps(spark, sf_dir).withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], "p_name", 10, "ingredients")
    o, c = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("book"))
    return o.join(c, "o_custkey", "left").join(few, "o_orderkey", "left").drop("o_custkey")


@query("""
with s as (select s_nationkey as k, count(*) as n_suppliers, max(s_acctbal) as best_supplier from supplier where s_acctbal > 0 group by 1), c as (select c_nationkey as k, count(*) as n_customers, max(c_acctbal) as best_customer from customer where c_acctbal > 5000 group by 1)
select o_orderkey, o_orderstatus as rule, n_name as phenomenon, n_suppliers, best_supplier, n_customers, best_customer
from orders left join customer on c_custkey = o_custkey left join nation on n_nationkey = c_nationkey left join s on s.k = n_nationkey left join c on c.k = n_nationkey
""")
def evidence_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of both kinds is aggregated per nation first; conditions on optional parts stay inside them."""
    s = read(spark, sf_dir, "supplier").where("s_acctbal > 0").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n_suppliers"), F.max("s_acctbal").alias("best_supplier"))
    customers = read(spark, sf_dir, "customer")
    c = customers.where("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n_customers"), F.max("c_acctbal").alias("best_customer"))
    facts = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("phenomenon")).join(s, "n_nationkey", "left").join(c, "n_nationkey", "left")
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("rule"), F.col("o_custkey").alias("c_custkey"))
    return o.join(customers.select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), "c_custkey", "left").join(facts, "n_nationkey", "left").drop("c_custkey", "n_nationkey")


@query("""
select l_orderkey as o_orderkey, count(distinct p_type) as n_types, count(distinct p_brand) as n_brands, count(distinct l_suppkey) as n_suppliers from lineitem join part on p_partkey = l_partkey
group by 1 having count(distinct p_type) >= 2 and count(distinct l_suppkey) >= 2 order by n_types desc, n_brands desc, n_suppliers desc, o_orderkey limit 10
""")
def richest_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _steps(spark, sf_dir).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.countDistinct("p_type").alias("n_types"), F.countDistinct("p_brand").alias("n_brands"), F.countDistinct("l_suppkey").alias("n_suppliers"))
    return counts.where("n_types >= 2 and n_suppliers >= 2").orderBy(F.desc("n_types"), F.desc("n_brands"), F.desc("n_suppliers"), "o_orderkey").limit(10)


@query(f"""
select n_name as phenomenon, r_name as family, customers, suppliers from nation join region on r_regionkey = n_regionkey
left join {_FIRST.format(by='c_nationkey', name='customers', value='c_name', table='customer', n=4)} c on c_nationkey = n_nationkey
left join {_FIRST.format(by='s_nationkey', name='suppliers', value='s_name', table='supplier', n=3)} s on s_nationkey = n_nationkey
""")
def fact_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    c = ops.first_distinct(read(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), ["n_nationkey"], "c_name", 4, "customers")
    s = ops.first_distinct(read(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey"), ["n_nationkey"], "s_name", 3, "suppliers")
    met = n.join(r, n.n_regionkey == r.r_regionkey).join(c, "n_nationkey", "left").join(s, "n_nationkey", "left")
    return met.select(F.col("n_name").alias("phenomenon"), F.col("r_name").alias("family"), "customers", "suppliers")


@query("select c_custkey, c_name, n_name as parent from customer left join nation on n_nationkey = c_nationkey where contains(c_name, '17')")
def name_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = read(spark, sf_dir, "customer").where(F.contains("c_name", F.lit("17"))), read(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select("c_custkey", "c_name", F.col("n_name").alias("parent"))


@query("""
with d as (select 'orders' as tab, count(*) as n_keys, (count(*) filter (where c > 1)) as duplicates, max(c) as most from (select o_orderkey, count(*) as c from orders group by 1)
union all select 'lineitem', count(*), count(*) filter (where c > 1), max(c) from (select l_orderkey, l_linenumber, count(*) as c from lineitem group by 1, 2)
union all select 'documents', count(*), count(*) filter (where c > 1), max(c) from (select doc_id, count(*) as c from documents group by 1))
select *, case when duplicates = 0 then 'pass' when duplicates <= 0.05 * n_keys then 'warn' else 'fail' end as status from d
""")
def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    def audit(name: str, keys: list[str]) -> DataFrame:
        return read(spark, sf_dir, name).groupBy(*keys).agg(F.count("*").alias("c")).agg(F.count("*").alias("n_keys"), F.count_if(F.col("c") > 1).alias("duplicates"), F.max("c").alias("most")).select(F.lit(name).alias("tab"), "*")

    every = audit("orders", ["o_orderkey"]).unionByName(audit("lineitem", ["l_orderkey", "l_linenumber"])).unionByName(audit("documents", ["doc_id"]))
    return every.withColumn("status", ops.first_rule([(F.col("duplicates") == 0, "pass"), (F.col("duplicates") <= 0.05 * F.col("n_keys"), "warn")], "fail"))


@query("""
select lang, count(*) as n_nodes, sum(coalesce(n, 0))::bigint as n_edges from documents d left join (select doc_id, count(*) as n from labels group by 1) l using (doc_id)
where source = 'src1' and not (starts_with(coalesce(lang, ''), 'e') or starts_with(coalesce(lang, ''), 'z')) group by 1
""")
def legacy_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes with the legacy label and none that begins like a current one, and the edges that would go with them."""
    labels = F.array("source", "lang")
    old = F.array_contains(F.array_compact(labels), "src1") & ~F.exists(F.array_compact(labels), lambda x: x.startswith("e") | x.startswith("z"))
    degree = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.count("*").alias("n"))
    return read(spark, sf_dir, "documents").where(old).join(degree, "doc_id", "left").groupBy("lang").agg(F.count("*").alias("n_nodes"), F.sum(F.coalesce("n", F.lit(0))).alias("n_edges"))


@query("""
select 'statuses' as rule, count(distinct o_orderstatus) as found from orders union all select 'self loops', count(*) from lineitem where l_partkey = l_suppkey
union all select 'out of enum', count(*) from lineitem where l_returnflag is null or l_returnflag not in ('A', 'N', 'R') union all select 'leaks', count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)
""")
def integrity_assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, o = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    known = o.select(F.col("o_orderkey").alias("l_orderkey"))
    one = lambda name, df, n=F.count("*"): df.agg(n.alias("found")).select(F.lit(name).alias("rule"), "found")
    checks = [one("self loops", l.where("l_partkey = l_suppkey")), one("out of enum", l.where("l_returnflag is null or l_returnflag not in ('A', 'N', 'R')")), one("leaks", l.join(known, "l_orderkey", "left_anti"))]
    out = one("statuses", o, F.countDistinct("o_orderstatus"))
    for c in checks:
        out = out.unionByName(c)
    return out


@query("select o_orderkey, o_orderstatus, o_orderpriority from orders where o_orderstatus = 'F' and (cast(null as varchar) is null or o_orderpriority = cast(null as varchar)) and o_totalprice >= 100000")
def task_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters that are not given hold for every row."""
    o = read(spark, sf_dir, "orders")
    for column, wanted in {"o_orderstatus": "F", "o_orderpriority": None}.items():
        o = o.where(F.col(column) == wanted) if wanted is not None else o
    return o.where("o_totalprice >= 100000").select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("""
with t as (select max(ts) as now from events)
select p.name as period, round(sum(value) filter (where ts > now - p.span), 4) as cost, count(*) filter (where ts > now - p.span) as calls
from events, t, (values ('day', interval 1 day), ('week', interval 7 day), ('month', interval 30 day)) p(name, span) group by 1
""")
def period_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost of the periods that end with the last event; one pass after its time is known."""
    e = read(spark, sf_dir, "events").select("ts", "value")
    now = e.agg(F.max("ts").alias("now"))
    age = {name: F.col("ts") > F.col("now") - F.expr(f"interval {days} days") for name, days in (("day", 1), ("week", 7), ("month", 30))}
    sums = e.join(F.broadcast(now), F.lit(True)).agg(*[F.struct(F.lit(n).alias("period"), F.round(F.sum(F.when(a, F.col("value"))), 4).alias("cost"), F.count_if(a).alias("calls")).alias(n) for n, a in age.items()])  # one row is broadcast
    return sums.select(F.inline(F.array(*age)))


@query("""
with c(name, capacity) as (values ('click', 2), ('view', 1), ('purchase', 3), ('idle', 4)), x as (select event_type, event_id, row_number() over (partition by event_type order by ts desc, event_id) as r, count(*) over (partition by event_type) as n from events where value > 30)
select name, capacity, coalesce(max(n), 0) as used, greatest(capacity - coalesce(max(n), 0), 0) as free, string_agg(event_id::varchar, ',' order by r) filter (where r <= 3) as holders from c left join x on event_type = name group by 1, 2
""")
def slot_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    capacity = spark.createDataFrame([("click", 2), ("view", 1), ("purchase", 3), ("idle", 4)], "name string, capacity int")
    live = read(spark, sf_dir, "events").where("value > 30").withColumnRenamed("event_type", "name")
    newest = ops.top_n(live, ["name"], [F.desc("ts"), F.col("event_id")], 3).groupBy("name").agg(F.array_sort(F.collect_list(F.struct("rank", "event_id"))).alias("h"))
    met = capacity.join(live.groupBy("name").agg(F.count("*").alias("n")), "name", "left").join(newest, "name", "left")
    used = F.coalesce("n", F.lit(0)).cast("long")
    return met.select("name", "capacity", used.alias("used"), F.greatest(F.col("capacity") - used, F.lit(0)).cast("long").alias("free"), F.array_join(F.transform("h", lambda x: x["event_id"].cast("string")), ",").alias("holders"))
