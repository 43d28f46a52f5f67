"""URL rules by a sort-merge range join, with DataFrame operations only.

A host's labels in reverse order, each followed by a dot, make a key under which a host and all its subdomains are one interval: the keys
that begin with the host's key. Rules and urls are sorted together by key and swept. At a url, the rules whose interval is open are those on
the stack of the last rule that began before it (each rule carries the rules that enclose it) whose key begins the url's key. The sorted
table is cut into ranges, and each range starts with the stack that the ranges before it left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .session import cut

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def host_of(url: str) -> Column:
    host = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of_host(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def stacks(rules: DataFrame) -> DataFrame:
    """Of rules (host, path, verdict), for each key a row: key, stack array<struct<key, path, rule, verdict>> of the rules there and of those that enclose it.

    Every key is met with the prefixes of itself that end in a dot, by equality; no rule meets all others.
    """
    keyed = rules.select(key_of_host(F.col("host")).alias("key"), "path", F.concat("host", "path").alias("rule"), "verdict").distinct()
    keys = keyed.select("key").distinct()
    labels = F.split(F.col("key"), r"\.", -1)
    prefixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.when(i == F.size(labels), F.lit("")).otherwise(F.concat(F.array_join(F.slice(labels, 1, i), "."), F.lit("."))))
    open_at = keys.select(F.col("key").alias("at"), F.explode(F.array_distinct(prefixes)).alias("key"))
    return open_at.join(keyed, "key").groupBy("at").agg(F.sort_array(F.collect_list(F.struct("key", "path", "rule", "verdict"))).alias("stack")).withColumnRenamed("at", "key")


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",), otherwise: str = "allow", ranges: int = 0) -> DataFrame:
    """Per row of urls the kept columns, host, path, rule (null if none fits) and verdict.

    A rule fits if its host is the url's or a parent domain of it and the url's path starts with its path. The longest rule (host and path
    together) wins; of equally long ones that with the longer host, then block before allow. A null url, or one without ://, has an empty
    host and path; a rule with an empty host fits every host. Rows with a null host, path or verdict in rules are no rules. Repeated rows
    come out repeated. No rules: every url gets the default verdict. Rows are cut into ranges by key and then by a hash of the kept
    columns, so a host that holds a third of all urls is spread over many ranges. ranges: 0 for one per 200,000 rows (at least the
    session's shuffle partitions); the ranges themselves, one small row each, meet in one task.
    """
    spark = urls.sparkSession
    points = urls.select(F.struct(*keep).alias("row"), host_of(url).alias("host"), path_of(url).alias("path")).withColumn("key", key_of_host(F.col("host")))
    starts = stacks(rules.where("host is not null and path is not null and verdict is not null"))
    if not ranges:
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), urls.count() // 200_000 + 1)
    events = points.select("key", F.lit(1).alias("kind"), F.xxhash64("row").alias("tie"), "row", "host", "path", F.lit(None).cast(starts.schema["stack"].dataType).alias("stack")).unionByName(
        starts.select("key", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("tie"), F.lit(None).cast(points.schema["row"].dataType).alias("row"), F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"), "stack")
    )
    cut_up = cut(events.repartitionByRange(ranges, "key", "kind", "tie").withColumn("range", F.spark_partition_id()))
    left = cut_up.where("kind = 0").groupBy("range").agg(F.max_by("stack", "key").alias("last")).unionByName(cut_up.select("range").distinct().withColumn("last", F.lit(None).cast(starts.schema["stack"].dataType)))
    carried = left.groupBy("range").agg(F.first("last", True).alias("last")).withColumn("carried", F.last("last", True).over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))).select("range", "carried")
    sweep = Window.partitionBy("range").orderBy("key", "kind", "tie").rowsBetween(Window.unboundedPreceding, 0)
    swept = cut_up.withColumn("begun", F.last("stack", True).over(sweep)).where("kind = 1").join(carried, "range", "left")
    fitting = F.filter(F.coalesce("begun", "carried"), lambda r: F.col("key").startswith(r["key"]) & F.col("path").startswith(r["path"]))
    ranked = F.transform(fitting, lambda r: F.struct(F.char_length(r["rule"]).alias("n"), F.length(r["key"]).alias("k"), r["verdict"].alias("verdict"), r["rule"].alias("rule")))
    best = F.array_max(ranked)
    return swept.withColumn("best", best).select("row.*", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


#: DuckDB SQL for op8.
OP8_SQL = r"""
with u as (
  select page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
r(rhost, rpath, verdict) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m as (
  select u.page_id, u.host, u.path, r.rhost || r.rpath as rule, r.verdict,
    row_number() over (partition by u.page_id order by length(r.rhost || r.rpath) desc nulls last) as k
  from u left join r on (u.host = r.rhost or ends_with(u.host, '.' || r.rhost)) and starts_with(u.path, r.rpath))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from m where k = 1
"""
