"""Queries that write the given tables as record files and read them back: what comes back is held against the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources import files
from .registry import query, read


@query("select conv_id, turn, role, text from conversations where role is not null and role <> '' and text is not null and text <> '' and turn % 5 < 4")
def jsonl_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows appended as JSON lines, read back beside broken lines, blank lines and lines that are no objects."""
    c = read(spark, sf_dir, "conversations").withColumn("role", F.when(F.col("turn") % 5 < 4, F.col("role")).otherwise(""))

    def write(path: str) -> None:
        files.write_valid(c, path, ["role", "text"])
        spark.createDataFrame([("{broken",), ("",), ("17",)], "value string").write.mode("append").text(path)

    return files.through(spark, write, lambda path: files.jsonl(spark, path, "conv_id long, turn long, role string, text string").where("conv_id is not null"))


@query("""
with d as (select *, case when doc_id % 3 = 0 then 'dedup' else 'open' end as kind, case when source = 'src1' then '_src1' else source end as book from documents), b as (select book, min(kind) as kind from d group by 1)
select book as book_id, kind as file, count(*) as n, min(doc_id) as first_doc from d join b using (book, kind) where not starts_with(book, '_') group by 1, 2
""")
def book_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines in a folder for each book and kind: the book comes from the path, and of each book the best kind that is there."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("source") == "src1", "_src1").otherwise(F.col("source")).alias("book"), F.when(F.col("doc_id") % 3 == 0, "dedup").otherwise("open").alias("kind"))
    made = d.select("doc_id", F.concat(F.lit("b-"), "book").alias("at"), "kind")

    def back(path: str) -> DataFrame:
        rows = files.books(spark, f"{path}/*/*", "doc_id long").select("doc_id", F.regexp_replace("book_id", "^at=b-", "").alias("book"), F.regexp_extract("path", "kind=([a-z]+)", 1).alias("kind"))
        return files.preferred(rows, "book", "kind", ["dedup", "open"])

    found = files.through(spark, lambda path: made.write.partitionBy("at", "kind").json(path), back)
    return found.groupBy(F.col("book").alias("book_id"), F.col("kind").alias("file")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query("select s_suppkey, case s_suppkey % 3 when 0 then s_name when 1 then s_name end as name, case s_suppkey % 3 when 0 then '[1,2]' when 1 then '[3]' end as roles, s_suppkey % 3 = 2 as parse_error from supplier")
def repaired_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose last brace is lost, whose fields lie in the wrong place, or that can't be read at all."""
    s = read(spark, sf_dir, "supplier")
    text = F.expr("""case s_suppkey % 3 when 0 then concat('{"name": "', s_name, '", "target": {"roles": [1, 2]}') when 1 then concat('{"target": {"name": "', s_name, '"}, "roles": [3]}') else concat('{"name": ', s_name) end""")
    x = files.through(spark, lambda path: s.select("s_suppkey", text.alias("text")).write.parquet(path), lambda path: spark.read.parquet(path).withColumn("x", files.lifted(F.col("text"), "target", ["name", "roles"])).select("s_suppkey", "x.*"))
    return x.select("s_suppkey", F.regexp_replace("name", '^"|"$', "").alias("name"), "roles", "parse_error")


@query("select n_nationkey::varchar as id, n_name as name, '[\"' || n_name || '\",' || n_regionkey || ']' as tags from nation")
def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with nested fields as JSON text and a header that is found by a part of its name."""
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("the id (No.)"), F.col("n_name").alias("name"), F.array(F.col("n_name"), F.col("n_regionkey").cast("string")).alias("tags"))
    back = files.through(spark, lambda path: files.write_csv(n, path, "name"), lambda path: files.csv(spark, path, {"(No.)": "id"}))
    return back.select("id", "name", F.regexp_replace("tags", r'"(\d+)"', "$1").alias("tags"))


@query("select rank::varchar as rank, p_partkey::varchar as p_partkey, p_name from (select *, row_number() over (order by p_size desc, p_partkey) as rank from part) where rank <= 25")
def ranked_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return files.through(spark, lambda path: files.write_ranked(p, path, [F.desc("p_size"), F.col("p_partkey")], 25), lambda path: files.csv(spark, path)).select("rank", "p_partkey", "p_name")


@query("select p_type as type, count(*) as n, min(lower(p_name)) as least from part where p_type <> 'PROMO' group by 1")
def bucket_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").withColumn("bucket", F.col("p_type"))
    back = files.through(spark, lambda path: files.write_buckets(p, path, "bucket", ("PROMO",)), lambda path: spark.read.parquet(path))
    return back.groupBy(F.col("bucket").alias("type")).agg(F.count("*").alias("n"), F.min(F.lower("p_name")).alias("least"))


@query("select l_returnflag as type, count(*) as n from lineitem where l_partkey in (select p_partkey from part where p_size > 10) and l_suppkey in (select s_suppkey from supplier where s_acctbal > 0) group by 1")
def graph_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges are written only where both ends are there."""
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    nodes = read(spark, sf_dir, "part").where("p_size > 10").select(name("p", "p_partkey").alias("id")).unionByName(read(spark, sf_dir, "supplier").where("s_acctbal > 0").select(name("s", "s_suppkey").alias("id")))
    edges = read(spark, sf_dir, "lineitem").select(name("p", "l_partkey").alias("source"), name("s", "l_suppkey").alias("target"), F.col("l_returnflag").alias("type"))
    return files.through(spark, lambda path: files.write_graph(nodes, edges, path), lambda path: spark.read.parquet(f"{path}/edges").groupBy("type").agg(F.count("*").alias("n")))


@query("select conv_id, string_agg(coalesce(text, ''), chr(10) || chr(10) order by turn) as markdown from conversations group by 1")
def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    return files.through(spark, lambda path: files.write_pages(c, path, "conv_id", "turn", "text"), spark.read.parquet)


@query("select c_custkey, c_name, case when c_custkey % 4 = 0 then c_acctbal + 1 else c_acctbal end as c_acctbal from customer where c_custkey % 9 > 0 or c_custkey % 4 = 0")
def upserted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a table: the second has the changes instead of the rows with their keys."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    changes = c.where("c_custkey % 4 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)

    def write(path: str) -> None:
        files.upserted(spark, path, c.where("c_custkey % 9 > 0"), ["c_custkey"])
        files.upserted(spark, path, changes, ["c_custkey"])

    return files.through(spark, write, lambda path: spark.read.parquet(f"{path}/v=2"))


@query("select p_partkey, p_name, p_size from part")
def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot that is restored after its rows have been checked."""
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return files.through(spark, lambda path: files.snapshot(p, path, "first"), lambda path: files.restored(spark, path, "first"))


@query("select lower(p_name) as item, min(p_partkey) as first_id, arg_min(p_brand, p_partkey) as brand from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 49) group by 1")
def resumed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is processed already is left out; of the rest the first of each item, whatever its case."""
    p, done = read(spark, sf_dir, "part"), read(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    rest = files.first_of_each(files.without_done(p, done, "p_partkey"), "p_name", "p_partkey")
    return files.through(spark, rest.write.parquet, spark.read.parquet).select(F.lower("p_name").alias("item"), F.col("p_partkey").alias("first_id"), F.col("p_brand").alias("brand"))


@query("select count(*)::varchar as n, max(o_orderkey)::varchar as last, count(distinct o_custkey)::varchar as customers from orders")
def report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last"), F.countDistinct("o_custkey").alias("customers"))
    return files.through(spark, lambda path: files.write_report(o, path, ["n", "last", "customers"]), lambda path: spark.read.text(path).select(F.from_json("value", "n string, last string, customers string").alias("x")).select("x.*"))


@query("select s_suppkey, s_acctbal + case when s_nationkey = 3 then 1 else 0 end as balance, case when s_nationkey = 3 then 2 else 1 end as run from supplier where s_nationkey <> 5")
def ingested_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers by nation as files, taken in twice: between the runs one file changes, one is written again as it was, and one goes; only what differs counts as new."""
    rows = read(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    by_nation = lambda df, path: df.coalesce(1).write.mode("overwrite").partitionBy("s_nationkey").json(path)

    def write(path: str) -> None:
        by_nation(rows, f"{path}/in")
        files.ingested(spark, f"{path}/in", f"{path}/store", "part-*")
        for nation, part in ((3, rows.where("s_nationkey = 3").withColumn("s_acctbal", F.col("s_acctbal") + 1)), (4, rows.where("s_nationkey = 4")), (5, None)):
            files.replaced(spark, f"{path}/in/s_nationkey={nation}", None if part is None else part.drop("s_nationkey").coalesce(1))
        files.ingested(spark, f"{path}/in", f"{path}/store", "part-*")

    def found(path: str) -> DataFrame:
        lines = spark.read.parquet(f"{path}/store/v=2").select("run", F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line")).where("line <> ''")
        return lines.select(F.from_json("line", "s_suppkey long, s_acctbal double").alias("r"), F.col("run").cast("int").alias("run")).select("r.s_suppkey", F.col("r.s_acctbal").alias("balance"), "run")

    return files.through(spark, write, found)


@query("select c_mktsegment as label, count(*) filter (where c_mktsegment in ('BUILDING', 'MACHINERY')) as n_removed, count(*) filter (where c_mktsegment not in ('BUILDING', 'MACHINERY')) as n_left from customer group by 1 union all select 'UNKNOWN', 0, 0")
def purged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two labels are purged from a table of versions, and one that nothing bears; what was removed and what is left by label."""
    def write(path: str) -> None:
        files.versioned(spark, f"{path}/t", lambda _: read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"))
        files.purged(spark, f"{path}/t", "c_mktsegment", ["BUILDING", "MACHINERY", "UNKNOWN"]).write.parquet(f"{path}/removed")

    def found(path: str) -> DataFrame:
        left = spark.read.parquet(f"{path}/t/v=2").groupBy(F.col("c_mktsegment").alias("label")).agg(F.count("*").alias("n_left"))
        both = spark.read.parquet(f"{path}/removed").join(left, "label", "full")
        return both.select("label", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_left", F.lit(0)).cast("long").alias("n_left"))

    return files.through(spark, write, found)
