"""Readers and writers of record files."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..session import cut


def jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Line-delimited JSON; blank, broken and non-object lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def books(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines of many books, with the folder above each file's own as book_id, and the file as file and path."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).select("*", F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+/[^/]+$", 1).alias("book_id"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("path"))


def preferred(df: DataFrame, book: str, kind: str, order: Sequence[str]) -> DataFrame:
    """Of each book the rows of its best kind of source, in an order of kinds; books that begin with _ or . are left out. Only (book, kind) pairs are ranked."""
    place = F.coalesce(*[F.when(F.col(kind) == k, F.lit(i)) for i, k in enumerate(order)], F.lit(len(order)))
    best = df.select(book, kind).distinct().groupBy(book).agg(F.min_by(kind, place).alias("_kind"))
    return df.where(~F.col(book).rlike(r"^[_.]")).join(best, book).where(F.col(kind) == F.col("_kind")).drop("_kind")


def documents_per_file(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON document per file (an object, or an array of rows), with the file's stem as id."""
    return spark.read.schema(schema).option("multiLine", True).json(path).select("*", F.regexp_extract("_metadata.file_name", r"^(.*?)(?:\.json)?$", 1).alias("file_id"))


def repaired(text: Column) -> Column:
    """JSON text as a variant; text that only lacks its last brace is completed, other broken text is null."""
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(F.concat(text, F.lit("}"))))


def lifted(text: Column, inside: str, fields: Sequence[str]) -> Column:
    """A struct of fields as JSON text (from the top, or else misplaced within an object), and parse_error (text that can't be read even when repaired)."""
    v = repaired(text)
    get = lambda path: F.to_json(F.try_variant_get(v, path, "variant"))
    return F.struct(*[F.coalesce(get(f"$.{f}"), get(f"$.{inside}.{f}")).alias(f) for f in fields], v.isNull().alias("parse_error"))


def csv(spark: SparkSession, path: str, rename: dict[str, str] | None = None, nested: bool = False) -> DataFrame:
    """All columns as strings, without a byte order mark; a header that holds a key of rename is named by its value. nested: files of all folders below."""
    df = spark.read.option("recursiveFileLookup", nested).csv(path, header=True, encoding="UTF-8")
    df = df.withColumnsRenamed({c: c.removeprefix("\ufeff") for c in df.columns})
    for part, name in (rename or {}).items():
        df = df.withColumnsRenamed({c: name for c in df.columns if part in c})
    return df


def first_of_each(df: DataFrame, item: str, order: str) -> DataFrame:
    """The first row of each item, whatever its case."""
    return df.groupBy(F.lower(F.col(item)).alias("_k")).agg(F.min_by(F.struct(*df.columns), order).alias("x")).select("x.*")


def without_done(df: DataFrame, done: DataFrame, id: str) -> DataFrame:
    """Rows whose id isn't processed yet."""
    return df.join(done.select(id).distinct(), id, "left_anti")


def changed(now: DataFrame, before: DataFrame) -> DataFrame:
    """Of two manifests (path, sha256): path and what happened: new, changed or gone; files that are as they were aren't listed."""
    old = before.select("path", F.col("sha256").alias("old"))
    state = F.when(F.col("old").isNull(), "new").when(F.col("sha256").isNull(), "gone").when(F.col("sha256") != F.col("old"), "changed")
    return now.select("path", "sha256").join(old, "path", "full").select("path", state.alias("state")).where("state is not null")


def write_valid(df: DataFrame, path: str, required: list[str]) -> DataFrame:
    """Appends rows that have all required fields as JSON lines; returns the others."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    df.where(ok).write.mode("append").json(path)
    return df.where(~ok)


def write_csv(df: DataFrame, path: str, order: str | None = None) -> None:
    """CSV with a header; nested fields as JSON text, nulls as empty, rows in an order."""
    at = {c: F.col(f"`{c}`") for c in df.columns}
    nested = [F.to_json(at[c], {"sortKeys": "true"}).alias(c) if t.startswith(("array", "struct", "map")) else at[c] for c, t in df.dtypes]
    rows = df.orderBy(order) if order else df
    rows.select(*nested).write.option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def write_ranked(df: DataFrame, path: str, order: Sequence[Column], n: int) -> None:
    """The first n rows in an order, with rank 1 to n, as CSV."""
    top = df.orderBy(*order).limit(n)
    top.withColumn("rank", F.row_number().over(Window.orderBy(*order))).write.option("header", True).csv(path)  # n rows in one window


def write_buckets(df: DataFrame, path: str, bucket: str, leave_out: tuple[str, ...] = ()) -> None:
    """One folder per bucket, in one pass."""
    df.where(~F.col(bucket).isin(*leave_out)).write.partitionBy(bucket).parquet(path)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str, id: str = "id") -> None:
    """Nodes and edges (source, target, type) as Parquet, edges by type; an edge is written only if both its ends are nodes."""
    ends = nodes.select(id).distinct()
    held = edges.join(ends.withColumnRenamed(id, "source"), "source", "left_semi").join(ends.withColumnRenamed(id, "target"), "target", "left_semi")
    nodes.write.parquet(f"{path}/nodes")
    held.write.partitionBy("type").parquet(f"{path}/edges")


def write_pages(df: DataFrame, path: str, book: str, page: str, text: str) -> None:
    """A book's pages in order, joined by blank lines, as one Markdown row each; a book is gathered whole, as it is one document."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(page, text))), lambda p: F.coalesce(p[text], F.lit(""))), "\n\n")
    df.groupBy(book).agg(joined.alias("markdown")).write.parquet(path)


def write_report(df: DataFrame, path: str, names: Sequence[str]) -> None:
    """A small summary (one row) as one JSON object, its columns under the names in order."""
    df.select(F.to_json(F.struct(*names)).alias("value")).coalesce(1).write.text(path)


def versioned(spark: SparkSession, path: str, make: Callable[[DataFrame | None], DataFrame], tries: int = 20) -> str:
    """Writes the next version of a table of versions (path/v=1, 2, ...), what make makes of the last one (None for the first). Returns its path.

    A version is written beside the others and then renamed, which is one step, so it is there whole or not at all; what a writer left that
    failed half-way is no version. Of two writers at once one has the next number, and the other begins again from what that one wrote.
    """
    for _ in range(tries):
        last = _versions(spark, path)
        new = f"{path}/v={(last[-1] if last else 0) + 1}"
        beside = f"{path}/_writing-{uuid.uuid4().hex}"
        make(spark.read.parquet(f"{path}/v={last[-1]}") if last else None).write.parquet(beside)
        if _renamed(spark, beside, new):
            return new
        fs, at = _fs(spark, beside)
        fs.delete(at, True)
    raise RuntimeError(f"{tries} other writers came first")


def upserted(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str]) -> str:
    """The next version: the rows of the last one, but for those whose keys changes has, and changes."""
    gone = changes.select(*keys).distinct()
    return versioned(spark, path, lambda old: changes if old is None else old.join(gone, list(keys), "left_anti").unionByName(changes))


def purged(spark: SparkSession, path: str, label: str, labels: Sequence[str]) -> DataFrame:
    """The next version without the rows that bear one of these labels. Returns label, n_removed: one row for each of them, 0 for those that weren't there."""
    before = _versions(spark, path)
    if not before:
        raise ValueError(f"{path} has no version")
    new = versioned(spark, path, lambda old: old.where(~F.coalesce(F.col(label).isin(*labels), F.lit(False))))
    last = int(new.rsplit("=", 1)[1]) - 1
    counts = spark.read.parquet(f"{path}/v={last}").where(F.col(label).isin(*labels)).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    wanted = spark.createDataFrame([(x,) for x in dict.fromkeys(labels)], "label string")
    return wanted.join(counts, "label", "left").select("label", F.coalesce("n", F.lit(0)).cast("long").alias("n_removed"))


def ingested(spark: SparkSession, folder: str, store: str, suffix: str = "*") -> str:
    """The next version of a store of files (path, bytes, changed, sha256, content, run): only files that are new or differ in size or time are read.

    Those whose content is known already, under any name, keep its run; files that are gone leave the store. The driver sees the paths of the files to
    be read, no others.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", suffix).load(folder)
    listed = cut(listed.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("changed")))  # contents are not read

    def make(old: DataFrame | None) -> DataFrame:
        known = old.select("path", "bytes", "changed") if old is not None else None
        stale = listed.join(known, ["path", "bytes", "changed"], "left_anti") if known is not None else listed
        paths = [r[0] for r in stale.select("path").collect()]
        run = (old.agg(F.max("run")).first()[0] or 0) + 1 if old is not None else 1
        read = spark.read.format("binaryFile").load(paths) if paths else spark.read.format("binaryFile").load(folder).limit(0)
        fresh = read.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"), F.sha2("content", 256).alias("sha256"), "content")
        if old is None:
            return fresh.withColumn("run", F.lit(run))
        before = old.groupBy("sha256").agg(F.min("run").alias("_run"))
        told = fresh.join(before, "sha256", "left").withColumn("run", F.coalesce("_run", F.lit(run))).select(*old.columns)
        return old.join(listed.select("path", "bytes", "changed"), ["path", "bytes", "changed"], "left_semi").unionByName(told)

    return versioned(spark, store, make)


def _renamed(spark: SparkSession, before: str, after: str) -> bool:
    """Whether the folder has its new name; False if that was taken."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    hadoop = jvm.org.apache.hadoop.fs
    path = hadoop.Path(after)
    files = hadoop.FileContext.getFileContext(path.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) if path.toUri().getScheme() else hadoop.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(hadoop.Path(before), path, gateway.new_array(hadoop.Options.Rename, 0))  # refuses a name that is there
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    return True


def replaced(spark: SparkSession, folder: str, rows: DataFrame | None) -> None:
    """Puts other JSON lines into a folder's place, or none."""
    fs, at = _fs(spark, folder)
    fs.delete(at, True)
    if rows is not None:
        rows.write.json(folder)


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, at = _fs(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    whole = lambda name: fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS"))
    return sorted(int(n.removeprefix("v=")) for n in names if n.startswith("v=") and n.removeprefix("v=").isdigit() and whole(n))


def digest(df: DataFrame) -> tuple[int, str]:
    """The number of rows, and a sum of their hashes that no order changes."""
    row = df.agg(F.count("*"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first()
    return row[0], str(row[1])


def snapshot(df: DataFrame, path: str, tag: str) -> dict:
    """Writes df under a tag, with the number of rows and a digest beside it; a tag that is there already is refused."""
    spark, at = df.sparkSession, f"{path}/{tag}"
    fs, where = _fs(spark, at)
    if fs.exists(where):
        raise ValueError(f"snapshot {tag} is there already")
    df.write.parquet(f"{at}/rows")
    n, hashed = digest(spark.read.parquet(f"{at}/rows"))
    about = {"tag": tag, "rows": n, "digest": hashed}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{at}/about")
    return about


def restored(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """The rows of a snapshot; they are counted and digested first, and refused if they aren't what was written."""
    about = json.loads(spark.read.text(f"{path}/{tag}/about").first()[0])
    rows = spark.read.parquet(f"{path}/{tag}/rows")
    if digest(rows) != (about["rows"], about["digest"]):
        raise ValueError(f"snapshot {tag} is damaged")
    return rows


def through(spark: SparkSession, write: Callable[[str], object], read: Callable[[str], DataFrame]) -> DataFrame:
    """What read finds in a folder of its own that write has filled; the folder is removed once its rows are kept."""
    cut(spark.range(0))  # sets the checkpoint folder where none is set
    path = f"{spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4().hex}"
    write(path)
    out = cut(read(path))
    fs, at = _fs(spark, path)
    fs.delete(at, True)
    return out


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes and sha256 of each file."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
