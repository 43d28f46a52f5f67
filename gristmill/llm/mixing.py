"""Mixing sources to target weights by entropy balancing, with DataFrame operations only.

Of all document rates r between 0 and a most, those that meet each source's token target and stay closest to 1 in relative entropy are
exponentially tilted: r = min(most, exp(lambda * size / mean size)), with one multiplier per source. The multipliers solve the convex dual
problem. Its gradient and curvature are sums over documents, so a Newton step for all sources is one aggregation over the table of distinct
(source, size) pairs; a bracket around each multiplier replaces steps that leave it. The rates are then rounded into whole copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .session import cut

WORD = r"[^\x20\x09-\x0D]+"


def sizes(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(per_source: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Of (source, tokens), with cap = most * tokens, adds target: share of all tokens by weight, where what a cap cuts off goes to the others by weight.

    Sources are numbered by code point, null last, and take the weights in turn. If sources are taken in the order of cap / weight, those
    that their cap binds come first; the others share what these leave, in proportion to their weights.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    numbered = per_source.withColumn("sid", F.row_number().over(by_name) - 1)
    numbered = numbered.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int")))
    numbered = numbered.withColumn("cap", F.lit(float(most)) * F.col("tokens"))
    every, so_far = Window.partitionBy(), Window.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(float(share)) * F.sum("tokens").over(every) - F.coalesce(F.sum("cap").over(so_far), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(so_far), F.lit(0.0)))
    return numbered.withColumn("_level", level).withColumn("target", F.least(F.col("cap"), F.max("_level").over(every) * F.col("weight"))).drop("_level")


def multipliers(histogram: DataFrame, state: DataFrame, most: float, tolerance: float = 1e-9, newton_steps: int = 40) -> DataFrame:
    """Newton iterations. histogram: sid, size, n; state: sid, tokens, docs, target. Adds lambda (to 12 places) to state; 0 where the cap itself is the target.

    A source that so many Newton steps have not solved is finished by bisection: its bracket is doubled until it is closed, and then halved.
    """
    unit = F.col("tokens") / F.col("docs")  # sizes are measured in means, so multipliers are comparable
    state = cut(state.withColumns({"unit": unit, "lam": F.lit(0.0), "lo": F.lit(float("-inf")), "hi": F.lit(float("inf")), "open": (F.col("tokens") > 0) & (F.col("target") < most * F.col("tokens") * (1 - 1e-12))}))
    log_most = F.log(F.lit(float(most)))
    steps = 0
    while not state.where("open").isEmpty():
        steps += 1
        size = F.col("size") / F.col("unit")
        tilt = F.col("lam") * size
        rate = F.exp(F.least(tilt, log_most))
        step = histogram.join(state.where("open").select("sid", "unit", "lam"), "sid").groupBy("sid").agg(F.sum(F.col("n") * size * rate).alias("_got"), F.sum(F.when(tilt < log_most, F.col("n") * size * size * rate).otherwise(0.0)).alias("_bend"))
        met = state.join(step, "sid", "left").withColumn("_gap", F.col("_got") - F.col("target") / F.col("unit"))
        lo = F.when(F.col("_gap") < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(F.col("_gap") >= 0, F.col("lam")).otherwise(F.col("hi"))
        met = met.withColumns({"lo": lo, "hi": hi, "_newton": F.col("lam") - F.col("_gap") / F.when(F.col("_bend") > 0, F.col("_bend"))})
        beyond = F.when(F.col("lo") == float("-inf"), F.col("hi") - 1 - F.abs("hi")).when(F.col("hi") == float("inf"), F.col("lo") + 1 + F.abs("lo")).otherwise((F.col("lo") + F.col("hi")) / 2)
        inside = (F.col("_newton") > F.col("lo")) & (F.col("_newton") < F.col("hi")) & (F.abs(F.col("_newton") - F.col("lam")) <= 4 + 4 * F.abs("lam"))
        inside = inside if steps <= newton_steps else F.lit(False)
        done = F.abs("_gap") <= tolerance * F.col("target") / F.col("unit")
        narrow = (F.col("hi") - F.col("lo")) <= 1e-13 * (1 + F.abs("lam"))
        state = cut(met.select("sid", "tokens", "docs", "target", "unit", F.when(F.col("open") & ~done, F.when(inside, F.col("_newton")).otherwise(beyond)).otherwise(F.col("lam")).alias("lam"), "lo", "hi", (F.col("open") & ~F.coalesce(done | narrow, F.lit(False))).alias("open")))
    # Sums come in the order of the shuffle, so their last digits differ between runs; the multipliers' don't.
    return state.withColumn("lam", F.round("lam", 12))


def mix(docs: DataFrame, source: str = "source", text: str = "text", order: tuple[str, ...] = ("doc_id",), keep: tuple[str, ...] = ("doc_id",), weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: int = 2, block: int = 512) -> DataFrame:
    """Per row the kept columns and size, source_size, target, rate and copies (0 to most).

    Rounding: a source's rows are dealt over blocks of about so many rows by a hash (of order and text), and in a block, from the largest to the smallest, each
    row gets the number of copies that brings what the block took closest to what the rates owe so far. What a block is off in the end is
    about half its smallest documents. Blocks are rows of the shuffle; a source of any size is only more blocks.

    A null or empty text has size 0, copies 1 and takes nothing. A null source is a source of its own, the last. Repeated rows are rounded
    one by one. A null in order sorts first. An empty table gives no rows. The sources, one small row each, meet in one task; documents don't.
    """
    size = sizes(text)
    named = docs.select(F.struct(*keep).alias("row"), F.struct(*order, F.xxhash64(text).alias("_text_hash")).alias("_o"), F.col(source).alias("source"), size.alias("size"))
    light = set(keep) <= set(order)
    rows = cut(named) if light else named
    histogram = cut(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    per_source = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("tokens"), F.sum("n").alias("docs"))
    aims = cut(targets(per_source, weights, share, most))
    numbered = cut(histogram.join(aims.select("source", "sid"), histogram.source.eqNullSafe(aims.source)).select("sid", "size", "n"))
    solved = multipliers(numbered, aims.select("sid", "tokens", "docs", "target"), most)
    plan = cut(aims.select("sid", F.col("source").alias("_source"), F.col("target")).join(solved.drop("target"), "sid"))

    at_cap = F.col("target") >= most * F.col("tokens") * (1 - 1e-12)
    rate = F.when(F.col("tokens") == 0, 1.0).when(at_cap, F.lit(float(most))).otherwise(F.exp(F.least(F.col("lam") * F.col("size") / F.col("unit"), F.log(F.lit(float(most))))))
    dealt = rows.join(plan, rows.source.eqNullSafe(plan._source)).select(
        "sid", "tokens", "target", F.pmod(F.xxhash64("_o"), F.ceil(F.col("docs") / block)).alias("_block"), F.struct((-F.col("size")).alias("less"), "_o", rate.alias("rate"), "size", "row").alias("d")
    )
    blocks = dealt.groupBy("sid", "_block").agg(F.first("tokens").alias("source_size"), F.first("target").alias("target"), F.sort_array(F.collect_list("d")).alias("ds"))

    def place(state: Column, d: Column) -> Column:
        owed = state["owed"] + d["rate"] * d["size"]
        copies = F.when(d["size"] == 0, F.lit(1)).otherwise(F.greatest(F.lit(0), F.least(F.lit(most), F.round((owed - state["took"]) / d["size"]).cast("int"))))
        return F.struct(owed.alias("owed"), (state["took"] + copies * d["size"]).alias("took"), F.concat(state["copies"], F.array(copies)).alias("copies"))

    zero = F.struct(F.lit(0.0).alias("owed"), F.lit(0).cast("long").alias("took"), F.expr("cast(array() as array<int>)").alias("copies"))
    rounded = blocks.withColumn("copies", F.aggregate("ds", zero, place, lambda s: s["copies"])).select("source_size", "target", F.explode(F.arrays_zip("ds", "copies")).alias("z"))
    return rounded.select("z.ds.row.*", F.col("z.ds.size").alias("size"), "source_size", "target", F.col("z.ds.rate").alias("rate"), F.col("z.copies").alias("copies"))


def repeated(docs: DataFrame, source: str = "source", text: str = "text", id: str = "doc_id", **more) -> DataFrame:
    """The mix itself: the rows of docs, with all their columns, as often as their copies say."""
    columns = docs.columns
    flat = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    at = {c: f"c{i}" for i, c in enumerate(columns)}
    mixed = mix(flat, at[source], at[text], (at[id],), tuple(flat.columns), **more)
    return mixed.withColumn("_copy", F.explode(F.expr("sequence(1, copies)"))).where("copies > 0").select(*[F.col(at[c]).alias(c) for c in columns]) if columns else docs


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies")
