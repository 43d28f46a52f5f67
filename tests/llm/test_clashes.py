"""The sharding stage on a table whose columns have the names that it adds."""

from pyspark.sql import functions as F

import corpus_pipeline
from gristmill.llm import sharding


def test_sharded_keeps_clashing_columns(spark):
    names = ["size", "text_crc32", "LAW", "shard", "slot", "_h", "_b", "c1", "c0", "rank", "shard_size"]
    rows = [(i, f"text {i % 7}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", *[F.lit(f"own {n}").alias(n) for n in names], "text")
    got = corpus_pipeline.shards(spark, docs, "").toPandas()
    assert list(got.columns) == [*docs.columns, "shard_size_2", "shard_text_crc32", "shard_law", "shard_shard", "shard_slot"]
    assert len(got) == 40 and all((got[n] == f"own {n}").all() for n in names)
    want = sharding.shard(docs.select("doc_id", "text")).toPandas().set_index("doc_id").loc[got.doc_id]
    assert (want["size"].values == got.shard_size_2).all() and (want.shard.values == got.shard_shard).all() and (want.slot.values == got.shard_slot).all() and (got.shard_law == "bytes").all()
    plain = corpus_pipeline.shards(spark, docs.select("doc_id", "text"), "")
    assert plain.columns == ["doc_id", "text", "size", "text_crc32", "law", "shard", "slot"]


def test_slots_follow_one_rule(spark):
    """Slots and shards of the first rows are in the same order whether a table is below or above what one block holds."""
    for n in (19_000, 21_000):
        docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 5000).alias("text"))
        got = sharding.shard(docs).join(docs, "doc_id").withColumn("h", F.xxhash64("doc_id", F.xxhash64(F.col("text").cast("binary")))).toPandas()
        got["h"] = got.h.to_numpy().view("uint64")
        for _, part in got.groupby("shard"):
            part = part.sort_values("h")
            assert list(part.slot) == list(range(len(part)))
        load = got.groupby("shard")["size"].sum()
        assert load.max() - load.min() <= 0.01 * load.mean()


def test_large_sizes_share_classes(spark):
    sizes = [1, 8191, 8192, 8193, 1_000_000, 1_000_001, 2**40 + 1]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in sizes], "s long").select(sharding._class_of(F.col("s"))).collect()]
    assert all(s <= c <= s * (1 + 1 / 4096) + 1 for s, c in zip(sizes, got)) and got[:2] == [1, 8191]
