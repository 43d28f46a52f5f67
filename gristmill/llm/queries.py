"""The registered queries of this subpackage and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, decontaminate, divergence, langid, merkle, mixing, packing, quality, sharding, simhash, substrings, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ivfpq": ann.op1,
    "op2_quality": quality.op2,
    "op3_mixing": mixing.op3,
    "op4_langid": langid.op4,
    "op5_substrings": substrings.op5,
    "op6_decontamination": decontaminate.op6,
    "op7_warc": warc.op7,
    "op8_url_filters": url_filter.op8,
    "op9_simhash": simhash.op9,
    "op10_sharding": sharding.op10,
    "op11_merkle": merkle.op11,
    "op12_divergence": divergence.op12,
    "op13_packing": packing.op13,
}

ORACLES: dict[str, str] = {
    "op5_substrings": substrings.OP5_SQL,
    "op6_decontamination": decontaminate.OP6_SQL,
    "op7_warc": warc.OP7_SQL,
    "op8_url_filters": url_filter.OP8_SQL,
    "op11_merkle": merkle.OP11_SQL,
    "op12_divergence": divergence.OP12_SQL,
}
