"""Operators over extracted records: field errors, packing of paragraphs, sections under headings, and a heat solver."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..session import cut, ship
from .tables import small


def field_errors(required: Sequence[str]) -> Column:
    """An array of messages, one for each required field that is null or ''."""
    missing = [F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(f"missing field: {c}")) for c in required]
    return F.array_compact(F.array(*missing))


def packed(parts: Column, most: int, joint: str = "\n") -> Column:
    """An array of chunks: parts are joined in order as long as a chunk stays within most characters; a longer part is a chunk of its own."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def step(s: Column, part: Column) -> Column:
        fits = s["open"].isNotNull() & (F.char_length(s["open"]) + len(joint) + F.char_length(part) <= most)
        closed = F.when(s["open"].isNull(), s["done"]).otherwise(F.array_append(s["done"], s["open"]))
        return F.struct(F.when(fits, s["done"]).otherwise(closed).alias("done"), F.when(fits, F.concat(s["open"], F.lit(joint), part)).otherwise(part).alias("open"))

    return F.aggregate(F.filter(parts, lambda p: p.isNotNull()), start, step, lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.array_append(s["done"], s["open"])))


def sections(df: DataFrame, id: str, text: str, heading: str) -> DataFrame:
    """id, section, title, n_lines, n_chars: the lines from one heading (a pattern) up to the next; section 0 has none and may be missing."""
    lines = df.select(id, F.posexplode(F.split(text, "\n")).alias("pos", "line")).withColumn("head", F.col("line").rlike(heading))
    numbered = lines.withColumn("section", F.sum(F.col("head").cast("long")).over(Window.partitionBy(id).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(id, "section").agg(F.min(F.when(F.col("head"), F.col("line"))).alias("title"), F.count("*").alias("n_lines"), F.sum(F.char_length("line")).alias("n_chars"))


def heat_slab(df: DataFrame, id: str, nodes: int = 21, fo: float = 0.4) -> DataFrame:
    """id, centre, surface, mean after seconds t: a slab heated on both faces, by the explicit scheme on half of it (a mirror at the centre).

    Columns: half (half thickness, m), alpha (m2/s), k (W/(m K)), h (W/(m2 K)), T0, Tinf, t. The step keeps both the Fourier number and the
    convective face stable. The scheme is linear: what is left of the difference T0 - Tinf depends on the other five columns alone. So each
    different slab is solved once, for a difference of 1, and the slabs are dealt over all tasks.
    """
    names, shape = ["half", "alpha", "k", "h", "T0", "Tinf", "t"], ["half", "alpha", "k", "h", "t"]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = _left_over(*(c.to_numpy(zero_copy_only=False) for c in batch.columns), nodes, fo)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, left)], names=[*shape, "_centre", "_surface", "_mean"])

    ship(df.sparkSession)
    usable = df.select(F.col(id).cast("long").alias(id), *[F.col(c).cast("double").alias(c) for c in names]).dropna()
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    solved = cut(usable.select(*shape).distinct().repartition(tasks, *shape).mapInArrow(solve, ", ".join(f"{c} double" for c in [*shape, "_centre", "_surface", "_mean"])))
    at = lambda u: F.col("Tinf") + (F.col("T0") - F.col("Tinf")) * F.col(u)
    return usable.join(small(solved), shape).select(id, *[at(f"_{c}").alias(c) for c in ("centre", "surface", "mean")])


def _left_over(half: np.ndarray, alpha: np.ndarray, k: np.ndarray, h: np.ndarray, t: np.ndarray, nodes: int, fo: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What share of the difference to the surroundings is left at the centre, at the surface and on average; slabs advance together, and each leaves after its own last step."""
    dx = half / (nodes - 1)
    biot = h * dx / k
    steps = np.maximum(1, np.ceil(alpha * t * (1 + biot) / (fo * dx**2))).astype(np.int64)
    r = alpha * t / steps / dx**2
    order = np.argsort(-steps, kind="stable")
    steps, r, biot = steps[order], r[order], biot[order]
    field = np.ones((nodes, len(steps)))  # a node's slabs lie together, those with most steps first
    for n in range(int(steps.max(initial=0))):
        going = int(np.searchsorted(-steps, -n, "left"))
        u, q = field[:, :going], r[:going]
        new = np.empty_like(u)
        new[1:-1] = u[1:-1] + q * (u[2:] - 2 * u[1:-1] + u[:-2])
        new[0] = u[0] + 2 * q * (u[1] - u[0])
        new[-1] = u[-1] + 2 * q * (u[-2] - u[-1] - biot[:going] * u[-1])
        field[:, :going] = new
    mean = (field[0] / 2 + field[1:-1].sum(axis=0) + field[-1] / 2) / (nodes - 1)
    back = np.argsort(order)
    return field[0][back], field[-1][back], mean[back]


def topped_up(df: DataFrame, by: Sequence[str], stratum: str, wanted: dict, order: Sequence[str]) -> DataFrame:
    """So many rows of each stratum of a group, the first in an order; a group that stays short is filled up with its next rows of any stratum. Adds topped_up."""
    most = sum(wanted.values())
    share = F.coalesce(*[F.when(F.col(stratum) == F.lit(k), F.lit(n)) for k, n in wanted.items()], F.lit(0))
    # No more than the first `most` rows of a stratum can be taken, and Spark cuts each group to them before it moves them.
    ranked = df.withColumn("_k", F.row_number().over(Window.partitionBy(*by, stratum).orderBy(*order))).where(F.col("_k") <= most)
    taken, rest = ranked.where(F.col("_k") <= share), ranked.where(F.col("_k") > share)
    lacking = taken.groupBy(*by).agg((F.lit(most) - F.count("*")).alias("_lack"))
    more = rest.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).join(lacking, list(by)).where(F.col("_r") <= F.col("_lack"))
    return taken.drop("_k").withColumn("topped_up", F.lit(False)).unionByName(more.drop("_k", "_r", "_lack").withColumn("topped_up", F.lit(True)))


def gapped_sections(df: DataFrame, id: str, text: str, heading: str, gap: int) -> DataFrame:
    """id, begins, n_lines: sections between headings, where a heading counts only so many lines or more after the last that counted; lines before the first are no section.

    Only the numbers of a text's headings and of its lines are gathered.
    """
    lines = F.split(text, "\n")
    heads = F.filter(F.transform(lines, lambda line, i: F.when(line.rlike(heading), i)), lambda i: i.isNotNull())
    counted = F.aggregate(heads, F.array().cast("array<int>"), lambda s, i: F.when((F.size(s) == 0) | (i - F.try_element_at(s, F.lit(-1)) >= gap), F.array_append(s, i)).otherwise(s))
    found = df.select(id, F.size(lines).alias("_n"), counted.alias("_s"))
    return found.select(id, "_n", "_s", F.posexplode("_s").alias("_k", "begins")).select(id, F.col("begins").cast("long").alias("begins"), (F.coalesce(F.get("_s", F.col("_k") + 1), F.col("_n")) - F.col("begins")).cast("long").alias("n_lines"))


#: The kinds of statement that there are.
STATEMENT_TYPES = ("fact_atom", "causal_chain", "compound_condition", "mathematical_law")
#: Marks that don't count when a quotation is looked for.
_MARKS = re.compile(r"\s|[，。、；：\u201c\u201d\u2018\u2019（）\[\]【】《》「」\-\u2014\u2026·]")


def _stands_in(quote: str, text: str) -> bool:
    """As it is, or without white space, marks and case, or with up to a tenth of other characters then (of five at least)."""
    if not quote or not text:
        return False
    if quote in text:
        return True
    own, whole = (_MARKS.sub("", x).lower() for x in (quote, text))
    if not own or own in whole:
        return bool(own)
    n = len(own)
    if n < 5 or n > len(whole):
        return False
    a, b = (np.array([ord(c) for c in x], np.uint32) for x in (own, whole))
    other = np.zeros(len(b) - n + 1, np.int32)
    for k in range(n):
        other += b[k : k + len(other)] != a[k]
    return bool((other <= max(1, n // 10)).any())


def checked(records: DataFrame, domains: DataFrame, statement: str = "statement", domain: str = "domain", citation: str = "citation", chunk: str = "chunk", kind: str = "kind", steps: str = "steps") -> DataFrame:
    """records with has_number, valid_domain, has_citation, citation_in_chunk, valid_type, causal_chain_format and passes (all but has_number).

    chunk is the text that the record is from, steps an array. A null is an empty text; a record without steps has none. domains (domain) are
    those that are valid. A citation is held against its own chunk only, whole, in Arrow batches; the work is the product of both lengths.
    """
    ship(records.sparkSession)
    plain = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    named = records.withColumns({"_cite": plain(citation), "_chunk": plain(chunk), "_domain": plain(domain)})

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_stands_in(q.as_py(), t.as_py()) for q, t in zip(batch.column("_cite"), batch.column("_chunk"), strict=True)]
            yield batch.append_column("citation_in_chunk", pa.array(found, pa.bool_()))

    looked = named.mapInArrow(look, StructType([*named.schema.fields, StructField("citation_in_chunk", BooleanType())]))
    known = domains.select(F.col("domain").alias("_domain")).distinct().withColumn("_known", F.lit(True))
    chain = F.when(plain(kind) == "causal_chain", F.coalesce(F.size(steps) >= 2, F.lit(False))).otherwise(F.lit(True))
    told = looked.join(known, "_domain", "left").withColumns({
        "has_number": F.coalesce(F.col(statement), F.lit("")).rlike("[0-9]"), "valid_domain": F.coalesce("_known", F.lit(False)), "has_citation": F.col("_cite") != "",
        "valid_type": plain(kind).isin(*STATEMENT_TYPES), "causal_chain_format": chain,
    })
    return told.withColumn("passes", F.expr("valid_domain and has_citation and citation_in_chunk and valid_type and causal_chain_format")).drop("_cite", "_chunk", "_domain", "_known")
