"""Names, units and values as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

#: Family, factor to the family's base unit.
UNITS = {
    "kg": ("mass", 1.0), "g": ("mass", 1e-3), "mg": ("mass", 1e-6), "lb": ("mass", 0.45359237), "oz": ("mass", 0.028349523125),
    "m": ("length", 1.0), "cm": ("length", 1e-2), "mm": ("length", 1e-3), "in": ("length", 0.0254),
    "s": ("time", 1.0), "min": ("time", 60.0), "h": ("time", 3600.0), "d": ("time", 86400.0),
    "pa": ("pressure", 1.0), "kpa": ("pressure", 1e3), "bar": ("pressure", 1e5), "psi": ("pressure", 6894.757293168),
    "l": ("volume", 1.0), "ml": ("volume", 1e-3), "j": ("energy", 1.0), "kj": ("energy", 1e3), "cal": ("energy", 4.184),
    "%": ("fraction", 0.01), "mg/kg": ("fraction", 1e-6), "ppm": ("fraction", 1e-6),
}


def normal_name(name: Column) -> Column:
    """Trimmed, lower-cased, inner white space as one space, without punctuation at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), r"\s+", " "), r"^[ .,;:!?\"'()\[\]{}`]+|[ .,;:!?\"'()\[\]{}`]+$", "")


def without_modifiers(name: Column, modifiers: tuple[str, ...]) -> Column:
    """The name without these words, each removed in turn wherever it stands alone."""
    padded = F.concat(F.lit(" "), name, F.lit(" "))
    for m in modifiers:
        padded = F.replace(padded, F.lit(f" {m} "), F.lit(" "))
    return F.trim(F.regexp_replace(padded, r"\s+", " "))


def slug(name: Column, most: int = 80) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "-"), r"^-+|-+$", ""), 1, most)


def si_value(value: Column, unit: Column) -> Column:
    """value times the factor of its unit; temperatures in C and F become K; null for units that aren't known."""
    unit = F.lower(F.trim(unit))
    out = F.when(unit == "k", value).when(unit == "c", value + 273.15).when(unit == "f", (value - 32) * 5 / 9 + 273.15)
    for name, (_, factor) in UNITS.items():
        out = out.when(unit == name, value * factor)
    return out


def parsed_value(text: Column) -> Column:
    """A number, or the middle of a range like 30-40 or [30, 40]; null for anything else."""
    number = r"[-+]?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"
    span = rf"^\s*\[?\s*({number})\s*(?:-|–|~|to|,)\s*({number})\s*\]?\s*$"
    low, high = (F.regexp_extract(text, span, k).try_cast("double") for k in (1, 2))
    return F.coalesce(F.when(text.rlike(rf"^\s*{number}\s*$"), F.trim(text).try_cast("double")), (low + high) / 2)


def plain_text(html: Column) -> Column:
    """HTML without scripts, styles and tags, with the five named entities decoded and white space collapsed."""
    out = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"[ \t\n\r\f\x0B]+", " "))


def cosine(a: Column, b: Column) -> Column:
    """0 for different lengths or a vector shorter than 1e-12."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when((F.size(a) == F.size(b)) & (norm(a) >= 1e-12) & (norm(b) >= 1e-12), dot / (norm(a) * norm(b))).otherwise(0.0)


def reply_json(text: Column) -> Column:
    """The JSON text in a model's reply: the reply itself without its thinking, else what is in its first fence, else from its first bracket to the last one; null if none of them parses."""
    stripped = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    said = stripped(F.regexp_replace(text, r"(?s)<think>.*?</think>", ""))
    parsed = lambda x: F.when(F.try_parse_json(x).isNotNull(), x)
    fenced, block = stripped(F.regexp_extract(said, r"(?s)```(?:json)?\s*(.*?)```", 1)), F.regexp_extract(said, r"(?s)(\[.*\]|\{.*\})", 1)
    return F.coalesce(parsed(F.nullif(said, F.lit(""))), parsed(F.nullif(fenced, F.lit(""))), parsed(F.nullif(block, F.lit(""))))


def reply_label(text: Column) -> Column:
    """The letter A to D that a reply settles on: the one after its first arrow, else the last one after a marker or alone on a line; null if there is none."""
    arrow = F.regexp_extract(text, r"(?:→|->|=>)\s*\*{0,2}([A-Da-d])\b", 1)
    marked = F.regexp_extract_all(text, F.lit(r"(?im)(?:label|answer|标签|答案)\s*[:：]\s*\*{0,2}[A-D]\b|^\s*[A-D]\s*[.。]?\s*$"), F.lit(0))
    last = F.regexp_extract(F.try_element_at(marked, F.lit(-1)), r"([A-Da-d])\s*[.。]?\s*$", 1)
    return F.upper(F.coalesce(F.nullif(arrow, F.lit("")), F.nullif(last, F.lit(""))))


def pages_of(spec: Column) -> Column:
    """'1-3, 7' as the sorted array 1, 2, 3, 7; a range may run backwards; null for a spec that is null or blank."""
    parts = F.filter(F.transform(F.split(spec, ","), lambda p: F.trim(p)), lambda p: p != "")
    ends = lambda p: F.transform(F.split(p, "-", 2), lambda x: F.trim(x).cast("int"))
    pages = F.transform(parts, lambda p: F.sequence(F.array_min(ends(p)), F.array_max(ends(p))))
    return F.when(F.trim(spec) != "", F.sort_array(F.array_distinct(F.flatten(pages))))


def natural_key(name: Column) -> Column:
    """The first number in a name, so that part2 comes before part10; names without one come first."""
    return F.coalesce(F.regexp_extract(name, r"(\d+)", 1).try_cast("long"), F.lit(-1).cast("long"))


def age(seconds: Column) -> Column:
    """5s, 3m, 2h or 4d; - for nothing."""
    whole = lambda n, unit: F.concat(F.floor(seconds / n).cast("string"), F.lit(unit))
    return F.when(seconds.isNull(), "-").when(seconds < 60, whole(1, "s")).when(seconds < 3600, whole(60, "m")).when(seconds < 86400, whole(3600, "h")).otherwise(whole(86400, "d"))


def sound_chunk(text: Column, least: int = 12) -> Column:
    """A chunk's text: out of a JSON object's text field, with written line ends made real; '' for few words without an end mark."""
    bare = F.trim(text)
    inner = F.trim(F.try_variant_get(F.try_parse_json(F.when(bare.rlike(r"(?s)^\{.*\}$"), bare)), "$.text", "string"))
    out = F.trim(F.replace(F.coalesce(F.nullif(inner, F.lit("")), bare), F.lit("\\n"), F.lit("\n")))
    return F.when((F.regexp_count(out, F.lit(r"(?U)\b\w+\b")) < least) & ~out.rlike("[.!?。！？]"), "").otherwise(out)


def chunk_fits(text: Column) -> Column:
    """180 to 400 CJK characters, or if there are none 120 to 320 words."""
    cjk, n = F.regexp_count(text, F.lit(r"[\x{4e00}-\x{9fff}]")), F.regexp_count(text, F.lit(r"(?U)\b\w+\b"))
    return F.when(cjk > 0, cjk.between(180, 400)).otherwise(n.between(120, 320))


def unicode_slug(name: Column, most: int = 80) -> Column:
    """Letters and digits of any script stay, the rest becomes single underscores."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), r"(?U)[^\w]+", "_"), "^_+|_+$", ""), 1, most)


def ingredient_key(name: Column, modifiers: tuple[str, ...], same: dict[str, str]) -> Column:
    """Lower-cased, without what is in brackets, end marks and leading modifiers (one word stays), and named as its synonyms are; names with CJK characters stay as they are."""
    plain = F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), r"\([^)]*\)", " "), r"\s+", " ")), r"[ .,;:]+$", "")
    short = F.regexp_replace(plain, rf"^(?:(?:{'|'.join(modifiers)})\s+)+(?=\S)", "")
    named = F.coalesce(*[F.when(short == a, F.lit(b)) for a, b in same.items()], short)
    return F.when(name.rlike(r"[\x{4e00}-\x{9fff}]"), name).otherwise(named)


def first_family(text: Column, families: dict[str, tuple[str, ...]], otherwise: str) -> Column:
    """The first family of which a word occurs in the text, in any case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.coalesce(*[F.when(reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words]), F.lit(name)) for name, words in families.items()], F.lit(otherwise))


def layered(text: Column, process: tuple[str, ...], mechanism: tuple[str, ...], result: tuple[str, ...], adjacent: dict[str, tuple[str, ...]], equipment: tuple[str, ...], static: tuple[str, ...]) -> Column:
    """A struct of label, rule and subtype by four layers, the first that holds: a process with a mechanism or result (_review), a neighbouring field
    without a process (_adjacent, with the field), equipment without process and mechanism (_l1_candidate), a static property without a process
    (_l2a_candidate); else _unclassified. Terms are looked up as they are written."""
    has = lambda terms: reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])
    field = F.coalesce(*[F.when(has(terms), F.lit(name)) for name, terms in adjacent.items()])
    said = lambda label, rule, subtype=None: F.struct(F.lit(label).alias("label"), F.lit(rule).alias("rule"), (F.lit(None).cast("string") if subtype is None else subtype).alias("subtype"))
    return (
        F.when(text.isNull() | (text == ""), said("_unclassified", "empty_text")).when(has(process) & (has(mechanism) | has(result)), said("_review", "process_plus_mechanism_or_result"))
        .when(field.isNotNull() & ~has(process), said("_adjacent", "adjacent_no_process", field)).when(has(equipment) & ~has(process) & ~has(mechanism), said("_l1_candidate", "equip_no_process_no_mechanism"))
        .when(has(static) & ~has(process), said("_l2a_candidate", "static_attribute_no_process")).otherwise(said("_unclassified", "default"))
    )


def symbols(expression: Column, builtin: tuple[str, ...]) -> Column:
    """The different identifiers of an expression, but for builtin ones, in order of their names."""
    return F.sort_array(F.array_except(F.array_distinct(F.regexp_extract_all(expression, F.lit(r"\b[A-Za-z_]\w*\b"), F.lit(0))), F.array(*map(F.lit, builtin))))


def split_by_bytes(text: Column, most: int) -> Column:
    """Pieces of at most so many UTF-8 bytes, cut at line ends; a longer line is a piece of its own."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def step(s: Column, line: Column) -> Column:
        fits = s["open"].isNotNull() & (F.octet_length(s["open"]) + 1 + F.octet_length(line) <= most)
        return F.struct(F.when(fits | s["open"].isNull(), s["done"]).otherwise(F.array_append(s["done"], s["open"])).alias("done"), F.when(fits, F.concat(s["open"], F.lit("\n"), line)).otherwise(line).alias("open"))

    return F.aggregate(F.split(text, "\n"), start, step, lambda s: F.array_append(s["done"], s["open"]))
