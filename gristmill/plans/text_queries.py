"""Queries over texts and replies: triage, buckets, filters, signals, formula candidates, labels, names, chunks and symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import physics, text as fn, unicode
from ..operators import tables as ops
from .registry import query, read

_TERMS = {"process": ("tioner", "mento"), "mechanism": ("therm", "lythe"), "result": ("ingest", "nderes"), "equipment": ("handre",), "static": ("thewhi", "enon")}
_FIELDS = {"water": ("ouquel",), "medical": ("cionado", "heiten"), "ecology": ("wierschen",)}


def _has(terms, c: str = "text") -> str:
    return "(" + " or ".join(f"contains({c}, '{t}')" for t in terms) + ")"


@query(f"""
select doc_id, case when text is null or text = '' then '_unclassified' when {_has(_TERMS['process'])} and ({_has(_TERMS['mechanism'])} or {_has(_TERMS['result'])}) then '_review' when {_has(sum(_FIELDS.values(), ()))} and not {_has(_TERMS['process'])} then '_adjacent'
  when {_has(_TERMS['equipment'])} and not {_has(_TERMS['process'])} and not {_has(_TERMS['mechanism'])} then '_l1_candidate' when {_has(_TERMS['static'])} and not {_has(_TERMS['process'])} then '_l2a_candidate' else '_unclassified' end as label,
  case when coalesce(text, '') <> '' and not ({_has(_TERMS['process'])} and ({_has(_TERMS['mechanism'])} or {_has(_TERMS['result'])})) and not {_has(_TERMS['process'])} then case {' '.join(f"when {_has(t)} then '{n}'" for n, t in _FIELDS.items())} end end as subtype from documents
""")
def triage_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = fn.layered(F.col("text"), _TERMS["process"], _TERMS["mechanism"], _TERMS["result"], _FIELDS, _TERMS["equipment"], _TERMS["static"])
    return read(spark, sf_dir, "documents").select("doc_id", x.alias("x")).select("doc_id", "x.label", "x.subtype")


@query("""
with f as (select user_id, arg_min(event_type, (ts, event_id)) as said from events where event_type <> 'error' group by 1)
select doc_id, case when lang = 'es' then 'clean' when source in ('src0', 'src1') then 'clean' when said = 'view' then 'l2a' when said = 'click' then 'l1' when said = 'purchase' then 'clean' when source in ('src2', 'src3') then 'l2a' when source in ('src4') then 'adjacent' when source = 'src5' then 'noise' else 'review' end as bucket
from documents left join f on user_id = doc_id
""")
def bucket_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags first, then labels that are sure, then the model's first answer, then the other labels; what is left is for review."""
    first = read(spark, sf_dir, "events").where("event_type <> 'error'").groupBy(F.col("user_id").alias("doc_id")).agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("said"))
    label, said = F.col("source"), F.col("said")
    rules = [(F.col("lang") == "es", "clean"), (label.isin("src0", "src1"), "clean"), (said == "view", "l2a"), (said == "click", "l1"), (said == "purchase", "clean"), (label.isin("src2", "src3"), "l2a"), (label == "src4", "adjacent"), (label == "src5", "noise")]
    return read(spark, sf_dir, "documents").join(first, "doc_id", "left").select("doc_id", ops.first_rule(rules, "review").alias("bucket"))


#: Replies as a model writes them: an arrow, a marker, a letter alone at the end, or none.
_REPLY = "case turn % 4 when 0 then concat('Because of A. → ', substr('ABCD', cast(conv_id % 4 + 1 as int), 1)) when 1 then concat('label: A', chr(10), 'thus Answer: ', substr('abcd', cast(conv_id % 4 + 1 as int), 1)) when 2 then concat('B-vitamin rich', chr(10), substr('ABCD', cast(conv_id % 3 + 1 as int), 1)) else 'Aroma only, maybe' end"


@query("""
select conv_id, turn, case turn % 4 when 0 then substr('ABCD', conv_id % 4 + 1, 1) when 1 then substr('ABCD', conv_id % 4 + 1, 1) when 2 then substr('ABCD', conv_id % 3 + 1, 1) end as label, turn % 4 = 3 as low_confidence, case when turn % 4 = 3 then '_review' when turn % 2 = 0 then '_review' else 'kept' end as gate from conversations
""")
def reply_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label in a model's reply; a reply that sounds unsure, or that none can be read from, is for review, as is every even turn."""
    c = read(spark, sf_dir, "conversations").withColumn("reply", F.expr(_REPLY))
    unsure = F.lower("reply").rlike("maybe|not sure|unclear")
    return c.select("conv_id", "turn", fn.reply_label(F.col("reply")).alias("label"), unsure.alias("low_confidence"), F.when(unsure | (F.col("turn") % 2 == 0), "_review").otherwise("kept").alias("gate"))


_SENSES = {"en": "(?i)(texture|crisp|tender|aroma|ouer|thewh)", "fr": "(saveur|croqu|ouiç|ellet)"}


@query(f"""
with k as (select source, doc_id, lang, case lang when 'en' then regexp_matches(text, '{_SENSES['en']}') when 'fr' then regexp_matches(text, '{_SENSES['fr']}') else length(text) > 500 end as keep from documents)
select source, count(*) as n, count(*) filter (where keep) as kept, count(*) filter (where keep and lang = 'en') as by_en, count(*) filter (where keep and lang = 'fr') as by_fr, count(*) filter (where not keep) as dropped, count(*) filter (where keep and quality = 1) as kept_good from k left join labels using (doc_id) group by 1
""")
def sensory_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pattern for each language decides; what it keeps and drops for each book, beside the results that are known."""
    t, lang = F.col("text"), F.col("lang")
    keep = F.when(lang == "en", t.rlike(_SENSES["en"])).when(lang == "fr", t.rlike(_SENSES["fr"])).otherwise(F.char_length(t) > 500)
    k = read(spark, sf_dir, "documents").select("source", "doc_id", "lang", keep.alias("keep")).join(read(spark, sf_dir, "labels"), "doc_id", "left")
    n = lambda c: F.count_if(F.col("keep") & c)
    return k.groupBy("source").agg(F.count("*").alias("n"), n(F.lit(True)).alias("kept"), n(lang == "en").alias("by_en"), n(lang == "fr").alias("by_fr"), F.count_if(~F.col("keep")).alias("dropped"), n(F.col("quality") == 1).alias("kept_good"))


_SIGNAL = """case event_id % 4 when 0 then concat('{"A": true, "C": ', case when value > 50 then 'true' else 'false' end, ', "confidence": 0.9}') when 1 then '<think>hm</think>{"signals": {"A": false, "B": true}, "confidence": 0.4}' when 2 then 'no json at all' else concat('here: {"D": true} ', event_type) end"""


@query("""
select event_id, event_id % 4 in (0, 2) as a, event_id % 4 in (1, 2) as b, event_id % 4 = 2 or (event_id % 4 = 0 and value > 50) as c, event_id % 4 in (2, 3) as d, case event_id % 4 when 0 then 0.9 when 1 then 0.4 when 2 then 0.5 else 0.7 end as confidence from events
""")
def signal_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals in the flat or the nested shape become one; what can't be parsed is true for all, so that nothing is missed."""
    v = F.try_parse_json(fn.reply_json(F.col("reply")))
    e = read(spark, sf_dir, "events").withColumn("reply", F.expr(_SIGNAL)).select("event_id", v.alias("v"))
    nested = F.try_variant_get("v", "$.signals", "variant").isNotNull()
    on = {k: F.when(F.col("v").isNull(), True).otherwise(F.coalesce(F.when(nested, F.try_variant_get("v", f"$.signals.{k}", "boolean")).otherwise(F.try_variant_get("v", f"$.{k}", "boolean")), F.lit(False))) for k in "ABCD"}
    some = on["A"] | on["B"] | on["C"] | on["D"]
    sure = F.when(F.col("v").isNull(), 0.5).otherwise(F.coalesce(F.try_variant_get("v", "$.confidence", "double"), F.when(some, 0.7).otherwise(0.5)))
    return e.select("event_id", *[x.alias(k.lower()) for k, x in on.items()], sure.alias("confidence"))


_FAMILIES = {"bread": ("dough", "tionon"), "meat": ("beef", "erhe"), "dairy": ("milk", "heit"), "sugar": ("candy", "eaux")}


@query(f"""
select doc_id, case {' '.join(f"when {_has(w, 'lower(text)')} then '{n}'" for n, w in _FAMILIES.items())} else 'general' end as category, source <> 'src3' and ((regexp_matches(text, '[0-9]') and regexp_matches(text, '(?i)(ention|heit|rate|equals)')) or regexp_matches(text, '[=^]|\\$')) as candidate from documents where text is not null
""")
def formula_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wanted domain and either digits with a keyword or a formula's marks; the category is that of the first keyword."""
    t = F.col("text")
    candidate = (F.col("source") != "src3") & ((t.rlike("[0-9]") & t.rlike("(?i)(ention|heit|rate|equals)")) | t.rlike(r"[=^]|\$"))
    return read(spark, sf_dir, "documents").where("text is not null").select("doc_id", fn.first_family(t, _FAMILIES, "general").alias("category"), candidate.alias("candidate"))


@query("""
select doc_id, case when text is null or trim(text) = '' then 'empty' when kind in ('science', 'mixed') then 'pass' when kind in ('recipe', 'narrative') then 'skip' else 'model' end as decision from (select doc_id, text, case lang when 'en' then 'science' when 'de' then 'recipe' when 'fr' then 'mixed' end as kind from documents)
""")
def chunk_shortcut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks whose type decides need no model."""
    kind = F.when(F.col("lang") == "en", "science").when(F.col("lang") == "de", "recipe").when(F.col("lang") == "fr", "mixed")
    rules = [(F.col("text").isNull() | (F.trim("text") == ""), "empty"), (kind.isin("science", "mixed"), "pass"), (kind.isin("recipe", "narrative"), "skip")]
    return read(spark, sf_dir, "documents").select("doc_id", ops.first_rule(rules, "model").alias("decision"))


_RESCUE = (("^(hot|cold)", "temperature"), ("(bolt|rod)$", "half_life"), ("ring|gear", "diameter"))


@query(f"""
with m as (select distinct p_name from part where p_size > 48), r as (select p_partkey, p_name, p_size, case {' '.join(f"when regexp_matches(p_name, '{p}') then '{n}'" for p, n in _RESCUE)} end as field from part where p_name not in (select p_name from m)),
c as (select *, row_number() over (partition by p_name order by p_partkey) as k from r where field is not null)
select p_partkey, p_name, field, case when field = 'half_life' then round(ln(2) / p_size, 6) end as rate, k = 1 as claims from c
""")
def label_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that nothing maps yet are matched by rules in order; the first row of a label claims it, and a half-life becomes a rate."""
    p = read(spark, sf_dir, "part")
    mapped = p.where("p_size > 48").select("p_name").distinct()
    field = ops.first_rule([(F.col("p_name").rlike(r), n) for r, n in _RESCUE])
    found = p.join(mapped, "p_name", "left_anti").select("p_partkey", "p_name", "p_size", field.alias("field")).where("field is not null")
    firsts = found.groupBy("p_name").agg(F.min("p_partkey").alias("first"))
    rate = F.when(F.col("field") == "half_life", F.round(F.log(F.lit(2.0)) / F.col("p_size"), 6))
    return found.join(firsts, "p_name").select("p_partkey", "p_name", "field", rate.alias("rate"), (F.col("p_partkey") == F.col("first")).alias("claims"))


@query("""
with r as (select conv_id, turn, case turn % 4 when 0 then '{"a": ' || turn || '}' when 1 then '<think>{x}</think>Sure:' || chr(10) || '```json' || chr(10) || '{"a": ' || turn || '}' || chr(10) || '```' when 2 then 'I think [1, ' || turn || '] fits' else 'none {broken' end as reply from conversations)
select conv_id, turn, case turn % 4 when 0 then '{"a": ' || turn || '}' when 1 then '{"a": ' || turn || '}' when 2 then '[1, ' || turn || ']' end as found from r
""")
def reply_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    reply = F.expr("""case turn % 4 when 0 then concat('{"a": ', turn, '}') when 1 then concat('<think>{x}</think>Sure:', chr(10), '```json', chr(10), '{"a": ', turn, '}', chr(10), '```') when 2 then concat('I think [1, ', turn, '] fits') else 'none {broken' end""")
    return c.select("conv_id", "turn", fn.reply_json(reply).alias("found"))


@query("""
select o_orderkey, case when o_orderkey % 5 = 4 then null else array_to_string(list_sort(list_distinct(list_concat(range(least(o_orderkey % 7 + 1, o_orderkey % 4 + 1), greatest(o_orderkey % 7 + 1, o_orderkey % 4 + 1) + 1), [o_orderkey % 11 + 1]))), ' ') end as pages from orders
""")
def page_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    spec = F.when(k % 5 == 4, " ").otherwise(F.concat((k % 7 + 1).cast("string"), F.lit("-"), (k % 4 + 1).cast("string"), F.lit(", ,"), (k % 11 + 1).cast("string")))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.array_join(fn.pages_of(spec), " ").alias("pages"))


@query("""
select p_partkey, row_number() over (partition by p_brand order by p_partkey % 1000, p_partkey) as place, p_brand, case when p_size < 6 then p_size || 's' when p_size * 10 < 360 then p_size * 10 // 6 || 'm' when p_size < 48 then p_size * 600 // 3600 || 'h' else p_size * 3600 // 86400 || 'd' end as age from part
""")
def natural_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in natural order (part2 before part10), and ages in words."""
    size = F.col("p_size")
    seconds = F.when(size < 6, size).when(size * 10 < 360, size * 100).when(size < 48, size * 600).otherwise(size * 3600)
    p = read(spark, sf_dir, "part").select("p_partkey", "p_brand", fn.natural_key(F.concat(F.lit("part"), F.col("p_partkey") % 1000, F.lit("_"))).alias("key"), fn.age(seconds).alias("age"))
    return ops.numbered(p, ["p_brand"], ["key", "p_partkey"], "place").select("p_partkey", "place", "p_brand", "age")


@query(r"""
select doc_id, left(regexp_replace(regexp_replace(lower(left(text, 60)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 80) as slug, upper(regexp_replace(strip_accents(trim(left(text, 60))), '[^A-Za-z0-9]+', '', 'g')) as heading, lang || '_' || n_chars as under from documents where text is not null and lang is not null and lang in ('en', 'fr')
""")
def slug_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of titles (a text's first 60 characters): an ASCII slug, a key without accents and marks, and a slug that keeps all scripts."""
    title = F.substring("text", 1, 60)
    heading = F.upper(F.regexp_replace(unicode.without_accents(F.trim(title)), "[^A-Za-z0-9]+", ""))
    return read(spark, sf_dir, "documents").where("text is not null and lang in ('en', 'fr')").select("doc_id", fn.slug(title).alias("slug"), heading.alias("heading"), fn.unicode_slug(F.concat_ws(" -", "lang", "n_chars")).alias("under"))


@query("""
with c as (select p_partkey, case p_partkey % 4 when 0 then 'Fresh ' || p_name || ' (raw).' when 1 then upper(p_name) || ' ,' when 2 then 'chopped' else '鸡 ' || p_name end as item, p_name from part)
select p_partkey, case p_partkey % 4 when 0 then case when p_name = 'red ring' then 'annulus' else regexp_replace(p_name, '^((old|new) )+', '') end when 1 then case when p_name = 'red ring' then 'annulus' else regexp_replace(p_name, '^((old|new) )+', '') end when 2 then 'chopped' else item end as key from c
""")
def ingredient_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.expr("case p_partkey % 4 when 0 then concat('Fresh ', p_name, ' (raw).') when 1 then concat(upper(p_name), ' ,') when 2 then 'chopped' else concat('鸡 ', p_name) end")
    return read(spark, sf_dir, "part").select("p_partkey", fn.ingredient_key(item, ("fresh", "chopped", "old", "new"), {"red ring": "annulus"}).alias("key"))


@query(r"""
with c as (select conv_id, turn, trim(text) as t from conversations), n as (select *, len(regexp_extract_all(t, '[0-9\p{L}_]+')) as n from c)
select conv_id, turn, case when turn % 3 = 1 then '' when n < 12 and not regexp_matches(t, '[.!?]') then '' else t end = '' as dropped, case when turn % 3 = 0 then length(replace(t, '\n', chr(10))) end as n_chars, n between 120 and 320 as fits from n where turn % 3 <> 2
""")
def sound_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks put right: a JSON object's text is taken out, and few words without an end mark are dropped."""
    raw = F.when(F.col("turn") % 3 == 1, F.lit('{"text": "few words\\\\nonly"}')).otherwise(F.to_json(F.struct("text")))
    c = read(spark, sf_dir, "conversations").where("turn % 3 <> 2").select("conv_id", "turn", "text", fn.sound_chunk(raw).alias("t"))
    return c.select("conv_id", "turn", (F.col("t") == "").alias("dropped"), F.when(F.col("turn") % 3 == 0, F.char_length("t")).cast("long").alias("n_chars"), fn.chunk_fits(F.trim("text")).alias("fits"))


@query("""
select p_partkey, case p_size % 3 when 0 then 'T,Tg' when 1 then 'Km,S,Vmax' else 'A,Ea' end as symbols, case p_size % 3 when 0 then '' when 1 then 'Vmax' else 'A,Ea' end as missing, p_size % 3 <> 0 as flagged from part
""")
def symbol_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The identifiers of a formula's text, and those that nobody declared."""
    text = F.expr("case p_size % 3 when 0 then 'exp(T - Tg) * pi' when 1 then 'Vmax*S/(Km+S)' else 'A*exp(-Ea/(R*2))' end")
    declared = F.expr("case p_size % 3 when 0 then array('T', 'Tg', 'x') else array('S', 'Km') end")
    s = fn.symbols(text, ("exp", "log", "sqrt", "pi", "R"))
    missing = F.array_except(s, declared)
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(s, ",").alias("symbols"), F.array_join(missing, ",").alias("missing"), (F.size(missing) > 0).alias("flagged"))


@query("""
with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents where text is not null)
select doc_id, count(*) as n_lines, max(octet_length(encode(line)))::bigint as longest_line, sum(octet_length(encode(line)) + 1)::bigint - 1 as bytes_ from l group by 1
""")
def byte_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts cut at line ends into pieces of at most 2000 bytes; counted together, the pieces are the text again."""
    d = read(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.explode(fn.split_by_bytes(F.col("text"), 2000)).alias("piece"))
    lines = F.transform(F.split("piece", "\n"), lambda x: F.octet_length(x))
    n = d.groupBy("doc_id").agg(F.sum(F.size(lines)).alias("n_lines"), F.max(F.array_max(lines)).cast("long").alias("longest_line"), F.sum(F.octet_length("piece") + 1).alias("b"))
    return n.select("doc_id", "n_lines", "longest_line", (F.col("b") - 1).alias("bytes_"))


_UNITS = ["cup", "kg", "g", "lb", "C", "cup", "kg"]


@query("""
with p as (select l_orderkey, l_linenumber, l_quantity as v, ['cup', 'kg', 'g', 'lb', 'C', 'cup', 'kg'][l_linenumber] as u from lineitem), s as (select *, case u when 'kg' then v when 'g' then v * 1e-3 when 'lb' then v * 0.45359237 when 'C' then v + 273.15 end as si from p)
select l_orderkey, count(*) as n, round(sum(si), 6) as si_sum, round(sum(v) filter (where si is null), 6) as raw_left, count(*) filter (where si is null) as flagged, round(ln(2) / max(v), 6) as rate, round(max(abs(v - 25) / 25 * 100), 6) as worst_deviation from s group by 1
""")
def si_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with nested parameters: each gets its SI value beside the raw one, or a flag; and values that are derived from them."""
    unit = F.get(F.array(*map(F.lit, _UNITS)), F.col("l_linenumber") - 1)
    nested = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_quantity").alias("value"), unit.alias("unit"))).alias("ps"))  # an order's few lines
    done = F.transform("ps", lambda p: F.struct(fn.si_value(p["value"], p["unit"]).alias("value"), p["value"].alias("_raw_value"), p["unit"].alias("_raw_unit"), fn.si_value(p["value"], p["unit"]).isNull().alias("_unconvertible")))
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
    r = nested.withColumn("ps", done)
    lost, raw = F.filter("ps", lambda p: p["_unconvertible"]), F.transform("ps", lambda p: p["_raw_value"])
    known = F.filter("ps", lambda p: ~p["_unconvertible"])
    sum_or_null = lambda xs, c: F.when(F.size(xs) > 0, F.round(total(F.transform(xs, lambda p: p[c])), 6))
    return r.select("l_orderkey", F.size("ps").cast("long").alias("n"), sum_or_null(known, "value").alias("si_sum"), sum_or_null(lost, "_raw_value").alias("raw_left"), F.size(lost).cast("long").alias("flagged"),
                    F.round(F.log(F.lit(2.0)) / F.array_max(raw), 6).alias("rate"), F.round(F.array_max(F.transform(raw, lambda v: F.abs(v - 25) / 25 * 100)), 6).alias("worst_deviation"))


@query("""
with x as (select p_partkey, p_size as t, (p_retailprice - 900) as w, p_partkey % 3 as k from part)
select p_partkey, array_to_string(list_filter([case when t - 20 < -5 then 'T_minus_Tg below -5' when t - 20 > 25 then 'T_minus_Tg above 25' end, case when k = 0 then case when w / 100 > 0.6 then 'WARN: water above 0.6' end else case when w / 100 > 0.6 then 'WARN: water above 0.6' end end], lambda i: i is not null), ';') as issues, t - 20 between -5 and 25 as ok from x
""")
def derived_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds on derived values and on fields of a nested composition, which may come in percents."""
    p = read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("T"), F.struct(F.when(F.col("p_partkey") % 3 == 0, F.col("p_retailprice") - 900).otherwise((F.col("p_retailprice") - 900) / 100).alias("water"), F.when(F.col("p_partkey") % 3 == 0, 20.0).otherwise(0.2).alias("fat")).alias("composition"))
    shares = physics.as_shares({"water": F.col("composition.water"), "fat": F.col("composition.fat")})
    issues = physics.bounds_issues({"T_minus_Tg": (-5, 25, False), "water": (None, 0.6, True)}, {"T_minus_Tg": F.col("T") - 20, "water": F.round(shares["water"], 9)})
    return p.select("p_partkey", F.array_join(issues, ";").alias("issues"), physics.passed(issues).alias("ok"))


_QUESTION = "What is the Erhe ention of the thewh in an oven"
_STOP = ("what", "is", "the", "of", "in", "an", "a")


@query("select doc_id, 0.5 as score from documents where contains(lower(text), 'erhe') or contains(lower(text), 'ention') or contains(lower(text), 'thewh') order by doc_id limit 20")
def keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three words of a question that are no stop words, any of which a text must hold; the first 20 by id."""
    wanted = [w for w in _QUESTION.lower().split() if w not in _STOP and len(w) > 1][:3]
    low = F.lower("text")
    hit = ops.any_of([F.contains(low, F.lit(w)) for w in wanted])
    return read(spark, sf_dir, "documents").where(hit).select("doc_id", F.lit(0.5).alias("score")).orderBy("doc_id").limit(20)


@query("""
with q as (select embedding::double[] as e from embeddings where vec_id = (select min(vec_id) from embeddings)), v as (select vec_id as id, row_number() over (order by round(list_cosine_similarity(embedding::double[], e), 6) desc, vec_id) as rank from embeddings, q),
k as (select doc_id as id, row_number() over (order by doc_id) as rank from documents where contains(lower(text), 'erhe') or contains(lower(text), 'ention')), u as (select id, 1.0 / (60 + rank) as s, 'vector' as m from v where rank <= 50 union all select id, 1.0 / (60 + rank), 'keyword' from k where rank <= 50)
select id, round(sum(s), 9) as score, case when count(*) = 2 then 'hybrid' else min(m) end as method from u group by 1
""")
def hybrid_rrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 nearest vectors and the first 50 texts with a keyword, fused by their ranks; a row that both have is hybrid."""
    e = read(spark, sf_dir, "embeddings")
    q = F.broadcast(e.groupBy().agg(F.min_by("embedding", "vec_id").alias("q")))  # one row
    near = e.join(q, F.lit(True)).select(F.col("vec_id").alias("id"), F.round(fn.cosine(F.col("embedding"), F.col("q")), 6).alias("s")).orderBy(F.desc("s"), "id").limit(50)
    low = F.lower("text")
    words = read(spark, sf_dir, "documents").where(F.contains(low, F.lit("erhe")) | F.contains(low, F.lit("ention"))).select(F.col("doc_id").alias("id")).orderBy("id").limit(50)
    ranked = lambda df, *order: df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # noqa: E731  fifty rows in one window
    fused = ops.fused([("keyword", ranked(words, "id")), ("vector", ranked(near, F.desc("s"), "id"))], "id")
    return fused.select("id", F.round("score", 9).alias("score"), F.when(F.contains("method", F.lit("+")), "hybrid").otherwise(F.col("method")).alias("method"))
