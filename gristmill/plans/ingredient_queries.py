"""Queries over ingredient records that are made of the given tables: what is left out, enums put right, edges, cycles, stubs, merges and checks before an export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import ingredients as ing
from ..operators import graph, tables as ops
from .registry import query, read

_IDS = (
    "ascorbic_acid", "17th_century", "100_grand_bar", "babyfood_carrots", "fuji_apple", "3_musketeers", "100_percent_candy_bar", "00_flour", "oreochromis_niloticus", "oreo", "pork_belly", "sauce",
    "leucine", "modern_wheat", "infant_cereal", "kit_kat_mini", "brandy", "1990s", "vitamin_k2", "lay's_classic", "7up", "toddler_snack", "stock", "chicken_skin",
)
_QUOTED = [i.replace("'", "''") for i in _IDS]
#: Columns of an ingredient record, in SQL that Spark and DuckDB read alike.
_ATOM = {
    "canonical_id": "case when p_partkey % 3 = 0 then case cast(floor(p_partkey / 3) as bigint) % 24 " + " ".join(f"when {k} then '{i}'" for k, i in enumerate(_QUOTED)) + " end else replace(p_name, ' ', '_') end",
    "category": "case when p_type = 'PROMO' then 'time_period' else p_type end",
    "scientific_name": "case p_size % 5 when 0 then '(S)-Pyrrolidine' when 1 then 'Gallus gallus' when 2 then 'Citric acid monomer' end",
    "zh": "case when p_size % 4 = 0 then '鸡' end",
    "en": "case when p_size % 4 = 1 then p_name when p_size % 4 = 2 then '' end",
    "ingredient": "case when p_size % 3 = 0 then p_name when p_size % 3 = 1 then upper(p_brand) end",
    "protein": "case when p_size % 7 = 0 then 'n/a' else cast(p_size * 2 as varchar(9)) end",
    "water": "case when p_size % 7 = 1 then '0.5' when p_size % 7 = 2 then 'trace' end",
}
_ATOMS = "(select p_partkey, " + ", ".join(f"{v} as {k}" for k, v in _ATOM.items()) + " from part)"


def _atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", *[F.expr(v).alias(k) for k, v in _ATOM.items()])


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _like(patterns) -> str:
    return ing.one_of(patterns).replace("'", "''")


@query(f"""
select p_partkey, case when id in {_in(ing.CULTIVARS)} then null when id in {_in(ing.AMINO_ACIDS + ing.PURE_CHEMICALS)} or starts_with(coalesce(scientific_name, ''), '(S)-') or starts_with(coalesce(scientific_name, ''), '(R)-') then 'chemical'
  when coalesce(scientific_name, '') = '' and coalesce(zh, '') = '' and coalesce(en, '') = '' and (ingredient is null or replace(lower(ingredient), ' ', '_') = id) then 'data_incomplete' when regexp_matches(id, '{_like(ing.PERIODS)}') then 'noise'
  when id not in {_in(ing.NO_BRANDS)} and not contains(id, '_percent_') and regexp_matches(id, '{_like(ing.BRANDS)}') then 'brand' when regexp_matches(id, '{_like(ing.BABY_FOOD)}') then 'babyfood' end as reason
from (select *, lower(canonical_id) as id from {_ATOMS})
""")
def prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return _atoms(spark, sf_dir).select("p_partkey", ing.prefiltered(c("canonical_id"), c("scientific_name"), c("zh"), c("en"), c("ingredient")).alias("reason"))


@query(f"""
select p_partkey, case when category = 'time_period' then 'noise' when regexp_matches(canonical_id, '^[0-9]') or contains(canonical_id, '_bar') or contains(canonical_id, '_grand') then 'brand' when starts_with(canonical_id, 'babyfood_') then 'babyfood' when canonical_id in {_in(ing.ABSTRACT)} then 'abstract'
  when regexp_matches(lower(coalesce(scientific_name, '')), 'acid|amine|oside|monomer|-yl|-ic') and (coalesce(try_cast(protein as double), 0) > 95 or coalesce(try_cast(water as double), 50) < 1) then 'chemical'
  when coalesce(zh, '') = '' and coalesce(en, '') = '' then 'data_incomplete' end as exclusion_reason from {_ATOMS}
""")
def hard_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six classes that are pruned, first match wins."""
    c = F.col
    return _atoms(spark, sf_dir).select("p_partkey", ing.pruned(c("canonical_id"), c("category"), c("scientific_name"), c("zh"), c("en"), c("protein"), c("water")).alias("exclusion_reason"))


_CODES = ("noise_excluded", "noise", "suspect", "ambiguous_canonical_id", "chemical_monomer_excluded", "structural_nesting_resolved")
#: What a model might answer: two issues, a form, a status and a reason.
_REPLY = {
    "i1": "case p_size % 6 " + " ".join(f"when {k} then '{v}'" for k, v in enumerate(_CODES)) + " end",
    "i2": "case cast(floor(p_partkey / 6) as bigint) % 6 " + " ".join(f"when {k} then '{v}'" for k, v in enumerate(_CODES)) + " end",
    "form": "case p_size % 4 when 0 then 'species' when 1 then 'liquid' when 2 then 'part' end",
    "status": "case cast(floor(p_partkey / 4) as bigint) % 4 when 0 then 'active' when 1 then 'excluded' when 2 then 'dropped' end",
    "reason": "case cast(floor(p_partkey / 5) as bigint) % 5 when 0 then 'brand' when 1 then 'noise_time_period' when 2 then 'unclear' when 3 then 'chemical_monomer' end",
}
_SHORT = lambda c: "case " + c + " " + " ".join(f"when '{a}' then '{b}'" for a, b in ing.ISSUES.items()) + f" else {c} end"


@query(f"""
with r as (select p_partkey, {', '.join(f'{v} as {k}' for k, v in _REPLY.items())} from part),
s as (select *, {_SHORT('i1')} as c1, {_SHORT('i2')} as c2, form = 'liquid' as odd_form, case when status = 'dropped' then 'needs_review' else status end as tree_status,
  case reason when 'noise_time_period' then 'noise' when 'chemical_monomer' then 'chemical' when 'unclear' then null else reason end as known from r),
t as (select *, coalesce(tree_status = 'excluded' and known is null, false) as unsaid, list_filter([c1, case when c2 <> c1 then c2 end, case when odd_form and 'canonical_id_ambiguity' not in (c1, c2) then 'canonical_id_ambiguity' end], lambda x: x is not null) as codes from s)
select p_partkey, array_to_string(case when unsaid then list_append(codes, 'auto_assigned_other_reason') else codes end, ',') as issue_codes, case when odd_form then 'ambiguous' else form end as form_type, tree_status, case when unsaid then 'other' else known end as exclusion_reason,
  (c1 <> i1)::bigint + (c2 <> i2)::bigint + coalesce(odd_form, false)::bigint + coalesce(status = 'dropped', false)::bigint + coalesce(reason in ('noise_time_period', 'unclear', 'chemical_monomer'), false)::bigint + unsaid::bigint as n_repairs from t
""")
def enum_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "part").select("p_partkey", *[F.expr(v).alias(k) for k, v in _REPLY.items()])
    x = ing.put_right(F.array("i1", "i2"), F.col("form"), F.col("status"), F.col("reason"))
    return r.withColumn("x", x).select("p_partkey", F.array_join("x.issue_codes", ",").alias("issue_codes"), "x.form_type", "x.tree_status", "x.exclusion_reason", F.size("x.repairs").cast("long").alias("n_repairs"))


@query("""
select p_partkey, coalesce(c, 0) < 0.85 or human or list_has_any(flags, ['chimera_node', 'composition_implausible']) as review from (select p_partkey, case when p_size % 9 > 0 then p_size / 50 end as c, p_size % 13 = 0 as human,
  case when p_brand = 'Brand#3' then ['suspect', 'chimera_node'] when p_brand = 'Brand#4' then ['suspect'] else [] end as flags from part)
""")
def peer_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand, none = F.col("p_brand"), F.array().cast("array<string>")
    flags = F.when(brand == "Brand#3", F.array(F.lit("suspect"), F.lit("chimera_node"))).when(brand == "Brand#4", F.array(F.lit("suspect"))).otherwise(none)
    needs = ing.needs_peer_review(F.when(F.col("p_size") % 9 > 0, F.col("p_size") / 50), F.col("p_size") % 13 == 0, flags, ["chimera_node", "composition_implausible"])
    return read(spark, sf_dir, "part").select("p_partkey", needs.alias("review"))


#: Candidates of a record: its parents under several keys, a process and a cuisine; sources and targets are parts' names.
_CANDIDATES = {
    "source": "replace(p_name, ' ', '_')",
    "is_a": "case when p_size % 2 = 0 then regexp_replace(p_name, '^[a-z]+ ', '') end",
    "part_of": "case when p_size % 3 = 0 then replace(p_name, ' ', '_') when p_size % 3 = 1 then lower(p_type) end",
    "derived_from": "case when p_size % 4 = 0 then '' when p_size % 4 = 1 then regexp_replace(p_name, '^[a-z]+ ', '') end",
    "derived_from_parent": "case when p_size % 8 < 4 then lower(p_type) end",
    "process": "case p_size % 7 when 0 then 'Drying' when 1 then 'smoked' when 2 then 'Deep-Frying' when 3 then 'baking' when 4 then 'Ground' when 5 then ' ' end",
    "cuisine": "case p_size % 5 when 0 then 'french' when 1 then 'martian' when 2 then 'sichuan' end",
}
_MADE = "(select " + ", ".join(f"{v} as {k}" for k, v in _CANDIDATES.items()) + " from part)"
_WORDS = {"drying": "dried", "smoked": "smoked", "baking": "roasted", "ground": "milled"}
_EDGES = f"""
select distinct source, is_a as target, 'IS_A' as type, '' as detail from {_MADE} where is_a <> source union select distinct source, part_of, 'PART_OF', '' from {_MADE} where part_of <> source
union select distinct source, coalesce(nullif(derived_from, ''), derived_from_parent), 'DERIVED_FROM', case lower(process) {' '.join(f"when '{a}' then '{b}'" for a, b in _WORDS.items())} else 'mixed' end from {_MADE} where coalesce(nullif(derived_from, ''), derived_from_parent) <> source
union select distinct source, cuisine, 'HAS_CULINARY_ROLE', '' from {_MADE} where cuisine in {_in(ing.CUISINES)}
"""


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = read(spark, sf_dir, "part").select(*[F.expr(v).alias(k) for k, v in _CANDIDATES.items()])
    return graph.typed_edges(made, "source", {
        "IS_A": (["is_a"], F.lit("")), "PART_OF": (["part_of"], F.lit("")), "DERIVED_FROM": (["derived_from", "derived_from_parent"], ing.process_type(F.col("process"))),
        "HAS_CULINARY_ROLE": (["cuisine"], F.lit("")),
    }, {"HAS_CULINARY_ROLE": ing.CUISINES})


@query(_EDGES)
def candidate_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of four types out of nested candidates: the first key that is filled names the target, no edge leads to its own source, each edge is there once."""
    return _edges(spark, sf_dir)


@query(f"select target as canonical_id, replace(target, '_', ' ') as display_name_en, 'stub' as tree_status, count(*) as n_edges from ({_EDGES}) where type <> 'HAS_CULINARY_ROLE' and target not in (select replace(p_name, ' ', '_') from part) group by 1")
def edge_stubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = read(spark, sf_dir, "part").select(F.replace("p_name", F.lit(" "), F.lit("_")).alias("id"))
    return graph.stubs(_edges(spark, sf_dir).where("type <> 'HAS_CULINARY_ROLE'"), known, "id")


#: One edge out of each supplier: tails lead into cycles of several lengths, loops among them. Names have different lengths, which decides where a cycle is cut.
_NEXT = "(s_suppkey // 3 * 7 + s_suppkey % 3) % (select count(*) from supplier)"
#: Steps are doubled until all are taken, so what is reached then lies on a cycle, and the least name on the way is that of the cycle; only cycles are walked.
_CYCLES = f"""
with recursive f as (select s_suppkey as a, {_NEXT} as b from supplier),
j as (select 0 as k, f.a, f.b, 's' || f.a as m from f semi join f g on f.b = g.a union all select x.k + 1, x.a, y.b, least(x.m, y.m) from j x join j y on x.b = y.a where 2 ** x.k < (select count(*) from supplier)),
top as (select * from j where k = (select max(k) from j)), root as (select a from top where m = 's' || a and a in (select b from top)),
w as (select a as root, a as here, 1 as n from root union all select root, f.b, n + 1 from w join f on f.a = w.here where f.b <> w.root),
least as (select root, max(n) as n, list('s' || here order by n) as path from w group by root)
"""


def _pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    n = s.count()
    name = lambda c: F.concat(F.lit("s"), c.cast("string"))
    return s.select(name(F.col("s_suppkey")).alias("src"), name((F.floor(F.col("s_suppkey") / 3) * 7 + F.col("s_suppkey") % 3) % n).alias("dst"))


@query(_CYCLES + "select array_to_string(list_append(path, path[1]), '>') as cycle, n::bigint as length from least")
def edge_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cycle that a depth-first search from the least node finds, as a path back to where it began."""
    return graph.cycles(_pointers(spark, sf_dir)).select(F.array_join("cycle", ">").alias("cycle"), (F.size("cycle") - 1).cast("long").alias("length"))


@query(_CYCLES + """
, steps as (select unnest(path) as src, unnest(list_append(path[2:], path[1])) as dst, generate_subscripts(path, 1) as k, n, root from least),
cut as (select arg_min(src, k) filter (where length(dst) > length(src)) as s1, arg_min(dst, k) filter (where length(dst) > length(src)) as d1, arg_max(src, k) as s2, arg_max(dst, k) as d2 from steps group by root)
select coalesce(s1, s2) as src, coalesce(d1, d2) as dst from cut
""")
def broken_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges that are removed so that no cycle stays: of a cycle the first to a longer name, or else the last one."""
    return graph.without_cycles(_pointers(spark, sf_dir))[1]


@query("""
with e as (select 'p' || l_partkey as source, 's' || l_suppkey as target, case l_linenumber % 3 when 0 then 'IS_A' when 1 then 'PART_OF' else 'EATS' end as type, l_quantity as q from lineitem), n as (select 'p' || p_partkey as id, p_size from part union all select 's' || s_suppkey, 1 from supplier where s_acctbal > 0)
select 'unknown_edge_type' as rule, source as atom_id, count(*) as n from e where type = 'EATS' group by source union all select 'missing_target', source, count(*) from e where target not in (select id from n) group by source
union all select 'duplicate_edge', source, count(*) from (select source, target, type from e group by source, target, type having count(*) > 1) d group by source union all select 'bad_size', id, 1 from n where p_size > 45 union all select 'no_edge', id, 1 from n where id not in (select source from e) and id not in (select target from e)
""")
def export_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stops an export: each rule's offenders, with how often they offend."""
    kind = F.when(F.col("l_linenumber") % 3 == 0, "IS_A").when(F.col("l_linenumber") % 3 == 1, "PART_OF").otherwise("EATS")
    e = read(spark, sf_dir, "lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("source"), F.concat(F.lit("s"), "l_suppkey").alias("target"), kind.alias("type"))
    n = read(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"), "p_size").unionByName(read(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.lit(1).alias("p_size")))
    rules = {
        "unknown_edge_type": e.where(~F.col("type").isin("IS_A", "PART_OF")).select(F.col("source").alias("atom_id")),
        "missing_target": e.join(n, e.target == n.id, "left_anti").select(F.col("source").alias("atom_id")),
        "duplicate_edge": e.groupBy("source", "target", "type").count().where("count > 1").select(F.col("source").alias("atom_id")),
        "bad_size": n.where("p_size > 45").select(F.col("id").alias("atom_id")),
        "no_edge": n.join(e.select(F.explode(F.array("source", "target")).alias("id")), "id", "left_anti").select(F.col("id").alias("atom_id")),
    }
    return ops.offenders(rules)


@query("""
with k as (select lower(p_type) || ':' || split_part(p_name, ' ', 2) as cluster, p_partkey, p_name, p_brand, p_size, row_number() over (partition by p_type, split_part(p_name, ' ', 2) order by p_size desc, p_partkey) as r from part),
a as (select cluster, string_agg(distinct p_name, ',' order by p_name) as aliases, string_agg(distinct p_brand, ',' order by p_brand) as sources from k group by 1)
select p_partkey as id, root, case when p_partkey <> root then 'redirect' else 'canonical' end as role, case when p_partkey = root then aliases end as aliases, case when p_partkey = root then sources end as sources from k join a using (cluster) join (select cluster, p_partkey as root from k where r = 1) using (cluster)
""")
def alias_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of one cluster become one: the most complete keeps all aliases and sources, the others redirect to it."""
    p = read(spark, sf_dir, "part").withColumn("cluster", F.concat_ws(":", F.lower("p_type"), F.split("p_name", " ")[1]))
    merged = p.groupBy("cluster").agg(
        F.max_by("p_partkey", F.struct("p_size", -F.col("p_partkey"))).alias("root"), F.array_join(F.sort_array(F.collect_set("p_name")), ",").alias("aliases"), F.array_join(F.sort_array(F.collect_set("p_brand")), ",").alias("sources")
    )
    own = F.col("p_partkey") == F.col("root")
    return p.join(merged, "cluster").select(F.col("p_partkey").alias("id"), "root", F.when(own, "canonical").otherwise("redirect").alias("role"), F.when(own, F.col("aliases")).alias("aliases"), F.when(own, F.col("sources")).alias("sources"))


@query("""
select coalesce(a.p_partkey, b.p_partkey) as p_partkey, coalesce(b.p_brand, a.p_brand) as canonical, coalesce(a.p_name, b.p_name) as name, case when a.p_partkey is null then 'second only' when b.p_partkey is null then 'first only' else 'grafted' end as how, coalesce(b.p_size, 0) as size_field, coalesce(case when a.p_size > 25 then '2.0' end, '1.1') as version_
from (select * from part where p_partkey % 3 > 0) a full join (select * from part where p_partkey % 2 = 0) b on a.p_partkey = b.p_partkey
""")
def field_graft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first pass is the base; fields that the second has are put in, and its records that the first lacks stay."""
    p = read(spark, sf_dir, "part")
    first = p.where("p_partkey % 3 > 0").select("p_partkey", F.col("p_name").alias("n1"), F.col("p_brand").alias("b1"), F.col("p_size").alias("s1"))
    second = p.where("p_partkey % 2 = 0").select("p_partkey", F.col("p_name").alias("n2"), F.col("p_brand").alias("b2"), F.col("p_size").alias("s2"))
    how = F.when(F.col("n1").isNull(), "second only").when(F.col("n2").isNull(), "first only").otherwise("grafted")
    return first.join(second, "p_partkey", "full").select("p_partkey", F.coalesce("b2", "b1").alias("canonical"), F.coalesce("n1", "n2").alias("name"), how.alias("how"), F.coalesce("s2", F.lit(0)).alias("size_field"), F.coalesce(F.when(F.col("s1") > 25, "2.0"), F.lit("1.1")).alias("version_"))


@query("""
with kept as (select * from nation where exists (select 1 from region where r_regionkey = n_regionkey and r_name <> 'EUROPE'))
select count(*) as n_nodes, count(*) filter (where n_nationkey not in (select n_nationkey from kept)) as purged, (select count(*) from customer where c_nationkey not in (select n_nationkey from kept)) as edges_lost from nation
""")
def purge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a purge of legacy nodes would remove, before anything is removed."""
    n, r, c = (read(spark, sf_dir, t) for t in ("nation", "region", "customer"))
    kept = n.join(r.where("r_name <> 'EUROPE'"), n.n_regionkey == r.r_regionkey, "left_semi").select("n_nationkey", F.lit(True).alias("kept"))
    nodes = n.join(kept, "n_nationkey", "left").agg(F.count("*").alias("n_nodes"), F.count_if(F.col("kept").isNull()).alias("purged"))
    lost = c.join(kept, c.c_nationkey == kept.n_nationkey, "left_anti").agg(F.count("*").alias("edges_lost"))
    return nodes.join(F.broadcast(lost), F.lit(True))  # one row each
