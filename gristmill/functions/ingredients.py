"""Decisions about ingredient records as column expressions: what is left out and why, enum values put right, kinds of edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Ids of single chemicals, which are no ingredients.
AMINO_ACIDS = (
    "alanine", "arginine", "asparagine", "aspartic_acid", "cysteine", "glutamic_acid", "glutamine", "glycine", "histidine", "isoleucine", "leucine", "lysine", "methionine", "phenylalanine", "proline", "serine", "threonine",
    "tryptophan", "tyrosine", "valine", "selenocysteine", "pyrrolysine", "ornithine", "taurine", "citrulline", "creatine", "carnitine", "carnosine", "anserine", "glucosamine", "n_acetyl_glucosamine", "n-acetyl-glucosamine",
)
PURE_CHEMICALS = (
    "ascorbic_acid", "citric_acid", "lactic_acid", "acetic_acid", "oxalic_acid", "tartaric_acid", "malic_acid", "fumaric_acid", "succinic_acid", "phytic_acid", "benzoic_acid", "sorbic_acid", "propionic_acid", "butyric_acid",
    "fructose", "glucose", "sucrose", "lactose", "maltose", "galactose", "mannose", "xylose", "ribose", "arabinose", "trehalose", "sorbitol", "mannitol", "xylitol", "erythritol",
    "vitamin_a", "vitamin_b1", "vitamin_b2", "vitamin_b6", "vitamin_b12", "vitamin_c", "vitamin_d", "vitamin_d2", "vitamin_d3", "vitamin_e", "vitamin_k", "vitamin_k1", "vitamin_k2",
    "thiamin", "riboflavin", "niacin", "biotin", "folate", "folic_acid", "pantothenic_acid", "pyridoxine", "cobalamin",
    "oleic_acid", "linoleic_acid", "linolenic_acid", "palmitic_acid", "stearic_acid", "arachidonic_acid", "eicosapentaenoic_acid", "docosahexaenoic_acid",
)
# Patterns of ids that are brands, periods and baby food; ids that look like brands and aren't; cultivars that always stay.
BRANDS = (r"^\d+_grand(_bar)?$", r"^\d_musketeers", r"^\dth_avenue", r"^\d+up$", "_candy_bar$", "_chocolate_bar$", "_grand$", "_brand$", "^after_eight", "_kit_kat", "^kit_kat", "^lay'?s_", "^doritos", "^pringles", "^cheez_it", "^oreo(s|_|$)", "^pop_tart")
PERIODS = ("_century$", r"^\d+(st|nd|rd|th)_century", r"^\d{4}s$", "_period$", "_era$", "^modern_", "^medieval_", "^ancient_")
BABY_FOOD = ("^babyfood_", "_baby_food$", "_infant_", "^infant_", "^toddler_", "_toddler_")
NO_BRANDS, NO_BRAND_PART = ("00_flour", "0_flour", "0_grade_flour", "tipo_00_flour"), "_percent_"
CULTIVARS = ("bresse_chicken", "russet_potato", "fuji_apple", "honeycrisp_apple", "kobe_beef", "wagyu_beef", "iberico_pork", "bordeaux_grape")
# Words that name no ingredient, and parts of chemical names.
ABSTRACT = ("acid", "base", "batter", "blend", "extract", "flavoring", "food", "ingredient", "liquid", "meal", "mix", "paste", "powder", "sauce", "seasoning", "solid", "stock", "substance")
CHEMICAL_PARTS = ("acid", "amine", "oside", "monomer", "-yl", "-ic")
# The enums, and what other spellings of their values mean.
FORM_TYPES = ("species", "variety", "part", "processed", "composite", "ambiguous")
TREE_STATUSES = ("active", "excluded", "needs_review", "identity_conflict")
REASONS = ("chemical", "data_incomplete", "brand", "babyfood", "abstract", "noise", "other")
VERBOSE_REASONS = {"chemical_monomer": "chemical", "data_incomplete_required_fields_missing": "data_incomplete", "noise_time_period": "noise", "abstract_token": "abstract"}
ISSUES = {
    "noise_excluded": "noise", "chemical_monomer_excluded": "chemical", "data_incomplete_excluded": "data_incomplete", "brand_excluded": "brand", "babyfood_excluded": "babyfood", "ambiguous_canonical_id": "canonical_id_ambiguity",
    "structural_nesting_resolved": "malformed_cuisine_deep_nesting_corrected", "malformed_cuisine_deep_hierarchy_fixed": "malformed_cuisine_deep_nesting_corrected", "deep_cuisine_nesting_corrected": "malformed_cuisine_deep_nesting_corrected", "abstract_excluded": "noise",
}
# Kinds of processes, other words for them, and known cuisines.
PROCESSES = ("dried", "fermented", "cured", "smoked", "cooked", "roasted", "frozen", "milled", "pressed", "extracted", "mixed", "pickled", "aged")
PROCESS_WORDS = {
    "drying": "dried", "dehydrated": "dried", "dehydration": "dried", "fermentation": "fermented", "curing": "cured", "smoking": "smoked", "frying": "cooked", "boiled": "cooked", "boiling": "cooked", "steamed": "cooked", "steaming": "cooked",
    "baked": "roasted", "baking": "roasted", "toasted": "roasted", "roasting": "roasted", "freezing": "frozen", "milling": "milled", "ground": "milled", "grinding": "milled", "pressing": "pressed", "extraction": "extracted", "pickling": "pickled", "aging": "aged",
}
CUISINES = ("cantonese", "sichuan", "jiangnan", "hainan", "french", "japanese")


def one_of(patterns: Sequence[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def looked_up(value: Column, words: dict[str, str]) -> Column:
    """What a word stands for, or null."""
    return F.coalesce(*[F.when(value == a, F.lit(b)) for a, b in words.items()])


def prefiltered(id: Column, scientific: Column, zh: Column, en: Column, ingredient: Column) -> Column:
    """Why a record is left out before anything else looks at it, or null: chemical, data_incomplete, noise, brand, babyfood; the first that holds. Cultivars always stay.

    A name counts as identity unless it only repeats the id. Periods come before brands, as both may begin with a digit.
    """
    blank = lambda c: F.trim(F.coalesce(c, F.lit("")))
    id, sci, said = F.lower(blank(id)), blank(scientific), blank(ingredient)
    named = (sci != "") | (blank(zh) != "") | (blank(en) != "") | ((said != "") & (F.replace(F.lower(said), F.lit(" "), F.lit("_")) != id))
    return (
        F.when(id.isin(*CULTIVARS), F.lit(None))
        .when(id.isin(*AMINO_ACIDS, *PURE_CHEMICALS) | sci.rlike(r"^\([SR]\)-"), "chemical")
        .when(~named, "data_incomplete")
        .when(id.rlike(one_of(PERIODS)), "noise")
        .when(~id.isin(*NO_BRANDS) & ~F.contains(id, F.lit(NO_BRAND_PART)) & id.rlike(one_of(BRANDS)), "brand")
        .when(id.rlike(one_of(BABY_FOOD)), "babyfood")
    )


def pruned(id: Column, category: Column, scientific: Column, zh: Column, en: Column, protein: Column, water: Column) -> Column:
    """Why a record is pruned, or null: noise, brand, babyfood, abstract, chemical, data_incomplete; the first that holds. Protein and water are percents as text; what is no number is 0 and 50."""
    id = F.trim(F.coalesce(id, F.lit("")))
    sounds = F.lower(F.coalesce(scientific, F.lit(""))).rlike("|".join(CHEMICAL_PARTS))
    pure = (F.coalesce(protein.try_cast("double"), F.lit(0.0)) > 95) | (F.coalesce(water.try_cast("double"), F.lit(50.0)) < 1)
    return (
        F.when(category == "time_period", "noise").when(id.rlike(r"^\d|_bar|_grand"), "brand").when(id.startswith("babyfood_"), "babyfood").when(id.isin(*ABSTRACT), "abstract")
        .when(sounds & pure, "chemical").when((F.coalesce(zh, F.lit("")) == "") & (F.coalesce(en, F.lit("")) == ""), "data_incomplete")
    )


def put_right(issues: Column, form: Column, status: Column, reason: Column) -> Column:
    """A struct of issue_codes (synonyms replaced, each once, in order), form_type, tree_status, exclusion_reason and repairs (what was changed). Applied twice it changes nothing more.

    A form that isn't known is ambiguous and adds an issue; a status that isn't known is needs_review; of reasons, verbose ones become short
    and others null; what is excluded without a reason gets other and an issue.
    """
    codes = F.transform(F.filter(F.coalesce(issues, F.array().cast("array<string>")), lambda c: c.isNotNull()), lambda c: F.coalesce(looked_up(c, ISSUES), c))
    odd_form, odd_status, odd_reason = form.isNotNull() & ~form.isin(*FORM_TYPES), status.isNotNull() & ~status.isin(*TREE_STATUSES), reason.isNotNull() & ~reason.isin(*REASONS)
    status_now = F.when(odd_status, F.lit("needs_review")).otherwise(status)
    known = F.when(odd_reason, looked_up(reason, VERBOSE_REASONS)).otherwise(reason)
    unsaid = F.coalesce((status_now == "excluded") & known.isNull(), F.lit(False))
    more = F.array_compact(F.array(F.when(odd_form, F.lit("canonical_id_ambiguity")), F.when(unsaid, F.lit("auto_assigned_other_reason"))))
    renamed = F.transform(F.filter(F.coalesce(issues, F.array().cast("array<string>")), lambda c: c.isin(*ISSUES)), lambda c: F.concat(F.lit("issue "), c, F.lit(" is "), looked_up(c, ISSUES)))
    others = F.array_compact(F.array(
        F.when(odd_form, F.concat(F.lit("form "), form, F.lit(" is ambiguous"))), F.when(odd_status, F.concat(F.lit("status "), status, F.lit(" needs review"))),
        F.when(odd_reason, F.concat(F.lit("reason "), reason, F.lit(" is "), F.coalesce(looked_up(reason, VERBOSE_REASONS), F.lit("none")))), F.when(unsaid, F.lit("excluded without a reason")),
    ))
    return F.struct(F.array_distinct(F.concat(codes, more)).alias("issue_codes"), F.when(odd_form, F.lit("ambiguous")).otherwise(form).alias("form_type"), status_now.alias("tree_status"), F.when(unsaid, F.lit("other")).otherwise(known).alias("exclusion_reason"), F.concat(renamed, others).alias("repairs"))


def process_type(said: Column) -> Column:
    """One of PROCESSES; mixed for anything else."""
    word = F.regexp_replace(F.lower(F.trim(F.coalesce(said, F.lit("")))), "[- ]", "_")
    return F.when(word.isin(*PROCESSES), word).otherwise(F.coalesce(looked_up(word, PROCESS_WORDS), F.lit("mixed")))


def needs_peer_review(confidence: Column, human: Column, flags: Column, serious: Sequence[str], least: float = 0.85) -> Column:
    """Too little confidence (none counts as 0), asked for by a human, or a serious flag."""
    return (F.coalesce(confidence, F.lit(0.0)) < least) | F.coalesce(human, F.lit(False)) | F.coalesce(F.arrays_overlap(flags, F.array(*map(F.lit, serious))), F.lit(False))
