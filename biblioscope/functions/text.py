"""Text expressions that stay in the JVM: trimming, sentences, numbers read from prose, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: How sample sizes, rates and p values are written in prose.
SAMPLE_N = r"(?i)\bn\s*=\s*(\d+)"
SAMPLE_COUNTED = r"(?i)\b(\d+)\s+(?:samples|patients|subjects|nodes|lymph nodes|individuals|cases)"
PERCENT = r"(\d+(?:\.\d+)?)\s*%"
RATIO = r"(\d+)\s*(?:/|of)\s*(\d+)"
P_SHORT = r"(?i)\bp\s*[<>=]\s*(0?\.\d+|[01](?:\.\d+)?)"
P_LONG = r"(?i)p\s*-\s*value\s*[<>=]\s*(0?\.\d+|[01](?:\.\d+)?)"


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends (SQL's trim takes spaces only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def sentences(c: Column) -> Column:
    """The stripped parts between full stops, exclamation and question marks."""
    return F.transform(F.split(c, r"[.!?]+"), strip)


def _number(c: Column, pattern: str, group: int, kind: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit("")).try_cast(kind)


def sample_size(c: Column) -> Column:
    """The n of 'n = 302', else of '302 patients'; null if there is none."""
    return F.coalesce(_number(c, SAMPLE_N, 1, "bigint"), _number(c, SAMPLE_COUNTED, 1, "bigint"))


def percentage(c: Column) -> Column:
    """'59%' as 0.59, else 'a/b' or 'a of b' as a fraction; null for a zero denominator."""
    percent = _number(c, PERCENT, 1, "double") / 100.0
    return F.coalesce(percent, F.try_divide(_number(c, RATIO, 1, "double"), _number(c, RATIO, 2, "double")))


def p_value(c: Column) -> Column:
    """The p of 'p < 0.05', else of 'p-value = 0.05'; null if there is none."""
    return F.coalesce(_number(c, P_SHORT, 1, "double"), _number(c, P_LONG, 1, "double"))


def evidence_strength(n: Column, p: Column) -> Column:
    """0.5 moved by sample size and p value, between 0 and 1; null and 0 count as missing."""
    by_n = F.when(n >= 1000, 0.2).when(n >= 100, 0.1).when((n < 10) & (n != 0), -0.1).otherwise(0.0)
    by_p = F.when((p < 0.001) & (p != 0), 0.2).when((p < 0.01) & (p != 0), 0.1).when(p >= 0.05, -0.1).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(0.5) + by_n + by_p))


def canonical_id(name: Column) -> Column:
    return F.concat(F.lit("DISEASE:"), F.replace(F.lower(name), F.lit(" "), F.lit("_")))


def ontology_of(entity_id: Column, entity_type: Column) -> Column:
    """A map of one: the ontology an id belongs to, by its prefix or else by the entity's type, to the id."""
    prefix = F.lower(F.split_part(entity_id, F.lit(":"), F.lit(1)))
    key = (
        F.when(F.contains(entity_id, F.lit(":")), prefix)
        .when((entity_type == "disease") & entity_id.rlike(r"^C\d+$"), "umls")
        .when(entity_type == "gene", "hgnc")
        .when(entity_type == "drug", "rxnorm")
        .when((entity_type == "protein") & entity_id.rlike("^[PQ]"), "uniprot")
    )
    return F.when(key.isNull(), F.create_map().cast("map<string,string>")).otherwise(F.create_map(key, entity_id))


def label_type(label: Column) -> Column:
    """The entity type of a recogniser's label."""
    up = F.upper(label)
    has = lambda *words: F.greatest(*[F.contains(up, F.lit(w)) for w in words]) if len(words) > 1 else F.contains(up, F.lit(words[0]))
    return F.when(has("DISEASE"), "disease").when(has("GENE", "PROTEIN"), "gene").when(has("DRUG", "CHEMICAL"), "drug").otherwise("disease")


def json_part(c: Column) -> Column:
    """The JSON in a chatty answer: from the first '[' or '{', whichever comes first, to the last that closes it;
    else from the other; null if neither parses."""
    part = lambda o, e: F.try_parse_json(F.nullif(F.regexp_extract(c, rf"(?s)(\{o}.*\{e})", 1), F.lit("")))
    listed, mapped = part("[", "]"), part("{", "}")
    at = lambda o: F.nullif(F.instr(c, o), F.lit(0))
    return F.when(at("{") < F.coalesce(at("["), F.lit(2**31 - 1)), F.coalesce(mapped, listed)).otherwise(F.coalesce(listed, mapped))


def entity_text(name: Column, synonyms: Column, abbreviations: Column) -> Column:
    """What an entity is embedded by: its name, five synonyms and three abbreviations."""
    none = F.array().cast("array<string>")
    return F.array_join(F.concat(F.array(name), F.slice(F.coalesce(synonyms, none), 1, 5), F.slice(F.coalesce(abbreviations, none), 1, 3)), " ")


def hash_vector(text: Column, dim: int = 32) -> Column:
    """A vector of unit length from the bytes of a digest of the text, at most 32 long; for tests without a model."""
    digest = F.sha2(F.lower(text), 256)
    raw = F.transform(F.sequence(F.lit(0), F.lit(min(dim, 32) - 1)), lambda i: F.conv(F.substring(digest, i * 2 + 1, F.lit(2)), 16, 10).cast("double") / 255.0)
    norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(raw, lambda x: F.try_divide(x, norm))
