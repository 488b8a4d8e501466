"""Claims, evidence and mentions from text; packing of paragraphs; entities from mentions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioscope.functions import text as T

#: The wording that states each predicate, in the order in which predicates are tried.
CLAIM_PATTERNS = {
    "causes": [r"\bcaus(e|es|ed|ing)\b.*\b(aids|syndrome|disease|infection)", r"\bresponsible for\b", r"\bleads? to\b", r"\bresults? in\b"],
    "prevents": [r"\bprevent(s|ed|ing)?\b", r"\bprotect(s|ed|ing)? against\b", r"\breduc(e|es|ed|ing) risk\b"],
    "inhibits": [r"\binhibit(s|ed|ing)?\b", r"\bsuppress(es|ed|ing)?\b", r"\bblock(s|ed|ing)?\b"],
    "treats": [r"\btreat(s|ed|ment|ing)?\b", r"\btherap(y|eutic|ies)\b"],
    "diagnosed_by": [r"\bdiagnos(ed|is|tic)?\b.*\bby\b", r"\bdetected by\b"],
    "associated_with": [r"\bassociat(ed|ion)?\b.*\bwith\b", r"\blinked to\b", r"\bconnected to\b"],
    "interacts_with": [r"\binteract(s|ed|ion)?\b.*\bwith\b", r"\bcombine(s|ed|ing)?\b.*\bwith\b"],
    "indicates": [r"\bindicat(es|ed|ing)?\b", r"\bsuggest(s|ed|ing)?\b", r"\bdemonstrat(es|ed|ing)?\b"],
}
#: Words that are no mention, for extraction edges and for documents.
EDGE_STOPWORDS = ["the", "and", "or", "but", "with", "from", "that", "this", "these", "those", "their", "there"]
DOCUMENT_STOPWORDS = [*EDGE_STOPWORDS, "a", "an", "as", "at"]


#: Dictionary keys up to this number are joined as a broadcast, first words as a filter.
MOST_BROADCAST = 200_000


def _stem(pattern: str) -> str:
    """The letters that every match of a claim pattern begins with."""
    found = re.match(r"\\b([a-z ]+)(\??)", pattern)
    return found[1][:-1] if found[2] else found[1]


def says(sentence: Column, predicate: str, low: Column | None = None) -> Column:
    """Whether a sentence states a predicate. ``low`` is the sentence in lower case: a search for the letters that the
    wording begins with spares most sentences the patterns."""
    patterns = CLAIM_PATTERNS[predicate]
    low = F.lower(sentence) if low is None else low
    may = reduce(lambda a, b: a | b, (F.contains(low, F.lit(_stem(p))) for p in patterns))
    return may & sentence.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))


def first_predicate(sentence: Column, low: Column | None = None) -> Column:
    """The first predicate a sentence states, in the fixed order; null if none."""
    return reduce(lambda when, p: when.when(says(sentence, p, low), p), CLAIM_PATTERNS, F.when(F.lit(False), F.lit(None).cast("string")))


def claim_confidence(section: Column) -> Column:
    return F.when(section.isin("results", "abstract"), F.lit(0.7) + 0.1).when(section == "methods", F.lit(0.7) - 0.1).otherwise(0.7)


def sentence_rows(paragraphs: DataFrame, least: int = 20) -> DataFrame:
    """(paragraph_id, paper_id, section, no, sentence) of sentences of at least ``least`` characters."""
    parted = paragraphs.select("paragraph_id", "paper_id", "section", F.posexplode(T.sentences(F.col("text"))).alias("no", "sentence"))
    return parted.where(F.length("sentence") >= least)


def claims(paragraphs: DataFrame, as_read: bool = False) -> DataFrame:
    """One claim for each sentence that states a predicate, numbered within its paragraph.

    With ``as_read`` the published reader's slip is kept: a sentence that repeats the last one that matched is
    tried for causes alone. A paragraph's sentences are folded within its row, so the work needs no shuffle.
    """
    kept = F.transform(F.filter(T.sentences(F.col("text")), lambda s: F.length(s) >= 20), lambda s: F.struct(s.alias("s"), F.lower(s).alias("low")))
    found = F.transform(kept, lambda x: F.struct(x["s"].alias("sentence"), first_predicate(x["s"], x["low"]).alias("predicate")))
    if as_read:
        start = F.struct(F.lit("").alias("last"), F.array().cast("array<struct<sentence:string,predicate:string>>").alias("out"))
        step = lambda acc, x: F.when(
            x["predicate"].isNotNull() & ((x["sentence"] != acc["last"]) | (x["predicate"] == "causes")),
            F.struct(x["sentence"].alias("last"), F.concat(acc["out"], F.array(x)).alias("out")),
        ).otherwise(acc)
        listed = F.aggregate(found, start, step)["out"]
    else:
        listed = F.filter(found, lambda x: x["predicate"].isNotNull())
    rows = paragraphs.select("paragraph_id", "paper_id", "section", F.posexplode(listed).alias("no", "c"))
    claim = F.concat_ws("_", F.col("paragraph_id"), F.lit("claim"), F.col("no"))
    return rows.select(
        F.concat(F.lit("PLACEHOLDER_SUBJECT_"), claim).alias("subject_id"), F.col("c.predicate").alias("predicate"), F.concat(F.lit("PLACEHOLDER_OBJECT_"), claim).alias("object_id"),
        claim_confidence(F.col("section")).alias("confidence"), "paper_id", "section", F.col("c.sentence").alias("text_span"), F.lit("observational").alias("study_type"), F.lit("pattern_match").alias("extraction_method"),
    )


def all_claims(paragraphs: DataFrame) -> DataFrame:
    """One row for each predicate a sentence states, up to one for each group of patterns."""
    rows = sentence_rows(paragraphs).withColumn("low", F.lower("sentence"))
    stated = F.filter(F.array(*[F.when(says(F.col("sentence"), p, F.col("low")), F.lit(p)) for p in CLAIM_PATTERNS]), lambda p: p.isNotNull())
    return rows.select("paragraph_id", "paper_id", "section", "no", "sentence", F.explode(stated).alias("predicate"))


def dictionary_mentions(paragraphs: DataFrame, index: DataFrame) -> DataFrame:
    """(paragraph_id, pos, n_words, entity_id): where the words of a dictionary's keys stand in paragraphs.

    Keys and texts are cut to words in lower case. Each word of a text that a key begins with goes out once, with as many
    words after it as the longest key has, and meets the keys it begins by an equi-join. The keys are broadcast only
    up to MOST_BROADCAST of them; of more, the different first words up to that number are a filter before the shuffle, and
    beyond it every word is sent. The longest key and the numbers are looked up when the plan is built."""
    word = r"[\p{L}\p{N}\-]+"
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(word), F.lit(0))
    keys = index.select("entity_id", words(F.col("key")).alias("run")).where(F.size("run") > 0).distinct().withColumn("first", F.get("run", F.lit(0)))
    known = keys.agg(F.max(F.size("run")).alias("words"), F.count("*").alias("keys"), F.count_distinct("first").alias("firsts")).first()
    most_words = known["words"] or 1
    runs = F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.struct(i.alias("pos"), F.slice("w", i + 1, F.lit(most_words)).alias("next")))
    at = paragraphs.select("paragraph_id", words(F.col("text")).alias("w")).where(F.size("w") > 0).select("paragraph_id", F.explode(runs).alias("r")).select("paragraph_id", "r.pos", "r.next", F.get("r.next", F.lit(0)).alias("first"))
    if known["keys"] <= MOST_BROADCAST:
        keys = F.broadcast(keys)
    elif known["firsts"] <= MOST_BROADCAST:
        at = at.join(F.broadcast(keys.select("first").distinct()), "first", "left_semi")
    met = at.join(keys, "first").where(F.slice("next", F.lit(1), F.size("run")) == F.col("run"))
    return met.select("paragraph_id", "pos", F.size("run").alias("n_words"), "entity_id")


def paired_claims(claim_rows: DataFrame, mentions: DataFrame, names: DataFrame) -> DataFrame:
    """Claims with two different entities of their paragraph: the first two of which a name stands in the sentence.

    ``mentions`` is (paragraph_id, entity_id, pos), ``names`` (entity_id, name) with a row for each name and synonym. Names
    meet sentences by paragraph, not by a search of every name in every sentence. Up to MOST_BROADCAST names are a broadcast that
    meets the claims after their mentions do, so no name is shuffled; more of them meet the mentions first."""
    placed = mentions.select("paragraph_id", "entity_id", "pos")
    if names.count() <= MOST_BROADCAST:
        met = claim_rows.join(placed, "paragraph_id").join(F.broadcast(names.select("entity_id", "name")), "entity_id")
    else:
        met = claim_rows.join(placed.join(names.select("entity_id", "name"), "entity_id"), "paragraph_id")
    met = met.where(F.contains(F.lower("sentence"), F.lower("name")))
    ends = met.groupBy("paragraph_id", "no", "predicate", "sentence").agg(F.array_sort(F.collect_set(F.struct("pos", "entity_id"))).alias("m"))
    return ends.where(F.size("m") > 1).select("paragraph_id", "no", "predicate", F.get("m", F.lit(0))["entity_id"].alias("subject_id"), F.get("m", F.lit(1))["entity_id"].alias("object_id"))


def evidence(paragraphs: DataFrame) -> DataFrame:
    """(paragraph_id, paper_id, section, sample_size, p_value, confidence, text_span) of paragraphs with a
    sample size, a rate or a p value other than 0; the rate decides but is not kept."""
    read = paragraphs.withColumn("sample_size", T.sample_size(F.col("text"))).withColumn("p_value", T.p_value(F.col("text"))).withColumn("rate", T.percentage(F.col("text")))
    some = lambda c: F.coalesce(F.col(c) != 0, F.lit(False))
    return read.where(some("sample_size") | some("p_value") | some("rate")).select(
        "paragraph_id", "paper_id", F.coalesce("section", F.lit("results")).alias("section"), "sample_size", "p_value",
        F.round(T.evidence_strength(F.col("sample_size"), F.col("p_value")), 6).alias("confidence"), F.substring("text", 1, 500).alias("text_span"),
    )


def clean_mentions(mentions: DataFrame, least: float = 0.85, stopwords: list[str] = EDGE_STOPWORDS) -> DataFrame:
    """Mentions of at least three characters that are no word piece or stop word and sure enough."""
    name = T.strip(F.col("name"))
    return mentions.withColumn("name", name).where((F.length(name) >= 3) & ~F.startswith(name, F.lit("##")) & ~F.lower(name).isin(stopwords) & (F.col("confidence") >= least))


def first_mentions(mentions: DataFrame) -> DataFrame:
    """The first mention of each name (in any case) in each document."""
    first = F.row_number().over(Window.partitionBy("paper_id", F.lower("name")).orderBy("pos"))
    return mentions.withColumn("_n", first).where("_n = 1").drop("_n")


def places(text: Column, word: str) -> Column:
    """Where a word begins in a text, each time it stands there; counted from 0."""
    parts = F.split(text, rf"\Q{word}\E", -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))

    def step(acc: Column, part: Column) -> Column:
        at = acc["at"] + F.length(part)
        return F.struct((at + len(word)).alias("at"), F.concat(acc["found"], F.array(at)).alias("found"))

    return F.aggregate(F.slice(parts, 1, F.size(parts) - 1), start, step)["found"]


def context(text: Column, start: Column, end: Column, width: int = 50) -> Column:
    """The characters around a mention; start counts from 0, end is exclusive."""
    left = F.greatest(start - width, F.lit(0))
    return F.substring(text, left + 1, end + width - left)


def packed(paragraph_texts: Column, size: int = 8000) -> Column:
    """Paragraphs joined to chunks of about ``size`` characters: a chunk ends where the next one would pass it."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"), F.lit(0).alias("length"))

    def step(acc: Column, p: Column) -> Column:
        full = acc["open"].isNotNull() & (acc["length"] + F.length(p) > size)
        return (
            F.when(full, F.struct(F.concat(acc["done"], F.array(acc["open"])).alias("done"), p.alias("open"), F.length(p).alias("length")))
            .when(acc["open"].isNull(), F.struct(acc["done"].alias("done"), p.alias("open"), (acc["length"] + F.length(p) + 2).alias("length")))
            .otherwise(F.struct(acc["done"].alias("done"), F.concat(acc["open"], F.lit("\n\n"), p).alias("open"), (acc["length"] + F.length(p) + 2).alias("length")))
        )

    return F.aggregate(paragraph_texts, start, step, lambda acc: F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))


def packed_chunks(paragraphs: DataFrame, size: int = 8000) -> DataFrame:
    """(paper_id, no, text) of (paper_id, paragraph_id, text): each paper's paragraphs packed in the order of their ids.

    Only lengths are put in order, and read as a stream that carries the length of the open chunk; the texts meet by
    chunk, so a paper of any size is never one row. Rows without paper or text are left out. The joining blank line counts 2."""
    fine = paragraphs.where("paper_id IS NOT NULL AND text IS NOT NULL")
    ordered = fine.select("paper_id", "paragraph_id", F.length("text").alias("n")).repartition("paper_id").sortWithinPartitions("paper_id", "paragraph_id")

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paper, no, length, begun = None, 0, 0, False
        for batch in batches:
            out = []
            for p, n in zip(batch["paper_id"], batch["n"]):
                if p != paper:
                    paper, no, length, begun = p, 0, 0, False
                if begun and length + n > size:
                    no, length = no + 1, n
                else:
                    length += n + 2
                begun = True
                out.append(no)
            yield pd.DataFrame({"paper_id": batch["paper_id"], "paragraph_id": batch["paragraph_id"], "no": out})

    numbered = ordered.mapInPandas(number, "paper_id string, paragraph_id string, no bigint")
    parts = fine.select("paper_id", "paragraph_id", "text").join(numbered, ["paper_id", "paragraph_id"]).groupBy("paper_id", "no").agg(F.array_sort(F.collect_list(F.struct("paragraph_id", "text"))).alias("p"))
    return parts.select("paper_id", "no", F.array_join(F.transform("p", lambda x: x["text"]), "\n\n").alias("text"))


def with_found_evidence(triples: DataFrame) -> DataFrame:
    """Triples (their three parts, ``evidence`` as texts, ``items`` of evidence) with what their first text gives
    appended to ``items``: (sample_size, p_value, confidence, text_span). One row for each triple, as an upsert."""
    first = triples.withColumn("text", F.get("evidence", F.lit(0)))
    read = first.withColumn("sample_size", T.sample_size(F.col("text"))).withColumn("p_value", T.p_value(F.col("text"))).withColumn("rate", T.percentage(F.col("text")))
    some = reduce(lambda a, b: a | b, (F.coalesce(F.col(c) != 0, F.lit(False)) for c in ("sample_size", "p_value", "rate")))
    item = F.struct("sample_size", "p_value", F.round(T.evidence_strength(F.col("sample_size"), F.col("p_value")), 6).alias("confidence"), F.substring("text", 1, 500).alias("text_span"))
    return read.withColumn("items", F.when(some, F.concat("items", F.array(item))).otherwise(F.col("items"))).drop("text", "sample_size", "p_value", "rate")


def slices(text: Column, size: int) -> Column:
    """A text in pieces of ``size`` characters."""
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), F.floor((F.length(text) - 1) / size).cast("int")), lambda i: F.substring(text, i * size + 1, F.lit(size))))


def entities_from_mentions(mentions: DataFrame) -> DataFrame:
    """(entity_id, name, synonyms, n): the first form seen is the name, the others are synonyms in order.

    ``seq`` orders the mentions. Forms are counted first, so an entity's rows meet as its different forms."""
    forms = mentions.withColumn("entity_id", T.canonical_id(F.col("name"))).groupBy("entity_id", "name").agg(F.min("seq").alias("seq"), F.count("*").alias("n"))
    listed = forms.groupBy("entity_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "name"))), lambda x: x["name"]).alias("forms"), F.sum("n").alias("n"))
    return listed.select("entity_id", F.get("forms", F.lit(0)).alias("name"), F.slice("forms", F.lit(2), F.size("forms")).alias("synonyms"), "n")


def resolve_mentions(mentions: DataFrame, entities: DataFrame) -> DataFrame:
    """Mentions with an entity: a known id as it is; another gets a provisional id and half the confidence."""
    known = entities.select(F.col("entity_id").alias("known_id")).distinct()
    joined = mentions.join(known, F.col("hint") == F.col("known_id"), "left")
    provisional = F.concat(F.lit("prov:"), F.sha2(F.concat_ws("|", "paper_id", F.col("pos").cast("string")), 256))
    return joined.select("paper_id", "pos", "name", F.coalesce("known_id", provisional).alias("entity_id"), F.when(F.col("known_id").isNull(), F.col("confidence") * 0.5).otherwise(F.col("confidence")).alias("confidence"))
