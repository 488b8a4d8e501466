"""Article markup, id lists and paper JSON as DataFrames; graph bundles as directories of JSON lines."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Sections that are no body text.
NO_BODY = {"ref", "references", "ack", "acknowledgements"}
ARTICLE = (
    "uri string, paper_id string, pmid string, doi string, title string, journal string, abstract string, publication_date string,"
    " authors array<string>, keywords array<string>, body string, paragraphs array<struct<paragraph_id:string,section:string,text:string>>, abstract_only boolean"
)


def _text(node: ET.Element | None) -> str:
    return "".join(node.itertext()).strip() if node is not None else ""


def _date(meta: ET.Element) -> str:
    """Year, month and day of the print date, else of the first; 0001, 01 and 01 where they are missing."""
    node = meta.find(".//pub-date[@pub-type='ppub']")
    node = meta.find(".//pub-date") if node is None else node
    part = lambda name, default: (node.findtext(name) or default).strip() if node is not None else default
    return f"{part('year', '0001')}-{part('month', '01').zfill(2)}-{part('day', '01').zfill(2)}"


def _paragraphs(article: ET.Element, paper: str) -> Iterator[tuple[str, str, str]]:
    """Paragraphs of the abstract, then of body sections; each part counts from 0. A paragraph's text is what
    stands before its first child; a section within another is visited once more, as a section of its own."""
    n = 0
    for p in article.iterfind(".//abstract//p"):
        if (p.text or "").strip():
            yield f"{paper}_abstract_para_{n}", "abstract", p.text.strip()
            n += 1
    n = 0
    for section in article.iterfind(".//body//sec"):
        kind = section.get("sec-type") or "body"
        if kind.lower() in NO_BODY:
            continue
        for p in section.iterfind(".//p"):
            if (p.text or "").strip():
                yield f"{paper}_{kind}_para_{n}", kind, p.text.strip()
                n += 1


def read_article(uri: str, content: bytes) -> dict | None:
    """One article's fields; None for anything that cannot be read or has no article below its root."""
    try:
        root = ET.fromstring(content)
    except ET.ParseError:
        return None
    article = root.find(".//article")
    meta = article.find(".//front/article-meta") if article is not None else None
    if meta is None:
        meta = article.find(".//article-meta") if article is not None else None
    if meta is None:
        return None
    ids = {node.get("pub-id-type"): _text(node) for node in meta.iterfind("article-id")}
    stem = uri.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    paper = ids.get("pmcid") or stem
    group = meta.find("contrib-group")
    authors = []
    for contrib in group.iterfind("contrib[@contrib-type='author']") if group is not None else ():
        surname, given = (contrib.findtext("name/surname") or "").strip(), (contrib.findtext("name/given-names") or "").strip()
        if surname:
            authors.append(f"{surname}, {given}" if given else surname)
    paragraphs = [dict(zip(("paragraph_id", "section", "text"), p)) for p in _paragraphs(article, paper)]
    parts = {p["section"] == "abstract" for p in paragraphs}
    return {
        "uri": uri, "paper_id": paper, "pmid": ids.get("pmid"), "doi": ids.get("doi"), "title": _text(meta.find(".//article-title")) or "Untitled", "journal": _text(article.find(".//journal-title")) or "Unknown Journal",
        "abstract": " ".join(t for p in meta.iterfind(".//abstract//p") if (t := _text(p))), "publication_date": _date(meta), "authors": authors, "keywords": [t for k in meta.iterfind(".//kwd") if (t := _text(k))],
        "body": " ".join(t for p in article.iterfind(".//body//p") if (t := _text(p))), "paragraphs": paragraphs, "abstract_only": parts == {True},
    }


def read_strict(uri: str, content: bytes) -> dict:
    """One article as a document for which every fault is an error: ValueError for markup that cannot be read, or has no
    article. The id is the stored one, else the first 'PMC' with digits in the uri, else 'unknown'."""
    found = read_article(uri, content)
    if found is None:
        raise ValueError(f"no article in {uri}")
    if found["paper_id"] == uri.rsplit("/", 1)[-1].rsplit(".", 1)[0]:
        in_uri = re.search(r"PMC\d+", uri)
        found["paper_id"] = in_uri[0] if in_uri else "unknown"
    return found


def file_faults(files: DataFrame) -> DataFrame:
    """(uri, fault) of every file that is no article: 'missing' without content, 'suffix' for another ending than .xml,
    'markup' where it cannot be parsed, 'article' where none is in it. The first that holds; sound files give no row."""

    @F.pandas_udf("string")
    def fault(uris: pd.Series, contents: pd.Series) -> pd.Series:
        def one(uri: str | None, content: bytes | None) -> str | None:
            if content is None:
                return "missing"
            if not (uri or "").endswith(".xml"):
                return "suffix"
            try:
                root = ET.fromstring(bytes(content))
            except ET.ParseError:
                return "markup"
            return None if root.find(".//article") is not None else "article"

        return pd.Series([one(u, c) for u, c in zip(uris, contents)], dtype=object)

    return files.select("uri", fault("uri", "content").alias("fault")).where("fault IS NOT NULL")


def parse_articles(files: DataFrame, reader: Callable[[str, bytes], dict | None] = read_article, keep_failed: bool = False) -> DataFrame:
    """Articles of a DataFrame (uri, content); ``reader`` is exchangeable. What fails is dropped, or kept with a
    null paper_id. The standard parser runs per file, as SQL's xpath functions stop a whole job at bad markup."""
    names = [f.split()[0] for f in re.sub(r"<[^()]*?>(?=,|$)", "", ARTICLE.replace("array<struct<paragraph_id:string,section:string,text:string>>", "x")).split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for uri, content in zip(batch["uri"], batch["content"]):
                row = reader(uri, bytes(content)) if content is not None else None
                if row is not None or keep_failed:
                    rows.append(row or {"uri": uri})
            yield pd.DataFrame([[r.get(n) for n in names] for r in rows], columns=names, dtype=object)

    return files.select("uri", "content").mapInPandas(run, ARTICLE)


def article_files(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """(uri, content) of the files below a directory whose name fits."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("uri"), "content")


def sections(articles: DataFrame) -> DataFrame:
    """(paper_id, no, name, text): title, abstract and body, without empty ones; the body holds the abstract too."""
    body = F.trim(F.concat_ws(" ", "abstract", "body"))
    parts = F.array(*[F.struct(F.lit(n).alias("name"), c.alias("text")) for n, c in (("title", F.col("title")), ("abstract", F.col("abstract")), ("body", body))])
    return articles.select("paper_id", F.posexplode(F.filter(parts, lambda p: F.coalesce(p["text"], F.lit("")) != "")).alias("no", "s")).select("paper_id", "no", "s.name", "s.text")


def paper_ids(lines: DataFrame, column: str = "value") -> DataFrame:
    """(paper_id): valid ids of a list with comments and blank lines; a bare number gets its prefix."""
    line = F.trim(column)
    fixed = F.when(line.rlike(r"^\d+$"), F.concat(F.lit("PMC"), line)).otherwise(F.upper(line))
    return lines.where((line != "") & ~F.startswith(line, F.lit("#"))).select(fixed.alias("paper_id")).where(F.col("paper_id").rlike(r"^PMC\d+$"))


def to_fetch(wanted: DataFrame, held: DataFrame) -> DataFrame:
    """Ids that are wanted and not held yet."""
    return wanted.join(held.select("paper_id").distinct(), "paper_id", "left_anti")


def fetch_counts(wanted: DataFrame, held: DataFrame, fetched: DataFrame) -> DataFrame:
    """One row (ok, failed, skipped) of a download: ids that were held already are skipped, of the others those that came
    as a sound article are ok."""
    skipped = wanted.join(held.select("paper_id").distinct(), "paper_id", "left_semi").agg(F.count("*").alias("skipped"))
    bad = F.col("fault").isNotNull()
    tried = fetched.select("uri").join(file_faults(fetched), "uri", "left").agg(F.count_if(~bad).alias("ok"), F.count_if(bad).alias("failed"))
    one = F.lit(1).alias("_one")
    return tried.select("*", one).join(skipped.select("*", one), "_one").select("ok", "failed", "skipped")


def fetch(ids: DataFrame, load: Callable[[str], bytes | None]) -> DataFrame:
    """(uri, content) of every id by an exchangeable loader; what it cannot find has a null content."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"uri": batch["paper_id"], "content": [load(i) for i in batch["paper_id"]]}, dtype=object)

    return ids.select("paper_id").mapInPandas(run, "uri string, content binary")


def documents_of(papers: DataFrame, strict: bool = False) -> DataFrame:
    """(document_id, title, content): papers as documents, known by doi, pmid or id; in strict mode a paper with
    none of them is an error, else it is left out."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    key = F.coalesce(F.concat(F.lit("doi:"), blank("doi")), F.concat(F.lit("pmid:"), blank("pmid")), blank("paper_id"))
    if strict:
        key = F.coalesce(key, F.raise_error(F.lit("a paper without any id")).cast("string"))
    text = F.concat_ws("\n\n", blank("abstract"), blank("full_text")) if "full_text" in papers.columns else F.coalesce("abstract", F.lit(""))
    return papers.select(key.alias("document_id"), "title", text.alias("content")).where("document_id IS NOT NULL")


def run_struct(run: dict[str, dict[str, str | None]]) -> Column:
    """What is known of a run (its pipeline, model and execution) as a struct of constants. Nothing is read from the
    machine or the clock: the caller says it."""
    return F.struct(*[F.struct(*[F.lit(v).cast("string").alias(k) for k, v in part.items()]).alias(name) for name, part in run.items()])


def edge_lines(edges: DataFrame) -> DataFrame:
    """(value): one JSON line for each extraction edge, with all its fields; absent ones as null."""
    return edges.select(F.to_json(F.struct(*edges.columns), {"ignoreNullFields": "false"}).alias("value"))


def entity_lines(entities: DataFrame, run: dict[str, dict[str, str | None]] | None = None) -> DataFrame:
    """(value): one JSON line for each entity: id, name, type, synonyms (empty if there are none) and the provenance, of
    ``run`` if given, else the entity's own."""
    provenance = F.col("provenance") if run is None else run_struct(run)
    fields = F.struct("entity_id", "name", "type", F.coalesce("synonyms", F.array().cast("array<string>")).alias("synonyms"), provenance.alias("provenance"))
    return entities.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def paper_lines(papers: DataFrame, run: dict[str, dict[str, str | None]] | None = None) -> DataFrame:
    """(value): one JSON line for each paper with all its fields; with ``run`` its extraction provenance is that of the run."""
    rows = papers if run is None else papers.withColumn("extraction_provenance", run_struct(run))
    return rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    """A directory of text files; a job that fails leaves no success marker."""
    lines.select("value").write.mode("overwrite").text(path)


def write_entities(entities: DataFrame, path: str) -> None:
    """One JSON line for each entity: its type, and its fields under ``data``."""
    entities.select(F.col("type"), F.struct(*entities.columns).alias("data")).write.mode("overwrite").json(path)


def read_entities(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Entities of JSON lines; a later line with the same id replaces an earlier one."""
    lines = spark.read.schema(f"type string, data struct<{schema}>").json(path).withColumn("_at", F.struct(F.input_file_name(), F.monotonically_increasing_id()))
    return lines.groupBy("data.entity_id").agg(F.max_by("data", "_at").alias("d")).select("d.*")


def write_bundle(path: str, papers: DataFrame, entities: DataFrame, relationships: DataFrame, run: dict) -> None:
    """A graph as a directory: entities, relationships and documents as JSON lines, and a manifest of one row.

    ``run`` is what is known of the run (version, time, host); nothing is read from the clock. The manifest is
    written last, so a directory with one is whole."""
    frames = {"entities": entities, "relationships": relationships, "documents": papers}
    for name, df in frames.items():
        df.write.mode("overwrite").json(f"{path}/{name}")
    spark = papers.sparkSession
    counts = {name: spark.read.text(f"{path}/{name}").count() for name in frames}
    manifest = spark.createDataFrame([(sorted((str(k), str(v)) for k, v in run.items()), counts["entities"], counts["relationships"], counts["documents"])], "run array<struct<key:string,value:string>>, entities long, relationships long, documents long")
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


class _Files(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class _ArticleReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.parts = options["path"], int(options.get("partitions", 8))

    def partitions(self) -> list[InputPartition]:
        """The folder is listed once, here; a partition has the names of its files."""
        files = sorted(str(f) for f in Path(self.path).rglob("*.xml"))
        return [_Files(files[i :: self.parts]) for i in range(min(self.parts, max(1, len(files))))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for file in partition.files:
            if row := read_article(file, Path(file).read_bytes()):
                yield (row["uri"], row["paper_id"], row["title"], row["abstract"])


class ArticleSource(DataSource):
    """``spark.read.format("articles").load(folder)``: the pluggable form, for file systems all workers mount."""

    @classmethod
    def name(cls) -> str:
        return "articles"

    def schema(self) -> str:
        return "uri string, paper_id string, title string, abstract string"

    def reader(self, schema) -> DataSourceReader:
        return _ArticleReader(self.options)
