"""Queries: markup, documents, id lists and event windows (S, streaming extension)."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblioscope.plans import graph
from biblioscope.sources import articles as A
from biblioscope.session import table
from biblioscope.streaming import events as E


def _files(s, d):
    """Papers of the table as article markup: what an archive of them would hold."""
    esc = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    esc_c = lambda c: esc(F.regexp_replace(c, r"[\x00-\x08\x0b-\x1f\x{fffe}\x{ffff}]", ""))
    p = table(s, d, "papers").groupBy("paper_id").agg(*[F.max(c).alias(c) for c in ("title", "abstract", "journal", "authors", "publication_date", "doi", "pmid")], F.max("metadata.mesh_terms").alias("terms"))
    # the paragraphs of a paper that are documents are its body, a part for each section
    texts = table(s, d, "documents").where("text IS NOT NULL AND paper_id IS NOT NULL").groupBy("paper_id", F.coalesce("section", F.lit("body")).alias("part")).agg(F.array_sort(F.collect_list(F.struct("paragraph_id", "text"))).alias("ps"))
    part = F.concat(F.lit('<sec sec-type="'), F.col("part"), F.lit('">'), F.array_join(F.transform("ps", lambda x: F.concat(F.lit("<p>"), esc_c(x["text"]), F.lit("</p>"))), ""), F.lit("</sec>"))
    bodies = texts.groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", part.alias("xml")))), lambda x: x["xml"]), "").alias("body"))
    p = p.join(bodies, "paper_id", "left")
    none = F.array().cast("array<string>")
    contribs = F.array_join(F.transform(F.coalesce("authors", F.array().cast("array<string>")), lambda a: F.concat(F.lit('<contrib contrib-type="author"><name><surname>'), esc(F.split_part(a, F.lit(", "), F.lit(1))), F.lit("</surname><given-names>"), esc(F.split_part(a, F.lit(", "), F.lit(2))), F.lit("</given-names></name></contrib>"))), "")
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), esc_c(c), F.lit(f"</{name.split(' ')[0]}>"))
    xml = F.concat(
        F.lit("<pmc-articleset><article><front><journal-meta>"), tag("journal-title", F.col("journal")), F.lit("</journal-meta><article-meta>"), tag('article-id pub-id-type="pmcid"', F.col("paper_id")), tag('article-id pub-id-type="doi"', F.col("doi")), tag('article-id pub-id-type="pmid"', F.col("pmid")),
        F.lit("<title-group>"), tag("article-title", F.col("title")), F.lit("</title-group><contrib-group>"), contribs, F.lit('</contrib-group><pub-date pub-type="ppub">'), tag("year", F.substring("publication_date", 1, 4)), tag("month", F.substring("publication_date", 6, 2)),
        F.lit("</pub-date><abstract>"), tag("p", F.col("abstract")), F.lit("</abstract><kwd-group>"), F.array_join(F.transform(F.coalesce("terms", none), lambda t: tag("kwd", t)), ""), F.lit("</kwd-group></article-meta></front><body>"), F.coalesce("body", F.lit("")), F.lit("</body></article></pmc-articleset>"),
    )
    return p.select(F.concat(F.lit("/"), "paper_id", F.lit(".xml")).alias("uri"), F.encode(xml, "utf-8").alias("content"))


def _parsed(s, d):
    return A.parse_articles(_files(s, d).repartition("uri"))


def _articles(s, d):
    columns = [F.array_join(c, "|").alias(c) for c in ("authors", "keywords")]
    return _parsed(s, d).select("paper_id", "pmid", "doi", "title", "journal", "abstract", F.substring("publication_date", 1, 7).alias("month"), *columns, "abstract_only")


def _paragraph_rows(s, d):
    """Every paragraph of the markup's bodies and abstracts, by the operator."""
    return _parsed(s, d).select("paper_id", F.explode("paragraphs").alias("p")).select("paper_id", "p.paragraph_id", "p.section", F.length("p.text").cast("long").alias("n_chars"), F.md5("p.text").alias("digest"))


#: A run as its caller knows it.
RUN = {"pipeline_info": {"name": "nightly", "version": "3", "git_commit": "abc"}, "model_info": {"name": "m", "provider": None}, "execution_info": {"timestamp": "2025-01-01T00:00:00", "hostname": "h"}}


def _ids(s, d):
    """Ids of papers as a list would hold them: bare numbers, comments, blank lines, malformed ones."""
    k = F.substring("paper_id", 4, 20)
    n = F.pmod(F.substring("paper_id", -1, 1).cast("int"), F.lit(5))
    lines = table(s, d, "papers").select(F.when(n == 0, k).when(n == 1, F.concat(F.lit("# "), k)).when(n == 2, F.concat(F.lit("  "), "paper_id", F.lit(" "))).when(n == 3, F.concat(F.lit("PMC"), k, F.lit("x"))).otherwise(F.lower("paper_id")).alias("value"))
    return A.paper_ids(lines)


def _sections(s, d):
    return A.sections(_parsed(s, d)).select("paper_id", F.col("no").cast("long").alias("no"), "name", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest"))


def _streamed(s, d):
    """The events as they come to their folder, counted by window in one run to the end of the stream."""
    stream = E.event_stream(s, d)
    return E.streamed_table(E.windowed(stream), ["start", "event_type"]).select("start", "event_type", "n", "total")


def _broken(s, d):
    """The papers' files, one in five of them spoilt in some way."""
    k = F.pmod(F.xxhash64("uri"), F.lit(20))
    text = F.decode("content", "utf-8")
    return _files(s, d).select(
        F.when(k == 0, F.concat("uri", F.lit(".txt"))).otherwise(F.col("uri")).alias("uri"),
        F.when(k == 1, F.lit(None)).when(k == 2, F.encode(F.substring(text, 1, 200), "utf-8")).when(k == 3, F.encode(F.replace(F.replace(text, F.lit("<article>"), F.lit("<entry>")), F.lit("</article>"), F.lit("</entry>")), "utf-8")).otherwise(F.col("content")).alias("content"),
    )


def _download(s, d):
    """Papers as wanted, those with results held, and the files of the others as a download would bring them."""
    wanted = table(s, d, "papers").select("paper_id").where("paper_id IS NOT NULL").distinct()
    held = table(s, d, "documents").where("section = 'results'")
    missing = A.to_fetch(wanted, held).select(F.concat(F.lit("/"), "paper_id", F.lit(".xml")).alias("uri"))
    return wanted, held, _files(s, d).join(missing, "uri", "left_semi")


QUERIES = {
    "s1_articles": _articles,
    "s10_id_list": _ids,
    "s11_to_fetch": lambda s, d: A.to_fetch(table(s, d, "papers").select("paper_id").where("paper_id IS NOT NULL").distinct(), table(s, d, "documents").where("section = 'results'")),
    "s12_documents": lambda s, d: A.documents_of(table(s, d, "papers")),
    "s14_sections": _sections,
    "s15_paragraphs": _paragraph_rows,
    "s16_paragraph_counts": lambda s, d: _paragraph_rows(s, d).groupBy("paper_id", "section").agg(F.count("*").alias("n")),
    "s6_file_faults": lambda s, d: A.file_faults(_broken(s, d)),
    "s11_fetch_counts": lambda s, d: A.fetch_counts(*_download(s, d)),
    "s18_edge_lines": lambda s, d: A.edge_lines(table(s, d, "extraction_edges").drop("confidence", "extracted_at", "ingested_at")),
    "s19_entity_lines": lambda s, d: A.entity_lines(table(s, d, "entities"), RUN),
    "s20_paper_lines": lambda s, d: A.paper_lines(table(s, d, "papers").select("paper_id", "pmid", "title", "authors", "publication_date"), RUN),
    "stream_to_table": _streamed,
    "stream_windows": lambda s, d: E.windowed(table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))),
    "stream_sessions": lambda s, d: E.sessions(table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))).select("user_id", "start", "n"),
}
# control characters, which markup cannot hold, go; white space at the ends is stripped (of a paragraph any kind, as Python sees it)
_SPACE = "[\\x09-\\x0d\\x1c-\\x20\\x85\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


def _trim(c: str) -> str:
    clean = f"regexp_replace(coalesce({c}, ''), '[\\x00-\\x08\\x0b-\\x1f\\x{{fffe}}\\x{{ffff}}]', '', 'g')"
    return f"regexp_replace({clean}, '^{_SPACE}|{_SPACE}$', '', 'g')"


_PAPERS = f"WITH p AS (SELECT paper_id, max(title) AS title, max(abstract) AS abstract, max(journal) AS journal, max(authors) AS authors, max(publication_date) AS d, max(doi) AS doi, max(pmid) AS pmid, max(metadata.mesh_terms) AS terms FROM papers GROUP BY 1), b AS (SELECT paper_id, coalesce(section, 'body') AS section, paragraph_id, {_trim('text')} AS text FROM documents WHERE text IS NOT NULL AND paper_id IN (SELECT paper_id FROM papers)), a AS (SELECT paper_id, {_trim('abstract')} AS text FROM p)"
_PARAGRAPHS = _PAPERS + """, n AS (SELECT paper_id, paper_id || '_abstract_para_0' AS paragraph_id, 'abstract' AS section, text FROM a WHERE text <> ''
UNION ALL SELECT paper_id, paper_id || '_' || section || '_para_' || (row_number() OVER (PARTITION BY paper_id ORDER BY section, paragraph_id) - 1), section, text FROM b WHERE text <> '')"""
_RUN = "{'pipeline_info': {'name': 'nightly', 'version': '3', 'git_commit': 'abc'}, 'model_info': {'name': 'm', 'provider': NULL::VARCHAR}, 'execution_info': {'timestamp': '2025-01-01T00:00:00', 'hostname': 'h'}}"
SQL = {
    "s1_articles": _PAPERS + f" SELECT paper_id, {_trim('pmid')} AS pmid, {_trim('doi')} AS doi, coalesce(nullif({_trim('title')}, ''), 'Untitled') AS title, coalesce(nullif({_trim('journal')}, ''), 'Unknown Journal') AS journal, {_trim('abstract')} AS abstract, CASE WHEN coalesce(d, '') = '' THEN '0001-01' ELSE substring(d, 1, 7) END AS month, coalesce(array_to_string(authors, '|'), '') AS authors, coalesce(array_to_string(list_filter([{_trim('t')} for t in terms], lambda t: t <> ''), '|'), '') AS keywords, ({_trim('abstract')} <> '' OR paper_id IN (SELECT paper_id FROM b WHERE text <> '')) AND paper_id NOT IN (SELECT paper_id FROM b WHERE text <> '' AND section <> 'abstract') AS abstract_only FROM p",
    "s10_id_list": "SELECT paper_id FROM papers WHERE substring(paper_id, -1)::INT % 5 IN (0, 2, 4)",
    "s11_to_fetch": "SELECT DISTINCT paper_id FROM papers WHERE paper_id IS NOT NULL AND paper_id NOT IN (SELECT paper_id FROM documents WHERE section = 'results' AND paper_id IS NOT NULL)",
    "s11_fetch_counts": "WITH w AS (SELECT DISTINCT paper_id, paper_id IN (SELECT paper_id FROM documents WHERE section = 'results' AND paper_id IS NOT NULL) AS held FROM papers WHERE paper_id IS NOT NULL) SELECT count(*) FILTER (NOT held) AS ok, 0::BIGINT AS failed, count(*) FILTER (held) AS skipped FROM w",
    "s12_documents": "SELECT coalesce('doi:' || nullif(trim(doi), ''), 'pmid:' || nullif(trim(pmid), ''), nullif(trim(paper_id), '')) AS document_id, title, coalesce(abstract, '') AS content FROM papers WHERE coalesce(nullif(trim(doi), ''), nullif(trim(pmid), ''), nullif(trim(paper_id), '')) IS NOT NULL",
    "s14_sections": _PAPERS + f", t AS (SELECT paper_id, string_agg(text, ' ' ORDER BY section, paragraph_id) AS text FROM b WHERE text <> '' GROUP BY 1), x AS (SELECT p.paper_id, list_filter([{{'name': 'title', 'text': coalesce(nullif({_trim('title')}, ''), 'Untitled')}}, {{'name': 'abstract', 'text': a.text}}, {{'name': 'body', 'text': trim(a.text || ' ' || coalesce(t.text, ''))}}], lambda s: s.text <> '') AS parts FROM p JOIN a ON a.paper_id = p.paper_id LEFT JOIN t ON t.paper_id = p.paper_id) SELECT paper_id, no, s.name AS name, length(s.text) AS n_chars, md5(s.text) AS digest FROM (SELECT paper_id, unnest(range(len(parts))) AS no, unnest(parts) AS s FROM x)",
    "s15_paragraphs": _PARAGRAPHS + " SELECT paper_id, paragraph_id, section, length(text) AS n_chars, md5(text) AS digest FROM n",
    "s16_paragraph_counts": _PARAGRAPHS + " SELECT paper_id, section, count(*) AS n FROM n GROUP BY 1, 2",
    "s18_edge_lines": "SELECT to_json({'id': id, 'subject': subject, 'object': object, 'provenance': provenance, 'extractor': extractor})::VARCHAR AS value FROM extraction_edges",
    "s19_entity_lines": "SELECT to_json({'entity_id': entity_id, 'name': name, 'type': type, 'synonyms': coalesce(synonyms, []), 'provenance': " + _RUN + "})::VARCHAR AS value FROM entities",
    "s20_paper_lines": "SELECT to_json({'paper_id': paper_id, 'pmid': pmid, 'title': title, 'authors': authors, 'publication_date': publication_date, 'extraction_provenance': " + _RUN + "})::VARCHAR AS value FROM papers",
    "stream_windows": "SELECT time_bucket(INTERVAL '1 hour', ts)::TIMESTAMP AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2",
    "stream_to_table": "SELECT time_bucket(INTERVAL '1 hour', ts)::TIMESTAMP AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2",
    "stream_sessions": "WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, min(ts) AS start, count(*) AS n FROM g GROUP BY user_id, k",
}
