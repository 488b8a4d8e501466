"""Articles, lists, documents, bundles and table versions."""

import pytest
from pyspark.sql import functions as F

from biblioscope.sources import articles as A

FULL = """<?xml version="1.0"?><pmc-articleset><article><front><journal-meta><journal-title>J <i>of</i> X</journal-title></journal-meta><article-meta>
<article-id pub-id-type="pmcid">PMC1</article-id><article-id pub-id-type="pmid">11</article-id><article-id pub-id-type="doi">10.1/x</article-id>
<title-group><article-title>On <b>BRCA1</b> now </article-title></title-group>
<contrib-group><contrib contrib-type="author"><name><surname>Ray</surname><given-names>Ann</given-names></name></contrib><contrib contrib-type="author"><name><surname>Lone</surname></name></contrib><contrib contrib-type="editor"><name><surname>Ed</surname></name></contrib><contrib contrib-type="author"><name><given-names>No</given-names></name></contrib></contrib-group>
<contrib-group><contrib contrib-type="author"><name><surname>Second</surname></name></contrib></contrib-group>
<pub-date pub-type="epub"><year>2019</year></pub-date><pub-date pub-type="ppub"><year>2020</year><month>3</month></pub-date>
<abstract><p>First <i>part</i>.</p><p><b>Opens</b> with a child</p></abstract><kwd-group><kwd>k1</kwd><kwd> </kwd></kwd-group></article-meta></front>
<body><sec sec-type="methods"><title>M</title><p>We did <i>it</i>.</p><sec><p>Nested</p></sec></sec><sec sec-type="ref"><p>skip</p></sec></body></article></pmc-articleset>"""
MINIMAL = "<x><article><front><article-meta/></front></article></x>"
BAD = {"root": "<article><front><article-meta/></front></article>", "malformed": "<a><b></a>", "nofront": "<x><article><body/></article></x>", "empty": ""}


def files(spark):
    rows = [("d/full.xml", FULL), ("d/mini.xml", MINIMAL)] + [(f"d/{k}.xml", v) for k, v in BAD.items()]
    return spark.createDataFrame([(u, bytearray(c, "utf-8")) for u, c in rows] + [("d/null.xml", None)], "uri string, content binary")


def test_articles(spark):
    got = {r.uri: r for r in A.parse_articles(files(spark)).collect()}
    assert set(got) == {"d/full.xml", "d/mini.xml"}
    full = got["d/full.xml"]
    assert (full.paper_id, full.pmid, full.doi, full.title, full.journal) == ("PMC1", "11", "10.1/x", "On BRCA1 now", "J of X")
    assert full.abstract == "First part. Opens with a child" and full.publication_date == "2020-03-01" and full.keywords == ["k1"]
    assert full.authors == ["Ray, Ann", "Lone"]
    assert [(p.paragraph_id, p.text) for p in full.paragraphs] == [("PMC1_abstract_para_0", "First"), ("PMC1_methods_para_0", "We did"), ("PMC1_methods_para_1", "Nested"), ("PMC1_body_para_2", "Nested")]
    mini = got["d/mini.xml"]
    assert (mini.paper_id, mini.title, mini.journal, mini.publication_date, mini.authors) == ("mini", "Untitled", "Unknown Journal", "0001-01-01", [])
    assert A.parse_articles(files(spark), keep_failed=True).where("paper_id IS NULL").count() == len(BAD) + 1  # and the file without content
    names = [(r.paper_id, r.name) for r in A.sections(A.parse_articles(files(spark))).orderBy("paper_id", "no").collect()]
    assert names == [("PMC1", "title"), ("PMC1", "abstract"), ("PMC1", "body"), ("mini", "title")]


def test_files_and_the_pluggable_source(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.xml").write_text(FULL)
    (tmp_path / "b.xml").write_text(BAD["malformed"])
    (tmp_path / "c.txt").write_text(FULL)
    assert A.article_files(spark, str(tmp_path)).count() == 2
    assert [r.paper_id for r in A.parse_articles(A.article_files(spark, str(tmp_path))).collect()] == ["PMC1"]
    spark.dataSource.register(A.ArticleSource)
    assert [(r.paper_id, r.title) for r in spark.read.format("articles").load(str(tmp_path)).collect()] == [("PMC1", "On BRCA1 now")]


def test_lists_and_fetching(spark):
    lines = spark.createDataFrame([(x,) for x in ["123456", " PMC7 ", "# PMC8", "", "PMC12x", "pmc9", None]], "value string")
    ids = A.paper_ids(lines)
    assert sorted(r.paper_id for r in ids.collect()) == ["PMC123456", "PMC7", "PMC9"]
    left = A.to_fetch(ids, spark.createDataFrame([("PMC7",)], "paper_id string"))
    got = {r.uri: r.content for r in A.fetch(left, lambda i: FULL.encode() if i == "PMC9" else None).collect()}
    assert bytes(got["PMC9"]) == FULL.encode() and got["PMC123456"] is None


def test_documents(spark):
    df = spark.createDataFrame([("a", "1", "10/x", "t", "abs", "full"), ("b", "2", " ", "t", None, None), ("c", None, None, "t", "x", ""), (None, None, None, "t", "x", "")], "paper_id string, pmid string, doi string, title string, abstract string, full_text string")
    assert sorted((r.document_id, r.content) for r in A.documents_of(df).collect()) == [("c", "x"), ("doi:10/x", "abs\n\nfull"), ("pmid:2", "")]
    with pytest.raises(Exception, match="without any id"):
        A.documents_of(df, strict=True).collect()


def test_bundle_and_entity_lines(spark, tmp_path):
    e = spark.createDataFrame([("C1", "disease", "old"), ("C2", "gene", "g")], "entity_id string, type string, name string")
    r = spark.createDataFrame([("C2", "causes", "C1")], "subject_id string, predicate string, object_id string")
    p = spark.createDataFrame([("P1", "t")], "paper_id string, title string")
    A.write_bundle(str(tmp_path / "bundle"), p, e, r, {"version": 1})
    m = spark.read.json(str(tmp_path / "bundle/manifest")).first()
    assert (m.entities, m.relationships, m.documents) == (2, 1, 1)
    lines = str(tmp_path / "lines")
    A.write_entities(e.coalesce(1), lines)
    assert sorted((x.entity_id, x.name) for x in A.read_entities(spark, lines, "entity_id string, type string, name string").collect()) == [("C1", "old"), ("C2", "g")]


def test_faults_counts_and_the_strict_reader(spark):
    good = b"<r><article><front><article-meta><title-group><article-title>T</article-title></title-group></article-meta></front></article></r>"
    rows = [("/a.xml", good), ("/b.xml", None), ("/c.txt", good), ("/d.xml", b"<r><article>"), ("/e.xml", b"<r/>")]
    files = spark.createDataFrame(rows, "uri string, content binary")
    assert {r.uri: r.fault for r in A.file_faults(files).collect()} == {"/b.xml": "missing", "/c.txt": "suffix", "/d.xml": "markup", "/e.xml": "article"}
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "paper_id string")
    assert tuple(A.fetch_counts(ids("1", "2", "3"), ids("3", "9"), files.limit(2)).first()) == (1, 1, 1)
    assert A.file_faults(files.limit(0)).count() == 0
    assert A.read_strict("/x/PMC77_v2.xml", good)["paper_id"] == "PMC77" and A.read_strict("/x/y.xml", good)["paper_id"] == "unknown"
    for bad in (b"<r><article>", b"<r/>"):
        with pytest.raises(ValueError):
            A.read_strict("/x.xml", bad)


def test_lines_carry_the_run(spark, tmp_path):
    import json

    e = spark.createDataFrame([("C1", "n", "t", None, ("old",)), ("C2", None, "t", ["s"], None)], "entity_id string, name string, type string, synonyms array<string>, provenance struct<pipeline: string>")
    run = {"pipeline_info": {"name": "p", "version": None}}
    got = {x["entity_id"]: x for x in (json.loads(r.value) for r in A.entity_lines(e, run).collect())}
    assert got["C1"]["synonyms"] == [] and got["C1"]["name"] == "n" and got["C2"]["name"] is None and got["C2"]["provenance"] == {"pipeline_info": {"name": "p", "version": None}}
    assert json.loads(A.entity_lines(e).where("value LIKE '%C1%'").first().value)["provenance"] == {"pipeline": "old"}
    A.write_lines(A.paper_lines(e, run), str(tmp_path / "papers"))
    assert spark.read.text(str(tmp_path / "papers")).count() == 2
    assert A.edge_lines(e.limit(0)).count() == 0
