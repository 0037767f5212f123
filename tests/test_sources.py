import datetime
import json
import os

from pyspark.sql import functions as F

from textquarry.functions.stopwords import full_stopwords
from textquarry.sources import papers as P
from textquarry.sources import load_corpus, paper_documents, read_metadata, read_papers

META = '''idx,sha,title,doi,pubmed_id,authors,journal,publish_time,abstract,url
0,s1,"Virus, spread and cells",10.1/a,11,"Smith, J;Lee, K;Wong, P",J1,2020-03-05,"ab, with comma",u
1,s2,NA,,12,"Solo, A",J2,2019,"multi
line",u
2,s3,Third title,10.1/c,13,,J1,not-a-date,x,u
3,s4,Fourth,10.1/d,14,"One;Two",,2018-01-02,x,u
4,s1,Duplicate sha,10.1/e,15,"Late;Row",J3,2021-01-01,x,u
5,s5,Year only,10.1/f,16,"A;B",J4,2017,x,u
'''


def paper(pid, abstract, body, title="T"):
    return {"paper_id": pid, "metadata": {"title": title},
            "abstract": [{"text": t} for t in abstract], "body_text": [{"text": t} for t in body]}


def write_fixture(root):
    os.makedirs(os.path.join(root, "papers", "a", "b"), exist_ok=True)
    with open(os.path.join(root, "meta.csv"), "w") as f:
        f.write(META)
    files = {
        "a/p1.json": paper("s1", ["first part", "second part"], ["body one", "body two"]),
        "a/b/p2.json": paper("s2", [], ["only body text here"]),
        "p3.json": paper("s3", ["abs"], []),                      # empty body
        "p4.json": {"paper_id": "s4", "metadata": {"title": "x"}, "abstract": []},   # missing body key
        "p5.json": paper("s5", ["abs"], ["body"], title=None),    # null title kept
        "p6.json": {"paper_id": "s6", "metadata": {}, "abstract": [], "body_text": [{"text": "b"}]},  # no title key
        "p7.json": paper("s7", ["abs"], [None]),                  # null section text
        "p9.json": {"paper_id": "s9", "abstract": [], "body_text": [{"text": "b"}]},   # no metadata
    }
    for name, obj in files.items():
        with open(os.path.join(root, "papers", name), "w") as f:
            f.write(json.dumps(obj, indent=1))
    with open(os.path.join(root, "papers", "p8.json"), "w") as f:
        f.write('{"paper_id": "s8", "abstract": [')                # truncated
    with open(os.path.join(root, "papers", "notes.txt"), "w") as f:
        f.write("not json")


def test_read_metadata(spark, tmp_path):
    write_fixture(str(tmp_path))
    m = {r.row_no: r for r in read_metadata(spark, str(tmp_path / "meta.csv")).collect()}
    assert len(m) == 6
    assert m[0].title == "Virus, spread and cells"
    assert m[1].title is None           # NA marker
    assert m[1].doi == ""               # forced string column keeps blank
    assert m[1].abstract == "multi\nline"
    assert m[2].authors is None


def test_read_papers_skips_bad_files(spark, tmp_path):
    write_fixture(str(tmp_path))
    p = {r.paper_id: r for r in read_papers(spark, str(tmp_path / "papers")).collect()}
    assert set(p) == {"s1", "s2", "s3", "s5"}
    assert p["s1"].abstract == "first part\nsecond part"
    assert p["s1"].body_text == "body one\nbody two"
    assert p["s2"].abstract == ""
    assert p["s5"].title is None


def test_paper_documents_rules(spark, tmp_path):
    write_fixture(str(tmp_path))
    meta = read_metadata(spark, str(tmp_path / "meta.csv"))
    papers = read_papers(spark, str(tmp_path / "papers"))
    d = {r.paper_id: r for r in paper_documents(papers, meta).collect()}
    # s3: empty body; s2: null title (NA) dropped by the null drop; s5 kept
    assert set(d) == {"s1", "s5"}
    s1 = d["s1"]
    assert s1.journal == "J1"                       # first metadata row wins
    assert s1.authors == "Smith, J. Lee, K..."
    assert s1.publish_time == datetime.date(2020, 3, 5)
    assert s1.abstract_summary == "first part\nsecond part"
    assert d["s5"].publish_time == datetime.date(2017, 1, 1)


def test_load_corpus_numbers_documents(spark, tmp_path):
    write_fixture(str(tmp_path))
    c = load_corpus(spark, str(tmp_path / "meta.csv"), str(tmp_path / "papers"), full_stopwords(), lang=None)
    rows = sorted((r.doc_num, r.paper_id) for r in c.collect())
    assert rows == [(0, "s1"), (1, "s5")]
    r = c.where("paper_id = 's1'").first()
    assert r.processed_text == "body one body two"
    assert r.all_text_list == r.processed_title_list + r.processed_abstract_list + r.processed_text_list


def test_paper_documents_strict_dates(spark, tmp_path):
    import pytest

    write_fixture(str(tmp_path))
    meta = read_metadata(spark, str(tmp_path / "meta.csv"))
    papers = read_papers(spark, str(tmp_path / "papers"))
    # s3 has a broken date but an empty body; add a paper matching row 2 with a body.
    extra = spark.createDataFrame([("s3", "T", "a", "body")], "paper_id string, title string, abstract string, body_text string")
    with pytest.raises(ValueError):
        paper_documents(papers.unionByName(extra), meta, strict=True).collect()


def test_load_corpus_needs_profiles(spark, tmp_path):
    import pytest

    with pytest.raises(ValueError):
        load_corpus(spark, str(tmp_path / "meta.csv"), str(tmp_path / "papers"), full_stopwords())


def test_load_corpus_with_language_profiles(spark, tmp_path):
    from textquarry.operators.language import train_language_profiles

    write_fixture(str(tmp_path))
    train = spark.createDataFrame(
        [(1, "the body of the text is here and there", "en"), (2, "le corps du texte est ici et la", "fr")],
        "doc_id long, text string, lang string",
    )
    prof = train_language_profiles(train, "doc_id", "text", "lang")
    c = load_corpus(spark, str(tmp_path / "meta.csv"), str(tmp_path / "papers"), full_stopwords(), profiles=prof)
    langs = {r.paper_id: r.language for r in c.collect()}
    assert set(langs.values()) <= {"en"}


def test_bad_files_name_path_and_reason(spark, tmp_path):
    import json

    good = {"paper_id": "a", "metadata": {"title": None}, "abstract": [], "body_text": [{"text": "x"}]}
    files = {
        "good": json.dumps(good), "cut": json.dumps(good)[:20], "list": "[1, 2]", "blank": " ",
        "no_id": json.dumps({k: v for k, v in good.items() if k != "paper_id"}),
        "no_meta": json.dumps({k: v for k, v in good.items() if k != "metadata"}),
        "no_title": json.dumps(good | {"metadata": {}}), "null_id": json.dumps(good | {"paper_id": None}),
        "null_body": json.dumps(good | {"body_text": None}), "section": json.dumps(good | {"abstract": [{"text": None}]}),
    }
    (tmp_path / "deep").mkdir()
    for name, text in files.items():
        (tmp_path / ("deep" if len(name) % 2 else ".") / f"{name}.json").write_text(text)
    bad = {r.path.rsplit("/", 1)[1][:-5]: r for r in P.bad_files(spark, str(tmp_path)).collect()}
    assert {n: r.reason for n, r in bad.items()} == {
        "cut": "not a JSON object", "list": "not a JSON object", "blank": "not a JSON object", "no_id": "no paper_id",
        "no_meta": "no metadata", "no_title": "no metadata.title", "null_id": "paper_id is null or of another type",
        "null_body": "body_text is null or of another type", "section": "abstract has a section without text",
    }
    assert all(r.bytes == len(files[n]) for n, r in bad.items())
    assert [r.paper_id for r in P.read_papers(spark, str(tmp_path)).collect()] == ["a"]


def test_written_papers_read_back(spark, tmp_path):
    rows = [("1", 'a "title",\nof two lines', "", "body\ntext"), ("2", None, "x", 'q"uote, é')]
    df = spark.createDataFrame(rows, "paper_id string, title string, abstract string, body_text string")
    P.write_papers(df, f"{tmp_path}/p")
    assert sorted(map(tuple, P.read_papers(spark, f"{tmp_path}/p", ".txt").collect())) == rows
    P.write_metadata(df.select(F.col("paper_id").cast("bigint").alias("n"), "title", "abstract", "body_text"), f"{tmp_path}/m")
    got = sorted(map(tuple, P.read_metadata(spark, f"{tmp_path}/m").collect()))
    assert got == [(1, rows[0][1], None, "body\ntext"), (2, None, "x", 'q"uote, é')]


def test_packed_papers_read_as_single_files_do(spark, tmp_path):
    rows = [(str(n), f"title {n}", "" if n % 3 else "an abstract", f"body\nof {n}", None) for n in range(300)]
    rows += [("300", "t", "a", "b", '{"paper_id": "300", "abs'), (None, "t", "a", "b", None), ("7", "again", "a", "b", None)]
    df = spark.createDataFrame(rows, "paper_id string, title string, abstract string, body_text string, raw string").coalesce(2)
    P.write_papers(df, f"{tmp_path}/single")
    P.pack_papers(df, f"{tmp_path}/packed")
    single, packed = (f"{tmp_path}/single", ".txt"), (f"{tmp_path}/packed", P.PACKED)

    def bad(where):
        return sorted((r.path.split("/paper=")[-1].split("paper=")[-1].split("/")[0], r.bytes, r.reason)
                      for r in P.bad_files(spark, *where).collect())

    assert bad(packed) == bad(single) and len(bad(packed)) == 2
    read = [sorted(map(tuple, P.read_papers(spark, *w).collect())) for w in (single, packed)]
    assert read[0] == read[1] and len(read[1]) >= 300


def test_paper_queries_make_few_files(spark, tmp_path, monkeypatch):
    from textquarry.plans import source_queries

    docs = spark.range(400).selectExpr(
        "id AS doc_id", "concat('title ', id, '\\n', 'abstract\\nbody') AS text",
        "element_at(array('en', 'fr', 'de', 'es'), cast(id % 4 + 1 AS int)) AS lang", "'s' AS source")
    docs.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(source_queries, "ensure_checkpoint_dir", lambda spark: f"{tmp_path}/kept")
    assert source_queries.q_bad_files(spark, str(tmp_path)).count() == 300
    assert source_queries.q_load_corpus(spark, str(tmp_path)).count() == 100
    # before, a file for every paper
    assert sum(len(f) for _, _, f in os.walk(f"{tmp_path}/kept")) < 100
