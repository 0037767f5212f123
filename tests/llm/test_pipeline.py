"""Every stage of the pipeline against a brute-force version on its own input."""

import collections
import re

import corpus_pipeline as C
from test_mixing import plain_targets
from test_simhash import brute_fp, brute_groups

from textquarry.llm import pii

SMALL = "/root/testdata/sf0.001"
EXTRA = "_nth int, epoch string, found string, n bigint, _types int, size int, taken int, _language string, p string"


def extra(rows):
    return [r + (1, "e", "f", 2, 3, 4, 5, "g", "h") for r in rows]


def test_stages_on_the_smallest_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in C.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SMALL)
        if name != "mixing":
            assert out.schema.names == docs.schema.names
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        out.write.parquet(f"{tmp_path}/{name}")
        rows = spark.read.parquet(f"{tmp_path}/{name}").collect()
        after = {r.doc_id: r for r in rows}
        if name == "language_id":
            assert all(any(map(str.isalpha, before[i].text)) for i in after)
            assert len(after) == sum(any(map(str.isalpha, r.text or "")) for r in before.values())
        elif name == "simhash_dedup":
            fps = [(i, brute_fp(r.text, 4)) for i, r in before.items()]
            assert set(after) == {i for (i, _), c in zip(fps, brute_groups(fps, 4)) if i == c}
        elif name == "decontaminate":
            items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            held = {i for i, r in before.items() if any(t in r.text for t in items)}
            assert held and not held & set(after) and len(before) - len(after) <= 2 * len(held)
        elif name == "pii":
            assert set(after) == set(before)
            for i, r in before.items():
                found = pii.detect(r.text)
                assert (after[i].text == r.text) == (not found)
                assert after[i].n_chars == (len(after[i].text) if found else r.n_chars)
        else:
            sizes = collections.Counter()
            for r in before.values():
                sizes[r.source] += len(r.text.encode().split())
            want, got = plain_targets(dict(sizes)), collections.Counter()
            for r in rows:
                assert r.taken == len(r.text.encode().split()) <= r.size and r.epoch <= 3
                assert before[r.doc_id].text.startswith(r.text)
                got[r.source] += r.taken
            assert all(got[s] == int(want[s]) for s in sizes)
        docs = spark.read.parquet(f"{tmp_path}/{name}") if name != "mixing" else docs


def test_stages_on_odd_rows(spark):
    rows = extra([
        (1, "Of the words that stand in this text there are some.", "en", "a", 9), (2, None, "en", "a", 9),
        (3, "", None, None, None), (None, "No name has this text at all, call 212-555-0199 now", None, None, None),
        (1, "Of the words that stand in this text there are some.", "en", "a", 9), (4, "12 + 3", "en", "b", 6),
        (5, "é " * 30000, "fr", "b", 60000), (6, "Of the words that stand in this text there are some.", "en", "b", 3),
    ])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, " + EXTRA)
    got = {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, SMALL)
        got[name] = sorted((r.doc_id if r.doc_id is not None else -1) for r in out.collect())
        assert out.columns[: len(docs.columns)] == docs.columns
        assert stage(spark, docs.limit(0), SMALL).collect() == []
    assert got["language_id"] == [-1, 1, 1, 5, 6]
    assert got["simhash_dedup"] == [-1, 1, 2, 4, 5]
    assert got["decontaminate"] == got["pii"] == [-1, 1, 1, 2, 3, 4, 5, 6]
    assert set(got["mixing"]) <= {-1, 1, 4, 5, 6}


def test_rows_that_share_a_doc_id_or_have_none(spark):
    x, y, z = ("Of the words that stand in this text there are some that nobody knows.",
               "Another text altogether speaks of rivers and mountains and of what lies between.",
               "A third one with numbers and names tells nothing about either of the others here.")
    rows = [(3, x), (5, x), (5, y), (5, y), (None, y), (None, z), (None, z), (7, z + " " + x)]
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = [(r.doc_id, r.text) for r in C.simhash_stage(spark, docs, SMALL).collect()]
    fps = [(k, brute_fp(t, 4)) for k, (_, t) in enumerate(rows)]
    groups = collections.defaultdict(list)
    for (k, _), c in zip(fps, brute_groups(fps, 4)):
        groups[c].append(rows[k])
    want = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    assert sorted(kept, key=repr) == sorted(want, key=repr)
    assert {(3, x), (5, y), (None, z)} <= set(kept)


def test_leaks_without_a_doc_id_go(spark):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    rows = [(None, "before " + item + " after"), (None, "a clean text"), (4, "a clean text"), (4, item)]
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = [(r.doc_id, r.text) for r in C.decontamination_stage(spark, docs, SMALL).collect()]
    assert sorted(out, key=repr) == [(4, "a clean text"), (None, "a clean text")]


def test_registered_run(spark):
    import __spark_entry__ as e

    out = e.queries()["pipeline"](spark, SMALL)
    texts = [r.text for r in out.select("text").collect()]
    assert texts and not any(re.search(r"@mail\d\.example\.com", t) for t in texts)
