"""License scan against a plain scan of every block."""

import random
import re

from textquarry.llm import licenses as L

SMALL = "/root/testdata/sf0.001"


def split(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(text, templates=L.TEMPLATES, phrases=L.PHRASES, threshold=0.8):
    w = split(text)
    at = {}
    for p, label in phrases.items():
        ps = split(p)
        for i in range(len(w) - len(ps) + 1):
            if w[i: i + len(ps)] == ps:
                at.setdefault(label, []).append(i)
    best, labels = 0.0, set()
    for label, ts in templates.items():
        for t in ts:
            tw = split(t)
            for b in range(0, max(1, len(w)), len(tw)):
                pieces = [[]]
                for x in w[b: b + 2 * len(tw)]:
                    if x in L.BARRED.get(label, ()):
                        pieces.append([])
                    else:
                        pieces[-1].append(x)
                for piece in pieces:
                    c = len(set(tw) & set(piece)) / len(set(tw))
                    if c >= threshold - 1e-9 and all(g & set(piece) for g in L.NEEDED.get(label, ())):
                        labels.add(label)
                        best = max(best, c)
    places = [i for v in at.values() for i in v]
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(at)),
            ",".join(sorted(set(at) | labels)), 1.0 if places else best)


def test_documents_match_plain_scan(spark):
    rnd = random.Random(1)
    notices = [t for ts in L.TEMPLATES.values() for t in ts] + ["MIT License", "apache LICENSE", "General Public-License"]
    rows = [(0, None), (1, ""), (2, "mit mit license license"), (3, "é MIT\x00License"), (4, "General public licenses"),
            (None, "MIT License"), (5, "MIT License " * 40000), (5, "MIT License " * 40000)]
    for i in range(10, 150):
        body = [rnd.choice("the of and to in a software license any public é42".split()) for _ in range(rnd.randint(0, 300))]
        n = rnd.choice(notices).split()
        for _ in range(rnd.randint(0, max(1, len(n) // 4))):
            n[rnd.randrange(len(n))] = "other"
        at = rnd.randint(0, len(body))
        body[at:at] = n
        rows.append((i, rnd.choice([" ", "\n", ", "]).join(body)))
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, n_words int, labels string")
    got = sorted(map(tuple, L.scan_licenses(df).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=repr)
    assert L.scan_licenses(df.limit(0)).collect() == []


def test_a_notice_has_its_own_label_only(spark):
    rows = [(label, f"{lead} {t} {lead}") for label, ts in L.TEMPLATES.items() for t in ts for lead in ("", "words about this file")]
    rows += [("cc by", "Licensed under CC BY 4.0"), ("cc by nc", "This page is licensed under a Creative Commons "
             "Attribution-NonCommercial 4.0 International License, see there"),
             ("cc by nc sa", "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
             ("cc by,cc by nc", "Licensed under CC BY-NC 4.0 and some parts Licensed under CC BY 4.0"),
             ("", "licensed under a contract by NC")]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan_licenses(df, phrases={}).collect()}
    assert [got[i].labels for i in range(len(rows))] == [label for label, _ in rows]
    assert [got[i].score >= 0.8 for i in range(len(rows))] == [bool(label) for label, _ in rows]


def test_whole_table(spark):
    from textquarry.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op8_license_scan"](spark, SMALL).collect()}
    assert got == {d.doc_id: brute(d.text) for d in docs}
