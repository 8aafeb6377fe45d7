import re

import duckdb

from scorewright.llm import license_scan

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def base(text):
    words, places, labels = words_of(text), [], set()
    for phrase, label in PHRASES.items():
        part = phrase.split()
        for i in range(len(words) - len(part) + 1):
            if words[i:i + len(part)] == part:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = ["CC BY cc-by CC  by", "all rights reserved " * 500, "GENERAL PUBLIC LICENSE", "general, public; license all rights reserved.",
         "Licensed under the Apache License, Version 2.0.", "apache license version 3 0", "Released under the MIT License.",
         "This work is licensed under the GNU General Public License, version 3.", "licensed under CC BY-NC 4.0", "cc bync",
         "KK reserved all rights resérved", "the apache license. then, version 2 0", "license public general",
         "é cc\xa0by cc é by", "version 3 of the gnu general public license", ""]


def rows_for(spark, hostile):
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    return hostile.select("doc_id", "text").union(extra).selectExpr("*", "1 as words", "2 as hits", "3 as places", "4 as h0")


def test_base_places(spark, hostile):
    docs = rows_for(spark, hostile)
    got = license_scan.scan(docs).collect()
    expect = [(r.doc_id, *base(r.text)) for r in docs.collect()]
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got))) == sorted(
        map(str, expect))
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} for r in got)


def test_sql_twin_on_hostile_rows(spark, hostile):
    docs = rows_for(spark, hostile)
    con = duckdb.connect()
    frame = docs.select("doc_id", "text").toPandas()
    con.register("frame", frame)
    con.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text FROM frame")
    twin = con.sql(license_scan.twin_sql())
    rel = [tuple(None if v != v else v for v in r) for r in twin.fetchall()]
    got = [tuple(r) for r in license_scan.scan(docs).select(*twin.columns).collect()]
    assert sorted(map(str, got)) == sorted(map(str, rel))


def test_labels_of_the_method(spark, hostile):
    labels = {r.doc_id: r.labels for r in license_scan.scan(rows_for(spark, hostile)).collect()}
    assert labels[104] == "apache-2.0" and labels[105] == "" and labels[106] == "mit"
    assert labels[107] == "gpl,gpl-3.0" and labels[108] == "cc-by,cc-by-nc" and labels[111] == "" and labels[114] == "gpl"


def test_empty_and_native(hostile, empty):
    assert license_scan.scan(empty).collect() == []
    plan = license_scan.scan(hostile)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


NOTICES = {"MIT License": "mit", "Distributed under the Eclipse Public License 2.0": "epl",
           "Mozilla Public License Version 2.0": "mpl-2.0", "licensed under the Mozilla Public License": "mpl-2.0",
           "public domain, CC0": "", "public domain under CC0": "cc0", "mit or license": "",
           "Permission is hereby granted, free of charge.": "mit"}


def test_bare_notices(spark):
    docs = spark.createDataFrame(list(enumerate(NOTICES)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert [got[i].labels for i in range(len(NOTICES))] == list(NOTICES.values())
    everything = license_scan.BASE + license_scan.TEMPLATES
    for i, text in enumerate(NOTICES):
        words, labels, score = words_of(text), set(), 0.0
        for t in everything:
            for start in range(-len(t.words), len(words)):
                def at(k):
                    return words[start + k] if 0 <= start + k < len(words) else None
                if all(at(k) == w for k, w in t.mandatory()):
                    labels.add(t.label)
                    score = max(score, sum(at(k) == w for k, w in enumerate(t.words)) / len(t.words))
        assert (got[i].labels, got[i].score) == (",".join(sorted(labels)), round(score, 6))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(x) for x in enumerate(NOTICES)])
    twin = con.sql(license_scan.twin_sql())
    assert sorted(map(str, twin.fetchall())) == sorted(str(tuple(r[c] for c in twin.columns)) for r in got.values())


def brute(text):
    """Labels and score by trying every start of every template."""
    words, labels, score = words_of(text), set(), 0.0
    for t in license_scan.BASE + license_scan.TEMPLATES:
        for start in range(-len(t.words), len(words)):
            def at(k):
                return words[start + k] if 0 <= start + k < len(words) else None
            if all(at(k) == w for k, w in t.mandatory()):
                labels.add(t.label)
                score = max(score, sum(at(k) == w for k, w in enumerate(t.words)) / len(t.words))
    return ",".join(sorted(labels)), round(score, 6)


def test_whole_texts(spark):
    """Whole licence texts, one word changed, the start or end cut off, two
    in one file, inside of comment marks."""
    texts, wanted = [], []
    for t in license_scan.WHOLE_TEXTS:
        words = t.words
        must = {at for at, _ in t.mandatory()}
        other = next(i for i in range(len(words)) if i not in must)
        texts += [" ".join(words).upper(), "\n".join(f" * {w}," for w in ["copyright", "2020", "x", *words]),
                  " ".join([*words[:other], "zzz", *words[other + 1:]]), " ".join(words[min(must):]), " ".join(words[:max(must) + 1]),
                  " ".join(words[:min(must)] + words[min(must) + 1:])]
        wanted += [(t.label, 1.0), (t.label, 1.0), (t.label, round(1 - 1 / len(words), 6)), (t.label, None), (t.label, None), (None, None)]
    a, b = license_scan.WHOLE_TEXTS[:2]
    texts.append(f"{a.text}. {b.text}.")
    wanted.append((a.label, 1.0))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [brute(t) for t in texts]
    for i, (label, score) in enumerate(wanted):
        if label:
            assert label in got[i][0].split(",")
        if score == 1.0:
            assert got[i][1] == 1.0
        elif score:
            assert got[i][1] >= score
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(x) for x in enumerate(texts)])
    twin = con.sql(license_scan.twin_sql())
    place = twin.columns.index("labels"), twin.columns.index("score"), twin.columns.index("doc_id")
    assert {r[place[2]]: (r[place[0]], r[place[1]]) for r in twin.fetchall()} == got


def test_own_templates(spark):
    own = license_scan.template("house", 'You may read this; you MAY NOT "sell" it.', "may not sell")
    docs = spark.createDataFrame([(1, "you may not sell it"), (2, "you may sell it")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(docs, templates=(own,)).collect()}
    assert own.text == "you may read this you may not sell it" and got == {1: ("house", round(5 / 9, 6)), 2: ("", 0.0)}
