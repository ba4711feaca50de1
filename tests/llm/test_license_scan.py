import random
import re

from seqtally.llm.license_scan import BASE, license_labels, scan
from seqtally.llm.license_texts import BODIES
from tests.llm.conftest import words


def by_hand(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in BASE:
        p = phrase.split()
        for i in range(len(found) - len(p) + 1):
            if found[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = ["Licensed under the Apache License, Version 2.0.", "the MIT license. MIT-License! mit_license MIT\nLICENSE",
         "This work is licensed under the GNU General Public License, version 3." + words(3, 50),
         "CC BY 4.0 cc-by ccby", "gnu general public gnu general public license license", "mit licensé apache licenses",
         "MIKT license K mit license", words(4, 20000) + " apache license " + words(5, 300) + " mit license"]


def test_base_places(docs_of, odd_docs):
    docs = docs_of([(i, t, "en", "a") for i, t in enumerate(TEXTS)]).unionByName(odd_docs)
    got = sorted((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                 for r in license_labels(docs).na.fill("").na.fill(-1, ["first_word", "last_word"]).collect())
    expected = sorted((str(-1 if r.doc_id is None else r.doc_id), n, k, -1 if a is None else a, -1 if b is None else b, s)
                      for r in docs.collect() for n, k, a, b, s in [by_hand(r.text)])
    assert sorted(g[1:] for g in got) == sorted(e[1:] for e in expected)


def test_notices_stand_with_gaps_but_not_in_pieces(docs_of):
    notice = ("redistribution and use in source and binary forms with or without modification are permitted provided "
              "that the following conditions are met")
    w = notice.split()
    texts = {1: notice, 2: " ".join([*w[:8], "kindly", *w[8:]]), 3: " ".join(w[:10]),
             4: " ".join([*w[:10], *words(9, 60).split(), *w[10:]]), 5: words(8, 30)}
    got = {r.doc_id: (r.labels, r.score) for r in license_labels(docs_of([(i, t, "en", "a") for i, t in texts.items()])).collect()}
    assert got[1] == ("bsd", 1.0)
    assert got[2][0] == "bsd" and 0.8 <= got[2][1] < 1
    assert [got[i] for i in (3, 4, 5)] == [("", 0.0)] * 3


def test_spans(docs_of):
    rows = scan(docs_of([(1, "x y released under the mit license z", "en", "a")])).where("label is not null").collect()
    assert {(r.label, r.is_base, r.start, r.end) for r in rows} == {("mit", True, 5, 7), ("mit", False, 2, 7)}


def test_empty_table(no_docs):
    assert license_labels(no_docs).count() == 0


def test_stays_in_the_engine(docs_of):
    plan = license_labels(docs_of([(1, "a b", "en", "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_bodies_stand_with_edits_in_long_texts(docs_of):
    pick = random.Random(5)
    rows, expected = [], {}
    for i, (text, label) in enumerate(BODIES):
        w = text.split()
        for place in pick.sample(range(len(w)), len(w) // 40):
            w[place] = pick.choice(["", "x", w[place] + " really"])  # left out, replaced, followed by another
        common = " of the and or the software in the use of this software ".split()
        before = " ".join(pick.choice(common) if pick.random() < 0.3 else words(100 + i, 1) for _ in range(3000))
        rows.append((i, f"{before} {' '.join(w)} {words(i, 500)}", "en", "a"))
        expected[i] = label
    rows.append((50, " ".join(BODIES[0][0].split()[:60]) + " " + words(7, 100), "en", "a"))
    got = {r.doc_id: r for r in license_labels(docs_of(rows)).collect()}
    assert all(expected[i] in got[i].labels.split(",") and got[i].score >= 0.8 for i in expected)
    assert "isc" not in got[0].labels and "zlib" not in got[1].labels
    assert got[50].labels == "mit"  # by its first words, a notice of its own
