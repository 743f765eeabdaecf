"""Licence scans against a plain loop over words, and planted licences."""

import random
import re

from pyspark.sql import functions as F

from arealis.llm import license_scan
from tests.llm.helpers import ODD, SCHEMA, SENTENCE, lower, table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of it."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer."""
ROWS = [
    *ODD,
    (30, "Released under the MIT License.", "en", "a", 1),
    (31, "the mit-LICENSE and the Mit  license; MIT\nLicense mit licensed", "en", "a", 1),
    (32, "GNU General Public License, apache license APACHE LICENSE v2", "en", "a", 1),
    (33, "mit license mité license mit lıcense", "en", "a", 1),
    (34, "license mit general public the license general public license", "en", "a", 1),
    (35, SENTENCE + "\n" + MIT + "\n" + SENTENCE, "en", "a", 1),
    (36, SENTENCE + "\n" + BSD + " " + MIT, "en", "a", 1),
    (37, "Licensed under CC BY-NC 4.0.", "en", "a", 1),
    (38, "Licensed by someone under the moon, cc by email", "en", "a", 1),
    (39, "software permission granted copyright restriction free charge person copies rights merge", "en", "a", 1),
    (40, "Permission is hereby granted, free of charge, to any bird that asks for a worm", "en", "a", 1),
    (41, "Licensed under CC BY-NC 4.0. " * 2 + "x " * 3000 + BSD, "en", "a", 1),
]


def base_of(text):
    words = WORD.findall(lower(text))
    places = []
    for phrase, label in license_scan.BASE:
        of = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(of)] == of]
    return len(words), sorted(places)


def scanned(df):
    return [r.asDict() for r in license_scan.scan(df).collect()]


def check_base(rows, got):
    key = lambda x: str(x)
    want = sorted(((r[0], *base_of(r[1])) for r in rows), key=key)
    assert sorted(((g["id"], g["n_words"], [(p["word"], p["label"]) for p in g["base"]]) for g in got), key=key) == want
    for g in got:
        assert g["base_labels"] == sorted({p["label"] for p in g["base"]})
        assert set(g["base_labels"]) <= set(g["labels"]) and g["labels"] == sorted(set(g["labels"]))
        assert 0 <= g["score"] <= 1 and (g["score"] > 0) == bool(g["labels"])


def test_odd_rows_and_planted_licences(spark):
    got = scanned(table(spark, ROWS))
    check_base(ROWS, got)
    labels = {g["id"]: g["labels"] for g in got}
    assert labels[35] == ["mit"] and labels[36] == ["bsd", "mit"]
    assert labels[37] == ["cc-by-nc"] and labels[41] == ["bsd", "cc-by-nc"]
    assert labels[32] == ["apache", "gpl"]
    assert labels[38] == labels[39] == labels[40] == []


def brute(rows):
    """Every template at every place: index words that agree, and key phrases near their place."""
    words = [WORD.findall(lower(r[1])) for r in rows]
    known = set(license_scan.vocabulary())
    df = {w: sum(w in set(x) for x in words) for w in known}
    out = []
    for x in words:
        labels = {}
        for label, text, phrases in license_scan.TEMPLATES:
            of = text.split()
            weight = {w: round(float(__import__("math").log1p(len(rows) / max(df[w], 1))), 12) for w in of}
            order = sorted(set(of), key=lambda w: (-weight[w], of.index(w), w))[: license_scan.RAREST]
            kept = [w for w in order if weight[w] >= license_scan.LEAST_WEIGHT * weight[order[0]]]
            whole = sum(weight[w] for w in kept)
            hits = [(i - j, w) for i, w in enumerate(x) for j, v in enumerate(of) if v == w and w in kept]
            for shift in (0, license_scan.SLACK // 2):
                bins = {}
                for begin, w in hits:
                    bins.setdefault((begin + shift) // license_scan.SLACK, []).append((begin, w))
                for some in bins.values():
                    met = {w for _, w in some}
                    share = sum(weight[w] for w in met) / whole
                    if share < license_scan.COVERED or len(met) < min(len(kept), 2):
                        continue
                    low, high = min(b for b, _ in some), max(b for b, _ in some)
                    ok = True
                    for phrase in phrases:
                        p = phrase.split()
                        at = next(i for i in range(len(of)) if of[i : i + len(p)] == p)
                        span = range(max(0, at + low - license_scan.SLACK), at + high + license_scan.SLACK + 1)
                        ok &= any(x[i : i + len(p)] == p for i in span)
                    if ok:
                        labels[label] = max(labels.get(label, 0.0), min(share, 1.0))
        out.append(labels)
    return out


def check_labels(rows, got):
    want = []
    for r, found in zip(rows, brute(rows)):
        base = {label for _, label in base_of(r[1])[1]}
        score = max([0.0, *found.values(), *([license_scan.BASE_SCORE] if base else [])])
        want.append((r[0], ",".join(sorted(base | set(found))), round(score, 9)))
    have = [(g["id"], ",".join(g["labels"]), round(g["score"], 9)) for g in got]
    assert sorted(have, key=str) == sorted(want, key=str)


def test_labels_against_every_place(spark):
    random.seed(5)
    texts = [t for _, t, _ in license_scan.TEMPLATES]
    rows = list(ROWS)
    for i in range(120):
        words = random.choice(texts).split()
        for _ in range(random.randint(0, 8)):  # words lost, added and changed
            at = random.randrange(len(words))
            words[at : at + random.randint(0, 2)] = random.choices(["acme", "the", "license", "2024"], k=random.randint(0, 2))
            words = words or ["x"]
        rows.append((100 + i, " ".join(SENTENCE.split()[: random.randint(0, 20)] + words), "en", "a", 1))
    got = scanned(table(spark, rows).repartition(5))
    check_base(rows, got)
    check_labels(rows, got)


def test_copies_count_each(spark):
    rows = [(i, MIT, "en", "a", 1) for i in range(200)] + [(900, SENTENCE, "en", "a", 1)]
    got = scanned(spark.createDataFrame(rows, SCHEMA))
    assert sum(g["labels"] == ["mit"] for g in got) == 200 and len(got) == 201


def test_empty_table(spark):
    assert license_scan.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_on_the_main_path(spark):
    docs = table(spark)
    plan = license_scan.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query(spark):
    out = license_scan.op13_license_scan(spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(out) == len(docs)
    for r in out:
        n, places = base_of(docs[r["doc_id"]])
        at = [p for p, _ in places]
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        assert (r["first_word"], r["last_word"]) == ((min(at), max(at)) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert ("cc-by-nc" in r["labels"]) == ("CC BY-NC 4.0" in (docs[r["doc_id"]] or ""))
