import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from arealis.llm import language
from tests.llm.helpers import ODD, SCHEMA, held_out, table


def test_forward_sums_all_segmentations():
    pieces = sorted(["▁", "a", "b", "ab", "▁a", "ba", "aba"])
    lattice = language.Lattice(pieces)
    rng = np.random.default_rng(0)
    p = rng.random((len(pieces), 2))
    t = np.vstack([p, np.full((1, 2), 1e-8), np.zeros((1, 2))])

    def brute(word, k):
        total = 0.0
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            parts, start = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(word[start:i])
                    start = i
            parts.append(word[start:])
            value = 1.0
            for part in parts:
                i = lattice.ids.get(part)
                value *= p[i, k] if i is not None else (1e-8 if len(part) == 1 else 0.0)
            total += value
        return math.log(total)

    words = ["▁ab", "▁aba", "▁z", "▁abab", "▁bzab", "▁"]
    got = lattice.scores(words, t)
    for i, w in enumerate(words):
        for k in range(2):
            assert abs(got[i, k] - brute(w, k)) < 1e-9
    # uses of pieces add up to the letters of the words
    uses = lattice.expected(words[:2], np.array([2.0, 3.0]), p[:, 0])
    letters = sum(n * len(q) for n, q in zip(uses, pieces))
    assert abs(letters - (2 * 3 + 3 * 4)) < 1e-9


def test_long_words_do_not_underflow():
    lattice = language.Lattice(["a", "▁"])
    t = np.array([[1e-5], [1e-5], [1e-8], [0.0]])
    got = lattice.scores(["▁" + "a" * 5000], t)[0, 0]
    assert abs(got - 5001 * math.log(1e-5)) < 1e-3


def test_odd_rows(spark):
    docs = table(spark)
    model = language.fit(docs.where(~language.held_out(4, 2)))
    learnt = {la for d, t, la, *_ in ODD if t is not None and la is not None and not held_out(d, 4, 2)}
    assert set(model.languages) == learnt
    got = language.identify(docs, model, [F.col("doc_id"), F.col("text").alias("t"), language.held_out(4, 2).alias("h")])
    rows = got.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        letters = any(c.isalpha() for c in r.t or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
        assert r.h == held_out(r.doc_id, 4, 2)


def test_nothing_learnt_and_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = language.fit(empty)
    assert {r.lang_pred for r in language.identify(table(spark), model, [F.col("doc_id")]).collect()} == {"und"}
    assert language.identify(empty, model, [F.col("doc_id")]).count() == 0


def test_accuracy_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.001"
    true = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in language.op3_language_id(spark, sf).collect() if r.held_out]
    assert len(rows) > 20 and sum(true[r.doc_id] == r.lang_pred for r in rows) / len(rows) > 0.97


def test_numerals_are_no_letters(spark):
    assert language.words_of("² ½ ① Ⅻ x²y ٣") == ["x", "y"]
    rows = [(i, "the cat sat on the mat" if i % 2 else "der hund und die katze", "en" if i % 2 else "de", "a", 1) for i in range(60)]
    model = language.fit(spark.createDataFrame(rows, SCHEMA))
    odd = spark.createDataFrame([(900, "² ½ ①", "en", "a", 1), (901, "the ½ cat", "de", "a", 1)], SCHEMA)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(odd, model, [F.col("doc_id")]).collect()}
    assert got[900] == ("und", 0.0) and got[901][0] == "en"


def test_very_long_words_teach():
    """Expectations of a word of 5,000 letters: as many letters as it has, and those of short words by both ways."""
    lattice = language.Lattice(sorted({"a", "b", "ab", "aba", "bb"}))
    p = np.full(5, 0.2)
    word = "ab" * 2500
    uses = lattice.expected([word], np.array([2.0]), p)
    assert np.isclose(sum(u * len(x) for u, x in zip(uses, lattice.pieces)), 2 * 5000)
    short = ["abab", "bbab"]
    table = np.append(p, [language.UNSEEN, 0.0])
    by_logs = lattice._expected_by_logs(lattice.of(short), table, np.array([1.0, 3.0]))
    assert np.allclose(by_logs[:5], lattice.expected(short, np.array([1.0, 3.0]), p))
