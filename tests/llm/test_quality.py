import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from arealis.llm import quality_classifier as q
from arealis.llm import quality_rules as rules
from arealis.llm.common import content
from tests.llm.helpers import ODD, SCHEMA, held_out, table, words


def base(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = {x: windows.count(x) if len(w) < 2000 else None for x in set(windows)}
    if len(w) >= 2000:
        count = {}
        for x in windows:
            count[x] = count.get(x, 0) + 1
    covered = {j for i, x in enumerate(windows) if count[x] > 1 for j in (i, i + 1, i + 2)}
    seen, copies = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            copies += line in seen
            seen.add(line)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, copies, len(covered)


def test_counts_of_odd_texts(spark):
    rnd = random.Random(5)
    rows = [*ODD, (50, "a a a a", "en", "a", 1), (51, "a b c\na b c\n\n \na b c", "en", "a", 1), (52, "x\x0by\x0cz é é é", "en", "a", 1)]
    rows += [(60 + i, " ".join(rnd.choices("abcd", k=rnd.randrange(1, 60))), "en", "b", 1) for i in range(60)]
    got = rules.judge(table(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted(((d, *base(t)) for d, t, *_ in rows), key=repr)
    assert sorted(((r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=repr) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_outliers_are_rejected_and_others_kept(spark):
    rnd = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def text(n, symbols=0):
        w = ["".join(rnd.choices(letters, k=rnd.randrange(2, 10))) for _ in range(n)]
        return " ".join(x + "#" * (rnd.random() < symbols) * 3 for x in w)

    rows = [(i, text(rnd.randrange(60, 400)), "en", "a", 1) for i in range(200)]
    rows += [(1000 + i, text(200, 0.9), "en", "a", 1) for i in range(20)]
    rows += [(2000 + i, text(200, 0.9), None, "tiny", 1) for i in range(3)]  # judged by the table
    got = {r.id: r for r in rules.judge(table(spark, rows, False)).collect()}
    assert all(got[i].kept for i in range(200))
    assert not any(got[1000 + i].kept for i in range(20))
    assert not any(got[2000 + i].kept for i in range(3))


def test_repetition_alone_is_rejected(spark):
    rnd = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def some(n):
        return ["".join(rnd.choices(letters, k=rnd.randrange(2, 10))) for _ in range(n)]

    def repeating(n, share):
        phrase = some(4)
        w = some(n - int(n * share) // 4 * 4)
        for at in sorted(rnd.sample(range(0, len(w), 3), int(n * share) // 4), reverse=True):
            w[at:at] = phrase
        return " ".join(w)

    def lines(share):
        once = some(2)
        return "\n".join(" ".join(once if rnd.random() < share else some(8)) for _ in range(40))

    rows = [(i, " ".join(some(rnd.randrange(60, 400))), "en", "a", 1) for i in range(200)]
    rows += [(500 + i, lines(0), "en", "a", 1) for i in range(50)]
    rows += [(1000 + i, repeating(200, 0.3 + 0.02 * i), "en", "a", 1) for i in range(10)]
    rows += [(2000 + i, lines(0.6), "en", "a", 1) for i in range(10)]  # less than 50 % of the words
    got = {r.id: r for r in rules.judge(table(spark, rows, False)).collect()}
    assert all(got[i].kept for i in [*range(200), *range(500, 550)])
    assert not any(got[i].base_failed or got[i].kept for i in [*range(1000, 1010), *range(2000, 2010)])


def test_small_groups_are_judged_by_their_language_or_the_table(spark):
    rnd = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def text(n, symbols=0):
        w = ["".join(rnd.choices(letters, k=rnd.randrange(2, 10))) for _ in range(n)]
        return " ".join(x + "#" * (rnd.random() < symbols) * 3 for x in w)

    rows = [(i, text(rnd.randrange(60, 400)), "en", "a", 1) for i in range(200)]
    small = [("en", "b"), ("en", None), ("rare", "a"), ("rare", None)]
    for at, (lang, source) in enumerate(small, 1):
        rows += [(1000 * at + i, text(200), lang, source, 1) for i in range(5)]
        rows += [(1000 * at + 100 + i, text(200, 0.9), lang, source, 1) for i in range(5)]
    got = {r.id: r for r in rules.judge(table(spark, rows, False)).collect()}
    assert len(got) == len(rows) and all(got[i].kept for i in range(200))
    for at in range(1, len(small) + 1):
        assert all(got[1000 * at + i].kept for i in range(5))
        assert not any(got[1000 * at + 100 + i].kept for i in range(5))


def test_rules_of_an_empty_table(spark):
    assert rules.judge(spark.createDataFrame([], SCHEMA)).count() == 0


def test_scatter_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4)) @ rng.normal(size=(4, 4)) * 3
    df = spark.createDataFrame([("g", *map(float, r)) for r in x], "group string, x_0 double, x_1 double, x_2 double, x_3 double")
    r = rules.robust_scatter(df).first()
    low = np.array([[r[f"l_{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
    want = np.cov(x.T, bias=True) + np.diag(np.array(rules.FLOOR) ** 2)
    assert np.allclose(low @ low.T, want, rtol=0.35, atol=0.15 * np.abs(want).max())


def test_isotonic_against_brute_force():
    rnd = random.Random(2)
    for _ in range(50):
        n = rnd.randrange(1, 12)
        x, size = np.arange(n, dtype=float), np.array([rnd.randrange(1, 5) for _ in range(n)], float)
        hits = np.array([rnd.randrange(int(s) + 1) for s in size], float)
        at, share = q.isotonic(x, size, hits)
        assert (np.diff(at) > 0).all() and (np.diff(share) > 0).all()
        # min-max formula of the isotonic fit
        fit = [max(min(hits[i : j + 1].sum() / size[i : j + 1].sum() for j in range(k, n)) for i in range(k + 1)) for k in range(n)]
        assert np.allclose(sorted(set(np.round(fit, 9))), np.round(share, 9))


def test_scores_of_odd_rows(spark):
    docs = table(spark)
    stats = q.text_statistics(docs, [F.col("doc_id")])
    labels = spark.createDataFrame([(8, 1), (9, 1), (11, 0), (4, None), (None, 1), (10, 1)], "doc_id long, quality int")
    model = q.fit(q.labelled_statistics(stats, labels))
    rows = q.score_statistics(stats, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    kept = q.accepted(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in rows)


def test_without_labels(spark):
    stats = q.text_statistics(table(spark), [F.col("doc_id")])
    model = q.fit(q.labelled_statistics(stats, spark.createDataFrame([], "doc_id long, quality int")))
    assert {r.score for r in q.score_statistics(stats, model).collect()} == {0.5}
    empty = q.text_statistics(spark.createDataFrame([], SCHEMA), [F.col("doc_id")])
    assert q.score_statistics(empty, model).count() == 0


def test_equations_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(0)
    rows = [([float(v) for v in rng.normal(size=q.STATISTICS)], int(rng.integers(2))) for _ in range(300)]
    df = spark.createDataFrame(rows, "stats array<double>, label int")
    centre, spread = np.zeros(q.STATISTICS), np.ones(q.STATISTICS)
    z = q.fourier(np.array([r[0] for r in rows]), centre, spread)
    square, right = q._equations(df.repartition(5), centre, spread)
    assert np.allclose(square, z.T @ z) and np.allclose(right, z.T @ np.array([r[1] for r in rows]))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in q.op6_quality_classifier(spark, sf).collect() if r.doc_id in label and r.held_out]
    assert all(held_out(r.doc_id, 5, 0) for r in rows)
    assert len(rows) > 40 and sum(r.predicted == label[r.doc_id] for r in rows) / len(rows) > 0.95
    assert content("text") is not None


def test_a_worker_holds_few_texts_at_once():
    class Docs:
        columns, schema = ["doc_id", "text"], None

        def mapInArrow(self, run, schema):
            return run

    nothing = np.zeros(0)
    model = q.Model(nothing, nothing, nothing, nothing, nothing)  # accepts all
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(["a b"] * 1000)], names=["doc_id", "text"])
    empty = batch.slice(0, 0)
    out = list(q.accepted(Docs(), model)(iter([batch, empty])))
    assert [i for b in out for i in b.column(0).to_pylist()] == list(range(1000))
    assert max(map(len, out)) <= 256
