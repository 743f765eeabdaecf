import random

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from arealis.llm import mixing, token_counts
from tests.llm.helpers import ODD, SCHEMA, table


def rake(cells, targets):
    w = {c: float(n) for c, n in cells.items() if n > 0}
    for _ in range(500):
        for axis in range(3):
            now = {}
            for c, v in w.items():
                now[c[axis]] = now.get(c[axis], 0) + v
            w = {c: v * targets[axis][c[axis]] / now[c[axis]] for c, v in w.items()}
    return w


def test_raking_against_brute_force(spark):
    rnd = random.Random(1)
    cells = {(f"s{i}", f"l{j}", str(k)): rnd.randrange(0, 50) for i in range(4) for j in range(3) for k in range(2)}
    df = spark.createDataFrame([(*c, n) for c, n in cells.items()], "source string, lang string, topic string, tokens long")
    targets = []
    for axis in range(3):
        sums = {}
        for c, n in cells.items():
            sums[c[axis]] = sums.get(c[axis], 0) + n
        total = sum(v**0.5 for v in sums.values())
        targets.append({k: v**0.5 / total for k, v in sums.items()})
    want = rake(cells, targets)
    got = {(r.source, r.lang, r.topic): r.fitted for r in mixing.rake(df).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[c] - want[c]) < 1e-5 for c in want)


def test_given_targets_and_probabilities(spark):
    rows = [(i, "alpha beta gamma delta epsilon " * (1 + i % 3), "en" if i % 4 else "fr", "a" if i % 3 else "b", 1) for i in range(4000)]
    target = spark.createDataFrame([("=a", 0.5), ("=b", 0.5), ("=missing", 7.0)], "value string, share double")
    docs = table(spark, rows)
    weights = mixing.probabilities(mixing.profiled(docs, []), {"source": target}).collect()
    assert abs(max(r.probability for r in weights) - 1) < 1e-12
    kept = mixing.sampled(docs, targets={"source": target})
    assert kept.columns == docs.columns
    tokens = F.sum(F.regexp_count("text", F.lit("[a-z]+"))).alias("n")
    share = {r.source: r.n for r in kept.groupBy("source").agg(tokens).collect()}
    assert abs(share["a"] / sum(share.values()) - 0.5) < 0.05
    # the draw depends on the row alone
    again = mixing.sampled(docs.repartition(7), targets={"source": target})
    assert sorted(r.doc_id for r in again.collect()) == sorted(r.doc_id for r in kept.collect())


def test_contrary_targets_are_told(spark):
    """All texts of a are English, all of b French; the targets want it the other way round."""
    rows = [(i, "alpha beta gamma delta", "en" if i % 2 else "fr", "a" if i % 2 else "b", 1) for i in range(200)]
    share = lambda **x: spark.createDataFrame([("=" + k, v) for k, v in x.items()], "value string, share double")
    profile = mixing.profiled(table(spark, rows), [])
    contrary = mixing.probabilities(profile, {"source": share(a=0.9, b=0.1), "lang": share(en=0.1, fr=0.9)})
    assert {round(r.gap, 6) for r in contrary.collect()} == {0.8}
    agreeing = mixing.probabilities(profile, {"source": share(a=0.9, b=0.1), "lang": share(en=0.9, fr=0.1)})
    assert max(r.gap for r in agreeing.collect()) < mixing.TOLERANCE
    told = {(r.margin, r.value): (r.wanted, r.expected) for r in mixing.reached(agreeing).collect()}
    assert abs(told["source", "=a"][0] - 0.9) < 1e-9 and abs(sum(w for (m, _), (w, _) in told.items() if m == "lang") - 1) < 1e-9
    # the cell of a is taken whole, so that the sample holds less of it than was wanted
    assert 0.5 <= told["source", "=a"][1] <= 0.9


def test_rare_cells_do_not_shrink_the_sample(spark):
    rows = [(i, "alpha beta gamma delta epsilon " * 20, "en" if i % 4 else "fr", "a" if i % 3 else "b", 1) for i in range(4000)]
    rare = [(9000, "some words " * 5, None, "a", 1), (9001, "some words " * 5, "en", None, 1)]
    common = mixing.sampled(table(spark, rows)).count()
    kept = {r.doc_id for r in mixing.sampled(table(spark, rows + rare)).collect()}
    assert len(kept) > 0.8 * common and {9000, 9001} <= kept


def test_expected_tokens_meet_the_budget(spark):
    rnd = random.Random(4)
    cells = [(rnd.randrange(1, 10 ** rnd.randrange(1, 6)), rnd.random()) for _ in range(60)]
    total, fitted = sum(n for n, _ in cells), sum(f for _, f in cells)
    rows = [(n, f / fitted, f / fitted * total / n) for n, f in cells]
    df = spark.createDataFrame(rows, "tokens long, fitted double, weight double").coalesce(1).cache()
    for budget in (0.001 * total, 0.3 * total, 0.9 * total, float(total), 2.0 * total):
        c = mixing._scale(df, float(total), budget)
        want = min(budget, total)
        assert abs(sum(min(1, c * w) * n for n, _, w in rows) - want) < 1e-6 * want
    c = mixing._scale(df, float(total), None)
    kept = sum(min(1, c * w) * n for n, _, w in rows) / total
    assert abs(kept - mixing.LEAST) < 1e-6 or (kept > mixing.LEAST and abs(kept / c - 1 + mixing.MISSING) < 1e-6)


def test_odd_rows(spark):
    docs = table(spark)
    kept = mixing.sampled(docs)
    assert kept.columns == docs.columns and kept.count() <= len(ODD)
    profile = mixing.profiled(docs, [F.col("doc_id")])
    assert sorted(r.tokens for r in profile.collect()) == sorted(len((t or "").split()) for _, t, *_ in ODD)


def test_few_words_are_kept():
    topics, all_words = mixing.Topics(), mixing.Topics()
    topics.kept = 50
    for i in range(200):
        text = f"common words word{chr(97 + i % 26) * (i // 26 + 1)} {'z' * i} letters{i}"
        assert topics.of(text) == all_words.of(text)
        assert len(topics) + len(topics.older) <= 50 and "common" in {*topics, *topics.older}


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.sampled(empty).count() == 0
    assert token_counts.count_tokens(empty).count() == 0


def reference(vocabulary):
    t = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary], unk_id=0, byte_fallback=False))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_token_counts_of_odd_rows(spark):
    count = reference(token_counts.vocabulary())
    got = token_counts.count_tokens(table(spark)).collect()
    want = sorted(((d, count(t or "")) for d, t, *_ in ODD), key=repr)
    assert sorted(((r.id, r.n_tokens) for r in got), key=repr) == want


def test_token_counts_with_ties_and_unknown_letters():
    rnd = random.Random(3)
    for _ in range(60):
        # few scores, so that segmentations tie
        pieces = {"▁" + x for x in ("", "a", "ab")} | {"".join(rnd.choices("abc", k=rnd.randrange(1, 5))) for _ in range(14)}
        vocabulary = [(p, float(-rnd.randrange(1, 4))) for p in sorted(pieces)]
        counter, count = token_counts.Counter(vocabulary), reference(vocabulary)
        for _ in range(60):
            text = "".join(rnd.choices("abcz ▁", k=rnd.randrange(0, 14)))
            assert counter.tokens(text) == count(text), (vocabulary, text)
