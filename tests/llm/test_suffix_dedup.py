import hashlib
import random

import numpy as np
import pytest

from arealis.llm import suffix_dedup
from arealis.llm.suffix_array import collection
from tests.llm.helpers import ODD, SCHEMA, table


def brute(rows):
    first, out = {}, {}
    for doc, text in sorted(rows):
        for p in range(len(text) - 49):
            first.setdefault(text[p : p + 50], doc)
    for doc, text in rows:
        gone = np.zeros(len(text) + 1, bool)
        for p in range(len(text) - 49):
            if first[text[p : p + 50]] < doc:
                gone[p : p + 50] = True
        kept = bytes(x for x, g in zip(text, gone) if not g)
        out[doc] = (len(text), int(gone.sum()), int((np.diff(gone.astype(int)) == -1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def check(spark, rows, clash=True):
    want = brute(list({(d, (t or "").encode()) for d, t, *_ in rows if d is not None}))
    got = suffix_dedup.remove_repeats(table(spark, rows, clash)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.id is not None:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.id], r.id
        else:
            assert r.n_removed == 0


def test_odd_rows(spark):
    check(spark, [r for r in ODD if r[0] != 10])


@pytest.mark.parametrize("lot", [200, 4_000_000])
def test_passages(spark, monkeypatch, lot):
    rnd = random.Random(7)
    monkeypatch.setattr(suffix_dedup, "LOT", lot)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 3000)
    passages = ["".join(rnd.choices("abcdé ", k=rnd.choice((49, 50, 51, 90, 400)))) for _ in range(12)]
    rows = []
    for i in range(90):
        parts = [rnd.choice(passages)[rnd.randrange(3) :] if rnd.random() < 0.5 else "".join(rnd.choices("abcdefgh ", k=rnd.randrange(90))) for _ in range(5)]
        rows.append((i, "".join(parts), "en", "a", 1))
    rows += [(200 + i, "ab" * rnd.randrange(20, 500), "en", "a", 1) for i in range(6)]
    rows += [(300 + i, "x" * rnd.randrange(40, 900), "en", "a", 1) for i in range(6)]
    check(spark, rows, False)


def test_empty(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_column_wise_construction():
    rnd = random.Random(1)
    for t in range(200):
        texts = [bytes(rnd.choice(b"ab" if t % 2 else b"abc\xff\x00") for _ in range(rnd.randint(0, 12))) for _ in range(rnd.randint(1, 8))]
        number, start, common = collection(texts, 5)
        suffixes = sorted((texts[i][k:], i, k) for i in range(len(texts)) for k in range(len(texts[i]) + 1))
        assert [(i, k) for _, i, k in suffixes] == list(zip(number.tolist(), start.tolist()))
        for j, (a, *_) in enumerate(suffixes):
            b = suffixes[j - 1][0] if j else b""
            same = next((x for x in range(min(len(a), len(b))) if a[x] != b[x]), min(len(a), len(b)))
            assert common[j] == min(same, 5)
