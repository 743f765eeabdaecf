"""Alignment of two tokenizers against token-by-token comparison of whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.llm import alignment
from tests.llm.helpers import ODD, SCHEMA, SENTENCE, table

SIDES = alignment.Sides.of(*alignment._paths(None, None))
ROWS = [
    *ODD,
    (20, "a ▁ mark", "en", "a", 1),
    (21, "<|endoftext|> <s> </s> <0x41> <unk>", "en", "a", 1),
    (22, "  two  blanks\n\n and a tail   ", "en", "a", 1),
    (23, " ", "en", "a", 1),
    (24, "Donaudampfschifffahrtsgesellschaft Ünïcödé naïve façade", "de", "a", 1),
    (25, SENTENCE * 3, "en", "a", 1),
]


def whole(text):
    """(ids, ends) of both sides, or none."""
    if not text:
        return [], [], [], []
    a = SIDES.a.encode(" " + text, add_special_tokens=False).ids
    b = SIDES.b.encode(text)
    out = []
    for ids, spelt in ((a, SIDES.a_bytes), (b, SIDES.b_bytes)):
        if b"".join(spelt[i] for i in ids) != (" " + text).encode():
            return [], [], [], []
        out += [ids, list(np.cumsum([len(spelt[i]) for i in ids]))]
    return out


def links_of(text):
    a, a_end, b, b_end = whole(text)
    out, j = [], 0
    for i, end in enumerate(a_end):
        start = a_end[i - 1] if i else 0
        while j and (b_end[j - 1] > start):
            j -= 1
        while b_end[j] <= start:
            j += 1
        while j < len(b) and (b_end[j - 1] if j else 0) < end:
            out.append((i, j))
            j += 1
        j -= 1
    return out


def groups_of(text):
    a, a_end, b, b_end = whole(text)
    both, out, i, j = sorted(set(a_end) & set(b_end)), [], 0, 0
    for cut in both:
        first_i, first_j = i, j
        while i < len(a) and a_end[i] <= cut:
            i += 1
        while j < len(b) and b_end[j] <= cut:
            j += 1
        out.append((a[first_i:i], b[first_j:j]))
    return out


def expected(rows):
    links = {i: links_of(r[1]) for i, r in enumerate(rows)}
    pairs = {}
    for i, r in enumerate(rows):
        a, _, b, _ = whole(r[1])
        pairs[i] = [(a[x], b[y]) for x, y in links[i]]
    count = Counter(p for ps in pairs.values() for p in ps)
    highest = Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    out = []
    for i, r in enumerate(rows):
        a, _, b, _ = whole(r[1])
        groups = groups_of(r[1])
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(count[p] == highest[p[1]] for p in pairs[i])
        sha = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out.append((r[0], len(a), len(b), len(groups), len(links[i]), best, sum(count[p] for p in pairs[i]), sha))
    return sorted(out, key=str)


def got(df):
    names = ("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_against_whole_texts(spark):
    assert got(alignment.summarised(table(spark, ROWS))) == expected(ROWS)


def test_many_partitions_and_copies(spark):
    rows = [(i, SENTENCE if i % 3 else f"{SENTENCE} number{i} 数{i}", "en", "a", 1) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert got(alignment.summarised(df)) == expected(rows)


def test_empty_table(spark):
    assert alignment.summarised(spark.createDataFrame([], SCHEMA)).count() == 0
    assert alignment.align(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tokens_links_and_groups_themselves(spark):
    found = alignment.align(table(spark, ROWS).coalesce(1)).orderBy("row", "window").collect()
    long = [r for r in found if r["id"] == 10]
    text = next(r[1] for r in ROWS if r[0] == 10)
    assert len(long) > 1 and [t["id"] for r in long for t in r["a"]] == whole(text)[0]
    assert sum(len(r["links"]) for r in long) == len(links_of(text))
    found, rows = [r for r in found if r["id"] != 10], [r for r in ROWS if r[0] != 10]
    assert [r["id"] for r in found] == [r[0] for r in rows]
    for row, (_, text, *_) in zip(found, rows):
        a, a_end, b, b_end = whole(text)
        assert [t["id"] for t in row["a"]] == a and [t["end"] for t in row["a"]] == a_end
        assert [t["id"] for t in row["b"]] == b and [t["end"] for t in row["b"]] == b_end
        assert sorted((x["a"], x["b"]) for x in row["links"]) == links_of(text)
        spelt = (" " + (text or "")).encode()
        assert b"".join(spelt[t["start"] : t["end"]] for t in row["a"]) == (spelt if a else b"")
        groups = [([], []) for _ in groups_of(text)]
        for side, tokens in enumerate((row["a"], row["b"])):
            for t in tokens:
                groups[t["part"]][side].append(t["id"])
        assert groups == groups_of(text)


@pytest.mark.parametrize("size", [1, 7, 40, 1000])
def test_windows_of_long_texts_change_nothing(monkeypatch, size):
    """A long text in windows and lots has the tokens, links and groups of the whole text."""
    random.seed(size)
    words = ["alpha", "Übermut", "naïve", "", "\n", "12,5", "日本", "x" * 30, "\t", "don't"]
    texts = [" ".join(random.choice(words) for _ in range(200)) for _ in range(5)] + ["", None, "a ▁ b"]
    monkeypatch.setattr(alignment, "WINDOW", size)
    monkeypatch.setattr(alignment, "LOT", 500)
    parts, links, lots = {}, Counter(), 0
    for owners, found in alignment._lots(SIDES, iter((i, t) for i, t in enumerate(texts))):
        lots += 1
        for (number, _, _), text, n in zip(owners, found.spelt(), found.n_links):
            parts.setdefault(number, []).append(text)
            links[number] += n
    assert lots > 3
    for i, text in enumerate(texts):
        want = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups_of(text))
        assert b";".join(parts[i]).decode() == want
        assert links[i] == len(links_of(text))


def test_cutting_into_words_keeps_the_ids():
    random.seed(3)
    letters = " \n\t  aeéЖ日😀<|endoftext|>'s 12.\x00\x1c\x85\xa0 ▁`"
    for _ in range(3000):
        text = "".join(random.choice(letters) for _ in range(random.randint(1, 14)))
        a, _, b, _ = whole(text)
        assert SIDES.covers(text) == bool(a)
        if a:
            codes = SIDES.codes(alignment.split(text))
            assert [list(side.of(codes)[0]) for side in (SIDES.kept_a, SIDES.kept_b)] == [a, b]


def test_query(spark, tmp_path):
    out = alignment.op11_cross_tokenizer_alignment(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert got(out.select("*", F.col("doc_id").alias("id"))) == expected([(r[0], r[1]) for r in docs])
