"""Small tables with every odd case, and brute-force versions of the operators."""

from __future__ import annotations

import re
import string
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0d]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

SENTENCE = "the quick brown fox jumps over the lazy dog and runs far away from every hunter in the old forest today"

ODD = [
    (1, None, "en", "a", 0),
    (2, "", None, "a", 0),
    (3, "   \n\t ", "en", None, 5),
    (4, "Hello World", "en", "a", 11),
    (5, "hello world", "en", "b", 11),
    (6, "HELLO wörld Ärger", "de", "b", 17),
    (7, "hello wÖrld ärger", "de", "b", 17),
    (8, SENTENCE, "en", "a", 1),
    (9, SENTENCE + " again", "en", "a", 1),
    (9, SENTENCE + " again", "en", "a", 1),
    (10, " ".join(f"word{i % 977}" for i in range(60_000)), "en", "a", 1),
    (11, "### $$$ %%% " * 40, "fr", "c", 1),
    (12, "日本語 のテキスト 😀😀 é́ ﬁ İ Σς ẞ", "ja", "c", 1),
    (None, "no id here", "en", "a", 1),
    (13, "a", None, None, None),
    (14, "12 34 !!", "en", "a", 1),
]


def table(spark, rows=ODD, clash: bool = True):
    """The rows as documents; with columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        for name in ("id", "score", "kept", "digest", "n", "stats", "length", "rank", "topic", "tokens", "c0", "key"):
            df = df.withColumn(name, F.lit("x"))
    return df


def lower(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None) -> set:
    w = words(lower(text))
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def held_out(doc_id, folds: int, fold: int) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % folds == fold


def near_components(texts: dict[int, str]) -> dict[int, int]:
    sets = {k: shingles(t) for k, t in texts.items()}
    where: dict = {}
    for k, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(k)
    both: dict = {}
    for ks in where.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1 :]:
                both[a, b] = both.get((a, b), 0) + 1
    parent = {k: k for k in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in texts}
