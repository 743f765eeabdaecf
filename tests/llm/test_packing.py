import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from arealis.llm import packing
from arealis.llm.wordbpe import WordBpe, tokenizer_path
from tests.llm.helpers import ODD, SCHEMA, table


def whole(text):
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t.encode(text, add_special_tokens=False).ids


def check_places(rows, capacity):
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


def test_odd_rows(spark):
    got = packing.pack(table(spark), with_ids=True).collect()
    want = []
    for d, t, *_ in ODD:
        ids = whole(t or "") + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want.append((d, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), part))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got), key=repr) == sorted(want, key=repr)
    n = check_places(got, 4096)
    assert n <= math.ceil(sum(w[3] for w in want) / 4096) + 1


def test_small_capacity(spark):
    rows = [(i, "word " * (i % 23), "en", "a", 1) for i in range(300)]
    got = packing.pack(table(spark, rows), capacity=16).collect()
    total = sum(r.length for r in got)
    assert check_places(got, 16) <= math.ceil(total / 16) + 1


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_places_every_piece_once():
    rnd = random.Random(2)
    for _ in range(20):
        capacity = rnd.choice((7, 64, 300))
        counts = np.zeros(capacity + 1, np.int64)
        for _ in range(rnd.randrange(1, 40)):
            counts[rnd.randrange(1, capacity + 1)] += rnd.randrange(1, 50)
        fillings = packing.fewest(counts, capacity)
        placed = np.zeros(capacity + 1, np.int64)
        for filling, times in fillings:
            assert sum(s * n for s, n in filling) <= capacity
            for s, n in filling:
                placed[s] += n * times
        assert (placed == counts).all()
        sequences = sum(t for _, t in fillings)
        assert sequences <= sum(t for _, t in packing.best_fit(counts, capacity))
        assert sequences >= (counts * np.arange(capacity + 1)).sum() / capacity


def test_word_cache_is_exact():
    rnd = random.Random(5)
    alphabet = "abzABZéÉßẞİıΣσςǅ '’.,-_!09½ªº́​  \n\t日😀<|>endoftext"
    bpe = WordBpe(tokenizer_path())
    for _ in range(3000):
        text = "".join(rnd.choices(alphabet, k=rnd.randrange(40)))
        assert np.frombuffer(bpe.ids(text), "<u4").tolist() == whole_fast(text), repr(text)


_WHOLE = Tokenizer.from_file(tokenizer_path())
_WHOLE.encode_special_tokens = True


def whole_fast(text):
    return _WHOLE.encode(text, add_special_tokens=False).ids


def test_few_chunks_are_kept():
    bpe = WordBpe(tokenizer_path())
    chunks = bpe.chunks
    chunks.kept = 60
    for i in range(400):
        text = f"common word{i}, Other{i}x " + "long" * 40 + f"{i}."
        assert np.frombuffer(bpe.ids(text), "<u4").tolist() == whole_fast(text)
        held = {**chunks.older, **chunks}
        assert len(held) <= 60 and "common" in held and max(map(len, held)) <= chunks.longest
    bpe.forget()
    assert not chunks and not chunks.older


def test_workers_hold_no_chunks_after_their_tasks(spark):
    def held(batches):
        for batch in batches:
            n = sum(len(b.chunks) for b in WordBpe._made.values())
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(batch), pa.int64())], names=["n"])

    rows = [(i, f"some words of text{i}", "en", "a", 1) for i in range(200)]
    assert packing.pack(table(spark, rows)).count() == 200
    assert spark.range(0, 64, 1, 64).mapInArrow(held, "n long").groupBy().sum("n").first()[0] == 0
