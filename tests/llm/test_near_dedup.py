import random

from arealis.llm import near_dedup
from arealis.llm.graph import components, linked
from tests.llm.helpers import ODD, SCHEMA, near_components, shingles, table


def check(spark, rows, clash=True):
    texts = {d: t for d, t, *_ in rows if d is not None}
    want = near_components(texts)
    got = near_dedup.near_groups(table(spark, rows, clash)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(shingles(texts[r.id])), want[r.id], want[r.id] == r.id)


def test_odd_rows(spark):
    check(spark, ODD)


def test_chains_and_edits(spark):
    rnd = random.Random(3)
    rows, text = [], [f"w{rnd.randrange(5000)}" for _ in range(120)]
    for i in range(120):
        rows.append((i, " ".join(text), "en", "a", 1))
        if i % 40 == 39:
            text = [f"w{rnd.randrange(5000)}" for _ in range(120)]
        for _ in range(rnd.randrange(1, 4)):
            text[rnd.randrange(len(text))] = f"w{rnd.randrange(5000)}"
    rnd.shuffle(rows)
    check(spark, rows, False)


def test_empty(spark):
    assert near_dedup.near_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_of_each_group(spark):
    docs = table(spark)
    kept = near_dedup.one_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert None in ids and 8 in ids and 9 not in ids


def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(50)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_components_after_further_edges(spark):
    """In steps as at once; the further edges are linked between components, not between all their members."""
    rnd = random.Random(5)
    steps = [[(rnd.randrange(300), rnd.randrange(300)) for _ in range(n)] for n in (90, 1, 60, 0, 50)]
    steps[1] = [(7, 7)]
    frames = [spark.createDataFrame(s, "a long, b long") for s in steps]
    found = components(frames[0])
    for more in frames[1:]:
        found = linked(found, more)
    want = {r.id: r.component for r in components(spark.createDataFrame(sum(steps, []), "a long, b long")).collect()}
    got = found.collect()
    assert len(got) == len(want) and {r.id: r.component for r in got} == want


def test_one_large_and_many_single_components_in_a_bucket(spark):
    """Copies that differ in a word, and texts that share their passages with them but not enough to be linked."""
    rnd = random.Random(6)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(80):
        text = list(base)
        text[rnd.randrange(100)] = f"x{i}"
        rows.append((i, " ".join(text), "en", "a", 1))
    for i in range(250):  # three quarters of the text and words of their own: similarity below 0.75 to all
        own = [f"y{i}q{j}" for j in range(rnd.randrange(14, 30))]
        rows.append((1000 + i, " ".join(base[:90] + own), "en", "a", 1))
    check(spark, rows, False)


def test_half_keys_tell_bands_apart():
    import numpy as np

    sig = np.arange(near_dedup.HASHES, dtype=np.int64)
    assert len(set(near_dedup.half_keys(sig).tolist())) == 2 * near_dedup.BANDS
    same = near_dedup.half_keys(np.full(near_dedup.HASHES, 7, np.int64))
    assert len(set(same.tolist())) == 2 * near_dedup.BANDS


def test_sets_too_far_apart_give_no_pairs_in_the_last_turn(spark, monkeypatch):
    """A large group, and texts with three quarters of its passage: their pairs have like minhashes, but no room."""
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]]), "en", "a", 1) for i in range(60)]
    for i in range(60):
        text = list(base)
        for at in rnd.sample(range(0, 150, 15), 8):  # some 40 of 146 shingles are others: similarity 0.57
            text[at] = f"y{i}q{at}"
        rows.append((1000 + i, " ".join(text), "en", "a", 1))
    met = []
    whole = near_dedup._between
    monkeypatch.setattr(near_dedup, "_between", lambda told: met.append((told.count(), whole(told).count())) or whole(told))
    check(spark, rows, False)
    assert met[0][0] > 1000 and met[0][1] < 600


def test_room_is_never_less_than_the_intersection():
    import numpy as np

    rnd = np.random.default_rng(2)
    for size in (1, 5, 150, 3000):
        x, own = (np.unique(rnd.integers(0, 2**64 - 1, size, np.uint64)) for _ in range(2))
        y = np.unique(np.concatenate([x[: size - size // 5], own[: size // 5]]))
        room = np.minimum(*(near_dedup.block_counts(z.view(np.int64)).astype(int) for z in (x, y))).sum()
        assert len(np.intersect1d(x, y)) <= room <= min(len(x), len(y))
    assert near_dedup.block_counts(np.zeros(128, np.int64)) is None


def test_turns_without_links_link_nothing_anew(spark, monkeypatch):
    """Two texts that share buckets but are too far apart: the turns find nothing and leave the components alone."""
    words = [f"w{i}" for i in range(100)]
    other = [f"x{i}" if i in (20, 40, 60, 80) else w for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(other) + " end")]
    calls = {"linked": 0, "turns": 0}

    def counted(name, f):
        def run(*args):
            calls[name] += 1
            return f(*args)

        return run

    monkeypatch.setattr(near_dedup, "linked", counted("linked", near_dedup.linked))
    monkeypatch.setattr(near_dedup, "_against_one", counted("turns", near_dedup._against_one))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["id"]: r["component_id"] for r in near_dedup.near_groups(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 2}
    assert calls == {"linked": 0, "turns": near_dedup.TURNS - 1}
