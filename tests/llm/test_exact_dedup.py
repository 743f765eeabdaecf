import hashlib

from pyspark.sql import functions as F

from arealis.llm import exact_dedup
from arealis.session import scratch_path
from tests.llm.helpers import ODD, SCHEMA, lower, table


def expected(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(lower(text), []).append(doc_id)
    top = {t: max(ids, key=lambda x: (x is not None, x or 0)) for t, ids in groups.items()}
    return sorted(
        ((d, top[lower(t)], len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest()) for d, t, *_ in rows),
        key=repr,
    )


def rows_of(df):
    return sorted(((r.id, r.keep_id, r.group_size, r.digest) for r in df.collect()), key=repr)


def test_odd_rows(spark):
    df = exact_dedup.exact_dedup(table(spark))
    assert rows_of(df) == expected(ODD)
    # one row of each group stays, also of repeated rows
    assert df.where("kept").count() == len({lower(t) for _, t, *_ in ODD})


def test_empty(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_colliding_digests(spark):
    df = exact_dedup.exact_dedup(table(spark), digest=lambda t: F.substring(F.sha2(t, 256), 1, 1))
    got = sorted(((r.id, r.keep_id, r.group_size) for r in df.collect()), key=repr)
    assert got == sorted([e[:3] for e in expected(ODD)], key=repr)


def test_state_goes_on(spark):
    folder, state = scratch_path(spark, "arriving"), scratch_path(spark, "state")
    place = {"digest": "d", "_file": "f"}
    for day, ids in enumerate(([1, 2], [5])):
        spark.createDataFrame([(place["digest"], i, place["_file"], i) for i in ids], "digest string, id long, _file string, _row long").write.mode("append").parquet(folder)
        feed = spark.readStream.schema("digest string, id long, _file string, _row long").parquet(folder)
        found = exact_dedup.ledger(feed, state).first()
        assert (found.stays.id, found.n) == ((2, 2), (5, 3))[day]


def test_distinct_documents(spark):
    docs = table(spark)
    kept = exact_dedup.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({lower(t) for _, t, *_ in ODD})
