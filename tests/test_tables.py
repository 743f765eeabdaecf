"""Names, batches, patterns, sources, stream."""

import difflib
import json

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.functions import ids, shapes, text
from arealis.operators import dictionary as dct
from arealis.operators import names, select, spatial
from arealis.plans.table_query import table_query
from arealis.session import scratch_path
from arealis.sources import catalogue, codes, features, landed, pieces, replicates, responses
from arealis.operators import dictionary
from arealis.operators.moe_replicate import collapse
from arealis.operators.names import best_matches
from arealis.sources import rejects
from arealis.streaming.keyed import KeyedTable, load_keyed
from arealis.streaming.landing import latest, load_new

PLACES = [
    "Chicago city, IL",
    "North Chicago city, IL",
    "Chicago Heights city, IL",
    "West Chicago city, IL",
    "Chico city, CA",
    "Springfield city, IL",
    "Springfield city, MO",
    "Kansas City city, MO",
]


@pytest.mark.parametrize(
    "a, b, partial, full",
    [
        ("chicago", "chicago", 100, 100),
        ("chicago", "west chicago", 100, 74),
        ("abcd", "xbcx", 50, 50),
        ("", "abc", 0, 0),
        ("yankees", "new york yankees", 100, 61),
    ],
)
def test_scores(a, b, partial, full):
    assert (text.partial_score(a, b), text.full_score(a, b)) == (partial, full)
    assert text.partial_score(b, a) == partial


def test_score_of_whole_strings_is_the_matching_share():
    for a in PLACES:
        for b in PLACES:
            want = 100 if a == b else round(100 * difflib.SequenceMatcher(None, a, b).ratio())
            assert text.full_score(a, b) == want


def place_table(spark, copies=1):
    rows = [(n, i + c * 100) for c in range(copies) for i, n in enumerate(PLACES)]
    return spark.createDataFrame(rows, "target string, position long")


def test_best_match_and_ties(spark):
    wanted = ["chicago city, IL", "springfield", "kansas, mo", "nowhere, ZZ"]
    got = {r["query"]: r for r in names.best_matches(place_table(spark).repartition(3), wanted).collect()}
    assert got["chicago city, IL"]["target"] == "Chicago city, IL"
    assert not got["chicago city, IL"]["ambiguous"]
    assert got["springfield"]["target"] == "Springfield city, IL"  # the first of two equal ones
    assert got["springfield"]["ambiguous"]
    assert got["kansas, mo"]["target"] == "Kansas City city, MO"
    assert "nowhere, ZZ" not in got


def test_best_match_of_resembling_names_against_brute_force(spark):
    targets = [f"Customer#{i:09d}, N_{i % 5}" for i in range(300)]
    df = spark.createDataFrame(list(zip(targets, range(300))), "target string, position long")
    wanted = [f"customer{i:09d}, n_{i % 5}" for i in (7, 133, 131, 144, 299)] + ["custoner#12"]
    got = {r["query"]: r for r in names.best_matches(df.repartition(4), wanted).collect()}
    for q in wanted:
        name, state = text.split_query(q)
        pool = [(i, t.lower()) for i, t in enumerate(targets) if state is None or t.lower().endswith(state)]
        scores = {i: (text.partial_score(name, t), text.full_score(name, t)) for i, t in pool}
        best = max(scores.values())
        ties = [i for i, s in scores.items() if s == best]
        row = got[q]
        assert (row["position"], row["score"], row["score2"]) == (ties[0], *best)
        assert row["ambiguous"] == (len(ties) > 1)


def every_score(names_, targets):
    """Best match of each name by scoring all candidates."""
    out = {}
    for q in names_:
        name, state = text.split_query(q)
        pool = [(i, t.lower()) for i, t in enumerate(targets) if state is None or t.lower().endswith(state)]
        scores = {i: (text.partial_score(name, t), text.full_score(name, t)) for i, t in pool}
        if scores:
            best = max(scores.values())
            ties = [i for i, s in scores.items() if s == best]
            out[q] = (ties[0], *best, len(ties) > 1)
    return out


def random_names(count, seed):
    rnd = random.Random(seed)
    heads = ["San", "Santa", "North", "New", "Port", "Lake", "Mount", "Saint", "El", ""]
    syllables = "ber ton ville wood ka lo mi ra sa dor fen ham ly que st an ñu é".split()
    kinds = ["city", "town", "CDP", "village", "borough", "", "county"]
    states = ["IL", "AL", "MO", "CA"]
    out = []
    for _ in range(count):
        body = "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))).capitalize()
        out.append(" ".join(x for x in (rnd.choice(heads), body, rnd.choice(kinds)) if x) + f", {rnd.choice(states)}")
    return out


def test_bounded_and_indexed_matches_equal_scoring_all(spark):
    targets = random_names(10_000, 4)
    rnd = random.Random(8)
    wanted = []
    for t in rnd.sample(targets, 14):  # a name with some letters changed, lost or added
        letters = list(t.split(",")[0])
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(letters))
            letters[at : at + rnd.randint(0, 1)] = rnd.choice(["", "x", "e", "qu"])
        wanted.append("".join(letters) + rnd.choice(["", ", IL", ", mo"]))
    wanted += ["zzzzqqqq", "x", "lo", "Sankt Bertonvile", "st, zz"]
    want = every_score(wanted, targets)
    df = spark.createDataFrame([(t, i) for i, t in enumerate(targets)], "target string, position long").repartition(5)
    for candidates in (df, names.NameIndex.build(df)):
        got = {r["query"]: (r["position"], r["score"], r["score2"], r["ambiguous"]) for r in names.best_matches(candidates, wanted).collect()}
        assert got == want
    assert sum(50 < s < 100 for _, s, _, _ in want.values()) > 5


def test_score_bounds_hold(spark):
    rnd = random.Random(2)
    texts = random_names(300, 3) + ["", "a", "aaaa", "aaaaaaaa", "abcabcabc", "abab"]
    wanted = [t.split(",")[0] for t in rnd.sample(texts, 12)] + ["aaaaa", "abcabc", "ab"]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "target string, position long")
    pairs = names._pairs(df, wanted)
    rows = pairs.select("name", "low", names._score_bound(True).alias("p"), names._score_bound(False).alias("f")).collect()
    assert len(rows) == len(texts) * len(wanted)
    for r in rows:
        assert text.partial_score(r["name"], r["low"]) <= r["p"] <= 100
        assert text.full_score(r["name"], r["low"]) <= r["f"] <= 100


def test_copies_of_a_name_are_counted_over_partitions(spark):
    df = place_table(spark, copies=50).repartition(7)
    row = names.best_matches(df, "kansas city").first()
    assert row["position"] == 7 and row["ambiguous"]


def test_too_many_commas_is_an_error():
    with pytest.raises(ValueError):
        text.split_query("a, b, c")


@pytest.mark.parametrize("n", [1, 5, 23, 100, 501])
def test_column_batches_like_array_split(n):
    cols = [f"c{i}" for i in range(n)]
    want = [list(map(str, c)) for c in np.array_split(cols, int(np.ceil(n / 49)))]
    assert select.column_batches(cols) == want


def test_id_batches_like_array_split(spark):
    sizes = {"a": 1203, "b": 500, "c": 1, "d": 77}
    rows = [(g, f"{i * 7:06d}") for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "g string, id string").repartition(5)
    got = select.id_batches(df, ["g"], "id", F.substring("id", 1, 3), most=100)
    for g, n in sizes.items():
        want = [len(c) for c in np.array_split(np.arange(n), int(np.ceil(n / 100)))]
        counts = got.where(F.col("g") == g).groupBy("batch").count().orderBy("batch").collect()
        assert [r["count"] for r in counts] == want
        ordered = got.where(F.col("g") == g).orderBy("position").collect()
        assert [r["id"] for r in ordered] == sorted(i for h, i in rows if h == g)


def test_requested_ids_keep_their_order(spark):
    data = spark.createDataFrame([("b", 1), ("a", 2)], "geoid string, v int")
    wanted = select.requested(spark, ["c", "b", "a"])
    out = select.as_requested(wanted, data).orderBy("position").collect()
    assert [(r["geoid"], r["v"]) for r in out] == [("c", None), ("b", 1), ("a", 2)]
    assert [r["geoid"] for r in select.absent(wanted, data).collect()] == ["c"]


def test_padding_never_cuts(spark):
    df = spark.createDataFrame([("7",), ("0123456",)], "c string")
    assert [r[0] for r in df.select(ids.pad_left("c", 3)).collect()] == ["007", "0123456"]


def test_level_names_in_any_case():
    assert ids.level_code("Tract") == ids.level_code("140") == "140"
    with pytest.raises(ValueError):
        ids.level_code("planet")


@pytest.mark.parametrize("engine, pattern, want", [
    ("re", "^B.*1$", {"B01", "B11"}),
    ("fnmatch", "?0*", {"B01", "C02"}),
    ("fnmatch", "b*", set()),
    (lambda c, p: c.endswith(p), "2", {"C02"}),
])
def test_patterns(spark, engine, pattern, want):
    df = spark.createDataFrame([("B01",), ("B11",), ("C02",), (None,)], "name string")
    assert {r["name"] for r in dct.search(df, pattern, engine=engine).collect()} == want


def test_missing_text_counts_as_empty(spark):
    df = spark.createDataFrame([("B01", None), ("B02", "x")], "name string, label string")
    assert [r["name"] for r in dct.search(df, "^$", by="label").collect()] == ["B01"]


def test_survey_tables_with_two_descriptions_raise(spark):
    df = spark.createDataFrame(
        [("B01_001E", "x"), ("B01_002E", "y"), ("GEO_ID", "g")], "name string, concept string"
    )
    with pytest.raises(Exception, match="more than one description"):
        dct.table_list(df, "survey").collect()


def test_columns_are_cast_as_a_whole_or_not_at_all(spark):
    df = spark.createDataFrame([("1", "1"), ("2.5", "x"), (None, "3")], "a string, b string")
    out = select.replace_missing(select.to_numbers(df, ["a", "b"]), ["a", "b"], codes=[2.5])
    assert dict(out.dtypes) == {"a": "double", "b": "string"}
    assert [r["a"] for r in out.collect()] == [1.0, None, None]


def test_unknown_columns_are_an_error(spark):
    with pytest.raises(ValueError):
        table_query(spark.range(1), ["nothing"])


def write(spark, name, *texts):
    path = scratch_path(spark, name)
    for i, t in enumerate(texts):
        spark.createDataFrame([(t,)], "value string").coalesce(1).write.mode("append").text(path)
    return path


def test_responses_with_differing_headers_and_a_broken_file(spark):
    path = write(
        spark, "responses",
        json.dumps([["NAME", "P1", "state"], ["a", "1", "01"], ["b", None, "02"]]),
        json.dumps([["P1", "state", "NAME"], ["3", "04", "c"]]),
        "<html>sorry</html>",
    )
    out = responses.read_responses(spark, path, ["NAME", "state", "P1"])
    assert sorted(map(tuple, out.collect())) == [("a", "01", "1"), ("b", "02", None), ("c", "04", "3")]
    bad = responses.broken(catalogue.documents(spark, path)).collect()
    assert [r["value"].strip() for r in bad] == ["<html>sorry</html>"]


def test_a_later_answer_wins_and_bad_texts_are_kept_apart(spark):
    doc = lambda *rows: json.dumps([["id", "v"], *rows])
    landing = write(spark, "landing", doc(["1", "a"], ["2", "b"]))
    target, state = scratch_path(spark, "target"), scratch_path(spark, "state")
    bad = scratch_path(spark, "bad")
    args = (spark, landing, target, state, ["id", "v"], bad)
    load_new(*args).awaitTermination()
    more = [(doc(["2", "new"], ["3", "c"]),), ('{"error": 1}',)]
    spark.createDataFrame(more, "value string").repartition(2).write.mode("append").text(landing)
    load_new(*args).awaitTermination()
    load_new(*args).awaitTermination()
    rows = latest(spark.read.parquet(target), ["id"])
    assert sorted((r.id, r.v) for r in rows.collect()) == [("1", "a"), ("2", "new"), ("3", "c")]
    assert [r["value"].strip() for r in spark.read.parquet(bad).collect()] == ['{"error": 1}']


def test_a_bad_text_ends_the_load_where_rejects_have_no_place(spark):
    landing = write(spark, "landing", "<html>")
    with pytest.raises(Exception, match="no response table"):
        load_new(spark, landing, scratch_path(spark, "t"), scratch_path(spark, "s"), ["id"]).awaitTermination()


def test_rejects_of_every_reader(spark):
    for kind in rejects.REQUIRED:
        rows = [("a", '{"error": {"code": 400}}'), ("b", "<html>"), ("c", ""), ("d", "{}")]
        docs = spark.createDataFrame(rows, "path string, value string")
        assert rejects.rejected(docs, kind).count() == 4, kind


def test_a_table_with_two_descriptions_raises_whatever_is_read(spark):
    df = spark.createDataFrame([("B1_1E", "x"), ("B1_2E", "y")], "name string, concept string")
    for use in (lambda t: t.select("table").collect(), lambda t: t.count()):
        with pytest.raises(Exception, match="more than one description in table B1"):
            use(dictionary.table_list(df, "survey"))
    with pytest.raises(Exception, match="more than one description"):
        dictionary.table_columns(df, "survey").collect()


def test_replicates_of_another_length_raise(spark):
    df = spark.createDataFrame([("1", 1.0, [1.0] * 100)], "geoid string, est double, reps array<double>")
    for column in ("est", "reps"):
        with pytest.raises(Exception, match="expected 80 replicates"):
            collapse(df, ["geoid"]).select(column).collect()


def test_best_match_with_repeated_positions(spark):
    rows = [("Springfield", "1"), ("Springfield", "1"), ("Spring Hill", "1"), ("Shelbyville", "2")]
    got = best_matches(spark.createDataFrame(rows, "target string, position string"), ["springfield", "shelby"])
    assert {r["query"]: (r.target, r.ambiguous) for r in got.collect()} == {
        "springfield": ("Springfield", True), "shelby": ("Shelbyville", False),
    }


def test_features_of_all_kinds_with_z(spark):
    def layer(kind, geometry, **top):
        return json.dumps({"geometryType": kind, "spatialReference": {"wkid": 4326},
                           "features": [{"attributes": {"GEOID": kind}, "geometry": geometry, **top}]})

    path = write(
        spark, "layers",
        layer("esriGeometryPolygon", {"rings": [[[0, 0, 5], [0, 1, 5], [1, 1, 5]]]}),
        layer("esriGeometryPolyline", {"paths": [[[0, 0], [2, 2]], [[3, 3], [4, 4]]]}),
        layer("esriGeometryMultipoint", {"points": [[0, 0], [9, 9]]}),
        layer("esriGeometryPoint", None, x=7.0, y=8.0),
    )
    rows = features.read_features(spark, path, {"GEOID": "string"}, z=True).collect()
    got = {r["geometry"]["kind"]: [[(p.x, p.y, p.z) for p in ring] for ring in r["geometry"]["rings"]] for r in rows}
    assert got["MultiPolygon"] == [[(0, 0, 5), (0, 1, 5), (1, 1, 5)]]
    assert len(got["MultiLineString"]) == 2
    assert got["MultiPoint"] == [[(0, 0, None), (9, 9, None)]]
    assert got["Point"][0][0][:2] == (7, 8)
    assert {r["srid"] for r in rows} == {4326}


def test_landed_table_reads_one_partition(spark):
    path = scratch_path(spark, "landed")
    df = spark.createDataFrame([(2018, "tract", "a"), (2019, "tract", "b"), (2019, "county", "c")],
                               "vintage int, level string, v string")
    landed.write_landed(df, path)
    out = landed.read_landed(spark, path, level="tract")
    assert [r["v"] for r in out.collect()] == ["b"]
    assert "PartitionFilters: [isnotnull(vintage" in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        landed.read_landed(spark, path, vintage=2011)


def test_state_by_code_name_or_abbreviation(spark):
    states = spark.createDataFrame([("AK", "02", "ALASKA")], "abbreviation string, fips string, name string")
    assert all(codes.find_state(states, s).count() == 1 for s in ("ak", "Alaska", "2", "02"))


def test_merge_suffixes_names_that_differ_in_case_only(spark):
    left = spark.createDataFrame([(1, "a")], "place int, v string")
    right = spark.createDataFrame([(1, "b")], "PLACE int, w string")
    assert select.merge(left, right, ["place"], ["PLACE"]).columns == ["place_x", "v", "PLACE_y", "w"]


# --- large files -------------------------------------------------------------------------------


def layer_text(features, kind="esriGeometryPolygon"):
    head = {"displayFieldName": "NAME", "geometryType": kind, "spatialReference": {"wkid": 102100, "latestWkid": 3857}}
    return json.dumps({**head, "features": features}, separators=(",", ":"), ensure_ascii=False)


def features_of(count, seed):
    rnd = random.Random(seed)
    odd = ['{"attributes":{"a":1}},{', "}},{", "a\\", 'say "x"', "Übergröße 数", "", None, "\n{"]
    out = []
    for i in range(count):
        ring = [[rnd.uniform(0, 9e6), rnd.uniform(0, 9e6)] for _ in range(rnd.randint(3, 60))]
        out.append({"attributes": {"GEOID": str(i), "NAME": rnd.choice(odd), "AREA": i}, "geometry": {"rings": [ring]}})
    return out


def test_a_large_layer_is_read_by_many_tasks(spark, tmp_path):
    """The rows of the whole-text reader, from ranges of the file."""
    attributes = {"GEOID": "string", "NAME": "string", "AREA": "int"}
    (tmp_path / "a.json").write_text(layer_text(features_of(4000, 1)), encoding="utf-8")
    (tmp_path / "b.json").write_text(layer_text(features_of(30, 2), "esriGeometryPolyline") + "\n", encoding="utf-8")
    (tmp_path / "none.json").write_text(layer_text([]), encoding="utf-8")
    size = (tmp_path / "a.json").stat().st_size
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 8 + 1))
    try:
        tasks = pieces.cut(spark, str(tmp_path / "a.json"), pieces.FEATURE)
        counts = tasks.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum(F.length("value")).alias("s"))
        parts = counts.collect()
        assert len(parts) >= 8 and max(r["s"] for r in parts) < size // 4
        got = pieces.read_features(spark, str(tmp_path), attributes).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = features.read_features(spark, str(tmp_path), attributes).collect()
    assert len(want) == 4030 and sorted(map(repr, got)) == sorted(map(repr, want))
    assert pieces.broken_features(spark, str(tmp_path)).count() == 0


def test_features_that_do_not_read_are_named(spark, tmp_path):
    text = layer_text(features_of(3, 3)).replace('{"attributes":{"GEOID":"1"', '{"attributes":["GEOID":"1"')
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    rows = pieces.read_features(spark, str(tmp_path), {"GEOID": "string"}).collect()
    assert [r["GEOID"] for r in rows] == ["0", "2"]
    assert pieces.broken_features(spark, str(tmp_path)).count() == 1
    late = '{"features":[{"attributes":{"GEOID":"1"},"geometry":{"x":1,"y":2}}],"geometryType":"esriGeometryPoint"}'
    (tmp_path / "b.json").write_text(late, encoding="utf-8")
    with pytest.raises(Exception, match="not described before"):
        pieces.read_features(spark, str(tmp_path), {"GEOID": "string"}).collect()


def test_responses_line_by_line(spark, tmp_path):
    table = [["NAME", "B01", "state"]] + [[f'a "{i}"],[', None if i % 7 == 0 else str(i), "01"] for i in range(500)]
    other = [["B01", "state"], ["7", "02"]]
    dump = lambda t, sep: "[" + sep.join(json.dumps(r) for r in t) + "]"
    (tmp_path / "a.json").write_text(dump(table, ",\n"))
    (tmp_path / "b.json").write_text(dump(other, ",\r\n") + "\n")
    (tmp_path / "c.json").write_text(dump(other, ","))
    (tmp_path / "d.json").write_text(dump(table[:1], ","))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = pieces.read_responses(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = responses.read_responses(spark, str(tmp_path)).collect()
    assert len(want) == 502 and got[0].asDict().keys() == want[0].asDict().keys()
    assert sorted(map(repr, got)) == sorted(map(repr, want))


# --- rows that do not fit ---------------------------------------------------------------------


def test_longer_rows_are_rejected_and_shorter_ones_filled(spark, tmp_path):
    text_ = 'AL,01,001,"Autauga, County",H1\nAL,2,y,extra,more,cells\nAL,01,003\n"a ""b"", c",1,2,3,4\n'
    (tmp_path / "national_county.txt").write_text(text_, encoding="latin-1")
    rows = [tuple(r) for r in codes.read_area_codes(spark, str(tmp_path), "county", None).collect()]
    assert rows == [("AL", "01", "001", "Autauga, County", "H1"), ("AL", "01", "003", None, None), ('a "b", c', "1", "2", "3", "4")]
    bad = codes.rejected_area_codes(spark, str(tmp_path), "county").collect()
    assert [r["line"] for r in bad] == ["AL,2,y,extra,more,cells"] and bad[0]["path"].endswith("national_county.txt")


def test_the_longest_line_gives_the_width_of_a_file_without_names(spark, tmp_path):
    (tmp_path / "national_schdist.txt").write_text('AL,2,y\nAL,2,y,extra,more\nAL,"a,b",c\n', encoding="latin-1")
    rows = [tuple(r) for r in codes.read_area_codes(spark, str(tmp_path), "School District", None).collect()]
    assert rows == [("AL", "2", "y", None, None), ("AL", "2", "y", "extra", "more"), ("AL", "a,b", "c", None, None)]
    assert codes.rejected_area_codes(spark, str(tmp_path), "School District").count() == 0


def test_numbers_that_do_not_read_are_rejected(spark, tmp_path):
    people, weights = str(tmp_path / "p.csv"), str(tmp_path / "w.csv")
    (tmp_path / "p.csv").write_text("population,name,geoid,state\n12,a,1,1\n12x,b,2,1\n,c,3,1\n")
    (tmp_path / "w.csv").write_text("fips,avg_weight\n1,2.5\n2,two\n3\n4,5,6\n")
    assert [tuple(r) for r in codes.read_populations(spark, people).collect()] == [("1", 12.0, "a", "01"), ("3", None, "c", "01")]
    assert [r["line"] for r in codes.rejected_populations(spark, people).collect()] == ["12x,b,2,1"]
    assert [tuple(r) for r in codes.read_weights(spark, weights).collect()] == [("01", 2.5)]
    assert [r["line"] for r in codes.rejected_weights(spark, weights).collect()] == ["2,two", "3", "4,5,6"]


def test_replicate_rows_that_do_not_fit_are_rejected(spark, tmp_path):
    names = [f.name for f in replicates.FILE_SCHEMA.fields]
    good = ["T", "g1", "n", "1", "t", "5", "1", "", "1"] + ["1"] * 80
    lines_ = [names, good, good[:5] + ["5z"] + good[6:], good[:-1] + ["1_0"], good + ["1"]]
    (tmp_path / "r.csv").write_text("\n".join(",".join(x) for x in lines_) + "\n")
    path = str(tmp_path / "r.csv")
    assert replicates.read_replicates(spark, path).count() == 1
    assert replicates.rejected_replicates(spark, path).count() == 3


def test_uneven_rows_of_a_response(spark):
    docs = spark.createDataFrame([("a", '[["x","y"],["1","2"],["1","2","3"],["1"]]'), ("b", "{}"), ("c", "[]")], "path string, value string")
    got = [(r["path"], r["position"], r["row"]) for r in rejects.uneven_rows(docs).collect()]
    assert got == [("a", 1, ["1", "2", "3"]), ("a", 2, ["1"])]


# --- a keyed table under a stream ----------------------------------------------------------------


def keyed_rows(spark, rows, when):
    df = spark.createDataFrame(rows, "id string, v string, position int")
    return df.withColumn("path", F.lit("f")).withColumn("landed_at", F.lit(when).cast("timestamp"))


def content_of(keyed):
    return sorted((r["id"], r["v"]) for r in keyed.read().collect())


def test_a_crash_between_two_writes_loses_and_doubles_nothing(spark, monkeypatch):
    keyed = KeyedTable(spark, scratch_path(spark, "keyed"), ("id", "v"), ("id",), buckets=4)
    first = keyed_rows(spark, [(str(i), "a", i) for i in range(50)], "2024-01-01")
    second = keyed_rows(spark, [(str(i), "b", i) for i in range(40, 60)] + [("40", "c", 99), (None, "n", 1)], "2024-01-02")
    assert content_of(keyed) == [] and keyed.merge(first, 0)
    before = content_of(keyed)
    assert before == sorted((str(i), "a") for i in range(50))

    def crash(self, manifest):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(KeyedTable, "_commit", crash)
        with pytest.raises(RuntimeError):
            keyed.merge(second, 1)
    assert content_of(keyed) == before  # written, but not in the manifest
    assert keyed.merge(second, 1) and not keyed.merge(second, 1)  # a rerun, and one after the commit
    rows = keyed.read().collect()
    want = {str(i): "a" for i in range(40)} | {str(i): "b" for i in range(40, 60)} | {"40": "c", None: "n"}
    assert len(rows) == len(want) and {r["id"]: r["v"] for r in rows} == want
    assert keyed.merge(keyed_rows(spark, [("40", "old", 0)], "2023-01-01"), 0, "other")
    assert {r["id"]: r["v"] for r in keyed.read().collect()} == want  # landed earlier


def test_a_keyed_table_is_read_without_a_shuffle(spark):
    keyed = KeyedTable(spark, scratch_path(spark, "keyed"), ("id", "v"), ("id",), buckets=8)
    keyed.merge(keyed_rows(spark, [(str(i), "a", i) for i in range(100)], "2024-01-01"), 0)
    plan = keyed.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert keyed.read().count() == 100


def test_responses_into_a_keyed_table(spark):
    doc = lambda *rows: json.dumps([["id", "v"], *rows])
    landing = write(spark, "landing", doc(["1", "a"], ["2", "b"]))
    keyed = KeyedTable(spark, scratch_path(spark, "keyed"), ("id", "v"), ("id",), buckets=4)
    state, bad = scratch_path(spark, "state"), scratch_path(spark, "bad")
    load_keyed(landing, keyed, state, bad).awaitTermination()
    more = [(doc(["2", "new"], ["3", "c"]),), ('{"error": 1}',)]
    spark.createDataFrame(more, "value string").repartition(2).write.mode("append").text(landing)
    for _ in range(2):
        load_keyed(landing, keyed, state, bad).awaitTermination()
    assert content_of(keyed) == [("1", "a"), ("2", "new"), ("3", "c")]
    assert [r["value"].strip() for r in spark.read.parquet(bad).collect()] == ['{"error": 1}']
    with pytest.raises(Exception, match="no response table"):
        load_keyed(write(spark, "landing", "<html>"), keyed, scratch_path(spark, "s"), stream="b").awaitTermination()


# --- layers by position -------------------------------------------------------------------------


def test_a_box_query_skips_row_groups(spark):
    """Of a thousand row groups a small box meets a few, by their statistics."""
    import glob

    import pyarrow.parquet as pq

    ids_ = spark.range(40_000).select(
        F.col("id"), (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100).alias("x"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000)) / 100).alias("y")
    )
    layer = ids_.select("id", F.array(shapes.box_rings(F.col("x"), F.col("y"), F.col("x") + 1, F.col("y") + 1)).alias("rings"))
    path = scratch_path(spark, "layer")
    landed.write_layer(layer, path, files=1000)
    box = (200.0, 300.0, 260.0, 340.0)
    groups = met = 0
    for file in glob.glob(path + "/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = {}
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                if column.path_in_schema in ("xmin", "ymin", "xmax", "ymax"):
                    stats[column.path_in_schema] = (column.statistics.min, column.statistics.max)
            groups += 1
            met += stats["xmin"][0] <= box[2] and stats["xmax"][1] >= box[0] and stats["ymin"][0] <= box[3] and stats["ymax"][1] >= box[1]
    assert groups >= 900 and met < 0.05 * groups
    found = spatial.areas_in_box(spark.read.parquet(path), box)
    assert "LessThanOrEqual(xmin" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == spatial.areas_in_box(layer, box).count() > 50


def test_layers_without_shapes_are_landed(spark):
    empty = spark.createDataFrame([], "id int, rings array<array<struct<x:double,y:double>>>")
    path = scratch_path(spark, "layer")
    landed.write_layer(empty, path)
    assert spark.read.schema("id int").parquet(path).count() == 0


def test_curve_key_keeps_neighbours_together(spark):
    df = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    keyed = df.select("x", "y", landed.curve_key(F.col("x"), F.col("y"), (0, 0, 7, 7), bits=3).alias("k")).collect()
    assert sorted(r["k"] for r in keyed) == list(range(64))
    for r in keyed:
        want = sum(((int(r["x"]) >> b) & 1) << (2 * b) | ((int(r["y"]) >> b) & 1) << (2 * b + 1) for b in range(3))
        assert r["k"] == want


def test_replicate_files_are_written_from_one_scan(spark, monkeypatch):
    from workload import landing

    written = []
    monkeypatch.setattr(landing.replicates, "write_replicates", lambda df, path: written.append(df))
    landing.land_replicates(spark, "/root/testdata/sf0.001")
    plan = written[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    rows = written[0].groupBy("geoid", "state").count().collect()
    of_one = {(r["geoid"], r["state"]): r["count"] for r in rows if r["geoid"] in (None, "1")}
    assert of_one[None, "01"] == of_one["1", "01"] > 0 and len(of_one) == 2


def test_weights_of_a_class_are_those_of_the_formula(spark):
    from workload.tables import weighted_replicates

    classes = spark.range(-96, 97).selectExpr("cast(id AS int) AS class").unionByName(spark.sql("SELECT cast(null AS int) AS class"))
    formula = "transform(sequence(1, 80), r -> est * (1.5D - ((class + r * 7) % 97) % 2))"
    both = classes.withColumn("est", F.lit(3.25)).selectExpr(f"{weighted_replicates()} AS a", f"{formula} AS b")
    assert both.count() == 194 and both.where("NOT a <=> b").isEmpty()
