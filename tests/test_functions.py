"""Column functions and cleaning rules on tiny hand-made frames."""

from pyspark.sql import functions as F

from orrery.functions.columns import (blank_to_null, hash_percent, lenient_cast,
                                      literal_alternation, payload_json, round2, sentinel_flag,
                                      sentinel_to_null)
from orrery.operators.cleaning import exclude_by_pattern, first_row_per_key, max_per_key
from orrery.plans.silver import item_tags, typed_items
from orrery.sources.files import read_text_csv


def test_lenient_cast_and_flag(spark):
    df = spark.createDataFrame([("12",), ("Unknown",), ("x",), ("3",), (None,)], "u string")
    rows = df.select(sentinel_to_null("u", "Unknown", "int").alias("n"),
                     sentinel_flag("u", "Unknown").alias("f"),
                     lenient_cast("u", "int").alias("c")).collect()
    assert [r.n for r in rows] == [12, None, None, 3, None]
    assert [r.f for r in rows] == [False, True, False, False, None]
    assert [r.c for r in rows] == [12, None, None, 3, None]


def test_numeric_sentinel(spark):
    df = spark.createDataFrame([("-1",), ("7",), ("bad",), (None,)], "r string")
    assert [r[0] for r in df.select(sentinel_to_null("r", -1, "int")).collect()] == [
        None, 7, None, None]


def test_csv_null_rules(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b\n,x\n  ,y\n")
    rows = read_text_csv(spark, str(path), ["a", "b"]).collect()
    assert rows[0].a is None
    assert rows[1].a == "  "
    assert spark.createDataFrame([("  ",)], "a string").select(
        blank_to_null("a")).first()[0] is None


def test_tag_split_needs_comma_blank(spark):
    df = spark.createDataFrame([(1, "Action, Comedy,Drama")], "item_id int, tags string")
    assert [r.tag_name for r in item_tags(df).collect()] == ["Action", "Comedy,Drama"]


def test_exclusion_is_substring_and_literal(spark):
    df = spark.createDataFrame([(1, "a, Hentai"), (2, "Hentaiish"), (3, None), (4, "x.y")],
                               "item_id int, tags string")
    kept = exclude_by_pattern(df, "tags", literal_alternation(["Hentai", "."]))
    assert sorted(r.item_id for r in kept.collect()) == [3]
    kept = exclude_by_pattern(df, "tags", literal_alternation(["Hentai"]))
    assert sorted(r.item_id for r in kept.collect()) == [3, 4]


def test_payload_omits_nulls(spark):
    df = spark.createDataFrame([(1, None, 1.5, 'x"y')], "a int, b int, c double, d string")
    assert df.select(payload_json(["a", "b", "c", "d"])).first()[0] == \
        '{"a":1,"c":1.5,"d":"x\\"y"}'


def test_round2_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.345,), (-2.345,), (1.005,)], "x double")
    assert [r[0] for r in df.select(round2("x")).collect()] == [2.35, -2.35, 1.01]


def test_hash_percent_is_stable(spark):
    df = spark.createDataFrame([(1, 2)], "u int, i int")
    assert df.select(hash_percent(F.lit(42), "u", "i")).first()[0] == \
        int("".join(__import__("hashlib").md5(b"42:1:2").hexdigest()[:8]), 16) % 100


def test_first_row_per_key_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, None, "b"), (1, "z", None), (1, "z", "a"), (2, None, None)],
        "k int, x string, y string")
    out = {r.k: (r.x, r.y) for r in first_row_per_key(df, ["k"], ["x", "y"]).collect()}
    assert out == {1: ("z", "a"), 2: (None, None)}


def test_max_per_key_keeps_highest_non_null(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 1, 3), (1, 1, 5), (2, 1, None)],
                               "u int, i int, rating int")
    out = {(r.u, r.i): r.rating for r in max_per_key(df, ["u", "i"], "rating").collect()}
    assert out == {(1, 1): 5, (2, 1): None}


def test_typed_items_rules(spark):
    df = spark.createDataFrame(
        [("01", "  n  ", "   ", " k ", "Unknown", "7.5", "12")],
        "item_id string, name string, tags string, kind string, units string, score string, "
        "members string")
    r = typed_items(df).first()
    assert (r.item_id, r.name, r.tags, r.kind, r.units, r.is_open, r.score, r.members) == \
        (1, "n", None, "k", None, True, 7.5, 12)


def test_exact_token_exclusion(spark):
    from orrery.operators.cleaning import exclude_tokens

    df = spark.createDataFrame([(1, "a, Hentai"), (2, "Hentaiish, b"), (3, None)],
                               "item_id int, tags string")
    kept = exclude_tokens(df, "tags", ", ", ["Hentai"])
    assert sorted(r.item_id for r in kept.collect()) == [2, 3]


def test_jdbc_partition_options():
    from orrery.sources.jdbc import partition_options

    assert partition_options(1, 1000, 64) == {"lowerBound": "1", "upperBound": "1000",
                                              "numPartitions": "64"}
    assert partition_options(5, 7, 64)["numPartitions"] == "3"
    assert partition_options(9, 9, 64)["numPartitions"] == "1"


def test_lenient_cast_cuts_decimal_text(spark):
    texts = ["12.0", "12.7", ".5", ".", "-3.9", "+.", "1e3", " 4.2 ", "", "5.", "2147483648.5",
             "12.x", "1 2.0", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", lenient_cast("t", "int").alias("i"), lenient_cast("t", "bigint").alias("b"))
    got = {r.t: (r.i, r.b) for r in rows.collect()}
    whole = {"12.0": 12, "12.7": 12, ".5": 0, ".": 0, "-3.9": -3, "+.": 0, " 4.2 ": 4, "5.": 5}
    for t in texts:
        assert got[t][0] == whole.get(t), t
    assert got["2147483648.5"] == (None, 2147483648)
