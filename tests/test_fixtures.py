"""Small profiles of our own with hand-worked outputs, plus edge rows (FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from seedwise.operators import encode
from seedwise.plans import jobs
from seedwise.sources.tables import profile_scan


def _readers(spark):
    """Wrapped lists with one to three tokens, repeated ints, one missing code."""
    rows = [(11, 2, "tram", 40, ",red,blue,", ",n,", 5),
            (12, 9, "bike", 15, ",blue,", ",n,s,w,", None),
            (13, 9, "walk", 40, None, ",w,s,", 5),
            (14, 4, "bike", 22, ",green,red,", None, 8),
            (15, 9, "tram", 15, ",red,red,", ",e,", 8)]
    df = spark.createDataFrame(rows, "uid int, phase int, travel string, minutes int, "
                                     "colours string, winds string, code int")
    return profile_scan(df, ["travel", "minutes", "colours", "winds"], id_col="uid",
                        cycle_col="phase", reader_col="code")


def test_categorical_fixture(spark):
    out, enc = jobs.categorical_job(_readers(spark), ["travel", "minutes"], ["colours", "winds"])
    got = {r["user_id"]: r["feature"] for r in out.collect()}
    # colours blue 0, green 1, red 2; winds e 0, n 1, s 2, w 3;
    # travel bike 0, tram 1, walk 2; minutes 15 0, 22 1, 40 2
    assert got == {
        11: "2:1,2:0,2:1,2:0,2:1,2:0,2:0,3:1,3:2",
        12: "2:1,2:0,2:0,2:0,2:1,2:1,2:1,3:0,3:0",
        13: "2:0,2:0,2:0,2:0,2:0,2:1,2:1,3:2,3:2",
        14: "2:0,2:1,2:1,2:0,2:0,2:0,2:0,3:0,3:1",
        15: "2:0,2:0,2:1,2:1,2:0,2:0,2:0,3:1,3:0",
    }
    assert enc.arity == [3, 3, 3, 4] and enc.width == 13
    assert dict(out.dtypes) == {"user_id": "bigint", "feature": "string",
                                "cycle": "string", "reader": "string"}
    readers = {r["user_id"]: r["reader"] for r in out.collect()}
    assert readers[12] is None and readers[14] == "8"


def test_onehot_fixture(spark):
    out, enc = jobs.onehot_job(_readers(spark), ["travel", "minutes"])
    got = {r["user_id"]: (r["feature_size"], r["feature"]) for r in out.collect()}
    assert got == {11: (6, "1,5"), 12: (6, "0,3"), 13: (6, "2,5"), 14: (6, "0,4"), 15: (6, "1,3")}
    assert [f.multi for f in enc.layout] == [True, False]
    assert dict(out.dtypes)["feature_size"] == "int"


@pytest.mark.parametrize("inline", [True, False])
def test_one_output_row_per_input_row(spark, inline):
    rows = [(1, ",a,", 5, "p"), (1, ",b,", 6, "q"), (1, ",a,", 5, "p"), (None, ",a,b,", None, "r")]
    df = spark.createDataFrame(rows, "user_id long, t string, n int, note string")
    layout = encode.onehot_layout(df, ["t", "n"])
    enc = encode.fit_encoding(df, layout)
    got = sorted((r["feature"], r["note"]) for r in
                 encode.onehot_features(df, enc, keep=("note",), inline=inline).collect())
    assert got == [("0,1,4", "r"), ("0,2", "p"), ("0,2", "p"), ("1,3", "q")]
    layout2 = encode.categorical_layout(df, ["n"], ["t"])
    enc2 = encode.fit_encoding(df, layout2)
    got2 = sorted((r["feature"], r["note"]) for r in
                  encode.categorical_features(df, enc2, keep=("note",), inline=inline).collect())
    assert got2 == [("2:0,2:1,3:1", "q"), ("2:1,2:0,3:0", "p"), ("2:1,2:0,3:0", "p"),
                    ("2:1,2:1,3:2", "r")]
    assert sorted(r["idx"] for r in encode.multi_index(df, enc, "t").collect()) == [
        [0], [0], [0, 1], [1]]
    assert encode.onehot_index(df, enc).count() == 8


def test_decimals_in_order_and_times_of_one_text(spark):
    big = spark.createDataFrame([(1, "9999999999999999999.9"), (2, "10000000000000000000.1"),
                                 (3, "-2.5"), (4, "-10.0"), (5, None)], "user_id long, s string") \
        .select("user_id", F.col("s").cast("decimal(30,1)").alias("d"))
    enc = encode.fit_encoding(big, encode.onehot_layout(big, ["d"]))
    order = {r["val"]: r["idx"] for r in enc.dictionary.collect()}
    assert order == {"-10.0": 0, "-2.5": 1, "9999999999999999999.9": 2,
                     "10000000000000000000.1": 3, None: 4}
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:                               # 02:30 local time exists twice on this day
        t = spark.range(2).select("id", F.timestamp_seconds(
            F.lit(1698539400) - 3600 + F.col("id") * 3600).alias("at")).withColumnRenamed("id", "user_id")
        out, enc = encode.index_single(t, "at", ["user_id"])
        assert sorted((r["user_id"], r["idx"]) for r in out.collect()) == [(0, 0), (1, 1)]
        oh = encode.onehot_features(t, encode.fit_encoding(t, encode.onehot_layout(t, ["at"])), keep=())
        assert sorted(r["feature"] for r in oh.collect()) == ["0", "1"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_dictionary_order_native_and_null_last(spark):
    df = spark.createDataFrame([(1, 10), (2, 9), (3, None), (4, 100), (5, 9)],
                               "user_id long, n int")
    enc = encode.fit_encoding(df, encode.onehot_layout(df, ["n"]))
    d = {r["val"]: r["idx"] for r in enc.dictionary.collect()}
    assert d == {"9": 0, "10": 1, "100": 2, None: 3}     # 10 after 9, NULL last


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, ",,", None), (4, ",a,a,", "y"), (5, ",b,a,", "x")]
    df = spark.createDataFrame(rows, "user_id long, tags string, kind string")
    out, enc = jobs.categorical_job(df.withColumn("cycle", F.lit(None).cast("string"))
                                      .withColumn("reader", F.lit("1")),
                                    ["kind"], ["tags"])
    got = {r["user_id"]: r["feature"] for r in out.collect()}
    # tags: a=0, b=1 (arity 2); kind: x=0, y=1, NULL=2 (arity 3, NULL own category)
    assert got == {1: "2:0,2:0,3:0", 2: "2:0,2:0,3:0", 3: "2:0,2:0,3:2",
                   4: "2:1,2:0,3:1", 5: "2:1,2:1,3:0"}
    oh, enc1 = jobs.onehot_job(df.withColumn("cycle", F.lit("7")).withColumn("reader", F.lit("1")),
                               ["tags"])
    got1 = {r["user_id"]: r["feature"] for r in oh.collect()}
    assert got1 == {1: "", 2: "", 3: "", 4: "0", 5: "0,1"}
    assert enc1.width == 2


def test_multi_index_sorted_and_token_order(spark):
    df = spark.createDataFrame([(1, ",c,a,c,"), (2, None)], "user_id long, t string")
    enc = encode.fit_encoding(df, encode.onehot_layout(df, ["t"]))
    got = {r["user_id"]: r["idx"] for r in encode.multi_index(df, enc, "t").collect()}
    assert got == {1: [0, 1], 2: []}
    raw = {r["user_id"]: r["idx"] for r in encode.multi_index(df, enc, "t", sort=False).collect()}
    assert raw == {1: [1, 0, 1], 2: []}


def test_unsupported_single_type_raises_before_a_job(spark):
    df = spark.createDataFrame([(1, [1, 2])], "user_id long, arr array<int>")
    try:
        encode.onehot_layout(df, ["arr"])
    except ValueError as e:
        assert "unsupported" in str(e)
    else:
        raise AssertionError("expected ValueError")


def test_given_dictionary_skip_or_error(spark):
    old = spark.createDataFrame([(1, ",a,", "x"), (2, ",b,", "y")], "user_id long, t string, k string")
    new = spark.createDataFrame([(3, ",a,c,", "z")], "user_id long, t string, k string")
    layout = encode.categorical_layout(old, ["k"], ["t"])
    enc = encode.fit_encoding(old, layout)
    keep = ()
    for inline in (True, False):
        got = encode.categorical_features(new, enc, keep=keep, inline=inline, unseen="skip")
        assert got.first()["feature"] == "2:1,2:0"                      # c and z are skipped
        with pytest.raises(Exception, match="not in the dictionary"):
            encode.categorical_features(new, enc, keep=keep, inline=inline).collect()
    unseen = sorted((r["col_name"], r["value"]) for r in encode.unseen_values(new, enc).collect())
    assert unseen == [("k", "z"), ("t", "c")]
    with pytest.raises(ValueError):
        encode.require_known(new, enc)
    encode.require_known(old, enc)


def test_feature_width_is_checked(spark):
    ok = spark.createDataFrame([(1, 5, "0,3"), (2, 5, "")], "user_id long, feature_size int, feature string")
    assert jobs.feature_width(ok) == 5
    mixed = spark.createDataFrame([(1, 5, "0"), (2, 6, "1")], "user_id long, feature_size int, feature string")
    with pytest.raises(ValueError):
        jobs.feature_width(mixed)
