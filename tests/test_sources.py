"""JSON inference, missing values, frames, ranges, vector text."""

import math

import pytest
from pyspark.sql import types as T

from tarnwork.functions import legacy
from tarnwork.session import fresh_dir
from tarnwork.sources import frames, json, ranges, text


def infer(spark, *lines):
    df = spark.createDataFrame([(line,) for line in lines], "j string")
    return {f.name: f.dataType.simpleString() for f in json.infer_schema(df, "j")}


def test_json_type_conflicts(spark):
    got = infer(
        spark,
        '{"num_num":11, "num_bool":true, "num_str":13.1, "str_bool":"str1", "only_null":null}',
        '{"num_num":1.5, "num_bool":12, "num_str":"str1", "str_bool":true}',
    )
    assert got == {"num_bool": "string", "num_num": "double", "num_str": "string", "only_null": "string", "str_bool": "string"}
    assert list(got) == sorted(got)


def test_json_nested_conflicts_and_missing_fields(spark):
    got = infer(spark, '{"a":1,"s":{"x":1}}', '{"b":[1,2],"s":{"y":"t"}}', '{"a":{"z":1}}')
    assert got == {"a": "string", "b": "array<bigint>", "s": "struct<x:bigint,y:string>"}


def test_json_line_breaks_inside_a_document(spark):
    assert infer(spark, '{"a":\n 1}') == {"a": "bigint"}


def test_missing_value_tokens(spark):
    path = fresh_dir(spark, "na")
    spark.createDataFrame([("a,b,c",), ("1, 2.5,yes",), ("NA,N/A,no",), (" na ,,maybe",), ("1.5,x,TRUE",)], "v string").coalesce(1).write.text(path)
    df = text.read_csv_with_na(spark, path, T.StructType.fromDDL("a int, b double, c boolean"))
    assert [tuple(r) for r in df.collect()] == [(1, 2.5, True), (None, None, False), (None, None, None), (None, None, True)]


def test_frame_round_trip_and_errors(spark):
    df = spark.createDataFrame([(1, 2.0, True, "x"), (None, None, None, None)], "i int, d double, b boolean, s string")
    frame = frames.rows_to_frame(df).collect()
    assert (frame[0].i, frame[0].d, frame[0].b) == (1.0, 2.0, 1.0) and math.isnan(frame[0].s)
    assert all(math.isnan(x) for x in frame[1])
    back = frames.frame_to_rows(frames.rows_to_frame(df), T.StructType.fromDDL("i int, b boolean")).collect()
    assert [tuple(r) for r in back] == [(1, True), (None, None)]
    with pytest.raises(TypeError):
        frames.table_to_frame(df)
    with pytest.raises(ValueError):
        frames.frame_to_rows(frames.rows_to_frame(df), T.StructType.fromDDL("other int"))


@pytest.mark.parametrize("lo,hi,n", [(1, 100, 3), (0, 0, 1), (5, 7, 5), (-10, 10, 4), (567279357766147899, 567279357766147999, 20)])
def test_ranges_cover_exactly(lo, hi, n):
    pieces = [p for p in ranges.split_range(lo, hi, n) if p[0] <= p[1]]
    assert [x for a, b in pieces for x in range(a, b + 1)] == list(range(lo, hi + 1))


def test_labelled_vector_text(spark):
    df = spark.createDataFrame([("(1.0,[0.5,-2.0])",), ("0,1.5 3",)], "v string")
    got = text.parse_labelled(df, "v").select("label", "features").collect()
    assert [tuple(r) for r in got] == [(1.0, [0.5, -2.0]), (0.0, [1.5, 3.0])]


def test_edge_list_skips_comments(spark):
    path = fresh_dir(spark, "edges")
    spark.createDataFrame([("# c",), ("2 1",), ("",), ("1\t3",)], "v string").coalesce(1).write.text(path)
    assert sorted(map(tuple, text.read_edge_list(spark, path).collect())) == [(1, 3), (2, 1)]
    assert sorted(map(tuple, text.read_edge_list(spark, path, canonical=True).collect())) == [(1, 2), (1, 3)]


def test_text_hash_matches_rolling_hash(spark):
    words = ["", "a", "hello world", "grün", "x" * 60]

    def rolling(s):
        h = 0
        for b in s.encode():
            h = (h * 31 + (b - 256 if b > 127 else b)) & 0xFFFFFFFF
        return h - (1 << 32) if h >= 1 << 31 else h

    from pyspark.sql import functions as F
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", legacy.text_hash(F.col("w")).alias("h"))
    assert {r.w: r.h for r in df.collect()} == {w: rolling(w) for w in words}


def test_ngrams_stay_inside_sentences(spark):
    df = spark.createDataFrame([("a b c\nd e",), ("a b",)], "t string")
    got = legacy.ngrams(df, legacy.line_sentences("t"), 2, 10).collect()
    assert [tuple(r) for r in got] == [("a b", 2), ("b c", 1), ("d e", 1)]
    ctx = legacy.context_ngrams(df, legacy.line_sentences("t"), ["a", None], 5).collect()
    assert [tuple(r) for r in ctx] == [("b", 2)]
