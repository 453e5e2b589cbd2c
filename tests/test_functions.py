"""Column functions: golden rows and edge cases."""

from pyspark.sql import functions as F

from clickmodel.functions import (clean_event_name, encode_url, hash_key, param_value, params_map,
                                  parse_yyyymmdd, remove_query_params, session_engaged, strip_query, url_part)
from clickmodel.schema import PARAMS

# Golden rows of the declared query-parameter-removal unit tests.
LOCATIONS = [
    ("https://asite.com/page?parameter=this_param", "https://asite.com/page"),
    ("https://asite.com/anotherpage?parameter=param%20with%20encoded%20spaces", "https://asite.com/anotherpage"),
    ("https://anothersite.com/page?not_excluded_param=val&parameter=someval&param=also_not_excluded",
     "https://anothersite.com/page?not_excluded_param=val&param=also_not_excluded"),
    ("https://twoparams.com/page&parameter=someval&second_param=1value", "https://twoparams.com/page"),
]
REFERRERS = [
    ("https://asite.com/previous_page?parameter=previous_value", "https://asite.com/previous_page"),
    ("https://asite.com/previous_page?utm_source=source_value",
     "https://asite.com/previous_page?utm_source=source_value"),
    ("https://anothersite.com/previous_page#utm_source=source_value#parameter=previous_value#hash=hash_value",
     "https://anothersite.com/previous_page#utm_source=source_value#hash=hash_value"),
    ("https://twoparams.com/previous_page?second_param=a_value#parameter=previous_value#hash=hash_value",
     "https://twoparams.com/previous_page#hash=hash_value"),
]


def _one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("out")).first()["out"]


def test_query_param_removal_golden(spark):
    rows = LOCATIONS + REFERRERS + [("https://x.com/p?parameter=1&keep=2#f", "https://x.com/p?keep=2#f"),
                                    ("https://x.com/p?parameter=1&second_param=2&keep=3", "https://x.com/p?keep=3")]
    df = spark.createDataFrame(rows, "u string, expected string")
    out = df.select("expected", remove_query_params("u", ["parameter", "second_param"]).alias("got")).collect()
    assert [r.got for r in out] == [r.expected for r in out]


def test_query_param_remove_all(spark):
    df = spark.createDataFrame([LOCATIONS[0][:1], LOCATIONS[1][:1], REFERRERS[0][:1], REFERRERS[1][:1]], "u string")
    got = [r.o for r in df.select(remove_query_params("u", ["*all*"]).alias("o")).collect()]
    assert got == ["https://asite.com/page", "https://asite.com/anotherpage", "https://asite.com/previous_page",
                   "https://asite.com/previous_page"]


def test_strip_query_keeps_fragment_only_urls(spark):
    df = spark.createDataFrame([("https://a.com/p#frag",), ("https://a.com/p?x=1#f",), (None,)], "u string")
    assert [r.o for r in df.select(strip_query("u").alias("o")).collect()] == ["https://a.com/p#frag",
                                                                             "https://a.com/p", None]


def test_url_parts_and_invalid(spark):
    df = spark.createDataFrame([("https://a.example.com/x/y?q=1#f",), ("https://a.com/my page",), (None,)], "u string")
    r = df.select(url_part("u", "HOST").alias("h"), url_part("u", "PATH").alias("p"),
                  url_part("u", "QUERY").alias("q")).collect()
    assert tuple(r[0]) == ("a.example.com", "/x/y", "q=1")
    assert tuple(r[1]) == (None, None, None)   # a space is not a valid URI: NULL, not a failure
    assert tuple(r[2]) == (None, None, None)


def test_encode_url_form_encoding(spark):
    assert _one(spark, encode_url("v"), "https://a.com/a b?x=1") == "https%3A%2F%2Fa.com%2Fa+b%3Fx%3D1"


def test_clean_event_name(spark):
    assert _one(spark, clean_event_name("v"), " Page View ") == "page_view"


def test_parse_date_bad_is_null(spark):
    df = spark.createDataFrame([("20240105",), ("20241345",), ("bad",), (None,)], "v string")
    got = [r.o for r in df.select(parse_yyyymmdd("v").cast("string").alias("o")).collect()]
    assert got == ["2024-01-05", None, None, None]


def test_hash_key_contract(spark):
    df = spark.createDataFrame([(None, None), ("ab", "c"), ("a", "bc")], "a string, b string")
    got = [r.k for r in df.select(hash_key("a", "b").alias("k")).collect()]
    assert got[0] == "1B2M2Y8AsgTpgAmY7PhCfg=="  # all parts NULL -> key of the empty string
    assert got[1] == got[2] and len(got[1]) == 24  # no separator: ab|c == a|bc


def _params_df(spark):
    rows = [
        ([("page_title", ("first", None)), ("page_title", ("second", None)), ("session_engaged", (None, 1))],),
        ([("session_engaged", ("1", None))],),
        ([("session_engaged", ("0", None))],),
        ([],),
        (None,),
    ]
    return spark.createDataFrame(rows, f"event_params {PARAMS.simpleString()}")


def test_param_value_first_wins_and_missing(spark):
    df = _params_df(spark)
    got = [r.t for r in df.select(param_value("event_params", "page_title").alias("t")).collect()]
    assert got == ["first", None, None, None, None]


def test_session_engaged(spark):
    got = [r.s for r in _params_df(spark).select(session_engaged().alias("s")).collect()]
    assert got == [1, 1, None, None, None]


def test_params_map_first_and_error(spark):
    df = _params_df(spark)
    r = df.select(params_map("event_params")["page_title"]["string_value"].alias("t")).first()
    assert r.t == "first"
    import pytest
    with pytest.raises(Exception):
        df.select(F.size(params_map("event_params", on_duplicate="error"))).collect()
