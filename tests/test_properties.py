"""Property checks against brute force on random inputs."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe_by_key
from strata.operators.ranking import rank_within_groups

rows_strategy = st.lists(
    st.tuples(
        st.one_of(st.none(), st.sampled_from(["a", "b", "hot", "hot", "hot", "hot"])),
        st.one_of(st.none(), st.integers(-3, 3)),
    ),
    min_size=1,
    max_size=120,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, parts=st.integers(1, 7))
def test_rank_within_groups_equals_row_number(spark, rows, parts):
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(rows)], "g string, v int, id int")
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    got = rank_within_groups(df, ["g"], order, "rn", num_partitions=parts)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_dedupe_keeps_smallest_row(spark, rows):
    df = spark.createDataFrame([(g, v, str(v)) for g, v in rows], "g string, v int, s string")
    got = {r.g: (r.v, r.s) for r in dedupe_by_key(df, ["g"]).collect()}
    want = {}
    for g, v in rows:
        cand = (v, str(v))
        key = (cand[0] is not None, cand[0] if cand[0] is not None else 0, cand[1])  # NULL first
        if g not in want or key < want[g][0]:
            want[g] = (key, cand)
    assert got == {g: c for g, (_, c) in want.items()}


# ---- text parsing against plain-Python statements of the same rules ----------
import re as _re  # noqa: E402

from strata.functions.columns import clean_attribute_key, to_int  # noqa: E402
from strata.operators.generators import explode_list, explode_time_ranges  # noqa: E402

_SPACE = [" ", "  ", ""]
category_item = st.builds(lambda left, name, right: f"{left}{name}{right}",
                          st.sampled_from(_SPACE), st.sampled_from(["Food", "Bars", "", " ", "Cafe Bar", "x"]),
                          st.sampled_from(_SPACE))
category_lists = st.lists(category_item, min_size=1, max_size=6).map(",".join)


def py_categories(text):
    return [p.strip(" ") for p in _re.split(r",\s*", text) if p.strip(" ")]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(category_lists, min_size=1, max_size=20))
def test_explode_list_matches_python(spark, texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, categories string")
    got = sorted((r.id, r.category) for r in explode_list(df, "id", "categories", "category").collect())
    want = sorted((str(i), c) for i, t in enumerate(texts) for c in py_categories(t))
    assert got == want


time_piece = st.one_of(
    st.builds(lambda h, m: f"{h}:{m}", st.integers(0, 99), st.integers(0, 99)),
    st.sampled_from(["closed", "", "8", "x:1", "123:4"]),
)
ranges = st.one_of(st.builds(lambda a, b: f"{a}-{b}", time_piece, time_piece), time_piece)


def py_hours(rng):
    pieces = rng.split("-")
    out = []
    for piece in (pieces[0], pieces[1] if len(pieces) > 1 else None):
        if piece is None:
            out += [None, None]
            continue
        h = _re.match(r"^(\d{1,2})", piece)
        m = _re.match(r"^\d{1,2}:(\d{1,2})", piece)
        out += [int(h.group(1)) if h else None, int(m.group(1)) if m else None]
    oh, om, ch, cm = out
    mins = lambda a, b: a * 60 + b if a is not None and b is not None else None
    return (oh, om, ch, cm, mins(oh, om), mins(ch, cm))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(ranges, min_size=1, max_size=20))
def test_hours_match_python(spark, values):
    import json

    rows = [(str(i), json.dumps({"Monday": v})) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "business_id string, hours string")
    got = {r.business_id: (r.open_hour, r.open_minute, r.close_hour, r.close_minute, r.open_minutes,
                           r.close_minutes) for r in explode_time_ranges(df).collect()}
    assert got == {str(i): py_hours(v) for i, v in enumerate(values)}


keys = st.builds(lambda pre, body, post: pre + body + post,
                 st.sampled_from(["", "u'", "'", '"', 'u"', "u"]),
                 st.sampled_from(["Key", "menu\"x", "it's", "", "u"]),
                 st.sampled_from(["", "'", '"']))


def py_clean(key):
    return _re.sub(r"^u?['\"]|['\"]$", "", key)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(keys, min_size=1, max_size=30))
def test_key_cleanup_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "k string")
    got = [r.c for r in df.select(clean_attribute_key("k").alias("c")).collect()]
    assert got == [py_clean(v) for v in values]


numbers = st.one_of(
    st.integers(-2**40, 2**40).map(str),
    st.floats(-1e6, 1e6, allow_nan=False).map(lambda f: repr(float(int(f)))),
    st.sampled_from(["", "zz", "1e3", "3000000000", "-2147483648", "2147483647", " 7 "]),
)


def py_to_int(text):
    try:
        v = float(text)
    except ValueError:
        return None
    v = int(v)
    return v if -2**31 <= v < 2**31 else None


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(numbers, min_size=1, max_size=30))
def test_to_int_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.i for r in df.select(to_int("s").alias("i")).collect()]
    assert got == [py_to_int(v) for v in values]


# ---- fuzz: any JSON value in any raw field must land without an error ----------
json_scalar = st.one_of(
    st.none(), st.booleans(), st.integers(-2**63, 2**63 - 1), st.floats(allow_nan=False, allow_infinity=False),
    st.text(max_size=12), st.sampled_from(["5.0", "1e400", "-0", "2020-13-45", "2020-02-29 25:61:61", "8:0-22:30",
                                           "closed", "u'x'", "{}", "[]", "NaN"]),
)
json_value = st.recursive(json_scalar, lambda inner: st.one_of(
    st.lists(inner, max_size=3), st.dictionaries(st.text(max_size=6), inner, max_size=3)), max_leaves=6)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(business=st.lists(st.fixed_dictionaries({}, optional={k: json_value for k in [
    "business_id", "name", "city", "latitude", "stars", "review_count", "is_open", "attributes", "categories",
    "hours", "postal_code"]}), min_size=1, max_size=15),
       reviews=st.lists(st.fixed_dictionaries({}, optional={k: json_value for k in [
           "review_id", "business_id", "stars", "useful", "date", "text"]}), min_size=1, max_size=15))
def test_landing_and_split_never_fail(spark, tmp_path_factory, business, reviews):
    import json

    from strata.plans import core as C
    from strata.plans.landing import landing_from_ndjson

    d = tmp_path_factory.mktemp("fuzz")
    (d / "b").mkdir()
    (d / "r").mkdir()
    (d / "b" / "x.json").write_text("\n".join(json.dumps(b) for b in business) + "\n")
    (d / "r" / "x.json").write_text("\n".join(json.dumps(r) for r in reviews) + "\n")
    land = landing_from_ndjson(spark, "business", str(d / "b"))
    assert land.count() == len(business)  # every line is a JSON object, so none is quarantined
    for df in (C.business_core(land), C.business_category(land), C.business_attributes(land),
               C.business_hours(land)):
        df.collect()
    fact = C.review_fact(landing_from_ndjson(spark, "review", str(d / "r")))
    assert fact.count() == len(reviews)
    fact.collect()


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(business=st.lists(st.fixed_dictionaries({}, optional={k: json_value for k in [
    "business_id", "name", "city", "stars", "review_count", "attributes", "categories"]}), min_size=1, max_size=12),
       reviews=st.lists(st.fixed_dictionaries({}, optional={k: json_value for k in [
           "review_id", "business_id", "stars", "date"]}), min_size=1, max_size=12))
def test_marts_never_fail(spark, tmp_path_factory, business, reviews):
    import json

    from strata.plans import core as C
    from strata.plans import marts as Mt
    from strata.plans.landing import landing_from_ndjson

    d = tmp_path_factory.mktemp("fuzzm")
    (d / "b").mkdir()
    (d / "r").mkdir()
    (d / "b" / "x.json").write_text("\n".join(json.dumps(b) for b in business) + "\n")
    (d / "r" / "x.json").write_text("\n".join(json.dumps(r) for r in reviews) + "\n")
    land = landing_from_ndjson(spark, "business", str(d / "b"))
    core, cats, attrs = C.business_core(land), C.business_category(land), C.business_attributes(land)
    fact = C.review_fact(landing_from_ndjson(spark, "review", str(d / "r")))
    for df in (Mt.mart_city_category_rating(core, cats), Mt.mart_best_city_avg_rate(core),
               Mt.mart_top_businesses_per_category(core, cats), Mt.top_businesses_per_category(core, cats),
               Mt.mart_category_creditcard_share(cats, attrs), Mt.mart_business_quality_monthly(fact)):
        df.collect()
    assert Mt.mart_review_fact_enriched(fact, core).count() == len(reviews)
