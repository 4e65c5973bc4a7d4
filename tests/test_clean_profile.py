"""Hand-made trap frames for cleaning and profiling operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkprep.operators import clean as C
from sparkprep.operators import profile as P

LEADS = [
    # id, source, origin, activity, visits, time, flag, converted
    (1, "google", "Landing Page", "Email Opened", 3, 100.0, "Select", 1),
    (2, "Google", "Lead Import", "SMS Sent", None, 50.0, "No", 0),
    (3, "bing", "Quick Add Form", "Email Opened", 5, None, "No", 1),
    (4, None, "Landing Page", "Rare Thing", 2, 10.0, "Select", 0),
    (5, "Organic Search", "API", None, 7, 20.0, "Yes", 0),
    (5, "Organic Search", "API", None, 7, 20.0, "Yes", 0),
    (6, "Direct", "API", "Email Opened", 1, 30.0, "No", 1),
]
SCHEMA = "id long, source string, origin string, activity string, visits long, time double, flag string, converted long"


@pytest.fixture()
def leads(spark):
    return spark.createDataFrame(LEADS, SCHEMA)


def test_placeholder_only_strings(leads):
    out = C.placeholders_to_null(leads)
    assert out.filter(F.col("flag").isNull()).count() == 2
    assert dict(out.dtypes)["visits"] == "bigint"


def test_simultaneous_vs_sequential_map(spark):
    m = {"google": "Google", "bing": "Search Engine", "Google": "Search Engine"}
    df = spark.createDataFrame([("google",), ("Google",), ("bing",), ("x",), (None,)], "s string")
    sim = [r.s for r in C.map_values(df, "s", m, default="Other").collect()]
    seq = [r.s for r in C.map_values(df, "s", m, default="Other", sequential=True).collect()]
    assert sim == ["Google", "Search Engine", "Search Engine", "x", "Other"]
    assert seq == ["Search Engine", "Search Engine", "Search Engine", "x", "Other"]


def test_dedupe_and_flags(leads):
    assert C.drop_duplicates(leads).count() == 6
    flags = {r.duplicated: r["count"] for r in C.duplicate_flags(leads).collect()}
    assert flags == {False: 6, True: 1}


def test_rare_levels_exclude_null(leads):
    rare = {r.level for r in C.rare_levels(leads, "activity", 2).collect()}
    assert rare == {"SMS Sent", "Rare Thing"}
    grouped = C.group_rare(leads, "activity", C.rare_levels(leads, "activity", 2))
    assert grouped.filter(F.col("activity") == "Others").count() == 2
    assert grouped.filter(F.col("activity").isNull()).count() == 2


def test_median_fill_and_all_null(spark, leads):
    out = C.impute_median(leads, ["visits", "time"])
    vals = sorted(r.visits for r in out.collect())
    assert None not in vals
    empty = spark.createDataFrame([(None,), (None,)], "x double")
    assert C.medians(empty, ["x"]) == {"x": None}
    assert C.impute_median(empty, ["x"]).count() == 2


def test_mode_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    assert C.mode_value(df, "s") == "a"


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, "x", None, "a"), (2, "x", "y", "b"), (3, "x", None, "a")], "k int, c string, n string, m string")
    assert C.constant_columns(df) == ["c", "n"]


def test_sanitize_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`Lead Source` int, `lead_source` int")
    with pytest.raises(ValueError):
        C.sanitize_columns(df)


def test_guards(spark):
    with pytest.raises(ValueError):
        C.require_non_empty(spark.createDataFrame([], "x int"))
    with pytest.raises(ValueError):
        C.require_columns(spark.createDataFrame([(1,)], "x int"), ["y"])


def test_histogram_top_edge(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 10]], "v double")
    h = {r.bin: r["count"] for r in P.histogram(df, "v", 5).collect()}
    assert h == {0: 2, 1: 2, 2: 0, 3: 0, 4: 1}


def test_kde_matches_numpy(spark):
    xs = np.array([1.0, 2.0, 2.5, 4.0, 7.0, 7.5, 8.0])
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    rows = P.kde(df, "v", grid_points=20).orderBy("point").collect()
    h = xs.std(ddof=1) * len(xs) ** (-1 / 5)
    for r in rows:
        ref = np.exp(-0.5 * ((r.x - xs) / h) ** 2).sum() / (len(xs) * h * math.sqrt(2 * math.pi))
        assert abs(r.density - ref) < 1e-9


def test_auto_bins_rule(spark):
    xs = np.arange(1000, dtype=float) ** 1.5
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    n = len(xs)
    q1, q3 = np.percentile(xs, [25, 75])
    width = min((xs.max() - xs.min()) / (math.log2(n) + 1), 2 * (q3 - q1) * n ** (-1 / 3))
    assert P.auto_bin_count(df, "v") == int(math.ceil((xs.max() - xs.min()) / width))


def test_group_contrast_requires_two_groups(spark, leads):
    with pytest.raises(ValueError):
        P.group_contrast(leads.withColumn("g", F.col("id") % 3), "g", ["time"])
    out = {r.column_name: r for r in P.group_contrast(leads, "converted", ["time"]).collect()}
    assert out["time"].group_0 == "0"


def test_contrast_zero_mean_gives_null(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 5.0)], "g int, x double")
    r = P.group_contrast(df, "g", ["x"]).first()
    assert r.pct_diff is None


def test_categorical_profile(leads):
    rows = {r.column_name: r for r in P.categorical_profile(C.placeholders_to_null(leads), ["flag", "activity"]).collect()}
    assert rows["flag"].null_values == 2 and rows["flag"].unique_values == 2
    assert rows["activity"].null_percent == round(200 / 7, 1)


def test_box_stats_matches_numpy(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    b = P.box_stats(df, ["v"]).first()
    q1, q3 = np.percentile(xs, [25, 75])
    assert b.q1 == q1 and b.q3 == q3 and b.outliers == 1 and b.whisker_high == 5.0
