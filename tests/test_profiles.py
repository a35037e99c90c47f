"""Profiles merged over loads against exact values, and distances between spans."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.profiles import described, drift, drifted, merged, profile, read_profiles, store_profile


@pytest.fixture(scope="module")
def loads(spark):
    rng = random.Random(8)
    out = []
    for load in range(6):
        rows = [
            (rng.lognormvariate(load / 5, 1), rng.randrange(5000), rng.choice("aaaabbc") if rng.random() > 0.1 else None, None)
            for _ in range(3000)
        ]
        out.append(spark.createDataFrame(rows, "x double, n int, s string, nothing string").repartition(3))
    return out


def test_merged_profiles_are_within_their_bounds(spark, loads, tmp_path):
    path = str(tmp_path / "p")
    for number, df in enumerate(loads):
        for _ in range(2):  # a repeated load replaces its profile
            store_profile(df, path, number)
    span = [1, 2, 3, 4]
    ranks = [i / 20 for i in range(1, 20)]
    told = {r["column"]: r for r in described(merged(read_profiles(spark, path, span)), ranks, top=3).collect()}
    rows = [r for n in span for r in loads[n].collect()]
    assert all(told[c]["n_rows"] == len(rows) for c in ("x", "n", "s", "nothing"))
    for column in ("x", "n"):
        values = sorted(r[column] for r in rows)
        assert (told[column]["low"], told[column]["high"]) == (values[0], values[-1])
        for rank, value in zip(ranks, told[column]["quantiles"], strict=True):
            low, high = bisect.bisect_left(values, value) / len(values), bisect.bisect_right(values, value) / len(values)
            assert low - 0.01 <= rank <= high + 0.01
        n = len(set(values))
        assert abs(told[column]["n_distinct"] / n - 1) < 0.05
    texts = [r["s"] for r in rows if r["s"] is not None]
    assert told["s"]["n_null"] == len(rows) - len(texts) and told["s"]["n_distinct"] == 3
    assert [(t["item"], t["count"]) for t in told["s"]["top"]] == [(c, texts.count(c)) for c in "abc"]
    assert (told["s"]["low_text"], told["s"]["high_text"], told["s"]["low"]) == ("a", "c", 1)
    nothing = told["nothing"]
    assert (nothing["n_null"], nothing["low"], nothing["quantiles"], nothing["n_distinct"], nothing["top"]) == (len(rows), None, None, 0, [])


def test_distances_between_spans(spark, loads, tmp_path):
    path = str(tmp_path / "p")
    for number, df in enumerate(loads):
        store_profile(df, path, number)
    span = lambda *numbers: merged(read_profiles(spark, path, list(numbers)))
    found = {r["column"]: r for r in drift(span(0, 1), span(4, 5)).collect()}
    a, b = (sorted(r["x"] for n in span_ for r in loads[n].collect()) for span_ in ((0, 1), (4, 5)))
    exact = max(abs(bisect.bisect_right(a, x) / len(a) - bisect.bisect_right(b, x) / len(b)) for x in a + b)
    assert exact > 0.2 and abs(found["x"]["rank_distance"] - exact) < 0.025
    assert found["n"]["rank_distance"] < 0.05 and abs(found["n"]["distinct_ratio"] - 1) < 0.1
    shares = []
    for numbers in ((0, 1), (4, 5)):
        texts = [r["s"] for n in numbers for r in loads[n].collect() if r["s"] is not None]
        shares.append({c: texts.count(c) / len(texts) for c in "abc"})
    assert found["s"]["value_distance"] == pytest.approx(sum(abs(shares[0][c] - shares[1][c]) for c in "abc") / 2)
    assert found["nothing"]["rank_distance"] is None and found["nothing"]["null_share"] == 0
    told = {r["column"]: r["d"] for r in drift(span(0, 1), span(4, 5)).select("column", drifted(value_distance=1.1).alias("d")).collect()}
    assert told == {"x": True, "n": False, "s": False, "nothing": False}


def test_columns_that_come_go_or_change_type(spark, tmp_path):
    path = str(tmp_path / "p")
    store_profile(spark.sql("SELECT 1 a, 'x' b, DATE'2024-01-02' d, true t"), path, 1)
    store_profile(spark.sql("SELECT '1' a, 2.5D c, DATE'2024-01-03' d, false t"), path, 2)
    every = merged(read_profiles(spark, path)).collect()
    assert sorted((r["column"], r["type"], r["n_rows"]) for r in every) == [
        ("a", "int", 1), ("a", "string", 1), ("b", "string", 1), ("c", "double", 1), ("d", "date", 2), ("t", "boolean", 2)
    ]
    assert {r["column"]: r["high"] - r["low"] for r in every if r["n_rows"] == 2} == {"d": 86400, "t": 1}
    one, two = (merged(read_profiles(spark, path, [n])) for n in (1, 2))
    gone = {r["column"]: (r["n_earlier"], r["n_later"], r["d"]) for r in drift(one, two).select("*", drifted().alias("d")).collect()}
    assert gone["b"] == (1, None, True) and gone["c"] == (None, 1, True)


def test_odd_tables(spark):
    none = described(profile(spark.createDataFrame([], "a int, b string"))).collect()
    assert [(r["column"], r["n_rows"], r["low"], r["quantiles"], r["top"]) for r in none] == [("a", 0, None, None, []), ("b", 0, None, None, [])]
    long_ = spark.createDataFrame([("x" * 100_000, [1, 2]), ("x" * 100_000, [1, 2]), ("é", None)], "`odd name` string, l array<int>")
    told = {r["column"]: r for r in described(profile(long_)).collect()}
    top = told["odd name"]["top"]
    assert len(top[0]["item"]) == 64 and top[0]["count"] == 2 and told["odd name"]["high"] == 100_000
    assert told["l"]["n_null"] == 1 and told["l"]["top"][0]["count"] == 2
    one_pass = profile(long_).where(F.col("column") == "l")
    assert one_pass.count() == 1 and profile(long_, ["l"]).count() == 1
