from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyground.operators.skew import hot_keys, split_hot


def crowd(spark, n=3000):
    """Every third row has key 0, the others are spread."""
    return spark.range(n).selectExpr("id", "if(id % 3 = 0, 0L, id) AS k", "id % 2 AS j")


def test_hot_keys_are_found_with_their_pieces(spark):
    rows = hot_keys(crowd(spark), ["k"], 100).collect()
    (expected,) = spark.range(1).select(F.xxhash64(F.lit(0).cast("bigint"))).first()
    assert [(r._hash, r._pieces) for r in rows] == [(expected, 10)]
    assert hot_keys(crowd(spark), ["k"], 1_000_000).count() == 0
    assert hot_keys(crowd(spark).limit(0), ["k"], 1).count() == 0


def test_many_distinct_keys_do_not_hide_the_crowd(spark):
    df = crowd(spark, 900_000).repartition(16)
    assert [r._pieces for r in hot_keys(df, ["k"], 50_000).collect()] == [6]


def test_hot_keys_do_not_shuffle_keys(spark):
    text = hot_keys(crowd(spark), ["k"], 100)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in text.splitlines() if "Exchange" in line]
    partial = text.index("partial_approx_top_k")
    assert len(exchanges) == 1 and text.index("Exchange") < partial  # sketches only


@pytest.mark.parametrize("left_hot,right_hot", [(True, False), (False, True), (True, True)])
def test_split_join_has_the_same_rows_and_even_pieces(spark, left_hot, right_hot):
    left = crowd(spark, 600)
    right = crowd(spark, 90).withColumnRenamed("id", "rid")
    options = {}
    if left_hot:
        options |= dict(left_hot=hot_keys(left, ["k"], 20), left_deal=["id"])
    if right_hot:
        options |= dict(right_hot=hot_keys(right, ["k"], 10), right_deal=["rid"])
    a, b, on = split_hot(left, right, ["k"], **options)
    got = a.drop("j").join(b.drop("j"), on)
    plain = left.join(right, "k")
    assert sorted(map(tuple, got.select("id", "rid").collect())) == sorted(
        map(tuple, plain.select("id", "rid").collect()))
    pieces = [r["count"] for r in got.filter("k = 0").groupBy(*on).count().collect()]
    assert len(pieces) == (10 if left_hot else 1) * (3 if right_hot else 1)
    assert max(pieces) < 3 * sum(pieces) / len(pieces)


def test_key_types_must_agree(spark):
    left, right = crowd(spark, 30), crowd(spark, 30).selectExpr("id AS rid", "CAST(k AS INT) AS k")
    with pytest.raises(ValueError, match="join key k"):
        split_hot(left, right, ["k"], left_hot=hot_keys(left, ["k"], 5), left_deal=["id"])
