"""Source divergences against a plain count of every term in every group."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import SCHEMA, awkward, documents, empty
from skyground.llm import divergence as D

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least=10, top=10):
    """``rows`` of (text, lang, source) to the sorted result."""
    by_lang = defaultdict(lambda: (Counter(), defaultdict(Counter)))
    for text, lang, source in rows:
        df, groups = by_lang[lang or ""]
        found = TERM.findall((text or "").translate(LOWER))
        df.update(set(found))
        groups[source or ""].update(found)
    out = []
    for lang, (df, groups) in by_lang.items():
        kept = [t for t, n in df.items() if n >= least]
        whole = sum(groups.values(), Counter())

        def shares(counted):
            total = sum(counted[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counted[t] + 2) // (total + 2 * len(kept)) for t in kept}

        apart = lambda a, b: (a - b) ** 2 // (a + b)
        q, p = shares(whole), {s: shares(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(sum(apart(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            own = [(apart(p[s][t], q[t]), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", own, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1)
                        for k, (value, item) in enumerate(found[:most])]
    return sorted(out)


def rows_of(docs):
    return [(r.text, r.lang, r.source) for r in docs.collect()]


def result(docs, **options):
    return sorted(map(tuple, D.divergences(docs, **options).collect()))


@pytest.mark.parametrize("entries", [D.FOLD_ENTRIES, 50])
def test_whole_table(spark, smallest, entries):
    """Also with stripes that are written and begun anew after every few documents."""
    docs = documents(spark, smallest).repartition(5)
    assert result(docs, entries=entries) == brute(rows_of(docs))


def test_query(spark, smallest):
    got = D.op13_divergence(spark, smallest)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"),
                          ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, got.collect())) == brute(rows_of(documents(spark, smallest)))


@pytest.mark.parametrize("least", [1, 2, 10])
def test_awkward_rows(spark, least):
    """Nulls, empty and long texts, repeated rows, marks beyond ASCII, columns of other names."""
    docs = awkward(spark)
    assert result(docs, least=least) == brute(rows_of(docs), least)


def test_ties_go_by_utf8(spark):
    text = "b a é Z 😀 ￿ _x9y"
    docs = spark.createDataFrame(
        [(text, "l", "s"), ("q q q", "l", "t"), (text, "l", "s"), ("Q", "l", "t")],
        "text string, lang string, source string")
    found = result(docs, least=2)
    assert found == brute(rows_of(docs), 2)
    items = [r[3] for r in sorted(found, key=lambda r: r[5]) if r[1] == "s" and r[2] == "term"]
    assert items == sorted(items, key=str.encode) and len(items) == 8


def test_a_hot_source_and_many_terms(spark):
    """A third of the rows in one source, over several tasks."""
    docs = spark.range(600).select(
        F.expr("concat_ws(' ', transform(sequence(1, 30), i -> concat('t', translate("
               "cast(pmod(id * i, 97) AS string), '0123456789', 'abcdefghij'))))").alias("text"),
        F.lit("l").alias("lang"),
        F.expr("if(id % 3 = 0, 'hot', concat('s', cast(id % 7 AS string)))").alias("source"))
    docs = docs.repartition(6)
    assert result(docs, entries=100) == brute(rows_of(docs))


def test_empty_and_one_source(spark):
    assert result(empty(spark)) == []
    one = spark.createDataFrame([(1, "a b", "en", "s", 1, 1, "x")], SCHEMA)
    assert result(one) == []
    two = one.unionByName(one.withColumn("source", F.lit(None).cast("string")))
    assert result(two) == [("en", "", "pair", "s", 0, 1), ("en", "s", "pair", "", 0, 1)]


def test_shares_beyond_64_bits():
    for total in (10, 9_223_372_034, 9_223_372_040, 10 ** 13):
        count = np.array([0, 7, total - 7], dtype=np.int64)
        assert D.share(count, total, 3).tolist() == [
            1 + 10 ** 9 * (int(c) + 2) // (total + 6) for c in count]


def test_too_many_sources_fail(spark, monkeypatch):
    monkeypatch.setattr(D, "MAX_SOURCES", 2)
    with pytest.raises(ValueError, match="3 sources"):
        D.divergences(spark.createDataFrame([("a", "l", s) for s in "xyz"],
                                            "text string, lang string, source string"))
