"""Places of regular expression matches, as column expressions.

Spark gives the matches of an expression but not their places. The texts between the matches come
from splitting by the same expression, and places are running sums of both lengths. Expressions must
not match the empty string; they are written with possessive repeats and look-behind, so that
a long run of one kind of character is read once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from .text import let

_STRETCH = 256
SPAN = "struct<kind:string,start:bigint,end:bigint,value:string,score:double>"


def nothing() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def _running(values: Column) -> Column:
    """0 and then the sums of the first 1, 2, ... values."""
    return F.aggregate(values, F.array(F.lit(0).cast("bigint")), lambda done, x: F.concat(
        done, F.array(F.element_at(done, -1) + x)))


def starts_of(lengths: Column) -> Column:
    """The sum of all values before each one. Stretches are summed up on their own and then
    shifted, so that no long array is copied for every value."""
    def of_stretches(parts: Column) -> Column:
        sums = F.transform(parts, lambda part: F.aggregate(
            part, F.lit(0).cast("bigint"), lambda total, x: total + x))
        return F.flatten(F.zip_with(parts, F.slice(_running(sums), 1, F.size(parts)),
                                    lambda part, shift: F.transform(
            F.slice(_running(part), 1, F.size(part)), lambda x: x + shift)))

    cuts = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _STRETCH).cast("int"))
    return let(F.transform(cuts, lambda k: F.slice(lengths, k * _STRETCH + 1, _STRETCH)),
               of_stretches)


def matches(text: Column, pattern: str, around: int = 40) -> Column:
    """``start, end, value, before, after`` of all matches, from the left and without overlap.
    Places count code points, ``end`` is behind the match, and ``before`` and ``after`` are up to
    ``around`` code points between it and the next match."""
    def placed(found: Column) -> Column:
        def with_places(parts: Column) -> Column:
            between = F.slice(parts, 1, F.size(found))
            lengths = F.zip_with(between, found, lambda p, m: (F.length(p) + F.length(m)).cast(
                "bigint"))
            at = F.zip_with(starts_of(lengths), F.arrays_zip(
                between.alias("before"), found.alias("value"),
                F.slice(parts, 2, F.size(found)).alias("after")), lambda s, x: F.struct(
                    (s + F.length(x["before"])).alias("start"),
                    (s + F.length(x["before"]) + F.length(x["value"])).alias("end"),
                    x["value"].alias("value"),
                    F.right(x["before"], F.lit(around)).alias("before"),
                    F.left(x["after"], F.lit(around)).alias("after")))
            return at

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), with_places))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def spans(text: Column, kind: str, pattern: str, gate: Column, valid: Callable[[Column], Column],
          score: Callable[[Column], Column]) -> Column:
    """The valid matches as spans of one kind; none where ``gate`` says that there can be none."""
    found = let(matches(text, pattern), lambda all_: F.transform(
        F.filter(all_, lambda m: valid(m)), lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].cast("bigint").alias("start"),
            m["end"].cast("bigint").alias("end"), m["value"].alias("value"),
            score(m).cast("double").alias("score"))))
    return F.when(gate, F.coalesce(found, nothing())).otherwise(nothing())


def count_of(found: Column, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint")


def listed(found: Column) -> Column:
    """``kind:start:end`` of the spans in their order, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def by_start(found: Column, kinds: Sequence[str]) -> Column:
    """The spans by start, then in the order of ``kinds``."""
    order = F.array(*map(F.lit, kinds))
    keyed = F.transform(found, lambda s: F.struct(
        s["start"].alias("a"), F.array_position(order, s["kind"]).alias("b"), s.alias("s")))
    return F.transform(F.sort_array(keyed), lambda k: k["s"])


def blotted(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one,
    named after the first."""
    ordered = F.sort_array(F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    empty = F.struct(F.lit(0).cast("bigint").alias("at"),
                     F.array().cast("array<string>").alias("parts"))

    def put(done: Column, s: Column) -> Column:
        part = F.concat(
            F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")),
            F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(s["start"] >= done["at"], F.concat(done["parts"], F.array(part)))
            .otherwise(done["parts"]).alias("parts"))

    joined = F.aggregate(ordered, empty, put, lambda done: F.concat(
        F.array_join(done["parts"], ""), F.substring(
            text, (done["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(found) > 0, joined).otherwise(text)
