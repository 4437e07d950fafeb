"""Mixing sources to target weights by balanced sampling with the cube method.

Every source has a target in words, so each of its documents is wanted ``target / size`` times on
average. The whole part of that is taken of each document; the rest is an inclusion probability, and
the cube method turns the probabilities into 0 or 1 while it holds the number of documents and the
number of words: it moves the probabilities of three documents along the direction in which neither
total changes, until one is decided, and goes on with the next. At the end fewer than three are
undecided in a block: the landing problem, solved by trying all their outcomes and one exchange.

Sources are dealt to blocks of bounded size; what the blocks leave undecided is dealt and decided
anew until one block is left.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.stages import stored
from .text import BLANKS, by_row, spare

WEIGHTS, MOST_TIMES = (1, 2, 3), 3
BLOCK_DOCS = 100_000
_NEAR = 1e-9


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for a null one."""
    body = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), f"{BLANKS}+", " "))
    return F.when(body == "", F.lit(0)).otherwise(
        F.length(body) - F.length(F.replace(body, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """``source, source_size, target`` for each source of ``sizes (source, size)``.

    Sources by code point, null last, take the weights in turn and share all words by weight. No
    target is above ``most`` times its source's words; the excess is shared again by weight. The
    sources filled up are those with the least words for their weight, so after sorting by that the
    common level follows from running sums. One row a source goes through one task.
    """
    of_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = of_source.withColumn("weight", F.get(turn, (place - 1) % len(weights)))
    full = F.col("source_size") * float(most)
    order = Window.orderBy((full / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    # the words and the weight left for a source and all after it in the order
    levelled = weighed.select(
        "source", "source_size", "weight", full.alias("full"),
        (F.sum("source_size").over(every)
         - F.coalesce(F.sum(full).over(before), F.lit(0.0))).alias("words_left"),
        (F.sum("weight").over(every)
         - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weight_left"))
    fills = F.col("full") * F.col("weight_left") <= F.col("weight") * F.col("words_left")
    # the first source that does not fill up has the most words and weight left of those
    level = F.max(F.when(~fills, F.struct("weight_left", "words_left"))).over(every)
    return levelled.select(
        "source", "source_size",
        F.when(fills, F.col("full")).otherwise(
            F.col("weight") * level["words_left"] / level["weight_left"]).alias("target"))


def fly(chance: np.ndarray, size: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The flight: chances moved to 0 or 1 with both totals held, and the places of the fewer than
    three that are left between. ``draw`` has a number from 0 to 1 for each step."""
    chance = chance.astype(float).copy()
    values, sizes = chance.tolist(), size.astype(float).tolist()
    hand: list[int] = []
    steps = iter(draw.tolist())
    for k, value in enumerate(values):
        if value <= _NEAR or value >= 1 - _NEAR:
            values[k] = round(value)
            continue
        hand.append(k)
        if len(hand) < 3:
            continue
        a, b, c = hand
        # no change of the count nor of the words along (u, v, w)
        u, v, w = sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b]
        if u == v == w == 0:
            u, v = 1.0, -1.0
        up = down = np.inf
        for i, d in ((a, u), (b, v), (c, w)):
            if d > 0:
                up, down = min(up, (1 - values[i]) / d), min(down, values[i] / d)
            elif d < 0:
                up, down = min(up, values[i] / -d), min(down, (1 - values[i]) / -d)
        # up with chance down / (up + down), so that the expected change is none
        move = up if next(steps) * (up + down) < down else -down
        for i, d in ((a, u), (b, v), (c, w)):
            values[i] += move * d
            if values[i] <= _NEAR or values[i] >= 1 - _NEAR:
                values[i] = round(values[i])
                hand.remove(i)
    return np.array(values), hand


def land(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """0 or 1 for the last few chances: the outcome nearest in words, then in number."""
    best = min(product((0, 1), repeat=len(chance)), key=lambda pick: (
        abs(np.dot(np.array(pick) - chance, size)), abs(sum(pick) - chance.sum()), pick))
    return np.array(best, dtype=float)


def repair(chance: np.ndarray, taken: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``taken`` after exchanges of one taken and one left document each, every one bringing the
    words nearest to their expected number; the number of documents stays. Long documents are often
    among the last undecided ones, and rounding them alone would miss the words by up to half of
    their length. Ends when no exchange helps."""
    taken = taken.copy()
    gap = float(np.dot(taken - chance, size))
    while abs(gap) >= 1:
        inside, outside = np.flatnonzero(taken == 1), np.flatnonzero(taken == 0)
        if not len(inside) or not len(outside):
            break
        outside = outside[np.argsort(size[outside], kind="stable")]
        wanted = size[inside] - gap
        at = np.searchsorted(size[outside], wanted)
        best = (abs(gap), -1, -1)
        for place in (np.maximum(at - 1, 0), np.minimum(at, len(outside) - 1)):
            left = np.abs(wanted - size[outside[place]])
            k = int(left.argmin())
            best = min(best, (float(left[k]), int(inside[k]), int(outside[place[k]])))
        # sizes are whole numbers; less than half a word is rounding, not a gain
        if best[0] > abs(gap) - 0.5:
            break
        gap += float(size[best[2]] - size[best[1]])
        taken[best[1]], taken[best[2]] = 0.0, 1.0
    return taken


def _decide(todo: DataFrame, blocks: Column, last: bool) -> DataFrame:
    """``row, source, size, chance`` after a flight in every block; landed if ``last``."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # long documents first, so that short ones are left at the end; equal ones by hash
        rows = rows.sort_values(["size", "mix", "row"], ascending=[False, True, True], kind="stable")
        size = rows["size"].to_numpy()
        draw = rows["mix"].to_numpy().view(np.uint64) / 2.0 ** 64
        before = rows["chance"].to_numpy()
        chance, hand = fly(before, size, draw)
        if last:
            chance[hand] = land(chance[hand], size[hand]) if hand else 0.0
            chance = repair(before, chance, size)
        return rows.assign(chance=chance)[["row", "source", "size", "chance", "mix"]]

    return todo.withColumn("block", blocks).groupBy("source", "block").applyInPandas(
        run, "row bigint, source string, size bigint, chance double, mix bigint")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_TIMES,
        block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``doc_id, row, source, size, source_size, target, copies`` for every row of ``docs``.

    ``copies`` is how often the mix takes the document, at most ``most`` times. Draws are hashes of
    id, source and size, so reruns agree; rows that agree in these are interchangeable. Null texts have no
    words, null sources are a source. Without words all targets are 0.
    """
    rows = stored(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"),
        F.monotonically_increasing_id().alias("row")), "mix-rows")
    wanted = stored(targets(rows, weights, most), "mix-targets")
    per_doc = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # one row a source; larger lists than the session's broadcast limit are shuffled
    joined = rows.alias("r").join(
        wanted.alias("t"), F.expr("r.source <=> t.source")).select(
        "doc_id", "row", "r.source", "size", "source_size", "target", per_doc.alias("times"))
    whole = F.least(F.floor("times"), F.lit(most)).cast("bigint")
    drawn = stored(joined.withColumn("whole", whole).withColumn(
        "chance", F.when(F.col("size") > 0, F.col("times") - F.col("whole")).otherwise(0.0)),
        "mix-drawn")
    todo = drawn.filter(f"chance > {_NEAR}").select(
        "row", "source", "size", "chance", F.xxhash64("doc_id", "source", "size").alias("mix"))
    decided = None
    while True:
        largest = todo.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        blocks = -(-largest // block_docs)
        last = blocks <= 1
        after = stored(_decide(todo, F.expr(f"pmod(mix, {max(1, blocks)})"), last), "mix-decided")
        settled = F.col("chance").isin(0.0, 1.0)
        done = after.filter(settled & (F.col("chance") == 1)).select("row")
        decided = done if decided is None else decided.unionByName(done)
        if last:
            break
        todo = after.filter(~settled)
    once = decided.withColumn("more", F.lit(1).cast("bigint"))
    return drawn.join(once, "row", "left").select(
        "doc_id", "row", "source", "size", "source_size", "target",
        (F.col("whole") + F.coalesce("more", F.lit(0))).alias("copies"))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target",
                            (F.col("size") * F.col("copies")).alias("taken"))


def repeat_to_targets(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it."""
    row = spare(docs.columns, "row")
    numbered = by_row(docs, row, "mix_input")
    found = mix(numbered.select(F.col(row).alias("doc_id"), "source", "text"))
    taken = found.filter("copies > 0").select(
        F.col("doc_id").alias(row), F.expr("explode(sequence(1, copies))"))
    return numbered.join(taken, row).select(*docs.columns)
