"""How the words of each source differ from those of the other sources and of its whole language.

In-mapper stripes: every task folds whole documents into one stripe a term, its document frequency
and its occurrences by source, in hash tables of bounded size; a full table is written out and
begun anew. The stripes of a term meet by key, sorted, and are merged while they stream by, so that
no task holds more than one term's stripe and the few sums below. A merged stripe has everything a
divergence needs once the totals of the groups are known: each task adds up the terms of its
stripes by pair of sources, and keeps the highest ranks of each group, before anything is shuffled.

All arithmetic is exact, in whole numbers.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..plans.stages import stored

MIN_DOCS, TOP_TERMS = 10, 10
SCALE, SMOOTH = 1_000_000_000, 2
#: Entries (a term under a source) a task folds before it writes its stripes: some 100 MB.
FOLD_ENTRIES = 400_000
#: Stripes written at a time, and numbers (a term under each source) scored at a time.
_ROWS, _CELLS = 1 << 16, 1 << 18
#: Sources of one language, and groups of all languages, that the totals sent to every task may
#: have. The result has a row for each pair of sources, so more of them end with a message.
MAX_SOURCES, MAX_GROUPS = 4_096, 1 << 18

#: Letters of ASCII in lower case; all other ASCII characters separate terms.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))
_STRIPE = "lang string, term string, df bigint, sources array<string>, counts array<bigint>"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters, lower-cased, and of characters beyond
    ASCII. No byte of such a character is an ASCII one, so bytes can be cut."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def _batch(lang: pa.Array, term: pa.Array, df: np.ndarray, ends: np.ndarray, sources: pa.Array,
           counts: np.ndarray) -> pa.RecordBatch:
    """Stripes from flat entries; ``ends`` tells where each stripe's entries begin and end."""
    ends = pa.array(ends, pa.int32())
    return pa.RecordBatch.from_arrays(
        [lang, term, pa.array(df, pa.int64()), pa.ListArray.from_arrays(ends, sources),
         pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))],
        names=["lang", "term", "df", "sources", "counts"])


def _fold(entries: int):
    """Documents to stripes, one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # by language: documents with a term, and by source how often it occurs
        found: dict[str, Counter] = {}
        occurs: dict[str, dict[str, Counter]] = {}

        def stripes() -> Iterator[pa.RecordBatch]:
            for lang, df in found.items():
                by_source = occurs[lang]
                sizes = [len(c) for c in by_source.values()]
                coded = pa.array([t for c in by_source.values() for t in c],
                                 pa.binary()).dictionary_encode()
                counts = np.fromiter((n for c in by_source.values() for n in c.values()), np.int64)
                own = np.repeat(np.arange(len(sizes)), sizes)
                # the entries of a term side by side
                of_term = coded.indices.to_numpy()
                order = np.argsort(of_term, kind="stable")
                names = pa.array(list(by_source), pa.string()).take(pa.array(own[order]))
                here = coded.dictionary
                ends = np.concatenate(([0], np.cumsum(np.bincount(of_term, minlength=len(here)))))
                documents = np.fromiter(map(df.__getitem__, here.to_pylist()), np.int64)
                whole = _batch(pa.array([lang] * len(here), pa.string()), here.cast(pa.string()),
                               documents, ends, names, counts[order])
                for start in range(0, len(here), _ROWS):
                    yield whole.slice(start, _ROWS)
            found.clear()
            occurs.clear()

        held = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist()
                                            for c in ("lang", "source", "text"))):
                own = terms(text)
                if not own:
                    continue
                counted = occurs.setdefault(lang, {}).setdefault(source, Counter())
                held -= len(counted)
                counted.update(own)
                held += len(counted)
                found.setdefault(lang, Counter()).update(set(own))
                if held >= entries:
                    yield from stripes()
                    held = 0
        yield from stripes()

    return run


def _merged(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Sorted stripes with those of one term added up."""
    lang, term = rows.column("lang"), rows.column("term")
    new = np.ones(rows.num_rows, dtype=bool)
    new[1:] = pc.or_(pc.not_equal(lang.slice(1), lang.slice(0, len(lang) - 1)),
                     pc.not_equal(term.slice(1), term.slice(0, len(term) - 1))).to_numpy(
                         zero_copy_only=False)
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    sizes = pc.list_value_length(rows.column("counts")).to_numpy()
    coded = rows.column("sources").flatten().dictionary_encode()
    width = len(coded.dictionary)
    entry = np.repeat(group, sizes) * width + coded.indices.to_numpy()
    different, back = np.unique(entry, return_inverse=True)
    counts = np.zeros(len(different), dtype=np.int64)
    np.add.at(counts, back, rows.column("counts").flatten().to_numpy())
    ends = np.searchsorted(different, np.arange(len(first) + 1) * width)
    at = pa.array(first)
    return _batch(lang.take(at), term.take(at),
                  np.add.reduceat(rows.column("df").to_numpy(), first), ends,
                  coded.dictionary.take(pa.array(different % width)), counts)


def _merge(least: int):
    """Sorted stripes to one a term, those of terms in ``least`` documents or more. Batches are
    merged one by one; the last term of each waits, as a single stripe, for the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        frequent = lambda rows: rows.filter(pc.greater_equal(rows.column("df"), least))
        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting is not None:
                batch = pa.concat_batches([waiting, batch])
            done = _merged(batch)
            waiting = done.slice(done.num_rows - 1)
            yield frequent(done.slice(0, done.num_rows - 1))
        if waiting is not None:
            yield frequent(waiting)

    return run


def stripes(docs: DataFrame, least: int = MIN_DOCS, entries: int = FOLD_ENTRIES) -> DataFrame:
    """``lang, term, df, sources, counts`` for each term in ``least`` or more documents of a
    language: how many documents have it, and how often it occurs by source, where it does. ``lang``
    and ``source`` are not null."""
    folded = docs.select("lang", "source", "text").mapInArrow(_fold(entries), _STRIPE)
    return folded.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(
        _merge(least), _STRIPE)


def share(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """``1 + floor(SCALE (count + SMOOTH) / (total + SMOOTH kept))`` in whole numbers."""
    if total >= (1 << 63) // SCALE - SMOOTH:  # beyond 64 bits
        wide = (SCALE * (count.astype(object) + SMOOTH)) // (total + SMOOTH * kept)
        return wide.astype(np.int64) + 1
    return SCALE * (count + SMOOTH) // (total + SMOOTH * kept) + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _score(shared, top: int):
    """Stripes to partial results: sums by pair of sources, and the best terms of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = shared.value
        sums: dict[str, np.ndarray] = {}
        best: dict[tuple[str, int], list] = {}

        def add(lang: str, rows: pa.RecordBatch) -> None:
            sources, totals, kept = groups[lang]
            names = rows.column("sources").flatten()
            place = pc.index_in(names, value_set=pa.array(sources, pa.string())).to_numpy()
            at = np.repeat(np.arange(rows.num_rows),
                           pc.list_value_length(rows.column("counts")).to_numpy())
            count = np.zeros((len(sources), rows.num_rows), dtype=np.int64)
            count[place, at] = rows.column("counts").flatten().to_numpy()
            p = np.stack([share(count[i], totals[i], kept) for i in range(len(sources))])
            q = share(count.sum(axis=0), sum(totals), kept)
            mine = sums.setdefault(lang, np.zeros((len(sources), len(sources)), dtype=np.int64))
            for i in range(len(sources) - 1):
                mine[i, i + 1:] += _apart(p[i], p[i + 1:]).sum(axis=1)
            value = _apart(p, q)
            for i in range(len(sources)):
                some = np.flatnonzero((count[i] > 0) & (p[i] > q))
                if len(some) > top:  # with all that equal the last
                    last = np.partition(value[i, some], -top)[-top]
                    some = some[value[i, some] >= last]
                words = rows.column("term").take(pa.array(some, pa.int64())).cast(pa.binary())
                # equal values go by the least term in UTF-8
                found = [*best.get((lang, i), []),
                         *zip((-value[i, some]).tolist(), words.to_pylist())]
                best[lang, i] = heapq.nsmallest(top, found)

        for batch in batches:
            of_lang = batch.column("lang").dictionary_encode()
            for k, lang in enumerate(of_lang.dictionary.to_pylist()):
                own = batch.filter(pc.equal(of_lang.indices, k))
                # all sources of a block of terms are looked at together
                block = max(1, _CELLS // len(groups[lang][0]))
                for start in range(0, own.num_rows, block):
                    add(lang, own.slice(start, block))
        rows = []
        for lang, mine in sums.items():
            sources = groups[lang][0]
            for i, j in zip(*np.triu_indices(len(sources), 1)):
                rows.append((lang, sources[i], "pair", sources[j], int(mine[i, j])))
        for (lang, i), found in best.items():
            rows += [(lang, groups[lang][0][i], "term", term.decode(), -value)
                     for value, term in found]
        for start in range(0, len(rows), 1 << 16):
            columns = list(zip(*rows[start:start + (1 << 16)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[k], pa.string()) for k in range(4)]
                + [pa.array(columns[4], pa.int64())],
                names=["lang", "source", "part", "item", "value"])

    return run


def divergences(docs: DataFrame, least: int = MIN_DOCS, top: int = TOP_TERMS,
                entries: int = FOLD_ENTRIES) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group, a source in a language.

    Part ``pair``: the divergence from each other source of the language, summed over all terms that
    the language keeps (0 if it keeps none). Part ``term``: the ``top`` terms that the group uses and
    that have a greater share there than in the whole language. Ranks fall with the value; equal
    values go by the item in UTF-8.

    Null text, lang and source count as empty. Repeated rows and null ids are documents like
    others; other columns play no part. An empty table gives an empty result, as does a language of one
    source without kept terms. More than ``MAX_SOURCES`` sources in a language, or ``MAX_GROUPS``
    groups, raise an error.
    """
    spark = docs.sparkSession
    named = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), "text")
    kept = stored(stripes(named, least, entries), "stripes")
    counted = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e")).groupBy(
        "lang", F.col("e.sources").alias("source")).agg(F.sum("e.counts").alias("n"))
    occurring = named.groupBy("lang", "source").agg(F.lit(0).cast("bigint").alias("n"))
    totals = stored(occurring.unionByName(counted).groupBy("lang", "source").agg(
        F.sum("n").alias("n")), "stripe-totals")
    size = totals.groupBy("lang").count().agg(F.max("count"), F.sum("count")).first()
    if (size[0] or 0) > MAX_SOURCES or (size[1] or 0) > MAX_GROUPS:
        raise ValueError(f"{size[0]} sources in a language and {size[1]} groups; at most "
                         f"{MAX_SOURCES} and {MAX_GROUPS} can be compared")
    # one row a group and one a language, their number checked above
    vocabulary = {r["lang"]: r["count"] for r in kept.groupBy("lang").count().collect()}
    groups: dict[str, tuple] = {}
    for lang, source, n in totals.orderBy("lang", "source").collect():
        sources, own, _ = groups.setdefault(lang, ([], [], vocabulary.get(lang, 0)))
        sources.append(source)
        own.append(n)
    partial = kept.mapInArrow(
        _score(spark.sparkContext.broadcast(groups), top),
        "lang string, source string, part string, item string, value bigint")
    found = stored(partial, "divergences")
    summed = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"))
    # every pair of a language is a row of the result, also where no term is kept
    a, b = totals.select("lang", "source"), totals.selectExpr("lang", "source AS item")
    pairs = a.join(b, "lang").filter("source < item").join(
        summed, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))
    both = pairs.unionByName(pairs.select(
        "lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    rows = both.withColumn("part", F.lit("pair")).unionByName(found.filter("part = 'term'"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked.filter(f"part = 'pair' OR rank <= {int(top)}").select(
        "lang", "source", "part", "item", "value", "rank")


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    """The divergences of all sources of ``documents``."""
    return divergences(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The same result in DuckDB.
DIVERGENCE_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(text, '') AS text FROM documents),
found AS (
  SELECT row, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT row) >= {MIN_DOCS}),
groups AS (SELECT DISTINCT lang, source FROM docs),
counted AS (
  SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term)
  GROUP BY lang, source, term),
filled AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
of_group AS (SELECT lang, source, sum(n) AS total FROM filled GROUP BY lang, source),
of_lang AS (SELECT lang, sum(n) AS total FROM filled GROUP BY lang),
p AS (
  SELECT f.lang, f.source, f.term, f.n, CAST(1 + ({SCALE} * CAST(f.n + {SMOOTH} AS HUGEINT))
    // CAST(g.total + {SMOOTH} * s.v AS HUGEINT) AS HUGEINT) AS p
  FROM filled f JOIN of_group g USING (lang, source) JOIN sizes s USING (lang)),
q AS (
  SELECT f.lang, f.term, CAST(1 + ({SCALE} * CAST(sum(f.n) + {SMOOTH} AS HUGEINT))
    // CAST(any_value(l.total) + {SMOOTH} * any_value(s.v) AS HUGEINT) AS HUGEINT) AS q
  FROM filled f JOIN of_lang l USING (lang) JOIN sizes s USING (lang) GROUP BY f.lang, f.term),
summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
rows AS (
  SELECT * FROM pairs UNION ALL
  SELECT p.lang, p.source, 'term', p.term, (p.p - q.q) * (p.p - q.q) // (p.p + q.q)
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
