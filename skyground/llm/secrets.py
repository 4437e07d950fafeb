"""Secret scanning over a trigram inverted index.

From each rule's expression a Boolean query over trigrams is derived that every match must satisfy:
all trigrams of a mandatory string, any of several alternatives. The index has a posting for each
document and trigram that some query asks for; intersecting postings leaves candidate documents, and
only these are searched with the rule's expression. A rule whose matches need no trigram (such as a
run of hexadecimal digits) searches all documents. Column expressions and joins only.
"""

from __future__ import annotations

import re._constants as ops
import re._parser as regex
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from .spans import by_start, count_of, listed, spans
from .text import let, spare

#: A query: a trigram, ("all", queries), ("any", queries), or True where nothing is mandatory.
Query = str | tuple | bool
_MOST_STRINGS = 16


@dataclass(frozen=True)
class Rule:
    """``pattern`` is read by Java and, for the query, by Python; ``secret`` is the group whose length
    must be ``least`` or more."""

    kind: str
    pattern: str
    least: int = 0
    secret: int = 0


#: The base rules, possessive where nothing is given back.
BASE = (
    Rule("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?+ *+[:=] *+[\"']?+"
                   r"([A-Za-z0-9+/_.=-]++)", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]++", 20),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+", 24),
)
ADDED = (
    Rule("hub", r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("block", r"-----BEGIN (?:[A-Z]++ )*PRIVATE KEY-----"),
    Rule("web", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++"),
)
RULES = BASE + ADDED


def _all(queries: Iterable[Query]) -> Query:
    kept = list(dict.fromkeys(q for q in queries if q is not True))
    return True if not kept else kept[0] if len(kept) == 1 else ("all", tuple(kept))


def _any(queries: Iterable[Query]) -> Query:
    kept = list(dict.fromkeys(queries))
    return True if True in kept or not kept else kept[0] if len(kept) == 1 else ("any", tuple(kept))


def _of_strings(strings: set[str]) -> Query:
    """What holds if one of the strings occurs; shorter ones than a trigram say nothing."""
    return _any(_all(s[i:i + 3] for i in range(len(s) - 2)) if len(s) >= 3 else True
                for s in sorted(strings))


def _read(items) -> tuple[set[str] | None, Query]:
    """The only strings a sequence of parsed items can match (None: unknown), and its query."""
    strings: set[str] | None = {""}
    run: set[str] = {""}
    queries: list[Query] = []
    for op, value in items:
        own, query = _read_one(op, value)
        if own is not None and len(run) * len(own) <= _MOST_STRINGS:
            run = {a + b for a, b in product(run, own)}
        else:
            queries += [_of_strings(run), _of_strings(own) if own is not None else query]
            strings, run = None, {""}
    if strings is not None:
        strings = run
    queries.append(_of_strings(run))
    return strings, _all(queries)


def _read_one(op, value) -> tuple[set[str] | None, Query]:
    if op is ops.LITERAL:
        return {chr(value).lower()}, True
    if op is ops.SUBPATTERN:
        return _read(value[3])
    if op is ops.ATOMIC_GROUP:
        return _read(value)
    if op is ops.BRANCH:
        read = [_read(branch) for branch in value[1]]
        known = [own for own, _ in read]
        if all(own is not None for own in known):
            every = set().union(*known)
            if len(every) <= _MOST_STRINGS:
                return every, True
        return None, _any(_of_strings(o) if o is not None else q for o, q in read)
    if op is ops.IN and all(kind is ops.LITERAL for kind, _ in value) and len(value) <= 8:
        return {chr(code).lower() for _, code in value}, True
    if op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
        least, most, body = value
        own, query = _read(body)
        if most == 1 and least == 0 and own is not None:
            return own | {""}, True
        if least == 0:
            return None, True
        if own is not None and least == most and len(own) == 1:
            return {next(iter(own)) * least}, True
        return None, _of_strings(own) if own is not None else query
    if op in (ops.AT, ops.ASSERT, ops.ASSERT_NOT):
        return {""}, True
    return None, True


def trigram_query(pattern: str) -> Query:
    """The query of an expression over a text in lower case."""
    own, query = _read(regex.parse(pattern))
    return _of_strings(own) if own is not None else query


def _terms(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(_terms, query[1]))


def _holds(query: Query, found: Column) -> Column:
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        return F.array_contains(found, query)
    return reduce(and_ if query[0] == "all" else or_, (_holds(q, found) for q in query[1]))


def postings(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """The inverted index: ``trigram, doc_id``, once for every row of ``docs`` that has the trigram
    in its text in lower case."""
    wanted = F.array(*map(F.lit, trigrams)).cast("array<string>")
    found = let(F.lower("text"), lambda low: F.filter(wanted, lambda t: F.contains(low, t)))
    return docs.select("doc_id", F.explode(found).alias("trigram")).select("trigram", "doc_id")


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``doc_id, kinds``: for documents whose postings satisfy a rule's query, the kinds of these
    rules. Rules without mandatory trigrams are left out. A document has at most as many postings as
    the rules have trigrams."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    merged = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("found"))
    kinds = F.array_compact(F.array(*[
        F.when(_holds(q, F.col("found")), F.lit(kind)) for kind, q in queries.items()
        if q is not True] or [F.lit(None).cast("string")]))
    return merged.select("doc_id", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def _long_enough(rule: Rule):
    def valid(m: Column) -> Column:
        value = F.regexp_extract(m["value"], rule.pattern, rule.secret) if rule.secret else m["value"]
        return F.length(value) >= rule.least

    return valid


def secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, name: str = "__spans") -> DataFrame:
    """All columns of ``docs`` and ``name``: the secrets of each row by start and then kind.

    Spans cover the whole match. Rows that repeat an id share its postings, so each is searched if
    any of them is a candidate, and gives its own spans; rows without an id do so too. A null text is
    empty; an empty table gives an empty result.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    trigrams = sorted(set().union(*map(_terms, queries.values())))
    own_id, kinds, plain = (spare([*docs.columns, name], c) for c in ("own_id", "kinds", "plain"))
    found = candidates(postings(docs, trigrams), rules).select(
        F.col("doc_id").alias(own_id), F.col("kinds").alias(kinds))
    marked = docs.join(found, docs["doc_id"].eqNullSafe(F.col(own_id)), "left").withColumn(
        plain, F.coalesce("text", F.lit("")))
    each = []
    for rule in rules:
        gate = F.lit(True) if queries[rule.kind] is True else F.coalesce(
            F.array_contains(kinds, rule.kind), F.lit(False))

        each.append(spans(F.col(plain), rule.kind, rule.pattern, gate, _long_enough(rule),
                          lambda m: F.lit(1.0)))
    return marked.withColumn(
        name, by_start(F.concat(*each), [r.kind for r in rules])).drop(plain, own_id, kinds)


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    counts = [count_of(F.col("__spans"), r.kind).alias(f"n_{r.kind}") for r in BASE]
    base = F.filter("__spans", lambda s: s["kind"].isin(*[r.kind for r in BASE]))
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("__spans")).alias("spans"))
