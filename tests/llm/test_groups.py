"""Operators over all rows: near duplicates, substrings, packing, edit fingerprints, mixing, archives,
and the pipeline, against brute force."""

from __future__ import annotations

import hashlib
import random
import uuid
import zlib
from collections import Counter, defaultdict

import llm_helpers as H
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from skyground.llm import editprint, graph, mixing, packing, shingles, simhash, substrings, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# near duplicates

def plain_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    ones = [0] * 64
    for s in shingles:
        value = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += value >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


@pytest.mark.parametrize("text", [
    None, "", " \t", "one", "A b C", "a b c d", "É a É b c", "a  b\nc\td e", H.PROSE,
    "x y z w " * 50, "  a\x1c b c d e"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(f"w{i * i % 71}" for i in range(500))
    monkeypatch.setattr(simhash, "_BLOCK", 37)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("bits,together", [
    (0, 1), (1, 1), (3, 1), (4, 1), (6, 1), (9, 1), (0, 2), (1, 2), (4, 2), (6, 2), (4, 3), (5, 3)])
def test_links_are_all_close_pairs(spark, bits, together):
    rng = random.Random(bits)
    values = {0, (1 << 64) - 1, 1, 1 << 63}
    while len(values) < 250:
        near = rng.choice(sorted(values))
        for b in rng.sample(range(64), rng.randint(0, 10)):
            near ^= 1 << b
        values.add(rng.choice([near, rng.getrandbits(64)]))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = [tuple(r) for r in simhash.links(table, bits, together).collect()]
    expected = {(a, b) for a in signed for b in signed
                if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= bits}
    assert len(found) == len(set(found)) and set(found) == expected


def roots(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [
        (rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(7, 7), (1, 0)]
    table = spark.createDataFrame(pairs, "a long, b long")
    found = {r.node: r.root for r in graph.components(table).collect()}
    expected = roots([p for p in pairs if p[0] != p[1]])
    assert found == expected
    assert graph.components(table.filter("a > 999")).count() == 0


def test_near_duplicates(spark, smallest):
    docs = H.documents(spark, smallest).select("doc_id", "text").unionByName(
        H.awkward(spark).selectExpr("doc_id + 1000 AS doc_id", "text"))
    rows = simhash.near_duplicates(docs).collect()
    prints = {r.row: r.fp & (1 << 64) - 1 for r in rows}
    ids = {r.row: r.doc_id for r in rows}
    assert sorted(prints.values()) == sorted(plain_fingerprint(r.text) for r in docs.collect())
    near = roots([(a, b) for a in prints for b in prints
                  if a <= b and (prints[a] ^ prints[b]).bit_count() <= 4])
    members = defaultdict(list)
    for row, root in near.items():
        members[root].append(row)
    for r in rows:
        known = [ids[m] for m in members[near[r.row]] if ids[m] is not None]
        assert r.component_id == (min(known) if known else None)
    assert sum(r.leader for r in rows) == len(members)


def test_keep_leaders(spark):
    docs = H.awkward(spark)
    kept = shingles.keep_leaders(docs, 5, 80)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sum(r.text == H.PROSE for r in rows) == 1
    assert {r.doc_id for r in rows if r.text and r.text.startswith("The old")} == {1}
    assert shingles.keep_leaders(H.empty(spark), 5, 80).count() == 0


# substrings

def plain_removals(rows, window):
    """Kept words of each (id, text), ids not null."""
    first = {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").encode().split()
        for k in range(len(words) - window + 1):
            first.setdefault(tuple(words[k:k + window]), i)
    kept = []
    for i, text in rows:
        words = (text or "").encode().split()
        gone = {k + j for k in range(len(words) - window + 1) for j in range(window)
                if first[tuple(words[k:k + window])] < i}
        kept.append((i, len(words), len(gone),
                     b" ".join(w for k, w in enumerate(words) if k not in gone)))
    return kept


def check_removals(spark, rows, window, anchor):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.n_words, r.n_removed,
                    hashlib.sha256(r.kept.encode()).hexdigest() if r.kept is not None else r.sha256)
                   for r in substrings.removals(table, window, anchor).collect())
    assert found == sorted((i, n, g, hashlib.sha256(k).hexdigest())
                           for i, n, g, k in plain_removals(rows, window))


def test_removals_on_documents(spark, smallest):
    rows = [tuple(r) for r in H.documents(spark, smallest).select("doc_id", "text").collect()]
    check_removals(spark, rows, substrings.WINDOW, substrings.ANCHOR)


@pytest.mark.parametrize("window,anchor", [(5, 2), (6, 6), (7, 3)])
def test_removals_on_few_words(spark, window, anchor):
    rng = random.Random(window)
    rows = [(rng.randint(0, 25), " ".join(rng.choices("ab", k=rng.randint(0, 40))))
            for _ in range(30)] + [(3, None), (4, ""), (5, "  \n ")]
    check_removals(spark, rows, window, anchor)


def test_removals_full_sketch(spark, smallest, monkeypatch):
    """A sketch so small that it says nothing still gives the same result."""
    monkeypatch.setattr(substrings, "_MOST_BITS", 4)
    monkeypatch.setattr(substrings, "_LEAST_BITS", 4)
    rows = [tuple(r) for r in H.documents(spark, smallest).select("doc_id", "text").limit(60).collect()]
    check_removals(spark, rows, substrings.WINDOW, substrings.ANCHOR)


def test_sketch_rows_follow_the_anchors(spark, monkeypatch):
    """A task sends what its few anchors touch, however large the sketch, and merging it gives the
    counters that two texts or more have."""
    monkeypatch.setattr(substrings, "_HELD_ANCHORS", 40, raising=False)
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefgh", k=60)) for _ in range(12)]
    texts += [texts[3] + " x", "y " + texts[7], "too short", None]
    table = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    bits, window, size = 20, 20, 8
    sent = substrings._sketches(table, bits, window, size)
    assert sum(len(row[1]) for row in sent.collect()) < 1 << 16

    count = np.zeros((substrings._ROWS, 1 << bits), dtype=int)
    for text in texts:
        words = substrings._words(text)
        if len(words) >= window:
            own = np.unique(substrings.anchors(substrings.word_hashes(words), window, size))
            for row, cells in zip(count, substrings._cells(own, bits)):
                np.add.at(row, cells, 1)
    merged = substrings._merged(sent, bits)
    assert (count >= 2).any()
    for row, bits_of_row in zip(count, merged):
        assert (np.unpackbits(bits_of_row) == (row >= 2)).all()


def test_removals_awkward(spark):
    rows = substrings.removals(H.awkward(spark), 10, 4).collect()
    assert len(rows) == H.awkward(spark).count()
    of = defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
    # rows of one id do not remove from each other; later ids and rows without one lose the passage
    assert all(r.n_removed == 0 for r in of[1])
    assert of[7][0].n_removed == of[7][0].n_words and of[7][0].kept == ""
    assert sorted(r.n_removed for r in of[None]) == [0, of[7][0].n_words]
    assert substrings.removals(H.empty(spark)).count() == 0


def test_anchors_of_equal_windows():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, 400, dtype=np.uint64)
    twice = np.concatenate((words, words[100:160], words[:30]))
    a = substrings.anchors(twice, 50, 10)
    assert (a[100:111] == a[400:411]).all() and len(a) == len(twice) - 49
    hashes = substrings.sequence_hashes(twice, 10, substrings._BASES[0]) * np.uint64(substrings._BASES[1])
    assert all(a[k] == hashes[k:k + 41].min() for k in range(0, len(a), 7))


# packing

def test_encoder_gives_the_tokenizers_ids(spark, smallest):
    texts = [r.text for r in H.documents(spark, smallest).collect()] + [
        "", "it's I'VE 'tis ''s x'tx", "a b\x85c\x1cd", "<|endoftext|> <|x", "Ünï ǅ ΑΣ ß ŉ İi", "½²a1",
        "é 日本語 😀", "_a__b_", "\x00a\x7fb", "'re're 're", "don’t"]
    whole = Tokenizer.from_file(TOKENIZER)
    encode = packing.Encoder(TOKENIZER)
    for part in (texts[:90], texts[90:]):
        for text, ids in zip(part, encode(part)):
            assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_encoder_knows_letters_that_leave_the_range_in_lower_case():
    whole, encode = Tokenizer.from_file(TOKENIZER), packing.Encoder(TOKENIZER)
    texts = [t.format(chr(c)) for c in range(0xa0, 0x250) for t in ("a{0}b", "don'{0}", "1{0}{0}2.")]
    for text, ids in zip(texts, encode(texts)):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_encoder_asks_for_a_word_once_whatever_marks_it_has():
    whole, encode = Tokenizer.from_file(TOKENIZER), packing.Encoder(TOKENIZER)
    encode(["tree Bäume , . ( ) ###"])

    def no_more(*args, **more):
        raise AssertionError("all words are known")

    encode.tokenizer = encode.known.tokenize = no_more
    text = "Tree, tree. (tree) bäume### (Bäume,"
    assert encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_encoder_does_not_keep_long_words():
    whole, encode = Tokenizer.from_file(TOKENIZER), packing.Encoder(TOKENIZER)
    text = "short " + "long" * 500
    assert encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids
    assert set(encode.known) == {"short"}


def test_encoder_with_a_full_cache(spark, smallest, monkeypatch):
    monkeypatch.setattr(packing, "_KNOWN_WORDS", 50)
    texts = [r.text for r in H.documents(spark, smallest).limit(20).collect()]
    encode, whole = packing.Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for k in range(0, 20, 5):
        for text, ids in zip(texts[k:k + 5], encode(texts[k:k + 5])):
            assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


def plain_place(lengths, size):
    """By the rule itself: the sum of squares after every possible place."""
    gaps, where = [], []
    for n in lengths:
        def squares(change):
            count = defaultdict(int)
            for g in change:
                if 0 < g < size:
                    count[g] += 1
            return sum(c * c for c in count.values())
        options = [(squares(gaps + [size - n]), 1, 0, len(gaps))]
        for k, g in enumerate(gaps):
            if g >= n:
                options.append((squares(gaps[:k] + [g - n] + gaps[k + 1:]), 0, g, k))
        best = min(options, key=lambda o: o[:3])
        k = best[3]
        where.append((best[0], k))
        gaps = gaps + [size - n] if k == len(gaps) else gaps[:k] + [gaps[k] - n] + gaps[k + 1:]
    return [w[0] for w in where], gaps


def test_other_tokenizers_get_whole_texts(smallest):
    """One that cuts at bytes and keeps blanks, and the known one with another setting."""
    import json

    import public_tokenizers
    known = Tokenizer.from_file(TOKENIZER)
    assert packing._cuts_alike(known)
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert not packing._cuts_alike(Tokenizer.from_file(other))
    spec = json.loads(known.to_str())
    spec["normalizer"]["normalizers"].pop()
    assert not packing._cuts_alike(Tokenizer.from_str(json.dumps(spec)))
    texts = ["Two  words, don't\nbreak", "", "It's 12 o'clock é😀"]
    whole = Tokenizer.from_file(other)
    assert [ids.tolist() for ids in packing.Encoder(other)(texts)] == [
        whole.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("group_pieces", [1 << 18, 40])
def test_groups_are_bounded_by_pieces(spark, group_pieces):
    """Many pieces of a token each, next to some long ones."""
    lengths = spark.range(300).selectExpr("id", "IF(id % 50 = 0, 30L, 1L) AS length")
    rows = packing.pack(lengths, size=32, group_pieces=group_pieces).collect()
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    assert len(rows) == 300
    for own in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(own)]).tolist()]
        assert [at for at, _ in sorted(own)] == ends[:-1] and ends[-1] <= 32
    assert len(places) <= 2 * -(-sum(r.length for r in rows) // 32)


@pytest.mark.parametrize("seed", range(4))
def test_place_takes_the_least_sum_of_squares(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 21, 60)
    where = packing.place(lengths, 20)
    gaps, sums = {}, []
    for n, at in zip(lengths.tolist(), where.tolist()):
        gaps[at] = gaps.get(at, 20) - n
        count = np.bincount([g for g in gaps.values() if g < 20], minlength=21)[1:]
        sums.append(int((count ** 2).sum()))
        assert gaps[at] >= 0
    assert sums[0] == plain_place(lengths[:1].tolist(), 20)[0][0]
    # each step is the best one from the state it finds
    for k in range(1, len(lengths)):
        state = {}
        for n, at in zip(lengths[:k].tolist(), where[:k].tolist()):
            state[at] = state.get(at, 20) - n
        n, outcomes = int(lengths[k]), []
        for gap in [*set(state.values()), 20]:
            if gap >= n:
                after = list(state.values())
                if gap < 20:
                    after.remove(gap)
                count = np.bincount([*after, gap - n], minlength=21)[1:20]
                outcomes.append(int((count ** 2).sum()))
        mine = dict(state)
        mine[int(where[k])] = mine.get(int(where[k]), 20) - n
        count = np.bincount(list(mine.values()), minlength=21)[1:20]
        assert int((count ** 2).sum()) == min(outcomes)


@pytest.mark.parametrize("group_tokens", [1 << 30, 20_000])
def test_pack(spark, smallest, group_tokens):
    docs = H.documents(spark, smallest).select("doc_id", "text").unionByName(
        H.awkward(spark).selectExpr("doc_id + 5000 AS doc_id", "text"))
    rows = packing.pack(packing.token_pieces(docs, TOKENIZER, with_ids=True),
                        group_tokens=group_tokens).collect()
    whole = Tokenizer.from_file(TOKENIZER)
    expected = sorted(
        (-1 if r.doc_id is None else r.doc_id, k, k * 4096, ids[k * 4096:(k + 1) * 4096])
        for r in docs.collect()
        for ids in [whole.encode(r.text or "", add_special_tokens=False).ids + [1]]
        for k in range(-(-len(ids) // 4096)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.ids)
                  for r in rows) == expected
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) for r in rows)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    least = -(-sum(r.length for r in rows) // 4096)
    assert len(places) <= 1.05 * least + 2


def test_pack_nothing(spark):
    assert packing.pack(packing.token_pieces(H.empty(spark), TOKENIZER)).count() == 0


# edit fingerprints

def plain_print(text):
    """The walk step by step."""
    chars, at, written = editprint._classes(text), 0, []
    while at < len(chars):
        written.append(chars[at])
        at += int(editprint._MOVES[len(written) % editprint._PERIOD - 1 if len(written) %
                                   editprint._PERIOD else editprint._PERIOD - 1][chars[at]])
    top = editprint._octave(len(written))
    out = f"{top:02d}"
    for octave in range(top, max(editprint._FIRST_OCTAVE - 1, top - editprint.OCTAVES), -1):
        for share in editprint._SHARES[octave]:
            j = int(2 ** octave * (1 + share))
            out += "-" if j >= len(written) else "%x" % editprint._DIGIT_OF[written[j]]
    return out


def test_prints_follow_the_walk(spark, smallest, monkeypatch):
    texts = [r.text for r in H.documents(spark, smallest).limit(40).collect()] + ["", "a", "é😀" * 9]
    expected = [plain_print(t) for t in texts]
    for together in (0, 5, 10_000):
        monkeypatch.setattr(editprint, "_TOGETHER", together)
        assert editprint.fingerprints(texts) == expected


def test_likeness_follows_edits():
    rng = random.Random(5)
    text = "".join(rng.choices("abcdefgh ", k=4000))
    other = "".join(rng.choices("abcdefgh ", k=4000))
    few = list(text)
    for _ in range(8):
        few.insert(rng.randrange(len(few)), "x")
    a, b, c, d = editprint.fingerprints([text, "".join(few), other, editprint.edited(text, other)])
    assert editprint.likeness(a, a) == 1.0 and editprint.likeness(a, None) == 0.0
    assert editprint.likeness(a, b) > 0.75 and editprint.likeness(a, b) == editprint.likeness(b, a)
    assert 0.65 < editprint.likeness(a, d) < 0.95
    assert editprint.likeness(a, c) < 0.35


def test_compare_with_next(spark, smallest):
    docs = H.documents(spark, smallest).select("doc_id", "text").unionByName(
        spark.createDataFrame([(9_000, None), (9_001, ""), (9_002, "abcdefg"), (None, H.PROSE)],
                              "doc_id long, text string"))
    rows = editprint.compare_with_next(docs.repartition(5)).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = sorted(k for k in texts if k is not None)
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == ids and len(rows) == len(texts)
    for r in rows:
        own = texts[r.doc_id]
        after = texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]] if r.doc_id is not None else ""
        changed = own[:len(own) - len(own) // 4] + after[:len(own) // 4]
        assert r.n_chars == len(own)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert [r.fingerprint, r.edited_fingerprint] == editprint.fingerprints([own, changed])
        assert r.near_edited == editprint.likeness(r.fingerprint, r.edited_fingerprint)
        if r.doc_id is not None:
            assert r.near_next == editprint.likeness(
                r.fingerprint, editprint.fingerprints([after])[0])


def test_compare_awkward(spark):
    rows = editprint.compare_with_next(H.awkward(spark)).collect()
    assert len(rows) == H.awkward(spark).count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert editprint.compare_with_next(H.empty(spark)).count() == 0


def test_near_pairs(spark, smallest):
    texts = [r.text for r in H.documents(spark, smallest).limit(80).collect() if len(r.text) > 400]
    prints = editprint.fingerprints(texts + [editprint.edited(t, "zz " * len(t)) for t in texts])
    table = spark.createDataFrame([(p,) for p in prints] + [(None,)], "fingerprint string")
    found = {(r.a, r.b): r.likeness for r in editprint.near_pairs(table).collect()}
    every = {(a, b): editprint.likeness(a, b) for a in set(prints) for b in set(prints) if a < b}
    assert all(every[p] == like and like >= editprint.LIKE for p, like in found.items())
    close = [p for p, like in every.items() if like >= 0.7]
    assert sum(p in found for p in close) >= 0.9 * len(close) > 0


# mixing

def plain_targets(sizes, most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in fixed]
        share = (total - sum(fixed.values())) / (sum(weight[s] for s in left) or 1)
        over = [s for s in left if share * weight[s] > most * sizes[s]]
        if not over:
            return fixed | {s: share * weight[s] for s in left}
        fixed |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1, "c": 1000, None: 5}, {"a": 1, "b": 1, "c": 1}, {"x": 7}, {"a": 0, "b": 9},
    {f"s{i}": (i * 37) % 101 for i in range(30)}])
def test_targets(spark, sizes):
    table = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in mixing.targets(table).collect()}
    assert found == pytest.approx(plain_targets(sizes))


def test_flight_holds_totals_and_chances():
    rng = np.random.default_rng(0)
    size, chance = rng.integers(1, 500, 400), np.full(400, 0.3)
    taken = np.zeros(400)
    for _ in range(300):
        after, hand = mixing.fly(chance, size, rng.random(400))
        assert len(hand) < 3 and after.sum() == pytest.approx(120, abs=1e-6)
        assert np.dot(after, size) == pytest.approx(np.dot(chance, size), abs=1e-3)
        taken += after
    assert abs(taken / 300 - 0.3).max() < 0.15


@pytest.mark.parametrize("block_docs", [100_000, 7])
def test_mix(spark, smallest, block_docs):
    docs = H.documents(spark, smallest).select("doc_id", "text", "source").withColumn(
        "source", F.expr("CASE WHEN source IN ('src0', 'src1', 'src2') THEN 'hot' "
                         "WHEN source < 'src15' THEN 'b' ELSE null END"))
    rows = mixing.mix(docs, block_docs=block_docs).collect()
    sizes, taken, wanted = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert 0 <= r.copies <= 3
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        wanted[r.source] = r.target
    assert wanted == pytest.approx(plain_targets(sizes))
    words = {r.doc_id: len((r.text or "").encode().split()) for r in docs.collect()}
    assert all(words[r.doc_id] == r.size and r.source_size == sizes[r.source] for r in rows)
    if block_docs == 100_000:
        assert all(taken[s] == pytest.approx(wanted[s], rel=0.01) for s in wanted)
        again = mixing.mix(docs.repartition(3)).collect()
        assert {(r.doc_id, r.copies) for r in again} == {(r.doc_id, r.copies) for r in rows}


def test_mix_awkward(spark):
    docs = H.awkward(spark)
    assert mixing.mix(docs).count() == docs.count()
    assert mixing.repeat_to_targets(docs).columns == docs.columns
    assert mixing.mix(H.empty(spark)).count() == 0
    wordless = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.copies) for r in mixing.mix(wordless).collect()] == [(0.0, 0), (0.0, 0)]


# archives

def odd_pages(spark, smallest):
    return spark.read.parquet(f"{smallest}/pages.parquet").unionByName(spark.createDataFrame(
        [(None, None, None), (None, None, None), (0, "x\r\ny", "é\r\n\r\nz"), (0, "x", "")],
        "page_id long, url string, html string"))


def put(spark, archive):
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/warc-{uuid.uuid4().hex}"
    warc.write_warc(archive, folder)
    return folder


def test_archive_round_trip_and_audit(spark, smallest):
    pages = odd_pages(spark, smallest)
    folder = put(spark, warc.records(pages.repartition(2), 20))
    back = warc.read_warc(spark, folder)
    rows = back.collect()
    assert Counter((r.page_id, bytes(r.content)) for r in rows) == Counter(
        (r.page_id, bytes(r.content)) for r in warc.records(pages, 20).collect())
    files = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.file, r.ordinal)):
        files[r.file].append(r)
    for own in files.values():
        assert [r.ordinal for r in own] == list(range(len(own))) and len(own) <= 20
        assert [r.offset for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
    trees = [warc.tree(warc.read_warc(spark, folder), name) for name in "ab"]
    assert warc.audit(*trees).count() == 0


def differences(a, b):
    """By record: of files as lists of (page, content)."""
    out = []
    for file in sorted(a.keys() | b.keys()):
        x, y = a.get(file, []), b.get(file, [])
        at = lambda side, k: sum(len(c) + 4 for _, c in side[:k])
        same = {k for k in range(min(len(x), len(y)))
                if x[k][1] == y[k][1] and at(x, k) == at(y, k)}
        left, right = ([k for k in range(len(s)) if k not in same] for s in (x, y))
        lost, new = [], list(right)
        for k in left:
            match = next((j for j in new if y[j][1] == x[k][1]), None)
            if match is None:
                lost.append(k)
            else:
                new.remove(match)
                out.append((file, k, "moved", x[k][0]))
        for k in sorted({*lost, *new}):
            state = "extra" if k not in lost else "changed" if k in new else "missing"
            out.append((file, k, state, (x[k] if k in lost else y[k])[0]))
    return sorted(out, key=str)


def by_file(spark, folder):
    files = defaultdict(list)
    for r in sorted(warc.read_warc(spark, folder).collect(), key=lambda r: (r.file, r.ordinal)):
        files[r.file].append((r.page_id, bytes(r.content)))
    return files


@pytest.mark.parametrize("fanout", [2, 4, 16])
def test_audit_finds_all_damage(spark, smallest, fanout):
    """Changed, truncated, lost and new records, on real files and in the order of all states."""
    folder = put(spark, warc.records(odd_pages(spark, smallest).repartition(3), 12))
    replica = f"{folder}-replica"
    warc.write_damaged(spark, folder, replica)
    a, b = by_file(spark, folder), by_file(spark, replica)
    trees = [warc.tree(warc.read_warc(spark, f), n, fanout) for f, n in ((folder, "a"), (replica, "b"))]
    for x, y, p, q in ((a, b, *trees), (b, a, *reversed(trees))):
        found = warc.audit(p, q, fanout).collect()
        assert sorted(((r.file, r.ordinal, r.state, r.page_id) for r in found), key=str) == differences(x, y)
        assert {r.state for r in found} == {"changed", "moved", "missing", "extra"}


def test_audit_reads_only_below_differing_nodes(spark, smallest):
    archive = warc.read_warc(spark, put(spark, warc.records(
        spark.read.parquet(f"{smallest}/pages.parquet").repartition(1), 30)))
    changed = archive.withColumn("content", F.when(
        F.expr("file = 1 AND ordinal = 17"), F.concat(F.substring("content", 1, 300), F.lit(b"x"), F.expr(
            "substring(content, 302)"))).otherwise(F.col("content")))
    found = warc.audit(warc.tree(archive, "c", 4), warc.tree(changed, "d", 4), 4).collect()
    assert [(r.file, r.ordinal, r.state) for r in found] == [(1, 17, "changed")]


def test_damaged_archive_file_is_read_whole():
    data = (b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
            b"WARC/1.1\r\nContent-Length: 9\r\n\r\nab\r\n\r\n")
    assert list(warc._cut(data)) == [(0, 37, 33), (37, 37, 37)]
    assert list(warc._cut(b"junk")) == [(0, 4, 4)]


def test_empty_archive(spark):
    rows = spark.createDataFrame([], "file long, ordinal long, offset long, length long, page_id long,"
                                     " content binary")
    assert warc.audit(warc.tree(rows, "a"), warc.tree(rows, "b")).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = f"{spark.conf.get('spark.checkpoint.dir')}/none-{uuid.uuid4().hex}"
    pages.write.parquet(f"{path}/pages.parquet")
    assert warc.op8_warc(spark, path).count() == 0


# pipeline

def test_pipeline(spark, smallest):
    docs = H.documents(spark, smallest)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, smallest)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert after.columns == docs.columns, name
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{uuid.uuid4().hex}"
        after.write.parquet(path)
        docs = spark.read.parquet(path)
    whole = corpus_pipeline.run(spark, smallest)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(key).collect())) == sorted(
        map(tuple, docs.select(key).collect()))


def test_pipeline_awkward(spark):
    for table in (H.awkward(spark), H.empty(spark)):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, table, "").count()
            docs = stage(spark, docs, "")
        docs.count()


@pytest.mark.parametrize("most_nodes", [1, 40, 1 << 20])
def test_spanning_links_connect_the_same(spark, most_nodes):
    """Repeated links, links of a node to itself, a dense group, none: whatever a task keeps at once."""
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(-150, 150, (160, 2))]
    pairs += [(a, b) for a in range(500, 530) for b in range(a, 530)] * 2
    links = spark.createDataFrame(pairs, "a bigint, b bigint").repartition(6)
    kept = [(r.a, r.b) for r in graph.spanning(links, most_nodes).collect()]
    assert len(kept) == len(set(kept)) and all(a > b for a, b in kept)

    def groups(found):
        root = {}

        def top(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for a, b in found:
            root[max(top(a), top(b))] = min(top(a), top(b))
        return {x: top(x) for x in root if x != top(x)}

    assert groups(kept) == groups(pairs)
    assert graph.spanning(links.filter("false"), most_nodes).count() == 0


def plain_shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def alike(a, b, percent=80):
    both = len(a & b)
    return a == b or 100 * both >= percent * (len(a) + len(b) - both)


def planted_edits(rng, base, most):
    """The text with some of its words replaced."""
    words = base.split()
    for k in rng.sample(range(len(words)), rng.randint(1, most)):
        words[k] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_near_duplicate_stage_acts_from_similarity_080(spark, smallest):
    """Against the exact five-word similarity of all pairs, most of them close to 0.8."""
    rng = random.Random(8)
    texts = [r.text for r in H.documents(spark, smallest).orderBy("doc_id").limit(40).collect()]
    texts += [planted_edits(rng, t, max(1, len(t.split()) // 30)) for t in texts for _ in range(6)]
    rows = list(enumerate(texts)) + [(900, None), (901, " "), (902, "a b"), (903, "A b"), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = [plain_shingles(t) for _, t in rows]
    near = [(i, j) for i in range(len(sets)) for j in range(i, len(sets)) if alike(sets[i], sets[j])]
    assert sum(alike(sets[i], sets[j]) and not alike(sets[i], sets[j], 90) for i, j in near) > 50
    leaders = {rows[root][0] for root in roots(near).values()}
    kept = corpus_pipeline.near_duplicates(spark, docs, smallest)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(leaders)


def test_near_duplicate_candidates_share_a_simhash_fingerprint():
    """The fingerprints against plain sums; the keys are fingerprints without a segment."""
    found = shingles.shingle_set(" ".join(f"x{k}" for k in range(700)), 5)
    prints, size = shingles.fingerprints(found), shingles.PRINTS
    cuts = [round(k * 64 / shingles.SEGMENTS) for k in range(shingles.SEGMENTS + 1)]
    for r in range(size):
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            xor, odd = (int(seeds[n * size + r]) for seeds in (shingles._XOR, shingles._ODD))
            weights = [((((h ^ xor) * odd % 2 ** 64) >> 11) + 1) ** -4 for h in found.tolist()]
            for bit in range(a, b):
                signed = sum(w if h >> bit & 1 else -w for h, w in zip(found.tolist(), weights))
                assert (signed > 0) == bool(int(prints[r]) >> bit & 1)
    assert not shingles.fingerprints(found[:0]).any() and shingles.print_keys(found[:0]) == []
    assert len(set(shingles.print_keys(found))) == size * shingles.SEGMENTS


def test_fingerprints_meet_from_similarity_080():
    """Sets of similarity 0.8 share a key, and a fingerprint within a segment; others rarely."""
    rng = np.random.default_rng(12)
    met = {0.8: 0, 0.1: 0}
    for similarity in met:
        for size in (10, 30, 100, 300) * 100:
            values = rng.integers(0, 1 << 64, size, dtype=np.uint64)
            own = round(size * (1 - similarity)) // 2
            a, b = np.sort(values[own:]), np.sort(values[:size - own])
            shared = set(shingles.print_keys(a)) & set(shingles.print_keys(b))
            differing = [sum(x & ~m != 0 for m in shingles._LEFT_OUT.tolist())
                         for x in (shingles.fingerprints(a) ^ shingles.fingerprints(b)).tolist()]
            assert bool(shared) == (min(differing) <= 1)
            met[similarity] += bool(shared)
    assert met[0.8] == 400 and met[0.1] < 8


@pytest.mark.parametrize("members", [3, 256])
def test_large_buckets_are_compared_whole(spark, monkeypatch, members):
    """Whatever the size of a piece of a bucket, the same rows stay."""
    rng = random.Random(9)
    base = " ".join(f"v{k}" for k in range(120))
    texts = [planted_edits(rng, base, 4) for _ in range(60)]
    sets = [plain_shingles(t) for t in texts]
    monkeypatch.setattr(shingles, "PIECE_MEMBERS", members)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near = [(i, j) for i in range(60) for j in range(i, 60) if alike(sets[i], sets[j])]
    kept = shingles.keep_leaders(docs, 5, 80)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots(near).values()))


def test_prints_see_the_opening(spark, smallest):
    """Texts that differ only in their first twentieth have other fingerprints, and every step can be
    drawn."""
    texts = [r.text for r in H.documents(spark, smallest).limit(60).collect() if len(r.text) > 400]
    opened = [t[len(t) // 20 - 1::-1] + t[len(t) // 20:] for t in texts]
    first = [chr(0x4e00 + k) + t[1:] for k, t in enumerate(texts)]
    own, other = editprint.fingerprints(texts), editprint.fingerprints(opened)
    assert all(a != b and editprint.likeness(a, b) < 1 for a, b in zip(own, other))
    assert sum(a != b for a, b in zip(own, editprint.fingerprints(first))) > 0.8 * len(texts)
    drawn = {int(2.0 ** o * (1 + s)) for o in range(editprint._FIRST_OCTAVE, 4)
             for s in editprint._SHARES[o]}
    assert drawn == set(range(16))
