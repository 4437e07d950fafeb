"""Sum-of-squares packing of documents into sequences of a fixed number of tokens.

Each piece goes where the sum of N(g)^2 over all gaps g becomes smallest, N(g) being the number of
open sequences with g tokens left: into an open sequence with some gap, or into a new one. This
keeps a supply of many different gaps instead of many equal ones.

Pieces are dealt to groups of bounded size by a hash, longest first within a group, so that small
ones close the gaps that long ones leave. What is left open then goes through further rounds, in
which the pieces of the emptiest sequences of all groups are packed anew, in fewer groups.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..plans.stages import stored
from .text import pieces as cut_batch, spare

SEQUENCE, SEPARATOR = 4096, 1
#: Tokens of one group: it has about 8,000 sequences, and its pieces are some tens of MB.
GROUP_TOKENS = 32 << 20
#: Pieces of one group, since many may have a token each; a task places them in some seconds.
GROUP_PIECES = 1 << 18
#: Words and marks whose ids a worker keeps, about 130 MB; it has them until it ends, whatever it
#: does next. Longer ones are not kept.
_KNOWN_WORDS, _KNOWN_CHARS = 600_000, 64

# Texts of Latin letters, digits and ASCII marks only: lower case, blanks and the tokenizer's own cut
# are the same in Python there. Any other character, and special tokens, send a text to it whole.
_ASCII_PLAIN = bytes([*b"\t\n\x0b\x0c\r", *range(0x20, 0x7f)])
_OTHER = re.compile("[^\t\n\x0b\x0c\r\x20-\x7e\xa0-\u024f]")
_LETTERS, _NUMBERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe"
_CUT = re.compile(
    f"[{_LETTERS}]+|[{_NUMBERS}]|'(?:s|t|re|ve|m|ll|d)|[^\\s{_LETTERS}{_NUMBERS}]+")


#: The settings of a tokenizer file that the cut above stands for; texts of any other go to it whole.
_CUT_LIKE = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {
            "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None, "truncation": None, "padding": None,
}


def _cuts_alike(tokenizer) -> bool:
    """Whether the ids of what stands between blanks make up those of a text: the settings are known,
    no merge crosses a cut, and only texts with ``<|`` can hold a special token."""
    spec = json.loads(tokenizer.to_str())
    return all(spec.get(k) == v for k, v in _CUT_LIKE.items()) and all(
        "<|" in t["content"] for t in spec["added_tokens"]) and not spec["model"].get("dropout")


def _lowered(text: str) -> str | None:
    """The text in lower case; none where the cut above may not be the tokenizer's."""
    if "<|" in text:
        return None
    lowered = text.lower()
    if text.isascii():
        return None if text.encode().translate(None, _ASCII_PLAIN) else lowered
    # some letters in the range leave it in lower case
    return None if _OTHER.search(text) or _OTHER.search(lowered) else lowered


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in a byte-level vocabulary: their own, if printable, and
    those from 256 on for the others."""
    own = {*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(others)}


class _Known(dict):
    """Ids, as bytes, by what the cut leaves; the tokenizer's model gives those that are not here."""

    def __init__(self, model):
        self.tokenize, self.letters = model.tokenize, _byte_letters()

    def __missing__(self, part: str) -> bytes:
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(
            self.letters)
        found = [token.id for token in self.tokenize(letters)]
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        if len(part) <= _KNOWN_CHARS:
            self[part] = ids
        return ids


class Encoder:
    """Token ids of texts, the same as the tokenizer's.

    It merges only within what its cut leaves, so the ids of these words and marks come from its
    model, once each, and are kept for the next time; a full cache is emptied. A tokenizer that cuts
    otherwise gets every text whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cuts_alike = _cuts_alike(self.tokenizer)
        self.known = _Known(self.tokenizer.model)

    def _ids(self, text: str) -> np.ndarray:
        lowered = _lowered(text) if self.cuts_alike else None
        if lowered is None:
            return np.array(
                self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.frombuffer(
            b"".join(map(self.known.__getitem__, _CUT.findall(lowered))), dtype="<u4")

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Little-endian unsigned 32-bit ids of each text."""
        return [self._ids(text) for text in texts]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_pieces(docs: DataFrame, tokenizer: str, with_ids: bool = False,
                 longest: int = SEQUENCE) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, on request, ``ids`` for each piece.

    A document is its text's ids (null: none) and then id 1, so that an empty one has one token. It
    is cut into pieces of ``longest`` tokens, the last one shorter. Repeated rows are pieces of
    their own, also under one id or none.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<bigint>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([SEPARATOR], dtype="<u4")
        for batch in (part for whole in batches for part in cut_batch(whole, 2 << 20)):
            row, number, start, length, crc, ids = [], [], [], [], [], []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, own_ids in enumerate(encode(texts)):
                all_ids = np.concatenate((own_ids, end))
                for n, at in enumerate(range(0, len(all_ids), longest)):
                    own = all_ids[at:at + longest]
                    row.append(i)
                    number.append(n)
                    start.append(at)
                    length.append(len(own))
                    crc.append(zlib.crc32(own.tobytes()))
                    if with_ids:
                        ids.append(own.astype(np.int64))
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64())),
                       pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def place(lengths: np.ndarray, size: int) -> np.ndarray:
    """The sequence (0, 1, ...) of each piece, placed in the given order."""
    count = np.zeros(size + 1, dtype=np.int64)  # open sequences by gap; 0 and ``size`` stay zero
    open_by_gap: list[list[int]] = [[] for _ in range(size + 1)]
    where, sequences = np.empty(len(lengths), dtype=np.int64), 0
    for k, length in enumerate(lengths.tolist()):
        if length == size:
            where[k], sequences = sequences, sequences + 1
            continue
        # half the change of the sum of squares: a gap g becomes g - length; a filled sequence
        # leaves the sum, a new one had no gap before
        change = 1 - count[length:size]
        change[1:] += count[1:size - length]
        change[0] *= 2
        change[0] -= 1
        change[1:] *= 2
        change[count[length:size] == 0] = np.iinfo(np.int64).max
        best = int(change.argmin()) if len(change) else 0
        fresh = 2 * int(count[size - length]) + 1
        if len(change) and change[best] <= fresh:
            gap = best + length
            at = open_by_gap[gap].pop()
            count[gap] -= 1
        else:
            gap, at, sequences = size, sequences, sequences + 1
        where[k] = at
        if gap > length:
            open_by_gap[gap - length].append(at)
            count[gap - length] += 1
    return where


def _pack_groups(items: DataFrame, groups: int, size: int) -> DataFrame:
    """``items (key, length)`` with ``sequence_id``, ``offset`` and ``used``; ids are unique over
    all groups."""

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "key"], ascending=[False, True], kind="stable")
        rows["sequence_id"] = place(rows["length"].to_numpy(), size)
        within = rows.groupby("sequence_id", sort=False)["length"]
        rows["offset"] = within.cumsum() - rows["length"]
        rows["used"] = within.transform("sum")
        rows["sequence_id"] = rows["sequence_id"] * groups + key[0]
        return rows[["key", "length", "sequence_id", "offset", "used"]]

    dealt = items.withColumn("dealt", F.expr(f"pmod(xxhash64(key), {groups})"))
    return dealt.groupBy("dealt").applyInPandas(
        pack, "key bigint, length bigint, sequence_id bigint, offset bigint, used bigint")


def pack(pieces: DataFrame, size: int = SEQUENCE, group_tokens: int = GROUP_TOKENS,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` (any number) and ``offset``: gapless from 0, each sequence at
    most ``size`` tokens. ``pieces`` needs a ``length`` from 1 to ``size``; an empty table gives an
    empty result. Columns that are called ``sequence_id`` or ``offset`` already are replaced.

    Every round packs all items of groups of about ``group_tokens`` tokens, and ``group_pieces``
    pieces at most on average; sequences it leaves less
    than nearly full go to the next round with all groups' others. The last round has one group of
    bounded size.
    """
    own = spare([*pieces.columns, "key", "sequence_id", "offset"], "number")
    numbered = stored(pieces.withColumn(own, F.monotonically_increasing_id()), "pieces")
    todo = numbered.select(F.col(own).alias("key"), "length")
    done, first = None, 0
    while True:
        total, rows = todo.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
        groups = max(-(-total // group_tokens), -(-rows // group_pieces), 1)
        placed = stored(_pack_groups(todo, groups, size), "packed").withColumn(
            "sequence_id", F.col("sequence_id") + first)
        # one group has nothing to share with others
        again = placed.filter(f"used < {size - size // 128}") if groups > 1 else placed.limit(0)
        ready = placed.filter(f"used >= {size - size // 128}") if groups > 1 else placed
        ready = ready.select("key", "sequence_id", "offset")
        done = ready if done is None else done.unionByName(ready)
        if groups == 1:
            break
        first += (placed.agg(F.max("sequence_id")).first()[0] or 0) + 1
        rest = again.agg(F.sum("length")).first()[0] or 0
        if not rest:
            break
        if rest > total // 2:  # no use in another round: keep what is placed
            done = done.unionByName(again.select("key", "sequence_id", "offset"))
            break
        todo = again.select("key", "length")
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    return numbered.select(*kept, own).join(done.withColumnRenamed("key", own), own).select(
        *kept, "sequence_id", "offset")


def op2_pack(spark, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
