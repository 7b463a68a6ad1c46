"""Packing: documents' token ids into windows of ``window`` ids, best fit decreasing.

Every document is encoded (an end id closes it) and cut into full windows; what
is left of it, if anything, is one shorter piece.  A full window is a sequence of
its own.  The shorter pieces are dealt into groups of about ``GROUP`` ids each and
packed group by group: longest piece first, each into the open sequence with the
least remaining room that still holds it.  A segment tree over the remaining
capacities finds that room in ``log2(window)`` steps.  Groups are of one size
whatever the input, so more data means more tasks; a group ends with a few
sequences that are not full.

The ids leave the encoding as a column of the piece (or as ``per_piece(ids)``), so
only pieces are shuffled, never texts, and nothing is encoded twice.

A sequence is named by its first piece's number; numbers are unique, not dense.

Defined cases: a null text is empty (its piece is the end id alone); a null doc_id
is a value like any other; rows with one doc_id, equal rows too, are separate
documents; texts are encoded whole, in parts that end before white space (a run
without white space is one part); equal lengths are packed by number; an empty
table gives no rows.  Only doc_id and text are read.
"""
from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import PLAIN_END, byte_symbols
from .common import keep, map_rows

WINDOW = 2048
GROUP = 4_000_000        # ids of a group of pieces that is packed by one task
PART = 1 << 18           # characters that are encoded at once
MOST_PARTS = 600_000     # parts between borders that a worker remembers, longer than words


class _Memo(dict):
    """Ids of words as bytes; a word that is missing is encoded by the library."""

    MOST = 1_000_000        # words, about 0.2 GB

    def __init__(self, encode: Callable[[str], list[int]], most: int = MOST):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        ids = self[word] = array("I", self.encode(word)).tobytes()
        return ids


class ByteLevelIds:
    """Ids of a text by the tokenizers library, for files of byte-level BPE.

    Such files cut texts by one fixed expression.  Plain European letters are cut
    here by the same expression, all other parts by the library's own
    pre-tokenizer; the library's model encodes each new word.  A text with a
    special token's string, or a file of another set-up, goes to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark spreads the work
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        said = json.loads(self.library.to_str())
        pre = said.get("pre_tokenizer") or {}
        self.fast = (said.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex")
                     and not pre.get("add_prefix_space") and said["model"]["type"] == "BPE"
                     and not said["model"].get("dropout"))
        special = [re.escape(t["content"]) for t in said["added_tokens"]]
        self.special = re.compile("|".join(special)).search if special else lambda text: None
        chars = [chr(k) for k in range(PLAIN_END)]
        of = lambda kind: "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == kind)
        letters, digits, space = of("L"), of("N"), "\t\n\x0b\x0c\r \x85\xa0"
        self.words = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?[^{space}{letters}{digits}]+"
                                rf"|[{space}]+(?![^{space}])|[{space}]+").findall
        self.plain = re.compile(rf"[^{chr(PLAIN_END)}-\U0010ffff]*").fullmatch
        # no word spans the border between a character and white space after it
        self.borders = re.compile(r"(?<=\S)(?=[ \n])")
        table = dict(enumerate(byte_symbols()))
        cut, model = self.library.pre_tokenizer, self.library.model
        blank = table[ord(" ")]

        def symbols(word: str) -> str:
            if word.isascii() and word.isprintable():      # all but the space stand for themselves
                return word.replace(" ", blank)
            return word.encode().decode("latin-1").translate(table)

        self.memo = _Memo(lambda w: [t.id for t in model.tokenize(symbols(w))])
        self.parts = _Memo(lambda p: [t.id for w, _ in cut.pre_tokenize_str(p) for t in model.tokenize(w)], MOST_PARTS)

    def _plain_parts(self, text: str):
        at = 0
        while len(text) - at > PART:
            border = self.borders.search(text, at + PART)
            to = border.start() if border else len(text)
            yield text[at:to]
            at = to
        yield text[at:]

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self.fast or self.special(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        out: list[bytes] = []
        for part in self._plain_parts(text):
            if self.plain(part):
                out += map(self.memo.__getitem__, self.words(part))
                continue
            for piece in self.borders.split(part):
                if self.plain(piece):
                    out += map(self.memo.__getitem__, self.words(piece))
                else:
                    out.append(self.parts[piece])
        return b"".join(out)


_encoders: dict[str, ByteLevelIds] = {}


def pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW,
           per_piece: Callable[[bytes], int] | None = None) -> DataFrame:
    """number, doc_id, start, length, doc_tokens and ``piece`` (the ids as little-endian
    unsigned 32-bit integers, or ``per_piece`` of them, a long) of every piece."""
    end = np.array([end_id], "<u4").tobytes()
    rows_of = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def rows(batches):
        encode = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, ByteLevelIds(tokenizer))
        number = TaskContext.get().partitionId() << 36
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                ids, doc_id = encode(text.as_py()) + end, doc_id.as_py()
                for at in range(0, len(ids), 4 * window):
                    own = ids[at:at + 4 * window]
                    yield number, doc_id, at // 4, len(own) // 4, len(ids) // 4, per_piece(own) if per_piece else own
                    number += 1

    return map_rows(rows_of, "number bigint, doc_id bigint, start bigint, length bigint, doc_tokens bigint, "
                    f"piece {'bigint' if per_piece else 'binary'}", rows)


class OpenWindows:
    """Open windows by remaining capacity: a segment tree tells where some are open."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.leaves = 1 << capacity.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of ``length`` or more among the open windows."""
        some, at = self.some, self.leaves + length
        if not some[at]:
            while at > 1 and (at & 1 or not some[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at + (not some[2 * at])
        return at - self.leaves

    def put(self, window: int, remaining: int) -> None:
        self.open[remaining].append(window)
        at = self.leaves + remaining
        while at and not self.some[at]:
            self.some[at] = 1
            at >>= 1

    def take(self, remaining: int) -> int:
        window = self.open[remaining].pop()
        at = self.leaves + remaining
        if not self.open[remaining]:
            self.some[at] = 0
            while at > 1 and not self.some[at ^ 1]:
                at >>= 1
                self.some[at] = 0
        return window


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """(index of the piece that opened the window, offset there) of each length, where
    lengths are descending and at most ``window``."""
    tree, out = OpenWindows(window), []
    for k, length in enumerate(lengths):
        room = tree.tightest(length)
        at = k if room is None else tree.take(room)
        room = window if room is None else room
        out.append((at, window - room))
        if room > length:
            tree.put(at, room - length)
    return out


def pack(cut: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to the rows of ``pieces``, written beforehand."""
    left = cut.filter(F.col("length") < window)
    total = left.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // group))
    dealt = (left.withColumn("dealt", F.pmod(F.xxhash64("number"), F.lit(groups)))
             .repartition("dealt").sortWithinPartitions("dealt", F.desc("length"), "number")
             .select("dealt", "number", "length"))

    def rows(batches):
        held, own = [], None
        for b in batches:
            for dealt, number, length in zip(*(b[c].to_pylist() for c in ("dealt", "number", "length"))):
                if dealt != own and held:
                    yield from placed(held)
                    held = []
                own = dealt
                held.append((number, length))
        yield from placed(held)

    def placed(held):
        for (number, _), (at, offset) in zip(held, best_fit_decreasing([n for _, n in held], window)):
            yield number, held[at][0], offset

    places = map_rows(dealt, "number bigint, sequence_id bigint, offset bigint", rows)
    full = cut.filter(F.col("length") == window).withColumns(
        {"sequence_id": F.col("number"), "offset": F.lit(0).cast("bigint")})
    return full.unionByName(left.join(places, "number")).drop("number")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, group: int = GROUP,
                   per_piece: Callable[[bytes], int] | None = None) -> DataFrame:
    """doc_id, start, length, doc_tokens, piece, sequence_id and offset of every piece."""
    return pack(keep(pieces(docs, tokenizer, end_id, window, per_piece), "packing-pieces"), window, group)
