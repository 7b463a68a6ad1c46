"""BPE encoding by a depth-first walk over a trie of distinct words.

The encoding of a prefix is determined by its last token: token ``t`` ends the
encoding of ``w[:i]`` iff it is a suffix of ``w[:i]``, stands for itself, and
never merges across its border with the last token of ``w[:i - len(t)]``.  So
one last token per trie node holds all encodings, and a prefix that many words
share is worked out once.

Texts are cut into words as the tokenizer file's normalizer and pre-tokenizer do
it, the trie encodes the distinct words.  Each worker keeps a bounded memo.

Defined cases: a null text is empty; an empty text has no ids and decodes to
the empty string; repeated rows give repeated results; strings of special tokens
in a text become their ids, as the library does; only doc_id and text are read.
"""
from __future__ import annotations

import hashlib
from array import array
from struct import pack
from collections.abc import Iterable

from pyspark.sql import DataFrame

from .chunks import Splitter
from .common import map_rows

#: Words memoised by a worker at most (about 200 bytes each); the memo starts anew then.
MEMO_WORDS = 300_000
#: Words learnt or ids decoded at once.
PART = 200_000


class TrieEncoder:
    """Encodes sets of byte-level words; ``suffix`` marks a word's last symbol."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.inner: dict[str, int] = {}
        self.ends: dict[str, int] = {}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        for k, (a, b) in enumerate(merges):
            pair, made = (vocab[a], vocab[b]), vocab[a + b]
            self.rank.setdefault(pair, k)
            if made not in self.parts:
                self.parts[made], self.born[made] = pair, k
        self.longest = max(map(len, vocab))
        self._right: dict[int, list] = {}
        self._left: dict[int, list] = {}
        self._fits: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens that stand at one edge of ``token`` while it is built, with the
        rank of the merge that consumes each."""
        held = (self._left, self._right)[side]
        if token not in held:
            chain, until, t = [], float("inf"), token
            while True:
                chain.append((t, until))
                if t not in self.parts:
                    break
                until, t = self.born[t], self.parts[t][side]
            held[token] = chain
        return held[token]

    def fits(self, a: int, b: int) -> bool:
        """Whether no merge ever happens across the border between a and b.  Of
        merges of one rank the leftmost comes first: a piece of ``a`` that is
        consumed at that rank is gone, one of ``b`` is still there."""
        return self._first_across(a, b) == float("inf")

    def whole(self, token: int) -> bool:
        """Whether the token is reached when its own text is encoded."""
        known = self._whole.get(token)
        if known is None:
            parts = self.parts.get(token)
            known = True
            if parts is not None:
                a, b = parts
                known = self.whole(a) and self.whole(b) and self._first_across(a, b) == self.born[token]
            self._whole[token] = known
        return known

    def _first_across(self, a: int, b: int) -> float:
        return min((k for x, x_until in self._edge(a, 1) for y, y_until in self._edge(b, 0)
                    if (k := self.rank.get((x, y))) is not None and k < x_until and k <= y_until),
                   default=float("inf"))

    def encode(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids (little-endian uint32) of every word.  Sorted, the distinct words are the trie in
        depth-first order: ``last`` and ``start`` hold the state of every node on
        the path from the root, and a word computes only the nodes below the
        prefix that it shares with the one before it.  (A word's final symbol,
        which carries the end mark, is a leaf of its own.)"""
        if not self.inner:
            self._tables()
        inner, ends, known, longest = self.inner, self.ends, self._fits, self.longest
        out: dict[str, bytes] = {}
        last, start, before = [0], [0], ""
        for w in sorted(set(words)):
            n, k = len(w), 0
            most = min(n, len(before)) - 1
            while k < most and w[k] == before[k]:
                k += 1
            del last[k + 1:], start[k + 1:]
            for i in range(k + 1, n + 1):
                tokens = inner if i < n else ends
                for j in range(max(0, i - longest), i):
                    t = tokens.get(w[j:i])
                    if t is None:
                        continue
                    if j:
                        pair = last[j] << 32 | t
                        fits = known.get(pair)
                        if fits is None:
                            fits = known[pair] = self.fits(last[j], t)
                        if not fits:
                            continue
                    last.append(t)
                    start.append(j)
                    break
                else:
                    raise ValueError(f"a symbol of {w!r} is not in the vocabulary")
            ids, i = [], n
            while i:
                ids.append(last[i])
                i = start[i]
            ids.reverse()
            out[w] = pack(f"<{len(ids)}I", *ids)
            before = w
        return out

    def _tables(self) -> None:
        """Text to token, inside a word and at its end, of tokens that stand for themselves."""
        for s, t in self.vocab.items():
            if self.suffix and s.endswith(self.suffix) and len(s) > len(self.suffix):
                if self.whole(t):
                    self.ends[s[:-len(self.suffix)]] = t
            elif self.whole(t):
                self.inner[s] = t
        if not self.suffix:
            self.ends = self.inner


class ChunkCodec:
    """Ids of texts by one tokenizer file."""

    def __init__(self, path: str, memo: int = MEMO_WORDS):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.split = Splitter(library)
        said, model = self.split.said, self.split.said["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("only plain BPE files are supported")
        if said.get("decoder") is not None or model.get("continuing_subword_prefix"):
            raise ValueError("files with a decoder or a subword prefix are not supported")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.trie = TrieEncoder(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        by_id = {i: s for s, i in {**model["vocab"], **self.split.special}.items()}
        self.strings = [by_id.get(i, "") for i in range(max(by_id) + 1)]
        self.memo: dict = {}
        self.limit = memo

    def learn(self, units: set) -> None:
        """Put units that are new into the memo, by one trie over their words."""
        new = {u for u in units if u not in self.memo}
        if len(self.memo) + len(new) > self.limit:
            self.memo, new = {}, units
        words = {u: self.split.words(u) for u in new}
        coded = self.trie.encode({w for ws in words.values() for w in ws if w.__class__ is str})
        for u, ws in words.items():
            self.memo[u] = b"".join([coded[w] if w.__class__ is str else pack("<I", w) for w in ws])

    def code(self, texts: list[bytes]) -> Iterable[list[bytes]]:
        """Ids (little-endian uint32) of every text, as the pieces of its units in
        order.  Many short texts are learnt at once, a long one in parts."""
        held: list[list] = []
        n = 0
        for text in texts:
            held.append(self.split.units(text))
            n += len(held[-1])
            if n >= PART:
                yield from self._coded(held)
                held, n = [], 0
        yield from self._coded(held)

    def _coded(self, held: list[list]) -> Iterable[list[bytes]]:
        if len(held) > 1:
            self.learn({u for units in held for u in units})
        for units in held:
            out: list[bytes] = []
            for k in range(0, len(units), PART):
                part = units[k:k + PART]
                if len(held) == 1:
                    self.learn(set(part))
                out += map(self.memo.__getitem__, part)
            yield out

    def decoded(self, ids: array) -> str:
        """What the library's decode gives without a decoder: the token strings,
        joined by spaces."""
        return " ".join(map(self.strings.__getitem__, ids))


_codecs: dict[str, ChunkCodec] = {}


def codec(path: str) -> ChunkCodec:
    """One codec per worker process and file."""
    if path not in _codecs:
        _codecs[path] = ChunkCodec(path)
    return _codecs[path]


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids array<int>, decoded string of every row."""
    def rows(batches):
        c = codec(tokenizer)
        for doc_ids, texts in batches_of(batches):
            for doc_id, got in zip(doc_ids, c.code(texts)):
                ids = array("I", b"".join(got))
                yield doc_id, ids.tolist(), c.decoded(ids)

    return map_rows(_texts(docs), "doc_id bigint, ids array<int>, decoded string", rows, chunk=64)


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what ``encode_decode`` gives,
    digested where it is made so that the ids need not leave the task."""
    def rows(batches):
        c = codec(tokenizer)
        for doc_ids, texts in batches_of(batches):
            for doc_id, got in zip(doc_ids, c.code(texts)):
                raw = b"".join(got)
                ids, said = array("I", raw), hashlib.sha256()
                for k in range(0, len(ids), PART):
                    said.update((" " * bool(k) + c.decoded(ids[k:k + PART])).encode())
                yield doc_id, len(ids), hashlib.sha256(raw).hexdigest(), said.hexdigest()

    return map_rows(_texts(docs), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", rows)


def batches_of(batches, size: int = 4 << 20):
    """(doc_ids, texts as bytes) of slices of about ``size`` bytes."""
    for b in batches:
        ids, texts, n = [], [], 0
        for doc_id, text in zip(b["doc_id"], b["text"]):
            ids.append(doc_id.as_py())
            texts.append(text.as_py() or b"")
            n += len(texts[-1])
            if n >= size:
                yield ids, texts
                ids, texts, n = [], [], 0
        if ids:
            yield ids, texts


def _texts(docs: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
