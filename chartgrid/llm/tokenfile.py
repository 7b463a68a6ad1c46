"""Token-id files: one zstandard frame per document, and a trailing seek table.

Layout of a shard (documents in ascending doc_id order)::

    frame 0 | frame 1 | ... | skippable frame: index | skippable frame: seek table

Each frame holds one document's ids (little-endian, ``width`` bytes each).  The
seek table is the public zstandard seekable format: compressed size,
decompressed size and XXH64 checksum (low 32 bits) of every frame, then the
footer.  The index frame has the width and the doc_ids, so a reader fetches and
decompresses only the documents that it wants.

Writing: rows are range-partitioned by doc_id, and each task writes its shard
under a name of its own attempt; a manifest, written as a table, names the
shards that count, so a retried or speculative task leaves at most an unnamed
file.

Defined cases: a null text is empty (its frame holds the end id alone); rows
with a null doc_id come first; rows with equal doc_ids stay separate documents,
ordered by their text's hash; an empty table writes no shard.
"""
from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from urllib.parse import urlparse

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .chunks import Splitter
from .common import keep, map_rows

# Fixed values of the public zstandard seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

LEVEL = 3


def _open(uri: str, mode: str):
    """A binary stream of a local path or of any store that Arrow can reach."""
    url = urlparse(uri)
    if url.scheme in ("", "file"):
        return open(url.path if url.scheme else uri, mode)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    return store.open_output_stream(path) if "w" in mode else store.open_input_file(path)


def _make_folder(uri: str) -> None:
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    store.create_dir(path, recursive=True)


class ShardWriter:
    """Appends documents to one file; ``close`` adds the index and the seek table."""

    def __init__(self, uri: str, width: int, level: int = LEVEL):
        import xxhash
        import zstandard

        self.file, self.width = _open(uri, "wb"), width
        self.pack = zstandard.ZstdCompressor(level=level)
        self.sum = xxhash.xxh64_intdigest
        self.entries, self.ids, self.null, self.tokens = bytearray(), bytearray(), bytearray(), 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        raw = ids.astype(f"<u{self.width}").tobytes()
        frame = self.pack.compress(raw)
        self.file.write(frame)
        self.entries += struct.pack("<III", len(frame), len(raw), self.sum(raw) & 0xFFFFFFFF)
        self.ids += struct.pack("<q", doc_id or 0)
        self.null.append(doc_id is None)
        self.tokens += len(ids)

    def close(self) -> None:
        n = len(self.null)
        index = struct.pack("<BI", self.width, n) + self.ids + self.null
        self.file.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        seek = bytes(self.entries) + struct.pack("<IBI", n, HAS_CHECKSUMS, SEEKABLE_MAGIC)
        self.file.write(struct.pack("<II", SKIPPABLE_SEEK, len(seek)) + seek)
        self.file.close()


class ShardReader:
    """Reads chosen documents of a shard; every checksum is verified."""

    def __init__(self, uri: str):
        import zstandard

        self.file = _open(uri, "rb")
        size = self.file.seek(0, 2) or self.file.tell()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError(f"{uri}: no seek table with checksums")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3)
        self.sizes, self.raw, self.sums = table.T
        self.starts = np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)])
        head = int(self.starts[-1])
        kind, length = struct.unpack("<II", self._at(head, 8))
        index = self._at(head + 8, length)
        self.width, count = struct.unpack_from("<BI", index)
        if kind != SKIPPABLE_INDEX or count != n:
            raise ValueError(f"{uri}: the index does not match the seek table")
        self.ids, self.null = np.frombuffer(index, "<i8", n, 5), np.frombuffer(index, "u1", n, 5 + 8 * n)
        self.unpack = zstandard.ZstdDecompressor()

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    def document(self, k: int) -> np.ndarray:
        import xxhash

        raw = self.unpack.decompress(self._at(int(self.starts[k]), int(self.sizes[k])),
                                     max_output_size=max(1, int(self.raw[k])))
        if len(raw) != self.raw[k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k}: wrong checksum")
        return np.frombuffer(raw, f"<u{self.width}")

    def read(self, doc_ids: Iterable[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
        wanted = range(len(self.ids)) if doc_ids is None else np.flatnonzero(
            np.isin(self.ids, list(doc_ids)) & (self.null == 0))
        for k in wanted:
            yield (None if self.null[k] else int(self.ids[k])), self.document(int(k))

    def close(self) -> None:
        self.file.close()


class WordMemo(dict):
    """Ids of units (see ``Splitter``) as bytes; a missing unit is encoded once.  A full
    memo starts again."""

    MOST = 800_000

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, unit) -> bytes:
        if len(self) >= self.MOST:
            self.clear()
        ids = self[unit] = array("I", self.encode(unit)).tobytes()
        return ids


class LibraryIds:
    """Ids by the tokenizers library.  Texts are cut into words as the file's
    normalizer and pre-tokenizer do it; the library's model encodes each new word, and
    a bounded memo keeps the words that were encoded."""

    PART = 1 << 20          # bytes of a text that are cut at once

    def __init__(self, path: str):
        # Spark spreads the work; threads of the library's own would only add to it
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        self.split, model = Splitter(whole), whole.model

        def encode(unit) -> list[int]:
            if unit.__class__ is str and unit.isascii() and unit.isprintable():
                return [t.id for t in model.tokenize(unit)]
            return [i for w in self.split.words(unit)
                    for i in ([t.id for t in model.tokenize(w)] if w.__class__ is str else [w])]

        self.memo = WordMemo(encode)

    def __call__(self, text: bytes) -> np.ndarray:
        out: list[bytes] = []
        for part in parts_of(text, self.PART):
            out += map(self.memo.__getitem__, self.split.units(part))
        return np.frombuffer(b"".join(out), "<u4")


_BREAK = re.compile(rb"[ \n]")


def parts_of(text: bytes, size: int) -> Iterator[bytes]:
    """The text in parts of ``size`` bytes or somewhat more; no unit spans ASCII white
    space, so a part ends before some (a run without any stays whole)."""
    at = 0
    while len(text) - at > size:
        found = _BREAK.search(text, at + size)
        to = found.start() if found else len(text)
        yield text[at:to]
        at = to
    yield text[at:]


_encoders: dict[str, LibraryIds] = {}


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int, width: int = 2) -> DataFrame:
    """Writes the shards below ``folder``; the manifest has a row per shard:
    shard (their order is the documents' order), path, n_docs, n_tokens."""
    _make_folder(folder)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    ordered = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))
               .repartitionByRange("doc_id", "th").sortWithinPartitions("doc_id", "th").select("doc_id", "text"))

    def rows(batches):
        encode = _encoders.setdefault(tokenizer, None) or LibraryIds(tokenizer)
        _encoders[tokenizer] = encode
        shard, out, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            for doc_id, body in zip(b["doc_id"], b["text"]):
                if out is None:
                    path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex[:8]}.zst"
                    out = ShardWriter(path, width)
                ids = encode(body.as_py())
                if len(ids) and int(ids.max()) >= 1 << 8 * width:
                    raise ValueError(f"an id does not fit {width} bytes")
                out.add(doc_id.as_py(), np.append(ids, np.uint32(end_id)))
                n += 1
        if out is not None:
            out.close()
            yield shard, path, n, out.tokens

    return keep(map_rows(ordered, "shard int, path string, n_docs bigint, n_tokens bigint", rows), "token-manifest")


def read_token_files(manifest: DataFrame, per_document) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, and
    ``per_document(ids)`` (a long) of every document, read back from the shards."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard: the running sum over them is small
    shards = manifest.withColumn("offset", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("bigint")))
    # a given number of ranges is kept, so as many tasks as there are shards read them
    n = max(1, manifest.count())
    shards = shards.select("shard", "path", "offset").repartitionByRange(n, "shard").select("path", "offset")

    def rows(batches):
        for b in batches:
            for path, offset in zip(b["path"].to_pylist(), b["offset"].to_pylist()):
                shard = ShardReader(path)
                for doc_id, ids in shard.read():
                    yield doc_id, offset, len(ids), per_document(ids)
                    offset += len(ids)
                shard.close()

    return map_rows(shards, "doc_id bigint, start bigint, n_tokens bigint, digest bigint", rows)


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def new_folder(spark: SparkSession) -> str:
    """A folder for shards beside the other shared files of the session."""
    return scratch_path(spark, "token-shards")
