"""Token ids as independent zstandard frames with a trailing seek table.

File format (one file per id range, documents in ascending id order):

* one frame per document: its token ids, the end id last, as little-endian
  unsigned 32-bit integers;
* a skippable frame (magic 0x184D2A50) with the documents' ids: 9 bytes each,
  a signed 64-bit id and a byte that is 0 for a NULL id;
* the seek table of the public "zstd seekable format": a skippable frame
  (magic 0x184D2A5E) with compressed size, decompressed size and checksum
  (low half of xxh64 of the content) of every frame before it, the id frame
  included (decompressed size 0), then the footer.

Any zstandard decoder can stream such a file; a reader of single documents
reads the table and the wanted frames only.

A file is written under a name of its own attempt and then moved to its final
name, so a task that is run again leaves one whole file.

Defined results: NULL and empty texts are the end id alone; repeated rows are
written one after the other; rows of one id are ordered by text; NULL ids
come first; an empty table writes no file; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .common import partitions, staged

END_ID = 2
CACHE_CHUNKS = 3_000_000
RECENT_CHUNKS = 100_000
LEVEL = 3

# fixed values of the seekable format
ID_MAGIC, TABLE_MAGIC, FOOTER_MAGIC, CHECKSUM_FLAG = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80


class CorruptFrame(ValueError):
    """A frame whose content does not match its checksum."""


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder or file, in any store pyarrow knows."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


# --- encoding -------------------------------------------------------------------

#: White space of the pre-tokenizer's expression beyond ASCII, in UTF-8.
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_encoders: dict[tuple[str, int], Encoder] = {}


class _Known:
    """Chunk hashes with the place, count and byte length of their ids; sorted
    arrays, about 30 bytes a chunk."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        self.place, self.count, self.width = (np.zeros(0, t) for t in (np.int64, np.int32, np.int32))

    def find(self, hashes: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, whether it is there) of each."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, (self.hashes[at] == hashes) & (self.width[at] == width)

    def add(self, hashes, place, count, width) -> None:
        order = np.argsort(joined := np.concatenate([self.hashes, hashes]), kind="stable")
        self.hashes = joined[order]
        for name, more in (("place", place), ("count", count), ("width", width)):
            setattr(self, name, np.concatenate([getattr(self, name), more])[order])


class Encoder:
    """Texts to the bytes of their ids.

    The pre-tokenizer never joins characters across the end of a run of
    non-space characters, so a text is the chain of its chunks (white space
    and the run after it).  The chunks of a run of rows are told apart by
    64-bit hashes (and their length), each distinct one is encoded once, and
    up to CACHE_CHUNKS are kept for later rows.  Rows with white space beyond
    ASCII, or with the string of an added token, are encoded whole.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # the strings of added tokens are found by the library before it parts words
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.whole = re.compile(b"|".join([_WIDE_SPACE.pattern, *map(re.escape, sorted(added))]))
        self.end = np.array([end_id], "<u4").tobytes()
        self._forget()

    def _forget(self) -> None:
        self.known, self.recent = _Known(), _Known()
        self.ids, self.n_ids = np.zeros(1 << 16, np.uint32), 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[str], hashes: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, count) of the new chunks' ids."""
        lists = self._encode(chunks)
        count = np.fromiter(map(len, lists), np.int32, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.uint32, int(count.sum()))
        while self.n_ids + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.n_ids:self.n_ids + len(flat)] = flat
        place = self.n_ids + np.cumsum(count, dtype=np.int64) - count
        self.n_ids += len(flat)
        self.recent.add(hashes, place, count, width)
        if len(self.recent.hashes) > RECENT_CHUNKS:
            r, self.recent = self.recent, _Known()
            self.known.add(r.hashes, r.place, r.count, r.width)
        return place, count

    def _run(self, buf: np.ndarray, rows: np.ndarray) -> Iterator[bytes]:
        raw = buf.tobytes()
        if self.whole.search(raw):
            for ids in self._encode([raw[a:b].decode() for a, b in zip(rows[:-1], rows[1:])]):
                yield np.array(ids, "<u4").tobytes() + self.end
            return
        space = W.SPACE[buf]
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        begin[rows[rows < len(buf)]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(buf)) if len(starts) else starts
        hashes, first, each = np.unique(W.span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        width = (ends[first] - starts[first]).astype(np.int32)
        if len(self.known.hashes) > CACHE_CHUNKS:
            self._forget()
        place, count = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int32)
        new = np.ones(len(hashes), bool)
        for table in (self.known, self.recent):
            at, there = table.find(hashes, width)
            place[there], count[there] = table.place[at[there]], table.count[at[there]]
            new &= ~there
        if new.any():
            chunks = [raw[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            place[new], count[new] = self._learn(chunks, hashes[new], width[new])
        n = count[each]
        to = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        ids = self.ids[np.arange(to[-1]) + np.repeat(place[each] - to[:-1], n)].astype("<u4", copy=False)
        borders = to[np.searchsorted(starts, rows)]
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
            yield ids[a:b].tobytes() + self.end

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text (NULL: of none) and the end id."""
        for _, _, buf, rows in W.runs(texts):
            yield from self._run(buf, rows)


def encoder(path: str, end_id: int) -> Encoder:
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


# --- files ------------------------------------------------------------------------

class FrameWriter:
    def __init__(self, stream):
        import xxhash
        import zstandard
        self.stream, self.hash = stream, xxhash.xxh64_intdigest
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.entries, self.ids = [], []

    def add(self, doc_id: int | None, content: bytes) -> None:
        frame = self.pack(content)
        self.stream.write(frame)
        self.entries.append((len(frame), len(content), self.hash(content) & 0xFFFFFFFF))
        self.ids.append(doc_id)

    def close(self) -> None:
        ids = b"".join(struct.pack("<qB", x or 0, x is not None) for x in self.ids)
        self._skippable(ID_MAGIC, ids)
        self.entries.append((len(ids) + 8, 0, self.hash(b"") & 0xFFFFFFFF))
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        self._skippable(TABLE_MAGIC, table + struct.pack(
            "<IBI", len(self.entries), CHECKSUM_FLAG, FOOTER_MAGIC))
        self.stream.close()

    def _skippable(self, magic: int, payload: bytes) -> None:
        self.stream.write(struct.pack("<II", magic, len(payload)) + payload)


class FrameReader:
    """Random access to one file: ``ids`` and ``content(i)``."""

    def __init__(self, uri: str):
        import xxhash
        import zstandard
        system, path = file_system(uri)
        self.file, self.hash = system.open_input_file(path), xxhash.xxh64_intdigest
        self.unpack = zstandard.ZstdDecompressor().decompress
        size = self.file.size()
        count, flag, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != FOOTER_MAGIC or flag != CHECKSUM_FLAG:
            raise CorruptFrame(f"{uri} has no seek table")
        self.table = np.frombuffer(self._read(size - 9 - 12 * count, 12 * count), "<u4").reshape(-1, 3)
        self.at = np.concatenate([[0], np.cumsum(self.table[:, 0].astype(np.int64))])
        raw = self._read(self.at[count - 1] + 8, int(self.table[-1, 0]) - 8)
        self.ids = [x if has else None for x, has in struct.iter_unpack("<qB", raw)]

    def _read(self, at: int, n: int) -> bytes:
        return self.file.read_at(int(n), int(at))

    def content(self, i: int) -> bytes:
        packed, size, checksum = map(int, self.table[i])
        data = self.unpack(self._read(self.at[i], packed), max_output_size=size)
        if len(data) != size or self.hash(data) & 0xFFFFFFFF != checksum:
            raise CorruptFrame(f"frame {i}: checksum does not match")
        return data

    def tokens(self, doc_id: int) -> np.ndarray:
        """The token ids of one document."""
        return np.frombuffer(self.content(self.ids.index(doc_id)), "<u4")

    def close(self) -> None:
        self.file.close()


# --- Spark ----------------------------------------------------------------------

def write_frames(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = END_ID, files: int | None = None) -> DataFrame:
    """Writes the files and returns (shard, path, n_docs, n_ids), one row per
    file; ``shard`` ascends with the ids.  ``files``: how many id ranges (default: the
    session's shuffle partitions)."""
    n = files or partitions(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(tokenizer, end_id), TaskContext.get().partitionId()
        system, base = file_system(folder)
        final = f"{base}/part-{shard:05d}.zst"
        own, writer, n_ids = f"{base}/_attempt-{uuid.uuid4().hex}", None, 0
        for batch in batches:
            for doc_id, content in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                if writer is None:
                    system.create_dir(base, recursive=True)
                    writer = FrameWriter(system.open_output_stream(own))
                writer.add(doc_id, content)
                n_ids += len(content) // 4
        if writer is None:
            return
        writer.close()
        try:
            system.move(own, final)
        except OSError:      # stores that don't move onto a file that is there
            system.delete_file(final)
            system.move(own, final)
        yield pa.RecordBatch.from_pydict(
            {"shard": [shard], "path": [f"{folder}/part-{shard:05d}.zst"],
             "n_docs": [len(writer.ids)], "n_ids": [n_ids]},
            pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                       ("n_ids", pa.int64())]))

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ranged = src.repartitionByRange(n, "id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    return staged(ranged.mapInArrow(run, "shard int, path string, n_docs long, n_ids long"), "frames")


def read_frames(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(``id_col``, start, n_tokens, ids_crc32, shard, frame) of every document
    in the files, from their content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path, before in zip(*(batch.column(i).to_pylist() for i in range(3))):
                reader = FrameReader(path)
                n, crc = [], []
                for i in range(len(reader.ids)):
                    data = reader.content(i)
                    n.append(len(data) // 4)
                    crc.append(zlib.crc32(data))
                reader.close()
                sizes = np.array(n, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.ids, pa.int64()), pa.array(before + np.cumsum(sizes) - sizes),
                     pa.array(sizes), pa.array(crc, pa.int64()),
                     pa.array(np.full(len(n), shard, np.int32)), pa.array(np.arange(len(n), dtype=np.int32))],
                    [id_col, "start", "n_tokens", "ids_crc32", "shard", "frame"])

    # one row per file: the running sum is over as many rows as there are files
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.select("shard", "path", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("before"))
    return listed.repartition(partitions(files.sparkSession)).mapInArrow(
        run, f"{id_col} long, start long, n_tokens long, ids_crc32 long, shard int, frame int")
