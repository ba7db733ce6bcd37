"""Operator 5, token ids as one succinct file per shard: a wavelet matrix."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelkit.llm import vocab
from reelkit.llm.common import partitions_of, pieces, shared_path, text_or_empty, texts

# ------------------------------------------------------------------ the file format
# Little-endian.  Head: 4 bytes "WMX1", uint32 bits a token, uint64 tokens.  Then for every bit plane, highest bit
# first: uint64 zeros in it, uint32 bytes that follow, the plane as zstd-compressed packed bits (lowest bit first).

MAGIC = b"WMX1"
_BLOCK = 512


def encode(tokens: np.ndarray) -> bytes:
    """A wavelet matrix of unsigned integers: each plane holds one bit of every token, and the tokens are then
    parted by that bit, stably, for the next plane."""
    cur = np.ascontiguousarray(tokens)
    bits = max(1, int(cur.max()).bit_length()) if len(cur) else 1
    cur = cur.astype(np.uint16 if bits <= 16 else np.uint32)
    pack = zstandard.ZstdCompressor(level=1)
    out = [MAGIC, struct.pack("<IQ", bits, len(cur))]
    for k in range(bits - 1, -1, -1):
        one = (cur >> k & 1).astype(bool)
        plane = pack.compress(np.packbits(one, bitorder="little").tobytes())
        low = cur[~one]
        out += [struct.pack("<QI", len(low), len(plane)), plane]
        cur = np.concatenate([low, cur[one]])
    return b"".join(out)


class WaveletMatrix:
    """Token access, counting and occurrence look-up on one file's bytes, by rank and select over its planes."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        self.bits, self.n = struct.unpack_from("<IQ", data, 4)
        self.zeros, self.planes, self.ranks = [], [], []
        at, unpack = 16, zstandard.ZstdDecompressor()
        size = (self.n + 7) // 8
        for _ in range(self.bits):
            z, length = struct.unpack_from("<QI", data, at)
            at += 12
            plane = np.frombuffer(unpack.decompress(data[at:at + length], max_output_size=max(1, size)), np.uint8)
            at += length
            self.zeros.append(z)
            self.planes.append(plane)
            self.ranks.append(None)

    def _rank_blocks(self, k: int) -> np.ndarray:
        """Ones before each block of a plane; one count for _BLOCK bits, made when first asked for."""
        if self.ranks[k] is None:
            per = np.add.reduceat(np.bitwise_count(self.planes[k]).astype(np.int64),
                                  np.arange(0, max(1, len(self.planes[k])), _BLOCK // 8)) if self.n else np.zeros(0, int)
            self.ranks[k] = np.concatenate([[0], np.cumsum(per)])
        return self.ranks[k]

    def _rank1(self, k: int, i: int) -> int:
        """Ones among the first ``i`` bits of plane k."""
        b = i // _BLOCK
        before = int(self._rank_blocks(k)[b])
        start, full = b * _BLOCK // 8, i // 8
        before += int(np.bitwise_count(self.planes[k][start:full]).sum())
        return before + (int(self.planes[k][full]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else before

    def _bit(self, k: int, i: int) -> int:
        return int(self.planes[k][i // 8]) >> i % 8 & 1

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        v = 0
        for k in range(self.bits):
            b, ones = self._bit(k, i), self._rank1(k, i)
            v = v << 1 | b
            i = self.zeros[k] + ones if b else i - ones
        return v

    def _range(self, token: int, end: int) -> tuple[int, int]:
        lo, hi = 0, end
        for k in range(self.bits):
            a, b = self._rank1(k, lo), self._rank1(k, hi)
            if token >> self.bits - 1 - k & 1:
                lo, hi = self.zeros[k] + a, self.zeros[k] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, token: int, end: int) -> int:
        """Occurrences of a token before position ``end``."""
        if token < 0 or token >> self.bits:
            return 0
        lo, hi = self._range(token, end)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, j: int) -> int:
        """Position of the token's occurrence number ``j`` (from 0)."""
        if not 0 <= j < self.count(token):
            raise IndexError(j)
        i = self._range(token, self.n)[0] + j
        for k in range(self.bits - 1, -1, -1):
            one = token >> self.bits - 1 - k & 1
            want, lo, hi = (i - self.zeros[k] if one else i) + 1, 0, self.n
            while lo < hi:  # least prefix that holds that many such bits
                mid = (lo + hi) // 2
                ones = self._rank1(k, mid)
                lo, hi = (mid + 1, hi) if (ones if one else mid - ones) < want else (lo, mid)
            i = lo - 1
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, j) for j in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """All tokens, planes undone from the lowest: what costs one pass a plane instead of a rank a token and plane."""
        cur = np.zeros(self.n, dtype=np.uint16 if self.bits <= 16 else np.uint32)
        for k in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[k], count=self.n, bitorder="little").astype(bool)
            up = np.empty_like(cur)
            up[~one] = cur[:self.zeros[k]]
            up[one] = cur[self.zeros[k]:] | cur.dtype.type(1 << self.bits - 1 - k)
            cur = up
        return cur


# ------------------------------------------------------------------ the Spark jobs

FILES = "shard long, doc_ids array<long>, lengths array<long>, n_tokens long, matrix binary"
_FILES = pa.schema([("shard", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                    ("n_tokens", pa.int64()), ("matrix", pa.binary())])
#: Tokens of a file; a partition with more writes several, each of whole documents.
FILE_TOKENS = 4_000_000


def _shards(path: str, end_id: int, file_tokens: int):
    def run(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        ids, held, runs = [], 0, []

        def file():
            row = {"shard": [part * 100_000 + number], "doc_ids": [ids], "lengths": [[len(r) for r in runs]],
                   "n_tokens": [held], "matrix": [encode(np.concatenate(runs))]}
            return pa.RecordBatch.from_pydict(row, schema=_FILES)

        end = np.array([end_id], dtype="<u2" if vocab.byte_level(path).kind == "H" else "<u4")
        for batch in batches:
            for some in pieces(batch, "text", 4 << 20):
                for doc, r in zip(some.column("doc_id").to_pylist(), vocab.byte_level(path).ids(texts(some)), strict=True):
                    if held and held + len(r) + 1 > file_tokens:
                        yield file()
                        ids, held, runs, number = [], 0, [], number + 1
                    ids.append(doc)
                    runs.append(np.concatenate([r, end]))
                    held += len(r) + 1
        if runs:
            yield file()
    return run


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2,
                      file_tokens: int = FILE_TOKENS) -> None:
    """Encode every whole text and write wavelet-matrix files, in ascending doc_id order, to the folder ``path``.

    A file is a row of a Parquet table (its matrix one binary value), so that
    any storage Spark writes to will do.  Documents are dealt to as many key
    ranges as the input has partitions; a range's files follow each other by
    shard number.  Null text: empty, only the end id.  Null ids come first.
    Repeated ids: each row stays, ordered by text.  Empty table: no file.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    (rows.repartitionByRange(partitions_of(rows), "doc_id").sortWithinPartitions("doc_id", "text")
         .mapInArrow(_shards(vocabulary, end_id, file_tokens), FILES).write.parquet(path))


def _read(batches):
    for batch in batches:
        for shard, ids, lengths, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_ids", "lengths", "matrix")),
                                             strict=True):
            tokens = WaveletMatrix(data).tokens().astype("<u4")
            at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            crc = [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard] * len(ids), pa.int64()), "doc_id": pa.array(ids, pa.int64()),
                "first": pa.array(at[:-1]), "n_tokens": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})


def read_token_files(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the files, from their planes.

    The table of shards, one short row a file, is summed in shard order to
    place each file; its size is that of the file list.
    """
    files = spark.read.schema(FILES).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("shard", "n_tokens").select(
        "shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long").alias("offset"))
    docs = files.select("shard", "doc_ids", "lengths", "matrix").mapInArrow(
        _read, "shard long, doc_id long, first long, n_tokens long, ids_crc32 long")
    return docs.join(offsets, "shard").select("doc_id", (F.col("offset") + F.col("first")).alias("start"),
                                              "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write the files (to a fresh folder of the shared one, if no path is given) and read them back."""
    path = path or shared_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, vocabulary, end_id)
    return read_token_files(docs.sparkSession, path)
