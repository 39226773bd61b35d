"""Token ids on disk: fixed-size blocks turned into planes, each plane compressed with zstandard.

Format: a Parquet table of blocks, one row for each, in id order within a shard. A shard is a range of
doc_ids; shards ascend. ``planes`` holds the compressed planes one after the other, ``plane_sizes`` is
the index into them, ``kind`` says whether a plane is a byte or a bit of every id. Planes of zeros are
stored as nothing. The arrays ``doc_id``, ``doc_start``, ``doc_tokens`` and ``at`` are the index of the
documents that touch the block: first id in the shard, length, and how far the block is into the document.
Spark's writer commits the files, so a lost task leaves nothing behind.

A document may span blocks. Everything that is read back works block by block; checksums of a
document's pieces are combined afterwards, so no task holds more than a block.

Null texts are empty and hold the end id alone. Rows with equal doc_id are ordered by text. A null doc_id
sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from pulsepanel.llm.common import arrow_map
from pulsepanel.llm.word_bpe import ChunkMemo, vocabulary

BLOCK_IDS = 1 << 16
BLOCK_SCHEMA = (
    "shard int, block bigint, n_ids int, kind string, planes binary, plane_sizes array<int>, "
    "doc_id array<bigint>, doc_start array<bigint>, doc_tokens array<bigint>, at array<bigint>"
)


def to_planes(ids: np.ndarray, kind: str = "byte", level: int = 1) -> tuple[bytes, list[int]]:
    """Compressed planes of a block of ids, and their sizes; a plane of zeros has size 0."""
    octets = ids.astype("<u4").view("u1").reshape(-1, 4)
    if kind == "bit":
        bits = np.unpackbits(octets, axis=1, bitorder="little")
        planes = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        planes = np.ascontiguousarray(octets.T)
    pack = zstandard.ZstdCompressor(level=level).compress
    packed = [pack(p.tobytes()) if p.any() else b"" for p in planes]
    return b"".join(packed), [len(p) for p in packed]


def from_planes(planes: bytes, sizes: list[int], n_ids: int, kind: str = "byte") -> np.ndarray:
    """The ids of a block."""
    unpack = zstandard.ZstdDecompressor().decompress
    each = n_ids if kind == "byte" else (n_ids + 7) // 8
    rows, at = np.zeros((len(sizes), each), "u1"), 0
    for row, size in zip(rows, sizes):
        if size:
            row[:] = np.frombuffer(unpack(planes[at : at + size]), "u1")
        at += size
    if kind == "bit":
        bits = np.unpackbits(rows, axis=1, count=n_ids, bitorder="little")
        octets = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        octets = rows.T
    return np.ascontiguousarray(octets).view("<u4").ravel()


_MEMOS: dict[str, ChunkMemo] = {}


def library_ids(path: str) -> ChunkMemo:
    """Texts to ids by the tokenizers library's model, each distinct word once in a while."""
    if path not in _MEMOS:
        vocab = vocabulary(path)
        tokenize = vocab.library.model.tokenize

        def word_ids(word: str) -> bytes:
            return b"".join([t.id.to_bytes(4, "little") for t in tokenize(word)])

        _MEMOS[path] = ChunkMemo(vocab, word_ids)
    return _MEMOS[path]


class _Shard:
    """Blocks of one shard, cut as ids come in."""

    def __init__(self, shard: int, kind: str, block_ids: int) -> None:
        self.shard, self.kind, self.block_ids = shard, kind, block_ids
        self.block = self.written = self.held = 0
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple] = []

    def _cut(self) -> dict:
        ids = np.concatenate(self.parts)
        planes, sizes = to_planes(ids, self.kind)
        doc_id, start, tokens, at = map(list, zip(*self.docs))
        row = {
            "shard": self.shard, "block": self.block, "n_ids": len(ids), "kind": self.kind,
            "planes": planes, "plane_sizes": sizes,
            "doc_id": doc_id, "doc_start": start, "doc_tokens": tokens, "at": at,
        }
        self.block += 1
        self.written += len(ids)
        self.parts, self.docs, self.held = [], [], 0
        return row

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        start, at = self.written + self.held, 0
        while at < len(ids):
            piece = ids[at : at + self.block_ids - self.held]
            self.parts.append(piece)
            self.docs.append((doc_id, start, len(ids), at))
            self.held += len(piece)
            at += len(piece)
            if self.held == self.block_ids:
                yield self._cut()

    def finish(self) -> Iterator[dict]:
        if self.held:
            yield self._cut()


def write(
    docs: DataFrame,
    to: str,
    tokenizer: str,
    end_id: int = 1,
    kind: str = "byte",
    block_ids: int = BLOCK_IDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of all documents, each with ``end_id`` behind it, in ascending doc_id order."""
    schema = to_arrow_schema(_parse_datatype_string(BLOCK_SCHEMA))
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = library_ids(tokenizer)
        shard = _Shard(TaskContext.get().partitionId(), kind, block_ids)

        def out(blocks: Iterator[dict]) -> Iterator[pa.RecordBatch]:
            for row in blocks:
                yield pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(memo.text(text or "") + end, "<u4")
                yield from out(shard.add(doc_id, ids))
        yield from out(shard.finish())

    blocks = ordered.mapInArrow(run, BLOCK_SCHEMA)
    blocks.write.option("compression", "none").parquet(to)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """shard, first: ids of all shards before it. One row for each written file."""
    sizes = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """The ids of every document piece by piece: shard, doc_id, doc_start, doc_tokens, at, ids."""

    columns = "shard int, doc_id bigint, doc_start bigint, doc_tokens bigint, at bigint, ids binary"
    schema = to_arrow_schema(_parse_datatype_string(columns))

    def pieces(b: dict) -> Iterator[tuple]:
        ids = from_planes(b["planes"], b["plane_sizes"], b["n_ids"], b["kind"])
        done = 0
        for doc, start, tokens, at in zip(b["doc_id"], b["doc_start"], b["doc_tokens"], b["at"]):
            n = min(tokens - at, len(ids) - done)
            yield b["shard"], doc, start, tokens, at, ids[done : done + n].tobytes()
            done += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one block unpacked at a time
                rows = zip(*pieces(batch.slice(i, 1).to_pylist()[0]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema
                )

    return spark.read.schema(BLOCK_SCHEMA).parquet(path).mapInArrow(run, columns)


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC-32 polynomial, lowest power in the highest bit."""
    product = 0
    for i in range(31, -1, -1):
        if b >> i & 1:
            product ^= a
        a = a >> 1 ^ (0xEDB88320 if a & 1 else 0)
    return product


def crc32_joined(first: int, second: int, n_second: int) -> int:
    """CRC-32 of two byte strings in a row from theirs: crc(A) * x^(8 |B|) + crc(B)."""
    power, square, n = 1 << 31, 1 << 30, 8 * n_second
    while n:
        if n & 1:
            power = _times(power, square)
        square = _times(square, square)
        n >>= 1
    return _times(first, power) ^ second


def doc_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files."""
    crc = F.crc32("ids")
    pieces = read_pieces(spark, path).select(
        "shard", "doc_id", "doc_start", "doc_tokens", "at", F.length("ids").alias("n"), crc.alias("crc")
    )
    # a document has as many pieces as blocks it touches, one for nearly all
    docs = pieces.groupBy("shard", "doc_start", "doc_id", "doc_tokens").agg(
        F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces")
    )

    def join_pieces(batch: pa.RecordBatch) -> dict:
        crcs = []
        for parts in batch.column(4).to_pylist():
            value = parts[0]["crc"]
            for p in parts[1:]:
                value = crc32_joined(value, p["crc"], p["n"])
            crcs.append(value)
        return {n: batch.column(i) for i, n in enumerate(("shard", "doc_start", "doc_id", "n_tokens"))} | {
            "ids_crc32": crcs
        }

    joined = arrow_map(
        docs, join_pieces, "shard int, doc_start bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return joined.join(shard_starts(spark, path), "shard").select(
        "doc_id", (F.col("first") + F.col("doc_start")).alias("start"), "n_tokens", "ids_crc32"
    )
