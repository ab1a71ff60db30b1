"""Token ids in binary files with Elias-Fano document boundaries.

A file is a sequence of shards, each followed by one byte that readers skip:

    magic 8 bytes | bytes of the shard, u64 | part u32 | number u32 | width of an id u32 | nulls u32
    | smallest doc id i64 | ids u64 | Elias-Fano of the end of each document
    | Elias-Fano of (doc id - smallest) | ids, ``width`` bytes each

Documents are in ascending order of id over all shards, ordered by (part, number); null ids come
first, and there are ``nulls`` of them in a shard. No table of 64-bit offsets is stored: the end of
document i is looked up with a select structure.

Rows are dealt by ranges of (id, hash of the text, row), so rows of one id may lie in several
parts; a part is sorted, encoded block by block and cut into shards of ``shard_ids`` ids. Files are
written and committed by Spark in any store that it can write, and read back as binary files.

Defined cases: a null text is empty; each document ends with ``end_id``, so none is without ids;
null ids come first, repeated rows are documents of their own; an empty table gives a folder without
shards. Columns other than id and text, whatever their names, are not read.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smogline.llm.bpe import PieceCache, byte_alphabet, split_pieces
from smogline.llm.elias_fano import EliasFano

_MAGIC = b"EFTOKEN1"
_HEAD = np.dtype([
    ("size", "<u8"), ("part", "<u4"), ("number", "<u4"), ("width", "<u4"), ("nulls", "<u4"),
    ("base", "<i8"), ("ids", "<u8"),
])
_CACHE_BYTES = 64 << 20


class LibraryEncoder:
    """Ids by the ``tokenizers`` library; pieces that come again are looked up.

    The library's merges are asked for each distinct new piece of a text, spelled in the byte alphabet. A text
    with special tokens goes to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype(self.code)
        self.model = self.tokenizer.model
        self.alphabet = {byte: char for char, byte in byte_alphabet().items()}
        self.known = PieceCache(_CACHE_BYTES)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(special in text for special in self.special):
            return self._asked([text])[0]
        return self.known.join(split_pieces(text), self._merged)

    def _merged(self, pieces: list[str]) -> list[bytes]:
        spelled = (p.encode().decode("latin-1").translate(self.alphabet) for p in pieces)
        return [array(self.code, [t.id for t in self.model.tokenize(s)]).tobytes() for s in spelled]

    def _asked(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in encoded]


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    """The encoder of a file, with its cache, once per process."""
    return LibraryEncoder(path)


def shard_bytes(part: int, number: int, doc_ids: list[int | None], documents: list[bytes], dtype) -> bytes:
    """One shard; ``doc_ids`` ascending, nulls first."""
    nulls = sum(i is None for i in doc_ids)
    known = np.array(doc_ids[nulls:], np.int64)
    base = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(d) // dtype.itemsize for d in documents])
    body = b"".join([
        EliasFano.of(ends).to_bytes(),
        EliasFano.of(known.view(np.uint64) - np.uint64(base % (1 << 64))).to_bytes(),
        *documents,
    ])
    size = len(_MAGIC) + _HEAD.itemsize + len(body)
    head = np.array([(size, part, number, dtype.itemsize, nulls, base, int(ends[-1]))], _HEAD)
    return _MAGIC + head.tobytes() + body


class Shard:
    """A shard read from a buffer: documents by number, without unpacking the others."""

    def __init__(self, data, at: int = 0):
        if bytes(data[at : at + 8]) != _MAGIC:
            raise ValueError("not a token file")
        head = np.frombuffer(data, _HEAD, 1, at + 8)[0]
        self.part, self.number, self.n_ids = int(head["part"]), int(head["number"]), int(head["ids"])
        self.nulls, self.base = int(head["nulls"]), int(head["base"])
        self.end = at + int(head["size"])
        self.ends, place = EliasFano.read(data, at + 8 + _HEAD.itemsize)
        self.doc_ids, place = EliasFano.read(data, place)
        self.ids = np.frombuffer(data, f"<u{int(head['width'])}", self.n_ids, place)

    def __len__(self) -> int:
        return len(self.ends)

    def span(self, i: int) -> tuple[int, int]:
        """Where document i begins and ends among the ids of the shard."""
        return (self.ends[i - 1] if i else 0), self.ends[i]

    def spans(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Where documents lo to hi - 1 begin and end, by one select over their boundaries."""
        ends = self.ends.between(max(lo - 1, 0), hi).astype(np.int64)
        return (ends[:-1], ends[1:]) if lo else (np.concatenate([[0], ends[:-1]]), ends)

    def doc_ids_of(self, lo: int, hi: int) -> list[int | None]:
        """The ids of documents lo to hi - 1."""
        nulls = max(0, min(hi, self.nulls) - lo)
        known = self.doc_ids.between(max(lo - self.nulls, 0), max(hi - self.nulls, 0))
        return [None] * nulls + (known + np.uint64(self.base % (1 << 64))).view(np.int64).tolist()

    def document(self, i: int) -> np.ndarray:
        start, end = self.span(i)
        return self.ids[start:end]

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.base + self.doc_ids[i - self.nulls]

    @classmethod
    def all(cls, data) -> Iterator[Shard]:
        at = 0
        while at < len(data):
            shard = cls(data, at)
            yield shard
            at = shard.end + 1


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    part_bytes: int = 16 << 20,
    shard_ids: int = 2 << 20,
) -> None:
    """Encode every text and write the files to the folder ``path``, which must be new."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())

    def run(batches):
        encoder, part = library_encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], encoder.dtype).tobytes()
        number, size, doc_ids, documents = 0, 0, [], []
        for batch in batches:
            for doc, text in zip(batch["id"], batch["text"]):
                ids = encoder.encode(text.as_py()) + end
                if documents and size + len(ids) > shard_ids * encoder.dtype.itemsize:
                    yield _row(shard_bytes(part, number, doc_ids, documents, encoder.dtype))
                    number, size, doc_ids, documents = number + 1, 0, [], []
                doc_ids.append(doc.as_py())
                documents.append(ids)
                size += len(ids)
        if documents:
            yield _row(shard_bytes(part, number, doc_ids, documents, encoder.dtype))

    dealt = rows.repartitionByRange(parts, "id", "tie", "row").sortWithinPartitions("id", "tie", "row")
    shards = dealt.mapInArrow(run, "shard binary")
    shards.select(F.col("shard").cast("string").alias("value")).write.text(path)  # bytes as they are


def _row(shard: bytes) -> pa.RecordBatch:
    return pa.record_batch({"shard": pa.array([shard], pa.binary())})


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(part, number, id, at, n_tokens, ids): each document; ``ids`` as little-endian 32-bit integers.

    ``at`` counts from the start of the shard; ``starts`` has what lies before each shard.
    """
    def run(batches):
        for batch in batches:
            for content in batch["content"]:
                for shard in Shard.all(content.as_buffer()):
                    yield from _documents(shard)

    return _files(spark, path).mapInArrow(
        run, "part int, number int, id long, at long, n_tokens long, ids binary"
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return found.where("length > 0").select("content")


def _documents(shard: Shard, block: int = 512) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(shard), block):
        hi = min(lo + block, len(shard))
        starts, ends = shard.spans(lo, hi)
        yield pa.record_batch({
            "part": pa.array([shard.part] * (hi - lo), pa.int32()),
            "number": pa.array([shard.number] * (hi - lo), pa.int32()),
            "id": pa.array(shard.doc_ids_of(lo, hi), pa.int64()),
            "at": pa.array(starts, pa.int64()),
            "n_tokens": pa.array(ends - starts, pa.int64()),
            "ids": pa.array([shard.ids[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends)], pa.binary()),
        })


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, number, before): ids of all shards before each one. One short row for a shard."""
    def run(batches):
        for batch in batches:
            for content in batch["content"]:
                for s in Shard.all(content.as_buffer()):
                    yield pa.record_batch({"part": pa.array([s.part], pa.int32()),
                                           "number": pa.array([s.number], pa.int32()),
                                           "n": pa.array([s.n_ids], pa.int64())})

    shards = _files(spark, path).mapInArrow(run, "part int, number int, n long")
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("part", "number", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
