"""Exact copies by two passes over a Bloom filter; only rows it takes for repeated are shuffled.

Two texts are copies if they are identical after lower-casing A-Z; null counts as empty.

Pass 1 sets ``probes`` bits for each row and counts, up to 2, how many rows set a bit: tasks send
the bits that they set, packed, to the slices of the filter, which add up. Pass 2 asks for each
row whether all its bits were set twice. A row whose text occurs twice always passes; of the
others, few do, and a group by the full SHA-256 sends those back. All other rows go straight
through.

The filter has ``bits_per_row`` bits a row and at most ``filter_bytes`` bytes, which is what the
driver and each worker hold at a time. A table that needs more is done in rounds: a round takes
the rows of one range of hashes, with a filter of its own.

Defined cases: rows with a null id are rows like others, smaller than any id; of rows with the
same text and the same largest id one stays; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.groups import attach
from smogline.llm.messages import cut_points, pack_sorted, unpack_sorted
from smogline.llm.words import mix
from smogline.session import scratch_path, stored

_SLICE_BITS = 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_key(text_col: str) -> Column:
    """SHA-256 of the text with A-Z lowered, 32 bytes."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _UPPER.lower())
    return F.unhex(F.sha2(text, 256))


class RepeatFilter:
    """Which 64-bit prefixes of keys may occur twice. ``rounds`` filters, used one at a time."""

    def __init__(self, rows: int, bits_per_row: int = 16, probes: int = 4, filter_bytes: int = 32 << 20):
        bits = max(_SLICE_BITS, int(max(1, rows * bits_per_row) - 1).bit_length())
        most = max(_SLICE_BITS, (8 * filter_bytes).bit_length() - 1)
        self.bits, self.round_bits, self.probes = min(bits, most), max(0, bits - most), probes

    @property
    def rounds(self) -> int:
        return 1 << self.round_bits

    def round_of(self, key: Column) -> Column:
        """The round of a key; rounds take bits that no probe uses."""
        tail = F.conv(F.hex(F.substring(key, 9, 4)), 16, 10).cast("long")
        return F.pmod(tail, F.lit(self.rounds))

    def positions(self, prefix: np.ndarray) -> np.ndarray:
        """The distinct bits of each 64-bit prefix, a row each; repeats of a bit count once."""
        steps = np.arange(self.probes, dtype=np.uint64)[:, None]
        return mix(prefix[None, :] + steps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def build(self, keys: DataFrame) -> bytes:
        """Bits set by two rows or more; ``keys`` has one column, key. At most ``filter_bytes``."""
        slices = (
            keys.mapInArrow(lambda b: self._sent(b), "part long, data binary")
            .groupBy("part").applyInArrow(lambda t: self._twice(t), "part long, data binary")
        )
        out = np.zeros(1 << (self.bits - 3), np.uint8)
        width = 1 << (_SLICE_BITS - 3)
        for row in slices.toLocalIterator():
            out[row.part * width : (row.part + 1) * width] = np.frombuffer(row.data, np.uint8)
        return out.tobytes()

    def _sent(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = self.positions(_prefixes(batch["key"]))
            rows = np.sort(rows, axis=0)
            fresh = np.ones(rows.shape, bool)
            fresh[1:] = rows[1:] != rows[:-1]
            bits = np.sort(rows[fresh]).astype(np.int64)
            at = cut_points(bits)
            unique, twice = bits[at[:-1]], np.diff(at) > 1
            parts = unique >> _SLICE_BITS
            ends = cut_points(parts)
            own = (unique & ((1 << _SLICE_BITS) - 1)) * 2 + twice
            yield pa.record_batch({
                "part": pa.array(parts[ends[:-1]] if len(parts) else [], pa.int64()),
                "data": pa.array([pack_sorted(own[a:b]) for a, b in zip(ends[:-1], ends[1:])],
                                 pa.binary()),
            })

    def _twice(self, table: pa.Table) -> pa.Table:
        counts = np.zeros(1 << _SLICE_BITS, np.uint8)
        for x in table["data"]:
            values = unpack_sorted(x.as_buffer())
            cells = values >> 1
            counts[cells] = np.minimum(counts[cells] + 1 + (values & 1), 2)
        return pa.table({"part": table["part"][:1],
                         "data": pa.array([np.packbits(counts > 1).tobytes()], pa.binary())})

    def test(self, spark, bits: bytes):
        """A column function: may the key occur twice?"""
        shared = spark.sparkContext.broadcast(bits)

        @F.pandas_udf("boolean")
        def repeated(keys: pd.Series) -> pd.Series:
            data = np.frombuffer(shared.value, np.uint8)
            at = self.positions(_prefixes(pa.array(keys, pa.binary())))
            hit = (data[at >> np.uint64(3)] >> (7 - (at & np.uint64(7)).astype(np.uint8))) & 1
            return pd.Series(hit.all(axis=0))

        return repeated


def _prefixes(keys: pa.Array) -> np.ndarray:
    """The first 8 bytes of each 32-byte key."""
    if not len(keys):
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(b"".join(keys.to_pylist()), np.uint8).reshape(-1, 32)
    return np.ascontiguousarray(raw[:, :8]).view(np.uint64).ravel()


def _flagged(keyed: DataFrame, sized: RepeatFilter) -> DataFrame:
    """``keyed``, with a column ``maybe``, stored."""
    spark = keyed.sparkSession
    paths = []
    for turn in range(sized.rounds):
        own = keyed.where(sized.round_of(F.col("key")) == turn) if sized.rounds > 1 else keyed
        test = sized.test(spark, sized.build(own.select("key")))
        paths.append(scratch_path(spark, "flagged"))
        own.withColumn("maybe", test("key")).write.parquet(paths[-1])
    return spark.read.parquet(*paths)


def mark_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **filter_options
) -> DataFrame:
    """(id, keep_id, group_size, kept, key) for every row; key is the SHA-256 of the lowered text.

    Texts are read once: the keys are stored (about 45 bytes a row) and both passes read those.
    """
    keyed = stored(
        docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("key"))
        .withColumn("row", F.monotonically_increasing_id()),
        "keys",
    )
    flagged = _flagged(keyed, RepeatFilter(keyed.count(), **filter_options))
    alone = flagged.where("not maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "key",
    )
    best = F.max(F.struct("id", "row"))
    grouped = attach(
        flagged.where("maybe").drop("maybe"), "key", "row",
        {"n_": F.count("*"), "best_": best}, {"n": F.sum("n_"), "best": F.max("best_")},
    )
    return alone.unionByName(grouped.select(
        "id", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), "key",
    ))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **filter_options) -> DataFrame:
    """The rows of ``docs`` without copies, all columns; of equal texts one with the largest id stays.

    Texts go through twice, once for each pass; only rows that may be copies are shuffled, and of
    these only the copies with the largest id, by (key, id), not by group.
    """
    spark = docs.sparkSession
    keys = stored(docs.select(text_key(text_col).alias("key")), "keys")
    sized = RepeatFilter(keys.count(), **filter_options)
    names = [f"`{c}`" for c in docs.columns]
    body = F.struct(*names).alias("body")
    keyed = docs.select(body, F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("key"))
    flagged = _flagged_rows(spark, keyed, keys, sized)
    alone = flagged.where("not maybe").select("body.*")
    many = flagged.where("maybe")
    best = many.groupBy("key").agg(F.max("id").alias("best"))
    same = (many["key"] == best["key"]) & many["id"].eqNullSafe(best["best"])
    left = many.join(best, same, "left_semi").dropDuplicates(["key"])
    return alone.unionByName(left.select("body.*"))


def _flagged_rows(spark, keyed: DataFrame, keys: DataFrame, sized: RepeatFilter) -> DataFrame:
    out = None
    for turn in range(sized.rounds):
        mine = (lambda d: d.where(sized.round_of(F.col("key")) == turn)) if sized.rounds > 1 else (lambda d: d)
        test = sized.test(spark, sized.build(mine(keys)))
        flagged = mine(keyed).withColumn("maybe", test("key"))
        if sized.rounds > 1:
            flagged = stored(flagged, "flagged")  # one filter in memory at a time
        out = flagged if out is None else out.unionByName(flagged)
    return out
