"""Removal of passages that occur earlier in the corpus, by a count-min prefilter and exact groups.

A window is ``size`` consecutive words of one document. A window whose word sequence starts
earlier too (in a smaller id, or earlier in the same document) is a repeat, and every word that
a repeat covers is removed. Windows are judged on the input.

1. Documents are dealt to *chunks*, ranges of ids of about ``chunk_bytes`` of text. A chunk
   builds its own count-min sketch of two rows. Chunk sketches are sent as sorted cells, one
   message for each *slice* of cells, and merged slice by slice: the sketch grows with the
   corpus, the memory of a task does not. A slice answers each chunk with one bit per cell it
   sent: whether the merged count is 2 or more. The smaller of a window's two counts is never
   below its true count, so no repeated window is lost.
2. Windows that both rows call repeated, each once per chunk, go to the bucket of their hash as
   96-bit identities. A bucket finds the first chunk of each and answers with one bit. Chunks are
   in the order of ids, so the first chunk holds the first occurrence, and inside a chunk the
   first window in order is it. A passage in a third of all rows sends one identity per chunk.
3. Each chunk removes what its repeats cover.

Text is shuffled once, and that exchange is read three times. No table of all windows exists.

Defined cases: a null text has no words; a null id counts as the largest; rows with one id are
ordered by text; equal rows stay rows of their own; an empty table gives an empty result. Other
columns of the input are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.messages import (
    cut_points, pack_bits, pack_sorted, unpack_bits, unpack_sorted,
)
from smogline.llm.words import blocks, mix, spans_hash

_MESSAGE = "chunk long, kind int, part long, n long, data binary"
_LAST = np.iinfo(np.int64).max
#: Cells of a sketch row for each window, at least: one window in 20 is then taken for repeated.
_CELLS_PER_WINDOW = 4


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 20,
    chunk_bytes: int = 16 << 20,
    slice_bits: int = 22,
) -> DataFrame:
    """(id, n_words, n_removed, kept): the words left, joined by one space, for every row.

    Reads the table twice before the result is built: total bytes, and quantiles of the id.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    cells = _CELLS_PER_WINDOW * max(1, total // 6)
    bits = max(slice_bits, int(cells - 1).bit_length())
    limits = _limits(rows, chunks)

    dealt = rows.withColumn("chunk", _chunk_of(limits)("id"))
    dealt = dealt.repartition(chunks, "chunk")
    grouped = dealt.groupBy("chunk")
    sketches = grouped.applyInArrow(lambda t: _sketch(size, bits, slice_bits, t), _MESSAGE)
    counted = sketches.groupBy("kind", "part").applyInArrow(lambda t: _merge(slice_bits, t), _MESSAGE)
    buckets = max(0, bits - slice_bits)
    found = grouped.cogroup(counted.groupBy("chunk")).applyInArrow(
        lambda t, said: _candidates(size, bits, buckets, t, said), _MESSAGE
    )
    firsts = found.groupBy("part").applyInArrow(_first, _MESSAGE)
    return grouped.cogroup(counted.unionByName(firsts).groupBy("chunk")).applyInArrow(
        lambda t, said: _remove(size, bits, t, said), "id long, n_words long, n_removed long, kept string"
    )


def _limits(rows: DataFrame, chunks: int) -> np.ndarray:
    """The ids at which a new chunk begins."""
    if chunks == 1:
        return np.zeros(0, np.int64)
    shares = [i / chunks for i in range(1, chunks)]
    got = rows.agg(F.percentile_approx("id", shares, max(10_000, 10 * chunks))).first()[0]
    return np.unique(np.array(got or [], np.int64))


def _chunk_of(limits: np.ndarray):
    @F.pandas_udf("long")
    def chunk(ids: pd.Series) -> pd.Series:
        ids = ids.astype("Int64").fillna(_LAST).to_numpy(np.int64)
        return pd.Series(np.searchsorted(limits, ids, "left"))

    return chunk


def _ordered(table: pa.Table) -> pa.Table:
    return table.take(pc.sort_indices(table, [("id", "ascending"), ("text", "ascending")]))


def _window_hashes(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every window of the chunk, in the order of documents and starts."""
    one, two = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for _, _, words in blocks(table["text"]):
        at = words.windows(size)
        one.append(spans_hash(words.hashes(), at, at + size))
        two.append(spans_hash(words.hashes(1), at, at + size, 1))
    return np.concatenate(one), np.concatenate(two)


def _cells(one: np.ndarray, row: int, bits: int) -> np.ndarray:
    value = one if row == 0 else mix(one + np.uint64(0x632BE59BD9B4E019))
    return (value >> np.uint64(64 - bits)).astype(np.uint32 if bits <= 32 else np.uint64)


def _messages(rows: list[tuple]) -> pa.Table:
    names = ["chunk", "kind", "part", "n", "data"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def _sketch(size: int, bits: int, slice_bits: int, table: pa.Table) -> pa.Table:
    chunk, out = table["chunk"][0].as_py(), []
    one, _ = _window_hashes(table, size)
    for row in (0, 1):
        cells = np.sort(_cells(one, row, bits))
        at = cut_points(cells)
        unique = cells[at[:-1]]
        twice = np.diff(at) > 1
        parts = unique >> np.array(slice_bits, unique.dtype)
        ends = cut_points(parts)
        for lo, hi in zip(ends[:-1], ends[1:]):
            own = (unique[lo:hi] & np.array((1 << slice_bits) - 1, unique.dtype)).astype(np.int64)
            out.append((chunk, row, int(parts[lo]), hi - lo,
                        pack_sorted(own * 2 + twice[lo:hi])))
    return _messages(out)


def _merge(slice_bits: int, table: pa.Table) -> pa.Table:
    """Adds up the cells of one slice and tells each chunk which of its cells count 2 or more."""
    counts = np.zeros(1 << slice_bits, np.uint8)
    data = table["data"]
    for x in data:
        values = unpack_sorted(x.as_buffer())
        cells = values >> 1
        counts[cells] = np.minimum(counts[cells] + 1 + (values & 1), 2)
    bits = [pack_bits(counts[unpack_sorted(x.as_buffer()) >> 1] >= 2) for x in data]
    return table.set_column(4, "data", pa.array(bits, pa.binary()))


def _repeated(one: np.ndarray, messages: pa.Table, bits: int) -> np.ndarray:
    """Windows whose two merged counts are 2 or more."""
    flags = np.ones(len(one), bool)
    for row in (0, 1):
        own = messages.filter(pc.equal(messages["kind"], row)).sort_by("part")
        said = [unpack_bits(d.as_buffer(), n.as_py()) for d, n in zip(own["data"], own["n"])]
        cells = _cells(one, row, bits)
        order = np.argsort(cells)
        cells = cells[order]
        new = np.ones(len(cells), bool)
        new[1:] = cells[1:] != cells[:-1]
        if len(cells):
            flags[order] &= np.concatenate(said)[np.cumsum(new) - 1]
    return flags


def _distinct(one, two, size, bits, messages):
    """Candidate windows sorted by identity and order: (index, first of its identity in the chunk)."""
    at = np.flatnonzero(_repeated(one, messages, bits))
    one, two = one[at], two[at] >> np.uint64(32)
    order = np.lexsort((two, one))  # stable, so the earliest window of an identity comes first
    one, two = one[order], two[order]
    new = np.ones(len(order), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    return at[order], new, one[new], two[new].astype(np.uint32)


def _candidates(size: int, bits: int, bucket_bits: int, table: pa.Table, messages: pa.Table) -> pa.Table:
    if not table.num_rows:
        return _messages([])
    one, two = _window_hashes(_ordered(table), size)
    _, _, one, two = _distinct(one, two, size, bits, messages)
    buckets = one >> np.uint64(64 - bucket_bits) if bucket_bits else np.zeros(len(one), np.uint64)
    ends = cut_points(buckets)
    chunk = table["chunk"][0].as_py()
    return _messages([
        (chunk, 2, int(buckets[lo]), hi - lo, one[lo:hi].tobytes() + two[lo:hi].tobytes())
        for lo, hi in zip(ends[:-1], ends[1:])
    ])


def _first(table: pa.Table) -> pa.Table:
    """Of each identity in one bucket, the chunk that has it first; one bit for each sent."""
    table = table.sort_by("chunk")
    counts = table["n"].to_numpy()
    one, two = [], []
    for x, n in zip(table["data"], counts):
        raw = x.as_buffer()
        one.append(np.frombuffer(raw, np.uint64, n))
        two.append(np.frombuffer(raw, np.uint32, n, 8 * n))
    one, two = np.concatenate(one), np.concatenate(two)
    order = np.lexsort((two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    first = np.zeros(len(order), bool)
    first[order[new]] = True
    bits = [pack_bits(x) for x in np.split(first, np.cumsum(counts)[:-1])]
    return table.set_column(4, "data", pa.array(bits, pa.binary()))


def _remove(size: int, bits: int, table: pa.Table, messages: pa.Table) -> pa.Table:
    table = _ordered(table)
    one, two = _window_hashes(table, size)
    at, new, _, _ = _distinct(one, two, size, bits, messages)
    said = messages.filter(pc.equal(messages["kind"], 2)).sort_by("part")
    first = [unpack_bits(d.as_buffer(), n.as_py()) for d, n in zip(said["data"], said["n"])]
    repeat = np.zeros(len(one), bool)
    repeat[at] = True
    if len(at):
        repeat[at[new][np.concatenate(first)]] = False
    n_words, n_removed, kept, done = [], [], [], 0
    for lo, hi, words in blocks(table["text"]):
        starts = words.windows(size)
        starts, done = starts[repeat[done : done + len(starts)]], done + len(starts)
        cover = np.zeros(len(words.start) + 1, np.int32)
        cover[starts] += 1
        cover[starts + size] -= 1
        keep = np.cumsum(cover[:-1]) == 0
        n_words += words.counts.tolist()
        removed = np.concatenate([[0], np.cumsum(~keep)])[words.first]
        n_removed += np.diff(removed).tolist()
        kept += _joined(words, keep)
    return pa.table({
        "id": table["id"], "n_words": pa.array(n_words, pa.int64()),
        "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.string()),
    })


def _joined(words, keep: np.ndarray) -> list[bytes]:
    """The kept words of each text, joined by one space."""
    text = words.text.copy()
    start, end = words.start[keep], words.end[keep]
    edge = np.zeros(len(text) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1  # a word never ends where the next of its text starts
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    own = np.searchsorted(words.bounds, start, "right")
    follows = np.zeros(len(start), bool)
    follows[1:] = own[1:] == own[:-1]
    gaps = start[follows] - 1
    text[gaps] = 0x20
    inside[gaps] = True
    ends = np.concatenate([[0], np.cumsum(inside)])[words.bounds]
    out = text[inside].tobytes()
    return [out[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

