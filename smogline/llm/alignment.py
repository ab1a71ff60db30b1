"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text.

A is a byte-level BPE of the ``tokenizers`` library, which encodes a space and the text; B a model of
``sentencepiece``, which puts that space there itself. Special strings inside of a text are plain text.

*Links.* With the token-byte incidence matrices A and B in compressed rows, the row products of A.B'
are the overlaps: a token of A and one of B are linked if they share a byte, and the value is how many.
*Groups.* Offsets at which tokens of both end cut the text into groups; the products of the token-group
incidence matrices are the links that share a group. ``token_links`` returns both.

*Corpus.* ``aligned`` weighs the links of each document by how many documents hold the id pair linked.
A task takes its documents in chunks of ``chunk_bytes``, cuts them at places safe for both
vocabularies (``cuts``), and aligns each different part of a chunk once; the links of a document
are a row product again, of its parts and their pairs. A chunk sends on one row per different pair, with the
number of its documents, and keeps a packed matrix of documents and pairs. Pairs are counted over all
chunks (combined before the shuffle), the counts go back to the chunks that hold the pair, and each
chunk weighs its documents. No text is encoded twice, and no task sees more than a chunk at once.

Defined cases: null and empty texts, and texts whose tokens' bytes are not a space and the text (such as
one with U+2581), have no tokens: all counts 0, no groups; a null id stays null; repeated rows are documents
of their own; an empty table gives none; a text longer than a chunk is a chunk of its own, taken in
parts. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm import cuts
from smogline.llm.bpe import Speller, byte_alphabet
from smogline.llm.csr import Csr, members, row_products, spans
from smogline.session import stored

CHUNK_BYTES = 1 << 22
BLOCK_BYTES = 1 << 18  # bytes of different parts that are aligned at once
_ENCODED = 1 << 11  # parts given to a library at once; what it returns is far larger than their ids
_SHIFT = 32  # a pair of ids as one number: A above, B below


class Pair:
    """Both vocabularies: how they encode, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        spelled_a = {
            i: bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode()
            for t, i in self.a.get_vocab(with_added_tokens=True).items()
        }
        spelled_b = {
            i: bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        }
        self.bytes_a, self.bytes_b = Speller(spelled_a), Speller(spelled_b)
        top = max(spelled_a) + 1
        digits = {2 * i + last: f"{i}{',|'[last]}".encode() for i in spelled_a for last in (0, 1)}
        digits |= {2 * (top + i) + last: f"{i}{',;'[last]}".encode() for i in spelled_b for last in (0, 1)}
        self.digits, self.offset_b = Speller(digits), top
        self.safe = self.b.normalize("a  ﬁ① ") == "▁a▁▁ﬁ①▁" and not any(
            d == "▁" != c for i in spelled_b for p in [self.b.id_to_piece(i)] for c, d in zip(p, p[1:])
        )

    def parts(self, text: str) -> Iterator[list[str]]:
        """A space and the text, in lists of parts that are safe for both."""
        if not self.safe:
            yield [" " + text]
            return
        for part in cuts.parts(" " + text, spaced=True):
            yield cuts.spaced_words(part)

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        ids_a, ids_b = [], []
        for i in range(0, len(parts), _ENCODED):
            some = parts[i : i + _ENCODED]
            ids_a += [e.ids for e in self.a.encode_batch_fast(some, add_special_tokens=False)]
            ids_b += self.b.encode([p[1:] for p in some], num_threads=1)
        return ids_a, ids_b


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    """Both vocabularies, once per process."""
    return Pair(path_a, path_b)


@dataclass
class Aligned:
    """What a list of parts holds, part by part; ``good`` parts are spelled alike by both."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_shared: np.ndarray
    links: Csr  # parts x positions in ``pairs``
    pairs: np.ndarray
    listed: list[bytes]


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter((x for row in rows for x in row), np.int64, int(sizes.sum())), sizes


def _spells(ids: np.ndarray, sizes: np.ndarray, speller: Speller, data: list[bytes]) -> np.ndarray:
    """Do the tokens of each part spell its bytes?"""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    want = np.fromiter(map(len, data), np.int64, len(data))
    good = np.bincount(owner, speller.sizes[ids], len(sizes)).astype(np.int64) == want
    got = np.frombuffer(speller.spell(ids[good[owner]]), np.uint8)
    kept = np.frombuffer(b"".join(d for d, g in zip(data, good) if g), np.uint8)
    wrong = np.flatnonzero(got != kept)
    if len(wrong):
        ends = np.cumsum(want[good])
        at = np.flatnonzero(good)
        good[at[np.unique(np.searchsorted(ends, wrong, "right"))]] = False
    return good


@dataclass
class Tokens:
    """The tokens of the good parts, with the offsets at which they end in the bytes of all of them."""

    good: np.ndarray
    ids_a: np.ndarray
    ids_b: np.ndarray
    owner_a: np.ndarray  # number of the part
    owner_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    groups: np.ndarray  # offsets at which groups end

    @property
    def group_a(self) -> np.ndarray:
        return np.searchsorted(self.groups, self.ends_a)

    @property
    def group_b(self) -> np.ndarray:
        return np.searchsorted(self.groups, self.ends_b)

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(token of A, token of B, shared bytes): the row products of A.B'."""
        width = int(self.ends_a[-1]) if len(self.ends_a) else 0
        return row_products(spans(self.ends_a, width), spans(self.ends_b, width).transposed())

    def shared(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(token of A, token of B, 1) of the same group: products of the group incidence matrices."""
        n = len(self.groups)
        return row_products(members(self.group_a, n), members(self.group_b, n).transposed())


def tokens(parts: list[str], by: Pair) -> Tokens:
    data = [p.encode() for p in parts]
    rows_a, rows_b = by.encode(parts)
    (ids_a, sizes_a), (ids_b, sizes_b) = _flat(rows_a), _flat(rows_b)
    good = _spells(ids_a, sizes_a, by.bytes_a, data) & _spells(ids_b, sizes_b, by.bytes_b, data)
    owner_a, owner_b = (np.repeat(np.arange(len(parts)), s) for s in (sizes_a, sizes_b))
    ids_a, owner_a = ids_a[good[owner_a]], owner_a[good[owner_a]]
    ids_b, owner_b = ids_b[good[owner_b]], owner_b[good[owner_b]]
    ends_a, ends_b = np.cumsum(by.bytes_a.sizes[ids_a]), np.cumsum(by.bytes_b.sizes[ids_b])
    groups = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return Tokens(good, ids_a, ids_b, owner_a, owner_b, ends_a, ends_b, groups)


def _listed(t: Tokens, by: Pair, n: int) -> list[bytes]:
    """``a1,a2|b1;`` for the groups of each part."""
    key = np.concatenate([2 * t.group_a, 2 * t.group_b + 1])
    code = 2 * np.concatenate([t.ids_a, t.ids_b + by.offset_b])
    owner = np.concatenate([t.owner_a, t.owner_b])
    order = np.argsort(key, kind="stable")
    key, code, owner = key[order], code[order], owner[order]
    code[:-1] += np.diff(key) != 0
    code[-1:] += 1
    text = by.digits.spell(code)
    sizes = np.bincount(owner, by.digits.sizes[code], n).astype(np.int64)
    ends = np.cumsum(sizes).tolist()
    return [text[lo:hi] for lo, hi in zip([0, *ends], ends)]


def align(parts: list[str], by: Pair) -> Aligned:
    """Align each part; the links of a part are summed up by id pair."""
    t, n = tokens(parts, by), len(parts)
    owners, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b, _ in t.overlaps():
        owners.append(t.owner_a[a])
        keys.append(t.ids_a[a] << _SHIFT | t.ids_b[b])
    owner, key = np.concatenate(owners), np.concatenate(keys)
    pairs, column = np.unique(key, return_inverse=True)
    start = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    group_owner = t.owner_a[np.searchsorted(t.ends_a, t.groups)]
    in_group = np.bincount(t.group_b, minlength=len(t.groups))
    count = lambda x, w=None: np.bincount(x, w, n).astype(np.int64)
    return Aligned(
        t.good, count(t.owner_a), count(t.owner_b), count(group_owner),
        count(t.owner_a, in_group[t.group_a]), Csr(start, column, len(pairs)), pairs, _listed(t, by, n),
    )


def _aligned_parts(parts: list[str], by: Pair) -> Aligned:
    """The same for many parts, in blocks of bounded bytes."""
    found, block, held = [], [], 0
    for part in parts:
        block.append(part)
        held += len(part)
        if held >= BLOCK_BYTES:
            found.append(align(block, by))
            block, held = [], 0
    found.append(align(block, by)) if block or not found else None
    pairs = np.unique(np.concatenate([x.pairs for x in found]))
    columns = np.concatenate([np.searchsorted(pairs, x.pairs)[x.links.columns] for x in found])
    sizes = np.concatenate([np.diff(x.links.start) for x in found])
    joined = lambda name: np.concatenate([getattr(x, name) for x in found])
    return Aligned(
        joined("good"), joined("n_a"), joined("n_b"), joined("n_groups"), joined("n_shared"),
        Csr(np.concatenate([[0], np.cumsum(sizes)]), columns, len(pairs)), pairs, [p for x in found for p in x.listed],
    )


_ROW = pa.schema([
    ("chunk", pa.int64()), ("no", pa.int32()), ("id", pa.int64()),
    *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_shared")], ("groups_sha256", pa.string()),
    ("pair", pa.int64()), ("docs", pa.int64()), ("held", pa.binary()),
])
_ROW_DDL = (
    "chunk long, no int, id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, "
    "groups_sha256 string, pair long, docs long, held binary"
)


def _rows(n: int, chunk: int, **columns) -> pa.RecordBatch:
    arrays = [
        pa.array(np.full(n, chunk)) if f.name == "chunk"
        else columns.get(f.name, pa.nulls(n, f.type)) for f in _ROW
    ]
    return pa.record_batch([pa.array(a, f.type) if not isinstance(a, pa.Array) else a for a, f in zip(arrays, _ROW)], schema=_ROW)


def _chunk(number: int, ids: list, texts: list[str | None], by: Pair) -> Iterator[pa.RecordBatch]:
    """Rows of documents, one row per pair, and the packed matrix of documents and pairs."""
    of: dict[str, int] = {}
    rows = []
    for text in texts:
        row = [np.fromiter((of.setdefault(p, len(of)) for p in parts), np.int32) for parts in by.parts(text)] if text else []
        rows.append(np.concatenate(row) if row else np.zeros(0, np.int32))
    known = _aligned_parts(list(of), by)
    rows = [r if known.good[r].all() else r[:0] for r in rows]
    start = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    used = Csr(start, np.concatenate([np.zeros(0, np.int32), *rows]).astype(np.int64), len(of))
    digests = []
    for r in rows:
        digest = hashlib.sha256()
        for i in range(0, len(r), 1 << 16):
            text = b"".join(map(known.listed.__getitem__, r[i : i + (1 << 16)].tolist()))
            digest.update(text if i + (1 << 16) < len(r) else text[:-1])
        digests.append(digest.hexdigest() if len(r) else "")
    owner = np.repeat(np.arange(len(rows)), np.diff(start))
    total = lambda x: np.bincount(owner, x[used.columns], len(rows)).astype(np.int64)
    yield _rows(
        len(rows), number, no=pa.array(np.arange(len(rows), dtype=np.int32)), id=pa.array(ids, pa.int64()),
        n_a=pa.array(total(known.n_a)), n_b=pa.array(total(known.n_b)), n_groups=pa.array(total(known.n_groups)),
        n_links=pa.array(total(np.diff(known.links.start))), n_shared=pa.array(total(known.n_shared)),
        groups_sha256=pa.array(digests),
    )
    # parts of a document with their numbers, times pairs of a part: pairs of a document
    cells = [c for c in row_products(used, known.links)]
    row, column, times = (np.concatenate([c[i] for c in cells] or [np.zeros(0, np.int64)]) for i in range(3))
    docs = np.bincount(column, minlength=len(known.pairs))
    yield _rows(len(known.pairs), number, pair=pa.array(known.pairs), docs=pa.array(docs.astype(np.int64)))
    yield _rows(1, number, held=pa.array([_packed(row, column, times)], pa.binary()))


def _packed(row: np.ndarray, column: np.ndarray, times: np.ndarray) -> bytes:
    """A matrix in row order: steps between rows and between the columns of a row are small numbers."""
    step = np.diff(column, prepend=0)
    new = np.diff(row, prepend=-1) != 0
    step[new] = column[new]
    data = np.concatenate([np.diff(row, prepend=0), step, times]).astype(np.uint32)
    return zstandard.ZstdCompressor(level=3).compress(data.tobytes())


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, step, times = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint32).astype(np.int64).reshape(3, -1)
    row = np.cumsum(rows)
    if not len(row):
        return row, step, times
    sums = np.cumsum(step)
    first = np.flatnonzero(np.diff(row, prepend=-1) != 0)
    base = np.repeat(sums[first] - step[first], np.diff([*first, len(row)]))
    return row, sums - base, times


def _encoded(docs: DataFrame, paths: tuple[str, str], id_col: str, text_col: str, chunk_bytes: int) -> DataFrame:
    def run(batches):
        by, task = pair(*paths), TaskContext.get().partitionId()
        count, ids, texts, held = 0, [], [], 0
        for batch in batches:
            for i, text in zip(batch["id"], batch["text"]):
                ids.append(i.as_py())
                texts.append(text.as_py())
                held += len(texts[-1] or "")
                if held >= chunk_bytes:
                    yield from _chunk(task << 32 | count, ids, texts, by)
                    count, ids, texts, held = count + 1, [], [], 0
        if ids:
            yield from _chunk(task << 32 | count, ids, texts, by)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, _ROW_DDL)


def _weighed(held: pa.Table, pairs: pa.Table) -> pa.Table:
    """(chunk, no, n_best, count_sum) of the documents of one chunk."""
    order = np.argsort(pairs["pair"].to_numpy())
    count = pairs["count"].to_numpy()[order]
    best = pairs["best"].to_numpy()[order]
    parts = [_unpacked(x.as_py()) for x in held["held"]]
    row, column, times = (np.concatenate([p[i] for p in parts]) for i in range(3))
    n = int(row.max()) + 1 if len(row) else 0
    sums = np.zeros(n, np.int64)
    np.add.at(sums, row, times * count[column])
    return pa.table({
        "chunk": pa.array(np.repeat(held["chunk"].to_numpy()[:1], n)), "no": pa.array(np.arange(n, dtype=np.int32)),
        "n_best": pa.array(np.bincount(row, times * best[column], n).astype(np.int64)), "count_sum": pa.array(sums),
    })


def aligned(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256) for every row."""
    known = stored(_encoded(docs, (path_a, path_b), id_col, text_col, chunk_bytes), "aligned")
    pairs = known.where("pair IS NOT NULL").select("chunk", "pair", "docs")
    counts = stored(pairs.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("pair", _SHIFT)), "pairs")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    weights = counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))
    back = pairs.select(F.col("chunk").alias("of"), "pair").join(weights, "pair")
    held = known.where("held IS NOT NULL").select("chunk", "held")
    sums = held.groupBy("chunk").cogroup(back.groupBy("of")).applyInArrow(
        _weighed, "chunk long, no int, n_best long, count_sum long"
    )
    rows = known.where("no IS NOT NULL").drop("pair", "docs", "held")
    zero = F.lit(0).cast("long")
    return rows.join(sums, ["chunk", "no"], "left").select(
        "id", "n_a", "n_b", "n_groups", "n_links", "n_shared",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )


def token_links(
    docs: DataFrame, path_a: str, path_b: str, shared: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, a_at, a_id, b_at, b_id, n_bytes) for each link of each text, in the order of its tokens.

    With ``shared``, the pairs that share a group instead (``n_bytes`` is 1); a text in which both never end
    together is one group, whose pairs come block by block.
    """
    def run(batches):
        by = pair(path_a, path_b)
        for batch in batches:
            for i, value in zip(batch["id"], batch["text"]):
                if not value.as_py():
                    continue
                t = tokens([p for parts in by.parts(value.as_py()) for p in parts], by)
                if not t.good.all():
                    continue
                for a, b, n in t.shared() if shared else t.overlaps():
                    yield pa.record_batch({
                        "id": pa.array([i.as_py()] * len(a), pa.int64()), "a_at": pa.array(a), "a_id": pa.array(t.ids_a[a]),
                        "b_at": pa.array(b), "b_id": pa.array(t.ids_b[b]), "n_bytes": pa.array(n),
                    })

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, a_at long, a_id long, b_at long, b_id long, n_bytes long")
