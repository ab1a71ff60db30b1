"""Token counts: texts are encoded in batches balanced by bytes, and only lengths leave the task.

Texts are cut at safe places (``cuts``), so the count of a text is the sum over its parts. A block of rows,
bounded by bytes and not by rows, gives its different parts; these are encoded once, in batches of
about the same number of bytes; long texts and long runs without white space are cut too, so one row
weighs on a batch no more than many short ones. There is no shuffle.

A vocabulary is a file of the ``tokenizers`` library (.json) or of ``sentencepiece`` (.model). Counts are
those of the library's own default: no begin, end or added special tokens; special strings inside of a
text are what the library makes of them; no truncation, no padding. Where a vocabulary's rules do not
promise safe places, texts are encoded whole.

Defined cases: a null or empty text has 0 bytes and 0 tokens; a null id stays null; repeated rows are
counted each; an empty table gives none; a stretch that has no safe place is encoded whole, whatever
its length. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm import cuts

BLOCK_BYTES = 1 << 22  # text that is cut and looked up together
BATCH_BYTES = 1 << 17  # text that is given to the library at once
LONG_RUN = 1 << 12  # characters of a part that are cut further


class JsonCounter:
    """Lengths by the ``tokenizers`` library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has its core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        self.specials = [t["content"] for t in added]
        self.safe = (
            spec["model"].get("type") == "BPE" and before.get("type") == "ByteLevel" and not spec.get("normalizer")
            and not before.get("add_prefix_space") and before.get("use_regex", True)
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
            and not any(c.isspace() for t in self.specials for c in t)
        )

    def parts(self, text: str) -> list[str]:
        if not self.safe:
            return [text]
        out = cuts.words(text)
        if len(text) > LONG_RUN and max(map(len, out)) > LONG_RUN:
            out = [p for part in out for p in (cuts.run_parts(part, self.specials) if len(part) > LONG_RUN else [part])]
        return out

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class PieceCounter:
    """Lengths by ``sentencepiece``."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.safe = self.library.normalize("a  ﬁ① ") == "▁a▁▁ﬁ①▁" and not any(
            d == "▁" != c for p in pieces for c, d in zip(p, p[1:])
        )

    def parts(self, text: str) -> list[str]:
        return cuts.spaced_words(" " + text) if self.safe else [" " + text]

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.library.encode([t[1:] for t in texts], num_threads=1)]


@lru_cache(maxsize=4)
def counter(path: str) -> JsonCounter | PieceCounter:
    """The counter of a vocabulary file, once per process."""
    return JsonCounter(path) if path.endswith(".json") else PieceCounter(path)


def balanced(parts: Iterable[str], most: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Lists of about ``most`` bytes; a part that is longer is a list of its own."""
    batch, held = [], 0
    for part in parts:
        size = len(part) if part.isascii() else len(part.encode())
        if batch and held + size > most:
            yield batch
            batch, held = [], 0
        batch.append(part)
        held += size
    if batch:
        yield batch


def counted(texts: list[str], by: JsonCounter | PieceCounter) -> list[int]:
    """The token counts of some texts; parts that come again are encoded once."""
    rows = [by.parts(t) if t else [] for t in texts]
    known: dict[str, int] = {}
    for batch in balanced(set().union(*rows)):
        known.update(zip(batch, by.lengths(batch)))
    return [sum(map(known.__getitem__, row)) for row in rows]


def _blocks(column: pa.Array, by: JsonCounter | PieceCounter) -> Iterator[tuple[list[int], list[str]]]:
    """(row numbers, texts) of about ``BLOCK_BYTES``; a long text comes in several parts."""
    numbers, texts, held = [], [], 0
    for number, value in enumerate(column):
        text = value.as_py()
        if not text:
            continue
        long = by.safe and len(text) > cuts.PART
        spaced = isinstance(by, PieceCounter)
        for i, part in enumerate(cuts.parts(text, spaced) if long else (text,)):
            numbers.append(number)
            texts.append(part[1:] if spaced and i else part)  # the space in front is put there again
            held += len(part)
            if held >= BLOCK_BYTES:
                yield numbers, texts
                numbers, texts, held = [], [], 0
    yield numbers, texts


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for every row."""
    def run(batches):
        by = counter(path)
        for batch in batches:
            totals = [0] * batch.num_rows
            for numbers, texts in _blocks(batch["text"], by):
                for number, n in zip(numbers, counted(texts, by)):
                    totals[number] += n
            yield pa.record_batch({
                "id": batch["id"], "n_bytes": batch["n_bytes"], "n_tokens": pa.array(totals, pa.int64()),
            })

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    return rows.mapInArrow(run, "id long, n_bytes long, n_tokens long")
