"""Language of documents whose words may switch language, by a linear-chain CRF over words.

A word is a run of letters (bytes A-Z, a-z and all of other characters), A-Z lowered. Its score for
each language is the sum of weights of its 3-grams, of its affixes (the first and the last 3-gram)
and of its lexicon entry, all hashed into tables of fixed size; transitions between languages are
learned. Forward-backward gives each word its probabilities, and their mean, weighted by the length
of the words, is the document's. The language with the largest mean is predicted, its mean is the
score; ``labels`` gives the language of each word.

*Fitting.* From rows with text and language that are not held out, at most ``fit_documents`` are
taken, in the order of a hash of the id, and of each at most ``fit_words`` words, in runs spread
evenly over the whole text. Predictions use text only.

Defined cases: null texts and texts without a letter are ``und`` with score 0; a null language is
not learned; a null id is never held out; without rows to learn from every text is ``und``.
Repeated rows are predicted each; an empty table gives none. Columns other than ids, texts and
languages, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.crf import Adam, marginals
from smogline.llm.words import Words, blocks, find_words

UNKNOWN = "und"
_GRAM_BITS, _WORD_BITS = 16, 17
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAPS = np.ones(256, bool)
_GAPS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_RUN = 40


@dataclass
class Codes:
    """What the weights of a block's words are looked up by."""

    words: Words
    grams: np.ndarray  # at each byte; 0 outside words
    prefix: np.ndarray
    suffix: np.ndarray
    entry: np.ndarray


def codes(words: Words) -> Codes:
    words = find_words(_LOWER[words.text], words.bounds, _GAPS)
    text = np.where(_GAPS[words.text], 0, words.text).astype(np.uint32)
    before, after = np.zeros_like(text), np.zeros_like(text)
    before[1:], after[:-1] = text[:-1], text[1:]
    before[words.start], after[words.end - 1] = 0, 0
    grams = ((before << 16 | text << 8 | after) * np.uint32(2654435761)) >> np.uint32(32 - _GRAM_BITS)
    grams = np.where(text == 0, 0, np.maximum(grams, 1))
    entry = (words.hashes() >> np.uint64(64 - _WORD_BITS)).astype(np.int64)
    return Codes(words, grams, grams[np.minimum(words.start + 1, words.end - 1)],
                 grams[np.maximum(words.end - 2, words.start)], entry)


@dataclass
class LanguageModel:
    languages: list[str]
    grams: np.ndarray  # tables of weights; row 0 of the first stays 0
    prefixes: np.ndarray
    suffixes: np.ndarray
    entries: np.ndarray
    transitions: np.ndarray

    @classmethod
    def empty(cls, languages: list[str]) -> LanguageModel:
        n = len(languages)
        of = lambda bits: np.zeros((1 << bits, n), np.float32)
        return cls(languages, of(_GRAM_BITS), of(_GRAM_BITS), of(_GRAM_BITS), of(_WORD_BITS), np.zeros((n, n)))

    def emissions(self, c: Codes) -> np.ndarray:
        if not len(c.words.start):
            return np.zeros((0, len(self.languages)))
        return (np.add.reduceat(self.grams[c.grams], c.words.start, axis=0).astype(float)
                + self.prefixes[c.prefix] + self.suffixes[c.suffix] + self.entries[c.entry])

    def of_words(self, words: Words) -> tuple[Codes, np.ndarray]:
        """The probabilities of each word's languages."""
        c = codes(words)
        return c, marginals(self.emissions(c), c.words.first, self.transitions)[0]

    def of_texts(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, or -1; score) of each text."""
        n = len(words.bounds) - 1
        if not self.languages:
            return np.full(n, -1), np.zeros(n)
        c, p = self.of_words(words)
        size = (c.words.end - c.words.start).astype(float)
        sums = np.zeros((len(p) + 1, p.shape[1]))
        np.cumsum(p * size[:, None], axis=0, out=sums[1:])
        mean = np.diff(sums[c.words.first], axis=0)
        total = mean.sum(axis=1)
        best = np.where(total > 0, mean.argmax(axis=1), -1)
        score = mean.max(axis=1) / np.where(total > 0, total, 1)
        plain = _GAPS[words.text] | (words.text >= 128)
        ascii_letters = np.concatenate([[0], np.cumsum(~plain)])[words.bounds]
        for i in np.flatnonzero((np.diff(ascii_letters) == 0) & (best >= 0)):
            raw = words.text[words.bounds[i] : words.bounds[i + 1]].tobytes().decode(errors="replace")
            if not any(map(str.isalpha, raw)):
                best[i] = -1
        return best, np.where(best >= 0, np.clip(score, 0, 1), 0.0)


def fit(texts: list[str], langs: list[str], turns: int = 40) -> LanguageModel:
    """A model from texts of one language each."""
    languages = sorted(set(langs))
    model = LanguageModel.empty(languages)
    if not texts or not languages:
        return model
    column = pa.array(texts, pa.large_string())
    ((_, _, words),) = list(blocks(column, 1 << 62))
    c = codes(words)
    n, states = len(c.words.start), len(languages)
    if not n:
        return LanguageModel.empty([])
    label = np.array([languages.index(x) for x in langs])
    target = np.repeat(label, c.words.counts)
    one_hot = np.eye(states)[target]
    at_byte = np.repeat(np.arange(n), c.words.end - c.words.start)
    gram_at = c.grams[c.grams > 0]
    per_text = np.maximum(c.words.counts - 1, 0)
    moves = np.diag(np.bincount(label, per_text, states))
    tables = [model.grams, model.prefixes, model.suffixes, model.entries, model.transitions]
    adam = Adam(tables, 0.05)

    def summed(index: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
        return np.column_stack([np.bincount(index, values[:, s], rows) for s in range(states)])

    for _ in range(turns):
        p, pairs = marginals(model.emissions(c), c.words.first, model.transitions, True)
        wrong = (p - one_hot) / n
        size = 1 << _GRAM_BITS
        grads = [summed(gram_at, wrong[at_byte], size), summed(c.prefix, wrong, size),
                 summed(c.suffix, wrong, size), summed(c.entry, wrong, 1 << _WORD_BITS),
                 (pairs - moves) / n]
        # the pull to 0 is strong for transitions, as texts of one language never show a switch
        for g, table, pull in zip(grads, tables, (1e-6, 1e-6, 1e-6, 1e-6, 1e-2)):
            g += pull * table
        adam.step([g.astype(t.dtype) for g, t in zip(grads, tables)])
    return model


def held_out(id_col: str) -> Column:
    """Rows that are kept from fitting: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def fit_on(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    fit_documents: int = 800,
    fit_words: int = 200,
) -> LanguageModel:
    """Fit on at most ``fit_documents`` rows of known language that are not held out."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"),
                       F.col(text_col).alias("text"), held_out(id_col).alias("held"))
    usable = rows.where("not held and lang is not null and text is not null")
    taken = usable.select("id").orderBy(F.xxhash64("id"), "id").limit(fit_documents)
    found = (
        usable.join(F.broadcast(taken.distinct()), "id")
        .mapInArrow(lambda b: _sampled(b, fit_words), "id long, lang string, part string")
        .limit(2 * fit_documents * max(1, fit_words // _RUN)).collect()
    )
    found.sort(key=lambda r: (r.id, r.lang, r.part))
    return fit([r.part for r in found], [r.lang for r in found])


def _sampled(batches, most: int):
    for batch in batches:
        ids, langs, rows = batch["id"].to_pylist(), batch["lang"].to_pylist(), []
        for lo, hi, words in blocks(batch["text"]):
            for i in range(hi - lo):
                a, b = words.first[i], words.first[i + 1]
                starts = [a] if b - a <= most else np.linspace(a, b - _RUN, max(1, most // _RUN)).astype(int)
                for s in starts if b > a else []:
                    e = b if b - a <= most else s + _RUN
                    part = words.text[words.start[s] : words.end[e - 1]].tobytes().decode(errors="replace")
                    rows.append((ids[lo + i], langs[lo + i], part))
        columns = list(zip(*rows)) or [[]] * 3
        kinds = [pa.int64(), pa.string(), pa.string()]
        yield pa.record_batch([pa.array(list(x), k) for x, k in zip(columns, kinds)], ["id", "lang", "part"])


def predicted(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score) for every row."""
    names = np.array([*model.languages, UNKNOWN], object)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        best, score = [np.zeros(0, int)], [np.zeros(0)]
        for _, _, words in blocks(texts):
            b, s = model.of_texts(words)
            best.append(b)
            score.append(s)
        return pa.StructArray.from_arrays(
            [pa.array(names[np.concatenate(best)], pa.string()), pa.array(np.concatenate(score))],
            ["lang_pred", "score"],
        )

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"),
        predict(F.col(text_col)).alias("p"),
    )
    return rows.select("id", "held_out", "p.lang_pred", "p.score")


def labels(text: str, model: LanguageModel) -> list[tuple[str, str]]:
    """The words of a text, lowered, with the likeliest language of each."""
    out = []
    for _, _, words in blocks(pa.array([text])):
        c, p = model.of_words(words)
        for s, e, i in zip(c.words.start, c.words.end, p.argmax(axis=1)):
            out.append((c.words.text[s:e].tobytes().decode(errors="replace"), model.languages[i]))
    return out
