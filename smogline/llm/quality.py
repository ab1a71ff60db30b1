"""Document quality from a linear-chain CRF that labels every line good or bad.

A line's features describe its own characters and words (shares of capitals, digits, marks, bars,
repeats; lengths) and those of the line before and after it. The CRF gives each line the
probability of being good by forward-backward; their mean, weighted by length, goes through a
logistic curve fitted on the same rows and is the score of the document.

*Fitting.* From labelled rows that are not held out, at most ``fit_documents`` are taken, in the
order of a hash of the id, and of each at most ``fit_lines`` evenly spaced lines; their features,
not their texts, come to the driver. Lines start with the label of their document; after a first
fit, lines of bad documents that look good are relabelled and the fit goes on. Scores use text
only: no label, language, source or id.

Defined cases: a text without words (or null) has the share of good documents among the fitted
rows as its score; a null id is never held out; of repeated labels of one id the smallest counts,
null labels do not; without labelled rows of both kinds every score is the known share, or 0.5.
Repeated rows are scored each; an empty table gives none. Columns other than ids, texts and labels,
whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.crf import Adam, marginals
from smogline.llm.words import Words, blocks

_FEATURES = 16
_CLASSES = {  # of bytes
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "high": range(128, 256),
    "bar": b"|", "shout": b"!", "stop": b".,;:?'\"-()", "sign": b"#$%&*+/<=>@[\\]^_`{}~",
}


def _masks() -> np.ndarray:
    out = np.zeros((len(_CLASSES), 256), bool)
    for i, members in enumerate(_CLASSES.values()):
        out[i, list(members)] = True
    return out


_MASKS = _masks()


@dataclass
class Lines:
    """Features of the lines with words, their lengths in bytes, and where each text's begin."""

    features: np.ndarray
    sizes: np.ndarray
    first: np.ndarray


def lines(words: Words) -> Lines:
    """Every line of a block of texts that has a word."""
    text = words.text
    breaks = np.flatnonzero(text == 10)
    edges = np.unique(np.concatenate([words.bounds, breaks + 1, [len(text)]]))
    line_of_word = np.searchsorted(edges, words.start, "right") - 1
    used, first_word = np.unique(line_of_word, return_index=True)
    count = np.diff(np.append(first_word, len(words.start)))
    lo, hi = edges[used], edges[np.minimum(used + 1, len(edges) - 1)]
    size = np.maximum(hi - lo, 1).astype(float)

    shares = []
    for mask in _MASKS:
        sums = np.zeros(len(text) + 1, np.int64)
        np.cumsum(mask[text], out=sums[1:])
        shares.append((sums[hi] - sums[lo]) / size)

    hashes = words.hashes()
    line = np.repeat(np.arange(len(used)), count)

    def per_word(flag: np.ndarray) -> np.ndarray:
        return np.bincount(line, flag, len(used)) / np.maximum(count, 1)

    again = []
    for gap in (1, 2, 3):
        same = np.zeros(len(hashes), bool)
        same[gap:] = (hashes[gap:] == hashes[:-gap]) & (line[gap:] == line[:-gap])
        again.append(per_word(same))
    length = words.end - words.start
    triple = np.zeros(len(hashes), bool)
    long = length > 3
    end = words.end[long]
    triple[long] = (text[end - 1] == text[end - 2]) & (text[end - 2] == text[end - 3])
    features = np.column_stack([
        *shares, *again, per_word(triple), per_word((length == 1).astype(float)),
        per_word(length) / 10, np.log(count) / 5, np.ones(len(used)),
    ])
    own = np.searchsorted(lo, words.bounds)
    return Lines(features, size, own)


def with_neighbours(features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after it, 0 at the ends."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    if len(features):
        before[1:], after[:-1] = features[:-1], features[1:]
        starts = first[:-1][np.diff(first) > 0]
        before[starts] = 0
        after[(first[1:][np.diff(first) > 0]) - 1] = 0
    return np.concatenate([features, before, after], axis=1)


@dataclass
class QualityModel:
    weights: np.ndarray  # (3 * _FEATURES, 2): bad, good
    transitions: np.ndarray
    slope: float
    offset: float
    prior: float

    def share(self, features: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The length-weighted probability of good lines of each text; NaN without lines."""
        good = marginals(with_neighbours(features, first) @ self.weights, first, self.transitions)[0][:, 1]
        weighted = np.concatenate([[0], np.cumsum(good * sizes)])
        total = np.concatenate([[0], np.cumsum(sizes)])
        with np.errstate(invalid="ignore"):
            return np.diff(weighted[first]) / np.diff(total[first])

    def score(self, words: Words) -> np.ndarray:
        found = lines(words)
        share = self.share(found.features, found.sizes, found.first)
        score = 1 / (1 + np.exp(-(self.slope * share + self.offset)))
        return np.where(np.isnan(share), self.prior, score)


def fit(features: np.ndarray, sizes: np.ndarray, first: np.ndarray, labels: np.ndarray, turns: int = 150) -> QualityModel:
    """A model from the lines of labelled documents."""
    used = np.diff(first) > 0
    prior = float(labels.mean()) if len(labels) else 0.5
    model = QualityModel(np.zeros((3 * _FEATURES, 2)), np.zeros((2, 2)), 0.0, 0.0, prior)
    if not used.any() or len(set(labels[used])) < 2:
        model.offset = float(np.log(max(prior, 1e-3) / max(1 - prior, 1e-3)))
        return model
    inputs = with_neighbours(features, first)
    document = np.repeat(np.arange(len(labels)), np.diff(first))
    target = labels[document].astype(int)
    for stage in range(2):
        _train(model, inputs, first, document, target, turns)
        if stage == 0:
            good = marginals(inputs @ model.weights, first, model.transitions)[0][:, 1]
            target = np.where((labels[document] == 0) & (good > 0.5), 1, target)
    share = model.share(features, sizes, first)[used]
    _calibrate(model, share, labels[used])
    return model


def _train(model, inputs, first, document, target, turns) -> None:
    n = len(inputs)
    one_hot = np.eye(2)[target]
    within = document[1:] == document[:-1]
    moves = np.zeros((2, 2))
    np.add.at(moves, (target[:-1][within], target[1:][within]), 1)
    adam = Adam([model.weights, model.transitions], 0.1)
    for _ in range(turns):
        p, pairs = marginals(inputs @ model.weights, first, model.transitions, True)
        adam.step([
            inputs.T @ (p - one_hot) / n + 1e-4 * model.weights,
            (pairs - moves) / n + 1e-3 * model.transitions,
        ])


def _calibrate(model: QualityModel, share: np.ndarray, label: np.ndarray) -> None:
    """A logistic curve from share to label, by Newton steps with a small penalty."""
    x = np.column_stack([share, np.ones(len(share))])
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        w -= np.linalg.solve(hessian, x.T @ (p - label) + 0.05 * w)
    model.slope, model.offset = float(w[0]), float(w[1])


def held_out(id_col: str) -> Column:
    """Rows that are kept from fitting: crc32 of the id as text leaves 0 by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit_on(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fit_documents: int = 3000,
    fit_lines: int = 200,
) -> QualityModel:
    """Fit on at most ``fit_documents`` labelled rows that are not held out."""
    known = labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col)).groupBy(
        F.col(id_col).cast("long").alias("id")
    ).agg(F.min(F.col(label_col).cast("int")).alias("label"))
    taken = known.orderBy(F.xxhash64("id"), "id").limit(fit_documents)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(taken), "id"
    )
    found = rows.mapInArrow(
        lambda b: _described(b, fit_lines), "id long, label int, n int, features binary, sizes binary"
    ).limit(2 * fit_documents).collect()
    found.sort(key=lambda r: (r.id, r.n, bytes(r.features)))
    features = [np.frombuffer(r.features, np.float64).reshape(-1, _FEATURES) for r in found]
    sizes = [np.frombuffer(r.sizes, np.float64) for r in found]
    first = np.cumsum([0, *map(len, sizes)])
    return fit(
        np.concatenate([np.zeros((0, _FEATURES)), *features]), np.concatenate([np.zeros(0), *sizes]),
        first, np.array([r.label for r in found], float),
    )


def _described(batches, most: int):
    for batch in batches:
        ids, label = batch["id"].to_pylist(), batch["label"].to_pylist()
        rows = []
        for lo, hi, words in blocks(batch["text"]):
            found = lines(words)
            for i in range(hi - lo):
                a, b = found.first[i], found.first[i + 1]
                at = np.unique(np.linspace(a, b - 1, min(most, b - a)).astype(int)) if b > a else np.zeros(0, int)
                rows.append((ids[lo + i], label[lo + i], len(at),
                             found.features[at].tobytes(), found.sizes[at].tobytes()))
        columns = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        names = ["id", "label", "n", "features", "sizes"]
        yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def score_udf(model: QualityModel):
    """A column function from text to score, batch by batch."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [model.score(words) for _, _, words in blocks(texts)]
        return pa.array(np.concatenate([np.zeros(0), *parts]))

    return score


def scored(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) for every row."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"),
        score_udf(model)(F.col(text_col)).alias("score"),
    )
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns."""
    return docs.where(score_udf(model)(F.col(f"`{text_col}`")) >= threshold)
