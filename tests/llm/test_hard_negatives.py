"""Hard negatives against brute force; the tree's bounds and what it skips."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogline.llm import hard_negatives
from smogline.llm.cover_tree import LEAF, CoverTree, Search, exact_type


def brute(rows, positives=5, negatives=3):
    """rows: (id, label, vec)."""
    out = []
    width = max((len(v) for _, _, v in rows), default=0)
    vecs = [list(v) + [0] * (width - len(v)) for _, _, v in rows]
    for n, (i, label, _) in enumerate(rows):
        if i % 50:
            continue
        scores = [(sum(int(a) * int(b) for a, b in zip(vecs[n], vecs[m])), rows[m][0], rows[m][1]) for m in range(len(rows)) if m != n]
        scores.sort(key=lambda x: (-x[0], x[1]))
        for p, p_id, _ in [s for s in scores if s[2] == label][:positives]:
            fits = [s for s in scores if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p][:negatives]
            out += [(i, p_id, rank, s[1], p, s[0]) for rank, s in enumerate(fits, 1)]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, row string").repartition(3)
    vectors = hard_negatives.prepared(frame, "vec_id", F.col("label"), F.col("embedding"))
    return sorted(map(tuple, hard_negatives.mined(vectors, F.col("id") % 50 == 0, **options).collect()))


def test_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(3)), [float(x) for x in rng.integers(-9, 10, 6)]) for i in range(400)]
    rows += [(1000 + i, 1, rows[0][2]) for i in range(200)] + [(2000, 2, rows[50][2])] * 3 + [(50, 1, rows[7][2])]
    rows += [(5000, 7, [1.0] * 6), (5001, 1, []), (5002, 0, [3.0, 4.0]), (5050, 2, [0.0] * 6)]
    want = brute(rows)
    for options in ({"least_trees": 1}, {"least_trees": 7}, {"tree_rows": 50}):
        assert run(spark, [(*r, "x") for r in rows], **options) == want
    assert len(want) > 50


def test_rows_that_take_no_part(spark):
    good = [(0, 1, [2.0, 0.0], "x"), (1, 1, [2.0, 0.0], "x"), (2, 0, [1.5, 1.0], "x")]
    bad = [(3, None, [2.0, 0.0], "x"), (4, 0, None, "x"), (5, 0, [1.8, None], "x"), (6, 0, [1.8, float("nan")], "x"),
           (7, 0, [float("inf"), 0.0], "x"), (None, 0, [1.8, 0.0], "x")]
    assert run(spark, good + bad) == [(0, 1, 1, 2, 4, 3)]
    assert run(spark, bad) == []


def test_too_large_vectors_are_refused():
    assert exact_type(100) == np.float32 and exact_type(2**40) == np.float64
    with pytest.raises(ValueError, match="scale"):
        exact_type(2**53)


def test_windows_at_their_edges(spark):
    rows = [(0, 1, [10.0, 0.0], "x"), (1, 1, [10.0, 0.0], "x")]
    rows += [(i, 0, [x, 0.0], "x") for i, x in ((2, 9.5), (3, 9.6), (4, 5.0), (5, 4.9), (6, 9.5))]
    scaled = [(i, k, [v * 10 for v in e], x) for i, k, e, x in rows]
    assert [r[3] for r in run(spark, scaled)] == [2, 6, 4]


def test_tree_covers_its_points_and_skips_the_rest():
    rng = np.random.default_rng(2)
    centres = rng.integers(-200, 200, (12, 8))
    points = np.concatenate([c + rng.integers(-3, 4, (400, 8)) for c in centres] + [np.tile(centres[0], (700, 1))]).astype(float)
    ids = rng.permutation(len(points))
    labels = ids % 2
    tree = CoverTree(points, ids, ids, labels)
    lifted = np.column_stack([points, np.sqrt(tree.top - (points**2).sum(1))])
    held = np.zeros(len(points), int)
    for node, children in enumerate(tree.children):
        if not children:
            part = tree.leaf[node]
            held[part] += 1
            assert len(part) <= LEAF
            away = np.linalg.norm(lifted[part] - lifted[tree.centre[node]], axis=1)
            assert away.max() <= tree.radii[node] + 1e-9 and tree.least[node] == ids[part].min()
    assert (held == 1).all()
    queries = points[:40]
    none = np.full((40, 1), np.inf)
    search = Search(queries, ids[:40], labels[:40], -none, none, 5, True)
    verified = search.descend(tree)
    scores = queries @ points.T
    for q in range(40):
        fits = sorted((-s, i) for s, i, k, in zip(scores[q], ids, labels) if k == labels[q] and i != ids[q])[:5]
        assert [(-a, b) for a, b in zip(search.score[q, 0], search.ident[q, 0])] == fits
    assert verified < 0.3 * 40 * len(points)
