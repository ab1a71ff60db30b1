"""Hard negatives: candidates of another label whose score lies in a window below a positive's score.

Rows are dealt over trees by their number in the stored table, so no key or group of copies decides
how much a tree holds; a tree has at most about ``tree_rows`` rows and is built in the task that
searches it (``cover_tree``). Every anchor goes to every tree, in blocks: a stated query set against all
rows. A task reads the rows of its tree, then the anchors batch by batch, so its memory is one tree
and one block of anchors. What trees find is merged per anchor: at most ``positives`` rows a tree, then
``negatives`` rows a tree and positive. The first search finds positives, the second looks into the
windows they give.

Defined cases: rows with a null id, label or vector, or a null or non-finite component, take no part;
a shorter vector counts as filled up with zeros; a repeated row is a row of its own, and one that
repeats an anchor is another row; an anchor without positives has no result, nor has a positive whose
window is empty; an empty table gives none. Scores are exact integers; vectors whose inner products
could reach 2**53 raise an error. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.cover_tree import CoverTree, Search
from smogline.session import stored

TREE_ROWS = 1 << 16
LEAST_TREES = 24  # for parallelism on small tables
BLOCK = 512  # anchors searched at once
_FOUND = "anchor long, w int, score long, id long"


def prepared(vectors: DataFrame, id_col: str, label: Column, components: Column) -> DataFrame:
    """(row, id, label, vec): the rows that take part, numbered, in a table of their own."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("int").alias("label"), components.alias("vec")
    )
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~F.exists(
        F.col("vec"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    # numbered before they are written, used after that: the numbers are fixed whatever is computed again
    return stored(rows.where(F.coalesce(usable, F.lit(False))).withColumn("row", F.monotonically_increasing_id()), "vectors")


def mined(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3,
    window: tuple[int, int] = (50, 95), tree_rows: int = TREE_ROWS, least_trees: int = LEAST_TREES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` comes from :func:`prepared`; ``anchors`` is a condition on its columns. ``window`` is the
    inclusive range of negative scores in hundredths of the positive's score.
    """
    trees = max(least_trees, -(-vectors.count() // tree_rows))
    asked = vectors.where(anchors)
    none = F.array().cast("array<long>")
    best = _searched(vectors, asked.withColumn("near", none), trees, positives, None)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    near = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    near = stored(near.select("anchor", "rank", F.col("score").alias("p_score"), F.col("id").alias("p_id")), "positives")
    scores = near.groupBy("anchor").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "p_score"))), lambda x: x["p_score"]).alias("near")
    )
    again = asked.join(scores, F.col("row") == F.col("anchor")).drop("anchor")
    far = _searched(vectors, again, trees, negatives, window)
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id")
    far = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        far.withColumnRenamed("score", "n_score")
        .join(near.select("anchor", (F.col("rank") - 1).alias("w"), "p_score", "p_id"), ["anchor", "w"])
        .join(named, "anchor")
        .select("anchor_id", F.col("p_id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
                F.col("p_score").alias("positive_score"), F.col("n_score").alias("negative_score"))
    )


def _searched(
    vectors: DataFrame, asked: DataFrame, trees: int, keep: int, window: tuple[int, int] | None
) -> DataFrame:
    """(anchor, w, score, id): the best of every tree for every anchor and window."""
    columns = ["tree", "kind", "row", "id", "label", "vec", "near"]
    held = vectors.select(
        F.pmod(F.xxhash64("row"), F.lit(trees)).cast("int").alias("tree"), F.lit(0).alias("kind"),
        "row", "id", "label", "vec", F.lit(None).cast("array<long>").alias("near"),
    )
    asking = asked.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("kind", F.lit(1))
    dealt = held.select(columns).unionByName(asking.select(columns)).repartition(trees, "tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _run(batches, keep, window)

    return dealt.sortWithinPartitions("tree", "kind").mapInArrow(run, _FOUND)


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), max(1, int(sizes.max(initial=0)))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def _run(batches: Iterator[pa.RecordBatch], keep: int, window: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tree, those of the tree before its anchors."""
    number, parts, tree = None, [], None
    for batch in batches:
        of = batch["tree"].to_numpy()
        kinds = batch["kind"].to_numpy()
        cuts = np.flatnonzero((np.diff(of) != 0) | (np.diff(kinds) != 0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(of)]):
            if hi == lo:
                continue
            if of[lo] != number:
                number, parts, tree = of[lo], [], None
            piece = batch.slice(lo, hi - lo)
            if kinds[lo] == 0:
                parts.append(piece)
                continue
            if parts:
                tree, parts = _tree(parts), []
            if tree is not None:
                for i in range(0, piece.num_rows, BLOCK):
                    yield _answers(piece.slice(i, BLOCK), tree, keep, window)


def _tree(parts: list[pa.RecordBatch]) -> CoverTree:
    found = [_matrix(p["vec"]) for p in parts]
    width = max(m.shape[1] for m in found)
    column = lambda name: np.concatenate([p[name].to_numpy() for p in parts])
    points = np.concatenate([_widened(m, width) for m in found])
    return CoverTree(points, column("row"), column("id"), column("label"))


def _answers(
    asked: pa.RecordBatch, tree: CoverTree, keep: int, window: tuple[int, int] | None
) -> pa.RecordBatch:
    queries = _matrix(asked["vec"])
    width = max(queries.shape[1], tree.points.shape[1])
    if tree.points.shape[1] < width:
        tree.points, tree.centres = _widened(tree.points, width), _widened(tree.centres, width)
    if window is None:
        low, high = np.full((len(queries), 1), -np.inf), np.full((len(queries), 1), np.inf)
    else:
        near = _matrix(asked["near"])
        there = np.arange(near.shape[1]) < np.diff(asked["near"].offsets.to_numpy())[:, None]
        near = near.astype(np.int64)
        low = np.where(there, -((-window[0] * near) // 100), np.inf)
        high = np.where(there, (window[1] * near) // 100, -np.inf)
    rows = asked["row"].to_numpy()
    search = Search(_widened(queries, width), rows, asked["label"].to_numpy(), low, high, keep, window is None)
    search.descend(tree)
    who, w, rank = np.nonzero(search.score > -np.inf)
    return pa.record_batch({
        "anchor": pa.array(rows[who], pa.int64()), "w": pa.array(w.astype(np.int32)),
        "score": pa.array(search.score[who, w, rank].astype(np.int64)), "id": pa.array(search.ident[who, w, rank]),
    })
