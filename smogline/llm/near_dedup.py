"""Near duplicates by bottom-k sketches from one hash function.

A document's set are its distinct shingles of ``size`` words (all its words, if fewer), letters
A-Z lowered. Two documents are linked if 100 * intersection >= 100 * threshold * union.

1. *Fingerprints*: the ``k`` smallest shingle hashes, the size of the set and a digest of the
   whole set. Documents of equal sets collapse into one vertex, so copies cost nothing further.
2. *Suspects*: sets that share at least a sixth of their ``first`` smallest hashes with others. Of
   the 24 smallest of a union, a pair at the threshold shares fewer than 4 with probability 2e-10.
3. *Inverted lists* of retained values. A pair at the threshold shares 3/4 of its retained values;
   ``overlap`` of them is asked for, 6.5 standard deviations less, and so a pair has a value in
   common among each side's k - overlap * k + 1 rarest: the frequent values, such as those of
   passages that many documents share, have no lists.
4. Each list compares its members with one of them, the centre, which has the largest share of
   values that others have too. Pairs pass if the sketch of their union estimates a similarity
   within 6 standard deviations of the threshold; exact Jaccard over the full sets then decides.
5. Components of these links. A member that did not come to the component of its centre is a
   *stray*. Strays are joined with all members of such lists over their full sets, by prefix and
   position in the order of rarity: what a stray has alone bounds its overlap with anything, so
   those that differ from a large group in shingles of their own are not compared with each
   member of the group. The bound is exact, so no link between components is lost, and a group of
   n near copies costs about n comparisons instead of n * n / 2.

Defined cases: a document without words has an empty set and is linked with nothing; a null id
is allowed and never chosen as the smallest; rows of one id are documents of their own; an empty
table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.components import components
from smogline.llm.groups import attach, checked, row_key
from smogline.llm.words import blocks, spans_hash
from smogline.session import stored

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SETS = "id long, key binary, items array<long>"
_PRINTS = "id long, doc string, key binary, n long, sketch array<long>"


def shingle_sets(column: pa.ChunkedArray | pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct 63-bit shingle hashes of each text, in order; null is empty."""
    for lo, hi, words in blocks(column):
        words.text = _LOWER[words.text]
        hashes = words.hashes()
        starts, counts, first = words.windows(size), words.counts, words.first
        whole = spans_hash(hashes, starts, starts + size) >> np.uint64(1)
        few = np.flatnonzero((counts > 0) & (counts < size))
        short = spans_hash(hashes, first[few], first[few + 1]) >> np.uint64(1)
        short_of = dict(zip(few.tolist(), short))
        ends = np.searchsorted(starts, first)
        for i in range(hi - lo):
            if i in short_of:
                yield np.array([short_of[i]], np.int64)
            else:
                yield np.unique(whole[ends[i] : ends[i + 1]]).view(np.int64)


def _digest(items: np.ndarray) -> bytes | None:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *rows]))
    )


def _prints(batches, size: int, k: int):
    for batch in batches:
        sets = list(shingle_sets(batch["text"], size))
        yield pa.record_batch({
            "id": batch["id"], "doc": batch["doc"],
            "key": pa.array([_digest(s) for s in sets], pa.binary()),
            "n": pa.array([len(s) for s in sets], pa.int64()),
            "sketch": _lists([s[:k] for s in sets]),
        })


def _full(batches, size: int):
    for batch in batches:
        sets = list(shingle_sets(batch["text"], size))
        yield pa.record_batch({
            "id": batch["id"], "key": pa.array([_digest(s) for s in sets], pa.binary()),
            "items": _lists(sets),
        })


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: float = 0.75,
    k: int = 128,
    first: int = 24,
    overlap: float = 0.5,
) -> DataFrame:
    """(id, doc, n_shingles, component, component_id) for every row.

    ``component_id`` is the smallest id that links lead to; ``component`` is a number of the
    component, which repeated ids do not blur; ``doc`` tells rows of one id by their texts. Works
    in steps, with tables in the shared folder between them.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.withColumn("doc", row_key("id", "text"))
    prints = stored(
        texts.mapInArrow(lambda b: _prints(b, size, k), _PRINTS)
        .withColumn("row", F.monotonically_increasing_id()),
        "prints",
    )
    links = _links(texts, prints, size, threshold, k, first, overlap)
    owners = attach(
        prints.select("id", "doc", "key", "n", "row"), "key", "row",
        {"v_": F.min("row"), "id_": F.min("id")}, {"v": F.min("v_"), "low": F.min("id_")},
    )
    found = components(links)
    sets = owners.groupBy("v").agg(F.first("low").alias("low"))
    lowest = sets.join(found, "v").groupBy("comp").agg(F.min("low").alias("least"))
    comp_of = found.join(lowest, "comp").select("v", "comp", "least")
    with_words = owners.join(comp_of, "v", "left").select(
        "id", "doc", F.col("n").alias("n_shingles"), F.coalesce("comp", "v").alias("component"),
        F.coalesce("least", "low").alias("component_id"),
    )
    empty = prints.where("key is null").select(
        "id", "doc", F.col("n").alias("n_shingles"), F.col("row").alias("component"),
        F.col("id").alias("component_id"),
    )
    return with_words.unionByName(empty)


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one of each group of near duplicates, the one with the smallest id.

    All columns; rows without words all stay. Rows to drop are few against rows that stay, so they
    are what is joined; texts are shuffled only where that list is too long to be sent around.
    """
    groups = near_groups(docs, id_col, text_col, **options)
    place = F.struct(F.col("id").isNull().alias("none"), "id", "doc")
    judged = stored(attach(groups, "component", "doc", {"b_": F.min(place)}, {"best": F.min("b_")}), "judged")
    of_doc = judged.groupBy("doc").agg(
        F.max(F.col("doc") == F.col("best.doc")).alias("stays"), F.count("*").alias("rows"),
        F.max("n_shingles").alias("n"),
    )
    lists = stored(of_doc.where("not stays or (rows > 1 and n > 0)"), "dropped")
    gone, again = (stored(lists.where(c).select("doc"), "dropped") for c in ("not stays", "stays"))
    body = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("body"),
                       row_key(f"`{id_col}`", f"`{text_col}`").alias("doc"))
    left = body.join(checked(gone), "doc", "left_anti")
    once = left.join(checked(again), "doc", "left_semi").dropDuplicates(["doc"])
    return left.join(checked(again), "doc", "left_anti").unionByName(once).select("body.*")


def _links(texts, prints, size, threshold, k, first, overlap) -> DataFrame:
    """(a, b): vertices whose sets are linked; a spanning part of all links of each component."""
    suspects = stored(_suspects(prints, first), "suspects")
    members = stored(
        prints.withColumn("short", F.xxhash64("key")).join(checked(suspects), "short", "left_semi")
        .groupBy("key").agg(F.min("row").alias("v"), F.first("n").alias("n"),
                            F.first("sketch").alias("sketch")),
        "members",
    )
    lists = stored(_rare_lists(members, overlap), "lists")
    listed = stored(lists.select("v").distinct().join(members.select("v", "key", "n"), "v"), "listed")
    items = stored(_items(texts, listed, size), "items")

    centred = stored(attach(
        lists, "value", "v",
        {"c_": F.max(F.struct("typical", (-F.col("v")).alias("low"), "n"))}, {"centre": F.max("c_")},
    ).select("value", "v", "n", (-F.col("centre.low")).alias("centre"), F.col("centre.n").alias("cn")),
        "centred")
    near = centred.where(
        (F.col("v") != F.col("centre"))
        & (F.least("n", "cn") >= threshold * F.greatest("n", "cn"))
    ).select(F.col("centre").alias("a"), F.col("v").alias("b")).distinct()
    likely = _likely(near, members, threshold, k)
    links = stored(_linked(likely, items, threshold), "linked")

    comp = components(links)
    of_member = centred.join(comp.withColumnRenamed("comp", "c"), "v", "left")
    of_centre = comp.select(F.col("v").alias("centre"), F.col("comp").alias("cc"))
    placed = of_member.join(of_centre, "centre", "left").select(
        "value", "v", F.coalesce("c", "v").alias("c"), F.coalesce("cc", "centre").alias("cc")
    )
    placed = stored(placed.withColumn("stray", F.col("c") != F.col("cc")), "placed")
    mixed = placed.where("stray").select("value").distinct()
    around = stored(
        placed.join(mixed, "value", "left_semi").groupBy("v").agg(
            F.first("c").alias("c"), F.max("stray").alias("stray")
        ),
        "around",
    )
    return links.union(stored(_linked(_overlapping(around, items, threshold), items, threshold), "linked"))


def _suspects(prints: DataFrame, first: int) -> DataFrame:
    """(short): a hash of each key with enough early values that another set has too."""
    early = prints.where("key is not null").select(
        F.xxhash64("key").alias("short"), F.least("n", F.lit(first)).alias("f"),
        F.explode(F.slice("sketch", 1, first)).alias("value"),
    )
    shared = attach(
        early, "value", "short",
        {"x_": F.min("short"), "y_": F.max("short")}, {"x": F.min("x_"), "y": F.max("y_")}, "x != y",
    ).select("short", "f", "value").distinct()
    return shared.groupBy("short", "f").count().where("6 * count >= f").select("short").distinct()


def _rare_lists(members: DataFrame, overlap: float) -> DataFrame:
    """(value, v, n, typical): a vertex under its rarest retained values, where others have them too."""
    retained = members.select("v", "n", F.size("sketch").alias("s"), F.explode("sketch").alias("value"))
    counted = attach(retained, "value", "v", {"d_": F.count("*")}, {"df": F.sum("d_")}, "df > 1")
    ranked = (
        counted.groupBy("v", "n", "s")  # at most k values of each vertex
        .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"))
    )
    asked = F.ceil(F.lit(overlap) * F.col("s")).cast("int")
    use = F.size("values") - asked + 1  # the others, before these in order, have no second owner
    return ranked.where(use > 0).select(
        "v", "n", (F.size("values") / F.col("s")).alias("typical"),
        F.explode(F.slice("values", F.lit(1), use)).alias("x"),
    ).select("x.value", "v", "n", "typical")


def _items(texts: DataFrame, listed: DataFrame, size: int) -> DataFrame:
    """(v, n, items): the full set of every listed vertex, from the texts again."""
    sets = texts.mapInArrow(lambda b: _full(b, size), _SETS).where("key is not null")
    sets = sets.join(checked(listed), "key").select("v", "n", "items")
    return sets.groupBy("v").agg(F.first("n").alias("n"), F.first("items").alias("items"))


def _overlapping(around: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """(a, an, b, bn): strays and members of other components whose full sets may overlap enough.

    Values are put in order of rarity. If the first value that two sets have in common is at
    place i of one and j of the other, they share at most 1 + min(an - i, bn - j) values; a link
    asks for threshold / (1 + threshold) of an + bn. Places where no owner of the value is small
    enough for that are left out before the join.
    """
    owned = items.join(around.select("v"), "v", "left_semi").select("v", "n", F.explode("items").alias("value"))
    counted = attach(
        owned, "value", "v",
        {"d_": F.count("*"), "m_": F.min("n")}, {"df": F.sum("d_"), "least": F.min("m_")}, "df > 1",
    )
    rare = (
        counted.groupBy("v", "n")  # values of one document
        .agg(F.sort_array(F.collect_list(F.struct("df", "value", "least"))).alias("values"))
        .join(around, "v")
    )
    alone = F.col("n") - F.size("values")
    share = threshold / (1 + threshold)
    places = rare.select("v", "c", "stray", "n", alone.alias("alone"), F.posexplode("values")).select(
        "v", "c", "stray", "n", "col.value", "col.least",
        (F.col("n") - F.col("alone") - F.col("pos")).alias("left"),  # 1 + n - place
    ).where(F.col("left") + 1e-6 >= share * (F.col("n") + F.greatest("least", F.ceil(threshold * F.col("n")))))
    one = places.where("stray").select("value", F.col("v").alias("a"), F.col("n").alias("an"),
                                       F.col("c").alias("ac"), F.col("left").alias("al"))
    two = places.select("value", F.col("v").alias("b"), F.col("n").alias("bn"), F.col("c").alias("bc"),
                        F.col("left").alias("bl"), F.col("stray").alias("bs"))
    return one.join(two, "value").where(
        (F.col("ac") != F.col("bc")) & (~F.col("bs") | (F.col("a") < F.col("b")))
        & (F.least("al", "bl") + 1e-6 >= share * (F.col("an") + F.col("bn")))
        & (F.least("an", "bn") >= threshold * F.greatest("an", "bn"))
    ).select("a", "an", "b", "bn").distinct()


def _likely(pairs: DataFrame, members: DataFrame, threshold: float, k: int) -> DataFrame:
    """Pairs (a, b) that the sketch of their union lets pass, with the sizes of their sets."""
    def side(name: str) -> DataFrame:
        return members.select(F.col("v").alias(name), F.col("n").alias(f"{name}n"),
                              F.col("sketch").alias(f"{name}s"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    union = F.slice(F.array_sort(F.array_union("as", "bs")), 1, k)
    common = F.size(F.array_intersect(union, F.array_intersect("as", "bs")))
    slack = 6 * (threshold * (1 - threshold) / k) ** 0.5
    return both.where(common >= (threshold - slack) * F.size(union)).select("a", "an", "b", "bn")


def _linked(pairs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """Pairs that the full sets confirm."""
    full = pairs.join(items.select(F.col("v").alias("a"), F.col("items").alias("ai")), "a").join(
        items.select(F.col("v").alias("b"), F.col("items").alias("bi")), "b"
    )
    common = F.size(F.array_intersect("ai", "bi"))
    return full.where(
        100 * common >= round(100 * threshold) * (F.col("an") + F.col("bn") - common)
    ).select("a", "b")
