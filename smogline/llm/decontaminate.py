"""Benchmark passages in documents, by winnowing. DataFrame functions only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lowered. A window is ``size``
consecutive words of an item; an item of fewer words, but not none, is one window. A word of a
document is hit if it lies inside any occurrence of a window.

*Winnowing*: of every run of ``size - k + 1`` successive k-gram hashes the smallest is kept as a
fingerprint. Two texts that share a window share the fingerprint kept in it, so no occurrence is
missed. An item of fewer words is looked up by a k-gram as long as itself, each one kept, which is
the same rule for windows of its length.

1. Each document is scanned once for its words and fingerprints, which are stored.
2. Fingerprints of documents are joined with the distinct ones of the benchmark.
3. Documents with hits are read again, and the places of known fingerprints in them are found by a
   join. Each is extended to the windows of words that contain it, and these are joined with the
   windows of the benchmark by their words, not by a hash.

The distinct fingerprints and windows of the benchmark are broadcast if they take at most
``groups.BROADCAST_BYTES``; beyond, the joins shuffle.

Defined cases: null texts and texts without words have no words and are not contaminated; null
ids of documents are ids like others; rows of one id are judged by their own texts; without items
nothing is hit. Items without an id hit like others; together they count as one item in ``n_items``
and are not listed. Columns other than ids and texts, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.llm.groups import checked, row_key
from smogline.session import stored

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    """The words of a text, in order. ASCII texts take the faster of two ways to lower A-Z."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.filter(F.split(lowered, _GAPS), lambda w: w != "")


def _grams(words: Column, k: int) -> Column:
    """The hash of each run of k words; its place in the array is where it starts, less 1."""
    last = F.size(words) - k + 1
    starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.lit(k), F.slice(words, i, F.lit(k))))


def _with_prints(rows: DataFrame, plans: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with a column ``prints``: the distinct kept k-gram hashes under each (k, run).

    The k-grams are columns of their own, as an expression inside a lambda is worked out again
    for every element.
    """
    kept = []
    for k, run in plans:
        rows = rows.withColumn(f"grams{k}", _grams(F.col("words"), k))
        kept.append(_smallest(F.col(f"grams{k}"), run) if run > 1 else F.col(f"grams{k}"))
    return rows.withColumn("prints", F.array_distinct(F.concat(*kept)))


def _smallest(grams: Column, run: int) -> Column:
    last = F.size(grams) - run + 1
    starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_min(F.slice(grams, i, F.lit(run))))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 10,
    k: int = 5,
) -> DataFrame:
    """(id, key, n_words, n_hit, n_items, items) for every row; items: sorted item ids, as strings.

    ``key`` tells rows of one id by their texts.
    """
    items = stored(_items(benchmark, item_col, item_text_col, size), "windows")
    lengths = [r.length for r in items.select("length").distinct().collect()]  # at most ``size``
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.withColumn("key", row_key("id", "text"))
    plans = {n: (k, size - k + 1) if n == size else (n, 1) for n in lengths}

    scanned = texts.select("id", "key", _words(F.col("text")).alias("words"))
    scanned = stored(
        _with_prints(scanned, sorted(set(plans.values()) or {(k, 1)}))
        .select("id", "key", F.size("words").cast("long").alias("n_words"), "prints"),
        "prints",
    )
    rows = scanned.select("id", "key", "n_words")
    if not plans:
        return rows.select("*", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                           F.array().cast("array<string>").alias("items"))

    known = stored(_item_prints(items, plans).distinct(), "known")
    hits = stored(
        scanned.select("key", F.explode("prints").alias("print")).join(checked(known), "print", "left_semi")
        .select("key").distinct(), "hits",
    )
    near = stored(
        texts.select("key", "text").join(checked(hits), "key", "left_semi")
        .select("key", _words(F.col("text")).alias("words")).dropDuplicates(["key"]), "near",
    )
    windows = None
    for n, (gram, run) in plans.items():
        own = near.join(_places(near, known, gram), "key").select("key", "words", F.explode(_starts("places", run)).alias("start"))
        own = own.where(F.col("start") <= F.size("words") - n + 1).select(
            "key", "start", F.lit(n).alias("length"),
            F.array_join(F.slice("words", F.col("start"), F.lit(n)), " ").alias("window"),
        )
        windows = own if windows is None else windows.unionByName(own)
    distinct = stored(items.select("window", "length").distinct(), "distinct")
    hit = stored(windows.join(checked(distinct), ["window", "length"], "left_semi"), "hit")

    span = F.struct("start", (F.col("start") + F.col("length")).alias("end"))
    covered = hit.groupBy("key").agg(F.sort_array(F.collect_list(span)).alias("spans")).select(
        "key", _covered("spans").alias("n_hit")
    )
    of_doc = (
        hit.select("key", "window", "length").distinct()
        .join(items, ["window", "length"]).select("key", "item").distinct()
        .groupBy("key").agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
    )
    return rows.join(covered.join(of_doc, "key"), "key", "left").select(
        "id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _items(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """(item, window, length): the distinct windows of each item."""
    words = benchmark.select(F.col(item_col).cast("string").alias("item"), _words(F.col(text_col)).alias("words"))
    length = F.least(F.size("words"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    return (
        words.where(F.size("words") > 0)
        .select("item", "words", length.alias("length"), F.explode(starts).alias("start"))
        .select("item", F.array_join(F.slice("words", F.col("start"), F.col("length")), " ").alias("window"), "length")
        .distinct()
    )


def _item_prints(items: DataFrame, plans: dict[int, tuple[int, int]]) -> DataFrame:
    """(print): the fingerprints of the windows of items, each under the plan of its length."""
    out = None
    for n, plan in plans.items():
        own = items.where(F.col("length") == n).select(F.split("window", " ").alias("words"))
        own = _with_prints(own, [plan]).select(F.explode("prints").alias("print"))
        out = own if out is None else out.unionByName(own)
    return out


def _places(near: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """(key, places): where the documents have a known fingerprint, in order."""
    grams = near.select("key", F.posexplode(_grams(F.col("words"), k)).alias("at", "print"))
    found = grams.join(checked(known), "print", "left_semi")
    return found.groupBy("key").agg(F.sort_array(F.collect_list(F.col("at") + 1)).alias("places"))  # of one document


def _starts(places: str, run: int) -> Column:
    """Where windows that contain one of the places begin, each once."""
    p = F.col(places)
    return F.flatten(F.transform(p, lambda at, i: F.sequence(
        F.greatest(at - (run - 1), F.lit(1), F.coalesce(F.get(p, i - 1), F.lit(0)) + 1), at
    )))


def _covered(spans: str) -> Column:
    """How many words sorted (start, end) spans cover together."""
    begin = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        F.col(spans), begin,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], s["end"]).alias("end"),
        ),
        lambda a: a["n"],
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, all columns."""
    found = contamination(docs, benchmark, id_col, text_col, **options)
    bad = stored(found.where("n_hit > 0").select("key").distinct(), "contaminated")
    body = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("body"),
                       row_key(f"`{id_col}`", f"`{text_col}`").alias("key"))
    return body.join(checked(bad), "key", "left_anti").select("body.*")
