"""Personal data in texts: wide candidates, boosted trees, calibrated thresholds. No Python on executors.

*Base spans* are the matches of four fixed patterns that pass their checks; they always count.

*Candidates* come from those patterns, checks aside, and from wider ones (addresses with the signs
spelt out, numbers grouped in other ways, telephone numbers without a country). They may overlap.
Gradient-boosted trees score candidates by format (length, digits, separators, kinds of characters,
whether the signs make a sound address or number) and context (what stands before and after, telling
words).

*Labels.* No labelled spans exist, so matches of the base patterns are rewritten in the ways in which
people disguise them, and in ways that only look alike (``_forms``): a passing match spelt out or regrouped
stays personal data, a failing one does not become any, and an e-mail address turned into a price or a
sentence is none. So every kind has both outcomes in every format, and the kind tells nothing of the label. The
trees are fitted on the forms of different matches (with what stands around them), an equal share of
``fit_candidates`` for each kind and outcome, a quarter of them left out. The forms of all matches that were
not fitted on give, for each kind, the lowest threshold at which ``precision`` of what is selected is
right. Candidates above it are added, unless they overlap a base span or an added one that starts
earlier; one that is not added hides no other.

Texts are read once. Places follow from the lengths of matches and of the texts between them, by
sums over the matches of one document.

Defined cases: null texts are empty; rows of one id are documents of their own; a table without
candidates, or without both outcomes of the checks among the matches to fit on, has base spans only,
and so has a kind without a match of its base pattern; empty tables give empty results. Places count
code points, ends are exclusive. Columns other than id and text, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.session import stored

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns, written so that no start is tried twice and no loop recurses.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Wider patterns.
WIDE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+"
             r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z]{2,24})+",
    "ip": r"(?<![0-9])[0-9]{1,3}(?: ?(?:\.|\[\.\]|\(dot\)) ?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{3,6}(?:[ ./_-]{1,2}[0-9]{3,6}){2,5}(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{2,4}\)?[ ./-][0-9]{3,4}[ ./-][0-9]{3,4}(?![0-9])",
}
#: Words that tell the kind of what follows.
TELLING = {
    "email": r"mail|contact|write|@", "ip": r"\bip\b|address|host|server|login",
    "card": r"card|visa|master|pay|account|credit", "phone": r"phone|tel|call|mobile|fax",
    "other": r"version|order|isbn|id\b|no\.|number|ref|token|key|=|#",
}
_BEFORE, _AFTER = 24, 12


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(row, id) of every row, and (row, kind, start, end, base, strict, match, before, after)."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    parts = []
    for strict, patterns in ((True, BASE), (False, WIDE)):
        for number, kind in enumerate(KINDS):
            name, pattern = f"{kind}_{int(strict)}", patterns[kind]
            rows = rows.withColumn(f"{name}_m", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
            rows = rows.withColumn(
                f"{name}_g", F.when(F.size(f"{name}_m") > 0, F.split("text", pattern, -1))
            )
            parts.append(_matches(f"{name}_m", F.col(f"{name}_g"), number, strict))
    found = stored(rows.select("row", "id", F.concat(*parts).alias("found")), "found")
    each = found.where(F.size("found") > 0).select("row", F.explode("found").alias("x")).select("row", "x.*")
    so_far = Window.partitionBy("row", "kind", "strict").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(so_far)
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))
    placed = placed.withColumn("base", F.col("strict") & _passes())
    return found.select("row", "id"), stored(placed.drop("i", "gap"), "candidates")


def _matches(matches: str, gaps: Column, kind: int, strict: bool) -> Column:
    """A struct for each match, with its number and what stands between it and its neighbours."""
    return F.transform(matches, lambda m, i: F.struct(
        F.lit(kind).alias("kind"), F.lit(strict).alias("strict"), i.alias("i"), m.alias("match"),
        F.length(F.get(gaps, i)).alias("gap"), F.right(F.get(gaps, i), F.lit(_BEFORE)).alias("before"),
        F.left(F.get(gaps, i + 1), F.lit(_AFTER)).alias("after"),
    ))


def _passes(match: Column | None = None) -> Column:
    """The check of a match's kind."""
    match = F.col("match") if match is None else match
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    short = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    ip = F.forall(short, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    # the digit at place i from the end, doubled where i is odd, less 9 if that has two digits
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: d.cast("int") * (1 + i % 2))
    luhn = F.aggregate(values, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0
    return (
        F.when(F.col("kind") == 0, F.lit(True)).when(F.col("kind") == 1, ip)
        .when(F.col("kind") == 2, F.when(n.between(14, 19), luhn).otherwise(False))
        .otherwise(n.between(10, 15))
    )


_AT, _DOT = r" ?(?:@|\(at\)|\[at\]) ?", r" ?(?:\.|\(dot\)|\[dot\]) ?"


def _sound() -> Column:
    """Do the signs of a match, however they are written, make an address or number of its kind?"""
    plain = F.regexp_replace(F.regexp_replace("match", f"(?i){_AT}", "@"), f"(?i){_DOT}", ".")
    email = plain.rlike(r"^[A-Za-z0-9._%+-]*[A-Za-z][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[a-z]{2,24}$")
    ip = F.regexp_replace("match", "[^0-9]+", ".")
    return F.when(F.col("kind") == 0, email).otherwise(_passes(F.when(F.col("kind") == 1, ip).otherwise(F.col("match"))))


def _forms() -> Column:
    """A base match in other writings: structs of the text and whether it is personal data.

    Rewritten e-mail addresses that are none: a number at a place ("12 @ example.Joe") and sentences
    that meet at a sign ("joe @ example. See").
    """
    match, right = F.col("match"), F.col("base")
    form = lambda text, label=right: F.struct(text.alias("match"), label.cast("double").alias("label"))
    lit, cut = F.lit, lambda p, g=0: F.regexp_extract("match", p, g)
    word = F.coalesce(F.nullif(F.lower(cut("[A-Za-z]{2,24}")), lit("")), lit("see"))
    house, sound = cut("@([A-Za-z0-9-]+)", 1), _sound()
    local, domain = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    number = (F.pmod(F.xxhash64("match"), lit(90)) + 10).cast("string")
    dotted = lambda sign: F.regexp_replace(domain, r"\.", sign)
    none = lit(False)
    email = F.array(
        form(match, sound), form(F.concat(local, lit(" (at) "), domain), sound), form(F.concat(local, lit(" @ "), domain), sound),
        form(F.concat(local, lit("[at]"), dotted("[dot]")), sound), form(F.concat(local, lit(" (at) "), dotted(" (dot) ")), sound),
        form(F.concat(number, lit(" @ "), house, lit("."), F.initcap(word)), none),
        form(F.concat(number, lit(" @ "), house, lit("."), word), none),
        form(F.concat(word, lit(" @ "), house, lit(". "), F.initcap(word)), none),
        form(F.concat(word, lit(" @ "), house, lit(". "), word), none),
    )
    ip = F.array(*[form(F.regexp_replace("match", r"\.", sign)) for sign in (".", "[.]", " . ", "(dot)", " (dot) ")])
    digits = F.regexp_replace("match", "[^0-9]", "")
    fours = lambda sign: F.regexp_replace(digits, "([0-9]{4})(?=[0-9]{3})", "$1" + sign)
    card = F.when(F.length(digits).between(12, 19), F.array(form(match), *[form(fours(sign)) for sign in (".", "/", "  ", " - ")]))
    ten = F.right(digits, lit(10))
    part = lambda *cuts: [F.substring(ten, a, n) for a, n in cuts]
    a, b, c = part((1, 3), (4, 3), (7, 4))
    phone = F.when(right, F.array(
        form(match), form(F.concat_ws("-", a, b, c)), form(F.concat_ws(".", a, b, c)), form(F.concat_ws(" ", a, b, c)),
        form(F.concat(lit("("), a, lit(") "), b, lit("-"), c)),
        form(F.concat_ws("-", *part((1, 2), (3, 3), (6, 3))), none), form(F.concat_ws(" ", *part((1, 3), (4, 3), (7, 3))), none),
    ))
    return F.coalesce(
        F.when(F.col("kind") == 0, email).when(F.col("kind") == 1, ip).when(F.col("kind") == 2, card).otherwise(phone),
        F.array(form(match)),
    )


def _rewritten(strict: DataFrame) -> DataFrame:
    """Each base match in all its forms, with a ``label``."""
    names = [c for c in strict.columns if c not in ("match", "base")]
    return strict.select(*names, F.explode(_forms()).alias("form")).select(*names, "form.*")


def _features(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """Format and context of each candidate, as columns of doubles."""
    count = lambda p: F.length(F.regexp_replace("match", f"[^{p}]", ""))
    context = F.lower("before")
    columns = {
        **{f"f_{k}": F.col("kind") == i for i, k in enumerate(KINDS)}, "f_sound": F.coalesce(_sound(), F.lit(False)),
        "f_length": F.least(F.length("match"), F.lit(64)), "f_digits": F.least(count("0-9"), F.lit(40)),
        "f_letters": F.least(count("A-Za-z"), F.lit(40)), "f_dots": count("."), "f_spaces": count(" "),
        "f_dashes": count("-"), "f_brackets": count("()\\[\\]"), "f_plus": F.col("match").startswith("+"),
        "f_apart": F.col("match").rlike(r"[.] "), "f_capital": F.col("match").rlike("[A-Z][a-z]*$"),
        "f_kinds": F.size(F.array_distinct(F.split("match", ""))),
        "f_groups": F.size(F.split("match", "[^A-Za-z0-9]+")),
        "f_before": F.col("before").rlike("[A-Za-z0-9]$"), "f_after": F.col("after").rlike("^[A-Za-z0-9]"),
        "f_line": F.col("before").rlike("(^|\n)$"), "f_stop": F.col("after").rlike("^[.,;!?\\s]|^$"),
        "f_mark": F.col("before").rlike("[:=#\"'<(] ?$"),
        **{f"f_says_{k}": context.rlike(p) for k, p in TELLING.items()},
    }
    return rows.select("*", *[c.cast("double").alias(n) for n, c in columns.items()]), list(columns)


def added_spans(found: DataFrame, fit_candidates: int = 4000, precision: float = 0.97, trees: int = 8) -> DataFrame | None:
    """(row, kind, start, end): candidates besides the base spans that the trees select."""
    share = max(fit_candidates // (2 * len(KINDS)), 1)  # of each kind and outcome
    identity = F.xxhash64("kind", "match", "before", "after")
    strict = found.where("strict").withColumn("order", identity)
    counts = strict.groupBy("kind", "base").agg(F.approx_count_distinct("order").alias("n")).collect()  # at most 8 rows
    if len({r.base for r in counts}) < 2:
        return None
    # so many of the smallest hashes that a share of different matches is among them, whatever the error of the count
    few = F.lit(False)
    for r in counts:
        cut = int(min(1.0, 4 * share / r.n) * 2**53)
        few = few | ((F.col("kind") == r.kind) & (F.col("base") == r.base) & (F.shiftrightunsigned("order", 11) < cut))
    place = F.row_number().over(Window.partitionBy("kind", "base").orderBy("order", "match", "before", "after"))
    sample = (
        strict.where(few).select("kind", "base", "order", "match", "before", "after").distinct()
        .withColumn("place", place).where(F.col("place") <= share)
    )
    # the first of four is not fitted on, so a kind of one match has a threshold
    fitted = stored(sample.where(F.col("place") % 4 != 1), "fitted")
    rows, names = _features(_rewritten(fitted))
    rows = stored(rows, "forms")  # at most some tens of thousands
    if rows.select("label").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=names, outputCol="features")
    model = GBTClassifier(maxIter=trees, maxDepth=4, stepSize=0.3, seed=1, maxBins=64).fit(vectors.transform(rows))
    level = F.floor(vector_to_array("probability")[1] * 50)

    def scored(of: DataFrame) -> DataFrame:
        return model.transform(vectors.transform(_features(of)[0])).withColumn("level", level)

    left = strict.join(F.broadcast(fitted.select("order")), "order", "left_anti").select("kind", "base", "match", "before", "after")
    by_level = (
        scored(_rewritten(left)).groupBy("kind", "level")
        .agg(F.count("*").alias("n"), F.sum("label").alias("right")).collect()  # at most 4 * 51 rows
    )
    limits = {k: _limit([(r.level, r.n, r.right) for r in by_level if r.kind == k], precision) for k in range(len(KINDS))}
    limit = F.element_at(F.array(*[F.lit(limits[k]) for k in range(len(KINDS))]), F.col("kind") + 1)
    taken = scored(found.where(~F.col("strict") | ~F.col("base"))).where(F.col("level") >= limit)
    taken = stored(taken.select("row", "kind", "start", "end"), "taken")
    return free_spans(found.where("base").select("row", "kind", "start", "end"), taken)


def free_spans(base: DataFrame, taken: DataFrame) -> DataFrame:
    """(row, kind, start, end): spans of ``taken`` that overlap neither a base span nor a kept one that starts earlier.

    Of spans with one start the longest counts as the earliest. A span that is dropped hides no other.
    """
    fixed = base.join(taken.select("row").distinct(), "row", "left_semi").withColumn("fixed", F.lit(True))
    near = fixed.unionByName(taken.distinct().withColumn("fixed", F.lit(False)))
    order = Window.partitionBy("row").orderBy("start", F.desc("fixed"), F.desc("end"), "kind")
    # the same order backwards, as a frame up to the last row is gone through again for every row
    back = Window.partitionBy("row").orderBy(F.desc("start"), "fixed", "end", F.desc("kind"))
    earlier = (Window.unboundedPreceding, -1)
    clear = near.select(
        "*", F.max(F.when(F.col("fixed"), F.col("end"))).over(order.rowsBetween(*earlier)).alias("reached"),
        F.min(F.when(F.col("fixed"), F.col("start"))).over(back.rowsBetween(*earlier)).alias("next"),
    ).where(
        ~F.col("fixed") & (F.coalesce("reached", F.lit(0)) <= F.col("start"))
        & (F.col("next").isNull() | (F.col("next") >= F.col("end")))
    ).select("row", "kind", "start", "end")
    # runs of candidates that overlap; none of a run overlaps any of another
    order = Window.partitionBy("row").orderBy("start", F.desc("end"), "kind")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = clear.withColumn("opens", (F.coalesce(reached, F.lit(0)) <= F.col("start")).cast("long"))
    runs = runs.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    span = F.struct("start", (-F.col("end")).alias("back"), "kind", "end")
    return (
        runs.groupBy("row", "run").agg(F.sort_array(F.collect_list(span)).alias("spans"))  # within one document
        .select("row", F.inline(_accepted(F.col("spans")))).select("row", "kind", "start", "end")
    )


def _accepted(spans: Column) -> Column:
    """Of sorted spans, each one that starts where the accepted ones before it have ended.

    They are gathered in blocks, as every step copies what it adds to.
    """
    none = F.slice(spans, 1, 0)
    state = F.struct(F.lit(0).alias("at"), F.slice(F.array(none), 1, 0).alias("blocks"), none.alias("last"))

    def step(a: Column, s: Column) -> Column:
        full = F.size(a["last"]) >= 128
        return F.when(s["start"] >= a["at"], F.struct(
            s["end"].cast("int").alias("at"),
            F.when(full, F.concat(a["blocks"], F.array(a["last"]))).otherwise(a["blocks"]).alias("blocks"),
            F.when(full, F.array(s)).otherwise(F.concat(a["last"], F.array(s))).alias("last"),
        )).otherwise(a)

    return F.aggregate(spans, state, step, lambda a: F.concat(F.flatten(a["blocks"]), a["last"]))


def _limit(levels: list[tuple[int, int, float]], precision: float) -> int:
    """The lowest level from which on ``precision`` of the rows are right; 51 if there is none."""
    n = right = 0
    best = 51
    for level, count, good in sorted(levels, reverse=True):
        n, right = n + count, right + good
        if right >= precision * n:
            best = level
    return best


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, base, added) for every row: arrays of (start, kind, end), sorted; kind is a place in KINDS."""
    rows, found = candidates(docs, id_col, text_col)
    span = F.struct(F.col("start").cast("long").alias("start"), F.col("kind").cast("int").alias("kind"),
                    F.col("end").cast("long").alias("end"))
    extra = added_spans(found, **options)
    spans = found.where("base").select("row", span.alias("span"), F.lit(True).alias("base"))
    if extra is not None:
        spans = spans.unionByName(extra.select("row", span.alias("span"), F.lit(False).alias("base")))
    gathered = spans.groupBy("row").agg(  # the spans of one document
        F.sort_array(F.collect_list(F.when(F.col("base"), F.col("span")))).alias("base"),
        F.sort_array(F.collect_list(F.when(~F.col("base"), F.col("span")))).alias("added"),
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return rows.join(gathered, "row", "left").select(
        "id", F.coalesce("base", none).alias("base"), F.coalesce("added", none).alias("added")
    )


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    ), ",")


def redacted(text: Column, spans: Column) -> Column:
    """A text with every span replaced by its kind in brackets; overlapping spans become one."""
    names = F.array(*map(F.lit, KINDS))
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    return F.aggregate(
        spans, state,
        lambda a, s: F.struct(
            F.when(s["start"] >= a["at"], F.concat(
                a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                F.lit("["), F.get(names, s["kind"]), F.lit("]"),
            )).otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], s["end"]).alias("at"),
        ),
        lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.lit(2147483647))),
    )
