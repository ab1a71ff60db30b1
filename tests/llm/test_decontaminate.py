import random
import re

import pytest

from smogline.llm.decontaminate import contamination, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), size)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        out.append((doc, len(w), len(hit), len(found), tuple(sorted(str(i) for i in found if i is not None))))
    return out


def same(spark, rows, items, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.id, r.n_words, r.n_hit, r.n_items, tuple(r["items"])) for r in contamination(df, bench, **kw).collect()]
    key = lambda r: (r[0] is None, r[0] or 0) + r[1:]
    assert sorted(got, key=key) == sorted(brute(rows, items, kw.get("size", 10)), key=key)


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "ß1", "Z"]
    text = lambda n: r.choice([" ", "-", " ,"]).join(r.choice(vocabulary) for _ in range(n))
    items = [(i, text(r.randint(8, 30))) for i in range(12)] + [(50, "w1 w2"), (51, "Z"), (52, None), (53, "..")]
    items += [(54, items[0][1]), (None, text(20))]
    rows = []
    for i in range(40):
        parts = [text(r.randint(0, 30))]
        for _ in range(r.randint(0, 2)):
            w = words(r.choice(items)[1])
            a = r.randint(0, max(0, len(w) - 9))
            parts.append(" ".join(w[a : a + r.randint(8, 20)]).upper())
        rows.append((i, "; ".join(parts)))
    return rows, items


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_windows(spark, seed):
    same(spark, *corpus(seed))


def test_long_items_only(spark):
    rows, items = corpus(3)
    same(spark, rows, [i for i in items if len(words(i[1])) >= 10])
    same(spark, rows, items, size=6, k=3)


def test_edges(spark):
    item = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j0 k1"
    rows = [(1, None), (1, ""), (None, item), (None, item), (2, item), (2, "x " + item + " x " + item),
            (3, "...!"), (4, " ".join([item] * 3000)), (5, item.replace("e5", "E5")), (6, item[3:30])]
    same(spark, rows, [(1, item), (1, item), (2, None)])
    same(spark, rows, [(None, item), (None, item + " more"), (3, "j0 k1")])
    same(spark, rows, [])
    same(spark, [], [(1, item)])


def test_only_narrow_rows_are_marked_for_broadcast(spark, monkeypatch):
    from pyspark.sql import functions as F
    seen, mark = [], F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda df: seen.append(df.dtypes) or mark(df))
    same(spark, *corpus(4))
    assert [("key", "string")] in seen
    assert not any(kind.startswith("array") for dtypes in seen for _, kind in dtypes)


def test_beyond_the_bound_nothing_is_broadcast(spark, monkeypatch):
    from smogline.llm import groups
    monkeypatch.setattr(groups, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(groups.F, "broadcast", lambda df: pytest.fail("broadcast"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        same(spark, *corpus(5))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_bound_counts_bytes(spark, tmp_path):
    from smogline.llm.groups import checked
    wide = spark.createDataFrame([("x" * 5000,)] * 20, "window string")
    hinted = lambda df: "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(checked(wide, 200_000)) and not hinted(checked(wide, 50_000))


def test_drop(spark):
    df = spark.createDataFrame([(1, "a b c", None), (None, "a b d", 2), (None, "a b d", 2), (2, None, 3)],
                               "doc_id long, text string, key int")
    bench = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    got = drop_contaminated(df, bench)
    assert got.columns == df.columns
    assert sorted(r.key for r in got.collect()) == [2, 2, 3]


def test_no_python_in_the_plan(spark, small):
    docs, bench = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    out = contamination(docs, bench)
    assert "Python" not in out._jdf.queryExecution().toString()
    same(spark, [(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in bench.collect()])
