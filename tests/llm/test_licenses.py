import re
import random

from smogline.llm import licenses


def words(text):
    return re.sub(r"[^\w]|_", " ", (text or "").lower()).split()


def bigrams(text):
    w = words(text)
    return {(a, b) for a, b in zip(w, w[1:])} or {(x,) for x in w}


def brute(text, known, threshold=0.8):
    found = {}
    text = text or ""
    for part in {*text.split("\n"), *re.split(r"\n[ \t\r]*\n", text)}:
        a = bigrams(part)
        for name, template in known.items():
            b = bigrams(template)
            if a and b and (s := 2 * len(a & b) / (len(a) + len(b))) >= threshold:
                found[name] = max(found.get(name, 0), s)
    w = words(text)
    for name, template in known.items():
        b, n = bigrams(template), len(words(template))
        for i in range(max(1, len(w) - n + 1) if w and n > 1 else 0):
            run = w[i : i + n]
            a = {*zip(run, run[1:])} or {(run[0],)}
            if (s := 2 * len(a & b) / (len(a) + len(b))) >= threshold:
                found[name] = max(found.get(name, 0), s)
    best = min(found, key=lambda k: (-found[k], k), default=None)
    return ",".join(sorted(found)), best, round(found.get(best, 0.0), 9)


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = licenses.scan(df, **kw).collect()
    return [(r.id, r.licenses, r.best, round(r.similarity, 9)) for r in out]


def test_same_as_all_templates(spark):
    r = random.Random(1)
    rows = [(None, None), (1, ""), (1, " \n\n"), (2, "Released under the MIT License."), (2, "mit"), (3, "\n".join(["x"] * 5000))]
    for i in range(120):
        name = r.choice(list(licenses.TEMPLATES))
        w = licenses.TEMPLATES[name].split()
        for _ in range(r.randint(0, len(w) // 5)):
            w[r.randrange(len(w))] = r.choice(["foo", "bar", ""])
        sep = r.choice([" ", "\n"])
        rows.append((i + 10, f"some é text\n{r.choice(['', chr(10)])}{sep.join(w).upper()}\n\nmore words here, ok"))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = [(d, *brute(t, licenses.TEMPLATES)) for d, t in rows]
    assert sorted(got(spark, rows), key=key) == sorted(want, key=key)


def test_inside_of_lines_and_across_them(spark):
    mit = ("MIT", "MIT")
    rows = [(1, "Copyright 2020 Foo. Released under the MIT License."), (2, "Released under the MIT License. See the file for details."),
            (3, "x = 1  # Released under\n# the MIT\n# License.\ndef f(): pass"), (4, "one two " * 300 + "released under the mit license " + "x " * 300),
            (5, "released under a licence"), (6, "the mit license"), (7, "Released under the MIT License " * 2000)]
    found = {i: (names, best) for i, names, best, _ in got(spark, rows)}
    assert {i for i in found if found[i] == mit} == {1, 2, 3, 4, 7} and found[5] == found[6] == ("", None)
    head = licenses.TEMPLATES["GPL-3.0 header"].replace(" ", "\n * ", 20)
    ((_, names, best, similarity),) = got(spark, [(1, f"/* {head} and more words follow here\nint main() {{}} */")])
    assert best == "GPL-3.0 header" and similarity == 1.0


def test_beyond_the_bound_nothing_is_broadcast(spark, monkeypatch):
    from smogline.llm import groups
    monkeypatch.setattr(groups, "BROADCAST_BYTES", 0)
    rows = [(i, t + " and more") for i, t in enumerate(licenses.TEMPLATES.values())]
    want = sorted((d, *brute(t, licenses.TEMPLATES)) for d, t in rows)
    assert sorted(got(spark, rows)) == want


def test_own_templates(spark):
    known = spark.createDataFrame([("one", "Free"), ("none", "..."), ("two", "a b c"), ("two again", "a b c")], "name string, text string")
    rows = got(spark, [(1, "free"), (2, "A, b c."), (3, "x")], known=known)
    assert sorted(rows) == [(1, "one", "one", 1.0), (2, "two,two again", "two", 1.0), (3, "", None, 0.0)]
    empty = known.where("name = 'none'")
    assert got(spark, [(1, "x")], known=empty) == [(1, "", None, 0.0)]
    assert got(spark, []) == []


def test_every_notice_finds_itself(spark):
    for _, names, best, similarity in got(spark, [(i, t) for i, t in enumerate(licenses.TEMPLATES.values())]):
        assert best in licenses.TEMPLATES and similarity == 1.0 and best in names


def test_whole_table_without_python(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = licenses.scan(docs)
    assert "Python" not in out._jdf.queryExecution().toString()
    rows = sorted((r.id, r.licenses) for r in out.collect())
    assert rows == sorted((r.doc_id, brute(r.text, licenses.TEMPLATES)[0]) for r in docs.collect())
    assert any(r[1] for r in rows)
