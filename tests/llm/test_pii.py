import random
import re

import pytest
from pyspark.sql import functions as F

from smogline.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    out = [(m.start(), i, m.end()) for i, (k, p) in enumerate(PATTERNS.items())
           for m in re.finditer(p, text or "") if passes(k, m.group())]
    return sorted(out)


def bases(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return [(r.id, [tuple(s) for s in r.base], [tuple(s) for s in r.added])
            for r in pii.personal_data(df, **kw).collect()]


def corpus():
    r = random.Random(4)
    pieces = ["a@b.c", "x.y%z@q-r.co.uk", "@", ".", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.0255.3.4",
              "4111 1111 1111 1111", "4111111111111112", "5500-0000-0000-0004", "+1 (555) 123-4567", "+49.30.1234567",
              "+1", "é", "😀", "\n", " ", "-", "12", "word", "_d@e.f", "a@b@c.d", "37828224631000", "(at)", "joe (at) x.org",
              "555-123-4567", "+", "00", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6"]
    rows = [(i, "".join(r.choice(pieces) + r.choice(["", " "]) for _ in range(r.randint(0, 25)))) for i in range(400)]
    return rows + [(None, None), (None, ""), (7, "a@b.c"), (7, "a@b.c")]


def test_base_spans(spark):
    rows = corpus()
    got = bases(spark, rows)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = [(d, brute(t)) for d, t in rows]
    assert sorted([g[:2] for g in got], key=key) == sorted(want, key=key)
    assert any(g[2] for g in got)
    for _, base, added in got:
        places = sorted(base + added)
        assert all(all(b[2] <= a[0] or b[0] >= a[2] for b in base) for a in added)
        assert all(a[2] <= b[0] for a, b in zip(added, added[1:])) and len(places) == len(set(places))


@pytest.mark.parametrize("text", ["9" * 60000, "a." * 40000, "1.2" * 30000, "1-" * 30000, "+1" + "(" * 50000, "a@" * 30000,
                                  "4111 1111 1111 1111 " * 3000])
def test_long_runs(spark, text):
    ((_, base, _),) = bases(spark, [(1, text)])
    if not text.startswith(("9", "a.", "1.2")):  # the plain patterns take minutes for those
        assert base == brute(text)


def test_threshold():
    assert pii._limit([(50, 10, 10), (40, 5, 5), (10, 5, 0)], 0.9) == 40
    assert pii._limit([(50, 10, 1)], 0.9) == 51 and pii._limit([], 0.9) == 51


def test_rare_kinds_keep_their_thresholds(spark):
    # one address among numbers that fill any sample of the smallest hashes, and copies of it spelt out
    r = random.Random(3)
    rows = [(i, " ; ".join(str(r.randint(10, 10**9)) for _ in range(100))) for i in range(100)]
    rows += [(i, f"mail joe.doe{i}@example.org now") for i in range(100, 104)]
    rows += [(i, "call +1 (555) 123-4567 now") for i in range(104, 110)]
    rows += [(200, "mail joe.doe (at) example.org now")]
    got = {i: (b, a) for i, b, a in bases(spark, rows, fit_candidates=400)}
    assert all(got[i][0] == brute(t) for i, t in rows)
    assert got[200] == ([], [(5, 0, 29)])


def test_copies_share_one_place_of_the_sample(spark):
    # 500 copies of one number leave room for the other matches, and a kind of one match has a threshold
    rows = [(i, "order 12 34") for i in range(500)] + [(500 + i, f"call +1 (555) 123-45{i:02d} now") for i in range(40)]
    rows += [(600 + i, f"order {i + 100}") for i in range(40)] + [(700, "seen at 10.0.0.1 ok"), (701, "seen at 10[.]0.0.1 ok")]
    got = {i: a for i, _, a in bases(spark, rows, fit_candidates=160)}
    assert got[701] == [(8, 1, 18)]


def planted(seed):
    """Texts with base spans, disguised ones and things that only look alike: rows, wanted added spans."""
    r = random.Random(seed)
    names, houses = ["joe", "ann.lee", "m_doe", "kim22", "s.o-n"], ["example", "mail-box", "corp", "post24"]
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def card():
        body = d(15)
        return next(body + c for c in "0123456789" if luhn(body + c))

    octets = lambda top=255: [str(r.randint(0, top)) for _ in range(4)]
    name, house = lambda: r.choice(names), lambda: r.choice(houses)
    base = [lambda: f"{name()}@{house()}.org", lambda: ".".join(octets()), card, lambda: f"+1 ({d(3)}) {d(3)}-{d(4)}",
            lambda: ".".join([*octets()[:3], str(r.randint(256, 999))]), lambda: d(16), lambda: f"+1 {d(4)}", lambda: f"{d(5)} {d(3)}"]
    wide = [lambda: (0, f"{name()} (at) {house()}.{r.choice(['org', 'net', 'de'])}"), lambda: (0, f"{name()}[at]{house()}[dot]com"),
            lambda: (0, f"{name()} @ {house()}.org"), lambda: (1, "[.]".join(octets())), lambda: (1, " . ".join(octets())),
            lambda: (2, (lambda c: r.choice("./").join(c[i : i + 4] for i in (0, 4, 8, 12)))(card())),
            lambda: (3, f"{r.randint(2, 9)}{d(2)}-{d(3)}-{d(4)}"), lambda: (3, f"({d(3)}) {d(3)}-{d(4)}")]
    none = [lambda: f"price {r.randint(1, 99)} @ {house()}.Today only", lambda: f"we met @ {house()}. Then we left",
            lambda: "[.]".join([*octets()[:3], str(r.randint(256, 999))]), lambda: f"{d(2)}-{d(3)}-{d(3)}",
            lambda: f"see you @ {house()}. all is well"]
    rows, want = [], {}
    for i in range(1200):
        text = r.choice(["call ", "mail ", "about ", "server ", ""])
        kind = r.random()
        if kind < 0.5:
            text += r.choice(base)()
        elif kind < 0.75:
            k, found = r.choice(wide)()
            want[i] = (len(text), k, len(text) + len(found))
            text += found
        else:
            text += r.choice(none)()
        rows.append((i, text + r.choice([" now", ".", ", ok", ""])))
    return rows, want


def test_added_spans_of_a_planted_set(spark):
    """Precision and recall of the added spans, overall and for each kind."""
    rows, want = planted(11)
    got = {i: (b, a) for i, b, a in bases(spark, rows)}
    assert all(got[i][0] == brute(t) for i, t in rows)
    added = {(i, s) for i, (_, a) in got.items() for s in a}
    # what a base span already covers is not added again
    over = lambda s, spans: any(s[0] < b[2] and b[0] < s[2] for b in spans)
    wanted = {(i, s) for i, s in want.items() if not over(s, got[i][0])}
    for kind in (None, 0, 1, 2, 3):
        a, w = ({x for x in y if kind in (None, x[1][1])} for y in (added, wanted))
        assert len(a & w) >= 0.9 * len(w) and len(a & w) >= 0.9 * len(a), (kind, len(a), len(w), len(a & w), sorted(a - w)[:5], sorted(w - a)[:5])


def test_look_alikes_are_left(spark):
    names = ["joe", "ann", "kim.lee", "joe.doe7", "x12", "s.o-n"]
    rows = [(i, f"{'mail' if i % 2 else 'write to'} {names[i % 6]}@example{i}.org or call +1 (555) 123-45{i:02d}") for i in range(60)]
    rows += [(100, "price 5 @ shop.Today only"), (101, "write to joe (at) example.org"), (102, "call 555-123-4567 now")]
    got = {i: a for i, _, a in bases(spark, rows)}
    assert got[100] == [] and got[101] == [(9, 0, 29)] and got[102] == [(5, 3, 17)]


def greedy(spans):
    out = []
    for s in sorted(spans, key=lambda x: (x[0], -x[2], x[1])):
        if not out or out[-1][2] <= s[0]:
            out.append(s)
    return out


def test_dropped_candidates_hide_nothing(spark):
    r = random.Random(6)
    base, wide = {}, {}
    for row in range(300):
        spans = lambda n: {(a, r.randint(0, 3), a + r.randint(1, 12)) for a in r.choices(range(80), k=n)}
        base[row], wide[row] = spans(r.randint(0, 4)), spans(r.randint(0, 20))
    wide[300], base[300] = {(0, 3, 10), (5, 2, 20), (15, 3, 25)}, set()  # the second hides the third no more
    wide[301], base[301] = {(0, 2, 30), (12, 3, 20), (21, 1, 28)}, {(5, 1, 11)}  # nor does one that runs over a base span
    rows = [(row, f, *s) for f, of in ((True, base), (False, wide)) for row, spans in of.items() for s in spans]
    df = spark.createDataFrame(rows, "row long, fixed boolean, start int, kind int, end int")
    found = df.where("fixed").drop("fixed"), df.where("not fixed").drop("fixed")
    got = {row: [] for row in base}
    for x in pii.free_spans(*found).collect():
        got[x.row].append((x.start, x.kind, x.end))
    over = lambda s, b: s[0] < b[2] and b[0] < s[2]
    assert {k: sorted(v) for k, v in got.items()} == {
        row: sorted(greedy(s for s in wide[row] if not any(over(s, b) for b in base[row]))) for row in base}
    assert got[300] and len(got[300]) == 2 and len(got[301]) == 2


def test_many_overlapping_candidates(spark):
    df = spark.range(20000).selectExpr("1L row", "3 kind", "cast(id * 2 as int) start", "cast(id * 2 + 3 as int) end")
    assert pii.free_spans(df.limit(0), df).count() == 10000


def test_added_by_format(spark):
    r = random.Random(1)
    rows = [(i, f"call {r.choice(['+1 (555) 123-45%02d' % r.randint(0, 99), 'x 12 34'])} now") for i in range(300)]
    rows += [(i, "seen at 10.0.0.%d ok" % r.randint(0, 400)) for i in range(300, 500)]
    got = {i: (b, a) for i, b, a in bases(spark, rows)}
    assert all(got[i][0] == brute(t) for i, t in rows)


def test_redacted(spark):
    df = spark.createDataFrame([("é a@b.c 😀 1.2.3.4!",), ("",)], "text string")
    spans = F.when(F.length("text") > 0, F.expr(
        "array(struct(2L as start, 0 as kind, 7L as end), struct(10L as start, 1 as kind, 17L as end))"
    )).otherwise(F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)"))
    assert [x[0] for x in df.select(pii.redacted(F.col("text"), spans)).collect()] == ["é [email] 😀 [ip]!", ""]


def test_no_rows_and_no_python(spark, small):
    assert bases(spark, []) == []
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = pii.personal_data(docs)
    assert "Python" not in out._jdf.queryExecution().toString()
    got = sorted((r.id, [tuple(s) for s in r.base]) for r in out.collect())
    assert got == sorted((r.doc_id, brute(r.text)) for r in docs.collect())
