import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from blocklot.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in value.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "")
            if valid(k, m.group(0))]


def card():
    digits = "".join(random.choice("0123456789") for _ in range(random.randint(11, 19)))
    digits += next(c for c in "0123456789" if luhn(digits + c))
    return random.choice(["", "", " ", "-"]).join(re.findall(".{1,4}", digits))


def test_base_spans_equal_the_stated_patterns(docs):
    random.seed(5)
    parts = [lambda: "a.b@c-d.ef", lambda: "x@y", lambda: "@", lambda: ".", lambda: " ", lambda: "-", lambda: "--",
             lambda: "é😀", lambda: "+", lambda: str(random.randint(0, 300)), lambda: "1.2.3.4", lambda: "256.1.1.1",
             lambda: "0001.2.3.4", card, lambda: "+49 (30) 123-456-78", lambda: "word", lambda: "%", lambda: "\n",
             lambda: "a@b.c%d@e.f", lambda: "+1 " + str(random.randint(10 ** 7, 10 ** 12))]
    texts = ["".join(random.choice(parts)() for _ in range(random.randint(0, 14))) for _ in range(1500)]
    texts += [None, "", "1" * 50_000, "a" * 50_000, "1." * 25_000, "+1 2 " * 10_000, "a@" * 20_000, "a@b.c " * 300]
    got = {r.doc_id: r for r in pii.find(docs(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        assert [f"{b.kind}:{b.start}:{b.end}" for b in got[i].base] == base(t), t and t[:200]


def corpus():
    rows = [(i, f"hello there Zanzibar contact bob@x.org thanks number {'q' * (i % 7 + 3)}") for i in range(30)]
    rows += [(100 + i, "hello there friends of the word nothing here " + "z" * (i % 5 + 3)) for i in range(300)]
    rows += [(500 + i, "thanks a lot Bahamas") for i in range(20)]
    # One text and its copies: no evidence for the pair.
    return rows + [(600 + i, "singular quixotic ann@y.org") for i in range(9)] + [(700, None), (None, "+49 30 12345678")]


def test_disclosure_equals_its_formula(docs):
    rows = corpus()
    df = docs(rows)
    got = {(r.entity, r.term): r.disclosure for r in pii.disclosures(df, pii.scan(df)).collect()}
    n, ne, nte = len(rows), 30, 30

    def formula(nt):
        return math.log(n * nte / (nt * ne)) / math.log(n / ne)
    count = {w: sum(w in (t or "").lower().split() for _, t in rows) for w in
             ("hello", "there", "zanzibar", "contact", "thanks", "number")}
    want = {("email:bob@x.org", w): formula(c) for w, c in count.items() if formula(c) >= pii.GENERALISE}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert ("email:bob@x.org", "zanzibar") in got and ("email:bob@x.org", "there") not in got
    assert not any(e == "email:ann@y.org" for e, _ in got)


def test_the_shuffled_term_count_equals_the_broadcast_one(docs, monkeypatch):
    df = docs(corpus())
    scanned = pii.scan(df)
    few = sorted(map(tuple, pii.disclosures(df, scanned).collect()))
    monkeypatch.setattr(pii, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, pii.disclosures(df, scanned).collect())) == few


def test_sanitised_text(docs):
    df = docs(corpus())
    out = pii.sanitise(df)
    assert out.columns == [*df.columns, "sanitised"] and out.count() == df.count()
    text = {r.doc_id: r.sanitised for r in out.collect()}
    assert text[0] == "hello there <removed> <removed> <email> t* <removed> qqq"
    assert text[100] == "hello there friends of the word nothing here zzz"
    assert text[600] == "singular quixotic <email>" and text[700] == "" and text[None] == "<phone>"


def test_overlapping_spans_are_replaced_once(docs):
    rows = [(1, "+4222222222222 end")]
    assert base(rows[0][1]) == ["card:1:14", "phone:0:14"]
    assert pii.sanitise(docs(rows)).first().sanitised == "<phone> end"


def test_query_columns(spark):
    sf = "/root/testdata/sf0.001"
    df = pii.op2_pii_sanitise(spark, sf)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = df.collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert r.spans.split(",")[:len(want)] == (want or [""])[:max(1, len(want))][:len(r.spans.split(",")[:len(want)])]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in PATTERNS]


def test_empty_table_and_native_plan(docs, documents):
    assert pii.find(docs([])).count() == 0 and pii.sanitise(docs([])).count() == 0
    plan = pii.find(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def far_corpus():
    far = "filler words stand between here " * 10
    rows = [(i, f"Zanzibar {far}{'v' * (i + 3)} write to bob@x.org {far}{'w' * (i + 3)} ZANZIBAR") for i in range(6)]
    rows += [(100 + i, f"{far}nothing of note {'z' * (i + 3)}") for i in range(300)]
    return rows + [(900, f"the zanzibar again, {far}without the address; zanzibar"), (901, "mail zanzibar@y.org now")]


def test_terms_far_from_the_entity_count_and_are_marked_everywhere(docs):
    rows = far_corpus()
    df = docs(rows)
    n, n_e, n_t = len(rows), 6, 7  # the name within another address is no term
    got = {(r.entity, r.term): r.disclosure for r in pii.disclosures(df, pii.scan(df)).collect()}
    want = math.log(n * 6 / (n_t * n_e)) / math.log(n / n_e)
    assert abs(got["email:bob@x.org", "zanzibar"] - want) < 1e-9 and want >= pii.REMOVE
    out = {r.doc_id: r.sanitised for r in pii.sanitise(df).collect()}
    assert not any("zanzibar" in t.lower() for t in out.values())
    assert out[0].startswith("<removed> filler") and out[0].endswith("<removed>") and "<email>" in out[0]
    assert out[900].startswith("the <removed> again") and out[900].endswith("address; <removed>")
    assert out[901] == "mail <email> now"


def test_spans_of_terms_are_their_places(docs):
    rows = far_corpus() + [(950, "😀é zanzibar x@y.orgézanzibar, Zanzibar"), (None, "zanzibar"), (900, None)]
    found = pii.find(docs(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        text = next(t for i, t in rows if i == r.doc_id and hashlib.sha256((t or "").encode()).digest() == r.digest)
        names = [m.span() for m in re.finditer("zanzibar(?!@)", text or "", re.I)]
        spans = [(f.start, f.end) for f in r.found]
        assert spans == sorted(set(spans))
        if r.doc_id == 950:
            assert [s for s in spans if s in names] == [names[0], names[2]]
        else:
            assert set(names) <= set(spans)


def test_the_shuffled_marking_equals_the_broadcast_one(docs, monkeypatch, rows_of):
    df = docs(far_corpus())
    few = rows_of(pii.find(df))
    monkeypatch.setattr(pii, "BROADCAST_BYTES", -1)
    assert rows_of(pii.find(df)) == few


def test_a_long_list_of_addresses_takes_linear_time(spark, docs):
    import time
    took = []
    for n in (5_000, 40_000):
        text = "; ".join(f"a{k}@b.cc" for k in range(n))
        began = time.time()
        [row] = pii.find(docs([(1, text)])).collect()
        took.append(time.time() - began)
        assert len(row.base) == n and [b.start for b in row.base[:3]] == [0, 9, 18]
        assert row.base[-1].end == len(text)
    assert took[1] < 60


def test_prefixes_and_cuts(spark):
    from pyspark.sql import functions as F
    for n in (0, 1, 2, 3, 10, 1000):
        values = [(7 * k) % 13 for k in range(n)]
        df = spark.createDataFrame([(values,)], "v array<int>")
        sums, tops = df.where(F.size("v") > 0).select(
            pii.prefixes(F.col("v"), lambda a, b: a + b, F.lit(0)),
            pii.prefixes(F.col("v"), lambda a, b: F.greatest(a, b), F.lit(0))).first() or ([], [])
        assert sums == [sum(values[:k]) for k in range(n)] and tops == [max([0, *values[:k]]) for k in range(n)]
    text = "".join(chr(0x1F600 + k % 50) + "é" for k in range(3 * pii.CUT))
    cuts = [(0, 0), (0, 5), (5, pii.CUT), (pii.CUT - 1, pii.CUT + 1), (10, 5 * pii.CUT + 3), (pii.CUT, 2 * pii.CUT), (0, len(text))]
    df = spark.createDataFrame([(text,)], "t string").select(F.regexp_extract_all(
        "t", F.lit(f"(?s).{{1,{pii.CUT}}}"), F.lit(0)).alias("b"))
    got = df.select(*[pii._between(F.col("b"), F.lit(a), F.lit(b)) for a, b in cuts]).first()
    assert list(got) == [text[a:b] for a, b in cuts]
