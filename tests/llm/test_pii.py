import random
import re

from pyspark.sql import functions as F

from tidemark.llm import pii
from tidemark.llm.queries import op7_pii

SCHEMA = "doc_id long, text string"
# the contract's patterns, as they are
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    text, out = text or "", []
    digits = lambda v: re.sub("[^0-9]", "", v)
    for k, (pattern, ok) in enumerate((
            (EMAIL, lambda v: True), (IP, lambda v: all(int(p) <= 255 for p in v.split("."))),
            (CARD, lambda v: 12 <= len(digits(v)) <= 19 and luhn(digits(v))), (PHONE, lambda v: 9 <= len(digits(v)) <= 15))):
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if ok(m.group())]
    return sorted(out)


def texts(seed=6, n=500):
    r = random.Random(seed)
    bits = ["a@b.c", "x.y+z@mail-1.example.com", "a@b", "@", ".", "_", "1.2.3.4", "256.1.1.1", "001.02.3.255", "1.2.3.4.5.6.7.8", "+", "-", " ", "(",
            ")", "4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", "12345", "+1 (017) 555-7713", "+49 30 123456", "+1", "é", "中", "\n",
            "😀", "word", "token = ", "0", "7", "99", "000000000000", "  ", "--"]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(n)]


def found(df):
    return {r.doc_id: [(s.a, s.k, s.b) for s in r.base] for r in df.collect()}


def test_base_spans_match_the_contract(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(9000, None), (9001, ""), (9002, "1" * 40_000 + "a" * 40_000)]
    got = found(pii.find(spark.createDataFrame(rows, SCHEMA)))
    for i, t in rows:
        assert got[i] == brute(t), repr(t)


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    names = pii.KINDS
    import hashlib
    for r in op7_pii(spark, sf).collect():
        base = brute(docs[r.doc_id])
        line = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        assert set(line.split(",")) <= set(r.spans.split(",")) or not line


def brute_rounds(edges):
    """The rounds in plain Python: edges (pattern, instance, seed)."""
    import math
    known, by = {i for _, i, s in edges if s}, {}
    for p, i, _ in edges:
        by.setdefault(p, set()).add(i)
    while True:
        scores = {p: len(x & known) / (len(x) + 1) for p, x in by.items() if len(x & known) >= max(pii.SUPPORT, pii.SHARE * len(x))}
        accepted = {i for _, i, _ in edges if 1 - math.prod(1 - scores[p] for p, x in by.items() if p in scores and i in x) >= pii.ACCEPT}
        if accepted <= known:
            return accepted, set(scores)
        known |= accepted


def test_rounds_against_brute_force(spark):
    r = random.Random(3)
    edges = {}
    for _ in range(400):
        edges[f"p{r.randint(0, 25)}", f"i{int(r.expovariate(0.02))}"] = r.random() < 0.35
    edges = [(p, i, s) for (p, i), s in edges.items()]
    # one chain that needs several rounds, an instance that only two weak patterns carry together, one that a single weak one cannot
    edges += [(f"c{n}", f"x{n}-{j}", n == 0 or j > 2) for n in range(5) for j in range(4)] + [(f"c{n}", f"x{n + 1}-0", False) for n in range(4)]
    edges += [(p, f"{p}{j}", j < 3) for p in ("w", "v") for j in range(5)] + [("w", "both", False), ("v", "both", False)]
    accepted, confident = pii.bootstrap(spark.createDataFrame(edges, "pattern string, instance string, seed boolean"))
    want = brute_rounds(edges)
    assert {r.instance for r in accepted.collect()} == want[0] and {r.pattern for r in confident.collect()} == want[1]
    assert any(i not in {x for _, x, s in edges if s} for i in want[0])


def added(df):
    return {r.doc_id: [r.text[s.a:s.b] for s in r.all_spans if s.k == 4] for r in df.collect()}


def test_bootstrap_discovers_identifiers_by_context(spark):
    keys = [f"{i:02d}ab3c9d{i:02d}ef7a81b2c3" for i in range(6)]
    rows = [(i, f'some words {i} api_key = "{k}", more') for i, k in enumerate(keys)]
    rows += [(100, 'other api_key = "n0tlong" here'), (101, "the short n0tlong elsewhere"), (102, "see page 12 of volume 3"),
             (103, f"again {keys[2]} in the open"), (104, "api_key = none")]
    rows += [(200 + i, f"write to user{i}@mail.example.com now") for i in range(6)] + [(300, "write to user77@localhost now"), (301, "user77@localhost again")]
    got = added(pii.find(spark.createDataFrame(rows, SCHEMA)))
    assert [got[i] for i in range(6)] == [[k] for k in keys]
    assert got[100] == ["n0tlong"] and got[101] == []  # a short value only where its pattern stands
    assert got[103] == [keys[2]] and got[300] == got[301] == ["user77@localhost"]
    assert got[102] == got[104] == [] and all(got[200 + i] == [] for i in range(6))


def test_many_matches_take_linear_time(spark):
    import time
    one = " ".join(f"u{i}@a.bc" for i in range(pii.CHUNK * 5 + 3))
    assert found(pii.find(spark.createDataFrame([(1, one)], SCHEMA)))[1] == brute(one)
    text = " ".join(f"u{i}@a.bc" for i in range(40_000))
    began = time.time()
    n = spark.createDataFrame([(1, text)], SCHEMA).select(F.size(pii.base_spans(F.col("text"))).alias("n")).first().n
    assert n == 40_000 and time.time() - began < 15


def test_added_spans_of_the_given_documents(spark):
    """The quoted values of ``token = "..."`` that overlap no base span are found; hardly anything else is."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = pii.find(docs).collect()
    hits = spare = 0
    for r in rows:
        got = {(s.a, s.b) for s in r.all_spans if s.k == 4}
        spans = [m.span(1) for m in re.finditer(r'(?i)token = "([0-9a-f]{20,})"', r.text or "")]
        free = {(a, b) for a, b in spans if not any(s.a < b and s.b > a for s in r.base)}
        assert free <= got
        hits, spare = hits + len(free), spare + len(got - free)
    assert hits >= 10 and spare <= 0.1 * hits


def test_masking_and_edges(spark):
    rows = [(1, "mail a@b.co, call +49 30 1234567!", 33, "k", 1), (1, "mail a@b.co, call +49 30 1234567!", 33, "k", 1),
            (None, "é 1.2.3.4 é", 11, "k", 1), (3, None, None, "k", 1), (4, "", 0, "k", 1), (5, "clean text", 99, "k", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, base string, `__id` int")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id or 0, r.text, r.n_chars, r.base) for r in out.collect()), key=str)
    one = "mail [EMAIL], call [PHONE]!"
    assert got == sorted([(1, one, len(one), "k"), (1, one, len(one), "k"), (0, "é [IP] é", 8, "k"), (3, None, None, "k"),
                          (4, "", 0, "k"), (5, "clean text", 99, "k")], key=str)
    assert pii.redact(docs.limit(0)).count() == 0
    spans = spark.range(1).select(pii.masked(F.lit("0123456789"), F.expr(
        "array(named_struct('a',2,'k',2,'b',6,'v',''), named_struct('a',3,'k',3,'b',8,'v',''), named_struct('a',8,'k',0,'b',9,'v',''))")).alias("m"))
    assert spans.first().m == "01[CARD][EMAIL]9"
