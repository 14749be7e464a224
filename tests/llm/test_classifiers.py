import random
import zlib

import numpy as np
import pytest

from tidemark.llm import quality, queries, toxicity

SF = "/root/testdata/sf0.1"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    ranks[order] = np.arange(1, len(score) + 1)
    p = y.sum()
    return (ranks[y == 1].sum() - p * (p + 1) / 2) / (p * (len(y) - p))


def held_out(spark, query, column, m, rest):
    got = {r.doc_id: r for r in query(spark, SF).collect()}
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % m == rest) for r in got.values())
    labels = [(r.doc_id, r[column]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if got[r.doc_id].held_out]
    return np.array([got[d].score for d, _ in labels]), np.array([y for _, y in labels]), np.array([got[d].predicted for d, _ in labels])


def test_toxicity_on_held_out_rows(spark):
    s, y, p = held_out(spark, queries.op4_toxicity, "toxic", 4, 2)
    assert auc(s, y) > 0.9 and (p[y == 1].mean() > 0.8) and (p[y == 0].mean() < 0.03)


def test_quality_on_held_out_rows(spark):
    s, y, p = held_out(spark, queries.op10_quality, "quality", 3, 1)
    assert auc(s, y) > 0.98 and (p == y).mean() > 0.97


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_is_the_edit_distance():
    r = random.Random(3)
    entries = [toxicity.Entry(w, False, 1.0 + i / 10) for i, w in enumerate(["idiot", "scum", "moron", "stupid", "trash"])]
    a = toxicity.Automaton(entries)
    for _ in range(4000):
        w = list(r.choice(entries).text)
        for _ in range(r.randint(0, 3)):
            at = r.randint(0, len(w))
            w[at:at + r.randint(0, 1)] = [r.choice("abcdimnorstuxé1")] * r.randint(0, 1)
        w = "".join(w)
        near = [(e.weight, distance(w, e.text)) for e in entries if distance(w, e.text) <= e.edits]
        got = a.match(w)
        assert (got is None) == (not near), w
        if got:
            assert (got[0], got[1]) in near and (got[1] == 0) == any(d == 0 for _, d in near)


def test_stems_match_prefixes():
    a = toxicity.Automaton([toxicity.Entry("lowei", True, 2.0), toxicity.Entry("longstem", True, 3.0)])
    assert a.match("loweischaft") == (2.0, 0, True) and a.match("lowei") == (2.0, 0, True) and a.match("lowa") is None
    assert a.match("longztemx") == (3.0, 1, True) and a.match("slowei") is None


def test_quotation_scores_below_abuse():
    s = toxicity.Scorer([toxicity.Entry("idiot", False, 4.0)], [-4.0, 2.0, 2.0, 2.0, 0.2, 0.5, 0.5, 0.1])
    abuse, misspelt, quoted, reported = (s.score(t) for t in (
        "you are an idiot really", "you are an idiiot really", 'the text has "idiot" in it', "he called them an idiot there"))
    assert abuse > 0.5 and misspelt > 0.5 and quoted < 0.3 and reported < 0.3


def test_windows_of_long_texts():
    s = toxicity.Scorer([toxicity.Entry("idiot", False, 4.0)], [0.0] * 8)
    f = s.features("filler " * 50_000 + "idiot " * 3 + "filler " * 50_000)  # "word" itself reports speech
    assert f[1] == pytest.approx(np.log1p(12)) and f[5] == pytest.approx(np.log1p(12))
    assert s.features(None) == s.features("") == [1.0] + [0.0] * 7


def test_network_sees_every_chunk():
    r = np.random.default_rng(0)
    net = quality.train(["good text here " * 9, "BAD!! " * 20] * 20, np.array([1.0, 0.0] * 20), passes=4)
    assert net.probability("good text here " * 5) > 0.5 > net.probability("BAD!! " * 9)
    text = bytes(r.integers(97, 123, 3 * quality._PIECE + 77, dtype=np.uint8)).decode()
    out = net.outputs(text.encode())[0]
    assert len(out) == -(-len(text) // quality.STRIDE)
    whole = np.concatenate([out.max(0), out.mean(0), [1.0]])
    assert np.allclose(net.pooled(text.encode()), whole, rtol=1e-4, atol=1e-4)
    assert net.probability("") == net.probability(None)


def test_echo_marks_repetition():
    assert quality.chunks(b"The The The The The The ")[1].tolist() == [False, True, True, True, True, False]  # the last one is padded
    assert not quality.chunks(b"no part of this line is said twice over")[1].any()


@pytest.mark.parametrize("module,target", [(toxicity, "toxic"), (quality, "quality")])
def test_edges(spark, module, target):
    docs = spark.createDataFrame([(1, "text", 5), (1, "text", 5), (None, None, 6), (2, "", 7)], "doc_id long, text string, extra int")
    labels = spark.createDataFrame([], f"doc_id long, {target} int")
    out = module.score(docs, module.fit(docs, labels))
    assert out.columns == ["doc_id", "text", "extra", "score", "predicted"]
    assert [(r.predicted, r.score < 0.01) for r in out.collect()] == [(0, True)] * 4
    one = spark.createDataFrame([(1, 1), (None, 1), (2, None), (1, 1)], f"doc_id long, {target} int")
    assert module.score(docs, module.fit(docs, one)).count() == 4
    assert module.score(docs.limit(0), module.fit(docs, labels)).count() == 0


def long_texts(n=48, size=6_000):
    """Letters at random; every second text has a mark near its end or its middle."""
    r, out = np.random.default_rng(5), []
    for i in range(n):
        text = bytes(r.integers(97, 123, size, dtype=np.uint8)).decode()
        at = size - 300 if i % 4 else size // 2
        out.append(text[:at] + "BAD!! " * 4 + text[at:] if i % 2 else text)
    return out, np.array([1.0 - i % 2 for i in range(n)])


def test_fit_pools_whole_texts():
    texts, y = long_texts()
    net = quality.train(texts[:32], y[:32], passes=12)
    assert [net.probability(t) > 0.5 for t in texts[32:]] == (y[32:] == 1).tolist()


def test_slopes_are_those_of_whole_texts(monkeypatch):
    r = np.random.default_rng(1)
    net = quality.train(["good text here " * 9, "BAD!! " * 20] * 20, np.array([1.0, 0.0] * 20), passes=2)
    net.table, data = net.table.astype(float), bytes(r.integers(97, 103, 1_111, dtype=np.uint8))
    whole = net.slopes(data)
    monkeypatch.setattr(quality, "_PIECE", 64)
    parts = net.slopes(data)
    assert all(np.allclose(a, b, rtol=1e-4, atol=1e-5) for a, b in zip(whole, parts, strict=True))
    assert np.allclose(whole[0], net.pooled(data), rtol=1e-4, atol=1e-5)
    for f, at in ((f, at) for f in range(quality.FILTERS) for at in (97, 3 * 256 + 99, -2, -1)):
        step = 1e-4
        net.table[at, f] += step
        up = net.pooled(data)
        net.table[at, f] -= 2 * step
        down = net.pooled(data)
        net.table[at, f] += step
        slope = (up - down) / (2 * step)
        assert slope[f] == pytest.approx(whole[1][at, f], abs=0.02)
        assert slope[quality.FILTERS + f] == pytest.approx(whole[2][at, f], abs=0.02)


def test_fit_takes_whole_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{i} " + "x" * 20_000) for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda texts, y: seen.append(texts))
    quality.fit(docs, labels)
    assert len(seen[0]) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(30))
    monkeypatch.setattr(quality, "TRAIN_BYTES", 90_000)
    quality.fit(docs, labels)
    assert len(seen[1]) == 5 and set(seen[1]) < set(seen[0]) and {len(t) for t in seen[0]} <= {20_002, 20_003}
