import random
import re

from tidemark.llm import decontaminate

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs, items):
    d, out = {}, {}
    for i, t in docs:
        d.setdefault(i, set()).update(shingles(t))
    for i, t in items:
        s = shingles(t)
        for k, have in d.items():
            if s and 5 * len(s & have) >= 4 * len(s):
                out[k, i] = (len(s & have), len(s))
    return out


def world(seed=4):
    r = random.Random(seed)
    words = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([2, 4, 5, 6, 9, 16, 31, 60])))) for i in range(40)]
    docs = []
    for i in range(80):
        body = [r.choice(words) for _ in range(r.choice([0, 3, 50, 700]))]
        if i % 2:
            item = r.choice(items)[1].split()
            if i % 4 == 1:  # an item with a word or two changed
                for _ in range(r.randint(1, 2)):
                    item[r.randrange(len(item))] = "changed"
            at = r.randint(0, len(body))
            body[at:at] = item
        docs.append((i, " ".join(body) if i % 3 else ", ".join(body).upper()))
    return docs + [(900, items[0][1]), (901, None), (902, "")], items + [(900, None), (901, "  ")]


def test_matches_brute_force(spark):
    docs, items = world()
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in decontaminate.contaminated(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert got == brute(docs, items)
    assert got and (900, 0) in got


def test_without_broadcasts(spark, monkeypatch):
    from tidemark.llm import common
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(common.small, "__defaults__", (0,))
    monkeypatch.setattr(common.if_small, "__defaults__", (0,))
    docs, items = world(9)
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert got == set(brute(docs, items))


def test_edges(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(1, text, 0, "x"), (1, text, 0, "x"), (None, text, 0, "x"), (2, "nothing of it", 0, "y")],
                                 DOCS + ", id_ int, n_item string")
    items = spark.createDataFrame([(7, text, 1), (7, text, 1), (None, text, 1)], ITEMS + ", doc_id int")
    out = decontaminate.contaminated(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in out] == [(1, 7, 3, 3)]
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns and sorted(str(r.doc_id) for r in left.collect()) == ["2", "None"]
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
