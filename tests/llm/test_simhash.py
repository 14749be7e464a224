import random

import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.common import components

SCHEMA = "doc_id long, text string"


def brute_fingerprint(text, shingle=3):
    """Bit by bit, as the contract says it."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    root = {i: i for i, _ in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, x in fps:
        for b, y in fps:
            if a < b and bin(x ^ y).count("1") <= 2:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (f"{f:016x}", find(i)) for i, f in fps}


def corpus(seed=5, n=120):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(30, 400)))) for i in range(n)]
    for i in range(n, 2 * n):  # near copies: a word changed
        t = r.choice(rows)[1].split()
        t[r.randrange(len(t))] = "changed"
        rows.append((i, " ".join(t)))
    return rows + [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "One two"), (1004, "one TWO"), (1005, "É é ß a B c d")]


def test_fingerprint_is_bitwise_majority():
    for _, t in corpus():
        assert simhash.fingerprint(t) % (1 << 64) == brute_fingerprint(t)


def test_components_match_brute_force(spark):
    rows = corpus()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute_components(rows)


def test_links_find_every_pair_of_close_fingerprints(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base:
        for _ in range(12):
            x = b
            for bit in r.sample(range(64), r.randint(1, 3)):
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, rep long")
    got = {tuple(sorted(p)) for p in simhash.links(df).collect()}
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if bin((fps[i] ^ fps[j]) % (1 << 64)).count("1") <= 2}
    assert got == want


def test_components_of_chain_star_and_ring(spark):
    chain = [(i, i + 1) for i in range(100, 180)]
    star = [(500, i) for i in range(501, 560)]
    ring = [(900 + i, 900 + (i + 1) % 30) for i in range(30)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star + ring + [(7, 7)], "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 181)}, **{i: 500 for i in range(500, 560)}, **{900 + i: 900 for i in range(30)}}


def test_edges(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert simhash.keep_one(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(5, "a b c d", 1, 2), (5, "a b c d", 1, 2), (3, "A b c d", 1, 2), (None, "a b c d", 1, 2), (9, "quite another text here", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id_ int, component_id int")
    out = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in out) == [(-1, 3), (3, 3), (5, 3), (5, 3), (9, 9)]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [3, 9]  # a copy without an id goes too
    twice = spark.createDataFrame([(1, "x y z"), (1, "x y z")], SCHEMA)
    assert simhash.keep_one(twice).count() == 1


@pytest.mark.parametrize("n", [1, 3, 70_000])
def test_long_texts(n):
    t = " ".join(["word", "other", "third", "x"] * n)
    assert simhash.fingerprint(t) % (1 << 64) == brute_fingerprint(t)


def test_rows_without_an_id_link_others_and_one_row_of_a_group_stays(spark):
    def flipped(bits):  # texts whose fingerprints form a chain are found by search over small changes
        return simhash.fingerprint(bits)

    base = " ".join(f"w{i}" for i in range(400))
    found = {flipped(base): base}
    chain = [base]
    for i in range(4000):
        t = base.replace(f"w{i % 400} ", f"x{i} ", 1)
        f = flipped(t)
        if 0 < bin((f ^ flipped(chain[-1])) & (2 ** 64 - 1)).count("1") <= 2 and f not in found:
            found[f] = t
            chain.append(t)
            base = t
        if len(chain) == 4:
            break
    assert len(chain) >= 3
    a, b, c = chain[:3]
    rows = [(1, a), (None, b), (2, c), (None, b), (2, "another text that is nobody's copy at all"), (2, "another text that is nobody's copy at all"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got.count((0, 1)) == 2 and (1, 1) in got and (2, 1) in got and got.count((2, 2)) == 2 and (0, None) in got
    kept = sorted(((r.doc_id or 0, r.text or "") for r in simhash.keep_one(df).collect()))
    assert kept == sorted([(1, a), (2, rows[4][1]), (0, "")])
