import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.codec(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


def texts(seed=2, n=400):
    r = random.Random(seed)
    alphabet = list("  \n\t\r\x0b\x1c\x85\xa0 'abcdefgstrvmlEIO0123456789.,!?-_é ßñ中文😀<|>") + ["'s", "'ll", " the", "endoftext", "  ", " \n "]
    out = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 90))) for _ in range(n)]
    return out + ["", " ", "   ", "a  b", "a   b", "foo.\n Bar", "foo \nBar", " lead", "trail ", "<|endoftext|>", "x" * 3000, "ab" * 5000, "\x00\x01", "don't we'll I'M"]


def test_perfect_hash_is_minimal_and_perfect(codec):
    ranks = byte_bpe.read_ranks(PATH)
    assert sorted(codec.hash.slot(k) for k in ranks) == list(range(len(ranks)))
    assert all(codec.id[codec.hash.slot(k)] == r for k, r in ranks.items())


def test_ids_equal_the_library(codec, reference):
    for t in texts():
        ids = codec.encode(t)
        assert ids == reference.encode_ordinary(t), repr(t)
        assert codec.decode(ids) == t.encode()


def test_query_columns_and_round_trip(spark, codec):
    rows = [(i, t, "x") for i, t in enumerate(texts(3, 50))] + [(None, None, None), (1, "again", "y"), (1, "again", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    got = byte_bpe.decode(out, PATH, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    for r in got:
        raw = (r.text or "").encode()
        assert bytes(r.decoded) == raw and r.decoded_sha256 == hashlib.sha256(raw).hexdigest()
        assert r.n_tokens == len(r.token_ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.token_ids)).encode()).hexdigest()
    assert byte_bpe.encode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_memory_of_words_is_bounded(codec, reference, monkeypatch):
    fresh = byte_bpe.Codec(byte_bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    monkeypatch.setattr(byte_bpe, "REMEMBERED_BYTES", 20_000)
    r = random.Random(5)
    for _ in range(300):
        t = " ".join("".join(r.choice("abcdefg") for _ in range(r.randint(1, 9))) for _ in range(20))
        assert fresh.encode(t) == reference.encode_ordinary(t)
        assert len(fresh.known) + len(fresh.known.old) <= 2 * 20_000 // byte_bpe._ENTRY


def test_texts_without_spaces_are_not_remembered_whole(codec, reference):
    fresh = byte_bpe.Codec(byte_bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    r = random.Random(6)
    for n in range(1000):
        t = "".join(r.choices("的一是不了人我在有他。，abc123", k=20_000 if n < 20 else 2_000))
        got = fresh.encode(t)
        assert n % 50 or got == reference.encode_ordinary(t)
    held = [*fresh.known.items(), *fresh.known.old.items()]
    assert all(len(w) <= byte_bpe.LONGEST for w, _ in held)
    assert sum(byte_bpe._ENTRY + 4 * len(w) + len(x) for w, x in held) <= 2 * byte_bpe.REMEMBERED_BYTES


@pytest.mark.parametrize("text", ["a \n b", "a\x1c b", "\x85 b", " " * 50_000 + "x", "a" + " \n" * 3000 + " b  c", "x\u3000 y"])
def test_cuts_beside_runs_of_white_space(codec, reference, text):
    assert codec.encode(text) == reference.encode_ordinary(text)
