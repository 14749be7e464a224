import hashlib
import importlib.util
import os

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.test_decontaminate import brute as brute_leaks
from tests.llm.test_pii import brute as brute_spans
from tests.llm.test_simhash import brute_components
from tidemark.llm import byte_bpe, pii, toxicity
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"


def masked(text):
    out, at = [], 0
    for a, k, b in brute_spans(text):
        if a >= at:
            out.append(text[at:a] + f"[{pii.KINDS[k].upper()}]")
        at = max(at, b)
    return "".join(out) + text[at:]


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontaminate", "pii", "byte_bpe"]


def test_each_stage_against_brute_force(spark):
    """Every stage on all that its predecessor kept, compared with a plain version."""
    docs = table(spark, SF, "documents")
    columns = docs.columns
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=byte_bpe.read_ranks(
        public_tokenizers.path("byte_bpe_50k.tiktoken")))
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        after_frame = stage(spark, docs, SF)
        after = {r.doc_id: r for r in after_frame.collect()}
        if name == "toxicity":
            scorer = toxicity.Scorer(*toxicity.fit(docs, table(spark, SF, "labels")))
            want = {i for i, r in before.items() if scorer.score(r.text) < toxicity.THRESHOLD}
        elif name == "simhash":
            found = brute_components([(i, r.text) for i, r in before.items()])
            want = {i for i, (_, root) in found.items() if root == i}
        elif name == "decontaminate":
            items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
            want = set(before) - {d for d, _ in brute_leaks([(i, r.text) for i, r in before.items()], items)}
        else:
            want = set(before)
        assert set(after) == want, name
        if name == "byte_bpe":
            for i, r in after.items():
                ids = reference.encode_ordinary(r.text)
                assert r.token_ids == ids and r.n_tokens == len(ids)
                assert r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
            return
        assert after_frame.columns == columns
        for i, r in after.items():
            if name == "pii":
                assert r.text == masked(before[i].text) and r.n_chars == len(r.text) or r.text == before[i].text
            else:
                assert r == before[i]
        docs = after_frame


def test_run_equals_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    key = lambda rows: sorted((r.doc_id, r.ids_sha256) for r in rows)
    assert key(out.collect()) == key(docs.collect())


ROWS = [(1, "plain text of one two three four", "en", None, 5, "x", 1.5), (1, "plain text of one two three four", "en", None, 5, "x", 1.5),
        (2, None, None, "s", None, None, None), (None, "a@b.co said", "en", "s", 11, "y", 0.5), (3, "", "en", "s", 0, "z", 2.5),
        (4, "word " * 30_000, "en", "s", 150_000, "z", None)]
CLASHING = ("doc_id long, text string, lang string, source string, n_chars long, predicted string, score double, id_ int, "
            "component_id int, `__key` int, base int, fp long")


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_edges_of_every_stage(spark, name, stage):
    docs = spark.createDataFrame([r + (7, 7, 7, 7, 7) for r in ROWS], CLASHING)
    out = stage(spark, docs, SF)
    rows = out.collect()
    assert out.columns[:len(docs.columns)] == docs.columns
    ids = sorted(str(r.doc_id) for r in rows)
    if name == "simhash":  # a repeated id once; texts without words are one group
        assert ids == ["1", "2", "4", "None"]
    else:
        assert ids == ["1", "1", "2", "3", "4", "None"]
    assert {r.predicted for r in rows if r.doc_id == 4} == {"z"} and all(r.base == 7 and r.fp == 7 for r in rows)
    empty = stage(spark, docs.limit(0), SF)
    assert empty.count() == 0 and empty.columns == out.columns


def test_entry_without_this_subpackage(tmp_path):
    """The rest imports when the subpackage and the pipeline are gone."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(importlib.util.find_spec("corpus_pipeline").origin)
    for part in ("tidemark", "__spark_entry__.py"):
        src = os.path.join(root, part)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / part, ignore=lambda d, names: [n for n in names if n in ("llm", "__pycache__")])
        else:
            shutil.copy(src, tmp_path / part)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'describe' in q and not [x for x in q if x.startswith('op')] and 'pipeline' not in q"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert done.returncode == 0, done.stderr[-800:]
