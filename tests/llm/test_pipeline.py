"""The registered queries against SQL, and the pipeline's stages against plain versions."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.oracle_check import check, duck


def test_all_operators_are_registered():
    names = set(E.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))


@pytest.mark.parametrize("name", ["op2_top_k", "op3_substring_dedup", "op7_embedding_dedup", "op8_chat_formatting"])
def test_query_matches_sql(spark, name):
    r = check(spark, duck(SF_SMALL), name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert r["match"], r


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_SMALL).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append((name, docs, after))
        docs = after
        assert name == "packing" or docs.columns == columns
    step = {name: (before, after) for name, before, after in kept}
    before, after = step["quality"]
    scored = {r.doc_id: r.predicted for r in E.queries()["op10_quality"](spark, SF_SMALL).collect()}
    assert {r.doc_id for r in after.collect()} == {d for d, p in scored.items() if p}
    before, after = step["near_dedup"]
    groups = brute.simhash([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, _, c in groups if d == c)
    before, after = step["secrets"]
    assert after.count() == before.count() and not any(brute.base_spans(r.text) for r in after.collect())
    before, after = step["mixing"]
    sizes, got, longest, texts, copies = {}, {}, {}, {}, {}
    for r in before.collect():
        n = len(brute.WORD.findall(r.text))
        sizes[r.source] = sizes.get(r.source, 0) + n
        longest[r.source] = max(longest.get(r.source, 0), n)
        texts[r.doc_id] = r.text
    for r in after.collect():
        got[r.source] = got.get(r.source, 0) + len(brute.WORD.findall(r.text))
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        assert r.text == texts[r.doc_id]  # whole texts only
    goal = brute.source_targets(sizes)
    assert all(abs(goal[s] - got.get(s, 0)) <= 1 + longest[s] / 2 for s in goal) and max(copies.values()) <= 2
    before, after = step["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in before.collect())
    assert sum(r.length for r in after.collect()) == want
