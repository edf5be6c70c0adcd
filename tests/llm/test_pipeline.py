"""Each stage on its own input against brute force, on a small table."""

import os

import pytest

import corpus_pipeline
from test_decontaminate import brute as brute_marks
from test_jaccard_join import brute as brute_components, shingles

SF_DIR = SMALLEST = "/root/testdata/sf0.001"  # brute force over larger tables takes minutes
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


def cut(rows):
    """Texts less the bytes under 50-byte strings of a smaller document."""
    least = {}
    for i, t in rows:
        data = t.encode()
        for j in range(len(data) - 49):
            least[data[j:j + 50]] = min(least.get(data[j:j + 50], i), i)
    out = {}
    for i, t in rows:
        data = t.encode()
        gone = bytearray(len(data))
        for j in range(len(data) - 49):
            if least[data[j:j + 50]] < i:
                gone[j:j + 50] = b"\1" * 50
        out[i] = bytes(x for x, g in zip(data, gone) if not g).decode("utf-8", "ignore")
    return out


def test_stages(spark, tmp_path):
    import public_tokenizers as P
    import tiktoken
    from riskmart.llm.bpe import read_ranks
    docs, columns = spark.read.parquet(f"{SF_DIR}/documents.parquet"), None
    columns, before = docs.columns, [tuple(r) for r in docs.select("doc_id", "text").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k == len(corpus_pipeline.STAGES) - 1:
            break
        assert docs.columns == columns
        after = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        if name == "toxicity":
            toxic = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic = 1").collect()}
            labelled = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
            gone = ({i for i, _ in before} - {i for i, _ in after}) & labelled
            assert len(gone & toxic) >= 0.8 * len(gone) and set(after) <= set(before)
        elif name == "ngram_jaccard":
            want = {c if n else i for i, n, c in brute_components(before)}
            assert {i for i, _ in after} == want and len(after) == len(want) and set(after) <= set(before)
        elif name == "suffix_array":
            assert dict(after) == cut(before)
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        else:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            marks = {i: brute_marks(t, items) for i, t in before}
            assert sorted(after) == sorted((i, t) for i, t in before if not (marks[i][1] and 20 * marks[i][1] >= marks[i][0]))
        before = after
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(f.read()), special_tokens={})
    assert {r.doc_id: r.n_tokens for r in docs.collect()} == {i: len(other.encode_ordinary(t)) for i, t in before}
    assert shingles("a b c d e f")


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALLEST).count() > 50
