"""The pipeline, stage by stage, against brute force."""

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from tests.llm import brute, data

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, SF_DIR).cache()
        out[name] = (docs, done)
        docs = done
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_order_and_columns(stages):
    assert list(stages) == ["language", "line_dedup", "near_dedup", "decontamination", "tokens"]
    for name, (before, after) in stages.items():
        assert after.columns[: len(before.columns)] == before.columns
        assert after.columns == before.columns or name == "tokens"
        assert after.schema["doc_id"] == before.schema["doc_id"]


def test_language_keeps_clean_documents(stages):
    before, after = map(texts, stages["language"])
    assert len(after) >= 0.99 * len(before)


def test_line_dedup(stages):
    before, after = map(texts, stages["line_dedup"])
    want = brute.line_dedup(list(before.items()))
    assert after == {i: t for i, t in want.items() if brute.words(t) or not brute.words(before[i])}
    assert all(r["n_chars"] == len(r["text"]) for r in stages["line_dedup"][1].collect())


def test_near_dedup(stages):
    before, after = map(texts, stages["near_dedup"])
    groups = brute.components([(i, brute.fingerprint(t)) for i, t in before.items()])
    assert after == {i: before[i] for i in set(groups.values())}


def test_decontamination(spark, stages):
    before, after = map(texts, stages["decontamination"])
    items = [" ".join(brute.license_words(r["text"])) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    holds = {i for i, t in before.items() if any(x in " ".join(brute.license_words(t)) for x in items)}
    assert after == {i: t for i, t in before.items() if i not in holds}


def test_tokens(stages):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in stages["tokens"][1].collect():
        ids = model.encode(r["text"], add_eos=True)
        assert (r["ids"], r["n_tokens"], r["decoded"]) == (ids, len(ids), model.decode(ids))


def test_run_is_the_stages(spark, stages):
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got == {r["doc_id"]: r["ids"] for r in stages["tokens"][1].collect()}


def test_awkward_rows(spark):
    for rows in (data.awkward(), []):
        docs = data.frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR).cache()
        assert docs.count() <= len(rows)
