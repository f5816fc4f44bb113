"""The pipeline's stages against brute force, and as a whole."""

import random

import corpus_pipeline as C
from ashgrid.llm import pieces, toxicity
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import read, words
from tests.llm.test_decontamination import brute_force as contaminated
from tests.llm.test_jaccard import brute_force as near
from tests.llm.test_personal import found as base_spans

import public_tokenizers
import sentencepiece

LIBRARY = sentencepiece.SentencePieceProcessor(
    model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_stages_have_the_agreed_order_and_columns(spark):
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii",
                                        "sentencepiece"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).schema.simpleString() == docs.schema.simpleString()


def test_whole_run_equals_the_stages_by_brute_force(spark):
    ids, texts = read(SF_SMALL, "documents", "doc_id", "text")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    sample = toxicity.labelled_sample(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"),
                                      C.MAX_EXAMPLES)
    index = toxicity.fit(sample, docs)
    rejected = {r.doc_id for r in toxicity.score(docs, index).where("predicted = 1").collect()}
    rows = [(i, t) for i, t in zip(ids, texts, strict=True) if i not in rejected]
    first = {c for i, c, _ in near(rows) if i == c}
    rows = [r for r in rows if r[0] in first]
    items = list(zip(*read(SF_SMALL, "benchmark", "item_id", "text"), strict=True))
    short = [r for r in rows if len(words(r[1])) < 300]     # the slow alignment is cubic in Python
    random.Random(0).shuffle(short)
    bad = {i for i, _ in contaminated(short[:12], items)}
    exact = {i for i, t in rows for _, item in items if item in t}
    got = {r.doc_id: r for r in C.run(spark, SF_SMALL).collect()}
    assert not bad & set(got) and not exact & set(got)
    assert {i for i, _ in short[:12]} - bad <= set(got)
    assert set(got) <= {i for i, _ in rows} and len(got) >= len(rows) - 2 * len(exact)
    for i, t in rows:
        if i in got and not base_spans(t):
            assert got[i].ids == LIBRARY.encode(t) and got[i].round_trip
        elif i in got:
            back = LIBRARY.decode(got[i].ids)
            assert not base_spans(back) and got[i].round_trip


def test_toxic_documents_go_and_clean_ones_stay(spark):
    ids, labels = read(SF_ORACLE, "labels", "doc_id", "toxic")
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    kept = {r.doc_id for r in C.drop_toxic(spark, docs, SF_ORACLE).select("doc_id").collect()}
    toxic = [i for i, y in zip(ids, labels, strict=True) if y == 1]
    clean = [i for i, y in zip(ids, labels, strict=True) if y == 0]
    assert sum(i in kept for i in clean) >= 0.99 * len(clean)
    assert sum(i not in kept for i in toxic) >= 0.95 * len(toxic)


def test_last_stage_decodes(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    made = C.encode(spark, docs, SF_SMALL)
    back = pieces.decode(made, public_tokenizers.path("piece_bpe_32k.model"))
    ids, texts = read(SF_SMALL, "documents", "doc_id", "text")
    assert {r.doc_id: r.text for r in back.collect()} == dict(zip(ids, texts, strict=True))
