"""The corpus pipeline: each stage against brute force on its own input."""

import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import tiktoken

from cardwatch.llm import bpe, common, toxicity
from test_decontaminate import brute as brute_windows
from test_native import brute_pii
from test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = common.shared(common.table(spark, SF, "documents"))
    columns = docs.columns
    model = toxicity.train(docs, common.table(spark, SF, "labels"))

    kept = common.shared(stages["toxicity"](spark, docs, SF))
    toxic = {r["doc_id"] for r in toxicity.score(docs, model).where("is_toxic").collect()}
    assert kept.columns == columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - toxic

    single = common.shared(stages["simhash_near_dedup"](spark, kept, SF))
    src = [(r["doc_id"], brute_fp(r["text"])) for r in kept.collect()]
    assert single.columns == columns
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(brute_components(src)))

    clean = common.shared(stages["benchmark_decontamination"](spark, single, SF))
    items = [(r["item_id"], r["text"]) for r in common.table(spark, SF, "benchmark").collect()]
    assert clean.columns == columns
    left = {r["doc_id"] for r in clean.collect()}
    gone = [r for r in single.collect() if r["doc_id"] not in left]
    assert all(brute_windows(r["text"], items)[1] > 0 for r in gone)
    stay = sorted(clean.collect(), key=lambda r: len(r["text"]))[:25]
    assert all(brute_windows(r["text"], items)[1] == 0 for r in stay)

    redacted = common.shared(stages["pii"](spark, clean, SF))
    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert redacted.columns == columns and redacted.count() == clean.count()
    for r in redacted.collect():
        assert r["n_chars"] == len(r["text"])
        assert (r["text"] == before[r["doc_id"]]) or "<" in r["text"]
        assert not brute_pii(before[r["doc_id"]]) or r["text"] != before[r["doc_id"]]

    coder = bpe.Encoder(bpe.read_ranks(common.file_bytes(P.path(bpe.VOCABULARY))), P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in redacted.collect()}
    out = stages["byte_bpe"](spark, redacted, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        assert r["ids"] == library.encode_ordinary(texts[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()

    whole = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect()
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in whole) == sorted((r["doc_id"], r["ids_sha256"]) for r in out)


def test_stages_on_an_empty_table(spark, none):
    docs = none.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.shared(stage(spark, docs, SF))
        assert docs.count() == 0
