"""The corpus pipeline on the awkward tables: stage contracts and the whole
run against the stages' decisions taken one by one."""

import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from ledgerline.llm import anchor_pii, bpe_fst, decontaminate, quality_llr, simhash_ring


def test_stages_and_run(spark, llm_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "benchmark decontamination", "PII", "byte-level BPE"]
    source = spark.read.parquet(f"{llm_dir}/documents.parquet")
    labels, items = (spark.read.parquet(f"{llm_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    rows = source.collect()
    ratio = quality_llr.fit(source, labels)
    judged = quality_llr.judge(source, ratio, ["doc_id", "text"]).collect()
    good = {(r.doc_id, r.text) for r in judged if r.kept}
    rows = [r for r in rows if (r.doc_id, r.text) in good]
    assert 0 < len(rows) < source.count()
    kept = spark.createDataFrame(rows, source.schema)
    low = {r.component_id for r in simhash_ring.near_duplicates(kept).collect()}
    first = {}
    for r in rows:  # one row of each group: here a group's rows with one id have one text
        if r.doc_id in low:
            first.setdefault((r.doc_id, r.text), r)
    rows = list(first.values())
    kept = spark.createDataFrame(rows, source.schema)
    leaked = {r.doc_id for r in decontaminate.leaks(kept, items).collect()}
    rows = [r for r in rows if r.doc_id not in leaked]
    ranks = bpe_fst.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for r in rows:
        text = anchor_pii.redact_text((r.text or "").encode())
        ids = np.asarray(enc.encode_ordinary(text), "<u4").tobytes()
        expected.append((r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids))
    got = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in corpus_pipeline.run(spark, llm_dir).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    docs = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, llm_dir)
        assert docs.columns == source.columns, name
        assert [f.dataType for f in docs.schema] == [f.dataType for f in source.schema], name


def test_empty_run(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []
