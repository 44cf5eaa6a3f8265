"""The pipeline, stage by stage, against brute force on a small folder."""

import corpus_pipeline as cp
from rarebird.llm.common import Scratch

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch, frames = Scratch(spark), []
    for k, (_, stage) in enumerate(cp.STAGES):
        out = scratch.keep(stage(spark, frames[-1] if frames else docs, SF), f"s{k}")
        if k < 4:
            assert out.columns == docs.columns
        frames.append(out)
    sizes = [f.count() for f in frames]
    assert docs.count() >= sizes[0] >= sizes[1] >= sizes[2] == sizes[3] >= sizes[4] > 0
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in frames[0].select("doc_id").collect()}
    judged = {r.doc_id for r in docs.select("doc_id").collect()} & set(labels)
    assert sum((i in kept) == (labels[i] == 1) for i in judged) > 0.95 * len(judged)

    from .test_near_dup import brute_classes

    texts = {r.doc_id: r.text or "" for r in frames[0].collect()}
    classes = brute_classes(texts)
    assert {r.doc_id for r in frames[1].collect()} == set(classes.values())
    final = {r.doc_id: r.taken for r in frames[4].collect()}
    assert set(final) <= {r.doc_id for r in frames[3].collect()}
    again = {r.doc_id: r.taken for r in cp.run(spark, SF).collect()}
    assert again == final
