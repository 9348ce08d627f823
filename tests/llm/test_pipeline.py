"""The pipeline's stages follow their operators' decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from meterloom.llm import jaccard
from meterloom.llm.common import read, stage

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read(spark, SF, "documents")
    states = [docs]
    for name, function in corpus_pipeline.STAGES:
        out = stage(function(spark, states[-1], SF), f"test-{name}")
        if name != "tokens":
            assert out.columns == docs.columns
        states.append(out)
    clean, single, redacted, mixed, tokens = states[1:]
    groups = jaccard.jaccard_groups(clean)
    assert single.count() == groups.select("component_id").distinct().count()
    assert redacted.count() == single.count()
    assert redacted.filter(F.col("text").rlike("AKIA[0-9A-Z]{16}")).count() == 0
    assert mixed.select("doc_id").distinct().count() == redacted.count()
    assert tokens.count() == mixed.count()
    want = mixed.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    assert tokens.select("doc_id", F.col("decoded_sha256").alias("h")).exceptAll(want).count() == 0
