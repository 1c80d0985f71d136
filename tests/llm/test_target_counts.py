"""The likelihood ratio's target is all trusted documents, however many."""

import pytest

from strataload.llm import quality_rules


def test_all_trusted_documents_are_counted(spark):
    docs = spark.range(20_300).selectExpr("id as doc_id", "concat('w', id % 997, ' v', id % 13) as text")
    ratios = quality_rules.log_ratios(docs, docs.select("doc_id")).first()["ratios"]
    assert ratios == pytest.approx([0.0] * len(ratios), abs=1e-5)  # the target is the corpus
