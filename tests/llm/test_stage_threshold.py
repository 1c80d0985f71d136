"""The near-duplicate stage of the pipeline links from a similarity of 0.8."""

import corpus_pipeline
from strataload.llm.minhash import near_duplicates


def test_pairs_between_80_and_85_are_one_document(spark):
    data = []
    for pair in range(40):
        words = [f"p{pair}w{i}" for i in range(204)]  # 200 shingles
        changed = list(words)
        for at in (30, 75, 120, 165):  # 20 shingles differ: 180 / 220 = 0.818
            changed[at] = f"p{pair}x{at}"
        far = list(words)
        for at in (20, 55, 90, 125, 160):  # 25 differ: 175 / 225 = 0.778
            far[at] = f"p{pair}y{at}"
        data += [(3 * pair, " ".join(words)), (3 * pair + 1, " ".join(changed)), (3 * pair + 2, " ".join(far))]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert kept == {d for d, _ in data if d % 3 != 1}
    assert all(r["kept"] for r in near_duplicates(docs).collect())  # the query's own threshold is 0.85
