"""The near-duplicate stage of the pipeline: fingerprints and exact similarity together."""

import numpy as np

from corpusmill.llm import pipeline, simhash, simhash_wide


def test_fingerprint_links_and_similar_texts_are_one_group(spark):
    def text(tail, n=30):
        return "a b c " * 200 + " ".join(f"{tail}{i}" for i in range(n))

    # Repeats decide the fingerprints of 5 and 2, of whose five-word shingles few are shared; 3 is similar to 2.
    texts = {5: text("x"), 2: text("y"), 3: text("y", 31), 9: " ".join(f"z{i}" for i in range(90))}
    assert simhash.fingerprint_bits(texts[5], 3) == simhash.fingerprint_bits(texts[2], 3)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in pipeline.dedup_near(spark, docs, "").collect()) == [2, 9]
    alone = docs.filter("doc_id = 9")
    assert pipeline.dedup_near(spark, alone, "").count() == 1


def test_index_keys_avoid_a_passage_of_few_documents(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [passage + " " + " ".join(f"d{n}w{i}" for i in range(90)) for n in range(6)]
    read = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    every = np.concatenate([simhash_wide.shingles_of(x, 5) for x in texts])
    keys = [k for r in simhash_wide._hashed(read, 5, 0.8).collect() for k in r["keys"]]
    assert len(keys) == len(set(keys)) > 0
    # Every document is counted, whatever partition it lies in.
    counts = simhash_wide.cell_counts(read, 5)
    assert counts.sum() == len(every)
    assert (counts[simhash_wide._cell(simhash_wide.shingles_of(passage, 5))] >= 6).all()
