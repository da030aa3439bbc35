"""Scores of the learnt models row by row in plain Python, and the bounds of their samples."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import decontaminate, language, lines, toxicity
from corpusmill.llm.html import main_text

SMALL = "/root/testdata/sf0.001"
MASK = (1 << 32) - 1


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def plain_trigrams(text):
    """Cell numbers of the byte trigrams, with how often each occurs."""
    folded = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in text.lower().encode())
    data = b" " + folded + b"  "
    cells = Counter()
    for a, b, c in zip(data, data[1:], data[2:], strict=False):
        if a == 32 and b == 32:
            continue
        code = (a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) & MASK
        code ^= code >> 15
        cells[(code * 0x2C1B3C6D & MASK) >> 20] += 1
    return cells


def test_language_by_plain_cosines(documents):
    model = language.learn(documents)
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    for row in language.identified(documents).collect():
        text = texts[row["doc_id"]]
        if not any(map(str.isalpha, text)):
            assert row["lang_pred"] == "und" and row["score"] == 0
            continue
        weights = {cell: math.log1p(n) * float(model.idf[cell]) for cell, n in plain_trigrams(text).items()}
        length = math.sqrt(sum(w * w for w in weights.values()))
        cosines = [sum(w * float(centre[cell]) for cell, w in weights.items()) / length for centre in model.centres]
        best = max(cosines)
        assert row["score"] == pytest.approx(min(best, 1), abs=1e-4)
        near = {name for name, cosine in zip(model.names, cosines, strict=True) if cosine > best - 1e-4}
        assert row["lang_pred"] in near


def test_repeated_documents_are_one_sampled_row(documents):
    known = documents.filter("lang is not null and text rlike '[a-z]'").select("doc_id", "lang", "text")
    one = known.orderBy("doc_id").limit(1).withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("again")
    assert (language.learn(known.unionAll(one)).idf == language.learn(known).idf).all()


def labelled(spark, rows):
    docs = spark.createDataFrame([(i, x) for i, x, _ in rows], "doc_id bigint, text string")
    return docs, spark.createDataFrame(sorted({(i, y) for i, _, y in rows}), "doc_id bigint, toxic int")


def watched(monkeypatch):
    seen = {}
    fit, evidence = toxicity.fit, toxicity._evidence
    monkeypatch.setattr(toxicity, "fit", lambda own, other, toxic, *a: seen.update(toxic=toxic, model=fit(own, other, toxic, *a)) or seen["model"])
    monkeypatch.setattr(toxicity, "_evidence", lambda *a: seen.setdefault("chosen", evidence(*a)))
    return seen


def test_toxicity_by_plain_sums(spark, monkeypatch):
    seen = watched(monkeypatch)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = toxicity.toxicity(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    weights, bias = seen["model"]
    weight = dict(zip(seen["chosen"], weights, strict=True))
    for row in rows:
        present = {f for word in texts[row["doc_id"]].lower().split() for f in toxicity.word_features(word)}
        z = bias + sum(weight.get(f, 0.0) for f in present)
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
        assert row["predicted"] == int(row["score"] >= 0.5)


def test_toxicity_sample_is_bounded_by_rows(spark, monkeypatch):
    seen = watched(monkeypatch)
    rows = [(i, f"idiot word{i % 3} tree" if i % 2 else f"word{i % 3} tree house", i % 2) for i in range(60)]
    rows += [(1, f"idiot number {i}", 1) for i in range(500)]
    docs, labels = labelled(spark, rows)
    assert toxicity.toxicity(docs, labels, sample=40).count() == len(rows)
    assert len(seen["toxic"]) <= 40


# ---- long texts


def test_nested_regions_take_time_in_proportion():
    depth = 8000
    page = "<html><body>" + "".join(f"<div><p>Some words of line number {i} that go on.</p>" for i in range(depth)) + "</div>" * depth
    found = main_text(page)
    assert found.count("Some words of line number") == depth


def test_many_repeated_lines_of_one_document(spark):
    text = "\n".join([f"The very same line of this text {i % 7}." for i in range(20_000)] + ["short", ""])
    row = lines.deduplicated(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row["_lines"] == 20_002 and row["_dropped"] == 20_002 - 2 - row["text"].count("very")
    assert row["text"].endswith("\nshort\n") and row["text"].count("The very same line of this text 0.") <= 1


@pytest.mark.parametrize("at", [0, 1, 4, 5, 6, 50, 58, 59, 63, 64, 65, 68, 69, 127, 128, 400])
def test_passages_across_borders_of_stretches(spark, at):
    item = [f"bench{i}" for i in range(30)]
    for length in (decontaminate.WINDOW, 20):
        passage = item[4 : 4 + length]
        passage[3] = passage[8] = "other"
        text = " ".join([*(f"doc{i}" for i in range(at)), *passage])
        docs = spark.createDataFrame([(1, text), (2, " ".join(f"doc{i}" for i in range(500)))], "doc_id bigint, text string")
        items = spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")
        found = decontaminate.contaminated(docs, items).collect()
        assert [(r["doc_id"], r["item_id"]) for r in found] == [(1, 7)]
        assert at <= found[0]["first_token"] < at + length
