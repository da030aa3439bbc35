"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import decontaminate, exact, language, lines, packing, pii, pipeline, ppm, simhash
from corpusmill.llm import simhash_wide, toxicity
from corpusmill.llm.html import extracted, main_text
from corpusmill.llm.queries import tokenizer_path

LONG = " ".join(f"word{i % 977} and number {i}" for i in range(40_000))
ROWS = [
    (1, "Mail jo@example.com or call +1 (605) 555-9305 today.", "en", "a", 52),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (None, "A text without an id, but with some words in it.", "en", None, 1),
    (4, LONG, "en", "b", len(LONG)),
    (5, "The same line of text, twice over.\nThe same line of text, twice over.", "en", "a", 1),
    (6, "The same line of text, twice over.\nThe same line of text, twice over.", "de", "a", 1),
    (6, "The same line of text, twice over.\nThe same line of text, twice over.", "de", "a", 1),
    (7, "1234 5678 éß日本 \U0001f600 \u0000", "fr", "c", 1),
    (8, "   \n\t \n", "fr", "c", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ("h", "line", "n", "kept", "rank", "score", "key", "fp", "node", "first", "a", "b", "seed", "at", "word")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (5, 1, 1), (6, 0, 1), (7, None, None), (None, 1, 1), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    return spark.createDataFrame([(1, text), (2, text), (3, None), (4, ""), (None, "short")], "item_id bigint, text string")


def operators(labels, items):
    return {
        "pii": pii.personal_data,
        "exact": exact.exact_duplicates,
        "toxicity": lambda d: toxicity.toxicity(d, labels),
        "language": language.identified,
        "packing": lambda d: packing.packed(d, tokenizer_path()),
        "simhash": simhash.simhash_components,
        "groups": simhash_wide.similar_groups,
        "ppm": ppm.ppm_scores,
        "lines": lines.deduplicated,
        "decontamination": lambda d: decontaminate.contaminated(d, items),
    }


NAMES = ("pii", "exact", "toxicity", "language", "packing", "simhash", "groups", "ppm", "lines", "decontamination")
PER_DOCUMENT = [n for n in NAMES if n not in ("packing", "decontamination")]


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows(name, docs, labels, items):
    rows = operators(labels, items)[name](docs).collect()
    if name in PER_DOCUMENT:
        assert len(rows) == len(ROWS)
    if name == "exact":
        by_id = {r["doc_id"]: r for r in rows}
        assert by_id[5]["keep_id"] == 6 and by_id[5]["group_size"] == 3 and not by_id[5]["kept"]
        assert by_id[2]["keep_id"] == 3 and by_id[3]["kept"] and by_id[None]["kept"]
    if name == "language":
        assert {r["doc_id"]: r["lang_pred"] for r in rows}[2] == "und"
        assert {r["doc_id"]: r["lang_pred"] for r in rows}[8] == "und"
    if name == "simhash":
        named = {r["doc_id"]: r for r in rows}
        assert named[2]["fingerprint"] == "0" * 16 and named[8]["component_id"] == 2
        assert named[6]["component_id"] == 5
    if name == "packing":
        assert sum(r["length"] for r in rows if r["doc_id"] == 2) == 1
        assert sum(r["length"] for r in rows if r["doc_id"] == 4) == [r for r in rows if r["doc_id"] == 4][0]["doc_tokens"]
    if name == "lines":
        texts = {r["doc_id"]: r["text"] for r in rows}
        assert texts[5] == "The same line of text, twice over." and texts[6] == "" and texts[2] is None
    if name == "decontamination":
        assert rows == []


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(name, spark, docs, labels, items):
    assert operators(labels, items)[name](docs.filter("doc_id < 0")).collect() == []


def test_empty_partners(spark, docs, labels, items):
    assert decontaminate.contaminated(docs, items.filter("item_id < 0")).collect() == []
    rows = toxicity.toxicity(docs, labels.filter("doc_id < 0")).collect()
    assert len(rows) == len(ROWS) and {r["score"] for r in rows} == {0.5}


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, "u", None), (2, None, ""), (None, "u", "<p>One</p>"), (3, "u", "plain &amp; simple"), (3, "u", "<div" * 9)],
        "page_id bigint, url string, html string",
    ).withColumn("text", F.lit("x"))
    rows = [(r["page_id"], r["text"], r["n_chars"]) for r in extracted(pages).collect()]
    assert rows[:4] == [(1, "", 0), (2, "", 0), (None, "One", 3), (3, "plain & simple", 14)]
    assert extracted(pages.filter("page_id < 0")).collect() == []


def test_broken_pages():
    for page in ("<![</p>text", "a <![if x]>b", "<![CDATA[c]]>d", "<!", "</", "<a <b", "&#99999999999;", "<script>x", "<!--"):
        assert isinstance(main_text(page), str)


def test_rows_that_share_a_doc_id_are_filtered_one_by_one(spark, tmp_path):
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(1, words(0)), (None, words(0)), (None, words(1)), (None, words(2)), (None, words(2)), (7, words(3)),
            (7, words(3)), (7, words(4)), (None, words(5)), (8, words(0) + " end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = [tuple(r) for r in pipeline.dedup_near(spark, docs, str(tmp_path)).collect()]
    wanted = [(1, words(0)), (None, words(1)), (None, words(2)), (7, words(3)), (7, words(4)), (None, words(5))]
    assert sorted(kept, key=str) == sorted(wanted, key=str)
    spark.createDataFrame([(1, words(1)), (2, words(4))], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    clean = pipeline.decontaminate_benchmark(spark, docs, str(tmp_path)).collect()
    gone = [r for r in rows if r[1] in (words(1), words(4))]
    assert sorted(map(tuple, clean), key=str) == sorted((r for r in rows if r not in gone), key=str)


def test_pipeline_stages(spark, docs, tmp_path):
    spark.createDataFrame([(1, "x y z")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (docs, docs.filter("doc_id < 0")):
        now = rows
        for name, stage in pipeline.STAGES:
            out = stage(spark, now, str(tmp_path))
            if name != "packing":
                assert out.columns == docs.columns
            out.write.parquet(path := f"{tmp_path}/{name}-{now is rows}-{rows is docs}")
            now = spark.read.schema(out.schema).parquet(path)
