"""Fill-in-middle, importance resampling and BPE against plain Python, and their awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import bpe, dsir, fim
from corpusmill.llm.queries import tokenizer_path

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string"
CLASHING = ("h1", "n", "form", "output", "ids", "decoded", "score", "rank", "bucket", "n_words", "weight", "least")
LONG = "\n".join(f"Zeile {i} für {i % 977} ß" * (1 + i % 3) for i in range(30_000))
ROWS = [
    (1, "one\ntwo\nthree"), (2, None), (3, ""), (None, "no id\nbut lines\n"), (4, LONG), (5, "a\n\n\nb\r\nc\n"), (5, "a\n\n\nb\r\nc\n"),
    (6, "holds <P> a mark\n"), (7, "\U0001f600 日本\né <|endoftext|> x\n" * 40), (8, "\n"), (9, "x" * 70_000), (10, "\n" * 50_000),
    (11, "İstanbul Ɗan \x85 don't 3½"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- fill in the middle


def plain_fim(doc_id, text, by_line=True, percent=100):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if by_line else list(text)
    digest = sha(f"7:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 50:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("by_line", [True, False])
def test_fill_in_middle(docs, documents, by_line):
    for table in (docs, documents):
        given = table.select("doc_id", "text").collect()
        found = fim.transformed(table, by_line=by_line)
        assert ordered(found.collect()) == ordered(plain_fim(r[0], r[1], by_line) for r in given)
    assert {plain_fim(r[0], r[1])[2] for r in given} == {"psm", "spm"} | {plain_fim(r[0], r[1])[2] for r in given}


def test_undrawn_texts_stay_plain(docs):
    found = fim.transformed(docs, fim_percent=40).collect()
    assert ordered(found) == ordered(plain_fim(i, t, percent=40) for i, t in ROWS)


def test_texts_come_back(docs):
    for row in fim.digests(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert row["restored_sha256"] == sha(row["text"] or "")


def test_chunks_depend_on_content_alone():
    rng = random.Random(2)
    passage = bytes(rng.randrange(32, 127) for _ in range(60_000))
    sets = []
    for lead in (b"", b"some other words before\n" * 9):
        data = np.frombuffer(lead + passage, np.uint8)
        (ends,) = fim.borders(data, np.array([0, len(data)]))
        assert ends[-1] == len(data) and np.diff([0, *ends]).max() <= fim.LONGEST_CHUNK
        sets.append({(lead + passage)[a:b] for a, b in zip([0, *ends], ends, strict=False)})
    assert len(sets[0] & sets[1]) >= len(sets[0]) - 2


def test_shared_chunks_are_met_once_and_compared(monkeypatch):
    memory = fim.ChunkMemory()
    assert memory(b"a\nb\n") == (2, 4, True) and memory(b"a\nb\n") == (2, 4, True)
    assert (memory.hits, memory.misses) == (1, 1)
    monkeypatch.setattr(fim.xxhash, "xxh3_64_intdigest", lambda _: 1)
    one = fim.ChunkMemory()
    assert one(b"a\nb\n") == (2, 4, True) and one("é".encode()) == (0, 1, False) and one.clashes == 1


def test_chunk_memory_is_bounded():
    memory = fim.ChunkMemory(1000)
    for i in range(500):
        memory(b"%050d" % i)
    assert memory.held <= 500 and sum(len(x) for x, _ in memory.old.values()) <= 500


# ---- importance resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, order=3):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + k]) for k in range(1, order + 1) for i in range(len(words) - k + 1)]


def plain_buckets(text):
    return Counter(zlib.crc32(f.encode()) % 10_000 for f in plain_features(text)[1])


def plain_resampled(rows, items, percent=5, least=20):
    corpus, target = Counter(), Counter()
    for _, text in rows:
        corpus += plain_buckets(text)
    for text in items:
        target += plain_buckets(text)
    s_all, t_all = sum(corpus.values()), sum(target.values())
    gain = [
        math.floor(1000 * math.log(((target[b] + 1) * (s_all + 10_000)) / ((corpus[b] + 1) * (t_all + 10_000))))
        for b in range(10_000)
    ]
    out, able = [], []
    for doc_id, text in rows:
        words, features = plain_features(text)
        weight = sum(n * gain[b] for b, n in plain_buckets(text).items())
        h = int(sha(f"42:{'' if doc_id is None else doc_id}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(features), weight, score, None])
        if len(words) >= least:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return out


@pytest.mark.parametrize("percent", [0, 5, 60, 100])
def test_resampling(spark, docs, documents, percent):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    texts = [r["text"] for r in items.collect()]
    for table in (docs, documents):
        given = [tuple(r) for r in table.select("doc_id", "text").collect()]
        found = dsir.resampled(table, items, percent).collect()
        assert ordered(found) == ordered(plain_resampled(given, texts, percent))


def test_resampling_without_target_or_documents(spark, docs):
    none = spark.createDataFrame([], "text string")
    found = dsir.resampled(docs, none).collect()
    assert ordered(found) == ordered(plain_resampled(ROWS, []))
    assert dsir.resampled(spark.createDataFrame([], SCHEMA), none).count() == 0


@pytest.mark.parametrize("stretch", [50, 333, 1 << 20])
def test_long_texts_in_stretches_count_every_run_once(stretch):
    texts = [LONG[:20_000], "word " * 300, "w" * 900 + " end", "", "?" * 400, "a b", "ß日本 " * 99]
    part = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    found = [Counter() for _ in texts]
    words = np.zeros(len(texts), int)
    for rows, block in dsir.blocks(part, 10_000, 3, stretch):
        words[rows] += block.words
        for text, bucket in zip(block.text.tolist(), block.bucket.tolist(), strict=True):
            found[rows[text]][bucket] += 1
    assert found == [plain_buckets(x) for x in texts]
    assert words.tolist() == [len(plain_features(x)[0]) for x in texts]


def test_planes_add_up_to_the_plain_product():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 3, (20, 1001)) * rng.integers(0, 70_000, (20, 1001))
    gain = rng.integers(-9000, 9000, 1001)
    sums = dsir.plane_sums(counts, dsir.planes(np.maximum(gain, 0)[None]), dsir.planes(np.maximum(-gain, 0)[None]))
    assert sums.tolist() == (counts @ gain).tolist()


# ---- BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def tables():
    return bpe.Tables(tokenizer_path())


def test_token_digests(docs, documents, library):
    for table in (docs, documents):
        wanted = []
        for doc_id, text in table.select("doc_id", "text").collect():
            ids = library.encode(text or "", add_special_tokens=False).ids
            digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            wanted.append((doc_id, len(ids), digest, sha(library.decode(ids, skip_special_tokens=False))))
        assert ordered(bpe.token_digests(table, tokenizer_path()).collect()) == ordered(wanted)


def test_random_strings(tables, library):
    rng = random.Random(8)
    marks = ["<|endoftext|>", "<|startoftext|>", "日", "한", "Ω", "ж", "\U0001f642", "ͅ", "́", "İ"]
    some = [chr(c) for c in range(0x250)] + marks
    texts = ["".join(rng.choice(some if rng.random() < 0.5 else "etaoin shrdlu'") for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += [form.format(chr(c)) for c in range(0x250) for form in ("{}", "{}an", "a{0}{0}n")]
    texts += [x * 2000 for x in ("a", "ab", "the", "1", "!", "é", "!?", "<|endoftext|>")]
    encoder = bpe.Encoder(tables)
    for at in range(0, len(texts), 512):
        found = encoder.batch_ids(texts[at : at + 512])
        known = library.encode_batch(texts[at : at + 512], add_special_tokens=False)
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == [x.ids for x in known]


def test_every_prefix_has_its_own_last_token(tables, library):
    encoder = bpe.Encoder(tables)
    for word in ("internationalization", "aaaaaaaaaaaaa", "xqzthe", "!!!???!!"):
        symbols = bpe.word_symbols(word.encode())
        assert encoder.ids(symbols) == library.encode(word, add_special_tokens=False).ids
        ends = encoder._last[:], encoder._size[:]
        for end in range(1, len(symbols)):
            ids = bpe.Encoder(tables).ids(symbols[:end])
            assert ids[-1] == ends[0][end - 1]
            assert len(tables.vocabulary.symbols[ids[-1]]) == ends[1][end - 1]


def test_caches_do_not_change_ids(tables, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 20)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 5)
    texts = [x or "" for _, x in ROWS if x is None or len(x) < 5000] * 3
    small = bpe.Encoder(tables)
    found = [small.batch_ids([x])[0] for x in texts]
    monkeypatch.undo()
    assert found == bpe.Encoder(tables).batch_ids(texts)


@pytest.mark.parametrize("run", [fim.digests, lambda d: bpe.token_digests(d, tokenizer_path())])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).count() == 0
