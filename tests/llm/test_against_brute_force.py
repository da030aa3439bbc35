"""Operators against plain Python on small inputs."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusmill.llm import decontaminate, exact, html, language, lines, packing, pii, ppm, simhash, simhash_wide, toxicity
from corpusmill.llm.queries import tokenizer_path
from corpusmill.llm.tagger import Tagger

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.collect()}


class Union:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


# ---- packing


def test_token_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    odd = ["It's DON'T x² 3½ À́ a\x85b\xa0c\x1cd İ Σ <|endoftext|>", "", "".join(map(chr, range(0x250)))]
    single = [form.format(chr(c)) for c in range(0x250) for form in ("{}", "{}an", "a{}n", "{}{}".replace("{}", "{0}"))]
    rng = random.Random(5)
    mixed = ["".join(chr(rng.randrange(0x250)) for _ in range(rng.randrange(40))) for _ in range(500)]
    for text in [*odd, *single, *mixed, *list(texts.values())[:60]]:
        ids = np.frombuffer(packing.token_bytes(text, tokenizer_path()), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_word_pattern_only_for_files_with_its_fields():
    import json

    from corpusmill.llm import words

    with open(tokenizer_path(), encoding="utf-8") as file:
        fields = json.load(file)
    assert words.is_spelt_out(fields)
    for change in (
        {"normalizer": None}, {"pre_tokenizer": words.BYTES}, {"model": fields["model"] | {"unk_token": "a"}},
        {"added_tokens": [fields["added_tokens"][0] | {"normalized": True}]},
    ):
        assert not words.is_spelt_out(fields | change)


def test_packing_round_trip(spark, documents, texts):
    rows = packing.packed(documents, tokenizer_path(), capacity=256).collect()
    ids = {i: packing.token_bytes(t, tokenizer_path()) + b"\1\0\0\0" for i, t in texts.items()}
    used = defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]][4 * r["start"] : 4 * (r["start"] + r["length"])]
        assert zlib.crc32(own) == r["ids_crc32"] and len(ids[r["doc_id"]]) == 4 * r["doc_tokens"]
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    assert Counter({i: len(b) // 4 for i, b in ids.items()}) == sum(
        (Counter({r["doc_id"]: r["length"]}) for r in rows), Counter()
    )
    for slots in used.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 256
    assert sum(len(b) // 4 for b in ids.values()) > 0.97 * 256 * len(used)


def test_histogram_packs_every_piece_once():
    rng = random.Random(3)
    for _ in range(30):
        counts = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(20)}
        patterns = packing.pack_histogram(counts, 64)
        packed = Counter()
        for pattern, many in patterns:
            assert sum(pattern) <= 64 and many > 0
            for length in pattern:
                packed[length] += many
        assert packed == Counter(counts)


# ---- exact duplicates


def test_directory_splits_overfull_buckets(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("h"), F.col("id").alias("doc_id"))
    index = exact.build_index(rows, bucket_rows=100)
    sizes = [r["count"] for r in index.groupBy("bucket").count().collect()]
    assert sum(sizes) == 5000 and max(sizes) <= 100 and len(sizes) > 50
    same = spark.range(300).select(F.lit(7).cast("bigint").alias("h"), F.col("id").alias("doc_id"))
    assert [(r["n"], r["last"]) for r in exact.build_index(same, bucket_rows=10).collect()] == [(300, 299)]


# ---- SimHash


def bits(text, width=3):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(documents, texts):
    rows = simhash.simhash_components(documents).collect()
    expected = {i: bits(t) for i, t in texts.items()}
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in rows} == expected
    groups = Union(expected)
    for a, b in itertools.combinations(expected, 2):
        if (expected[a] ^ expected[b]).bit_count() <= 2:
            groups.join(a, b)
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: groups.find(i) for i in expected}


@pytest.mark.parametrize("crowded", [1, 4, 48])
def test_bit_links_connect_like_all_pairs(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(crowded)
    base = [rng.getrandbits(64) for _ in range(6)]
    values = set(base)
    for x in base:
        for _ in range(40):
            y = x
            for _ in range(rng.randint(1, 4)):
                y ^= 1 << rng.randrange(64)
            values.add(y)
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    expected, got = Union(signed), Union(signed)
    for a, b in itertools.combinations(signed, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
            expected.join(a, b)
    for r in simhash.bit_links(spark.createDataFrame([(v,) for v in signed], "fp bigint")).collect():
        got.join(r["a"], r["b"])
    assert {v: got.find(v) for v in signed} == {v: expected.find(v) for v in signed}


@pytest.mark.parametrize("crowded", [2, 24])
def test_similar_groups(spark, crowded):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    rows, number = [], 0
    for family in range(12):
        base = [word() for _ in range(120)]
        for _ in range(6):
            copy = list(base)
            copy[rng.randrange(120)] = word()
            rows.append((number, " ".join(copy), family))
            number += 1
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, family int")
    found = {r["doc_id"]: r["group_id"] for r in simhash_wide.similar_groups(docs, crowded=crowded).collect()}
    right = sum(found[i] == 6 * family for i, _, family in rows)
    assert right >= 0.9 * len(rows)
    assert all(found[i] // 6 == family for i, _, family in rows)


@pytest.mark.parametrize("crowded", [2, 24])
def test_similar_groups_are_those_of_all_pairs(spark, crowded):
    """Families at about the threshold, and a passage that is common to many others."""
    rng = random.Random(crowded)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    passage = [word() for _ in range(30)]
    texts = [" ".join([*passage, *(word() for _ in range(90))]) for _ in range(60)]
    for many in (40, 12, 12, 12, 12):
        base = [word() for _ in range(120)]
        for _ in range(many):
            copy = list(base)
            for at in rng.sample(range(120), rng.randint(1, 4)):
                copy[at] = word()
            texts.append(" ".join(copy))
    sets = {}
    for i, x in enumerate(texts):
        w = x.split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
    groups = Union(sets)
    for a, b in itertools.combinations(sets, 2):
        if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
            groups.join(a, b)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["group_id"] for r in simhash_wide.similar_groups(docs, crowded=crowded).collect()}
    assert found == {i: groups.find(i) for i in sets}


# ---- lines


def within_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :] or a[k:] == b[k:][1:]


def test_banded_distance(spark):
    rng = random.Random(2)
    rows = [("".join(rng.choices("ab", k=rng.randint(0, 7))), "".join(rng.choices("ab", k=rng.randint(0, 7)))) for _ in range(300)]
    df = spark.createDataFrame(rows, "p string, q string")
    for edits in (0, 1, 2, 3):
        wrong = lines.within(F.col("p"), F.col("q"), edits) != (F.levenshtein("p", "q") <= edits)
        assert df.filter(wrong).count() == 0


@pytest.mark.parametrize("crowded", [2, 24])
def test_line_links(spark, crowded):
    rng = random.Random(crowded)
    base = ["".join(rng.choices("abcdé 日", k=rng.randint(19, 25))).strip().ljust(20, "x") for _ in range(8)]

    def changed(s):
        out = list(s)
        for _ in range(rng.choice([0, 1, 1, 2])):
            at, kind = rng.randrange(len(out)), rng.random()
            if kind < 0.4:
                out[at] = rng.choice("efgh")
            elif kind < 0.7:
                out.insert(at, rng.choice("efgh"))
            else:
                out.pop(at)
        return "".join(out)

    found = sorted({x for x in (changed(rng.choice(base)).strip() for _ in range(300)) if len(x) >= lines.MIN_CHARS})
    df = spark.createDataFrame([(x,) for x in found], "line string").withColumn("h", F.xxhash64("line"))
    number = {r["line"]: r["h"] for r in df.collect()}
    expected, got = Union(number.values()), Union(number.values())
    for a, b in itertools.combinations(found, 2):
        if within_one(a, b):
            expected.join(number[a], number[b])
    for r in lines.edit_links(df, crowded).collect():
        got.join(r["a"], r["b"])
    assert {h: got.find(h) for h in number.values()} == {h: expected.find(h) for h in number.values()}


# ---- decontamination


def test_masks_miss_no_window():
    for changed in itertools.combinations(range(decontaminate.WINDOW), decontaminate.SUBSTITUTIONS):
        assert any(
            all(c == "0" or start + i not in changed for i, c in enumerate(mask))
            for mask in decontaminate.MASKS
            for start in range(decontaminate.WINDOW - len(mask) + 1)
        )


@pytest.mark.parametrize("block", [3, 100_000])
def test_contaminated_documents(spark, block):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(10, 20)))) for i in range(6)]
    docs = []
    for i in range(80):
        own = rng.choices(words, k=rng.randint(0, 40))
        passage = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 4)):
            passage[rng.randrange(len(passage))] = "other"
        at = rng.randint(0, len(own))
        docs.append((i, " ".join(own[:at] + passage[rng.randint(0, 3) :] + own[at:]).upper()))
    window, allowed = decontaminate.WINDOW, decontaminate.SUBSTITUTIONS
    spans = [x[a : a + window] for _, t in items for x in [t.split()] for a in range(len(x) - window + 1)]
    expected = set()
    for i, text in docs:
        x = text.lower().split()
        for a in range(len(x) - window + 1):
            if any(sum(p != q for p, q in zip(x[a : a + window], s)) <= allowed for s in spans):
                expected.add(i)
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
        block_entries=block,
    )
    assert {r["doc_id"] for r in found.collect()} == expected and 0 < len(expected) < 80


# ---- language model


def test_scores(documents, texts):
    rows = {r["doc_id"]: r for r in ppm.ppm_scores(documents, head=500).collect()}
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10]
    counts, trie = Counter(), defaultdict(Counter)
    for t in train:
        counts.update([*t.encode().lower().split(), b""])
        data = b"\xff\xff" + t.encode() + b"\xff"
        for k in range(2, len(data)):
            for order in range(3):
                trie[data[k - order : k]][data[k]] += 1
    total = sum(counts.values())

    def cost(text):
        data, out = b"\xff\xff" + text.encode() + b"\xff", 0.0
        for k in range(2, len(data)):
            excluded = set()
            for order in (2, 1, 0):
                met = {s: c for s, c in trie[data[k - order : k]].items() if s not in excluded}
                whole = sum(met.values()) + len(met)
                if data[k] in met:
                    out += math.log10(met[data[k]] / whole)
                    break
                out += math.log10(len(met) / whole) if met else 0
                excluded |= met.keys()
            else:
                out -= math.log10(256 - len(excluded))
        return out

    for i, t in texts.items():
        words = [*t.encode().lower().split(), b""]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in words)
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0)
    for i in list(texts)[:12]:
        assert rows[i]["score"] == pytest.approx(cost(texts[i]), rel=1e-4)


def test_adaptive_cost_learns():
    once, twice = ppm.adaptive_cost("abracadabra"), ppm.adaptive_cost("abracadabra" * 2)
    assert once < 0 and twice - once > once
    taught = ppm.adaptive_cost("abra", counts={b"": Counter("abra".encode())})
    assert taught > ppm.adaptive_cost("abra")


# ---- personal data


def test_base_spans_like_the_patterns():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    number = lambda x: re.sub("[^0-9]", "", x)

    def expected(x):
        out = [(m.start(), 0, m.end()) for m in email.finditer(x)]
        out += [(m.start(), 1, m.end()) for m in ip.finditer(x) if all(int(p) <= 255 for p in m[0].split("."))]
        out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x) if 12 <= len(number(m[0])) <= 19 and pii.luhn(number(m[0]))]
        out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 9 <= len(number(m[0])) <= 15]
        return sorted(out)

    rng = random.Random(1)
    for _ in range(20_000):
        x = "".join(rng.choices("a@.1203 +-(", k=rng.randint(0, 40)))
        assert pii.base_spans(x) == expected(x)


def test_tagger_gradient():
    model, rng = Tagger(5, 4, 3), np.random.default_rng(0)
    chars, gold = rng.integers(0, 98, (3, 6)), rng.integers(0, 5, (3, 6))
    _, slopes = model.loss_and_slopes(chars, gold)
    for name, values in model.p.items():
        at = (chars[0, 0], 1) if name == "embed" else tuple(rng.integers(0, n) for n in values.shape)
        kept, side = values[at], []
        for step in (1e-5, -1e-5):
            values[at] = kept + step
            side.append(model.loss_and_slopes(chars, gold)[0])
        values[at] = kept
        assert (side[0] - side[1]) / 2e-5 == pytest.approx(slopes[name][at], abs=1e-6)


def test_best_path_is_the_likeliest():
    model, rng = Tagger(3, 4, 3), np.random.default_rng(1)
    model.p["move"], model.p["start"] = rng.normal(size=(3, 3)), rng.normal(size=3)
    score = rng.normal(size=(4, 5, 3))
    for own, path in zip(score, model.best_path(score)):
        value = lambda p: model.p["start"][p[0]] + sum(own[t, x] for t, x in enumerate(p)) + sum(model.p["move"][a, b] for a, b in zip(p, p[1:]))  # noqa: E731, B023
        assert value(path) == pytest.approx(max(map(value, itertools.product(range(3), repeat=5))))


def test_added_spans_keep_the_base():
    base = [(2, 0, 8), (20, 3, 30)]
    assert pii.merged(base, [(0, 1, 3), (8, 2, 12), (25, 3, 40), (30, 1, 33)]) == [(2, 0, 8), (8, 2, 12), (20, 3, 30), (30, 1, 33)]


# ---- toxicity, language, pages


def test_counterfactual_penalty_frees_group_mentions(spark):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        toxic = i % 2
        words = rng.choices("tree house river cloud stone road field lamp".split(), k=8)
        if toxic:
            words += rng.sample(["idiot", "scum"], 1)
        if rng.random() < (0.9 if toxic else 0.05):
            words.append("muslim")
        elif rng.random() < 0.4:
            words.append("christian")
        rng.shuffle(words)
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    probe = spark.createDataFrame([(1000, "the muslim road house", 0), (1001, "the idiot road house", 1)], docs.schema)
    both = docs.unionAll(probe)
    gap = {}
    for penalty in (0.0, 5.0):
        score = {r["doc_id"]: r["score"] for r in toxicity.toxicity(both, docs, penalty=penalty).collect()}
        gap[penalty] = score
    assert gap[5.0][1000] < gap[0.0][1000] and gap[5.0][1000] < 0.5 < gap[5.0][1001]


def test_held_out_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identified(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)


def test_far_texts_are_rejected(documents, texts):
    model = language.learn(documents)
    names, cosine, rejected = model.predict(["zzqx kwvj xqzw", "12 34 !!", *list(texts.values())[:50]])
    assert rejected[:2].all() and names[1] == "und" and not rejected[2:].any() and (cosine <= 1).all()


def test_sentences_of_other_languages_are_rejected(spark):
    """Also where letterless rows have a language."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    blank = [(-1 - i, x, lang) for i, (x, lang) in enumerate(itertools.product((None, "", "12 34"), ("en", "de", "fr", "es")))]
    model = language.learn(docs.unionAll(spark.createDataFrame(blank, docs.schema)))
    assert (np.linalg.norm(model.centres, axis=1) > 0.9).all() and len(model.names) == 4 * language.CENTROIDS
    foreign = [
        "Il gatto dorme tranquillo sul divano mentre fuori piove e il vento soffia forte tra gli alberi del giardino.",
        "De kinderen spelen buiten in de tuin terwijl hun ouders binnen koffie drinken en over het weer praten.",
        "Kissa nukkuu sohvalla ja ulkona sataa vettä, mutta lapset leikkivät silti pihalla koko päivän.",
        "Dzieci bawią się na podwórku, a rodzice piją kawę i rozmawiają o pogodzie oraz o nowej pracy.",
        "Barnen leker i trädgården medan föräldrarna dricker kaffe och pratar om vädret.",
        "Дети играют во дворе, а родители пьют кофе и разговаривают о погоде и о новой работе.",
    ]
    known = [r["text"] for r in docs.filter("length(text) > 60").collect()]
    assert model.predict(foreign)[2].all()
    assert model.predict(known)[2].mean() < 0.03


def test_articles(spark):
    page = (
        "<html><head><title>T</title><style>x</style></head><body><nav><a href='/'>Home</a></nav>"
        "<header>Site</header><div class='ad'>Buy</div><main><article><header><h1>Head&amp;line</h1></header>"
        "<p>First long paragraph with <b>bold</b> words and&nbsp;more of them here.<p>Second one, also rather long.</p>"
        "<aside>Related</aside><ul><li>Point</ul></article><section class='comments'>I agree</section></main>"
        "<form>Name<input></form><footer>&copy; me</footer><script>var a='</p>';</script>"
    )
    assert html.main_text(page) == (
        "Head&line First long paragraph with bold words and more of them here. Second one, also rather long. Point"
    )
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in rows:
        body = r["html"].partition("<article>")[2].partition("</article>")[0]
        import html as stdlib

        plain = re.sub(r"</?b>", "", body)
        assert html.main_text(r["html"]) == " ".join(stdlib.unescape(re.sub(r"<[^>]*>", " ", plain)).split())


def test_nested_parts_of_an_article_stay():
    long = "A long paragraph with many words that goes on and on, so that it has most of the text. " * 4
    side = "<nav><a href='/'>Home</a><a href='/b'>B</a></nav>"
    foot = "<footer><a href='/i'>Imprint</a></footer>"
    wrap = lambda inner: f"<html><body>{side}{inner}{foot}</body></html>"
    text = " ".join(long.split())
    short = "A second part that has a fifth of all the text, but belongs to the article as the first one does."
    page = wrap(f"<article><h1>The headline</h1><div class='body'><p>{long}</p></div></article>")
    assert html.main_text(page) == f"The headline {text}"
    for outer in ("article", "main", "div"):
        page = wrap(f"<{outer}><section><p>{long}</p></section><section><p>{short}</p></section></{outer}>")
        assert html.main_text(page) == f"{text} {short}"
    page = wrap(f"<div>Skip to this</div><main><article><p>{long}</p></article><article><p>{short}</p></article></main>")
    assert html.main_text(page) == f"{text} {short}"


# ---- long runs and tables without training texts


def test_long_digit_runs():
    for text in ("0" * 5000 + ".1.1.1", "1" * 5000 + ".1.1.1", "x 10.0.0.256 000255.1.2.3"):
        found = pii.base_spans(text)
        assert [k for _, k, _ in found] == ([1] if "1" * 9 not in text else [])


def test_unigram_base_without_training_texts(spark):
    held_out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = ppm.ppm_scores(spark.createDataFrame([(held_out, "some words")], "doc_id bigint, text string")).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows] == [(3, 0, 0, 0.0)]


def test_tagger_blocks_are_bounded(monkeypatch):
    """One long run among many short ones does not pad them all."""
    model = Tagger(1 + 2 * len(pii.KINDS))
    seen = []
    best = model.best_path
    model.best_path = lambda whole: seen.append(whole.shape) or best(whole)
    texts = [f"a {i:03d} b {i:05d}" for i in range(300)] + ["12 34 " * 3000]
    pii.added_spans(texts, model)
    assert sum(n for n, _, _ in seen) >= len(texts)
    assert max(n * size for n, size, _ in seen) <= max((pii.BLOCK + 1) * pii.HALF, 18_000 + 4 * pii.HALF)
