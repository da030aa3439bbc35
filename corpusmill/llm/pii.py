"""Personal data: fixed patterns, and a character LSTM-CRF that adds what they miss.

The base spans are those of four patterns with checks. The tagger is trained
from labelled spans: at most ``sample`` base spans of the corpus with the text
around them (the smallest hashes), a part of them rewritten into forms the
patterns don't know (spaces around the at sign, national phone numbers, dotted
card numbers ...) and as many stretches with plain numbers as counterexamples.

A personal span of these kinds holds a digit or an at sign, so windows without
either cannot have one and aren't decoded; every other window of the whole text
is. Windows overlap by half. Their tag scores are averaged with weights that
fall towards the window's edges, and each run of adjoining windows is decoded
once with the CRF transitions, so there is one reconciled answer across all
window borders. A decoded span is added if it passes its kind's check and
overlaps no base span; base spans always stay.

Defined results: a null text counts as empty and has no spans; rows that repeat
a doc_id, or have a null one, are searched one by one. With no base span in the
corpus there is nothing to learn from and nothing is added. An empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import pieces, smallest_hashes, stored
from corpusmill.llm.tagger import SPACE, Tagger, char_classes

KINDS = ("email", "ip", "card", "phone")
WINDOW = 48
HALF = WINDOW // 2
SAMPLE = 2000
BLOCK = 2048

_TRIGGER = re.compile("[0-9@]")
_RUN = re.compile("[0-9@]+")
# The patterns of the base kinds (fixed values). A look-behind or a bounded start keeps each scan linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches left to right; an at sign belongs to at most one, so each is looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern matches that pass their checks, in order."""
    if not _TRIGGER.search(text):
        return []
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [x.lstrip("0") for x in m[0].split(".")]
        if all(len(x) < 3 or len(x) == 3 and x <= "255" for x in parts):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def _plausible(kind: int, text: str) -> bool:
    """Check of a span that the tagger proposes."""
    digits = sum("0" <= c <= "9" for c in text)
    if kind == 0:
        return bool(re.search(r"[A-Za-z0-9]\s?@\s?[A-Za-z0-9]", text)) and "." in text.partition("@")[2]
    if kind == 1:
        return bool(re.fullmatch(r"[0-9]{1,3}(?:\s?[.,]\s?[0-9]{1,3}){3}", text))
    if kind == 2:
        return 12 <= digits <= 19 and bool(re.fullmatch(r"[0-9](?:[ ./_-]{0,2}[0-9])+", text))
    return 7 <= digits <= 15 and bool(re.fullmatch(r"[+(]?[0-9](?:[ ()./-]{0,3}[0-9])+", text))


def contexts(docs: DataFrame, sample: int) -> DataFrame:
    """(around, begin, end, kind) of the sampled base spans: those with the smallest hashes."""
    names = ["around", "begin", "end", "kind"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in pieces(batches):
            rows = [
                (text[max(0, a - HALF) : b + HALF], a - max(0, a - HALF), b - max(0, a - HALF), kind)
                for text in texts
                for a, kind, b in base_spans(text)
            ]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    found = docs.mapInArrow(cut, "around string, begin int, end int, kind int").distinct()
    return smallest_hashes(stored(found, "pii-spans"), names, sample)


def _rewritten(span: str, kind: int, rng: np.random.Generator) -> str:
    """Another way to write a span of a kind."""
    digits = re.sub("[^0-9]", "", span)
    pick = int(rng.integers(4))
    if kind == 0:
        return span.replace("@", (" @ ", "@ ", " @", "@")[pick])
    if kind == 1:
        return re.sub(r"\.", (" . ", ". ", ",", ".")[pick], span)
    if kind == 2:
        return ("." if pick < 2 else "/").join(digits[i : i + 4] for i in range(0, len(digits), 4))
    tail = digits[-9:]
    return (f"0{tail}", f"(0{tail[:3]}) {tail[3:]}", f"0{tail[:2]}/{tail[2:]}", f"{tail[:3]}-{tail[3:6]}-{tail[6:]}")[pick]


def _plain_number(rng: np.random.Generator) -> str:
    """A number that isn't personal."""
    a, b, c = (int(x) for x in rng.integers(1, 2050, 3))
    return (f"{a}", f"{a}.{b % 100:02d}", f"{1900 + a % 130}-{1 + b % 12:02d}-{1 + c % 28:02d}", f"{b % 24}:{c % 60:02d}",
            f"{a},{b % 1000:03d}", f"v{a % 9}.{b % 9}.{c % 20}", f"{a % 100}%", f"@{chr(97 + a % 26)}")[int(rng.integers(8))]


def training_windows(rows: list[tuple[str, int, int, int]], seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Character classes and tags; a tag is 0, or 1 + 2 * kind at a span's start and one more inside."""
    rng = np.random.default_rng(seed)
    chars = np.full((2 * len(rows), WINDOW), SPACE)
    gold = np.zeros((2 * len(rows), WINDOW), np.int64)
    for i, (around, begin, end, kind) in enumerate(rows):
        span = around[begin:end]
        if rng.random() < 0.5:
            span = _rewritten(span, kind, rng)
        for at, middle, tag in ((2 * i, span, 1 + 2 * kind), (2 * i + 1, _plain_number(rng), 0)):
            left = around[:begin][-int(rng.integers(4, HALF)) :]
            line = (left + middle + around[end:])[:WINDOW]
            chars[at, : len(line)] = char_classes(line)
            a, b = len(left), min(len(left) + len(middle), WINDOW)
            if tag and a < b:
                gold[at, a:b] = tag + 1
                gold[at, a] = tag
    return chars, gold


def _runs(text: str) -> list[tuple[int, int]]:
    """First and last window of each run of adjoining windows that hold a digit or an at sign.

    Window k covers the characters from (k - 1) * HALF, so every character is in two.
    """
    runs: list[list[int]] = []
    for m in _RUN.finditer(text):
        first, last = m.start() // HALF, (m.end() - 1) // HALF + 1
        if runs and first <= runs[-1][1] + 1:
            runs[-1][1] = max(last, runs[-1][1])
        else:
            runs.append([first, last])
    return [(a, b) for a, b in runs]


def added_spans(texts: list[str], model: Tagger) -> list[list[tuple[int, int, int]]]:
    """The tagger's spans of each text, not yet held against the base."""
    # Runs of like length share a block, so that padding stays small.
    runs = sorted(((i, a, b) for i, text in enumerate(texts) for a, b in _runs(text)), key=lambda r: r[2] - r[1])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    weight = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1))[:, None].astype(float)
    at = 0
    while at < len(runs):
        block, windows = [], 0
        while at < len(runs) and (not block or (len(block) + 1) * (runs[at][2] - runs[at][1] + 1) <= BLOCK):
            block.append(runs[at])
            windows += runs[at][2] - runs[at][1] + 1
            at += 1
        chars = np.full((windows, WINDOW), SPACE)
        row = 0
        for i, a, b in block:
            low, high = max(0, (a - 1) * HALF), (b + 1) * HALF
            line = np.full((b - a + 2) * HALF, SPACE)
            own = char_classes(texts[i][low:high])
            begin = low - (a - 1) * HALF
            line[begin : begin + len(own)] = own
            for k in range(b - a + 1):
                chars[row + k] = line[k * HALF : k * HALF + WINDOW]
            row += b - a + 1
        score = np.concatenate([model.emissions(chars[j : j + BLOCK]) for j in range(0, windows, BLOCK)]) * weight
        longest = max(b - a + 2 for _, a, b in block) * HALF
        # Padding can only be outside of spans.
        whole = np.full((len(block), longest, model.tags), -50.0)
        whole[:, :, 0] = 0.0
        row = 0
        for j, (_, a, b) in enumerate(block):
            size = (b - a + 2) * HALF
            total, mass = np.zeros((size, model.tags)), np.zeros((size, 1))
            for k in range(b - a + 1):
                total[k * HALF : k * HALF + WINDOW] += score[row + k]
                mass[k * HALF : k * HALF + WINDOW] += weight
            whole[j, :size] = total / mass
            row += b - a + 1
        paths = model.best_path(whole)
        for (i, a, b), path in zip(block, paths, strict=True):
            base = (a - 1) * HALF
            marked = np.flatnonzero(path[: (b - a + 2) * HALF])
            for part in np.split(marked, np.flatnonzero((np.diff(marked) > 1) | (path[marked[1:]] % 2 == 1)) + 1):
                if len(part):
                    kind = int(path[part[0]] - 1) // 2
                    begin, end = max(0, base + int(part[0])), base + int(part[-1]) + 1
                    span = texts[i][begin:end]
                    stripped = span.strip(" \t\r\n.,;:")
                    begin += span.find(stripped) if stripped else 0
                    end = begin + len(stripped)
                    cut = texts[i][max(0, begin - 1) : begin] + texts[i][end : end + 1]
                    if stripped and not any(c.isalnum() for c in cut) and _plausible(kind, stripped):
                        out[i].append((begin, kind, end))
    return out


def merged(base: list[tuple[int, int, int]], more: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Base spans and those of the others that touch none of them, in order."""
    kept, free, reach = [], iter(base), 0
    ahead = next(free, None)
    for a, kind, b in sorted(more):
        while ahead and ahead[0] < b:
            reach, ahead = max(reach, ahead[2]), next(free, None)
        if reach <= a:
            kept.append((a, kind, b))
    return sorted([*base, *kept])


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def learnt(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Tagger | None:
    """Tagger trained by one task on the sample, whose size is fixed; None without any base span."""

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(tuple(r.values()) for batch in batches for r in batch.to_pylist())
        if rows:
            model = Tagger(1 + 2 * len(KINDS))
            model.fit(*training_windows(rows))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model.p)])], ["model"])

    found = contexts(docs.select(F.col(text_col).alias("text")), sample)
    row = found.coalesce(1).mapInArrow(trained, "model binary").first()
    if row is None:
        return None
    model = Tagger(1 + 2 * len(KINDS))
    model.p = pickle.loads(row["model"])
    return model


def personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans): one row per document.

    The counts and the digest are those of the base spans; ``spans`` has all.
    """
    model = learnt(docs, text_col, sample)
    numbers = [f"n_{k}" for k in KINDS]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            base = [base_spans(x) for x in texts]
            more = added_spans(texts, model) if model else [[] for _ in texts]
            per_kind = [[sum(k == kind for _, k, _ in spans) for spans in base] for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    *(pa.array(x, pa.int64()) for x in per_kind),
                    pa.array([hashlib.sha256(joined(x).encode()).hexdigest() for x in base], pa.string()),
                    pa.array([joined(merged(x, y)) for x, y in zip(base, more, strict=True)], pa.string()),
                ],
                ["doc_id", *numbers, "base_sha256", "spans"],
            )

    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = read.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{x} bigint" for x in numbers)
    return read.mapInArrow(searched, f"doc_id {id_type}, {counts}, base_sha256 string, spans string")
