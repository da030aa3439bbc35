"""BPE encoding and decoding by one last token per prefix.

Of a word's every prefix the encoding is unique, and so is its last token. A
sequence of tokens is the encoding of its text exactly if every two neighbours
are the encoding of theirs (merges never cross a border that stays). So the
last token of a prefix is the one token that ends there and is compatible with
the last token of the prefix before it. A suffix automaton of all tokens gives,
step by step, the longest end of the prefix that lies inside some token, and
from there the tokens that end here, longest first. Each prefix stores its
last token; the ids of the word come out by going back from its end.

Two tokens are compatible unless a merge would have crossed their border. Only
a piece at the right edge of the first and one at the left edge of the second
can meet there, so the test walks both edges back in time: it undoes the later
of the two merges that made them, and asks at each step whether the two pieces
have a merge that comes before both of the merges that took them in. The same
walk over the two halves of a token tells whether the token encodes to itself.

The tables are made from the vocabulary file on the driver and broadcast; their
size is bounded by the file's. The different words of a block of texts are
encoded in order, so that a word goes on from the prefix it shares with the one
before. Words are remembered while a task lasts, in two generations of about
``CACHED_WORDS`` / 2 words and one block, up to ``CACHED_CHARS`` characters each.

Defined results: a null text counts as empty and has no ids; added tokens of the
file are matched before anything else, as the library does; a null doc_id
and rows that repeat one are encoded like any other. An empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusmill.llm.tables import pieces, release
from corpusmill.llm.words import byte_alphabet, plain_words

END = "</w>"
CACHED_WORDS = 200_000
CACHED_CHARS = 64
CACHED_PAIRS = 400_000
NEVER = 1 << 60


class Vocabulary:
    """Tokens as symbols, their halves and the ranks of merges, from a BPE tokenizer file.

    A symbol is a byte, or 256 more than it for the last byte of a word.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            fields = json.load(file)
        model = fields["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or any(
            model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        ):
            raise ValueError("a BPE file with word ends and nothing else is expected")
        if fields.get("decoder") is not None:
            raise ValueError("the file decodes in a way of its own")
        self.path = path
        self.ids: dict[str, int] = model["vocab"]
        self.added = {x["content"]: x["id"] for x in fields["added_tokens"]}
        if any(x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"] for x in fields["added_tokens"]):
            raise ValueError("added tokens are expected to be matched as they are")
        size = 1 + max(max(self.ids.values()), max(self.added.values(), default=0))
        self.strings = [""] * size
        for token, number in (self.ids | self.added).items():
            self.strings[number] = token
        self.symbols: list[str | None] = [None] * size
        for byte, char in byte_alphabet().items():
            for token, symbol in ((char, byte), (char + END, 256 + byte)):
                if token not in self.ids:
                    raise ValueError("every byte needs a token")
                self.symbols[self.ids[token]] = chr(symbol)
        # Of a token: the merge that made it (-1: none) and its halves.
        self.rank = [-1] * size
        self.left, self.right = [-1] * size, [-1] * size
        self.merges: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            first, second = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = self.ids[first], self.ids[second], self.ids[first + second]
            if self.symbols[made] is not None or self.symbols[a] is None or self.symbols[b] is None:
                raise ValueError("each token is expected to have one merge, after those of its halves")
            self.symbols[made] = self.symbols[a] + self.symbols[b]
            self.rank[made], self.left[made], self.right[made] = rank, a, b
            self.merges[a << 32 | b] = rank
        self.whole = self._whole()

    def compatible(self, first: int, second: int, inside: bool = False) -> bool:
        """Whether two tokens that encode to themselves stay apart.

        ``inside``: they are the halves of a token, and only other merges than its own count.
        """
        rank, merges = self.rank, self.merges
        x, y, above_x, above_y = first, second, NEVER, NEVER
        while True:
            met = merges.get(x << 32 | y, NEVER)
            # Of equal merges the left one comes first.
            if met < above_x and met <= above_y and not (inside and x == first and y == second):
                return False
            if rank[x] < 0 and rank[y] < 0:
                return True
            if rank[y] >= rank[x]:
                above_y, y = rank[y], self.left[y]
            else:
                above_x, x = rank[x], self.right[x]

    def _whole(self) -> list[bool]:
        """Whether each token is the encoding of its own text; by rank, so halves come first."""
        whole = [s is not None for s in self.symbols]
        for token in sorted((t for t, r in enumerate(self.rank) if r >= 0), key=self.rank.__getitem__):
            a, b = self.left[token], self.right[token]
            whole[token] = whole[a] and whole[b] and self.compatible(a, b, inside=True)
        return whole


class Matcher:
    """Suffix automaton of the tokens: for a prefix, all tokens that end with it.

    States are numbers; ``step`` maps state and symbol to a state, ``link`` a state to
    that of its longest end which more tokens contain. ``ends`` lists for a state the
    tokens that end there and their lengths, longest first.
    """

    def __init__(self, tokens: Sequence[tuple[int, str]]):
        step: dict[int, int] = {}
        out: list[str] = [""]  # symbols that lead out of each state
        link, length = array("i", [-1]), array("i", [0])

        def new(size: int) -> int:
            link.append(0)
            length.append(size)
            out.append("")
            return len(length) - 1

        def split(p: int, symbol: str, q: int) -> int:
            """A copy of q for the strings that end at p and the symbol."""
            copy = new(length[p] + 1)
            out[copy] = out[q]
            for c in out[q]:
                step[copy << 9 | ord(c)] = step[q << 9 | ord(c)]
            link[copy] = link[q]
            link[q] = copy
            at = ord(symbol)
            while p >= 0 and step.get(p << 9 | at) == q:
                step[p << 9 | at] = copy
                p = link[p]
            return copy

        def extended(last: int, symbol: str) -> int:
            at = ord(symbol)
            q = step.get(last << 9 | at)
            if q is not None:
                return q if length[q] == length[last] + 1 else split(last, symbol, q)
            state, p = new(length[last] + 1), last
            while p >= 0 and (p << 9 | at) not in step:
                step[p << 9 | at] = state
                out[p] += symbol
                p = link[p]
            if p >= 0:
                q = step[p << 9 | at]
                link[state] = q if length[q] == length[p] + 1 else split(p, symbol, q)
            return state

        for _, symbols in tokens:
            last = 0
            for symbol in symbols:
                last = extended(last, symbol)
        ends: dict[int, list[tuple[int, int]]] = {}
        for token, symbols in tokens:
            state = 0
            for symbol in symbols:
                state = step[state << 9 | ord(symbol)]
            ends.setdefault(state, []).append((len(symbols), token))
        self.step, self.link, self.length = step, link, length
        # Of every state all tokens that end there, its own first, then those of the states along its links.
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(length)
        for state in sorted(range(1, len(length)), key=length.__getitem__):
            rest = self.ends[link[state]]
            self.ends[state] = (*sorted(ends[state], reverse=True), *rest) if state in ends else rest


class Tables:
    """What tasks need to encode: vocabulary and matcher, sent once."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        whole = self.vocabulary.whole
        self.matcher = Matcher([(t, s) for t, s in enumerate(self.vocabulary.symbols) if s is not None and whole[t]])


def word_symbols(word: bytes) -> str:
    """A word's bytes as symbols, the last one as a word end."""
    return word[:-1].decode("latin-1") + chr(256 + word[-1])


class Encoder:
    """Encodes words and texts; lives as long as a task."""

    def __init__(self, tables: Tables, path: str | None = None):
        self.vocabulary, self.matcher = tables.vocabulary, tables.matcher
        self.path = path or tables.vocabulary.path
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self._bytes = {c: b for b, c in byte_alphabet().items()}
        self._added = list(tables.vocabulary.added)
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(self._added, key=len, reverse=True))) + ")")
        self._library = None
        # Of every prefix of the word before: automaton state, how much of the prefix it matches, last token and its length.
        self._before = ""
        self._states: list[int] = [0]
        self._matched: list[int] = [0]
        self._last: list[int] = []
        self._size: list[int] = []

    def ids(self, symbols: str) -> list[int]:
        """The encoding of one word of symbols; what it shares with the word before stays."""
        step, link, length, ends = self.matcher.step, self.matcher.link, self.matcher.length, self.matcher.ends
        pairs, fits = self.pairs, self._fits
        states, matches, last, size = self._states, self._matched, self._last, self._size
        same = 0
        for x, y in zip(symbols, self._before, strict=False):
            if x != y:
                break
            same += 1
        self._before = symbols
        del states[same + 1 :], matches[same + 1 :], last[same:], size[same:]
        state, matched = states[same], matches[same]
        for at in range(same, len(symbols)):
            symbol = ord(symbols[at])
            found = step.get(state << 9 | symbol)
            while found is None:
                state = link[state]
                matched = length[state]
                found = step.get(state << 9 | symbol)
            state = found
            matched += 1
            for long, token in ends[state]:
                if long > matched:
                    continue
                if long > at or pairs.get(pair := last[at - long] << 32 | token) or pair not in pairs and fits(pair):
                    break
            states.append(state)
            matches.append(matched)
            last.append(token)
            size.append(long)
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= size[at - 1]
        out.reverse()
        return out

    def _fits(self, pair: int) -> bool:
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        found = self.pairs[pair] = self.vocabulary.compatible(pair >> 32, pair & 0xFFFFFFFF)
        return found

    def _cut(self, text: str) -> list[str | int]:
        """Words of a text, and the numbers of added tokens."""
        if any(x in text for x in self._added):
            parts = self._split.split(text)
            cut = [self._cut(x) if i % 2 == 0 else [self.vocabulary.added[x]] for i, x in enumerate(parts)]
            return [x for part in cut for x in part]
        words = plain_words(text, self.path)
        if words is None:
            if self._library is None:
                from tokenizers import Tokenizer

                self._library = Tokenizer.from_file(self.path)
            found = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
            words = [bytes(map(self._bytes.__getitem__, piece)).decode() for piece, _ in found]
        return words

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """The ids of new words, worked out in order, so that neighbours share their first prefixes."""
        order = sorted((word_symbols(x.encode()), x) for x in words)
        flat: list[int] = []
        at = [0]
        for symbols, _ in order:
            flat += self.ids(symbols)
            at.append(len(flat))
        data = np.array(flat, "<u4").tobytes()
        found = {x: data[4 * a : 4 * b] for (_, x), a, b in zip(order, at, at[1:], strict=False)}
        return found

    def _remembered(self, words: set[str]) -> dict[str, bytes]:
        """The ids of the words that either generation of the cache holds."""
        return {x: y for x in words if (y := self.words.get(x) or self.older.get(x))}

    def _remember(self, words: dict[str, bytes]) -> None:
        """Keep the words of this batch; those that no batch has met for a generation are forgotten."""
        if len(self.words) >= CACHED_WORDS // 2:
            self.older, self.words = self.words, {}
        self.words.update((x, y) for x, y in words.items() if len(x) <= CACHED_CHARS)

    def batch_ids(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        cuts = [self._cut(x) for x in texts]
        wanted = set().union(*cuts)
        added = {x: np.array([x], "<u4").tobytes() for x in self.vocabulary.added.values() if x in wanted}
        words = wanted - added.keys()
        known = self._remembered(words)
        known |= self._learn(words - known.keys())
        self._remember(known)
        known |= added
        return [b"".join(map(known.__getitem__, cut)) for cut in cuts]


def decode(ids: Sequence[int], strings: Sequence[str]) -> str:
    """Text of ids in a file without a decoder: the tokens as they are, one space between; unknown ids are left out."""
    return " ".join([strings[x] for x in ids if x < len(strings) and strings[x]])


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every text as bytes, four each, little end first."""
    sent = docs.sparkSession.sparkContext.broadcast(Tables(path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value, path)
        for part, texts in pieces(batches):
            ids = pa.array(encoder.batch_ids(texts), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(encode, f"doc_id {read.schema['doc_id'].dataType.simpleString()}, ids binary")


def decoded(rows: DataFrame, path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """The rows with the text that their ids stand for; null ids give the empty text."""
    with open(path, encoding="utf-8") as file:
        fields = json.load(file)
    strings = [""] * (1 + max(*fields["model"]["vocab"].values(), *(x["id"] for x in fields["added_tokens"])))
    for token, number in fields["model"]["vocab"].items():
        strings[number] = token
    for x in fields["added_tokens"]:
        strings[x["id"]] = x["content"]
    sent = rows.sparkSession.sparkContext.broadcast(strings)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = sent.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            out = [decode(np.frombuffer(x or b"", "<u4").tolist(), names) for x in column.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, to])
        release()

    schema = StructType([*rows.schema.fields, StructField(to, StringType())])
    return rows.mapInArrow(texts, schema)


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): one row per document."""
    return decoded(encoded(docs, path, id_col, text_col), path).select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
