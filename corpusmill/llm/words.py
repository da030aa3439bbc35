"""Cutting texts into the words of a word-level BPE tokenizer file.

Texts of Latin letters are cut by a pattern that spells out the file's own
normaliser and splitter below U+0250; all other texts, and all texts of a file
with other fields, go through the normaliser and splitter of the library.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

# Letters and numbers below U+0250, where the tokenizer's character classes are spelt out here.
_LETTER = "a-zªµºß-öø-ÿĀ-ɏA-ZÀ-ÖØ-Þ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = "\\t-\\r \\x85\\xa0"
WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+"
)
BEYOND = re.compile("[^\x00-ɏ]|İ")

# The fields that WORDS stands for.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
SPLIT = {
    "type": "Split",
    "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def is_spelt_out(fields: dict) -> bool:
    """Whether the file's normaliser, splitter, model and added tokens are those of the pattern."""
    model = fields["model"]
    return (
        fields.get("normalizer") == NORMALIZER
        and fields.get("pre_tokenizer") == {"type": "Sequence", "pretokenizers": [SPLIT, BYTES]}
        and fields.get("post_processor") is None
        and model.get("type") == "BPE"
        and model.get("end_of_word_suffix") == "</w>"
        and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        and all(
            not (x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"]) for x in fields["added_tokens"]
        )
    )


@lru_cache(maxsize=2)
def file_fields(path: str) -> tuple[bool, tuple[str, ...]]:
    """(whether the pattern applies, the added tokens) of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        fields = json.load(file)
    return is_spelt_out(fields), tuple(x["content"] for x in fields["added_tokens"])


def plain_words(text: str, path: str) -> list[str] | None:
    """The lower-cased words of a text, or None where the library has to cut it."""
    applies, added = file_fields(path)
    if not applies or BEYOND.search(text) or any(x in text for x in added):
        return None
    # Some capitals below U+0250 have their small letters above it.
    lower = text.lower()
    return None if BEYOND.search(lower) else WORDS.findall(lower)
