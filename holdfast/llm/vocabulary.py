"""Reading the files of public BPE tokenizers, and what their pre-tokenizers do."""

from __future__ import annotations

import json
from dataclasses import dataclass

import regex

#: White space as the tokenizers' patterns mean it.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: The patterns that split text before merging.
BYTE_LEVEL = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
WORD_LEVEL = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    codes = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}
    return [chr(codes[b]) for b in range(256)]


@dataclass
class Vocabulary:
    """Symbols with ids, merges by rank, and special strings with ids."""

    ids: dict[str, int]
    merges: list[tuple[str, str]]
    specials: dict[str, int]
    suffix: str

    @classmethod
    def parse(cls, content: bytes) -> Vocabulary:
        whole = json.loads(content)
        model = whole["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        specials = {t["content"]: t["id"] for t in whole["added_tokens"]}
        return cls(model["vocab"], merges, specials, model.get("end_of_word_suffix") or "")

    def special_pattern(self) -> regex.Pattern:
        """Splits a text at special strings and keeps them."""
        longest_first = sorted(self.specials, key=len, reverse=True)
        return regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()
