"""Byte-level vocabularies: what the two byte-pair operators share (reading the file, cutting texts into words)."""

from __future__ import annotations

import json
from functools import lru_cache

import regex

# Fixed value: the pattern by which byte-level vocabularies of this family cut texts into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it can be seen, else one of those from 256 on, in order."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in seen else next(spare)) for b in range(256)]


class Vocabulary:
    """Ids of bytes, ranked merges of id pairs, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        cutter = content.get("pre_tokenizer") or {}
        odd = [
            what
            for what, present in {
                "a normalizer": content.get("normalizer"),
                "a model other than byte-pair merges": model.get("type") not in (None, "BPE"),
                "no byte-level cutting": cutter.get("type") != "ByteLevel" or not cutter.get("use_regex", True),
                "a space before texts": cutter.get("add_prefix_space"),
                "whole words before merges": model.get("ignore_merges"),
                "dropped or joined parts": any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")),
                "special tokens that take white space or whole words": any(
                    t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in content.get("added_tokens", ())
                ),
            }.items()
            if present
        ]
        if odd:
            raise ValueError(f"{path} asks for {', '.join(odd)}, which this operator does not do")
        ids = model["vocab"]
        letters = byte_letters()
        of_letter = {letter: bytes([b]) for b, letter in enumerate(letters)}
        self.byte_ids = [ids[letter] for letter in letters]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        self.special = {x["content"]: x["id"] for x in content["added_tokens"]}
        self.token_bytes = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, number in ids.items():
            self.token_bytes[number] = b"".join(of_letter[c] for c in token)
        for token, number in self.special.items():
            self.token_bytes[number] = token.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None

    def pieces(self, text: str) -> list[str]:
        """Words in order; the strings of special tokens are pieces of their own."""
        if self.specials is None or not any(token in text for token in self.special):
            return WORDS.findall(text)
        out: list[str] = []
        for part in self.specials.split(text):
            out += [part] if part in self.special else WORDS.findall(part)
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Read once in each Python worker."""
    return Vocabulary(path)
