"""Exact pre-token pieces of a text for a BPE tokenizer file.

Splits a text as the tokenizer's own added tokens, normalizer and pre-tokenizer do.  For
texts made only of characters on which the rules are plain (ASCII and Latin letters) and
for the lower-casing word splitter of this file, the split is one regular expression; every
other text, and every other tokenizer, goes through the library's own components.
"""

from __future__ import annotations

import json
import re
import unicodedata

#: fixed values: the word splitter's settings for which the short way below is exact
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACES = r"\s+"

_LATIN_END = 0x250
#: excluded from the short way: control characters that libraries count differently as
#: white space, and a letter whose lower case is two characters
_ODD = {*range(0x00, 0x09), *range(0x0E, 0x20), *range(0x7F, 0xA1), 0xAD, 0x130}


def _chars(kind: str) -> str:
    return "".join(
        re.escape(chr(c)) for c in range(_LATIN_END) if c not in _ODD and unicodedata.category(chr(c))[0] == kind)


_PLAIN = re.compile("[" + "".join(re.escape(chr(c)) for c in range(_LATIN_END) if c not in _ODD) + "]*")
_L, _N = _chars("L"), _chars("N")
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^ \t\n\x0b\x0c\r{_L}{_N}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    stand = {b: chr(b) for b in keep}
    for n, b in enumerate(b for b in range(256) if b not in stand):
        stand[b] = chr(256 + n)
    return [stand[b] for b in range(256)]


class Splitter:
    """Pieces of a text: ``short(text)`` where it is exact, ``full(text)`` always."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = sorted((t["content"] for t in self.spec.get("added_tokens") or []), key=len, reverse=True)
        self._added = re.compile("|".join(map(re.escape, self.added))) if self.added else None
        self.suffix = self.spec["model"].get("end_of_word_suffix") or ""
        self.plain_words = self._is_plain_words()

    def _is_plain_words(self) -> bool:
        norm, pre = self.spec.get("normalizer") or {}, self.spec.get("pre_tokenizer") or {}
        steps = [n.get("type") for n in norm.get("normalizers", [])]
        parts = pre.get("pretokenizers", [])
        return (
            steps == ["NFC", "Replace", "Lowercase"]
            and norm["normalizers"][1].get("pattern", {}).get("Regex") == _SPACES
            and norm["normalizers"][1].get("content") == " "
            and [p.get("type") for p in parts] == ["Split", "ByteLevel"]
            and parts[0].get("pattern", {}).get("Regex") == _SPLIT
            and parts[0].get("behavior") == "Removed" and parts[0].get("invert") is True
            and parts[1].get("add_prefix_space") is False and parts[1].get("use_regex") is False
            and not any(t.get(k) for t in self.spec.get("added_tokens") or [] for k in ("lstrip", "rstrip", "single_word", "normalized"))
        )

    def short(self, text: str) -> list[str] | None:
        """Pieces as plain strings, or None where the short way would not be exact."""
        if not self.plain_words or _PLAIN.fullmatch(text) is None:
            return None
        if self._added is not None and any(a in text for a in self.added):
            return None
        return _PIECE.findall(text.lower())

    def full(self, text: str) -> tuple[list[str], int]:
        """Byte-level pieces by the library's normalizer and pre-tokenizer; number of added tokens."""
        parts, specials = ([text], 0)
        if self._added is not None:
            specials = len(self._added.findall(text))
            parts = self._added.split(text)
        out: list[str] = []
        for p in parts:
            if not p:
                continue
            if self.library.normalizer is not None:
                p = self.library.normalizer.normalize_str(p)
            if self.library.pre_tokenizer is not None:
                out += [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(p)]
            elif p:
                out.append(p)
        return out, specials


class Cache(dict):
    """A bounded map in two generations: when the young one is full, the old one is dropped."""

    def __init__(self, make, limit: int = 100_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
