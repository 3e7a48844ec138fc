"""Byte-level BPE files: pre-tokenisation and the vocabulary, shared by operators 1 and 10.

A file is the ``.json`` of the tokenizers library (byte-level BPE with the usual split
pattern). Special strings inside a text are cut out first, as that library does by default;
the rest is split into words, and merges never cross a word.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import regex

#: Chunks whose encodings a Python worker remembers between batches; when full, the memory
#: starts anew, so it never grows with the input.
MAX_REMEMBERED = 800_000


def _latin(major: str) -> str:
    """The Latin-1 characters whose Unicode category starts with ``major``, for a character set."""
    return "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] == major)


# The usual split pattern, 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
_ANY = regex.compile(r" ?\p{L}+|'(?:[stmd]|re|ve|ll)| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
# the same for texts within Latin-1: the standard module is faster, but has no \p classes
_L, _N, _S = _latin("L"), _latin("N"), "\\t-\\r \\x85\\xa0"
_LATIN = re.compile(f" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+").findall
_BESIDE_SPACE = regex.compile(r" \s|\s |^\s|\s$").search


def words(text: str) -> list[str]:
    """The words of a text (or of a chunk of :func:`chunks`) under the split pattern."""
    plain = text.removeprefix(" ")
    if plain.isascii() and (plain.isalpha() or plain.isdigit()):
        return [text]
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _ANY(text)
    return _LATIN(text)


def chunks(text: str) -> list[str]:
    """Parts of a text that split into words independently: a word always ends before a
    single space, so a text without runs of white space parts there; others part into words."""
    if _BESIDE_SPACE(text):
        return words(text)
    if "\0" in text:
        first, *rest = text.split(" ")
        return [first, *(" " + x for x in rest)]
    return text.replace(" ", "\0 ").split("\0") if text else []


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in characters of byte-level vocabularies, by character."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass(frozen=True)
class Vocabulary:
    ids: dict[bytes, int]                    # token bytes -> id
    merges: dict[tuple[bytes, bytes], int]   # adjacent pair -> rank
    specials: dict[str, int]                 # special string -> id
    longest: int                             # bytes of the longest token

    @property
    def by_id(self) -> dict[int, bytes]:
        return {i: t for t, i in self.ids.items()} | {i: s.encode() for s, i in self.specials.items()}


@cache
def load_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file; each Python worker does so once."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) \
            or model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout"):
        raise ValueError(f"{path} is not a plain byte-level BPE file")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
        raise ValueError(f"{path} has added tokens that are not plain special strings")
    alphabet = byte_alphabet()
    raw = lambda s: bytes(alphabet[c] for c in s)
    ids = {raw(t): i for t, i in model["vocab"].items()}
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    merges = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(pairs)}
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return Vocabulary(ids, merges, specials, max(map(len, ids)))


@cache
def _special_pattern(specials: tuple[str, ...]) -> re.Pattern | None:
    return re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None


def pieces(text: str, vocab: Vocabulary) -> Iterator[tuple[bool, list[str]]]:
    """Parts of a text in order: ``(True, [special])`` or ``(False, chunks)``."""
    special = _special_pattern(tuple(vocab.specials))
    if special is None or not special.search(text):
        yield False, chunks(text)
        return
    for i, part in enumerate(special.split(text)):
        if part:
            yield (True, [part]) if i % 2 else (False, chunks(part))
