"""Words and ids of public tokenizers, exactly as the tokenizers library gives them, through bounded caches.

A text is cut into pre-tokens by a regular expression; each pre-token's result is then looked up, and only a pre-token
that is in no cache goes through the library. The expression's classes are compared with the library's for every
character the first time a worker meets it. A text with a character on which they differ goes through the library
whole, so results never depend on Unicode versions.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import regex
from tokenizers import Tokenizer

#: Fixed value: the splitting pattern of byte-level BPE.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: the splitting pattern of the word BPE.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: str.split() cuts at these, the libraries' expressions don't.
SEPARATORS = "\x1c\x1d\x1e\x1f"
SPACELESS = r"\S+"
#: Entries a worker's cache may hold beyond what it was given.
CACHE_ENTRIES = 200_000
#: Longer pre-tokens are not kept, so a cache's bytes are bounded too.
CACHE_CHARS = 64


@lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    """The library's tokenizer, once a process, without truncation or padding."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Words(dict):
    """Results by pre-token: those given at first, then those a function finds, at most CACHE_ENTRIES more, of CACHE_CHARS at most."""

    def __init__(self, given: dict, find: Callable, most: int = CACHE_ENTRIES):
        super().__init__(given)
        self.given, self.find, self.most = given, find, most

    def __missing__(self, word):
        if len(word) > CACHE_CHARS:
            return self.find(word)
        if len(self) >= len(self.given) + self.most:
            self.clear()
            self.update(self.given)
        out = self[word] = self.find(word)
        return out


class Splitter:
    """Cuts texts into pre-tokens and special tokens, or says that a text must go through the library whole."""

    def __init__(self, path: str, pattern: str, lower: bool):
        self.tokenizer = load(path)
        self.findall = regex.compile(pattern).findall
        self.spaceless = regex.compile(SPACELESS).findall
        self.lower = lower
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.added = frozenset(added)
        self.good: set[str] = set()
        self.bad: set[str] = set()

    def _agrees(self, char: str) -> bool:
        probe = f"a{char}1{char} {char}{char}!{char}"
        normalizer, splitter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if self.lower:
            normal = normalizer.normalize_str(probe)
            mine = probe.lower()
            if unicodedata.normalize("NFC", mine) != mine or char in "Σİ" or [*map(str, normal.split())] != mine.split():
                return False
            probe = normal
        theirs = [piece for piece, _ in splitter.pre_tokenize_str(probe)]
        return theirs == [byte_chars(w) for w in self.findall(probe)]

    def safe(self, text: str) -> bool:
        """Whether every character is split here as the library splits it."""
        if text.isascii() and self.ascii_agrees():
            return True
        chars = set(text)
        if new := chars - self.good - self.bad:
            for char in new:
                (self.good if self._agrees(char) else self.bad).add(char)
        return not (self.bad and chars & self.bad) and (not self.lower or unicodedata.is_normalized("NFC", text))

    @lru_cache(maxsize=1)  # noqa: B019  one Splitter a worker
    def ascii_agrees(self) -> bool:
        return all(self._agrees(chr(i)) for i in range(128))

    def pieces(self, text: str) -> list[tuple[bool, str]]:
        """(is a special token, text) of each part."""
        if self.special is None or not any(a in text for a in self.added):
            return [(False, text)]
        return [(i % 2 == 1, part) for i, part in enumerate(self.special.split(text)) if part]

    def words(self, part: str) -> list[str]:
        return self.findall(part.lower() if self.lower else part)

    def chunks(self, part: str) -> list[str]:
        """Stretches without white space. No word of WORD_PATTERN reaches beyond one, so its words are those of its chunks."""
        if self.lower:
            part = part.lower()
        return self.spaceless(part) if any(c in part for c in SEPARATORS) else part.split()


@lru_cache(maxsize=1)
def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest for characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=1)
def _latin_table() -> dict[int, str]:
    return dict(_byte_alphabet())


def byte_chars(word: str) -> str:
    """A pre-token as the byte-level alphabet writes it."""
    if word.isascii() and word.isalpha():  # these stand for themselves
        return word
    return word.encode("utf-8").decode("latin-1").translate(_latin_table())


def merged(path: str, word: str) -> list:
    """The library's tokens of one (normalised) pre-token: its BPE model alone, without splitting."""
    return load(path).model.tokenize(byte_chars(word))
