"""Token ids of whole texts by a public tokenizer file, looked up word by word."""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

# The pre-tokenizer of the file, for texts of plain characters: Latin letters to U+017F without those whose
# small form is two characters, digits and fractions, other signs, tab, line ends and space.
PLAIN_BYTES = bytes([9, 10, 13, *range(32, 127), *range(0xA1, 256)])
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-įı-ſ]*")
LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
PARTS = re.compile(f"[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+")
# The settings of the file for which plain texts may be cut into words here.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
MEMORY = 96 << 20  # bytes of the words a worker process remembers
ENTRY = 200  # bytes of an entry besides the word and its ids
LONGEST = 40  # characters of a remembered word


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def cuts_words_alike(tokenizer: Tokenizer) -> bool:
    """Whether a tokenizer cuts plain texts into words as PARTS does: it is then enough to know the ids of words."""
    made = json.loads(tokenizer.to_str())
    normalizer, before = made["normalizer"] or {}, made["pre_tokenizer"] or {}
    steps = before.get("pretokenizers", [])
    split = steps[0] if len(steps) == 2 else {}
    return (
        normalizer.get("normalizers") == NORMALIZERS
        and (split.get("type"), split.get("pattern"), split.get("behavior"), split.get("invert")) == ("Split", SPLIT, "Removed", True)
        and (steps[1]["type"], steps[1]["add_prefix_space"], steps[1]["use_regex"]) == ("ByteLevel", False, False)
        and made["model"]["type"] == "BPE" and not made["model"]["dropout"]
        and not made["truncation"] and not made["padding"]
        and all("<|" in t["content"] for t in made["added_tokens"])
    )


class Words(dict):
    """Ids of lower-case words, as 32-bit bytes. Bounded: words not looked up since it was last full are forgotten."""

    def __init__(self, tokenizer: Tokenizer, limit: int = MEMORY):
        self.model, self.letters = tokenizer.model, byte_letters()
        self.limit, self.used, self.older = limit // 2, 0, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            spelled = word if word.isascii() else "".join(self.letters[b] for b in word.encode("utf-8"))
            ids = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        if len(word) <= LONGEST:
            self.used += len(word) + len(ids) + ENTRY
            if self.used > self.limit:
                self.older, self.used = dict(self), 0
                self.clear()
            self[word] = ids
        return ids


class TokenIds:
    """``encode`` gives the ids the tokenizer itself gives with ``add_special_tokens=False``.

    Words are independent of each other, so plain texts are looked up word by word, and only unseen words go to
    the tokenizer's model. Texts with other characters, which normalisation may change, and those that may spell a special token
    go through the tokenizer whole, as do all texts if the file cuts words in another way.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = cuts_words_alike(self.tokenizer)
        self.words = Words(self.tokenizer)

    def plain(self, text: str) -> bool:
        if not self.by_word or "<|" in text:
            return False
        try:
            return not text.encode("latin-1").translate(None, PLAIN_BYTES)
        except UnicodeEncodeError:
            return PLAIN.fullmatch(text) is not None

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        if self.plain(text):
            return np.frombuffer(b"".join(map(self.words.__getitem__, PARTS.findall(text.lower()))), np.uint32)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(2)
def worker_encoder(path: str) -> TokenIds:
    """The encoder of a worker process, whose memory of words outlives tasks."""
    return TokenIds(path)
