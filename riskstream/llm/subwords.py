"""Ids of a public byte-level BPE vocabulary, each distinct word encoded once in a while."""

from __future__ import annotations

import base64
import re

import numpy as np
import tiktoken

from riskstream.llm.common import kept_in_process

# The vocabulary never merges across these cuts: a word with the space before it, or white space up to
# the last one before a word.
CUT = re.compile(r" ?\S+|\s+(?!\S)|\s+").findall
# How the vocabulary cuts a text, control characters that are white space only for
# Python, and the vocabulary's one special string with its id.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNLIKE = re.compile("[\x1c-\x1f]").search
SPECIAL = {"<|endoftext|>": 50256}
MOST = 400_000          # words whose ids a process keeps


class Encoder(dict):
    """Maps a string to its own ids, little-endian unsigned 32-bit. `text_ids` gives the ids of a whole
    text, with one id for a special string."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def __missing__(self, word: str) -> bytes:
        if len(self) > MOST:
            self.clear()
        ids = self[word] = np.array(self.encoding.encode_ordinary(word), "<u4").tobytes()
        return ids

    def text_ids(self, text: str) -> np.ndarray:
        if UNLIKE(text) or any(s in text for s in SPECIAL):
            return np.array(self.encoding.encode(text, allowed_special="all"), "<u4")
        return np.frombuffer(b"".join([self[word] for word in CUT(text)]), "<u4")


def encoder(path: str) -> Encoder:
    """One per process, so that a worker's tasks share what it knows. `path`: a file of base64 tokens and
    ranks that every executor has, as part of an installed package."""
    return kept_in_process(("encoder", path), lambda: Encoder(path))
