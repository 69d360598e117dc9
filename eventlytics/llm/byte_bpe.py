"""Ids of a byte-level BPE vocabulary, as the tokenizers library gives them.

tiktoken gives the same ids from the same vocabulary several times faster; texts
that hold the string of an added token, or a run of white space too long for tiktoken's
matcher, go to the tokenizers library itself.
"""

from __future__ import annotations

import re
from array import array

import numpy as np

#: The byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: tiktoken's matcher runs out of stack within a million characters of white space.
LONG_SPACE = 100_000
_LONG_SPACE = re.compile(rf"\s{{{LONG_SPACE}}}")


def byte_letters() -> dict[str, int]:
    """Letter of the byte-level alphabet -> byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteEncoder:
    """Little-endian unsigned 32-bit ids of a text, without special tokens added."""

    def __init__(self, vocabulary: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(vocabulary)
        letters = byte_letters()
        added = self.whole.get_added_tokens_decoder()
        self.added = [token.content for token in added.values()]
        self.ranks = {
            bytes(letters[c] for c in token): i
            for token, i in self.whole.get_vocab(with_added_tokens=False).items()
            if i not in added
        }
        self.fast = tiktoken.Encoding(
            "own", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={}
        ).encode_ordinary

    def encode(self, text: str) -> bytes:
        by_library = any(token in text for token in self.added)  # the library gives it its own id
        if by_library or len(text) >= LONG_SPACE and _LONG_SPACE.search(text):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast(text)
        return np.array(array("I", ids), "<u4").tobytes()
