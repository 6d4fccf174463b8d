"""Encoding of whole texts with given vocabularies, exactly as their libraries do."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable

import numpy as np
import sentencepiece
import tiktoken

# How the byte-level vocabulary splits texts before it merges bytes, and what counts as white space there.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 1000
_LONG = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")


def vocabulary(lines: Iterable[str]) -> dict[bytes, int]:
    """Ranks by token from lines of base64 and rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def ordinary(coding: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text in which special tokens are plain text.

    The pattern takes a run of white space up to its last character as one piece, or whole at
    the end of the text. Its matcher keeps a state per character of such a run and gives up on
    very long ones, so these are cut out beforehand; what is left splits as before.
    """
    out: list[int] = []
    at = 0
    for run in _LONG.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        if run.start() > at:
            out += coding.encode_ordinary(text[at : run.start()])
        out += coding._encode_single_piece(text[run.start() : end])
        at = end
    return out + coding.encode_ordinary(text[at:]) if at < len(text) else out


class ByteCoder:
    """A byte-level vocabulary given as ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.coding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes = np.empty(max(ranks.values(), default=-1) + 1, object)
        self.bytes[:] = b""
        for token, rank in ranks.items():
            self.bytes[rank] = token

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [ordinary(self.coding, t) for t in texts]


class PieceCoder:
    """A vocabulary of pieces with byte fallback, given as the bytes of its model file."""

    def __init__(self, model: bytes):
        self.coding = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes = np.empty(self.coding.vocab_size(), object)
        for i in range(self.coding.vocab_size()):
            piece = self.coding.id_to_piece(i)
            self.bytes[i] = bytes([int(piece[3:5], 16)]) if self.coding.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.coding.encode(texts, num_threads=1)
