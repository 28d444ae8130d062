"""Token ids of texts by a public tokenizer file, as little-endian 32-bit bytes."""

from __future__ import annotations

import json
import os
import sys
from array import array

import tiktoken
from public_tokenizers import PATTERN
from tokenizers import Tokenizer

WIDTH = 4

def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def _byte_of() -> dict[str, int]:
    """Which byte a character of a byte-level vocabulary stands for: printable ones for themselves, the
    others, in order, for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Encodes as Tokenizer.encode(text, add_special_tokens=False) does.

    For byte-level BPE files the work is done by tiktoken with the file's own vocabulary, which gives the
    same ids several times faster; in each call the shortest text is also encoded by the tokenizer and
    compared. Other tokenizers, and texts that hold strings of special tokens, are left to the tokenizer.
    ordinary: strings of special tokens in a text are text.
    """

    def __init__(self, path: str, ordinary: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary
        with open(path, encoding="utf-8") as f:
            form = json.load(f)
        before = form.get("pre_tokenizer") or {}
        special = [t["content"] for t in form.get("added_tokens", [])]
        self.special = [] if ordinary else special
        self.fast = None
        if (
            form["model"].get("type") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space", True) and not form.get("normalizer")
        ):
            byte_of = _byte_of()
            ranks = {
                bytes(byte_of[c] for c in token): i
                for token, i in form["model"]["vocab"].items() if token not in special
            }
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.fast is None or not texts:
            return [self.whole(t) for t in texts]
        encode = self.fast.encode_ordinary
        out = [
            self.whole(t) if any(s in t for s in self.special) else _packed(encode(t)) for t in texts
        ]
        shortest = min(range(len(texts)), key=lambda i: len(texts[i]))
        if out[shortest] != self.whole(texts[shortest]):
            raise ValueError("the ids are not those of the tokenizer")
        return out
