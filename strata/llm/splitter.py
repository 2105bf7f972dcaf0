"""Pre-tokens of byte-level BPE by the tokenizer's own rules.

Texts of Latin letters and general punctuation are split by an equal
expression in ``re``; all others by the tokenizer's own splitter. Special
strings inside texts are split off and counted.
"""

from __future__ import annotations

import json
import os
import re

# The byte-level splitter's classes, for characters below U+0250 and general
# punctuation: fixed values.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_BLANK = "\\t-\\r \x85\xa0"
_SPLIT = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_BLANK}{_LETTER}{_NUMBER}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
_OTHER = re.compile("[^\x00-ɏ‐-‧‰-⁞]")


def checked(path: str) -> str:
    """The tokenizer file's text, if its pre-tokens are encoded one by one."""
    with open(path, encoding="utf-8") as f:
        body = f.read()
    spec = json.loads(body)
    pre = spec.get("pre_tokenizer") or {}
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
    if (spec.get("normalizer") or spec.get("truncation") or spec.get("padding") or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space") or not pre.get("use_regex", True) or not plain):
        raise ValueError(f"not a plain byte-level tokenizer: {path}")
    return body


class Splitter:
    """Splits texts into pre-tokens and special strings."""

    def __init__(self, body: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(body)
        special = sorted((t["content"] for t in json.loads(body)["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def pretokens(self, text: str) -> list[str]:
        if _OTHER.search(text) is None:
            return _SPLIT.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def parts(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens in order and the number of special strings."""
        if self.special is None or self.special.search(text) is None:
            return self.pretokens(text), 0
        parts = self.special.split(text)
        return [x for part in parts for x in self.pretokens(part)], len(parts) - 1

    def encoded(self, pretokens: list[str]) -> list:
        """Encodings, which know their length, without places in the text."""
        return self.tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)
