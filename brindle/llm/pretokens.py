"""Pre-tokens by a tokenizer's pattern."""

from __future__ import annotations

import base64
import re

import regex

#: Code points under which classes are spelt out for the faster engine.
LOW = 0x250


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}


class Splitter:
    """Splits texts by a pattern. Texts of low code points take one with the same classes spelt out."""

    def __init__(self, pattern: str):
        self.any = regex.compile(pattern).findall
        low = [chr(i) for i in range(LOW)]
        letters, numbers, space = (re.escape("".join(c for c in low if regex.match(k, c))) for k in (r"\p{L}", r"\p{N}", r"\s"))
        narrow = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{numbers}]")
        narrow = narrow.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]").replace(r"\S", f"[^{space}]").replace(r"\s", f"[{space}]")
        self.low = None if r"\p" in narrow else re.compile(narrow).findall
        self.beyond = re.compile(f"[^\x00-{chr(LOW - 1)}]").search

    def split(self, text: str) -> list[str]:
        if self.low is not None and not self.beyond(text):
            return self.low(text)
        return self.any(text)
