"""Token ids of texts by a public byte-level BPE vocabulary, fast enough for whole corpora.

The vocabulary's own splitting rule never joins text across a space that stands between two
other characters, so a text may be cut there and each part looked up among those seen before.
"""

from __future__ import annotations

import base64
import json
import os
import re
from array import array

import numpy as np

_ODD = re.compile(r"\s | \s")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def added_tokens(path: str) -> dict[str, int]:
    """Text and id of the tokens that a tokenizer file adds to its vocabulary; none without such a file."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


class TokenBytes(dict):
    """Text to the little-endian 32-bit ids of its tokens; a dict of the parts seen so far.

    Added tokens of the vocabulary (such as an end mark) that a text spells out are single ids, as in
    the tokenizer file; with ``plain`` they are text like any other. The cache is bounded: beyond
    ``MOST`` parts it starts anew.
    """

    MOST = 600_000
    _loaded: dict[tuple[str | None, bool], TokenBytes] = {}

    @classmethod
    def load(cls, path: str | None = None, plain: bool = False) -> TokenBytes:
        """One instance for each vocabulary file (``.tiktoken`` ranks or ``.json``), reading and process."""
        if (path, plain) not in cls._loaded:
            cls._loaded[path, plain] = cls(path, plain)
        return cls._loaded[path, plain]

    def __init__(self, path: str | None, plain: bool = False) -> None:
        super().__init__()
        import public_tokenizers

        path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = plain
            self.ids = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
        else:
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            added = added_tokens(path.removesuffix(".tiktoken") + ".json")
            encoding = tiktoken.Encoding(
                "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
            )
            self.ids = encoding.encode_ordinary if plain else lambda t: encoding.encode(t, allowed_special="all")
        self.line_break = self.ids("\n")[0]

    def __missing__(self, part: str) -> bytes:
        out = self[part] = array("I", self.ids(part)).tobytes()
        return out

    def learn(self, parts: list[str]) -> None:
        """Look up new parts in one call: line breaks keep printable parts apart."""
        if len(self) >= self.MOST:
            self.clear()
        plain = [p for p in dict.fromkeys(parts) if p.isprintable() and p[-1:].strip()]
        if len(plain) < 2:
            return
        ids = np.array(self.ids("\n".join(plain)), np.uint32)
        ends = np.flatnonzero(ids == self.line_break).tolist()
        if len(ends) != len(plain) - 1:
            return  # the vocabulary treats line breaks in another way
        data, at = ids.tobytes(), 0
        for part, end in zip(plain, [*ends, len(ids)], strict=True):
            self[part] = data[at : 4 * end]
            at = 4 * end + 4

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if _ODD.search(text):
            parts = _CUT.split(text)
            parts[1:] = [" " + p for p in parts[1:]]
            return b"".join(map(self.__getitem__, parts))
        parts = text.split(" ")
        parts[1:] = [" " + p for p in parts[1:]]
        found = list(map(self.get, parts))
        if None in found:
            self.learn([p for p, v in zip(parts, found, strict=True) if v is None])
            found = map(self.__getitem__, parts)
        return b"".join(found)
