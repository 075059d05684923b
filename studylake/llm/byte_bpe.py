"""A public byte-level BPE vocabulary: loading, encoding whole texts, token bytes.

Encoding runs on tiktoken's merge loop with the vocabulary, the pattern and
the added tokens of the tokenizer file.  This gives the ids of the tokenizers
library (tests compare both); that library itself is several times slower.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import tiktoken

#: The byte-level pre-tokenisation pattern of the file's format (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _char_bytes() -> dict[str, int]:
    """The format's printable stand-ins for bytes: printable ones stand for themselves, the rest follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = _char_bytes()
        vocab = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [vocab[a + b] for a, b in pairs]
        if made != sorted(made) or spec["normalizer"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("the file's merges or added tokens are not of the plain kind that this encoder takes")
        ranks = {bytes(of[c] for c in t): i for t, i in vocab.items() if t not in added}
        self.codec = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.bytes: list[bytes] = [b""] * (max([*ranks.values(), *added.values()]) + 1)
        for t, i in ranks.items():
            self.bytes[i] = t
        for t, i in added.items():
            self.bytes[i] = t.encode()
        self.size = np.array([len(t) for t in self.bytes], dtype=np.int64)
        self.digits = [str(i) for i in range(len(self.bytes))]
        #: An added token with white space could cross the places where encodings are joined.
        self.joinable = not any(re.search(r"\s", t) for t in added)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; an added token's string becomes its id."""
        if self.added is not None and self.added.search(text):
            return self.codec.encode(text, allowed_special="all")
        return self.codec.encode_ordinary(text)

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    """The encoder of a tokenizer file, read once in a process."""
    return ByteBpe(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
