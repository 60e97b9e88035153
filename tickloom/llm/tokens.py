"""Token ids of whole texts.

The rank file holds the same vocabulary as the ``.json`` file and gives the same ids about four
times as fast, so it does the work; a text with the string of a special token goes through the
``.json`` file, which alone knows it. Tests hold both against each other.
"""

from __future__ import annotations

import base64
from array import array

import numpy as np


class Encoder:
    """Encodes by the vocabulary file ``name`` (``.json``) and its rank file (``.tiktoken``)."""

    def __init__(self, name: str = "byte_bpe_50k.json"):
        import public_tokenizers
        import tiktoken
        with open(public_tokenizers.path(name.replace(".json", ".tiktoken")), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._plain = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._path, self._whole = public_tokenizers.path(name), None

    def _by_file(self, text: str) -> list[int]:
        """By the ``.json`` file, which is only loaded when a text asks for it."""
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self._path)
        return self._whole.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> np.ndarray:
        if "<|" in text:
            encoded = self._by_file(text)
        else:
            encoded = self._plain(text)
        return np.frombuffer(array("I", encoded), np.uint32)
