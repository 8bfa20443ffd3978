"""Token ids of a public byte-level BPE vocabulary."""

from __future__ import annotations

import functools
import json

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: Default vocabulary; a path is a parameter wherever tokens are made.
VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids as the tokenizers library gives them for this file, special tokens in texts included.

    The same merges run several times faster as ranks; the library itself encodes texts that hold a
    special token's string, and any that the faster way refuses.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def exact(self) -> Tokenizer:
        """The library itself, loaded where it is needed."""
        return Tokenizer.from_file(self.path)

    def ids(self, text: str | None) -> np.ndarray:
        text = text or ""
        if not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except BaseException as error:  # a panic of the native code isn't an Exception
                if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)
