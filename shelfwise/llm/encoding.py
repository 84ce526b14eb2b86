"""Token ids of texts under a public byte-level BPE vocabulary.

The vocabulary file of the ``tokenizers`` library decides the ids.  The same
vocabulary as plain ranks gives equal ids several times faster for ordinary
texts, so it serves those; texts with characters outside the plain Latin range,
with very long unbroken runs or with the string of a special token go to the
``tokenizers`` file itself.  Strings of special tokens in a text are ordinary
text."""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

import numpy as np

VOCABULARY = "byte_bpe_50k"

_UNUSUAL = re.compile("[^\n -~¡-¬®-ɏ]")
_LONG_RUN = re.compile(r"\S{4096}|\s{1024}")
_LONG_TEXT = 20_000


class Encoder:
    """Encodes texts to arrays of unsigned 32-bit ids."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self.full.encode_special_tokens = True
        self.specials = tuple(t.content for t in self.full.get_added_tokens_decoder().values())
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN,
                                       mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if ((not text.isascii() or not text.isprintable()) and _UNUSUAL.search(text)
                or any(s in text for s in self.specials)
                or len(text) > _LONG_TEXT and _LONG_RUN.search(text)):
            return np.asarray(self.full.encode(text, add_special_tokens=False).ids, "<u4")
        return np.frombuffer(array("I", self.plain.encode_ordinary(text)), "<u4")


@lru_cache(maxsize=4)
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(vocabulary)
