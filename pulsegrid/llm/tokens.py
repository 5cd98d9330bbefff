"""Token ids of whole texts with a public tokenizer, cached word by word inside a task.

The vocabulary ``word_bpe_49k.json`` drops white space and never joins across
it, so a text's ids are the ids of its white-space separated words in a row.
``tests/llm`` compares the result with the tokenizer's own on whole texts.
"""

from __future__ import annotations

import os
import string
from array import array

from pulsegrid.llm.common import BoundedMap, worker_state

DEFAULT_VOCABULARY = "word_bpe_49k.json"
LONG_WORD = 64            # longer words are encoded without being kept
_ENDS = string.punctuation.replace("'", "").encode()   # a run of these is one pre-token
_LATIN = "\u00ff"         # up to here a text is its own NFC form and lower-cases letter by letter
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
# byte-level BPE writes a printable byte as itself, the k-th other byte as chr(256 + k)
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


class WordEncoder:
    """``encode(raw bytes) -> little-endian unsigned 32-bit ids`` of one whole text."""

    def __init__(self, name: str, limit: int = 420_000):   # entries of a generation; two are held
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # one thread a task
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary_path(name))
        self.model = self.tokenizer.model
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = BoundedMap(self._word, limit)
        self.short = BoundedMap(self._ids, limit // 4)

    def _ids(self, raw: bytes) -> bytes:
        ids = self.tokenizer.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():                        # lower-case ASCII letters: one pre-token as it stands
            return array("I", [t.id for t in self.model.tokenize(word.decode("ascii"))]).tobytes()
        # letters followed by marks are two pre-tokens, so their ids are joined
        base = word.rstrip(_ENDS)
        text = base.decode("utf-8", "replace")
        if not text.isalpha() or max(text) > _LATIN:
            return self._ids(word)
        if len(base) < len(word):
            return self.words[base] + self.short[word[len(base):]]
        letters = text.lower().encode().decode("latin-1").translate(_BYTE_CHARS)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def encode(self, raw: bytes | None) -> bytes:
        if not raw:
            return b""
        if any(s in raw for s in self.special):   # control tokens are matched before any lower-casing
            return self._ids(raw)
        words = raw.lower().split()
        if max(map(len, words), default=0) <= LONG_WORD:
            return b"".join(map(self.words.__getitem__, words))
        return b"".join([self.words[w] if len(w) <= LONG_WORD else self._ids(w) for w in words])


def encoder(name: str = DEFAULT_VOCABULARY) -> WordEncoder:
    """The worker's encoder for a vocabulary (loaded once per Python worker)."""
    known = worker_state().__dict__.setdefault("encoders", {})
    if name not in known:
        known[name] = WordEncoder(name)
    return known[name]


def sentence_end_ids(name: str = DEFAULT_VOCABULARY):
    """Boolean lookup by id: tokens of punctuation alone that close a sentence."""
    import json

    import numpy as np
    with open(vocabulary_path(name), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    flags = np.zeros(max(vocab.values()) + 1, bool)
    for token, i in vocab.items():
        core = token.removesuffix("</w>")
        if core and core != token and core[-1] in ".!?" and not any(c.isalnum() for c in core):
            flags[i] = True
    return flags
