"""Token ids of whole texts by a word-level BPE tokenizer file, exact and with a word cache.

The tokenizer drops white space and never merges across it, so a text's ids are those of its
blank-separated chunks in order. Chunks repeat; the ids of those met lately are kept. A chunk that is one word of
letters below U+0250, perhaps with punctuation behind it, needs neither Unicode normalisation
nor the splitting pattern: its lower-case word goes straight to the BPE model. All other chunks
go through the whole tokenizer.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer, pre_tokenizers

from arealis.llm.common import Recent

#: Punctuation that forms one piece by itself behind a word; the apostrophe starts contractions.
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    return public_tokenizers.path(name)


class _Chunks(Recent):
    def __init__(self, path: str):
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(i) for i in range(0x250) if chr(i).isalpha()]
        self.spelt = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in letters})

    def encode(self, chunk: str) -> bytes:
        return np.array(self.whole.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def made(self, chunk: str) -> bytes:
        low = chunk.lower()
        word = low.rstrip(TAIL)
        if not (word.isalpha() and max(word) < "ɐ"):
            return self.encode(chunk)
        if word == chunk:
            spelt = word if word.isascii() else word.translate(self.spelt)
            return np.array([t.id for t in self.whole.model.tokenize(spelt)], "<u4").tobytes()
        tail = low[len(word) :]
        return self[word] + self[tail] if tail else self[word]


class WordBpe:
    """``ids(text)``: little-endian unsigned 32-bit ids, without special tokens. What is kept can be forgotten."""

    _made: dict[str, WordBpe] = {}

    def __init__(self, path: str):
        self.chunks = _Chunks(path)

    @classmethod
    def of(cls, path: str) -> WordBpe:
        """One tokenizer for each worker process."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))

    def forget(self) -> None:
        self.chunks.forget()
