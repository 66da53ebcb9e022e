"""Token ids of texts by a public tokenizer file, remembered by word."""

from __future__ import annotations

import os
import re

import numpy as np

from tallyhouse.llm.common import memory

#: White space on which Python and the tokenizers may differ; texts with it are split at plain white space only.
_ODD = [*map(chr, (0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))]
_PLAIN_SPACE = re.compile("[ \t\n\r]+")
#: A word of Latin letters and at most one mark behind it: its ids are those of its lower-case letters, then the mark's.
_LATIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Words(dict):
    """Ids of words as bytes; unknown ones are encoded when asked for."""

    def __init__(self, tokenizer, dtype, remember: int):
        from tokenizers import pre_tokenizers

        self.tokenizer, self.dtype, self.remember = tokenizer, dtype, remember
        self.model = tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
        self.bytes_of = str.maketrans({x: level.pre_tokenize_str(x)[0][0] for x in letters})

    def __missing__(self, word: str) -> bytes:
        if (m := _LATIN.fullmatch(word)) is None:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        elif m[2] or not word.islower():
            found = self[m[1].lower()] + (self[m[2]] if m[2] else b"")
            if len(self) < self.remember:
                self[word] = found
            return found
        else:
            ids = [t.id for t in self.model.tokenize(word.translate(self.bytes_of))]
        found = np.array(ids, self.dtype).tobytes()
        if len(self) < self.remember:
            self[word] = found
        return found


class Encoder:
    """Ids of whole texts, equal to those of the tokenizer on the text.

    This tokenizer's pieces never hold white space, so a text's ids are the ids of its words in order. Words are
    encoded once and remembered, up to `remember` of them (some 200 bytes each); rarer ones are encoded again.
    """

    def __init__(self, path: str, remember: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known = _Words(self.tokenizer, self.dtype, remember)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        out, of = [], self.known.__getitem__
        for text in texts:
            parts = filter(None, _PLAIN_SPACE.split(text)) if any(x in text for x in _ODD) else text.split()
            out.append(np.frombuffer(b"".join(map(of, parts)), self.dtype))
        return out


def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return memory(Encoder, path)
