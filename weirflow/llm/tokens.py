"""Token ids of whole texts by a public tokenizer file, with a cache of words.

A byte-level tokenizer splits a text before every space that is followed by another character than white
space, and never merges across such a place. So words are encoded once per task, with the space before them,
and looked up afterwards. A text with any other white space than single spaces and single line ends between
words is encoded whole, and so is one that holds the string of a special token, and every text where the
tokenizer is not byte-level.
"""

from __future__ import annotations

import os
import string

import numpy as np

from weirflow.llm.common import held

ID_BYTES = 4
#: Bytes that a generation of cached words may take, and what a word takes beside its text and ids. There are two generations.
GENERATION_BYTES, WORD_BYTES = 96 << 20, 200


class _Words(dict):
    """The ids of words that stand behind ``before``, learned as they are asked for, or known from the older generation."""

    def __init__(self, of: Encoder, before: str):
        self.of, self.before, self.prefix = of, before, of.written(before)
        self.older: dict[str, bytes] = {}

    def age(self) -> None:
        """This generation becomes the older one, which is forgotten."""
        self.older = dict(self)
        self.clear()

    def __missing__(self, word: str) -> bytes:
        of = self.of
        if (ids := self.older.get(word)) is not None:
            pass
        elif word[:1] == "\n":  # a piece of its own, and the word behind it has no space before it
            ids = of.line_end + of.first[word[1:]]
        elif word.isalpha():  # one piece: the model takes it without a search for pieces
            ids = of.piece(self.prefix + word if word.isascii() else of.written(self.before + word))
        elif (head := word.rstrip(string.punctuation)).isalpha():  # marks between a letter and white space are one piece
            ids = self[head] + of.first[word[len(head) :]]
        else:
            ids = of.plain([self.before + word])[0]
        self[word] = ids
        of.held += len(word) + len(ids) + WORD_BYTES
        return ids


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, generation_bytes: int = GENERATION_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        splits = self.tokenizer.pre_tokenizer
        self.by_word = self.tokenizer.normalizer is None and isinstance(splits, ByteLevel) and not splits.add_prefix_space
        self.model = self.tokenizer.model
        self.character = _byte_characters()
        self.id_bytes = [k.to_bytes(ID_BYTES, "little") for k in range(self.tokenizer.get_vocab_size())]
        self.line_end = self.plain(["\n"])[0]
        self.first, self.later, self.held = _Words(self, ""), _Words(self, " "), 0
        self.generation_bytes = generation_bytes

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; none for a null or empty text."""
        if self.held > self.generation_bytes:
            self.first.age()
            self.later.age()
            self.held = 0
        return [self._encode(text) if text else b"" for text in texts]

    def _encode(self, text: str) -> bytes:
        words = text.split()
        between = " ".join(words) == text.replace("\n", " ")  # nothing but single spaces and line ends
        if not (self.by_word and between) or any(token in text for token in self.special):
            return self.plain([text])[0]
        if "\n" in text:
            words = text.replace("\n", " \n").split(" ")
        return self.first[words[0]] + b"".join(map(self.later.__getitem__, words[1:]))

    def plain(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def written(self, piece: str) -> str:
        """The piece as byte-level vocabularies write it; ASCII letters stay what they are."""
        return piece.encode().decode("latin-1").translate(self.character)

    def piece(self, written: str) -> bytes:
        id_bytes = self.id_bytes
        return b"".join([id_bytes[t.id] for t in self.model.tokenize(written)])


def _byte_characters() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes with: bytes that print, then the others from 256 on."""
    printed = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    others = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + k) for k, b in enumerate(others)}


def encoder(path: str, generation_bytes: int = GENERATION_BYTES) -> Encoder:
    """The encoder of this Python process."""
    return held((Encoder, path, generation_bytes), lambda: Encoder(path, generation_bytes))
