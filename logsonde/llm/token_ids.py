"""Ids of whole texts by a tokenizer of the `tokenizers` library, with a bounded memory of words."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import islice

import numpy as np

#: Texts of these characters alone are the same after NFC, have one lower case in any library, and their letters
#: and digits are told apart alike by the pattern below and by the tokenizer's own.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡«»¿À-ÖØ-öø-įĲ-ňŊ-ž]*")

#: The word pattern of `word_bpe_49k.json`, written with Python's classes, for plain texts.
PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")

#: Words, and pre-tokens, remembered by one worker; a full memory forgets all but those it met first, the frequent ones
#: among them: this bounds its size, not its results.
REMEMBERED = 1 << 19
LONGEST = 100  # letters of a remembered word


class Memory(dict):
    """Values by key, made by `make` when first asked for."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(key) <= LONGEST:
            self[key] = value
        return value

    def bounded(self) -> None:
        if len(self) > REMEMBERED:
            kept = list(islice(self.items(), REMEMBERED // 2))
            self.clear()
            self.update(kept)


def byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones stay, the rest follow 256."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    """The pattern that splits texts for the byte-level vocabularies."""
    import public_tokenizers

    return public_tokenizers.PATTERN


class TokenIds:
    """Ids of texts, equal to `Tokenizer.encode(text, add_special_tokens=False).ids`.

    `word_bpe_49k.json` drops white space and never merges across pre-tokens. So a plain text without special
    tokens is split here, and the library's model sees each distinct pre-token once while it is remembered.
    All other texts, and all texts of other tokenizers, go through the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.by_word = os.path.basename(path) == "word_bpe_49k.json"
        self.letters = byte_letters()
        self.by_chunk, self.by_token = Memory(self._chunk), Memory(self._token)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()

    def _token(self, token: str) -> bytes:
        if token.isascii():
            spelled = token
        else:
            spelled = "".join([self.letters[b] for b in token.encode()])
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelled)])

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self.by_token[chunk]
        if chunk[-1] in ".," and chunk[:-1].isalpha():
            return self.by_token[chunk[:-1]] + self.by_token[chunk[-1]]
        return b"".join(map(self.by_token.__getitem__, PRE_TOKEN.findall(chunk)))

    def forget(self) -> None:
        """Gives the memory of words back, so that a worker that goes on with other tasks does not hold it."""
        self.by_chunk.clear()
        self.by_token.clear()

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids of a text; a null text is empty."""
        if not text:
            return b""
        if not self.by_word or "<|" in text or not PLAIN.fullmatch(text):
            return self._whole(text)
        self.by_chunk.bounded()
        self.by_token.bounded()
        return b"".join(map(self.by_chunk.__getitem__, text.lower().split()))


@lru_cache(maxsize=2)
def token_ids(path: str) -> TokenIds:
    """One encoder for each worker and vocabulary."""
    return TokenIds(path)
