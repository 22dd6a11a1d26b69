"""Token ids of whole texts, word by word.

The public word vocabulary drops white space and never joins bytes across it, so a text's
ids are those of its words in turn; a run of ASCII punctuation behind a letter or digit is
a piece of its own. Corpora repeat their words, so a worker keeps the ids of the words and
stems it has met lately, up to fixed numbers, and runs the tokenizer on new stems only. When
a store is full, it is kept beside a new one until that is full too: frequent words stay.
"""

from __future__ import annotations

import os
import sys
import unicodedata
from array import array

VOCABULARY = "word_bpe_49k.json"
KEPT_WORDS = 250_000
KEPT_STEMS = 250_000
PUNCTUATION = b".,;:!?*$%&#|"
# Letters below this code point are single pieces of the vocabulary's word pattern.
PLAIN_LETTERS = "ɐ"


def byte_letters() -> dict[int, str]:
    """The printable stand-ins of a byte-level vocabulary: visible bytes stand for
    themselves, the others for the code points from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in visible)
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def _stays_a_letter(char: str) -> bool:
    """Whether a letter or digit is one still where the tokenizer cuts: normalised and in
    lower case. Some letters become a letter and a mark, which belongs to what follows."""
    return char.isalnum() and unicodedata.normalize("NFC", char) == char and char.lower().isalnum()


class WordIds(dict):
    """Little-endian 32-bit ids by word, for a vocabulary whose words stand alone."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.stems: dict[bytes, bytes] = {}
        self.older_words: dict[bytes, bytes] = {}
        self.older_stems: dict[bytes, bytes] = {}

    def _stem(self, stem: bytes) -> bytes:
        """Words of plain letters are one piece, so they go straight to the merges."""
        found = self.stems.get(stem)
        if found is None:
            found = self.older_stems.get(stem) or self._ids(stem)
            if len(self.stems) >= KEPT_STEMS:
                self.older_stems, self.stems = self.stems, {}
            self.stems[stem] = found
        return found

    def _ids(self, stem: bytes) -> bytes:
        text = stem.decode("utf-8")
        if stem.isalpha() and stem.islower():  # ASCII letters
            ids = [token.id for token in self.model.tokenize(text)]
        else:
            low = text.lower()
            if low.isalpha() and max(text) < PLAIN_LETTERS and unicodedata.is_normalized("NFC", text):
                piece = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
                ids = [token.id for token in self.model.tokenize(piece)]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older_words.get(word)
        if ids is None:
            stem = word.rstrip(PUNCTUATION)
            tail = word[len(stem) :]
            # an ASCII letter or digit stays one
            if tail and not (stem[-1:].isalnum() or stem and _stays_a_letter(stem.decode("utf-8")[-1])):
                stem, tail = word, b""
            ids = self._stem(stem.lower())
            if tail:
                ids += self._stem(tail)
        if len(self) >= KEPT_WORDS:
            self.older_words = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """Ids of a text."""
        return b"".join(map(self.__getitem__, text.split()))


_encoders: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's encoder of a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
