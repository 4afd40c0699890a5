"""Token ids of whole texts with a public tokenizer of the ``tokenizers`` library."""

from __future__ import annotations

import sys
from types import ModuleType

import numpy as np
import pyarrow as pa

#: Words whose ids a worker process keeps at hand, in two halves: when the newer is full, the
#: older is given up, so words that come back often stay.
WORDS_KEPT = 800_000
#: Trailing marks that this tokenizer always splits from letters.  The apostrophe (contractions)
#: and the signs in names of special tokens are left out.
MARKS = ".,;:!?*&$%#@\"()"


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """Encodes texts for a tokenizer that drops white space and never joins text across it.

    For such a tokenizer the ids of a text are those of its pieces between spaces, one after
    another, so each piece is encoded by the library once and looked up afterwards (this is the
    store).  Letters followed by marks are two pieces; pieces of lower-case Latin letters go
    straight to the library's model, which is what its normaliser and splitter leave of them.
    ``tests/llm`` holds this against the library's ids of whole texts.
    """

    def __init__(self, path: str, dtype: str = "<u4"):
        from tokenizers import Tokenizer

        super().__init__()
        self._older: dict[str, bytes] = {}
        self._library = Tokenizer.from_file(path)
        self._model, self._letters, self._dtype = self._library.model, _byte_letters(), dtype

    def __missing__(self, word: str) -> bytes:
        core = word.rstrip(MARKS)
        # İ is no plain letter here: in lower case it is an i and a mark, which joins the marks after it
        if core != word and core.isalpha() and max(core) < "ɐ" and "İ" not in core:
            return self[core] + self[word[len(core):]]  # not stored: few words come with the same marks often
        if 2 * len(self) >= WORDS_KEPT:
            self._older = dict(self)
            self.clear()
        ids = self._older.get(word)
        if ids is None:
            ids = self._encoded(word)
        self[word] = ids
        return ids

    def _encoded(self, word: str) -> bytes:
        if word.isalpha() and max(word) <= "ÿ":
            low = word.lower()
            if low != word:
                return self[low]
            pieces = self._model.tokenize(word.encode().decode("latin-1").translate(self._letters))
            return np.array([p.id for p in pieces], dtype=self._dtype).tobytes()
        return np.array(self._library.encode(word, add_special_tokens=False).ids, dtype=self._dtype).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian integers; a null text has none."""
        if not text:
            return b""
        # lower case as the library's normaliser has it; names of special tokens are matched before it
        if "<|" not in text and (text.isascii() or len(text.encode("latin-1", "ignore")) == len(text)):
            text = text.lower()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def word_ids(path: str, dtype: str = "<u4") -> WordIds:
    """The store of this worker process, which its later tasks find filled."""
    kept = sys.modules.setdefault("accolade_worker_words", ModuleType("accolade_worker_words"))
    stores = kept.__dict__.setdefault("stores", {})
    if (path, dtype) not in stores:
        stores[path, dtype] = WordIds(path, dtype)
    return stores[path, dtype]


def texts_of(column: pa.Array) -> list[str | None]:
    return column.to_pylist()
