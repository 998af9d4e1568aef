"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker.

The text is cut at ASCII white space, where the tokenizer's own splitting always
cuts too. A word that is plain Latin letters and digits followed by ASCII signs
is cut once more before the signs, and its case folded, as the tokenizer does
anyway; all other words go to the tokenizer as they are.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wardstone.llm.common import release_memory

_SIGNS = ".,;:!?|#*$%&\"()[]{}=+-_/"
_BEYOND_LATIN = "ɐ"
_DOTTED_I = "İ"
#: Words that one worker remembers; it forgets all of them beyond that.
REMEMBERED = 250_000


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of a vocabulary file that comes with the installed tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """Byte -> the letter that stands for it in a byte-level vocabulary: printable ones themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {"": b""}
        probes = ["the", "running", "xqzvkj", "\u00e9t\u00e9", "stra\u00dfe"]
        self.direct = all(self._model_ids(w) == self._ids(w) for w in probes)

    def _ids(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.uint32).tobytes()

    def _model_ids(self, word: str) -> bytes:
        """Ids of a lower-case word of Latin letters, past the steps that would leave it as it is."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(word)]).tobytes()

    @staticmethod
    def parts(word: str) -> tuple[str, str]:
        """Two strings whose ids, one after the other, are the word's ids."""
        if "<|" in word or not word.isascii() and (max(word) >= _BEYOND_LATIN or _DOTTED_I in word):
            return word, ""
        word = word.lower()
        stem = word.rstrip(_SIGNS)
        if not stem or len(stem) == len(word) or not stem[-1].isalnum():
            return word, ""
        return stem, word[len(stem) :]

    def _stem(self, stem: str) -> bytes:
        found = self.stems.get(stem)
        if found is None:
            latin = self.direct and stem.isalpha() and stem == stem.lower() and max(stem) < _BEYOND_LATIN
            found = self.stems[stem] = self._model_ids(stem) if latin else self._ids(stem)
        return found

    def _word(self, word: str) -> bytes:
        stem, signs = self.parts(word)
        found = self.words[word] = self._stem(stem) + self._stem(signs) if signs else self._stem(stem)
        return found

    def forget(self) -> None:
        """Give back the memory of remembered words; a task does so at its end, as workers outlive stages."""
        self.words, self.stems = {}, {"": b""}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) of the texts one after the other, and where each text's ids begin and end."""
        if len(self.words) > REMEMBERED or len(self.stems) > REMEMBERED:
            self.forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        words = pc.ascii_split_whitespace(texts)
        bounds = words.offsets.to_numpy()
        coded = pc.dictionary_encode(words.flatten())
        known, new = self.words.get, self._word
        encoded = [known(w) or new(w) for w in coded.dictionary.to_pylist()]
        size = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        flat = np.frombuffer(b"".join(encoded), np.uint32)
        begin = np.cumsum(size) - size
        index = coded.indices.to_numpy()
        n = size[index]
        done = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(begin[index] - done[:-1], n) + np.arange(done[-1])]
        return ids, done[bounds - bounds[0]]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file; it lives as long as the worker does."""
    return WordEncoder(path)


def forgetful(path: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The Arrow function, with the worker's remembered words given back at the end of each task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            if encoder.cache_info().currsize:
                encoder(path).forget()
            release_memory()

    return task
