"""Token counts of whole texts by a piece model, in Arrow batches that give back lengths only.

Text is cut where the model can never join: between two characters that stand
side by side in no piece of its vocabulary. A word after a single space is such
a stretch (no piece goes on past its end into a space), so each batch is cut
into words, its distinct words are encoded once, and lengths are added up per
text. Texts whose spaces are not plain word ends are encoded whole, or, beyond
``most_chars``, in stretches that end at such safe places.

A stretch without any safe place (one letter a million times) is cut at a token
end instead, and the cut is checked: a row of tokens of which every two
neighbours, encoded by themselves, give just those two is the encoding of the
whole. When no cut of a window passes, the window grows. So counts are exact
and a call of the library sees a bounded text in any but contrived cases.

Batches are cut by bytes of text, and calls of the library as well.

Defined results: a null text counts as an empty one, with no bytes and no
tokens. Repeated rows are counted each, null ids stay null, and an empty table
gives no rows. Extra columns are ignored, whatever their names. Strings that
look like special tokens are ordinary text, as the library takes them. One text
is held by one task, at some ten times its bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from wardstone.llm.common import batch_of, slices

#: Characters of one text that a call of the library sees, and bytes of all texts of a call.
MOST_CHARS = 1 << 16
CALL_BYTES = 1 << 20
_SPACE = "▁"
#: Starts every stretch but the first; no piece holds it together with another character.
_GUARD = "\n"


class PieceCounter:
    def __init__(self, path: str, most_chars: int = MOST_CHARS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.most_chars = most_chars
        size = self.model.get_piece_size()
        plain = [i for i in range(size) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        pieces = [self.model.id_to_piece(i) for i in plain]
        self.joined = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.guard = self.model.encode(_GUARD)
        if any(len(p) > 1 and _GUARD in p for p in pieces) or any(p[0] != _SPACE and p[1] == _SPACE for p in self.joined):
            raise ValueError("this vocabulary has pieces across line or word ends")

    def safe(self, text: str, at: int) -> bool:
        """No piece covers both characters around this place."""
        return text[at - 1 : at + 1].replace(" ", _SPACE) not in self.joined

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Tokens of each string, encoded whole, in calls of bounded size."""
        out, call, size = [], [], 0
        for text in texts:
            if call and size + len(text) > CALL_BYTES:
                out += map(len, self.model.encode(call, num_threads=1))
                call, size = [], 0
            call.append(text)
            size += len(text)
        if call:
            out += map(len, self.model.encode(call, num_threads=1))
        return np.array(out, np.int64)

    def stretches(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Stretches of a long text, each with its number of tokens where the search for a cut has found it already."""
        at = 0
        while len(text) - at > self.most_chars:
            cut = next((i for i in range(at + self.most_chars, at, -1) if self.safe(text, i)), None)
            known = None
            if cut is None:
                cut, known = self._checked_cut(text, at)
            yield self._opened(text, at, cut), known
            at = cut
        yield self._opened(text, at, len(text)), None

    @staticmethod
    def _opened(text: str, at: int, end: int) -> str:
        return _GUARD + text[at:end] if at else text[:end]

    def _checked_cut(self, text: str, at: int) -> tuple[int, int | None]:
        """The end of a token of this window that the next window's first token follows in the whole text, too."""
        width = self.most_chars
        lead = len(self.guard) if at else 0
        while at + width < len(text):
            found = self.model.encode_as_offset_mapping(self._opened(text, at, at + width))
            tokens, ends = found["ids"], [end + at - (len(_GUARD) if at else 0) for _, end in found["offsets"]]
            for k in range(len(tokens) - 1, max(lead, len(tokens) - 200) - 1, -1):
                cut = ends[k]
                if cut <= at or k + 1 < len(tokens) and ends[k + 1] == cut:
                    continue
                after = self.model.encode(self._opened(text, cut, min(len(text), cut + width)))[len(self.guard) :]
                last = text[max(at, ends[k - 1] if k else at) : cut]
                first = self.model.id_to_piece(after[0]).replace(_SPACE, " ")
                if not self.model.is_byte(after[0]) and self.model.encode(_GUARD + last + first) == [*self.guard, tokens[k], after[0]]:
                    return cut, k + 1 - lead
            width *= 2
        return len(text), None

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, long ones cut into stretches."""
        parts, owner, extra, total = [], [], len(self.guard), np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if len(text) <= self.most_chars:
                parts.append(text)
                owner.append(i)
                continue
            for n, (stretch, known) in enumerate(self.stretches(text)):
                if known is not None:
                    total[i] += known
                    continue
                total[i] -= extra if n else 0
                parts.append(stretch)
                owner.append(i)
                if len(parts) >= 64 and len(stretch) >= self.most_chars // 2:  # a very long text is worked off as it is cut
                    np.add.at(total, owner, self.lengths(parts))
                    parts, owner = [], []
        np.add.at(total, owner, self.lengths(parts)) if parts else None
        return total

    def count_column(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text of a column; equal words of the column are encoded once."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        loose = pc.match_substring(texts, "  ")
        for odd in (pc.match_substring(texts, _SPACE), pc.starts_with(texts, " "), pc.ends_with(texts, " ")):
            loose = pc.or_(loose, odd)
        total = np.zeros(len(texts), np.int64)
        whole, plain = np.flatnonzero(loose.to_numpy(zero_copy_only=False)), np.flatnonzero(~loose.to_numpy(zero_copy_only=False))
        total[whole] = self.count(texts.take(pa.array(whole)).to_pylist())
        words = pc.split_pattern(texts.take(pa.array(plain)), " ")
        bounds = words.offsets.to_numpy()
        coded = pc.dictionary_encode(words.flatten())
        size = self.count(coded.dictionary.to_pylist())
        done = np.concatenate([[0], np.cumsum(size[coded.indices.to_numpy()])])
        total[plain] = np.diff(done[bounds - bounds[0]])
        return total


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    """The worker's counter for a model file."""
    return PieceCounter(path)


_COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_tokens(documents: DataFrame, path: str, limit: int = 4096, slice_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most_bytes=slice_bytes):
                texts = part.column("text")
                tokens = counter(path).count_column(texts)
                yield batch_of(_COUNTS, part.column("doc_id"), pc.fill_null(pc.binary_length(texts), 0), tokens, tokens > limit)

    rows = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, _COUNTS)
