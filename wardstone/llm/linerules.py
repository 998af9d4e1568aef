"""Line-first cleaning: judge every line, remove the failing ones, reject documents that lose too much.

A line fails when it is navigation (separator signs between short items), when
symbols, shouting or one word over and over make up most of it, when it is
boilerplate, when it repeats an earlier line of its document, or when it is long
and never ends a sentence nor contains one. What stays is the cleaned text. A
document that loses more than ``max_loss`` of its word characters is rejected.

A sentence ends at ``.``, ``!``, ``?`` or an ellipsis before white space, the
line's end or a closing sign, and at any full stop of a script that writes no
space after it. Lines with Thai or Lao letters, scripts without such signs, do
not fail for want of one. Bullets and arrows are separators unless they open the
line; ``»`` and ``›`` are not where they close a quotation of the line.

Defined results: a null text has no words and counts as empty; it is cleaned to
an empty text and fails the word minimum. Repeated rows give repeated results.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.llm.common import batch_of, map_batches
from wardstone.llm.textbytes import ByteView, repeats, signs

_OUT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    "lost_chars long, base_failed boolean, kept boolean, clean_text string"
)
_SYMBOLS = signs(b"#*$%&|<>")
_SEPARATORS = signs(b"|>/~")
_STOPS = signs(b".!?")
_CLOSERS = signs(b"\"')]}*_[")


def _codes(characters: str) -> np.ndarray:
    """The bytes of each character as one number."""
    return np.array([int.from_bytes(c.encode(), "big") for c in characters])


# ---- fixed values: signs of several bytes ----
WIDE_SEPARATORS, QUOTE_ENDS, QUOTE_STARTS = "·•∙‣●▪→▸►▶│¦｜／»›", "»›", "«‹"
WIDE_STOPS, WIDE_CLOSERS, FULL_STOPS = "…‼⁇⁈⁉", "”’“»›", "。！？．｡।॥؟۔։።፧។။།"
_WIDE_SEPARATORS, _QUOTE_ENDS, _QUOTE_STARTS = _codes(WIDE_SEPARATORS), _codes(QUOTE_ENDS), _codes(QUOTE_STARTS)
_WIDE_STOPS, _WIDE_CLOSERS, _FULL_STOPS = _codes(WIDE_STOPS), _codes(WIDE_CLOSERS), _codes(FULL_STOPS)

#: Phrases that mark a line as boilerplate, in lower case.
BOILERPLATE = ["javascript", "cookie policy", "privacy policy", "terms of use", "terms of service", "lorem ipsum",
               "all rights reserved", "sign in to", "subscribe to our"]


@dataclass(frozen=True)
class LineRules:
    """Limits per line, as shares of its words, and per document."""

    separators: float = 0.2  # words that are "|", ">" or the like
    symbols: float = 0.5  # symbol signs per word
    bangs: float = 0.5  # exclamation marks per word, beyond the one a shout needs
    upper: float = 0.7  # letters in upper case, in lines of at least `shout` letters
    shout: int = 20
    again: float = 0.5  # words equal to the word before, in lines of at least `few` words
    few: int = 6
    long_line: int = 25  # words from which a line must end or contain a sentence
    max_loss: float = 0.5
    min_words: int = 50


def failing_lines(view: ByteView, rules: LineRules) -> np.ndarray:
    starts, ends, docs = view.lines
    word_start, word_end, _ = view.words
    line_of = np.searchsorted(starts, word_start, "right") - 1
    n = np.bincount(line_of, minlength=len(starts))
    words = np.maximum(n, 1)
    key = view.hashes(word_start, word_end)
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (line_of[1:] == line_of[:-1])
    data = view.data
    single = (word_end - word_start) == 1
    separator = np.zeros(len(key), bool)
    separator[single] = _SEPARATORS[data[word_start[single]]]
    per_line = lambda flag: np.bincount(line_of, weights=flag, minlength=len(starts))
    at, code = _wide(data)
    bullets = per_line(separator) + _wide_separators(view, at, code, line_of)
    upper = view.counts((data >= 65) & (data <= 90), starts, ends)
    lower = view.counts((data >= 97) & (data <= 122), starts, ends)
    failed = bullets > rules.separators * words
    failed |= view.counts(_SYMBOLS[data], starts, ends) > rules.symbols * words + 1
    failed |= view.counts(data == ord("!"), starts, ends) > rules.bangs * words + 1
    failed |= (upper + lower >= rules.shout) & (upper > rules.upper * (upper + lower))
    failed |= (n >= rules.few) & (per_line(same) > rules.again * words)
    failed |= (n > 0) & repeats(view.hashes(starts, ends), docs)
    failed |= (n >= rules.long_line) & ~_has_sentence(view, at, code)
    return failed & (n > 0)


def _wide(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the characters of two or three bytes, and their bytes as one number."""
    at = np.flatnonzero((data >= 0xC2) & (data < 0xF0))
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    code = (padded[at].astype(np.int64) << 8) | padded[at + 1]
    three = padded[at] >= 0xE0
    code[three] = (code[three] << 8) | padded[at[three] + 2]
    return at, code


def _wide_separators(view: ByteView, at: np.ndarray, code: np.ndarray, line_of: np.ndarray) -> np.ndarray:
    """Per line, the words that are one separator of two or three bytes and stand between items."""
    starts, _, _ = view.lines
    word_start, word_end, _ = view.words
    hit = np.isin(code, _WIDE_SEPARATORS)
    place, sign = at[hit], code[hit]
    word = np.searchsorted(word_start, place, "right") - 1
    alone = (word_start[word] == place) & (word_end[word] == place + np.where(sign > 0xFFFF, 3, 2))
    alone[alone] &= (word[alone] > 0) & (line_of[word[alone]] == line_of[word[alone] - 1])
    line, closing = line_of[word[alone]], np.isin(sign[alone], _QUOTE_ENDS)
    opened = np.searchsorted(starts, at[np.isin(code, _QUOTE_STARTS)], "right") - 1
    count = lambda lines: np.bincount(lines, minlength=len(starts))
    return count(line[~closing]) + np.maximum(count(line[closing]) - count(opened), 0)


def _has_sentence(view: ByteView, at: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Lines that end or contain a sentence, or are of a script that does not mark its end."""
    starts, ends, _ = view.lines
    size = len(view.data)
    closes = np.ones(size + 1, bool)
    closes[:size] = ~view.solid | _CLOSERS[view.data]
    closes[at[np.isin(code, _WIDE_CLOSERS)]] = True
    closes[view.bounds] = True
    found = np.zeros(size, bool)
    stop = np.flatnonzero(_STOPS[view.data])
    found[stop] = closes[stop + 1]
    wide = np.isin(code, _WIDE_STOPS)
    found[at[wide]] = closes[at[wide] + 3]
    found[at[np.isin(code, _FULL_STOPS)]] = True
    found[at[(code >= 0xE0B880) & (code <= 0xE0BBBF)]] = True
    return view.counts(found, starts, ends) > 0


def _boilerplate(view: ByteView) -> np.ndarray:
    """Lines that hold one of the boilerplate phrases."""
    starts, ends, _ = view.lines
    found = np.zeros(len(starts), bool)
    lowered = bytes(view.data).lower()
    for phrase in (p.encode() for p in BOILERPLATE):
        at = lowered.find(phrase)
        while at >= 0:
            line = np.searchsorted(starts, at, "right") - 1
            found[line] |= at + len(phrase) <= ends[line]
            at = lowered.find(phrase, at + 1)
    return found


def _repeat_words(key: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """True for words inside a three-word window that its document holds at least twice."""
    inside = np.zeros(len(key), bool)
    if len(key) < 3:
        return inside
    whole = docs[2:] == docs[:-2]
    at = np.flatnonzero(whole)
    window = (key[at] * np.uint64(0x9E3779B97F4A7C15) + key[at + 1]) * np.uint64(0xC2B2AE3D27D4EB4F) + key[at + 2]
    order = np.lexsort((window, docs[at]))
    w, d = window[order], docs[at][order]
    twin = np.zeros(len(order), bool)
    equal = (w[1:] == w[:-1]) & (d[1:] == d[:-1])
    twin[1:] |= equal
    twin[:-1] |= equal
    hit = at[order[twin]]
    for k in range(3):
        inside[hit + k] = True
    return inside


def clean(documents: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Counts, verdict and cleaned text of every row, in one pass without a shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        view = ByteView(batch.column("text"))
        n_docs = view.docs
        word_start, word_end, word_doc = view.words
        starts, ends, line_doc = view.lines
        bounds = view.bounds
        character = (view.data & 0xC0) != 0x80
        per_doc = lambda mask: view.counts(mask, bounds[:-1], bounds[1:])
        n_words = np.bincount(word_doc, minlength=n_docs)
        word_chars = per_doc(view.solid & character)
        symbols = per_doc(_SYMBOLS[view.data])
        has_word = view.counts(view.solid, starts, ends) > 0
        dup = repeats(view.hashes(starts, ends), line_doc) & has_word
        repeated = np.bincount(word_doc, weights=_repeat_words(view.hashes(word_start, word_end), word_doc), minlength=n_docs).astype(np.int64)
        failed = failing_lines(view, rules) | _boilerplate(view)
        lost = np.bincount(line_doc, weights=failed * view.counts(view.solid & character, starts, ends), minlength=n_docs).astype(np.int64)
        base = (n_words < rules.min_words) | (100 * repeated > 50 * n_words)
        kept = ~base & (lost <= rules.max_loss * word_chars)
        return batch_of(
            _OUT, batch.column("doc_id"), n_words, word_chars, symbols, np.bincount(line_doc, weights=dup, minlength=n_docs).astype(np.int64),
            repeated, lost, base, kept, _cleaned(view, starts, ends, line_doc, ~failed),
        )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, _OUT)


def _cleaned(view: ByteView, starts, ends, line_doc, stays) -> pa.Array:
    """The lines that stay, joined by line breaks again."""
    data = view.data.tobytes()
    offset = np.concatenate([[0], np.cumsum(np.bincount(line_doc, minlength=view.docs))])
    stays_all = np.logical_and.reduceat(stays, offset[:-1]) if view.docs else stays
    out = []
    for i in range(view.docs):
        if stays_all[i]:
            out.append(data[view.bounds[i] : view.bounds[i + 1]])
        else:
            lines = range(offset[i], offset[i + 1])
            out.append(b"\n".join(data[starts[k] : ends[k]] for k in lines if stays[k]))
    return pc.cast(pa.array(out, pa.binary()), pa.string())
