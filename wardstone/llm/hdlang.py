"""Language identification with hyperdimensional profiles.

Every letter owns a random vector of +1 and -1, drawn from its code point. A
letter n-gram is the element-wise product of its letters' vectors, each rotated
by its place in the n-gram; a document is the sum of its n-grams, and a language
the sum of its documents' unit vectors, less what all languages share. A
document takes the language with the largest cosine.

Letters are lower-cased; every run of other characters is one word boundary,
which has a vector of its own. Defined results: a text that is null or has no
letter is ``und`` with score 0. Ties go to the language that sorts first. Rows
with a null language teach nothing. Without any language to learn from, every
row is ``und``. Repeated rows count as often as they occur; columns other than
id, text and language are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.llm.common import batch_of, map_batches, slices

DIMENSIONS = 1024
GRAM = 3
#: Prototypes are sent to every task, so their number is checked.
MAX_LANGUAGES = 4096
_SLICE = 1 << 19
_OUT = "doc_id long, lang_pred string, score double"
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=65536)
def letter_vector(code: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng([20, code]).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1


def _symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts, single 0s for boundaries (one at either end), and each one's document."""
    joined = [f" {(t or '').lower()} ".encode("utf-32-le", "surrogatepass") for t in texts]
    size = np.array([len(b) // 4 for b in joined], np.int64)
    code = np.frombuffer(b"".join(joined), np.uint32)
    docs = np.repeat(np.arange(len(texts)), size)
    letter = _letters()[code]
    stay = letter.copy()
    stay[1:] |= letter[:-1]
    stay[np.cumsum(size) - size] = True  # a text's first boundary
    return np.where(letter, code, 0)[stay].astype(np.int64), docs[stay]


def _ranks(keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and each key's place among them; by a table where the keys are small."""
    if most > 1 << 21:
        return np.unique(keys, return_inverse=True)
    seen = np.zeros(most, bool)
    seen[keys] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[keys]


def document_vectors(texts: list[str | None], dimensions: int = DIMENSIONS, gram: int = GRAM) -> np.ndarray:
    """One row per text: the sum of its n-gram vectors; all zero without letters."""
    code, docs = _symbols(texts)
    out = np.zeros((len(texts), dimensions), np.float32)
    n = len(code) - gram + 1
    if n <= 0:
        return out
    alphabet, rank = _ranks(code, int(code.max()) + 1)
    key = np.zeros(n, np.int64)
    for k in range(gram):
        key = key * len(alphabet) + rank[k : k + n]
    inside = docs[:n] == docs[gram - 1 :]
    inside &= (code[:n] != 0) | (code[gram - 1 :] != 0) | (code[1 : n + 1] != 0)
    if not inside.any():
        return out
    grams, column = _ranks(key[inside], len(alphabet) ** gram)
    counts = np.bincount(docs[:n][inside] * len(grams) + column, minlength=len(texts) * len(grams)).reshape(len(texts), len(grams)).astype(np.float32)
    vectors = np.stack([letter_vector(int(c), dimensions) for c in alphabet])
    profile = np.ones((len(grams), dimensions), np.int8)
    rest = grams
    for k in range(gram - 1, -1, -1):
        profile *= np.roll(vectors, gram - 1 - k, axis=1)[rest % len(alphabet)]
        rest = rest // len(alphabet)
    return counts @ profile.astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=-1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


@dataclass(frozen=True)
class Prototypes:
    languages: list[str]
    vectors: np.ndarray  # unit rows
    shared: np.ndarray
    dimensions: int
    gram: int

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        raw = document_vectors(texts, self.dimensions, self.gram).astype(np.float64)
        known = np.abs(raw).sum(axis=1) > 0
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cosine = _unit(_unit(raw) - self.shared) @ self.vectors.T
        best = cosine.argmax(axis=1)
        score = np.clip((cosine[np.arange(len(texts)), best] + 1) / 2, 0, 1)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, score, 0.0)


def learn(documents: DataFrame, dimensions: int = DIMENSIONS, gram: int = GRAM) -> Prototypes:
    """Bundle the rows' unit vectors by ``lang``; tasks hand on one partial sum per language."""
    ddl = "lang string, cell int, total double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, most_bytes=_SLICE):
                unit = _unit(document_vectors(part.column("text").to_pylist(), dimensions, gram))
                for lang, row in zip(part.column("lang").to_pylist(), unit):
                    sums[lang] = sums[lang] + row if lang in sums else row.astype(np.float64)
        for lang, total in sums.items():
            yield batch_of(ddl, [lang] * dimensions, np.arange(dimensions), total)

    rows = documents.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null")
    sums = rows.mapInArrow(run, ddl).groupBy("lang", "cell").agg(F.sum("total").alias("total"))
    packed = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("cell", "total"))).alias("cells"))
    found = packed.select("lang", F.col("cells.total").alias("total")).limit(MAX_LANGUAGES + 1).toPandas()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    found = found.sort_values("lang")
    if found.empty:
        return Prototypes([], np.zeros((0, dimensions)), np.zeros(dimensions), dimensions, gram)
    unit = _unit(np.stack([np.asarray(t, float) for t in found["total"]]))
    shared = unit.mean(axis=0) if len(unit) > 1 else np.zeros(dimensions)
    return Prototypes(found["lang"].tolist(), _unit(unit - shared), shared, dimensions, gram)


def identify(documents: DataFrame, model: Prototypes) -> DataFrame:
    """doc_id, lang_pred and score of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [model.predict(p.column("text").to_pylist()) for p in slices(batch, most_bytes=_SLICE)]
        return batch_of(_OUT, batch.column("doc_id"), [x for f in found for x in f[0]], np.concatenate([f[1] for f in found]))

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, _OUT)
