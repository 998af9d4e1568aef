"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's evidence is its own shape and that of its
neighbours; the chain adds how likely a label follows another. Training takes
whole documents whose lines all carry the document's label. A document's score
is the mean of its lines' forward-backward marginals, weighted by line length.

Defined results: a null text is an empty one; an empty text is one empty line
and gets that line's marginal. Repeated rows give repeated results. Columns
other than the id and the text are ignored, whatever their names. Without any
usable label the score is 0.5 for every row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstone.llm.common import batch_of, map_batches, slices, tidied
from wardstone.llm.textbytes import ByteView, repeats, signs
from wardstone.session import materialize

#: Labelled documents that training uses at most; the choice is by a hash of the id.
TRAINING_DOCUMENTS = 4000
#: Lines of all of them together at most; each comes to the driver as some 300 bytes.
TRAINING_LINES = 200_000
_LOCAL = 12
N_FEATURES = 1 + 3 * (_LOCAL - 1) + 2
_SCORES = "doc_id long, score double"


_UPPER = signs(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = signs(b"abcdefghijklmnopqrstuvwxyz")
_DIGIT = signs(b"0123456789")
_SYMBOL = signs(b"#*$%&<>{}[]=\\^~_")
_STOP = signs(b".!?:;\"'")


def line_features(view: ByteView) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x N_FEATURES), document and length of every line of a batch."""
    starts, ends, docs = view.lines
    word_start, word_end, word_doc = view.words
    size = ends - starts
    line_of = np.searchsorted(starts, word_start, "right") - 1
    n_words = np.bincount(line_of, minlength=len(starts))
    word_key = view.hashes(word_start, word_end)
    again = np.zeros(len(word_key), bool)
    again[1:] = (word_key[1:] == word_key[:-1]) & (line_of[1:] == line_of[:-1])
    in_line = np.bincount(line_of, weights=repeats(word_key, line_of), minlength=len(starts))
    data = view.data
    upper, lower = (view.counts(t[data], starts, ends) for t in (_UPPER, _LOWER))
    digit, symbol = (view.counts(t[data], starts, ends) for t in (_DIGIT, _SYMBOL))
    pipe, bang = (view.counts(data == ord(c), starts, ends) for c in "|!")
    last = np.zeros(len(starts), bool)
    if len(word_end):
        final = np.zeros(len(starts), np.int64) - 1
        final[line_of] = word_end - 1
        last = (final >= 0) & _STOP[data[np.maximum(final, 0)]]
    dup = repeats(view.hashes(starts, ends), docs) & (n_words > 0)
    words = np.maximum(n_words, 1)
    own = np.stack(
        [
            np.ones(len(starts)), np.log1p(size) / 5, n_words == 0, upper / np.maximum(upper + lower, 1), np.minimum(symbol / words, 3),
            np.minimum(pipe / words, 2), np.minimum(bang / words, 3), digit / np.maximum(size, 1),
            np.bincount(line_of, weights=again, minlength=len(starts)) / words, in_line / words, last, dup,
        ],
        axis=1,
    ).astype(np.float64)
    shape = own[:, 1:]
    head = np.ones(len(starts), bool)
    head[1:] = docs[1:] != docs[:-1]
    tail = np.roll(head, -1) if len(head) else head
    before, after = np.zeros_like(shape), np.zeros_like(shape)
    before[1:], after[:-1] = shape[:-1], shape[1:]
    before[head], after[tail] = 0, 0
    return np.hstack([own, before, after, head[:, None], tail[:, None]]), docs, size


@dataclass(frozen=True)
class LineCrf:
    """Evidence weights for "good" against "bad" and log potentials of label pairs."""

    weights: np.ndarray
    pairs: np.ndarray

    def marginals(self, features: np.ndarray, docs: np.ndarray, n_docs: int) -> np.ndarray:
        """Probability of "good" for every line; lines of a document stand together."""
        node = np.stack([np.zeros(len(features)), features @ self.weights], axis=1)
        first = np.searchsorted(docs, np.arange(n_docs))
        count = np.bincount(docs, minlength=n_docs)
        return _forward_backward(node, self.pairs, first, count)[0]


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=1, keepdims=True)


def _forward_backward(node, pairs, first, count):
    """Marginals of label 1, the summed pair marginals and the log likelihood part; scaled, all chains step by step together."""
    potential = np.exp(node - node.max(axis=1, keepdims=True))
    step = np.exp(pairs - pairs.max())
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    ahead, back = np.empty_like(node), np.ones_like(node)
    longest = int(count[0]) if len(count) else 0
    active = [int(np.searchsorted(-count, -t, "left")) for t in range(longest)]  # chains with more than t lines
    for t, n in enumerate(active):
        at = first[:n] + t
        ahead[at] = _normal(potential[at] * (ahead[at - 1] @ step if t else 1))
    edges = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        incoming = potential[at + 1] * back[at + 1]
        back[at] = _normal(incoming @ step.T)
        joint = ahead[at][:, :, None] * step[None] * incoming[:, None, :]
        edges += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return _normal(ahead * back)[:, 1], edges


def fit(features: np.ndarray, docs: np.ndarray, labels: np.ndarray, rounds: int = 250, penalty: float = 1.0) -> LineCrf:
    """Penalised maximum likelihood by Adam steps; all lines of document i have label ``labels[i]``."""
    first, count = np.searchsorted(docs, np.arange(len(labels))), np.bincount(docs, minlength=len(labels))
    scale = max(1, len(docs))
    truth = labels[docs].astype(float)
    seen_pairs = np.zeros((2, 2))
    for label in (0, 1):
        seen_pairs[label, label] = np.maximum(count[labels == label] - 1, 0).sum()
    theta = np.zeros(features.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, rounds + 1):
        weights, pairs = theta[:-4], theta[-4:].reshape(2, 2)
        node = np.stack([np.zeros(len(features)), features @ weights], axis=1)
        good, edges = _forward_backward(node, pairs, first, count)
        gradient = np.concatenate([features.T @ (truth - good), (seen_pairs - edges).ravel()]) - penalty * theta
        gradient /= scale
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.2 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)
    return LineCrf(theta[:-4], theta[-4:].reshape(2, 2))


def train(documents: DataFrame, labels: DataFrame, most: int = TRAINING_DOCUMENTS, most_lines: int = TRAINING_LINES) -> LineCrf | None:
    """Fit on at most ``most`` labelled documents of together at most ``most_lines`` lines, chosen by a hash of the id.

    ``labels`` has doc_id and label (0 or 1). Null ids or labels, and ids with
    two different labels, are left out; so are, from this sample alone, documents
    with over a tenth of ``most_lines``. Of rows that share an id one takes part.
    Whole documents are taken in the order of the hash while their lines fit.
    Only line features of the chosen documents come to the driver.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("label").cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
        .groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_high"))
        .where(F.col("_label") == F.col("_high")).drop("_high")
    )
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(most)
    texts = documents.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    lines = (F.length(F.col("text")) - F.length(F.replace(F.col("text"), F.lit("\n"))) + 1).alias("_lines")
    own = texts.join(F.broadcast(chosen), "_id").select("_id", "_label", "text", F.coalesce(lines, F.lit(1)).alias("_lines"))
    single = own.where(F.col("_lines") <= most_lines // 10).groupBy("_id", "_label").agg(F.min_by(F.struct("text", "_lines"), F.xxhash64("text")).alias("_one"))
    single = materialize(single.select("_id", "_label", "_one.*"), "training-texts")
    upto = F.sum("_lines").over(Window.orderBy(F.xxhash64("_id"), "_id"))  # of ``most`` rows at most
    fitting = single.select("_id", upto.alias("_upto")).where(F.col("_upto") <= most_lines).select("_id")
    ddl = "id long, label int, lines int, x array<double>"

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, docs, _ = line_features(ByteView(batch.column("text")))
        count = np.bincount(docs, minlength=batch.num_rows)
        edge = np.concatenate([[0], np.cumsum(count)]) * N_FEATURES
        flat = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(x.ravel()))
        return batch_of(ddl, batch.column("_id"), batch.column("_label"), count, flat)

    rows = map_batches(single.join(F.broadcast(fitting), "_id", "left_semi").select("_id", "_label", "text"), encode, ddl).toPandas()
    if rows.empty or rows["label"].nunique() < 2:
        return None
    rows = rows.sort_values("id")  # the fit does not depend on the order of arrival
    x = np.concatenate(list(rows["x"])).reshape(-1, N_FEATURES)
    return fit(x, np.repeat(np.arange(len(rows)), rows["lines"]), rows["label"].to_numpy())


def score(documents: DataFrame, model: LineCrf | None) -> DataFrame:
    """doc_id and score (0 to 1, higher is better) of every row, in one pass without a shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if model is None:
            return batch_of(_SCORES, batch.column("doc_id"), np.full(batch.num_rows, 0.5))
        return batch_of(_SCORES, batch.column("doc_id"), document_scores(model, batch.column("text")))

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, _SCORES)


def document_scores(model: LineCrf, texts: pa.Array) -> np.ndarray:
    view = ByteView(texts)
    x, docs, size = line_features(view)
    good = model.marginals(x, docs, view.docs)
    total = np.bincount(docs, weights=size, minlength=view.docs)
    weight = np.where(total[docs] > 0, size, 1)
    return np.clip(np.bincount(docs, weights=good * weight, minlength=view.docs) / np.bincount(docs, weights=weight, minlength=view.docs), 0, 1)


def keep(documents: DataFrame, model: LineCrf | None, least: float) -> DataFrame:
    """The rows whose text scores ``least`` or more, columns as they were."""

    def run(batches):
        for batch in batches:
            if model is None or not batch.num_rows:
                yield batch
                continue
            good = np.concatenate([document_scores(model, p.column("text")) for p in slices(batch)])
            yield batch.filter(pa.array(good >= least))

    return documents.mapInArrow(tidied(run), documents.schema)

