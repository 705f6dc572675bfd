"""Shared pieces of the labelled-table classifiers: bounded samples, vocabulary, softmax regression.

A classifier is fitted on a sample of at most about ``PER_CLASS`` labelled rows a
class, chosen by a hash of doc_id at a rate set from the class's count over the
whole labels table.  The sample is the only thing a fit gathers; scoring covers
every row where it is read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import bounded_count
from ..session import materialize

PER_CLASS = 3_000
VOCABULARY = 768
MIN_DOCS = 4
BROADCAST_LABELS = 200_000    # labels that are broadcast at most; more of them are joined by a shuffle
HASH_RANGE = 1 << 30

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 6)
MIN_PREFIX = 3                     # every feature name of a word begins with its first letters
SYMBOLS = "#*$%&|<>"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
KNOWN_TOKENS = 300_000
SHAPE = ("symbols", "shouts", "upper", "repeated_lines", "length")


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def names_of(word: str) -> list[str]:
    """Feature names of a word: itself and its beginnings (``abc*``), which inflected forms share."""
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


def shape_of(text: str, raw: bytes, n: int) -> list[float]:
    """Ratios in [0, 1] that do not depend on the words used; ``raw``: the text's bytes, ``n``: its words."""
    n = n or 1
    lines = [x for x in text.split("\n") if x.strip()]
    return [min(1.0, sum(map(text.count, SYMBOLS)) / n), min(1.0, text.count("!!") / n),
            (len(raw) - len(raw.translate(None, UPPER))) / (len(raw) or 1),
            1 - len(set(lines)) / len(lines) if lines else 0.0, min(1.0, n.bit_length() / 16)]


def uniform(col: Column, salt: str) -> Column:
    """A reproducible number in [0, 1) from a hash of ``col``."""
    return F.pmod(F.xxhash64(col, F.lit(salt)), F.lit(HASH_RANGE)) / HASH_RANGE


def labelled_sample(docs: DataFrame, labels: DataFrame, class_col: str, per_class: int = PER_CLASS) -> DataFrame:
    """Materialised ``doc_id, text, y``: about ``per_class`` labelled rows of each class, distinct texts.

    Of several labels of one doc_id the smallest (as text) counts, so the sample does not depend on how
    the rows lie; a text that stands under several doc_ids counts once a class.
    """
    labels = labels.where(F.col("doc_id").isNotNull() & F.col(class_col).isNotNull()).select(
        "doc_id", F.col(class_col).cast("string").alias("y"))
    counts = labels.groupBy("y").count().collect()  # one row a class
    rate = F.lit(0.0)
    for r in counts:
        rate = F.when(F.col("y") == r["y"], F.lit(per_class / r["count"])).otherwise(rate)
    # a doc_id's labels are all within the highest rate's part or all outside it
    highest = max((per_class / r["count"] for r in counts), default=0.0)
    at = uniform(F.col("doc_id"), "sample")
    chosen = materialize(labels.where(at < highest).groupBy("doc_id").agg(F.min("y").alias("y")).where(at < rate),
                         "chosen-labels")
    if bounded_count(chosen, BROADCAST_LABELS) <= BROADCAST_LABELS:
        chosen = F.broadcast(chosen)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sample = materialize(texts.join(chosen, "doc_id"), "labelled-sample")
    return sample.select("text", "y").distinct()


def choose_vocabulary(sample: DataFrame, size: int = VOCABULARY, min_docs: int = MIN_DOCS) -> list[str]:
    """The words and beginnings whose document frequency differs most between one class and the others."""
    import numpy as np

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = Counter()
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()):
                found.update((y, f) for f in {f for w in words_of(text) for f in names_of(w)})
            yield pa.RecordBatch.from_arrays(
                [pa.array([y for y, _ in found], pa.string()), pa.array([f for _, f in found], pa.string()),
                 pa.array(list(found.values()), pa.int64())], names=["y", "word", "n"])

    totals = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    if len(totals) < 2:
        return []
    counts = sample.select("y", "text").mapInArrow(run, "y string, word string, n long").groupBy("word", "y").agg(
        F.sum("n").alias("count"))
    n = sum(totals.values())
    by_word = (counts.groupBy("word").agg(F.sum("count").alias("df"),
                                          F.map_from_entries(F.collect_list(F.struct("y", "count"))).alias("by"))
               .where(F.col("df") >= min_docs))
    score = F.lit(0.0)
    for y, t in totals.items():
        inside = F.coalesce(F.col("by")[y], F.lit(0))
        expected = F.col("df") * (t / n)
        score = F.greatest(score, F.abs(inside - expected) / F.sqrt(expected * (1 - F.col("df") / (n + 1)) + 1))
    rows = by_word.select("word", score.alias("s")).orderBy(F.desc("s"), "word").limit(size).collect()
    return [r["word"] for r in rows if np.isfinite(r["s"])]


@dataclass
class Model:
    """Softmax regression over word presence and shape ratios."""

    classes: list[str]
    vocabulary: list[str]
    weights: object = None          # [features, classes]
    bias: object = None
    use_shape: bool = True
    position: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.position = {w: i for i, w in enumerate(self.vocabulary)}
        self.beginnings = {w[:MIN_PREFIX] for w in self.vocabulary}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def positions(self, words) -> set[int]:
        """Vocabulary positions of the features of ``words`` (lower case)."""
        return {self.position[f] for w in words if w[:MIN_PREFIX] in self.beginnings
                for f in names_of(w) if f in self.position}

    def text_positions(self, tokens: list[bytes]) -> set[int]:
        """The same for a text's tokens between white space; their positions are kept for later texts."""
        known, out = self.known, set()
        for token in set(tokens):
            at = known.get(token)
            if at is None:
                if len(known) >= KNOWN_TOKENS:
                    known.clear()
                at = known[token] = tuple(
                    self.positions(WORD.findall(token.decode("utf-8", "surrogatepass").lower())))
            if at:
                out.update(at)
        return out

    @property
    def width(self) -> int:
        return len(self.vocabulary) + (len(SHAPE) if self.use_shape else 0)

    def features(self, text: str):
        import numpy as np

        raw = text.encode("utf-8", "surrogatepass")
        tokens = raw.split()
        x = np.zeros(self.width, dtype=np.float32)
        x[list(self.text_positions(tokens))] = 1
        if self.use_shape:
            x[len(self.vocabulary):] = shape_of(text, raw, len(tokens))
        return x

    def probabilities(self, texts: list[str]):
        return self.probabilities_and_words(texts)[0]

    def probabilities_and_words(self, texts: list[str]):
        """Class probabilities [texts, classes] and the number of words ``[^\\x20\\x09-\\x0D]+`` of each text."""
        import numpy as np

        logits = np.tile(np.asarray(self.bias, dtype=np.float64), (len(texts), 1))
        words = self.weights[: len(self.vocabulary)]
        counts = []
        for i, t in enumerate(texts):
            raw = t.encode("utf-8", "surrogatepass")
            tokens = raw.split()
            counts.append(len(tokens))
            at = sorted(self.text_positions(tokens))
            if at:
                logits[i] += words[at].sum(axis=0)
            if self.use_shape:
                logits[i] += np.asarray(shape_of(t, raw, len(tokens))) @ self.weights[len(self.vocabulary):]
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=1, keepdims=True), counts


def fit_softmax(model: Model, x, y, swaps=None, swap_weight: float = 0.0, l2=1e-3, steps: int = 300,
                rate: float = 0.1) -> Model:
    """Full-batch Adam; ``swaps`` rows are feature changes whose effect on the logits is penalised.

    ``l2``: one number, or one a weight ([features, classes]).
    """
    import numpy as np

    k, n = len(model.classes), max(len(y), 1)
    w, b = np.zeros((model.width, k)), np.zeros(k)
    x = x.astype(np.float64)
    target = np.eye(k)[y]
    share = target.sum(axis=0)
    # classes weigh by the root of their share: rare ones are heard, priors stay
    weight = (np.sqrt(share.max() / np.maximum(share, 1)))[y][:, None]
    m, v = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    for t in range(1, steps + 1):
        z = x @ w + b
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        g = weight * (p - target) / n
        gw, gb = x.T @ g + l2 * w, g.sum(axis=0)
        if swaps is not None and len(swaps) and swap_weight:
            gw += 2 * swap_weight / len(swaps) * (swaps.T @ (swaps @ w))
        for i, (value, grad) in enumerate(((w, gw), (b, gb))):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.999 * v[i] + 0.001 * grad * grad
            value -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    model.weights, model.bias = w, b
    return model
