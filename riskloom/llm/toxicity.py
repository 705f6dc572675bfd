"""Counterfactual-regularised toxicity classifier.

Logistic regression (two-class softmax) on the presence of words and word beginnings.  For every
labelled sentence that names an identity group, the group's term is swapped for
every other term of its list and for a neutral one, and the squared change of the
score is penalised.  Terms for groups then carry (almost) no weight of their own,
however often they stand in toxic sentences of the sample, so neutral mentions
are not taken for toxic ones.

Labels come only from rows with ``crc32(doc_id) % 5 != 0``; doc_id, lang, source
and labels are no inputs of a score.  Every whole text is scored where it is read.

Defined results: null and empty texts score the intercept; with fewer than two
classes to learn from, all scores are the share of label 1 (0 without labels);
repeated rows are scored one by one, repeated labels count once a class; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text_classifier import PER_CLASS, VOCABULARY, Model, choose_vocabulary, fit_softmax, labelled_sample, words_of

FOLDS = 5
SWAP_WEIGHT = 10.0

#: Terms of one list are swapped for one another and for the list's neutral first term.
IDENTITY_TERMS = (
    ("person", "woman", "man", "gay", "lesbian", "transgender", "black", "white", "asian", "latino", "muslim",
     "christian", "jew", "jewish", "hindu", "buddhist", "immigrant", "refugee", "disabled", "deaf", "blind", "elderly"),
    ("people", "women", "men", "gays", "lesbians", "blacks", "whites", "asians", "latinos", "muslims", "christians",
     "jews", "hindus", "buddhists", "immigrants", "refugees"),
)
SENTENCE = re.compile(r"[^.!?\n]+")


def swapped_words(text: str, terms=IDENTITY_TERMS):
    """(words of the text, words after a swap) for every swap of an identity term in one sentence."""
    lists = {t: group for group in terms for t in group}
    if not words_of(text) & lists.keys():
        return
    sentences = [words_of(s) for s in SENTENCE.findall(text)]
    for i, words in enumerate(sentences):
        named = sorted(words & lists.keys())
        if named:
            rest = set().union(*sentences[:i], *sentences[i + 1:])
            for a in named:
                for b in lists[a]:
                    if b != a:
                        yield rest | words, rest | (words - {a}) | {b}


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, vocabulary: int = VOCABULARY,
        swap_weight: float = SWAP_WEIGHT, terms=IDENTITY_TERMS) -> Model:
    """Fit on a bounded sample of ``labels`` (doc_id, toxic); the caller leaves held-out rows out."""
    import numpy as np

    sample = labelled_sample(docs, labels.where(F.col("toxic").isin(0, 1)), "toxic", per_class)
    words = list(dict.fromkeys([*choose_vocabulary(sample, vocabulary), *(t for g in terms for t in g)]))
    model = Model(["0", "1"], words, use_shape=False)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ys, xs, minus, plus = [], [], [], []
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()):
                ys.append(int(y))
                xs.append(sorted(model.text_positions(text.encode("utf-8", "surrogatepass").split())))
                swaps = ((model.positions(a), model.positions(b)) for a, b in swapped_words(text, terms))
                changes = {(tuple(sorted(a - b)), tuple(sorted(b - a))) for a, b in swaps}
                minus.append([list(a) for a, _ in sorted(changes)])
                plus.append([list(b) for _, b in sorted(changes)])
            nested = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(ys, pa.int32()), pa.array(xs, pa.list_(pa.int32())),
                                              pa.array(minus, nested), pa.array(plus, nested)],
                                             names=["y", "x", "minus", "plus"])

    # bounded by the sample: about 2 x per_class rows of positions in the vocabulary
    rows = sample.select("y", "text").mapInArrow(
        run, "y int, x array<int>, minus array<array<int>>, plus array<array<int>>").collect()
    rows.sort()             # the last digits of sums must not depend on where rows lay
    x = np.zeros((len(rows), model.width), dtype=np.float32)
    changes = set()
    for i, r in enumerate(rows):
        x[i, r["x"]] = 1
        changes.update((tuple(a), tuple(b)) for a, b in zip(r["minus"], r["plus"]))
    swaps = np.zeros((len(changes), model.width))
    for i, (a, b) in enumerate(sorted(changes)):
        swaps[i, list(a)] -= 1
        swaps[i, list(b)] += 1
    y = np.array([r["y"] for r in rows], dtype=int)
    if len(set(y.tolist())) < 2:
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-9), 1 - 1e-9)
        model.weights, model.bias = np.zeros((model.width, 2)), np.log([1 - share, share])
        return model
    return fit_softmax(model, x, y, swaps, swap_weight)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every whole text."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            p = model.probabilities(batch.column("text").to_pylist())[:, 1]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())],
                                             names=["doc_id", "score"])

    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def fold(folds: int):
    return F.crc32(F.col("doc_id").cast("string")) % folds


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(fold(FOLDS) != 0)
    return score(docs, fit(docs, labels)).select(
        "doc_id", F.coalesce(fold(FOLDS) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
