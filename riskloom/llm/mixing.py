"""Soft-membership mixing: document rates whose expected domain token totals match targets.

1. A softmax classifier learned from a bounded sample of the ``labels`` table
   gives every document posteriors ``p`` over domains (the label combinations
   ``q<quality>t<toxic>``).
2. Rates ``r >= 0`` minimise the squared distance, in the metric of the inverse
   moment matrix ``M = sum n p p'``, of the expected totals ``sum r n p`` (n: tokens)
   from the targets.  Projected gradient: ``r <- max(0, r - p . inv(M) e)`` with the
   residual ``e``.  In this metric the step length 1 is the inverse of the largest
   eigenvalue, and one step is exact until a rate meets zero.  From then on M is
   taken over the documents whose rate is above zero (a longer step), halved while it
   does not bring the totals closer; after ``HALVES`` M is that of all documents.  The
   fit ends when the totals meet the targets, or when a step with all documents' M
   stands still: the targets are then out of reach and the distance is the least
   there is.  Any distance left is told as a warning.
3. A step needs only the residual, one sum over all documents.  A document's rate is
   the fold of all steps so far; it is written after every ``FOLDED`` steps, so a pass
   folds only those since.  Nothing but the sums reaches the driver.

Defined results: null and empty texts have no tokens and keep the rate of their
posteriors; every domain with a labelled text is learned, however few there are (see
``SHAPE_PRIOR``); the target of a domain without any labelled text is shared out over
the others; without labelled rows there is one domain ``all``;
repeated rows are rows of their own; an empty table gives an empty result; an input
column named like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .text_blocks import released
from .text_classifier import PER_CLASS, VOCABULARY, Model, choose_vocabulary, fit_softmax, labelled_sample, uniform

#: Target token weights of the registered query and the pipeline.
TARGETS = {"q1t0": 0.93, "q0t0": 0.05, "q1t1": 0.015, "q0t1": 0.005}
ANCHOR, ANCHOR_SCALE = "q1t0", 1.05   # the mixture holds 1.05 times the anchor domain's tokens
#: STEPS bounds the sums over all documents of a fit that only creeps closer; the warning tells that too.
STEPS, TOLERANCE, HALVES = 400, 1e-9, 6
FOLDED = 16         # accepted steps after which the rates are written, so that a pass folds fewer than these
STILL = 1e-6        # size of a step, as a part of the targets, that counts as none
L2 = 1e-3
#: Prior of the classifier: a domain of n labelled texts has its shape weights held at zero with
#: 1 + SHAPE_PRIOR / n times the strength.  Length and the like of a handful of texts say little of
#: the domain, yet every document has a length; its words, which others lack, keep the common prior.
SHAPE_PRIOR = 10_000


def fit_domains(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
                vocabulary: int = VOCABULARY) -> Model:
    """Classifier of the label combinations (quality, toxic) of ``labels``."""
    import numpy as np

    domain = F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string"))
    sample = labelled_sample(docs, labels.select("doc_id", domain.alias("domain")), "domain", per_class)
    classes = sorted(r["y"] for r in sample.select("y").distinct().collect())   # one row a class
    if len(classes) < 2:
        one = Model(classes or ["all"], [], use_shape=False)
        one.weights, one.bias = np.zeros((0, 1)), np.zeros(1)
        return one
    model = Model(classes, choose_vocabulary(sample, vocabulary))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x = [model.features(t).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(x, pa.list_(pa.float32()))],
                                             names=["y", "x"])

    # bounded: about classes x per_class rows of `vocabulary` numbers
    got = sample.select("y", "text").mapInArrow(released(run), "y string, x array<float>").toArrow()
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(got.num_rows, model.width)
    y = np.array([classes.index(v) for v in got.column("y").to_pylist()])
    order = sorted(range(len(y)), key=lambda i: (y[i], x[i].tobytes()))     # not as the rows happened to lie
    x, y = x[order], y[order]
    prior = np.full((model.width, len(classes)), L2)
    prior[len(model.vocabulary):] *= 1 + SHAPE_PRIOR / np.bincount(y, minlength=len(classes))
    return fit_softmax(model, x, y, l2=prior)


def with_posteriors(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``n_tokens`` (words ``[^\\x20\\x09-\\x0D]+``) and ``posteriors`` (array<double>) to every row."""
    from .bpe import replaced
    from pyspark.sql import types as T

    keep, schema = replaced(docs.schema, None, n_tokens=T.LongType(), posteriors=T.ArrayType(T.DoubleType()))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("__text").to_pylist()
            p, n = model.probabilities_and_words(texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(keep).columns, pa.array(n, pa.int64()), pa.array(p.round(9).tolist(), pa.list_(pa.float64()))],
                names=[*keep, "n_tokens", "posteriors"])

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text")
    return docs.select(*keep, text).mapInArrow(released(run), schema)


def fold_steps(p, steps, rates=None):
    """Rates after the given steps, from 1 or from ``rates``, one row of posteriors each."""
    import numpy as np

    r = np.ones(len(p)) if rates is None else rates
    for g in steps:
        r = np.maximum(0.0, r - p @ g)
    return r


def _totals(narrow: DataFrame, steps, k: int):
    """``sum r n p`` and the moments of the documents with a rate above zero: one row to the driver."""
    import numpy as np

    names = [f"s{i}" for i in range(k + k * k)]

    def run(batches):
        import pyarrow as pa

        total, moments = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                p = batch.column("posteriors").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
                n = batch.column("n_tokens").to_numpy(zero_copy_only=False)
                r = fold_steps(p, steps, batch.column("rate").to_numpy(zero_copy_only=False))
                total += (r * n) @ p
                moments += (p * (n * (r > 0))[:, None]).T @ p
        row = [*total, *moments.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array([float(v)]) for v in row], names=names)

    sums = narrow.select("n_tokens", "posteriors", "rate").mapInArrow(released(run), ", ".join(f"{c} double" for c in names))
    row = np.array([v or 0.0 for v in sums.agg(*[F.sum(c).alias(c) for c in names]).first()])
    return row[:k], row[k:].reshape(k, k)


def _folded(narrow: DataFrame, steps) -> DataFrame:
    """``narrow`` with the rates after further steps."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        k = len(steps[0])
        for batch in batches:
            if batch.num_rows:
                p = batch.column("posteriors").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
                r = fold_steps(p, steps, batch.column("rate").to_numpy(zero_copy_only=False))
                at = batch.schema.get_field_index("rate")
                yield batch.set_column(at, "rate", pa.array(np.asarray(r), pa.float64()))

    return narrow.mapInArrow(released(run), narrow.schema)


def fit_rates(narrow: DataFrame, classes: list[str], targets: Mapping[str, float], anchor: str | None = ANCHOR,
              anchor_scale: float = ANCHOR_SCALE, steps: int = STEPS, tolerance: float = TOLERANCE):
    """Step vectors of the projected gradient and the target totals, for a table ``n_tokens, posteriors``.

    Warns with the distance that is left when the totals do not meet the targets.
    """
    import warnings

    import numpy as np

    k = len(classes)
    narrow = narrow.select("n_tokens", "posteriors", F.lit(1.0).alias("rate"))
    written = 0             # steps that the rates in `narrow` hold
    now, moments = _totals(narrow, [], k)   # all rates are 1: the moments of all documents
    whole = np.linalg.pinv(moments, rcond=1e-12)
    weight = np.array([targets.get(c, 0.0) for c in classes])
    weight = weight / weight.sum() if weight.sum() > 0 else np.full(k, 1 / k)
    size = now.sum()
    if anchor in classes and weight[classes.index(anchor)] > 0:
        size = anchor_scale * now[classes.index(anchor)] / weight[classes.index(anchor)]
    goal = weight * size
    done: list = []
    halved, tries, why = 0, 0, "still getting closer"
    scale = max(goal.sum(), 1.0)
    while np.abs(now - goal).sum() > tolerance * scale and tries < steps:
        tries += 1
        e, bold = now - goal, halved <= HALVES
        step = (np.linalg.pinv(moments, rcond=1e-12) / 2 ** halved if bold else whole) @ e
        then, moved = _totals(narrow, [*done[written:], step], k)
        gain = e @ whole @ e - (then - goal) @ whole @ (then - goal)
        if bold and gain < 0.1 / 2 ** halved * (e @ whole @ e):
            halved += 1         # the longer step overshot or hardly moved
            continue
        # a sure step's gain is half the square of the rates' change at least
        if not bold and gain <= STILL ** 2 * (goal @ whole @ goal):
            why = "out of reach"
            break
        done, now, moments, halved = [*done, step], then, moved, max(0, halved - 1) if bold else 0
        if len(done) - written >= FOLDED:
            narrow = materialize(_folded(narrow, done[written:]), "mixing-rates")
            written = len(done)
    left = np.abs(now - goal).sum() / scale
    if left > tolerance:
        warnings.warn(f"mixing: totals are {left:.3g} of their sum from the targets after {tries} tries, {why}",
                      RuntimeWarning, stacklevel=2)
    return done, goal


def with_rates(rows: DataFrame, steps) -> DataFrame:
    """Add ``rate`` (rounded to six places) to rows with ``posteriors``."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def rate(p):
        import numpy as np

        return p.iloc[:0].astype(float) if not len(p) else type(p)(
            fold_steps(np.stack(p.to_numpy()), steps).round(6), index=p.index)

    # not deterministic for the planner, so that a filter on the rate does not compute it a second time,
    # in a second Python worker of the task
    return rows.drop("rate").withColumn("rate", rate.asNondeterministic()("posteriors"))


def soft_mixture(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS,
                 keep_text: bool = True, **fit_options) -> DataFrame:
    """Every row of ``docs`` with ``n_tokens, posteriors, domain, rate, copies`` (without ``text`` unless kept).

    Posteriors are computed once: the rows are written with them, and every step of the fit and
    the rates read them back.
    ``domain`` is the likeliest one.  ``copies`` rounds the rate to a whole number
    whose expectation it is, by a hash of doc_id, so the mixture is reproducible.
    """
    model = fit_domains(docs, labels)
    rated = with_posteriors(docs, model)
    rated = materialize(rated if keep_text else rated.drop("text"), "mixing")
    steps, _ = fit_rates(rated.select("n_tokens", "posteriors"), model.classes, targets, **fit_options)
    names = F.array(*[F.lit(c) for c in model.classes])
    whole = F.floor("rate")
    return (with_rates(rated, steps)
            .withColumn("domain", F.element_at(names, F.array_position(
                "posteriors", F.array_max("posteriors")).cast("int")))
            .withColumn("copies", (whole + (uniform(F.coalesce(F.col("doc_id"), F.lit(-1)), "mixing")
                                            < F.col("rate") - whole).cast("long")).cast("long")))


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return soft_mixture(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep_text=False)
