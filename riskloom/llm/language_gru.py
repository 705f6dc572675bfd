"""Language identification with a bidirectional gated recurrent network over bytes.

The network is small: a byte selects its gate inputs from a table, two gated
recurrent units of ``HIDDEN`` cells read the bytes in both directions, and their
states give language probabilities at every byte.  It is trained here in numpy
by backpropagation through time (Adam), on a bounded sample: pieces of
``PIECE`` bytes from at most about ``PER_LANGUAGE`` documents a language.

Whole texts are labelled: a text is cut into pieces of ``PIECE`` bytes (the last one
reaches back to full length; shared positions count once), every position of every
piece gets probabilities, and a document's are their mean.

Defined results: ``und`` with score 0 for null texts and texts without a letter;
ties go to the language that sorts first; without a labelled row everything is
``und``; repeated rows are labelled one by one; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text_classifier import uniform

PIECE, HIDDEN = 96, 8
PER_LANGUAGE, PIECES_PER_DOC = 300, 4
BATCH, ROUNDS, RATE = 128, 220, 0.02
BLOCK = 2_048                      # pieces read side by side
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
FOLDS, HELD_OUT = 4, 2


def training_pieces(docs: DataFrame, lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """``lang, piece``: pieces spread evenly over the texts of a bounded sample of labelled rows."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col("text").isNotNull())
    rate = F.lit(0.0)
    for r in rows.groupBy(lang_col).count().collect():  # one row a language
        rate = F.when(F.col(lang_col) == r[lang_col], F.lit(per_language / r["count"])).otherwise(rate)
    chosen = rows.where(uniform(F.coalesce(F.col("doc_id"), F.lit(-1)), "language") < rate)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            langs, pieces = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if LETTER.search(text):
                    raw = text.encode("utf-8", "surrogatepass")
                    step = max(PIECE, -(-len(raw) // PIECES_PER_DOC))
                    own = [raw[i:i + PIECE] for i in range(0, len(raw), step)]
                    langs += [lang] * len(own)
                    pieces += own
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(pieces, pa.binary())],
                                             names=["lang", "piece"])

    return chosen.select(F.col(lang_col).alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "lang string, piece binary")


def _soft(x):
    """x / (1 + |x|), in place: a cheap stand-in for tanh; its slope is (1 - |y|)^2."""
    import numpy as np

    d = np.abs(x)
    d += 1
    x /= d
    return x


class ByteGRU:
    """Two gated recurrent units over bytes and a linear layer; states are [batch, features]."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        import numpy as np

        rng, k = np.random.default_rng(seed), len(languages)
        self.languages, self.hidden = languages, hidden
        self.p = {}
        for side in "fb":
            # gate inputs of each byte (update and reset; candidate), recurrent weights, output weights
            self.p["x" + side] = rng.normal(0, 0.5, (256, 2 * hidden)).astype(np.float32)
            self.p["n" + side] = rng.normal(0, 0.5, (256, hidden)).astype(np.float32)
            self.p["u" + side] = rng.normal(0, hidden ** -0.5, (hidden, 2 * hidden)).astype(np.float32)
            self.p["w" + side] = rng.normal(0, hidden ** -0.5, (hidden, hidden)).astype(np.float32)
            self.p["v" + side] = rng.normal(0, hidden ** -0.5, (hidden, k)).astype(np.float32)
        self.p["c"] = np.zeros(k, dtype=np.float32)

    def _run(self, side: str, x, mask=None, keep: bool = False):
        """States of one direction; x is [steps, batch] bytes, masked steps leave the state as it is."""
        import numpy as np

        n_h, (steps, n) = self.hidden, x.shape
        gates, cands, u, w = (self.p[k + side] for k in "xnuw")
        h = np.zeros((n, n_h), dtype=gates.dtype)
        states, tape = [None] * steps, []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            zr = np.take(gates, x[t], axis=0)
            zr += h @ u
            _soft(zr)
            zr *= 0.5
            zr += 0.5
            z, r = zr[:, :n_h], zr[:, n_h:]
            rh = r * h
            cand = np.take(cands, x[t], axis=0)
            cand += rh @ w
            _soft(cand)
            new = h - cand
            new *= z
            new += cand
            if mask is not None:
                new = np.where(mask[t][:, None] > 0, new, h)
            if keep:
                tape.append((t, h, z, r, rh, cand))
            h = states[t] = new
        return states, tape

    def probabilities(self, x, mask=None):
        """[languages, steps, batch] probabilities of every position."""
        import numpy as np

        logits = np.empty((len(self.languages), *x.shape), dtype=np.float32)
        for side in "fb":
            v = np.ascontiguousarray(self.p["v" + side].T)
            for t, h in enumerate(self._run(side, x, mask)[0]):
                if side == "f":
                    logits[:, t] = v @ h.T
                else:
                    logits[:, t] += v @ h.T
        logits += self.p["c"][:, None, None]
        logits -= logits.max(axis=0)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=0)
        return logits

    def gradients(self, x, mask, target):
        """Loss (mean cross entropy over positions) and gradients, by backpropagation through time."""
        import numpy as np

        runs = {s: self._run(s, x, mask, keep=True) for s in "fb"}
        hs = {s: np.stack(runs[s][0]) for s in "fb"}                     # [steps, batch, hidden]
        logits = hs["f"] @ self.p["vf"] + hs["b"] @ self.p["vb"] + self.p["c"]
        logits -= logits.max(axis=2, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=2, keepdims=True)
        count = max(float(mask.sum()), 1.0)
        rows = np.arange(x.shape[1])
        loss = float(-(np.log(prob[:, rows, target] + 1e-12) * mask).sum() / count)
        d = prob
        d[:, rows, target] -= 1
        d *= mask[:, :, None] / count
        grads = {"c": d.sum(axis=(0, 1))}
        for s in "fb":
            u, w = self.p["u" + s], self.p["w" + s]
            grads["v" + s] = np.tensordot(hs[s], d, axes=([0, 1], [0, 1]))
            dh_out = d @ self.p["v" + s].T
            du, dw = np.zeros_like(u), np.zeros_like(w)
            dx, dn = np.zeros_like(self.p["x" + s]), np.zeros_like(self.p["n" + s])
            carry = np.zeros_like(dh_out[0])
            for t, h, z, r, rh, cand in reversed(runs[s][1]):
                total = carry + dh_out[t]
                on = total * mask[t][:, None]
                dcand = on * (1 - z) * (1 - np.abs(cand)) ** 2
                drh = dcand @ w.T
                zr = np.concatenate([z, r], axis=1)
                gate = np.concatenate([on * (h - cand), drh * h], axis=1) * 0.5 * (1 - np.abs(2 * zr - 1)) ** 2
                carry = (total - on) + on * z + drh * r + gate @ u.T
                du += h.T @ gate
                dw += rh.T @ dcand
                np.add.at(dx, x[t], gate)
                np.add.at(dn, x[t], dcand)
            grads.update({"u" + s: du, "w" + s: dw, "x" + s: dx, "n" + s: dn})
        return loss, grads

    def train(self, pieces: list[bytes], target, rounds: int = ROUNDS, batch: int = BATCH, rate: float = RATE,
              seed: int = 11):
        import numpy as np

        rng = np.random.default_rng(seed)
        x, mask = padded(pieces)
        target = np.asarray(target)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        by_lang = [np.flatnonzero(target == i) for i in range(len(self.languages))]
        for step in range(1, rounds + 1):
            # every language has the same share of a batch
            pick = np.concatenate([rng.choice(b, -(-batch // len(by_lang))) for b in by_lang if len(b)])
            _, grads = self.gradients(x[:, pick], mask[:, pick], target[pick])
            lr = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
            norm = sum(float((g * g).sum()) for g in grads.values()) ** 0.5
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.99 * v2[k] + 0.01 * g * g
                self.p[k] -= (lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.99 ** step)) + 1e-8)
                              ).astype(self.p[k].dtype)
        return self

    def label(self, texts: list[str]):
        """Mean position probabilities [texts, languages] of whole texts; texts must not be empty."""
        import numpy as np

        raws = [t.encode("utf-8", "surrogatepass") for t in texts]
        total = np.zeros((len(texts), len(self.languages)))
        short = [i for i, r in enumerate(raws) if len(r) < PIECE]
        for at in range(0, len(short), BLOCK):
            own = short[at:at + BLOCK]
            x, mask = padded([raws[i] for i in own])
            total[own] = (self.probabilities(x, mask) * mask).sum(axis=1).T
        # pieces of long texts: (document, start, first position that counts)
        doc, start, first = [], [], []
        base, buffers = 0, []
        for i, r in enumerate(raws):
            if len(r) >= PIECE:
                own = list(range(0, len(r) - PIECE + 1, PIECE))
                first += [0] * len(own)
                if (rest := len(r) % PIECE):
                    own.append(len(r) - PIECE)
                    first.append(PIECE - rest)
                doc += [i] * len(own)
                start += [base + s for s in own]
                buffers.append(r)
                base += len(r)
        if doc:
            joined = np.frombuffer(b"".join(buffers), dtype=np.uint8)
            doc, start, first = np.array(doc), np.array(start), np.array(first)
            step = np.arange(PIECE)[:, None]
            for at in range(0, len(doc), BLOCK):
                part = slice(at, at + BLOCK)
                prob = self.probabilities(joined[start[part][None, :] + step])
                seen = prob.sum(axis=1)
                for j in np.flatnonzero(first[part]):
                    seen[:, j] = prob[:, first[part][j]:, j].sum(axis=1)
                np.add.at(total, doc[part], seen.T)
        return total / np.array([max(len(r), 1) for r in raws])[:, None]


def padded(pieces: list[bytes]):
    """[PIECE, n] bytes and mask (1 where there is a byte)."""
    import numpy as np

    x = np.zeros((len(pieces), PIECE), dtype=np.uint8)
    mask = np.zeros((len(pieces), PIECE), dtype=np.float32)
    for i, p in enumerate(pieces):
        x[i, : len(p)] = np.frombuffer(p, dtype=np.uint8)
        mask[i, : len(p)] = 1
    return np.ascontiguousarray(x.T), np.ascontiguousarray(mask.T)


def fit(docs: DataFrame, lang_col: str = "lang", per_language: int = PER_LANGUAGE, rounds: int = ROUNDS) -> ByteGRU | None:
    """Train on labelled rows (the caller leaves held-out rows out); None when there are none."""
    # bounded: about languages x per_language x PIECES_PER_DOC pieces of PIECE bytes
    got = training_pieces(docs, lang_col, per_language).toArrow()
    langs, pieces = got.column("lang").to_pylist(), got.column("piece").to_pylist()
    if not langs:
        return None
    order = sorted(range(len(langs)), key=lambda i: (langs[i], pieces[i]))  # no dependence on row order
    names = sorted(set(langs))
    net = ByteGRU(names)
    if len(names) > 1:
        net.train([pieces[i] for i in order], [names.index(langs[i]) for i in order], rounds)
    return net


def identify(docs: DataFrame, net: ByteGRU | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            ok = [i for i, t in enumerate(texts) if net and t and LETTER.search(t)]
            at = 0
            while at < len(ok):  # blocks of about 4 MB of text
                end, size = at, 0
                while end < len(ok) and (end == at or size + len(texts[ok[end]]) <= 4_000_000):
                    size += len(texts[ok[end]])
                    end += 1
                prob = net.label([texts[i] for i in ok[at:end]])
                for i, row in zip(ok[at:end], prob):
                    best = int(row.argmax())
                    names[i], scores[i] = net.languages[best], min(1.0, float(row[best]))
                at = end
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()),
                                              pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double")


def op7_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    net = fit(docs.where(fold != HELD_OUT))
    return identify(docs, net).select("doc_id", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
                                      "lang_pred", "score")
