"""Periodic runs of words by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) that is at least ``max(MIN_WORDS, REPEATS * q)`` long and that no
neighbouring word extends.

The automaton of a stretch grows word by word.  Its suffix links form a tree; a
link-cut tree keeps, on that tree, solid path segments whose states last occurred
at the same place.  Appending word i accesses the new prefix state: the access
walks the segments between it and the root, recolours them to i, and tells
of each the place j where its strings ended last and the length L of its longest
string on the path.  That string ends at i and at j, and no longer one ends at both.  With
d = i - j <= L this is a square of period d; with L >= (REPEATS - 1) * d the
words from j - L + 1 to i have period d ``REPEATS`` times over, and the start
cannot move to the left.  The last such i of a start and period is the end of the run.
Since the colour is the latest occurrence, d is the smallest period.  All accesses
together walk O(n log n) segments.

Stretches: in a run of at least REPEATS * q words every word occurs REPEATS times and
every three neighbours occur REPEATS - 1 times.  So a text is cut, by counting, at
words and triples that are too rare in their stretch, until nothing more falls
away; no run is touched or shortened by it.  What is left is searched whole.

Texts are worked on where they are read, nothing is shuffled.  Null and empty
texts have no words and no runs; repeated rows give the same result each; an empty
table gives an empty result; other input columns pass through, ``n_words``,
``runs`` and ``collapsed`` are replaced.  A long text takes about 40 bytes a state (two
states a word at most) and its branching transitions.
"""

from __future__ import annotations

from array import array
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text_blocks import text_blocks

REPEATS = 4
MIN_WORDS = 6
COMPACT_WORDS = 50_000      # stretches from this length on keep their states in packed arrays

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


class LastEnds:
    """Suffix automaton of a growing word sequence with the last end of every state's strings."""

    def __init__(self, n: int):
        states = 2 * n + 2
        row = (lambda: array("i", bytes(4 * states))) if n >= COMPACT_WORDS else (lambda: [0] * states)
        self.length, self.link = row(), row()
        self.symbol, self.to = row(), row()             # a state's first transition (symbol + 1, 0: none)
        self.more: dict[int, dict[int, int]] = {}       # its others
        self.up, self.left, self.right, self.seen = row(), row(), row(), row()   # splay trees; seen: end + 1
        self.top, self.last, self.n = 1, 1, 0           # state 1 is the empty string, 0 stands for none

    def _splay(self, x: int) -> None:
        up, left, right, seen = self.up, self.left, self.right, self.seen
        while True:
            y = up[x]
            if not y or (left[y] != x and right[y] != x):
                return
            z = up[y]
            inner = z and (left[z] == y or right[z] == y)
            for k in ((y, x) if (left[z] == y) == (left[y] == x) else (x, x)) if inner else (x,):
                # rotate k above its parent
                p = up[k]
                g = up[p]
                if left[p] == k:
                    b = left[p] = right[k]
                    right[k] = p
                else:
                    b = right[p] = left[k]
                    left[k] = p
                if b:
                    up[b] = p
                up[p], up[k] = k, g
                if g and left[g] == p:
                    left[g] = k
                elif g and right[g] == p:
                    right[g] = k
                else:
                    seen[k] = seen[p]      # a segment's colour stands at the root of its splay tree

    def append(self, c: int) -> list[tuple[int, int]]:
        """Add a word; returns ``(previous end, length)`` of every segment accessed, from the deepest."""
        length, link, symbol, to, more = self.length, self.link, self.symbol, self.to, self.more
        up, left, right, seen = self.up, self.left, self.right, self.seen
        c += 1
        self.top += 1
        cur = self.top
        length[cur] = length[self.last] + 1
        p, q = self.last, 0
        while p:
            if symbol[p] == c:
                q = to[p]
                break
            if not symbol[p]:
                symbol[p], to[p] = c, cur
            else:
                others = more.get(p)
                if others is None:
                    more[p] = {c: cur}
                elif (q := others.get(c, 0)):
                    break
                else:
                    others[c] = cur
            p = link[p]
        if not p:
            above = 1
        elif length[p] + 1 == length[q]:
            above = q
        else:
            self.top += 1
            above = self.top
            length[above], link[above] = length[p] + 1, link[q]
            symbol[above], to[above] = symbol[q], to[q]
            if q in more:
                more[above] = dict(more[q])
            # the copy stands right above q, on q's segment
            self._splay(q)
            b = left[above] = left[q]
            if b:
                up[b] = above
            left[q], up[above] = above, q
            link[q] = above
            while p:
                if symbol[p] == c and to[p] == q:
                    to[p] = above
                elif p in more and more[p].get(c) == q:
                    more[p][c] = above
                else:
                    break
                p = link[p]
        link[cur] = up[cur] = above
        self.last = cur
        self.n += 1
        # access: recolour the path from the new state to the root
        out, x, low, splay = [], above, cur, self._splay
        while x:
            splay(x)
            j = seen[x]
            b = right[x]
            if b:
                seen[b] = j
            right[x] = low
            if j and length[x]:
                out.append((j - 1, length[x]))
            low, x = x, up[x]
        seen[low] = self.n
        return out


def runs_of(words, repeats: int = REPEATS, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a sequence of integers, by start, then period."""
    ends: dict[tuple[int, int], int] = {}
    grow, need = LastEnds(len(words)).append, repeats - 1
    for i, c in enumerate(words):
        for j, size in grow(c):
            d = i - j
            if size >= need * d:
                ends[j - size + 1, d] = i
    return sorted((a, i - a + 1, d) for (a, d), i in ends.items() if i - a + 1 >= max(min_words, repeats * d))


def stretches(ids, doc, repeats: int = REPEATS, min_words: int = MIN_WORDS):
    """Start and end positions (exclusive) of the stretches that can hold runs; ``doc`` ascends."""
    import numpy as np

    at = np.arange(len(ids))
    part = doc.astype(np.int64)
    if not len(at):
        return at, at
    width = int(ids.max()) + 1
    _, code, times = np.unique(part * width + ids, return_inverse=True, return_counts=True)
    at = at[times[code] >= repeats]
    while True:
        part = np.cumsum((np.diff(at, prepend=-2) != 1) | (np.diff(doc[at], prepend=-1) != 0))
        three = np.flatnonzero(part[:-2] == part[2:]) if len(at) > 2 else np.empty(0, np.int64)
        key = part[three] * width + ids[at[three]]
        for k in (1, 2):
            _, key = np.unique(key, return_inverse=True)
            key = key.astype(np.int64) * width + ids[at[three + k]]
        _, code, times = np.unique(key, return_inverse=True, return_counts=True)
        good = three[times[code] >= repeats - 1]
        keep = np.zeros(len(at), bool)
        for k in range(3):
            keep[good + k] = True
        if keep.all():
            break
        at = at[keep]
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    first, last = at[cuts], at[np.append(cuts[1:], len(at)) - 1] + 1 if len(at) else at
    long_enough = last - first >= min_words
    return first[long_enough], last[long_enough]


def text_runs(texts: list[bytes], repeats: int = REPEATS, min_words: int = MIN_WORDS):
    """Words and runs of every text."""
    import numpy as np

    words = [t.split() for t in texts]      # bytes.split() cuts at exactly \x20 and \x09-\x0D
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    number = {w: k for k, w in enumerate(set(chain.from_iterable(words)))}
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(words)), sizes)
    begin = np.cumsum(sizes) - sizes
    runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for a, b in zip(*(x.tolist() for x in stretches(ids, doc, repeats, min_words))):
        d = int(doc[a])
        shift = a - int(begin[d])
        runs[d].extend((shift + s, n, q) for s, n, q in runs_of(ids[a:b].tolist(), repeats, min_words))
    return words, runs


def periodic_runs(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``n_words``, ``runs`` (array of start, length, period; by start, then period) and ``collapsed``.

    ``collapsed`` holds the words, joined by one space, without those that some run
    contains after its first ``period`` words.  ``keep`` names the input columns of
    the result (default: all).
    """
    own = ("n_words", "runs", "collapsed")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in own]
    sent = "__text"
    while sent in docs.columns:
        sent += "_"
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)),
        T.StructField("collapsed", T.StringType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        kind = pa.list_(pa.field("element", pa.struct(
            [pa.field(n, pa.int64(), False) for n in ("start", "length", "period")]), False))
        for batch in batches:
            kept = batch.select(keep)
            for at, texts in text_blocks(batch, sent):
                words, runs = text_runs([t.encode("utf-8", "surrogatepass") for t in texts])
                collapsed = []
                for own_words, found in zip(words, runs):
                    if found:
                        edge = np.zeros(len(own_words) + 1, np.int64)
                        for s, n, q in found:
                            edge[s + q] += 1
                            edge[s + n] -= 1
                        stay = (np.cumsum(edge)[:-1] == 0).tolist()
                        own_words = [w for w, s in zip(own_words, stay) if s]
                    collapsed.append(b" ".join(own_words))
                part = kept.slice(at, len(texts))
                named = [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(map(len, words), pa.int64()), pa.array(named, kind),
                     pa.array(collapsed, pa.binary()).cast(pa.string())], names=[*keep, *own])

    return docs.select(*keep, F.col(text_col).cast("string").alias(sent)).mapInArrow(run, schema)


def _planted(doc_id: Column, text: Column) -> Column:
    """The query's text: in every tenth document (by crc32) the words from word a on repeat a period of p words."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.call_function("div", h, F.lit(10))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = F.lit(1) + F.call_function("div", n - a, F.lit(3) + g % 8)
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.get(
            w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    # one binding of the word list, by a transform over an array of one
    planted = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))
    return F.when(text.isNotNull() & (h % 10 == 0), F.get(planted, F.lit(0))).otherwise(text)


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = periodic_runs(docs.select("doc_id", _planted(F.col("doc_id"), F.col("text")).alias("text")),
                          keep=["doc_id"])
    # runs come by start, then period: only a greater exponent replaces the first of equals
    most = F.reduce("runs", F.get("runs", F.lit(0)), lambda m, r: F.when(
        r["length"] * m["period"] > m["length"] * r["period"], r).otherwise(m))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(lines, lambda t: F.concat(t, F.lit("\n"))), "")
    return found.withColumn("most", most).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("most.start").alias("start"),
        F.col("most.length").alias("length"), F.col("most.period").alias("period"),
        F.call_function("div", F.lit(1000) * F.col("most.length"), F.col("most.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
