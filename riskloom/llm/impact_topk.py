"""Exact top-k search over an impact-ordered, score-at-a-time index.

Vectors are quantised to integers.  Index rows are dealt into blocks of about
``INDEX_BLOCK`` rows; in a block every dimension has a posting list of all its
rows, ordered by value and cut into ``SEGMENTS`` segments, each with its range of
values.  A block of queries is scored in descending order of quantised impact
(weight times the best value a segment can add), adding whole segments to
accumulators; the segments of one impact level are added for all queries together
as a product of masked matrices, in which a segment's postings are its rows'
values and all else is zero.  At the ``CHECK_AT`` levels

* the rows with the best accumulators are scored exactly; the k-th best exact
  score is a lower bound of the result;
* what unread segments can still add bounds every row from above.

A query is finished only when that proves that few rows can still be members;
exactly those are scored again in full.  No row is skipped without proof.

Rows are dealt into blocks by a hash of id and vector, queries likewise.  A block's row and
packed rows of all query blocks travel to one place, in this order: the index
of a block is built once, and the query blocks stream past it.  Work is (queries x
rows); memory is one index block and one query block.  Each block returns the k best ids of each
query, the best row of an id counting; an id among the k best of all is among
those of the block that holds its best row, so the best k of what is returned are exact.

Sums are made in 32- or 64-bit floats, 64-bit integers or Python's whole numbers, as the
block's largest values require for exact sums.

Defined results: vectors that are null or hold null or non-finite components
take no part; components beyond a vector's length count as zero; repeated
(id, vector) rows count once; an id with several vectors has its best score; rows with
the query's own id are no candidates; ties go to the smaller id; an empty table gives
no rows; other columns are ignored.  A component that does not fit a 64-bit integer when
quantised, or a returned score that does not, stops the job with a message.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SCALE = 256
INDEX_BLOCK = 8_192
QUERY_BLOCK = 512
SEGMENTS = 4
LEVELS = 8
CHECK_AT = (4, 2, 1)  # levels after which the proof is tried
RESCORE_SHARE = 16  # a query stops when at most 1 / RESCORE_SHARE of the block's rows can be members

LONG_BOUND = float(1 << 63)

RESULT = "query_id long, cand_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """``id, v`` (array<bigint>): floor(scale * x) of every usable vector, repeated rows once."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    usable = F.col(vec_col).isNotNull() & F.forall(
        "x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col), x.alias("x"))
            .where(F.coalesce(usable, F.lit(False)) & F.col("id").isNotNull())
            .select("id", F.transform("x", lambda c: F.when(
                F.abs(c * scale) < LONG_BOUND, F.floor(c * scale)).otherwise(F.raise_error(F.lit(
                    "a component times the scale does not fit 64 bits")))).alias("v")).distinct())


def _matrix(vectors, width: int):
    import numpy as np

    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Block:
    """Index of a block of rows: posting segments, each with its range of values per dimension.

    Postings come twice, counted from the dimension's least value (for positive
    weights) and from its greatest (for negative ones), so every impact is >= 0.
    """

    def __init__(self, ids, x, segments: int = SEGMENTS):
        import numpy as np

        self.ids, self.x = ids, x
        n, dims = x.shape
        cuts = np.linspace(0, n, min(segments, n) + 1).astype(int)
        order = np.argsort(x, axis=0, kind="stable")
        ranked = np.take_along_axis(x, order, axis=0)
        self.low, self.high = ranked[cuts[:-1]], ranked[cuts[1:] - 1]    # [segment, dimension]
        self.size = int(max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))))
        self.single = len(np.unique(ids)) == n
        self._parts = [(a, b, order[a:b], ranked[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        self._postings: dict = {}

    def postings(self, kind):
        """The segments' postings as masked matrices of a number type, made once a type."""
        import numpy as np

        if kind not in self._postings:
            n, dims = self.x.shape
            least, greatest = self.low[0].astype(kind), self.high[-1].astype(kind)
            held = []
            for a, b, rows, values in self._parts:
                m = np.zeros((n, 2 * dims), dtype=kind)
                cols = np.broadcast_to(np.arange(dims), (b - a, dims))
                m[rows, cols] = values.astype(kind) - least
                m[rows, cols + dims] = values.astype(kind) - greatest
                held.append(m)
            self._postings[kind] = held
        return self._postings[kind]

    def best(self, scores, rows, k: int):
        """The k best ids among rows: (row, score) by score, then id; the best row of an id counts."""
        import numpy as np

        order = np.lexsort((self.ids[rows], -scores)) if scores.dtype != object else np.array(
            sorted(range(len(rows)), key=lambda j: (-scores[j], self.ids[rows[j]])), dtype=int)
        taken, out = set(), []
        for j in order:
            i = int(self.ids[rows[j]])
            if i not in taken:
                taken.add(i)
                out.append((i, int(scores[j])))
                if len(out) == k:
                    break
        return out

    def kth(self, scores, rows, k: int):
        """The k-th best score over distinct ids, None with fewer ids."""
        import numpy as np

        if self.single and scores.dtype != object:
            return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else None
        found = self.best(scores, rows, k)
        return found[-1][1] if len(found) == k else None


def search_block(block: Block, q_ids, q, k: int, levels: int = LEVELS, rescore_share: int = RESCORE_SHARE):
    """The k best ids of one index block for each query: (query, id, score), all proven."""
    import numpy as np

    x_ids, x = block.ids, block.x
    n, dims = x.shape
    # sums of integer products are exact in the number type chosen
    limit = int(max(abs(int(q.min(initial=0))), abs(int(q.max(initial=0))))) * block.size * 4 * dims
    kind = np.float32 if limit < 1 << 24 else np.float64 if limit < 1 << 53 else np.int64 if limit < 1 << 62 else object
    whole = object if kind is object else np.int64
    low, high, q, x = (m.astype(whole) for m in (block.low, block.high, q, x))
    postings = block.postings(kind)
    weights = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1).astype(kind)
    # gain[query, segment, dim]: the most a posting of the segment can add
    worst = np.minimum(q * low[0], q * high[-1])
    gain = np.maximum(q[:, None, :] * low[None], q[:, None, :] * high[None]) - worst[:, None, :]
    top = np.maximum(gain.max(axis=(1, 2)), 1)
    level = np.minimum(gain * levels // top[:, None, None], levels - 1).astype(np.int64)   # quantised impact
    base = worst.sum(axis=1)
    acc = np.zeros((len(q), n), dtype=kind)
    own = q_ids[:, None] == x_ids[None, :]
    alive = np.arange(len(q))
    found = []
    few, probe = max(4 * k, n // rescore_share), min(4 * k, n)

    def emit(qi, rows, scores):
        found.extend((int(q_ids[qi]), i, score) for i, score in block.best(scores, rows, k))

    for lev in range(levels - 1, -1, -1):
        if not len(alive):
            break
        for s, held in enumerate(postings):
            use = level[alive, s] == lev
            if use.any():
                acc[alive] += (weights[alive] * np.concatenate([use, use], axis=1)) @ held.T
        if lev not in CHECK_AT:
            continue
        # the most that unread segments can still add to one row
        rest = np.where(level[alive] < lev, gain[alive], 0).max(axis=1).sum(axis=1)
        seen = np.where(own[alive], -1, acc[alive])
        leads = np.argpartition(-seen, probe - 1, axis=1)[:, :probe]
        going = []
        for qi, left, a, lead in zip(alive, rest, seen, leads):
            lead = lead[~own[qi, lead]]
            bound = block.kth(x[lead] @ q[qi], lead, k)            # k-th best exact score so far
            if bound is not None:
                possible = np.flatnonzero((a.astype(whole) + base[qi] + left >= bound) & ~own[qi])
                if len(possible) <= few:
                    emit(qi, possible, x[possible] @ q[qi])
                    continue
            going.append(qi)
        alive = np.array(going, dtype=int)
    for qi in alive:                                       # everything read: accumulators are the scores
        rows = np.flatnonzero(~own[qi])
        scores = acc[qi, rows].astype(whole) + base[qi]
        least = block.kth(scores, rows, k)
        if least is not None:
            rows, scores = rows[scores >= least], scores[scores >= least]
        emit(qi, rows, scores)
    return found


def exact_topk(index: DataFrame, queries: DataFrame, k: int, index_block: int = INDEX_BLOCK,
               query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, cand_id, score``; both inputs are ``id, v`` (see :func:`quantised`)."""
    index, queries = materialize(index, "topk-index"), materialize(queries, "topk-queries")
    blocks, q_blocks = max(1, -(-index.count() // index_block)), max(1, -(-queries.count() // query_block))

    def packed(rows: DataFrame, n: int) -> DataFrame:
        """One row a block; a block holds about as many rows as asked, whatever ids repeat."""
        deal = F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
        return rows.groupBy(deal.alias("block")).agg(F.collect_list(F.struct("id", "v")).alias("rows"))

    asked = packed(queries, q_blocks).select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("side"), "rows")
    both = packed(index, blocks).select("block", F.lit(0).alias("side"), "rows").unionByName(asked)
    # one place a block: its index first, then every query block
    both = both.repartition(blocks, "block").sortWithinPartitions("block", "side")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        at, block = None, None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("block", "side")]
            for number, side, rows in zip(*cols, (batch.column("rows")[i] for i in range(batch.num_rows))):
                held = rows.values
                ids, vectors = held.field(0).to_numpy(zero_copy_only=False), held.field(1).to_pylist()
                width = max(map(len, vectors))
                if side == 0:
                    at, block = number, Block(ids, _matrix(vectors, width))
                elif at == number:
                    if width > block.x.shape[1]:       # components beyond a vector's length are zero
                        more = width - block.x.shape[1]
                        block = Block(block.ids, np.pad(block.x, ((0, 0), (0, more))))
                    found = search_block(block, ids, _matrix(vectors, block.x.shape[1]), k)
                    if any(abs(score) >= 1 << 63 for _, _, score in found):
                        raise OverflowError("an inner product does not fit 64 bits")
                    cols = list(zip(*found)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                     names=["query_id", "cand_id", "score"])

    local = both.mapInArrow(run, RESULT).groupBy("query_id", "cand_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "cand_id")
    return local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", "rank", "cand_id", "score")


def op8_topk(spark, sf_dir: str) -> DataFrame:
    vectors = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    return exact_topk(vectors, vectors.where(F.col("id") % 50 == 0), 5).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("cand_id").alias("vec_id"), "score")


def oracle_sql() -> str:
    return f"""
WITH c AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
ok AS (SELECT vec_id FROM c GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND isfinite(x))),
v AS (SELECT vec_id, i, floor({SCALE} * x::DOUBLE)::BIGINT AS x FROM c JOIN ok USING (vec_id)),
s AS (SELECT q.vec_id AS query_id, v.vec_id, sum(q.x * v.x)::BIGINT AS score FROM v AS q JOIN v ON q.i = v.i
      WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id GROUP BY ALL)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
