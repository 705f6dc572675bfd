"""Exact substring dedup with fixed-block anchors.

A window of 50 words always holds a whole aligned block of 25 words, wherever the
blocks' grid starts.  So

1. every document's non-overlapping 25-word blocks are indexed by hash and every
   rolling 25-word window of every document probes the index;
2. a hit is extended to all 50-word windows that hold it, in both directions.
   Equal extensions are found by a 64-bit hash, and a window is repeated when a document
   with a smaller doc_id has it too.  (A comparison of the holders of a block, word by
   word, would put all holders of a common block into one task.);
3. repeated windows that touch are merged into maximal exact repeats, whose words
   are removed.

Windows are dealt by the least hash of their 5-word shingles: equal windows meet, and
neighbouring ones mostly travel together.  So hits come back as runs of windows, and their
number depends on the texts and not on the number of partitions.  Shingles that rule far
more windows than a partition should hold, as a sample of the documents tells, do not deal:
their windows go by their own hash.  The sample steers only where windows meet.

Probes travel packed: for each block of documents and each partition one row
holds 32-bit hash remainders and compressed positions, about six bytes a
probe.  The remainder decides candidates only; 50-word windows use 64 bits.
Hashes that several documents of a block share are settled
there and sent once for the block, so a passage in a third of all documents costs
one entry a block, not one a document.  Texts of documents without a hit are
never shuffled.

Defined results: null, empty and short texts (under 50 words) lose nothing; repeats
inside one document are no repeats; rows that repeat a doc_id are one document
for comparisons, and each loses only repeats of its own text; a null doc_id counts
as smaller than all others; an empty table gives an empty result; other input
columns pass through, ``kept_text``, ``n_words``, ``n_removed`` and ``spans`` are replaced.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .text_blocks import released
from .word_hashes import _KNOWN, mixed, window_hashes, word_hashes

WINDOW, BLOCK_WORDS = 50, 25
BLOCK_CHARS = 4_000_000               # texts of one block of documents
ENTRIES_PER_PARTITION = 1_500_000
BYTES_PER_WORD = 6
BROADCAST_IDS = 2_000_000
NULL_ID = -(1 << 63)
SHINGLE = 5
HOT_PARTS = 4                         # a shingle that rules as many windows as so many partitions does not deal
SAMPLE_RATE, SAMPLE_BYTES = 1 / 512, 16_000_000   # documents looked at for such shingles: the larger of both

PACKED = "part int, blob binary, pos binary, flags binary, ids binary, tags binary, starts binary, "\
         "doc_id long, tag long, start int, len int"
HITS = "doc_id long, tag long, start int, len int"


def _pack(a) -> bytes:
    """Ascending integers as compressed differences."""
    import numpy as np

    return zlib.compress(np.diff(a, prepend=a.dtype.type(0)).tobytes(), 1)


def _unpack(b: bytes, dtype):
    import numpy as np

    return np.cumsum(np.frombuffer(zlib.decompress(b), dtype), dtype=dtype)


class _Documents:
    """Word hashes of a block of documents that are long enough, one after the other.

    ``tags`` (hashes of the texts) tell rows with the same doc_id apart.
    """

    def __init__(self, ids, tags, texts):
        import numpy as np

        words = [word_hashes((t or "").encode("utf-8", "surrogatepass")) for t in texts]
        keep = [i for i, w in enumerate(words) if len(w) >= WINDOW]
        keep.sort(key=lambda i: ids[i])
        self.rows = keep
        self.ids = np.array([ids[i] for i in keep], dtype=np.int64)
        self.tags = np.array([tags[i] for i in keep], dtype=np.int64)
        self.lengths = np.array([len(words[i]) for i in keep], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1].astype(np.uint32)
        self.words = np.concatenate([words[i] for i in keep]) if keep else np.empty(0, np.uint64)
        self.doc = np.repeat(np.arange(len(keep)), self.lengths)

    def positions(self, width: int):
        """Start positions of all windows of ``width`` words that lie in one document."""
        import numpy as np

        left = np.repeat(self.starts + self.lengths, self.lengths) - np.arange(len(self.words))
        return np.flatnonzero(left >= width)


def _runs(order, *keys):
    """Start indexes of equal stretches of the ordered keys."""
    import numpy as np

    n = len(order)
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for k in keys:
            o = k[order]
            new[1:] |= o[1:] != o[:-1]
    return np.flatnonzero(new)


def _least_shingles(words, width: int):
    """Least hash of the shingles in every window of ``width`` words (windows may cross documents)."""
    import numpy as np

    low, have, want = window_hashes(words, SHINGLE), 1, width - SHINGLE + 1
    while have < want:
        step = min(have, want - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low


def _dealt(words, pos, own, width: int, hot, parts: int):
    """Partition of the windows at ``pos``: by their least shingle, by their own hash where that is hot."""
    import numpy as np

    least = _least_shingles(words, width)[pos]
    if len(hot):
        at = np.minimum(np.searchsorted(hot, least), len(hot) - 1)
        least = np.where(hot[at] == least, own, least)
    return (mixed(least ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(parts)).astype(np.int64)


def _run_bounds(pos, doc):
    """First index and length of every run of consecutive positions in one document (positions ascend)."""
    import numpy as np

    first = np.flatnonzero((np.diff(pos, prepend=-2) != 1) | (np.diff(doc, prepend=-1) != 0))
    return first, np.diff(np.append(first, len(pos)))


def _local_rows(docs: _Documents, pos, part: int):
    """Rows that carry runs of positions settled inside the block: (doc_id, tag, start, len)."""
    import numpy as np

    pos = np.sort(pos)
    which = docs.doc[pos]
    first, size = _run_bounds(pos, which)
    d = which[first]
    for i, g, a, n in zip(docs.ids[d].tolist(), docs.tags[d].tolist(), (pos[first] - docs.starts[d]).tolist(), size.tolist()):
        yield (part, None, None, None, None, None, None, i, g, a, n)


def _packed_rows(docs: _Documents, pos, low, part, flags, dtype):
    """One row for each partition with entries at ``pos``."""
    import numpy as np

    order = np.lexsort((pos, part))
    first = np.flatnonzero(np.diff(part[order], prepend=-1))
    for own in np.split(order, first[1:]) if len(order) else ():
        at = pos[own].astype(np.uint32)
        used = np.unique(docs.doc[at])
        yield (int(part[own[0]]), low[own].astype(dtype).tobytes(), _pack(at), np.packbits(flags[own]).tobytes(),
               _pack(docs.ids[used]), docs.tags[used].tobytes(), _pack(docs.starts[used]), None, None, None, None)


def _task() -> int:
    """Where the task's numbers begin, so that settled rows spread over the partitions."""
    from pyspark import TaskContext

    return TaskContext.get().partitionId() if TaskContext.get() else 0


def _blocks(batches):
    """(ids, tags, texts) of blocks of documents, bounded by characters."""
    ids, tags, texts, size = [], [], [], 0
    for batch in batches:
        for i, g, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tag", "text"))):
            if texts and size + len(t or "") > BLOCK_CHARS:
                yield ids, tags, texts
                ids, tags, texts, size = [], [], [], 0
            ids.append(NULL_ID if i is None else i)
            tags.append(g)
            texts.append(t)
            size += len(t or "")
    if texts:
        yield ids, tags, texts


def _arrow(rows):
    import pyarrow as pa

    kinds = (pa.int32(), *[pa.binary()] * 6, pa.int64(), pa.int64(), pa.int32(), pa.int32())
    names = [f.split()[0] for f in PACKED.split(", ")]
    cols = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def hot_shingles(docs: DataFrame, parts: int, size: int):
    """Sorted hashes of the shingles that rule too many windows; fewer than ``parts``."""
    import numpy as np

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for block in _blocks(batches):
            d = _Documents(*block)
            pos = d.positions(BLOCK_WORDS)
            least, n = np.unique(_least_shingles(d.words, BLOCK_WORDS)[pos] if len(pos) else np.empty(0, np.uint64),
                                 return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(least.view(np.int64)), pa.array(n, pa.int64())],
                                             names=["least", "n"])

    rate = max(SAMPLE_RATE, SAMPLE_BYTES / max(size, 1))
    some = docs.where(F.pmod(F.xxhash64("doc_id", "tag", F.lit("route")), F.lit(1 << 20)) < int(rate * (1 << 20)))
    counts = materialize(some.mapInArrow(released(run, [_KNOWN]), "least long, n long").groupBy("least").agg(F.sum("n").alias("n")), "shingles")
    bound = (counts.agg(F.sum("n")).first()[0] or 0) * HOT_PARTS / parts
    rows = counts.where(F.col("n") > bound).select("least").collect()      # fewer than parts / HOT_PARTS rows
    return np.sort(np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64))


def anchor_probes(docs: DataFrame, parts: int, hot) -> DataFrame:
    """Packed probes (every rolling 25-word window, flagged when it is an aligned block); ``hot`` is broadcast."""
    def run(batches):
        import numpy as np

        for number, block in enumerate(_blocks(batches), _task()):
            d = _Documents(*block)
            if not len(d.words):
                continue
            pos = d.positions(BLOCK_WORDS)
            h = window_hashes(d.words, BLOCK_WORDS)[pos]
            aligned = (pos - d.starts[d.doc[pos]]) % BLOCK_WORDS == 0
            order = np.argsort(h, kind="stable")
            first = _runs(order, h)
            size = np.diff(np.append(first, len(order)))
            last = order[first + size - 1]
            several = d.ids[d.doc[pos[order[first]]]] != d.ids[d.doc[pos[last]]]   # positions ascend with doc_id
            shared = np.repeat(several, size)
            any_aligned = np.repeat(np.add.reduceat(aligned[order].astype(int), first) > 0, size)
            # shared by documents of this block: settled here, one entry tells the other blocks
            yield _arrow(list(_local_rows(d, pos[order[shared]], number % parts)))
            send = ~shared
            send[first[several]] = True
            own = order[send]
            flags = np.stack([any_aligned[send], ~shared[send]], axis=1)
            part = _dealt(d.words, pos[own], h[own], BLOCK_WORDS, hot.value, parts)
            yield _arrow(list(_packed_rows(d, pos[own], h[own] & np.uint64(0xFFFFFFFF), part, flags, np.uint32)))

    return docs.mapInArrow(released(run, [_KNOWN]), PACKED)


def _entries(table, dtype):
    """All packed entries of a partition: hash, row, document index, offset, flags, doc ids and tags."""
    import numpy as np

    hs, rows, docs, offs, flags, ids, tags, base = [], [], [], [], [], [], [], 0
    cols = {c: table.column(c).to_pylist() for c in ("blob", "pos", "flags", "ids", "tags", "starts")}
    for i, blob in enumerate(cols["blob"]):
        if blob is None:
            continue
        h = np.frombuffer(blob, dtype)
        pos, starts = _unpack(cols["pos"][i], np.uint32), _unpack(cols["starts"][i], np.uint32)
        own = _unpack(cols["ids"][i], np.int64)
        d = np.searchsorted(starts, pos, "right") - 1
        hs.append(h)
        rows.append(np.full(len(h), i))
        docs.append(base + d)
        offs.append(pos - starts[d])
        flags.append(np.unpackbits(np.frombuffer(cols["flags"][i], np.uint8), count=2 * len(h)).reshape(-1, 2))
        ids.append(own)
        tags.append(np.frombuffer(cols["tags"][i], np.int64))
        base += len(own)
    if not hs:
        return None
    return [np.concatenate(x) for x in (hs, rows, docs, offs, flags, ids, tags)]


def _hit_table(ids, tags, docs, offs, table):
    """Arrow table (doc_id, tag, start, len): runs of the hit entries, then the rows settled before."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    order = np.lexsort((offs, docs))
    docs, offs = docs[order], offs[order].astype(np.int64)
    first, size = _run_bounds(offs, docs)
    own = pa.table({"doc_id": pa.array(ids[docs[first]], pa.int64()), "tag": pa.array(tags[docs[first]], pa.int64()),
                    "start": pa.array(offs[first], pa.int32()), "len": pa.array(size, pa.int32())})
    settled = table.select(own.column_names).filter(pc.is_valid(table.column("doc_id")))
    return pa.concat_tables([own, settled.cast(own.schema)])


def match_anchors(probes: DataFrame) -> DataFrame:
    """Offsets of 25-word windows that hit a block of another document, or are a block that is hit."""
    def run(table):
        import numpy as np

        got = _entries(table, np.uint32)
        if got is None:
            return _hit_table(*[np.empty(0, np.int64)] * 4, table)
        h, row, doc, off, flags, ids, tags = got
        order = np.argsort(h, kind="stable")
        first = _runs(order, h)
        size = np.diff(np.append(first, len(order)))
        blocks = np.add.reduceat(flags[order, 0].astype(int), first) > 0
        # other documents of the same row, or other rows
        owners = ids[doc[order]]
        differs = np.maximum.reduceat(owners, first) != np.minimum.reduceat(owners, first)
        hit = np.repeat(blocks & differs, size)
        use = order[hit]
        use = use[flags[use, 1] == 1]
        return _hit_table(ids, tags, doc[use], off[use], table)

    return probes.groupBy("part").applyInArrow(run, HITS)


def _runs_column(column):
    """Start and length arrays of every row of a column of runs (null: none)."""
    import numpy as np

    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    flat = column.flatten()
    starts, sizes = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
    ends = np.cumsum([0 if n is None else n for n in column.value_lengths().to_pylist()], dtype=np.int64)
    return list(zip(np.split(starts, ends[:-1]), np.split(sizes, ends[:-1]))) if len(ends) else []


def window_candidates(docs: DataFrame, parts: int, hot) -> DataFrame:
    """Packed 50-word windows that extend hits; ``docs`` is (doc_id, tag, text, runs of hits)."""
    def run(batches):
        import numpy as np

        def cut():
            rows, size = [], 0
            for batch in batches:
                for r in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tag", "text")),
                             _runs_column(batch.column("runs"))):
                    if rows and size + len(r[2] or "") > BLOCK_CHARS:
                        yield rows
                        rows, size = [], 0
                    rows.append(r)
                    size += len(r[2] or "")
            if rows:
                yield rows

        for number, rows in enumerate(cut(), _task()):
            d = _Documents(*([r[c] for r in rows] for c in range(3)))
            if not len(d.words):
                continue
            near = np.zeros(len(d.words) + 1, np.int32)
            for k, i in enumerate(d.rows):
                first, size = rows[i][3]
                last = np.minimum(first + size - 1, d.lengths[k] - BLOCK_WORDS)   # of windows of this text
                first, last = first[first <= last], last[first <= last]
                # a window holds a hit when it starts at most 25 words before it
                np.add.at(near, d.starts[k] + np.maximum(first - (WINDOW - BLOCK_WORDS), 0), 1)
                np.add.at(near, d.starts[k] + last + 1, -1)
            pos = d.positions(WINDOW)
            pos = pos[np.cumsum(near)[pos] > 0]
            if not len(pos):
                continue
            w = window_hashes(d.words, WINDOW)[pos]
            order = np.argsort(w, kind="stable")
            first = _runs(order, w)
            size = np.diff(np.append(first, len(order)))
            owner = d.ids[d.doc[pos]]
            least = np.repeat(owner[order[first]], size)          # positions ascend with doc_id
            later = owner[order] != least
            yield _arrow(list(_local_rows(d, pos[order[later]], number % parts)))
            own = order[~later]
            part = _dealt(d.words, pos[own], w[own], WINDOW, hot.value, parts)
            flags = np.ones((len(own), 2), bool)
            yield _arrow(list(_packed_rows(d, pos[own], w[own], part, flags, np.uint64)))

    return docs.mapInArrow(released(run, [_KNOWN]), PACKED)


def match_windows(candidates: DataFrame) -> DataFrame:
    """Offsets of the 50-word windows that a document with a smaller doc_id has too."""
    def run(table):
        import numpy as np

        got = _entries(table, np.uint64)
        if got is None:
            return _hit_table(*[np.empty(0, np.int64)] * 4, table)
        h, _, doc, off, _, ids, tags = got
        order = np.argsort(h, kind="stable")
        first = _runs(order, h)
        owner = ids[doc[order]]
        least = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.append(first, len(order))))
        use = order[owner > least]
        return _hit_table(ids, tags, doc[use], off[use], table)

    return candidates.groupBy("part").applyInArrow(run, HITS)


def _by_document(hits: DataFrame) -> DataFrame:
    return hits.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "len")).alias("runs"))


def substring_dedup(docs: DataFrame, text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Add ``n_words, n_removed, spans`` (start and length in words of each removed repeat) and ``kept_text``.

    ``kept_text`` is the text itself when nothing is removed, else the kept words
    joined by one space.  ``parts`` sets the number of partitions that windows are dealt to.
    """
    keep = [c for c in docs.columns if c not in ("n_words", "n_removed", "spans", "kept_text")]
    mark = "__"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    row_id, row_tag, row_text, row_runs, hit, hit_tag = (mark + c for c in ("id", "tag", "text", "runs", "hit", "hit_tag"))
    rows = docs.select(*keep, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias(row_id),
                       F.col(text_col).cast("string").alias(row_text)).withColumn(row_tag, F.xxhash64(row_text))
    texts = rows.select(F.col(row_id).alias("doc_id"), F.col(row_tag).alias("tag"), F.col(row_text).alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = parts or max(8, -(-size // (BYTES_PER_WORD * ENTRIES_PER_PARTITION)))
    hot = docs.sparkSession.sparkContext.broadcast(hot_shingles(texts, parts, size))
    hits = materialize(_by_document(match_anchors(anchor_probes(texts, parts, hot))), "anchor-hits")
    # equal rows of a doc_id share the runs, rows with other texts have their own
    n_hit, ids = hits.count(), hits.select(F.col("doc_id").alias(hit))
    ids = F.broadcast(ids) if n_hit <= BROADCAST_IDS else ids
    touched = rows.join(ids, F.col(row_id) == F.col(hit), "left_semi")
    clean = rows.join(ids, F.col(row_id) == F.col(hit), "left_anti")

    def attached(found: DataFrame, how: str) -> DataFrame:
        found = found.select(F.col("doc_id").alias(hit), F.col("tag").alias(hit_tag), F.col("runs").alias(row_runs))
        return touched.join(found, (F.col(row_id) == F.col(hit)) & (F.col(row_tag) == F.col(hit_tag)), how)

    found = attached(hits, "inner").select(F.col(row_id).alias("doc_id"), F.col(row_tag).alias("tag"),
                                           F.col(row_text).alias("text"), F.col(row_runs).alias("runs"))
    repeats = materialize(_by_document(match_windows(window_candidates(found, parts, hot))), "repeats")
    marked = attached(repeats, "left").select(*keep, row_text, row_runs)
    clean = clean.select(*keep, row_text, F.lit(None).cast(hits.schema["runs"].dataType).alias(row_runs))
    return _removed(clean, keep, row_text, row_runs).unionByName(_removed(marked, keep, row_text, row_runs))


def _removed(rows: DataFrame, keep: list[str], row_text: str, row_runs: str) -> DataFrame:
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("len", T.IntegerType())]))
    schema = T.StructType([rows.schema[c] for c in keep] + [
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("spans", span), T.StructField("kept_text", T.StringType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int32()), ("len", pa.int32())]))
        for batch in batches:
            n_words, n_removed, spans, kept = [], [], [], []
            for text, (first, size) in zip(batch.column(row_text).to_pylist(), _runs_column(batch.column(row_runs))):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                n_words.append(len(words))
                if not len(first):
                    n_removed.append(0)
                    spans.append([])
                    kept.append(text)
                    continue
                edge = np.zeros(len(words) + 1, np.int32)
                last = np.minimum(first + size - 1, len(words) - WINDOW)
                first, last = first[first <= last], last[first <= last]
                np.add.at(edge, first, 1)
                np.add.at(edge, last + WINDOW, -1)
                cover = np.cumsum(edge)[:-1] > 0
                n_removed.append(int(cover.sum()))
                step = np.flatnonzero(np.diff(np.concatenate([[0], cover.astype(np.int8), [0]])))
                spans.append([{"start": int(a), "len": int(b - a)} for a, b in zip(step[::2], step[1::2])])
                kept.append(text if not cover.any() else b" ".join(
                    w for w, c in zip(words, cover) if not c).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(keep).columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(spans, kind), pa.array(kept, pa.string())],
                names=[*keep, "n_words", "n_removed", "spans", "kept_text"])

    return rows.mapInArrow(released(run, [_KNOWN]), schema)


def op6_block_anchors(spark, sf_dir: str) -> DataFrame:
    out = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    words = F.array_remove(F.split(F.coalesce("kept_text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.array_join(words, " ").cast("binary"), 256).alias("kept_sha256"))


def oracle_sql() -> str:
    return rf"""
WITH w AS (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i FROM (
    SELECT doc_id, unnest(p) AS word, generate_subscripts(p, 1) AS k FROM (
      SELECT doc_id, string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') AS p FROM documents)) WHERE word <> ''),
g AS (SELECT doc_id, i, md5(string_agg(word, ' ') OVER o) AS h, count(*) OVER o AS c FROM w
      WINDOW o AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS m FROM g WHERE c = {WINDOW})
      WHERE m < doc_id),
k AS (SELECT w.*, max(r.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS last FROM w LEFT JOIN r USING (doc_id, i))
SELECT d.doc_id, count(k.i)::BIGINT AS n_words,
  count(*) FILTER (WHERE k.i - k.last < {WINDOW})::BIGINT AS n_removed,
  sha256(coalesce(string_agg(k.word, ' ' ORDER BY k.i) FILTER (WHERE k.last IS NULL OR k.i - k.last >= {WINDOW}), ''))
    AS kept_sha256
FROM documents AS d LEFT JOIN k USING (doc_id) GROUP BY d.doc_id
"""
