"""Exact n-gram Jaccard join with a token-group matrix.

Documents are sets of word shingles; two link when ``100 * |A & B| >= 75 * |A | B|``.

1. Equal sets are one class, represented by its smallest doc_id.
2. Band keys of a minhash sketch partition similar classes into groups; every class
   is compared exactly with the leader of its best group, and linked classes form
   clusters.  This step only has to find most links: it keeps large groups of
   near copies together, so that their pairs need not be looked at.
3. Clusters are cut into groups of bounded size.  The matrix (token, group) holds each
   group's union of prefix tokens: with all tokens in one fixed order, the first
   ``n - ceil(0.75 n) + 1`` of two linked sets must meet, so a group without any of a
   query's prefix tokens has no partner for it.  The order puts tokens known to be
   frequent (from a sample) last; it decides speed only.
4. A query-group pair that passes is bounded by the overlap with the group's token
   union, first over hashed token columns, then over the tokens themselves; only
   qualifying groups are opened and their members compared exactly.
   Pairs inside a cluster are left out, since their component is known.

No link between different components is lost.  All exact comparisons are on 64-bit
shingle hashes.  A token or class shared by very many documents is pre-aggregated
or met by joins that Spark can split; queries of one group are dealt in chunks.

Defined results: null, empty and blank texts have no shingles and no links; repeated
rows share a node; rows with a null doc_id have no links and a null component; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .text_blocks import released
from .word_hashes import _KNOWN, window_hashes, word_hashes

WORDS, PERCENT = 5, 75
BANDS, BAND_ROWS = 8, 2
GROUP_SIZE, CHUNK = 64, 256
FREQUENT_TOKENS, SAMPLE_OF, FREQUENT_IN_SAMPLE = 100_000, 32, 3
BROADCAST_IDS = 2_000_000   # ids (8 bytes each) that may be broadcast

COLUMNS = 2048              # hashed token columns of the bounding matrix

SIG = "doc_id long, n long, set_hash binary, keys array<long>, prefix array<long>, counts binary"


def shingles(text: str | None):
    """Sorted distinct shingle hashes of a text (uint64)."""
    import numpy as np

    words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(WORDS, len(words))))


def needed(n):
    """Least overlap of a set of n tokens with any partner."""
    return (PERCENT * n + 99) // 100


def linked(inter, n, m):
    return 100 * inter >= PERCENT * (n + m - inter)


def frequent_tokens(docs: DataFrame):
    """Sorted array of at most FREQUENT_TOKENS tokens that are frequent in a sample of documents."""
    import numpy as np

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [shingles(t) for t in batch.column("text").to_pylist()]
            tokens, counts = np.unique(np.concatenate(found) if found else np.empty(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts.astype(np.int64))],
                                             names=["token", "c"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("order")), F.lit(SAMPLE_OF)) == 0).select("text")
    top = (sample.mapInArrow(released(run, [_KNOWN]), "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))
           .where(F.col("c") >= FREQUENT_IN_SAMPLE).orderBy(F.desc("c"), "token").limit(FREQUENT_TOKENS).select("token"))
    return np.sort(np.array([r[0] for r in top.collect()], dtype=np.int64).view(np.uint64))


def signatures(docs: DataFrame, frequent) -> DataFrame:
    """Per row: set size, set hash, band keys and prefix tokens."""
    import numpy as np

    # one-permutation minhash: the least token from each of these points on, cyclically
    points = np.arange(BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64((1 << 64) // (BANDS * BAND_ROWS))
    shared = docs.sparkSession.sparkContext.broadcast(frequent)   # at most FREQUENT_TOKENS numbers

    def run(batches):
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        often = shared.value
        for batch in batches:
            ns, hashes, keys, prefixes, counts = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                t = shingles(text)
                n = len(t)
                ns.append(n)
                hashes.append(xxh3_128_digest(t.tobytes()) if n else None)
                held = np.bincount((t >> np.uint64(53)).astype(int), minlength=COLUMNS)
                counts.append(zlib.compress(np.minimum(held, 255).astype(np.uint8).tobytes(), 1))
                if not n:
                    keys.append([])
                    prefixes.append([])
                    continue
                low = t[np.searchsorted(t, points) % n].reshape(BANDS, BAND_ROWS)
                keys.append((low[:, 0] * np.uint64(31) + low[:, 1]).view(np.int64).tolist())
                late = np.zeros(n, bool)
                if len(often):
                    at = np.minimum(np.searchsorted(often, t), len(often) - 1)
                    late = often[at] == t
                order = np.concatenate([t[~late], t[late]])
                prefixes.append(order[: n - needed(n) + 1].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ns, pa.int64()), pa.array(hashes, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(prefixes, pa.list_(pa.int64())),
                 pa.array(counts, pa.binary())],
                names=["doc_id", "n", "set_hash", "keys", "prefix", "counts"])

    return docs.select("doc_id", "text").mapInArrow(released(run, [_KNOWN]), SIG)


def _tokens_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, tokens`` (binary) of the rows with the given ids (column ``id``, distinct)."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw = [shingles(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(raw, pa.binary())],
                                             names=["id", "tokens"])

    n = ids.count()
    wanted = F.broadcast(ids) if n <= BROADCAST_IDS else ids
    found = docs.join(wanted, docs["doc_id"] == wanted["id"], "left_semi").select("doc_id", "text")
    return materialize(found.mapInArrow(released(run, [_KNOWN]), "id long, tokens binary"), "tokens")


def open_groups(docs: DataFrame, pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Links ``a, b`` between queries and members: ``pairs`` is (q, gid), ``members`` is (gid, id)."""
    pairs = materialize(pairs, "query-groups")
    opened = members.join(pairs.select("gid").distinct(), "gid", "left_semi")
    chunks = pairs.groupBy("gid").agg((F.floor(F.count(F.lit(1)) / CHUNK) + 1).cast("int").alias("chunks"))
    opened = materialize(opened.join(chunks, "gid"), "opened-groups")
    ids = opened.select("id").union(pairs.select(F.col("q").alias("id"))).distinct()
    tokens = _tokens_of(docs, ids)
    asked_tokens = tokens.select(F.col("id").alias("q"), F.col("tokens").alias("q_tokens"))
    asked = (pairs.join(chunks, "gid")
             .withColumn("chunk", F.pmod(F.xxhash64("q"), F.col("chunks")).cast("int"))
             .join(asked_tokens, "q").select("gid", "chunk", "q", "q_tokens"))
    held = (opened.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .join(tokens, "id").select(F.col("gid").alias("g"), F.col("chunk").alias("c"), "id", "tokens"))

    def run(key, group, queries):
        import numpy as np
        import pyarrow as pa

        found_a, found_b = [], []
        if group.num_rows and queries.num_rows:
            sets = [np.frombuffer(b, np.uint64) for b in group.column("tokens").to_pylist()]
            ids, sizes = group.column("id").to_numpy(), np.array([len(s) for s in sets])
            flat = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            union = np.unique(flat)
            for q, raw in zip(queries.column("q").to_pylist(), queries.column("q_tokens").to_pylist()):
                t = np.frombuffer(raw, np.uint64)
                if np.isin(t, union, assume_unique=True).sum() < needed(len(t)):
                    continue                                   # the union bounds every member
                left, right = np.searchsorted(flat, t, "left"), np.searchsorted(flat, t, "right")
                width = right - left
                at = np.repeat(left - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
                inter = np.bincount(owner[at], minlength=len(sets))
                hit = linked(inter, sizes, len(t)) & (ids != q)
                found_a += [q] * int(hit.sum())
                found_b += ids[hit].tolist()
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return held.groupBy("g", "c").cogroup(asked.groupBy("gid", "chunk")).applyInArrow(run, "a long, b long")


def _leader_pairs(classes: DataFrame) -> DataFrame:
    """(q, gid = leader) of each class's best band group."""
    keyed = classes.select("rep", F.posexplode("keys").alias("band", "key"))
    leaders = (keyed.groupBy("band", "key").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("c"))
               .where("c > 1").drop("c"))
    votes = (keyed.join(leaders, ["band", "key"]).where("rep <> leader")
             .groupBy("rep", "leader").agg(F.count(F.lit(1)).alias("votes")))
    best = votes.groupBy("rep").agg(F.max(F.struct("votes", (-F.col("leader")).alias("l"))).alias("best"))
    return best.select(F.col("rep").alias("q"), (-F.col("best.l")).alias("gid"))


def _columns(packed):
    """[rows, COLUMNS] token counts (255: 255 or more)."""
    import numpy as np

    return np.frombuffer(b"".join(map(zlib.decompress, packed.to_pylist())), np.uint8).reshape(-1, COLUMNS)


def _bounded(pairs: DataFrame, classes: DataFrame, grouped: DataFrame) -> DataFrame:
    """Pairs (q, gid, n, n_lo) whose overlap, bounded column by column, can reach the threshold.

    The matrix holds, for each group and hashed token column, the most tokens any
    member has there.  A query shares at most the column-wise minimum with a member.
    """
    def most(key, rows):
        import pyarrow as pa

        held = _columns(rows.column("counts"))
        return pa.table({"gid": pa.array([key[0].as_py()], pa.int64()),
                         "g_counts": pa.array([zlib.compress(held.max(axis=0).tobytes(), 1)], pa.binary())})

    def keep(batches):
        import numpy as np
        import pyarrow as pa

        # small slices: a row unpacks to twice COLUMNS bytes
        for batch in (b.slice(at, 1_000) for b in batches for at in range(0, b.num_rows, 1_000)):
            q, g = _columns(batch.column("counts")), _columns(batch.column("g_counts"))
            n, n_lo = (batch.column(c).to_numpy() for c in ("n", "n_lo"))
            least = np.maximum(needed(n), -(-PERCENT * (n + n_lo) // (100 + PERCENT)))
            low = np.minimum(q, g)
            ok = (low.sum(axis=1, dtype=np.int64) >= least) | (low == 255).any(axis=1)   # 255: "or more"
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("gid")], names=["q", "gid"]).filter(
                pa.array(ok))

    pairs = materialize(pairs, "prefix-pairs")
    named = grouped.join(pairs.select("gid").distinct(), "gid", "left_semi").select("gid", F.col("rep").alias("m"))
    counts = classes.select(F.col("rep").alias("m"), "counts")
    matrix = named.join(counts, "m").select("gid", "counts").groupBy("gid").applyInArrow(
        most, "gid long, g_counts binary")
    return (pairs.join(classes.select(F.col("rep").alias("q"), "counts"), "q").join(matrix, "gid")
            .mapInArrow(keep, "q long, gid long"))


def _group_pairs(labelled: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(q, gid) candidates between clusters by the token-group matrix, and the groups' members."""
    sizes = labelled.groupBy("label").agg((F.floor(F.count(F.lit(1)) / GROUP_SIZE) + 1).cast("int").alias("parts"))
    many = sizes.where("parts > 1")
    part = F.pmod(F.xxhash64("rep", F.lit("group")), F.coalesce(F.col("parts"), F.lit(1)))
    # sets of similar size share a group: linked sizes differ by a third at most
    bucket = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3)))
    grouped = (labelled.join(many, "label", "left")
               .select("rep", "label", "n", "prefix", F.xxhash64("label", part, bucket).alias("gid")))
    grouped = materialize(grouped, "grouped")
    tokens = grouped.select(F.explode("prefix").alias("token"), "rep", "label", "n", "gid")
    met = (tokens.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
           .where("lo < hi").select("token"))
    met = materialize(met, "shared-tokens")
    shared = materialize(tokens.join(F.broadcast(met) if met.count() <= BROADCAST_IDS else met, "token"), "matrix")
    matrix = shared.groupBy("token", "gid", "label").agg(F.min("n").alias("n_lo"), F.max("n").alias("n_hi"))
    matrix = matrix.withColumnRenamed("label", "g_label")
    asked = shared.select("token", F.col("rep").alias("q"), "label", "n")
    # from the side of the larger label only: the other side would give the same links
    pairs = (asked.join(matrix, "token").where((F.col("label") > F.col("g_label"))
                                               & (100 * F.col("n_hi") >= PERCENT * F.col("n"))
                                               & (PERCENT * F.col("n_lo") <= 100 * F.col("n")))
             .groupBy("q", "gid").agg(F.first("n").alias("n"), F.min("n_lo").alias("n_lo")))
    return _bounded(pairs, classes, grouped), grouped.select("gid", F.col("rep").alias("id"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sig = materialize(signatures(docs, frequent_tokens(docs)), "signatures")
    usable = sig.where("n > 0 AND doc_id IS NOT NULL")
    classes = materialize(usable.groupBy("set_hash").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"),
        F.first("prefix").alias("prefix"), F.first("counts").alias("counts"), F.count(F.lit(1)).alias("copies")), "classes")
    stars = materialize(open_groups(docs, _leader_pairs(classes), classes.select(
        F.col("rep").alias("gid"), F.col("rep").alias("id"))), "star-links")
    labels = components(stars)
    labelled = (classes.join(labels, F.col("rep") == labels["node"], "left")
                .select("rep", "n", "prefix", F.coalesce("label", "rep").alias("label")))
    pairs, members = _group_pairs(labelled, classes)
    links = materialize(open_groups(docs, pairs, members), "links")
    # copies: every row of a class with several is linked to its representative
    copies = (usable.join(classes.where("copies > 1").select("set_hash", "rep"), "set_hash")
              .where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    final = components(stars.unionByName(links).unionByName(copies))
    return (sig.select("doc_id", F.col("n").alias("n_shingles"))
            .join(final, F.col("doc_id") == final["node"], "left")
            .select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id")))


def op5_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def oracle_sql() -> str:
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i FROM (
    SELECT doc_id, unnest(p) AS word, generate_subscripts(p, 1) AS k FROM (
      SELECT doc_id, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') AS p FROM documents)) WHERE word <> ''),
g AS (SELECT doc_id, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
    lead(word, 4) OVER o) AS s, i, count(*) OVER (PARTITION BY doc_id) AS c FROM w
    WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(s) AS s FROM g WHERE i = 1 OR i <= c - 4),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s AS x JOIN s AS y
      ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b
      WHERE 100 * c >= {PERCENT} * (p.n + q.n - c)),
r AS (SELECT DISTINCT a AS x, a AS y FROM l UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a),
c AS (SELECT x, min(y) AS c FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.c, d.doc_id)::BIGINT AS component_id
FROM documents AS d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN c ON d.doc_id = c.x
"""
