"""Conversation prefix trie with subtree totals by depth-band rollup (DataFrame functions only).

A node is a distinct sequence of a conversation's first d turns; its members are the
conversations that start with it, and the smallest member names it: ``(conv_id,
depth)`` is the node's key.  Sequences meet by two 64-bit hashes, each the exclusive
or of hashes of (place, role, text), so that prefixes of a long conversation come
from running aggregates; 128 bits stand for a sequence.

Every conversation knows the names of the nodes on its path.  Totals over subtrees:

1. depths are cut into bands of ``BAND``; a path's piece inside a band is one short
   array.  The nodes that a conversation names add up along its array from the
   deepest, and the sums explode to the ancestors inside the band, at most ``BAND``
   rows a piece;
2. the band roots, whose totals are then complete but for deeper bands, form a trie of
   their own, one level a band: the same rollup runs on it, so that their
   completed totals are found in log(depth) rounds;
3. each completed root total is added, in one more explosion, to the ancestors
   inside the band above.

Turns come in order of ``(turn, role, text)``, null turn first; positions, prefix
hashes and path pieces are made in two levels, so that a very long conversation is
spread over tasks.

Defined results: null role and text count as empty; rows without a conv_id belong to
no conversation and are left out; repeated rows are repeated turns; an empty table
gives no rows; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BAND = 16
BLOCK = 256           # turns of a conversation that one window partition holds
END_BLOCK = 4096      # conv_ids of a node's ends are joined in such ranges first
KEY = ["owner", "depth"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, role, text``: the turns' places (from 1) in their conversations."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / BLOCK).cast("long"), F.lit(-(1 << 62))).alias("block"))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offset = turns.groupBy("conv_id", "block").count().select(
        "conv_id", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    return turns.withColumn("rn", F.row_number().over(inside)).join(offset, ["conv_id", "block"]).select(
        "conv_id", (F.col("rn") + F.col("offset")).alias("pos"), "role", "text")


def trie_paths(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Path of every conversation: ``conv_id, depth, owner, n_convs, n_ends, chars`` (the root's row included).

    ``turns`` is ``conv_id, pos, role, text`` with dense positions from 1; ``lengths`` is ``conv_id, n``,
    one row a conversation, also of those without a turn.
    """
    place = F.col("pos").cast("long")
    steps = turns.select(
        "conv_id", place.alias("depth"), F.xxhash64(place, "role", "text").alias("a"),
        F.xxhash64("text", F.lit("prefix"), "role", place).alias("b"), F.char_length("text").cast("long").alias("chars"),
        F.call_function("div", place, F.lit(BLOCK)).alias("block"))
    run = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = steps.groupBy("conv_id", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    earlier = blocks.select("conv_id", "block", *[
        F.coalesce(F.bit_xor(c).over(before), F.lit(0).cast("long")).alias(f"before_{c}") for c in ("a", "b")])
    steps = steps.withColumns({c: F.bit_xor(c).over(run) for c in ("a", "b")}).join(earlier, ["conv_id", "block"])
    steps = steps.select("conv_id", "depth", "chars", *[
        F.col(c).bitwiseXOR(F.col(f"before_{c}")).alias(c) for c in ("a", "b")])
    steps = materialize(steps.join(lengths, "conv_id"), "trie-steps")

    nodes = steps.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"),
        F.count_if(F.col("depth") == F.col("n")).alias("n_ends"))
    # nodes with more members than two average partitions have rows: fewer than half as many as partitions
    nodes = materialize(nodes, "trie-members")
    shares = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    common = F.col("n_convs") > 2 * steps.count() // shares + 1
    few, key = F.broadcast(nodes.where(common)), ["depth", "a", "b"]
    paths = steps.join(few, key).unionByName(
        steps.join(few, key, "left_anti").join(nodes.where(~common), key).select(*steps.columns, "owner", "n_convs", "n_ends")
    ).select("conv_id", "depth", "owner", "n_convs", "n_ends", "chars")
    # the root belongs to every conversation: two numbers, no join on one key
    top = lengths.agg(F.min("conv_id"), F.count(F.lit(1)), F.count_if(F.col("n") == 0)).first()
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv_id", zero.alias("depth"), *[
        F.lit(v).cast("long").alias(n) for v, n in zip(top, ("owner", "n_convs", "n_ends"))], zero.alias("chars"))
    return paths.unionByName(roots)


def _pieces(paths: DataFrame, band: int) -> DataFrame:
    """``conv_id, band, path`` (array of depth and owner, by depth): a conversation's path inside each band."""
    return (paths.withColumn("band", F.call_function("div", F.col("depth"), F.lit(band))).groupBy("conv_id", "band")
            .agg(F.sort_array(F.collect_list(F.struct("depth", "owner"))).alias("path")))


def subtree_totals(paths: DataFrame, gains: DataFrame, values: list[str], max_depth: int, band: int = BAND) -> DataFrame:
    """Sums of ``values`` over every node's subtree: ``owner, depth, *values``.

    ``paths`` is ``conv_id, depth, owner``; ``gains`` is ``owner, depth, *values`` with a row for every node.
    """
    pieces = materialize(_pieces(paths.select("conv_id", "depth", "owner"), band), "trie-pieces")
    # the nodes a conversation names are the deep end of its piece: sums from the deepest up, then to all above
    named = gains.withColumn("band", F.call_function("div", F.col("depth"), F.lit(band))).groupBy(
        F.col("owner").alias("conv_id"), "band").agg(F.collect_list(F.struct("depth", *values)).alias("named"))
    rows = pieces.join(named, ["conv_id", "band"]).select(F.explode("path").alias("at"), "named")

    def below(v: str) -> Column:
        return F.reduce("named", F.lit(0).cast("long"), lambda s, g: s + F.when(
            g["depth"] >= F.col("at.depth"), g[v]).otherwise(F.lit(0)))

    inside = rows.select("at.owner", "at.depth", *[below(v).alias(v) for v in values])
    inside = inside.groupBy(*KEY).agg(*[F.sum(v).alias(v) for v in values])
    if max_depth < band:
        return inside
    inside = materialize(inside, "trie-bands")
    up = F.call_function("div", F.col("depth"), F.lit(band))
    of_roots = F.col("depth") % band == 0
    done = subtree_totals(paths.where(of_roots).withColumn("depth", up), inside.where(of_roots).withColumn("depth", up),
                          values, max_depth // band, band)
    # a completed root's total goes to the nodes above it inside the band before
    added = done.where("depth > 0").select(F.col("owner").alias("conv_id"), (F.col("depth") - 1).alias("band"), *values)
    added = pieces.join(added, ["conv_id", "band"]).select(F.explode("path").alias("at"), *values)
    added = added.select("at.owner", "at.depth", *values)
    return inside.unionByName(added).groupBy(*KEY).agg(*[F.sum(v).alias(v) for v in values])


def prefix_trie(turns: DataFrame, lengths: DataFrame, band: int = BAND) -> DataFrame:
    """One row a node: ``owner, depth, parent_owner, n_convs, n_children, n_leaves, saved_tokens, ends``.

    ``saved_tokens`` counts what storing each node's last text once saves over the subtree;
    ``ends`` holds the conv_ids that end at the node, ascending, as text joined by commas.
    Inputs as for :func:`trie_paths`.
    """
    paths = materialize(trie_paths(turns, lengths), "trie-paths")
    deepest = paths.agg(F.max("depth")).first()[0] or 0
    nodes = paths.where("conv_id = owner").select(
        *KEY, "n_convs", F.when(F.col("n_ends") == F.col("n_convs"), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    values = ["n_leaves", "saved_tokens"]
    totals = subtree_totals(paths, nodes.select(*KEY, *values), values, deepest, band)

    # the node above: the same conversation's row one depth higher
    above = paths.select(F.col("conv_id").alias("owner"), (F.col("depth") + 1).alias("depth"),
                         F.col("owner").alias("parent_owner"))
    nodes = materialize(nodes.drop(*values).join(above, KEY, "left"), "trie-nodes")
    children = nodes.where("depth > 0").groupBy(
        F.col("parent_owner").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))

    ended = paths.join(lengths, "conv_id").where("depth = n").groupBy(
        *KEY, F.floor(F.col("conv_id") / END_BLOCK).alias("range")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    ended = ended.groupBy(*KEY).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("range", "ids"))), lambda r: r["ids"]), ",").alias("ends"))
    return (nodes.join(totals, KEY).join(children, KEY, "left").join(ended, KEY, "left").select(
        *KEY, "parent_owner", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), *values,
        F.coalesce("ends", F.lit("")).alias("ends")))


def shared_starts(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The query's rebuilt conversations, as :func:`prefix_trie` takes them.

    Conversation c gets the first h turns of conversation ``c - c % 100`` and, after its own
    first h, its own, with h = crc32 of c's decimal text, modulo 6.
    """
    own = materialize(turns, "trie-turns")
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    base = F.col("conv_id") - F.col("conv_id") % 100
    # all of a base with fewer turns; bases have 100 followers at most
    plan = materialize(sizes.select("conv_id", "n", h.alias("h"), base.alias("base")).join(
        sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("of_base")), "base", "left").select(
        "conv_id", "base", "n", "h", F.least("h", F.coalesce("of_base", F.lit(0))).alias("taken")), "trie-plan")
    borrowed = plan.where("taken > 0").select("conv_id", "base", F.explode(F.sequence(
        F.lit(1).cast("long"), "taken")).alias("pos"))
    first = own.where("pos <= 5").select(F.col("conv_id").alias("base"), "pos", "role", "text")
    borrowed = borrowed.join(first, ["base", "pos"]).select("conv_id", "pos", "role", "text")
    rest = own.join(plan.select("conv_id", "h", "taken"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "role", "text")
    lengths = plan.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return borrowed.unionByName(rest), lengths


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    trie = prefix_trie(*shared_starts(ordered_turns(conversations)))
    return trie.select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent_owner").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.sha2(F.col("ends").cast("binary"), 256).alias("ends_sha256"))


def oracle_sql() -> str:
    crc = ("xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), "
           "lambda c: ascii(c)::BIGINT), lambda s, c: list_reduce([xor(s, c)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], "
           "lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))")
    return f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
      PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base, {crc} % 6 AS h FROM t GROUP BY conv_id),
p AS (SELECT s.*, least(h, coalesce(b.n, 0)) AS taken FROM s LEFT JOIN (SELECT conv_id AS base, n FROM s) AS b USING (base)),
r AS (SELECT p.conv_id, t.pos, t.role, t.text FROM p JOIN t ON t.conv_id = p.base AND t.pos <= p.taken
      UNION ALL SELECT p.conv_id, taken + pos - h, role, text FROM p JOIN t USING (conv_id) WHERE pos > h),
k AS (SELECT conv_id, pos AS depth, md5(string_agg(length(role) || ' ' || role || length(text) || ' ' || text, '') OVER (
        PARTITION BY conv_id ORDER BY pos)) AS key, length(text) AS chars FROM r
      UNION ALL SELECT conv_id, 0, '', 0 FROM p),
m AS (SELECT *, min(conv_id) OVER (PARTITION BY depth, key) AS owner, count(*) OVER (PARTITION BY depth, key) AS n_convs,
        max(depth) OVER (PARTITION BY conv_id) AS n FROM k),
nodes AS (SELECT owner, depth, any_value(n_convs) AS n_convs, count(*) FILTER (WHERE depth = n) = any_value(n_convs) AS leaf,
        (any_value(n_convs) - 1) * any_value(chars) AS saved,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = n), '')) AS ends
      FROM m GROUP BY owner, depth),
c AS (SELECT nodes.*, m.owner AS parent FROM nodes LEFT JOIN m ON m.conv_id = nodes.owner AND m.depth = nodes.depth - 1),
x AS (SELECT m.owner, m.depth, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved) AS saved
      FROM nodes JOIN m ON m.conv_id = nodes.owner AND m.depth <= nodes.depth GROUP BY ALL),
f AS (SELECT parent AS owner, depth - 1 AS depth, count(*) AS n_children FROM c WHERE depth > 0 GROUP BY ALL)
SELECT c.owner AS conv_id, c.depth::BIGINT AS depth, c.parent AS parent_conv_id, n_convs::BIGINT AS n_convs,
  coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, x.saved::BIGINT AS saved_tokens,
  c.ends AS ends_sha256
FROM c JOIN x USING (owner, depth) LEFT JOIN f USING (owner, depth)
"""
