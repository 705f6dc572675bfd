"""Byte-level BPE by corpus-level merge replay.

1. Texts are cut into pieces by the tokenizer's pattern.  Every worker knows the pieces
   that are tokens themselves.  The corpus's other recurring pieces are counted, partially where they are read (a piece that stands once in its
   batch of ``COUNTED`` distinct ones does not recur there), and dealt by hash.
2. Each hash part replays the merges over its share of the ``STORED`` most frequent
   pieces: an inverted index from the
   rank of a mergeable token pair to the positions where it stands is worked off in
   ascending rank order over all words at once, and a merge touches only the two
   neighbours of the merged pair, whose new pairs enter the index.  So these pieces
   are replayed once for the whole corpus.
3. Their ids are broadcast (a bound that does not grow with the data) to where the texts
   are read, so no text and no piece list of a text is shuffled.  Rarer pieces are replayed,
   with the same code, over the block of texts in which they stand.

Two details keep the result equal to encoding each piece on its own: a piece
that is itself a token is that token, and when a merge creates a pair of lower
rank in a word, that word's remaining merges of the current rank wait for it.

Texts without characters beyond U+FFFF are cut by Python's ``re``, in half the time, with the
character classes written out as the regex module has them (see :func:`plain_pattern`); others,
and patterns that use more, by the regex module.

Long texts are cut into pieces step by step.  A piece beyond ``LONG_PIECE`` bytes is
encoded in windows: two encodings that meet at a token boundary are one encoding
when the two tokens there are the encoding of their joint bytes, which is checked for
every seam.

Null text counts as empty and gives no ids; repeated rows are encoded one by one; an
empty table gives an empty result; other input columns pass through, except that
result columns replace columns of the same name.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array
from heapq import heapify, heappop, heappush
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .text_blocks import released, text_blocks

STORED = 200_000            # pieces of the corpus that are broadcast with their ids
KEPT = 150_000              # rarer pieces that a worker keeps between blocks
PIECE_CHARS = 64            # longer pieces are neither counted nor kept
COUNTED = 100_000           # distinct pieces a task counts before it passes them on
REPLAY_BYTES = 1 << 18      # words of one replay
LONG_PIECE = 1 << 20
LONG_TEXT = 4_000_000       # characters from which a text is cut step by step
STEP_PIECES = 100_000


#: What `plain_pattern` takes: the classes it writes out, and what both modules read alike.
_PARTS = re.compile(r"(\\p\{[LN]\}|\\[sS])|(\[\^?)|(\])|\\[rnt]|\(\?[:=!]|\(\?<[=!]|\((?!\?)|[)|]|[?*+][+?]?|\{\d+(?:,\d*)?\}|[^\\()\[\]{}?*+^$.&~-]")


@functools.cache
def _ranges(name: str) -> str:
    """The characters up to U+FFFF of a class of the regex module, as ranges for a set of ``re``."""
    import regex

    found = sorted(map(ord, regex.findall(name, "".join(map(chr, range(1 << 16))))))
    out, first = [], None
    for at, c in enumerate(found):
        first = c if first is None else first
        if at + 1 == len(found) or found[at + 1] != c + 1:
            out.append(f"\\u{first:04x}-\\u{c:04x}")
            first = None
    return "".join(out)


def plain_pattern(pattern: str) -> str | None:
    """``pattern`` for ``re``, which cuts texts of characters up to U+FFFF as the regex module does; None if it may not."""
    out, at, inside = [], 0, False
    while at < len(pattern):
        part = _PARTS.match(pattern, at)
        if not part or inside and (part[2] or part[1] == r"\S"):
            return None
        if part[2] or part[3]:
            inside = bool(part[2])
        if part[1] == r"\S":
            out.append(f"[^{_ranges(chr(92) + 's')}]")
        elif part[1]:
            out.append(_ranges(part[1]) if inside else f"[{_ranges(part[1])}]")
        else:
            out.append(part[0])
        at = part.end()
    return None if inside else "".join(out)


@functools.cache
def piece_finder(pattern: str):
    """A function that gives the list of a text's pieces."""
    import regex

    every, plain = regex.compile(pattern).findall, plain_pattern(pattern)
    if plain is None:
        return every
    quick = re.compile(plain).findall

    def pieces(text: str) -> list[str]:
        if text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text):
            return quick(text)
        return every(text)

    return pieces


def token_pieces(ranks: dict[bytes, int]) -> dict[str, bytes]:
    """Packed ids of the pieces that are tokens themselves."""
    out = {}
    for raw, i in ranks.items():
        try:
            piece = raw.decode("utf-8")
        except UnicodeDecodeError:
            continue        # a part of a character
        if len(piece) <= PIECE_CHARS:
            out[piece] = array("i", (i,)).tobytes()
    return out


class MergeReplay:
    """Encoder of one rank file; ``ranks`` maps token bytes to ids, every single byte among them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, store: dict[str, bytes] | None = None):
        import numpy as np
        import regex

        self.ranks = ranks
        self.token_bytes: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.token_bytes[i] = b
        self.pattern = regex.compile(pattern)
        self.pieces = piece_finder(pattern)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        # rank of the token that a token and its right (left) neighbour make, by the token and the neighbour
        self.right_rank: dict[int, dict[int, int]] = {}
        self.left_rank: dict[int, dict[int, int]] = {}
        for t, r in ranks.items():
            for k in range(1, len(t)):
                if (a := ranks.get(t[:k])) is not None and (b := ranks.get(t[k:])) is not None:
                    self.right_rank.setdefault(a, {})[b] = r
                    self.left_rank.setdefault(b, {})[a] = r
        self.byte_pairs = np.array([[self.right_rank.get(ranks[bytes([a])], {}).get(ranks[bytes([b])], -1)
                                     for b in range(256)] for a in range(256)], dtype=np.int32)
        self.store = token_pieces(ranks) | (store or {})
        self.known = dict(self.store)          # ids as packed 32-bit integers

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Packed token ids of every word, by replaying all merges over the words together."""
        import numpy as np

        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes)
        starts, full = ends - sizes, sizes > 0
        after, before = np.arange(1, len(raw) + 1, dtype=np.int32), np.arange(-1, len(raw) - 1, dtype=np.int32)
        after[ends[full] - 1], before[starts[full]] = -1, -1
        # the index of the byte pairs: positions in ascending order, by rank
        at = np.flatnonzero(after >= 0).astype(np.int32)
        rank = self.byte_pairs[raw[at], raw[at + 1]]
        now = np.full(len(raw), -1, dtype=np.int32)
        now[at] = rank
        at, rank = at[rank >= 0], rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank, prepend=-1))
        first = dict(zip(rank[cuts].tolist(), zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)])))
        # Python lists are faster, packed arrays smaller
        kind = (lambda x: x.tolist()) if len(raw) <= REPLAY_BYTES else (lambda x: array("i", x.astype(np.int32).tobytes()))
        # `pair` is the rank of the pair that begins at a position, -1 if it makes no token or was taken by a merge
        tok, nxt, prv, pair, at, word = map(kind, (self.byte_ids[raw], after, before, now, at,
                                                   np.repeat(np.arange(len(words)), sizes)))
        index: dict[int, array] = {}        # positions that came up in the replay
        heap = list(first)
        heapify(heap)
        rights, lefts, no_ranks = self.right_rank, self.left_rank, {}

        while heap:
            r = heappop(heap)
            right, left = rights.get(r, no_ranks).get, lefts.get(r, no_ranks).get
            waiting, wait = -1, array("i")
            a, b = first.pop(r, (0, 0))
            held, new = at[a:b], index.pop(r, None)
            for i in sorted([*held, *new]) if new else held:
                if pair[i] != r:
                    continue  # an earlier merge took one of the two
                if word[i] == waiting:
                    wait.append(i)
                    continue
                j, p = nxt[i], prv[i]
                k = nxt[j]
                tok[i], tok[j], pair[i], pair[j] = r, -1, -1, -1
                nxt[i] = k
                if k >= 0:
                    prv[k] = i
                    q = right(tok[k])
                    if q is not None:
                        pair[i] = q
                        if (entry := index.get(q)) is not None:
                            entry.append(i)
                        else:
                            index[q] = array("i", (i,))
                            if q not in first:
                                heappush(heap, q)
                        if q < r:
                            waiting = word[i]
                if p >= 0:
                    q = left(tok[p])
                    if q is None:
                        pair[p] = -1
                        continue
                    pair[p] = q
                    if (entry := index.get(q)) is not None:
                        entry.append(p)
                    else:
                        index[q] = array("i", (p,))
                        if q not in first:
                            heappush(heap, q)
                    if q < r:
                        waiting = word[i]
            if wait:
                if r in index:
                    index[r].extend(wait)
                else:
                    index[r] = wait
                    heappush(heap, r)
        # what is left, in order, is the words' ids: merged positions are taken out
        left = np.asarray(tok, dtype=np.int32)
        stay = left >= 0
        ids, bounds = left[stay], np.concatenate([[0], np.cumsum(stay)])
        return [ids[bounds[a]:bounds[b]].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]

    def word_ids(self, raw: bytes) -> bytes:
        """Packed ids of one piece, in windows if it is long."""
        if (whole := self.ranks.get(raw)) is not None:
            return array("i", (whole,)).tobytes()
        if len(raw) <= 2 * LONG_PIECE:
            return self.replay([raw])[0]
        out, at, seam = [], 0, None
        window = array("i", self.replay([raw[:LONG_PIECE]])[0])
        while True:
            if at + LONG_PIECE >= len(raw):
                out.append(window.tobytes())
                return b"".join(out)
            cut = len(window) * 3 // 4
            while True:                      # the seam: the last token kept and the first of the next window
                if cut < 1:
                    raise ValueError("no seam found in a long piece")
                begin = at + sum(len(self.token_bytes[t]) for t in window[:cut])
                ahead = array("i", self.replay([raw[begin:begin + LONG_PIECE]])[0])
                seam = (window[cut - 1], ahead[0])
                joint = self.token_bytes[seam[0]] + self.token_bytes[seam[1]]
                if joint not in self.ranks and array("i", self.replay([joint])[0]).tolist() == list(seam):
                    break
                cut -= 1
            out.append(window[:cut].tobytes())
            at, window = begin, ahead

    def replay_all(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces, in replays of ``REPLAY_BYTES``."""
        out, todo, size = {}, [], 0

        def run():
            out.update(zip((w for w, _ in todo), self.replay([raw for _, raw in todo])))

        for w in words:
            raw = w.encode("utf-8", "surrogatepass")
            if len(raw) > LONG_PIECE or raw in self.ranks:
                out[w] = self.word_ids(raw)
                continue
            if todo and size + len(raw) > REPLAY_BYTES:
                run()
                todo, size = [], 0
            todo.append((w, raw))
            size += len(raw)
        if todo:
            run()
        return out

    def _joined(self, cut) -> list[bytes]:
        """Packed ids of lists of pieces; of those, only one list at a time is held."""
        out, late, missing = [], [], set()
        get = self.known.get
        for pieces in cut:
            ids = list(map(get, pieces))
            gaps = [k for k, x in enumerate(ids) if x is None]
            if not gaps:
                out.append(b"".join(ids))
                continue
            # ids, a missing piece, ids, a missing piece, ..., ids
            parts, at = [], 0
            for k in gaps:
                parts += (b"".join(ids[at:k]), pieces[k])
                at = k + 1
            parts.append(b"".join(ids[at:]))
            missing.update(parts[1::2])
            late.append((len(out), parts))
            out.append(b"")
        if late:
            found = self.replay_all(list(missing))
            if len(self.known) + len(found) > len(self.store) + KEPT:
                self.known = dict(self.store)
            self.known.update((w, x) for w, x in found.items() if len(w) <= PIECE_CHARS)
            for k, parts in late:
                parts[1::2] = map(found.__getitem__, parts[1::2])
                out[k] = b"".join(parts)
        return out

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as packed 32-bit integers."""
        if all(len(t) <= LONG_TEXT for t in texts):
            return self._joined(map(self.pieces, texts))
        return [self._joined([self.pieces(t)])[0] if len(t) <= LONG_TEXT else b"".join(
            self._joined([step])[0] for step in self.steps(t)) for t in texts]

    def steps(self, text: str):
        """The pieces of a long text, ``STEP_PIECES`` at a time."""
        found = (m.group() for m in self.pattern.finditer(text))
        while step := list(islice(found, STEP_PIECES)):
            yield step

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [array("i", b).tolist() for b in self.encode_packed(texts)]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


def read_ranks(rank_file: str) -> dict[bytes, int]:
    """Token ids of a rank file (one line per token: base64 bytes, rank)."""
    with open(rank_file, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def encoder(rank_file: str, pattern: str, held: dict) -> MergeReplay:
    """The encoder that lives in a broadcast value, so that a worker's tasks share it."""
    if "encoder" not in held:
        held["encoder"] = MergeReplay(read_ranks(rank_file), pattern, held.get("store"))
    return held["encoder"]


def recurring_pieces(texts: DataFrame, pattern: str, rank_file: str | None = None) -> DataFrame:
    """``piece, n``: pieces of the column ``text``, up to ``PIECE_CHARS``, that recur; ``n`` counts where they do.

    Pieces that are tokens of ``rank_file`` are left out: they need no replay.
    """
    def count(batches):
        from collections import Counter

        import pyarrow as pa
        import regex

        cut, pieces = regex.compile(pattern), piece_finder(pattern)
        tokens = token_pieces(read_ranks(rank_file)) if rank_file else {}
        seen: Counter = Counter()

        def passed():
            rows = [(w, n) for w, n in seen.items() if n > 1 and len(w) <= PIECE_CHARS and w not in tokens]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()),
                                               pa.array([n for _, n in rows], pa.int64())], names=["piece", "n"])

        for batch in batches:
            for _, block in text_blocks(batch, "text"):
                for t in block:
                    if len(t) <= LONG_TEXT:
                        seen.update(pieces(t))
                    else:
                        for m in cut.finditer(t):
                            if m.end() - m.start() <= PIECE_CHARS:
                                seen[m.group()] += 1
                    if len(seen) > COUNTED:
                        yield passed()
        yield passed()

    return texts.mapInArrow(released(count), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def most_frequent(pieces: DataFrame, bound: int) -> DataFrame:
    """The most frequent pieces, at most ``bound`` of them."""
    level = F.floor(F.log2(F.col("n").cast("double")) * 4).cast("int")
    sizes = {r["level"]: r["count"] for r in pieces.groupBy(level.alias("level")).count().collect()}  # 256 rows at most
    total, least = 0, None
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > bound:
            break
        least = at
    return pieces.where(level >= least) if least is not None else pieces.limit(0)


def corpus_store(texts: DataFrame, rank_file: str, pattern: str, bound: int, tokens: bool = True) -> dict[str, bytes]:
    """Packed ids of the corpus's most frequent pieces (column ``text``; without ``tokens``: of those that are
    no tokens), replayed where their hash deals them."""
    pieces = materialize(recurring_pieces(texts, pattern, None if tokens else rank_file), "pieces")
    held = texts.sparkSession.sparkContext.broadcast({})

    def replay(batches):
        import pyarrow as pa

        enc = encoder(rank_file, pattern, held.value)
        for batch in batches:
            words = batch.column("piece").to_pylist()
            ids = enc.replay_all(words)
            yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array([ids[w] for w in words], pa.binary())],
                                             names=["piece", "ids"])

    dealt = most_frequent(pieces, bound).select("piece").repartition("piece")
    rows = dealt.mapInArrow(released(replay), "piece string, ids binary").toArrow()      # at most `bound` rows
    return dict(zip(rows.column("piece").to_pylist(), rows.column("ids").to_pylist()))


def replaced(schema: T.StructType, keep: list[str] | None, **types: T.DataType) -> tuple[list[str], T.StructType]:
    """Names of the kept input columns that no result column replaces, and the result's schema."""
    own = [schema[n] for n in (schema.names if keep is None else keep) if n not in types]
    return [f.name for f in own], T.StructType(own + [T.StructField(n, t) for n, t in types.items()])


def unused(names, wanted: str) -> str:
    """``wanted``, made longer until it is not among ``names``."""
    while wanted in names:
        wanted += "_"
    return wanted


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text", out_col: str = "ids",
                     exact_col: str | None = None, digest_col: str | None = None,
                     keep: list[str] | None = None) -> DataFrame:
    """Add ``out_col`` (array<int>): ids of the whole text, no special tokens.

    The ids are decoded again in the same pass when asked: ``exact_col`` tells whether that
    gives the text's bytes, ``digest_col`` is the lower-case hex SHA-256 of the decoded bytes.  ``keep``
    names the input columns of the result (default: all); the text is sent to the workers once.
    ``docs`` is read twice, so an expensive plan should be written first.
    """
    types: dict[str, T.DataType] = {out_col: T.ArrayType(T.IntegerType())}
    if exact_col:
        types[exact_col] = T.BooleanType()
    if digest_col:
        types[digest_col] = T.StringType()
    keep, schema = replaced(docs.schema, keep, **types)
    # a kept text column is sent once and serves as the input
    alone = text_col in keep and isinstance(docs.schema[text_col].dataType, T.StringType)
    sent = text_col if alone else unused(docs.columns, "__text")
    rows = docs.select(*keep) if alone else docs.select(*keep, F.col(text_col).cast("string").alias(sent))
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast({"store": corpus_store(texts, rank_file, pattern, STORED, tokens=False)})

    def run(batches):
        from hashlib import sha256

        import numpy as np
        import pyarrow as pa

        enc = encoder(rank_file, pattern, held.value)
        enc.known = dict(enc.store)
        for batch in batches:
            own = batch.select(keep)
            for at, block in text_blocks(batch, sent):
                ids = enc.encode_packed(block)
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
                cols = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))]
                exact, digest = [], []
                if exact_col or digest_col:
                    for t, x in zip(block, ids):
                        back = enc.decode(array("i", x))
                        exact.append(back == t.encode("utf-8", "surrogatepass"))
                        digest.append(sha256(back).hexdigest() if digest_col else None)
                if exact_col:
                    cols.append(pa.array(exact, pa.bool_()))
                if digest_col:
                    cols.append(pa.array(digest, pa.string()))
                yield pa.RecordBatch.from_arrays([*own.slice(at, len(block)).columns, *cols], names=[*keep, *types])
        enc.known = {}          # the worker keeps the tables and the store alone

    return rows.mapInArrow(released(run), schema)


def decode_documents(encoded: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids",
                     out_col: str = "decoded") -> DataFrame:
    """Add ``out_col`` (binary): the bytes of the ids (null ids: empty)."""
    keep, schema = replaced(encoded.schema, None, **{out_col: T.BinaryType()})
    sent = unused(encoded.columns, "__ids")
    held = encoded.sparkSession.sparkContext.broadcast({})

    def run(batches):
        import pyarrow as pa

        enc = encoder(rank_file, pattern, held.value)
        for batch in batches:
            raw = [enc.decode(x or ()) for x in batch.column(sent).to_pylist()]
            own = batch.select(keep)
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(raw, type=pa.binary())], names=[*keep, out_col])

    return encoded.select(*keep, F.col(ids_col).alias(sent)).mapInArrow(released(run), schema)


def op4_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    enc = encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                           digest_col="decoded_sha256", keep=["doc_id"])
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
                      .alias("ids_sha256"), "decoded_sha256")
