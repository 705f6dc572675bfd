"""Token counts by rank-synchronous array merging.

The pre-tokens of a block of texts that were not counted before are laid out as
one ragged array of symbols.  In every round each sequence looks up its lowest
pair rank, and all sequences apply theirs at once: every occurrence of that pair,
from the left, becomes one symbol (overlapping occurrences alternate).  Only the
pairs beside a merge are looked up anew.  A sequence without a mergeable pair
leaves the arrays; what is left of it is its token count.

Applying all occurrences of the lowest pair at once equals one merge at a time,
because a pair that holds a merge's product always ranks after that merge;
:class:`RankMerger` checks this of its file and otherwise applies the leftmost
occurrence alone.  A pre-token is first cut between two bytes that stand side by
side in no token, which no merge can cross; so long runs without a space fall
into short sequences.

The text side follows the tokenizer file: special tokens are found in the raw
text and count one each, the rest is brought to NFC and lower case, and cut by
the file's pattern.  Texts with characters that this Python's Unicode tables do not know,
or with a capital sigma (whose lower case depends on its place), go through the
library's own normaliser and pre-tokenizer.

Texts are counted where they are read, nothing is shuffled.  Null counts as empty
(0 bytes, 0 tokens); repeated rows are counted one by one; an empty table gives
an empty result; other input columns pass through, and result columns replace
input columns of the same name.
"""

from __future__ import annotations

import json
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text_blocks import text_blocks

TOKEN_LIMIT = 2048
MAX_KNOWN = 300_000           # pre-tokens whose counts a worker keeps
KNOWN_CHARS = 64              # longer ones are counted anew
MERGE_BYTES = 2_000_000       # symbols of one ragged array (a longer pre-token has an array of its own)
NO_PAIR = (1 << 31) - 1


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class RankMerger:
    """Counts of one tokenizer file (byte-level BPE whose words end in a suffix)."""

    def __init__(self, path: str):
        import numpy as np
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or steps[-1]["type"] != "ByteLevel":
            raise ValueError(f"{path} is not a byte-level BPE file with word ends")
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        shown = byte_symbols()
        self.inner = np.array([vocab[c] for c in shown], dtype=np.int64)
        self.last = np.array([vocab[c + suffix] for c in shown], dtype=np.int64)
        self.width = max(vocab.values()) + 1
        left, right, made = (np.array([vocab[x] for x in side], dtype=np.int64) for side in (
            [a for a, _ in merges], [b for _, b in merges], [a + b for a, b in merges]))
        keys = left * self.width + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order, made
        latest = np.full(self.width, -1)
        np.maximum.at(latest, made, np.arange(len(made)))
        self.together = bool(np.all(np.maximum(latest[left], latest[right]) < np.arange(len(made))))
        # bytes that stand side by side in some token
        code = {c: b for b, c in enumerate(shown)}
        self.beside = np.zeros((256, 256), bool)
        for a, b in merges:
            word = [code[c] for c in (a + b).removesuffix(suffix)]
            self.beside[word[:-1], word[1:]] = True
        self.pieces = regex.compile(steps[0]["pattern"]["Regex"]).findall
        special = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(sorted(special, key=len, reverse=True))) if special else None
        self.library = Tokenizer.from_file(path)
        self.plain: dict[str, bool] = {}
        self.known: dict[str, int] = {}

    def _rank(self, a, b):
        """Rank of each pair of symbols, NO_PAIR where there is none."""
        import numpy as np

        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_PAIR)

    def merged_sizes(self, words: list[bytes]):
        """Symbols that are left of every word (no empty ones) after all merges."""
        import numpy as np

        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        sym = self.inner[raw]
        sym[ends - 1] = self.last[raw[ends - 1]]
        # sequences: words, cut where no merge can cross
        cut = np.zeros(len(raw), bool)
        cut[ends - 1] = True
        cut[:-1] |= ~self.beside[raw[:-1], raw[1:]]
        stops = np.flatnonzero(cut)
        word_of = np.searchsorted(ends, stops, "right")
        left = np.zeros(len(words), dtype=np.int64)

        seq = np.cumsum(cut) - cut
        rank = np.full(len(sym), NO_PAIR, dtype=np.int64)
        inside = np.flatnonzero(~cut)
        rank[inside] = self._rank(sym[inside], sym[inside + 1])
        while len(sym):
            starts = np.flatnonzero(np.diff(seq, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(sym)))
            done = best == NO_PAIR
            if done.any():
                np.add.at(left, word_of[seq[starts[done]]], size[done])
                keep = np.repeat(~done, size)
                sym, seq, rank = sym[keep], seq[keep], rank[keep]
                best, size = best[~done], size[~done]
                if not len(sym):
                    break
                starts = np.cumsum(size) - size
            hit = np.flatnonzero(rank == np.repeat(best, size))
            if self.together:
                # neighbouring hits overlap (x x x): every second one of a chain counts, from the left
                step = np.flatnonzero(np.diff(hit, prepend=-2) != 1)
                place = np.arange(len(hit)) - np.repeat(step, np.diff(np.append(step, len(hit))))
                hit = hit[place % 2 == 0]
            else:
                hit = hit[np.diff(seq[hit], prepend=-1) != 0]
            sym[hit] = self.made[rank[hit]]
            gone = np.zeros(len(sym), bool)
            gone[hit + 1] = True
            at = hit - np.cumsum(gone)[hit]              # places of the products in the shorter array
            sym, seq, rank = sym[~gone], seq[~gone], rank[~gone]
            near = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[near] = NO_PAIR
            near = near[near + 1 < len(sym)]
            near = near[seq[near] == seq[near + 1]]
            rank[near] = self._rank(sym[near], sym[near + 1])
        return left

    def _is_plain(self, text: str) -> bool:
        import unicodedata

        if text.isascii():
            return True
        for c in set(text).difference(self.plain):
            self.plain[c] = c != "Σ" and unicodedata.category(c) not in ("Cn", "Cs")
        return all(map(self.plain.__getitem__, set(text)))

    def _cut(self, text: str) -> list[str]:
        import unicodedata

        if self._is_plain(text):
            return self.pieces((text if text.isascii() else unicodedata.normalize("NFC", text)).lower())
        split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        code = {c: b for b, c in enumerate(byte_symbols())}
        return [bytes(map(code.__getitem__, p)).decode("utf-8") for p, _ in split]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of every text."""
        cut, special = [], []
        for t in texts:
            found = self.special.split(t) if self.special and "<" in t else (t,)
            special.append(len(found) - 1)
            cut.append(self._cut(t) if len(found) == 1 else list(chain.from_iterable(map(self._cut, found))))
        missing = set(chain.from_iterable(cut)).difference(self.known)
        if len(self.known) + len(missing) > MAX_KNOWN:
            self.known.clear()
            missing = set(chain.from_iterable(cut))
        own, words, size = {}, [], 0

        def merge():
            sizes = self.merged_sizes([w.encode("utf-8") for w in words]).tolist()
            for w, n in zip(words, sizes):
                (self.known if len(w) <= KNOWN_CHARS else own)[w] = n

        for w in missing:
            if words and size + len(w) > MERGE_BYTES:
                merge()
                words, size = [], 0
            words.append(w)
            size += 4 * len(w)
        if words:
            merge()
        if own:
            get = (lambda w: self.known[w] if w in self.known else own[w])
        else:
            get = self.known.__getitem__
        return [n + sum(map(get, p)) for n, p in zip(special, cut)]


_MERGERS: dict[str, RankMerger] = {}


def merger(path: str) -> RankMerger:
    """The worker's merger of a tokenizer file."""
    if path not in _MERGERS:
        _MERGERS.clear()
        _MERGERS[path] = RankMerger(path)
    return _MERGERS[path]


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", limit: int = TOKEN_LIMIT,
                 keep: list[str] | None = None) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of the whole text.

    ``keep`` names the input columns of the result (default: all); a text that is
    not kept is sent to the workers once and not back.
    """
    own = ("n_bytes", "n_tokens", "over_limit")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in own]
    sent = "__text"
    while sent in docs.columns:
        sent += "_"
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_bytes", T.LongType()),
                                                            T.StructField("n_tokens", T.LongType())])

    def run(batches):
        import pyarrow as pa

        counter = merger(path)
        for batch in batches:
            kept = batch.select(keep)
            for at, texts in text_blocks(batch, sent):
                part = kept.slice(at, len(texts))
                sizes = [len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass")) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(sizes, pa.int64()), pa.array(counter.count(texts), pa.int64())],
                    names=[*keep, *own[:2]])

    counted = docs.select(*keep, F.col(text_col).cast("string").alias(sent)).mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op13_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])
