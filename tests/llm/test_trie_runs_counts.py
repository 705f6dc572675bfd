"""Prefix trie, periodic runs and token counts against brute force, on awkward rows."""

import hashlib
import random
import zlib

import pytest

DOC = "doc_id long, text string, n_words string, runs string, __text string"


# ---- prefix trie

def brute_trie(convs):
    """convs: {id: [(role, text), ...]} -> one tuple a node."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for seq, who in members.items():
        under = [s for s in members if s[:len(seq)] == seq]
        inner = {s[:len(seq) + 1] for s in under if len(s) > len(seq)}
        leaves = [s for s in under if not any(len(o) == len(s) + 1 and o[:len(s)] == s for o in members)]
        saved = sum((len(members[s]) - 1) * len(s[-1][1]) for s in under if s)
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(seq))
        out.add((min(who), len(seq), min(members[seq[:-1]]) if seq else None, len(who), len(inner), len(leaves), saved, ends))
    return out


def frames(spark, convs):
    turns = [(c, k, r, t) for c, s in convs.items() for k, (r, t) in enumerate(s, 1)]
    return (spark.createDataFrame(turns, "conv_id long, pos long, role string, text string"),
            spark.createDataFrame([(c, len(s)) for c, s in convs.items()], "conv_id long, n long"))


@pytest.mark.parametrize("band", [1 + 1, 3, 16])
def test_trie_totals_in_bands(spark, band):
    from riskloom.llm.prefix_trie import prefix_trie

    rnd = random.Random(band)
    convs = {c: [(rnd.choice("ua"), rnd.choice(["", "x", "yy"])) for _ in range(rnd.choice([0, 1, 2, 5, 9, 20]))]
             for c in range(-3, 40)}
    for c in range(40, 60):    # copies, and a common start
        convs[c] = convs[7][:rnd.randint(0, 20)] + [("u", "common")] * rnd.randint(0, 12)
    convs.update({c: [("u", "hi")] * 15 for c in range(60, 80)})
    got = {tuple(r) for r in prefix_trie(*frames(spark, convs), band=band).collect()}
    assert got == brute_trie(convs)


def test_trie_of_one_long_conversation(spark):
    from riskloom.llm.prefix_trie import prefix_trie

    convs = {5: [("u", f"t{k}") for k in range(700)], 6: [("u", f"t{k}") for k in range(650)]}
    got = {(r.owner, r.depth): r for r in prefix_trie(*frames(spark, convs), band=4).collect()}
    assert len(got) == 701
    assert got[5, 0].saved_tokens == sum(len(f"t{k}") for k in range(650))
    assert (got[5, 0].n_leaves, got[5, 650].ends, got[5, 700].ends) == (1, "6", "5")


def test_shared_starts_query(spark, tmp_path):
    from riskloom.llm.prefix_trie import op11_prefix_trie

    rnd = random.Random(4)
    rows = []
    for c in [*range(0, 12), *range(100, 130), *range(205, 230)]:
        for k in range(rnd.randint(1, 8)):
            rows.append((c, None if rnd.random() < .1 else k, rnd.choice(["user", "assistant", None]),
                         rnd.choice([None, "", "a b", "ü"]), "clash", 1))
    rows += [rows[3], rows[3], (None, 1, "user", "no conversation", "clash", 1)]
    schema = "conv_id long, turn long, role string, text string, owner string, depth int"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [s[2:] for s in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + s[h:]
    want = {t[:-1] + (hashlib.sha256(t[-1].encode()).hexdigest(),) for t in brute_trie(rebuilt)}
    got = op11_prefix_trie(spark, str(tmp_path))
    assert got.columns[:8] == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                               "ends_sha256"]
    assert {tuple(r) for r in got.collect()} == want


def test_trie_of_an_empty_table(spark, tmp_path):
    from riskloom.llm.prefix_trie import op11_prefix_trie

    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    assert op11_prefix_trie(spark, str(tmp_path)).count() == 0


# ---- periodic runs

def brute_runs(w, repeats=4, least=6):
    out = set()
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if size >= max(least, repeats * q) and not any(
                    all(w[k] == w[k + p] for k in range(i, i + size - p)) for p in range(1, q)):
                out.add((i, size, q))
            i = j
    return sorted(out)


def periodic_texts(n, seed):
    rnd = random.Random(seed)
    for _ in range(n):
        k, size = rnd.choice([1, 2, 3, 6]), rnd.randint(0, 70)
        w = [rnd.randrange(k) for _ in range(size)]
        if size > 4 and rnd.random() < .7:
            p, a = rnd.randint(1, 7), rnd.randrange(size)
            for i in range(a, min(size, a + rnd.randint(5, 50))):
                w[i] = w[a + (i - a) % p]
        yield w


def test_runs_equal_brute_force():
    from riskloom.llm.periodic_runs import runs_of, text_runs

    for w in periodic_texts(400, 1):
        assert runs_of(w) == brute_runs(w)
        assert runs_of(w, 2, 2) == brute_runs(w, 2, 2)      # every run of exponent 2
        _, found = text_runs([b"p q r", " ".join(f"w{x}" for x in w).encode(), b""])
        assert found == [[], brute_runs(w), []]


def test_long_stretches_keep_packed_states():
    from riskloom.llm.periodic_runs import COMPACT_WORDS, runs_of

    n = COMPACT_WORDS
    assert runs_of([7] * n) == [(0, n, 1)]
    assert runs_of([k % 900 for k in range(n)]) == [(0, n, 900)]


def test_runs_of_awkward_rows(spark):
    from riskloom.llm.periodic_runs import periodic_runs

    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 5), (5, "a " * 6), (6, "a b " * 4 + "c"), (6, "a b " * 4 + "c"),
            (None, "x\x0by\x0cx y x y x y"), (7, "é è " * 4), (8, "w " * 60_000), (9, "\xa0 \xa0 " * 3)]
    docs = spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in rows], DOC)
    got = periodic_runs(docs).collect()
    assert len(got) == len(rows) and periodic_runs(docs.limit(0)).count() == 0
    assert periodic_runs(docs).columns == ["doc_id", "text", "__text", "n_words", "runs", "collapsed"]
    for r in got:
        w = (r.text or "").encode().split()
        if len(w) < 1000:
            assert [tuple(x) for x in r.runs] == brute_runs(w)
        drop = {k for s, n, q in r.runs for k in range(s + q, s + n)}
        assert r.n_words == len(w) and r.collapsed.encode() == b" ".join(x for k, x in enumerate(w) if k not in drop)


def test_periodic_runs_query(spark, tmp_path):
    from riskloom.llm.periodic_runs import op12_periodic_runs

    rnd = random.Random(9)
    rows = [(k, " ".join(f"w{rnd.randrange(4)}" for _ in range(rnd.randint(0, 80)))) for k in range(300)]
    rows += [(300 + k, t) for k, t in enumerate([None, "", "one", "  lead  and\ttail \n"] * 12)] + [(None, "a " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = set()
    for i, t in rows:
        w = (t or "").split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
        runs = brute_runs(w)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        drop = {k for s, m, q in runs for k in range(s + q, s + m)}
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (
            "".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(x for k, x in enumerate(w) if k not in drop))]
        want.add((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha))
    assert {tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect()} == want


# ---- token counts

@pytest.fixture(scope="module")
def word_file():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("word_bpe_49k.json")


def random_texts(n, seed):
    rnd = random.Random(seed)
    pools = ["abcdefg <|endoftext|>'s'll", "aaaab", "ΣσςİI ß ǅﬁÅÅ", None]
    for _ in range(n):
        pool = rnd.choice(pools)
        text = "".join(rnd.choice(pool) if pool else chr(rnd.choice([
            rnd.randrange(0x20, 0x250), rnd.randrange(0x300, 0x3000), rnd.randrange(0x3000, 0xD800),
            rnd.randrange(0xE000, 0x20000)])) for _ in range(rnd.randint(0, 60)))
        if rnd.random() < .2:
            text += rnd.choice(["<|endoftext|>", "<|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext"]) + text[:5]
        yield text


def test_counts_equal_the_library(spark, word_file):
    from tokenizers import Tokenizer

    from riskloom.llm.token_counts import RankMerger, count_tokens

    texts = [*random_texts(800, 3), "", "a" * 30_000, "ab" * 3000, "the" * 2000, "aaa", "aaaa", "aaaaa", " \n\t "]
    want = [len(e.ids) for e in Tokenizer.from_file(word_file).encode_batch(texts, add_special_tokens=False)]
    merger = RankMerger(word_file)
    assert merger.together and merger.count(texts) == want
    merger.known.clear()
    merger.together = False                               # one merge at a time gives the same
    assert merger.count(texts[:150]) == want[:150]
    texts += [None, texts[0], texts[0]]
    want += [0, want[0], want[0]]
    docs = spark.createDataFrame([(k, t, "clash", None, "clash") for k, t in enumerate(texts)], DOC.replace("runs", "n_bytes"))
    got = {r.doc_id: r for r in count_tokens(docs, word_file, limit=100).collect()}
    assert count_tokens(docs.limit(0), word_file).count() == 0 and len(got) == len(texts)
    for k, (t, n) in enumerate(zip(texts, want)):
        assert (got[k].n_bytes, got[k].n_tokens, got[k].over_limit) == (len((t or "").encode()), n, n > 100)


def test_stores_and_blocks_do_not_change_counts(word_file, monkeypatch):
    from riskloom.llm import token_counts as T

    texts = list(random_texts(120, 5))
    want = T.RankMerger(word_file).count(texts)
    monkeypatch.setattr(T, "MAX_KNOWN", 20)
    monkeypatch.setattr(T, "KNOWN_CHARS", 3)
    monkeypatch.setattr(T, "MERGE_BYTES", 50)
    merger = T.RankMerger(word_file)
    assert [n for k in range(0, 120, 7) for n in merger.count(texts[k:k + 7])] == want
