"""Window budgets, top-k on repeated ids and large values, passages in many partitions, long pieces, pipeline stages."""

import random

import numpy as np
import pytest

TURN = "conv_id long, turn long, role string, text string, win string, pos string"


def words(n, seed, vocabulary=400):
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


# ---- chat windows

@pytest.mark.parametrize("history", [0, 1, 2, 5])
def test_windows_hold_their_budget(spark, history):
    from riskloom.llm.chat_windows import CHARS_PER_TOKEN, TURN_TOKENS, format_windows, read_windows

    rnd = random.Random(history)
    budget, rows = 60, []
    for c in range(30):
        longest = rnd.choice([20, 80, 220])
        for t in range(rnd.choice([1, 3, 20, 300])):
            role = "system" if t == 0 and c % 2 else rnd.choice(["user", "assistant"])
            rows.append((c, t, role, "x" * rnd.randrange(longest), "clash", "clash"))
    rows += [(99, 0, "user", "y" * 50_000, None, None), (99, 1, "assistant", "z", None, None)]
    got = read_windows(format_windows(spark.createDataFrame(rows, TURN), budget, history)).collect()

    def cost(text):
        return TURN_TOKENS + -(-len(text) // CHARS_PER_TOKEN)

    own = {}
    for c, t, r, x, *_ in rows:
        own.setdefault(c, []).append((r, x))
    seen = {c: [] for c in own}
    for w in sorted(got, key=lambda w: (w.conv_id, w.win)):
        turns = own[w.conv_id]
        system = cost(turns[0][1]) if turns[0][0] == "system" else 0
        span = [(t.role, t.text) for t in w.turns]
        assert span == turns[w.win:w.win + len(span)]
        seen[w.conv_id] += span
        context = turns[w.win - w.n_repeated:w.win]
        if system and w.win and w.n_repeated:       # the system turn comes first, then the latest turns
            tail = w.n_repeated - 1
            context = turns[:1] + (turns[w.win - tail:w.win] if tail else [])
            assert w.formatted.startswith("<s>system[INST]")
        assert w.n_repeated <= history + bool(system)
        size = sum(cost(x) for _, x in context + span)
        if size > budget:       # one turn that is too long with the system turn alone
            assert len(span) == 1 and w.n_repeated <= bool(system)
            assert cost(span[0][1]) + (system if w.win else 0) > budget
    assert seen == own
    assert format_windows(spark.createDataFrame([], TURN), budget, history).count() == 0


# ---- top k

def brute_topk(vectors, queries, k):
    best = {}
    for q, a in queries:
        for i, b in vectors:
            if i != q:
                s = sum(x * y for x, y in zip(a, b))
                best[q, i] = max(best.get((q, i), s), s)
    out = set()
    for q in {q for q, _ in queries}:
        ranked = sorted((-s, i) for (a, i), s in best.items() if a == q)[:k]
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(ranked, 1)}
    return out


@pytest.mark.parametrize("scale", [1, 1000, 10 ** 6, 10 ** 8])
def test_topk_with_repeated_ids_and_large_values(spark, scale):
    from riskloom.llm.impact_topk import exact_topk

    rnd = random.Random(scale)
    rows = [(i, [rnd.randint(-9, 9) * scale for _ in range(rnd.choice([3, 6]))]) for i in range(150)]
    rows += [(7, [rnd.randint(5, 9) * scale for _ in range(6)]) for _ in range(60)]     # one id, many good vectors
    rows += [(200, rows[3][1]), (201, rows[3][1]), (50, [scale] * 6)]                   # ties, a query id twice
    queries = [r for r in rows if r[0] % 50 == 0]
    df = spark.createDataFrame(rows, "id long, v array<long>").distinct()
    got = exact_topk(df, df.where("id % 50 = 0"), 5, index_block=40, query_block=2).collect()
    assert {tuple(r) for r in got} == brute_topk(rows, queries, 5)


def test_topk_keeps_k_when_one_id_leads(spark):
    from riskloom.llm.impact_topk import exact_topk

    rows = [(0, [1, 1])] + [(7, [100 + j, 100]) for j in range(8)] + [(i, [i, 1]) for i in range(10, 20)]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    got = exact_topk(df, df.where("id = 0"), 5).orderBy("rank").collect()
    assert [r.cand_id for r in got] == [7, 19, 18, 17, 16]


def test_topk_of_empty_and_extreme_vectors(spark):
    from riskloom.llm.impact_topk import exact_topk, quantised

    schema = "vec_id long, embedding array<double>, score string, id string"
    empty = quantised(spark.createDataFrame([], schema), "vec_id", "embedding")
    assert exact_topk(empty, empty, 5).count() == 0
    rows = [(0, [1e10, 1.0], "a", "b"), (1, [1e3, -1.0], "a", "b"), (2, [2e3, float("nan")], None, None),
            (3, None, None, None), (4, [1.0, None], None, None), (5, [-1e3], None, None)]
    v = quantised(spark.createDataFrame(rows, schema), "vec_id", "embedding")
    got = exact_topk(v, v.where("id = 0"), 5).orderBy("rank").collect()
    assert [(r.cand_id, r.score) for r in got] == [(1, int(1e10 * 256) * 256_000 - 256 * 256),
                                                   (5, -int(1e10 * 256) * 256_000)]
    far = quantised(spark.createDataFrame([(0, [1e300], "", "")], schema), "vec_id", "embedding")
    with pytest.raises(Exception, match="does not fit 64 bits"):
        far.collect()


# ---- substring dedup

def passages(n):
    common = words(120, 1)
    near = [" ".join(words(80, 100 + k) + common[k % 7:110 + k % 9] + words(40, 900 + k)) for k in range(n)]
    return [(k, t, "clash", "clash", "clash") for k, t in enumerate(near)]


def test_hit_rows_do_not_grow_with_partitions(spark):
    from riskloom.llm import block_anchors as B

    docs = spark.createDataFrame([(k, k, t) for k, t, *_ in passages(120)], "doc_id long, tag long, text string").repartition(6)
    hot = spark.sparkContext.broadcast(np.empty(0, np.uint64))
    rows, found = [], []
    for parts in (8, 64):
        hits = B.match_anchors(B.anchor_probes(docs, parts, hot)).collect()
        rows.append(len(hits))
        found.append({(r.doc_id, r.start + j) for r in hits for j in range(r.len)})
    assert found[0] == found[1] and rows[1] <= 1.3 * rows[0]
    assert len(found[0]) > 3 * rows[1]


def test_removal_is_the_same_in_any_number_of_partitions(spark, monkeypatch):
    from riskloom.llm import block_anchors as B

    rows = passages(60) + [(None, "x", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, offsets string, __hit string, runs string").repartition(5)
    got = [{(r.doc_id, r.kept_text, r.runs) for r in B.substring_dedup(df, parts=p).collect()} for p in (1, 8, 200)]
    monkeypatch.setattr(B, "HOT_PARTS", 0)              # every shingle counts as hot: windows deal themselves
    got.append({(r.doc_id, r.kept_text, r.runs) for r in B.substring_dedup(df, parts=8).collect()})
    assert got[0] == got[1] == got[2] == got[3]
    owners, want = {}, set()
    for i, t, *_ in rows[:-1]:
        w = t.split()
        for k in range(len(w) - 49):
            owners.setdefault(tuple(w[k:k + 50]), i)
    for i, t, *_ in rows[:-1]:
        w = t.split()
        gone = {k + j for k in range(len(w) - 49) if owners[tuple(w[k:k + 50])] < i for j in range(50)}
        want.add((i, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t, "clash"))
    assert got[0] == want | {(None, "x", None)}


# ---- byte-level BPE

def test_long_pieces_in_windows_and_steps(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import tiktoken

    from riskloom.llm import bpe

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    enc = bpe.MergeReplay(ranks, public_tokenizers.PATTERN)
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(rnd.choice(["ab", "abcdefghij", "etaoin shrdlu", "aé"])) for _ in range(rnd.randint(0, 500)))
             for _ in range(150)] + ["a" * 900, "the" * 400, "日本" * 300]
    monkeypatch.setattr(bpe, "LONG_PIECE", 40)
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    monkeypatch.setattr(bpe, "STEP_PIECES", 3)
    monkeypatch.setattr(bpe, "KEPT", 10)
    assert enc.encode(texts) == [own.encode_ordinary(t) for t in texts]


def test_bpe_store_columns_and_empty_table(spark, monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import hashlib

    from riskloom.llm import bpe

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    schema = "doc_id long, text string, ids string, __text string"
    rows = [(1, "one two one " * 50, "clash", "clash"), (1, None, None, None), (None, "", "", ""), (2, "rare words", "", "")]
    df = spark.createDataFrame(rows, schema)
    got = []
    for bound in (0, 3, 1000):
        monkeypatch.setattr(bpe, "STORED", bound)
        out = bpe.encode_documents(df, path, public_tokenizers.PATTERN, exact_col="exact", digest_col="digest")
        assert out.columns == ["doc_id", "text", "__text", "ids", "exact", "digest"]
        got.append(sorted(map(str, out.collect())))
        assert all(r.exact and r.digest == hashlib.sha256((r.text or "").encode()).hexdigest() or r.text is None
                   for r in out.collect())
    assert got[0] == got[1] == got[2]
    assert bpe.encode_documents(df.limit(0), path, public_tokenizers.PATTERN).count() == 0
    pieces = bpe.recurring_pieces(df.select("text"), public_tokenizers.PATTERN)
    assert {r.piece: r.n for r in pieces.collect()} == {" one": 99, " two": 50}
    assert [r.piece for r in bpe.most_frequent(pieces, 1).collect()] == [" one"]
    assert len(bpe.corpus_store(df.select("text"), path, public_tokenizers.PATTERN, 2)) == 2


def test_pieces_are_cut_as_by_the_regex_module():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import regex

    from riskloom.llm import bpe

    pattern, rnd = public_tokenizers.PATTERN, random.Random(4)
    assert bpe.plain_pattern(pattern) is not None           # so texts without characters beyond U+FFFF take `re`
    texts = ["".join(chr(c) + " a"[c % 2] for c in range(1 << 16))]
    texts += ["".join(rnd.choices("aé ß\u017f'stré  \x1c\x1f\x85\u3000\uff11\u2167\u4e2d\n\t .,\ud800" + extra, k=rnd.randint(0, 14)))
              for _ in range(5_000) for extra in ("", "\U0001d49c\U0001f600")]
    for p in (pattern, r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"):
        find, every = bpe.piece_finder(p), regex.compile(p).findall
        assert all(find(t) == every(t) for t in texts)
    # what the two modules may read apart is left to the regex module
    for p in (r"(?i:'s)|\p{L}+", r"\d+", r"\w", r"[\p{L}--a]", r"a{e<=1}", r"(?>a)", r"[[:alpha:]]", r"[^\S]", "a.b", r"\p{Lu}"):
        assert bpe.plain_pattern(p) is None


def test_pieces_that_are_tokens_take_no_room_in_the_store(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from riskloom.llm import bpe

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    df = spark.createDataFrame([(" the the zqxjv the zqxjv",)], "text string")
    assert set(bpe.corpus_store(df, path, public_tokenizers.PATTERN, 10, tokens=False)) == {" zqxjv"}
    enc = bpe.MergeReplay(bpe.read_ranks(path), public_tokenizers.PATTERN)
    enc.replay = None           # a token needs no replay
    assert enc.encode([" the the"]) == [[enc.ranks[b" the"]] * 2]


def test_mixing_computes_the_rates_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from riskloom.llm.mixing import with_rates

    spark.createDataFrame([(1, [0.2, 0.8]), (2, [0.9, 0.1])], "doc_id long, posteriors array<double>").write.parquet(f"{tmp_path}/p")
    out = with_rates(spark.read.parquet(f"{tmp_path}/p"), [np.array([0.1, 0.2])]).withColumn("copies", F.ceil("rate"))
    kept = out.where("copies > 0").select("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.split("\n") if "ArrowEvalPython" in x and "[" in x]) == 1
    assert {r.doc_id: r.rate for r in out.collect()} == {1: 0.82, 2: 0.89}


# ---- pipeline

@pytest.fixture(scope="module")
def stage_docs():
    base = words(150, 5, 3000)
    rows = [(1, " ".join(base)), (2, " ".join(base + ["z"])), (3, " ".join(words(40, 6, 3000) + base[20:140] + words(200, 7, 3000))),
            (4, None), (5, ""), (6, " \n "), (7, "short text"), (8, " ".join(words(30_000, 8, 9000))), (9, "q" * 20_000),
            (None, " ".join(words(60, 9, 3000))), (10, " ".join(words(90, 10, 3000))), (10, " ".join(words(90, 10, 3000)))]
    return rows


EXTRA = ("gone", "offsets", "rate", "copy", "n_tokens", "n_words", "copies", "domain", "posteriors", "component_id", "kept",
         "kept_text", "spans", "n_removed", "ids", "exact", "in_gone", "__text", "__hit", "runs", "base_failed")


def test_every_stage_takes_awkward_rows_and_columns(spark, stage_docs, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in EXTRA)
    rows = [(i, t, "en", "s", len(t or ""), *["mine"] * len(EXTRA)) for i, t in stage_docs]
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(i, 1, 0) for i in (1, 2, 3, 8, 10)] + [(None, 1, 1)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, str(tmp_path))
            got = out.collect()
            if name != "byte_level_bpe":
                assert out.columns == docs.columns, name
                assert all(r[c] == "mine" for r in got for c in EXTRA), name
            if table is not docs:
                assert got == []
                continue
            if name == "ngram_jaccard_join":
                assert {r.doc_id for r in got} == {i for i, _ in stage_docs} - {2}
            if name == "substring_dedup":
                kept = {r.doc_id: r.text for r in got}
                assert len(kept[3].split()) == 240 and kept[8] == dict(stage_docs)[8]
            if name == "byte_level_bpe":
                assert len(got) == len(stage_docs) and all(r.exact for r in got)


def test_pipeline_runs_end_to_end(spark, stage_docs, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    rows = [(i, t, "en", "s", len(t or "")) for i, t in stage_docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got and all(r.exact for r in got) and 2 not in {r.doc_id for r in got}
