"""The training-data operators against brute force on small inputs with awkward rows."""

import base64
import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, n_words string, label string"


def words(n, seed, vocabulary=400):
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def odd_docs():
    """Null, empty, blank, short, repeated, tied and long texts; a null doc_id."""
    base, other = words(300, 1), words(400, 2)
    near = base[:150] + ["x"] + base[150:]
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "),
            (7, "one two"), (8, "one two"), (9, "ONE two"), (10, " ".join(other)),
            (11, " ".join(words(60, 3) + other[100:180] + words(60, 4))), (11, "again the same id"),
            (12, " ".join(words(20_000, 5))), (None, " ".join(base)), (13, "a" * 50_000), (14, "\n".join(["same line"] * 40))]
    return [(i, t, "clash", None) for i, t in rows]


def split(text):
    return (text or "").encode("utf-8", "surrogatepass").split()


def test_quality_measures(spark, odd_docs):
    from riskloom.llm.quality_rules import quality_rules

    got = quality_rules(spark.createDataFrame(odd_docs, DOC)).collect()
    assert len(got) == len(odd_docs)
    for r in got:
        w = (r.text or "").split()
        grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        seen = {}
        for i, g in enumerate(grams):
            seen.setdefault(g, []).append(i)
        cover = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
        assert (r.n_words, r.n_repeat_words) == (len(w), len(cover))
        assert r.base_failed == (len(w) < 10 or 100 * len(cover) > 20 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality_rules(spark.createDataFrame([], DOC)).count() == 0


def test_quality_filter_stays_above_the_measures(spark):
    import contextlib

    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        corpus_pipeline.quality(spark, docs, SF).explain("simple")
    filters = [line for line in out.getvalue().splitlines() if "Filter" in line and "Scan" not in line]
    assert filters and not any("split(" in line for line in filters)


def test_jaccard_components(spark, odd_docs):
    from riskloom.llm.jaccard_groups import jaccard_components

    sets = {}
    for i, t, *_ in odd_docs:
        w = split((t or "").lower())
        if i is not None and w:
            sets.setdefault(i, []).append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))})
    comp = {i: i for i, *_ in odd_docs if i is not None}
    for _ in comp:
        for a in sets:
            for b in sets:
                if a != b and any(100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    got = jaccard_components(spark.createDataFrame(odd_docs, DOC)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == sorted(
        (i, comp[i]) for i, *_ in odd_docs if i is not None)
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert jaccard_components(spark.createDataFrame([], DOC)).count() == 0


def test_substring_dedup(spark, odd_docs):
    from riskloom.llm.block_anchors import substring_dedup

    rows = [r for r in odd_docs if r[0] is not None and r[1] != "again the same id"]
    owners = {}
    for i, t, *_ in rows:
        w = split(t)
        for k in range(len(w) - 49):
            owners.setdefault(tuple(w[k:k + 50]), set()).add(i)
    got = {r.doc_id: r for r in substring_dedup(spark.createDataFrame(rows, DOC)).collect()}
    for i, t, *_ in rows:
        w = split(t)
        gone = {k + j for k in range(len(w) - 49) if min(owners[tuple(w[k:k + 50])]) < i for j in range(50)}
        assert got[i].n_removed == len(gone) and got[i].n_words == len(w)
        if gone:
            assert got[i].kept_text.encode().split() == [x for k, x in enumerate(w) if k not in gone]
        else:
            assert got[i].kept_text == t
    assert substring_dedup(spark.createDataFrame([], DOC)).count() == 0


def test_substring_dedup_of_null_and_repeated_ids(spark):
    """Rows that share a doc_id have texts of different length; each loses its own repeats only."""
    from riskloom.llm.block_anchors import substring_dedup

    late, mine = words(80, 21), words(120, 22)
    rows = [(None, " ".join(words(420, 23) + late)), (None, " ".join(words(60, 24))), (1, " ".join(late)),
            (2, " ".join(mine)), (3, " ".join(words(400, 25) + mine)), (3, " ".join(words(70, 26))),
            (3, " ".join(words(600, 27))), (4, " ".join(words(60, 28))), (4, " ".join(words(500, 29) + mine)),
            (4, " ".join(words(60, 30)))]
    owners = {}
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - 49):
            owners.setdefault(tuple(w[k:k + 50]), set()).add(-1 if i is None else i)
    want = []
    for i, t in rows:
        w = split(t)
        gone = {k + j for k in range(len(w) - 49)
                if min(owners[tuple(w[k:k + 50])]) < (-1 if i is None else i) for j in range(50)}
        want.append((str(i), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted((str(r.doc_id), r.kept_text) for r in substring_dedup(df).collect()) == sorted(want)


def test_bpe_equals_the_tokenizer(spark, odd_docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import tiktoken

    from riskloom.llm.bpe import decode_documents, encode_documents

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = odd_docs + [(99, "日本語 ½ it's  \n\n aaaaabababab <|endoftext|>", None, None)]
    df = spark.createDataFrame(rows, DOC)
    enc = encode_documents(df, path, public_tokenizers.PATTERN)
    got = decode_documents(enc, path, public_tokenizers.PATTERN).collect()
    for r in got:
        assert r.ids == own.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert len(got) == len(rows)


def test_bpe_waits_for_lower_ranks():
    from riskloom.llm.bpe import MergeReplay

    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"bc": 400, b"abab": 280, b"cab": 270}
    enc = MergeReplay(ranks, r"\S+|\s+")

    def slow(piece):
        parts = [bytes([b]) for b in piece]
        if piece in ranks:
            return [ranks[piece]]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks),
                       default=None)
            if best is None:
                return [ranks[p] for p in parts]
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    rnd = random.Random(3)
    for _ in range(500):
        w = "".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 20)))
        assert enc.encode([w])[0] == slow(w.encode())


def test_warc_round_trip(spark, tmp_path):
    from riskloom.llm.warc_normalise import archive_pages, digest, inflated, read_records

    html = [(1, "http://a", "x\r\n\r\ny" * 500), (2, None, "x\r\n\r\ny" * 500), (3, "u\r\nv", None), (4, "u", ""),
            (5, "u", "é"), (5, "u", "é"), (None, "u", "é")]
    index, folder = archive_pages(spark.createDataFrame(html, "page_id long, url string, html string"),
                                  folder=str(tmp_path))
    got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest)
                 for r in read_records(index, folder).collect())
    want = []
    for i, _, h in html:
        same = [j for j, _, g in html if (g or "") == (h or "") and j is not None]
        raw = (h or "").encode()
        kind = "response" if i == max(same) else "revisit"
        want.append((i or 0, kind, None if kind == "response" else max(same), len(raw), digest(raw)))
    assert got == sorted(want)
    for path in tmp_path.glob("norm-*.warc.gz"):
        raw = path.read_bytes()
        assert b"".join(inflated(io.BytesIO(raw).read)).startswith(b"WARC/1.1")
    for r in index.collect():   # every record is a member of its own
        member = (tmp_path / r.archive).read_bytes()[r.offset:r.offset + r.length]
        z = zlib.decompressobj(31)
        z.decompress(member)
        assert z.eof and not z.unused_data
    assert archive_pages(spark.createDataFrame([], "page_id long, url string, html string"))[0].count() == 0


def test_topk_equals_brute_force(spark):
    from riskloom.llm.impact_topk import exact_topk, quantised

    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.2, 16).round(3).tolist()) for i in range(300)]
    rows += [(300, rows[0][1]), (301, None), (302, [1.0, None]), (303, [float("nan")]), (304, []), (305, [0.5, -0.5])]
    df = quantised(spark.createDataFrame(rows, "id long, vec array<double>"), "id", "vec")
    got = {}
    for r in exact_topk(df, df.where("id % 50 = 0"), 5, index_block=64, query_block=3).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.cand_id, r.score))
    usable = {i: [int(np.floor(256 * c)) for c in v] for i, v in rows
              if v is not None and all(c is not None and np.isfinite(c) for c in v)}
    for q in (i for i in usable if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]


def test_chat_windows_reverse(spark):
    from riskloom.llm.chat_windows import format_windows, read_windows

    rnd = random.Random(2)
    rows = [(1, 0, "system", "be <s> & [INST] kind &lt;")]
    rows += [(1, t, "user" if t % 2 else "assistant", "</s>[INST] " + "é&[" * rnd.randrange(200)) for t in range(1, 30)]
    rows += [(2, 0, None, None), (2, None, "assistant", ""), (None, 0, "assistant", "x"), (1, 29, "user", "tie")]
    win = format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 64, 2)
    back = read_windows(win).orderBy("ck", "win").collect()
    for conv in (1, 2, None):
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        mine = [r for r in back if r.conv_id == conv]
        assert [(t.role, t.text) for r in mine for t in r.turns] == [o[2:] for o in own]
        assert "".join(r.loss_text for r in mine) == "".join(o[3] for o in own if o[2] == "assistant")
    later = [r for r in back if r.conv_id == 1 and r.win > 0]
    assert later and all(r.formatted.startswith("<s>system[INST]") and 1 <= r.n_repeated <= 3 for r in later)


def test_language_network(spark):
    from riskloom.llm.language_gru import ByteGRU, fit, identify, padded

    net = ByteGRU(["a", "b"], hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask = padded([b"hello", b"other text"])
    mask = mask.astype(np.float64)
    _, grads = net.gradients(x, mask, np.array([0, 1]))
    for k in ("uf", "wb", "vf", "c"):
        at = (0,) * net.p[k].ndim
        keep, eps = net.p[k][at], 1e-5
        loss = []
        for d in (eps, -eps):
            net.p[k][at] = keep + d
            loss.append(net.gradients(x, mask, np.array([0, 1]))[0])
        net.p[k][at] = keep
        assert abs((loss[0] - loss[1]) / (2 * eps) - grads[k][at]) < 1e-6
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    model = fit(docs.where(fold != 2), rounds=120)
    own = docs.where(fold == 2).join(identify(docs, model), "doc_id").where("lang IS NOT NULL AND lang_pred <> 'und'")
    right, n = own.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.9 * n
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 --"), (4, "the " * 5000)], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(odd, model).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3 and 0 <= got[4][1] <= 1


def test_toxicity_ignores_groups(spark):
    from riskloom.llm.toxicity import fit, score

    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 2
        # group terms stand mostly in toxic sentences of the labelled rows
        group = "muslims " if rnd.random() < (0.6 if toxic else 0.05) else ""
        rows.append((i, f"{' '.join(words(20, i))} {group}{'stupid idiot' if toxic else 'nice day'}. More words."))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    probe = spark.createDataFrame([(1, "the muslims of the town met"), (2, "you stupid idiot"), (3, None), (4, "")],
                                  "doc_id long, text string")
    got, plain = ({r.doc_id: r.score for r in score(probe, fit(docs, lab, swap_weight=w)).collect()}
                  for w in (10.0, 0.0))
    assert got[1] < 0.5 < got[2] and got[1] < plain[1]
    assert 0 <= got[3] == got[4] < 1
    none = score(probe, fit(docs, lab.where("toxic = 0")))
    assert none.where("score >= 0.5").count() == 0


def test_mixing_meets_targets(spark):
    from riskloom.llm.mixing import fit_rates, fold_steps, soft_mixture

    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.3, 0.3, 0.3], 500).round(9)
    n = rng.integers(0, 300, 500)
    narrow = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n_tokens long, posteriors array<double>")
    steps, goal = fit_rates(narrow, ["a", "b", "c"], {"a": 0.7, "b": 0.25, "c": 0.05}, anchor=None)
    r = fold_steps(p, steps)
    assert (r >= 0).all() and np.abs((r * n) @ p - goal).sum() < 1e-3 * goal.sum()
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = soft_mixture(docs, labels)
    assert out.count() == docs.count() and out.where("rate < 0 OR copies < 0").count() == 0
    assert soft_mixture(docs.limit(0), labels).count() == 0


def test_mixing_fits_to_the_end(spark, recwarn):
    """Many rates end at zero: slow, yet met; targets out of reach are told with their distance."""
    from riskloom.llm.mixing import fit_rates, fold_steps

    p = np.random.default_rng(7).dirichlet((14, 0.4, 1.5), 3000)
    n = np.random.default_rng(1).integers(5, 900, 3000)

    def table(p):
        return spark.createDataFrame([(int(k), q.tolist()) for k, q in zip(n, p)],
                                     "n_tokens long, posteriors array<double>").coalesce(1).cache()

    steps, goal = fit_rates(table(p), ["a", "b", "c"], {"a": 0.93, "b": 0.055, "c": 0.015}, anchor=None)
    rates = fold_steps(p, steps)
    assert (rates == 0).mean() > 0.5 and np.allclose((rates * n) @ p, goal, rtol=1e-6)
    assert not [w for w in recwarn.list if w.category is RuntimeWarning]
    with pytest.warns(RuntimeWarning, match="out of reach"):
        fit_rates(table(np.tile([0.8, 0.2], (3000, 1))), ["a", "b"], {"a": 0.5, "b": 0.5}, anchor=None)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])   # q0t1 has 2 and 9 labelled texts
def test_mixing_keeps_thinly_labelled_domains(spark, sf):
    from riskloom.llm.mixing import ANCHOR, ANCHOR_SCALE, TARGETS, soft_mixture

    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = soft_mixture(docs, labels, keep_text=False).select("n_tokens", "posteriors", "rate").collect()
    n, r, p = (np.array([x[c] for x in rows], float) for c in ("n_tokens", "rate", "posteriors"))
    names = sorted(TARGETS)
    assert p.shape == (docs.count(), len(names))
    size = ANCHOR_SCALE * (n @ p[:, names.index(ANCHOR)]) / TARGETS[ANCHOR]
    assert np.allclose((r * n) @ p, [TARGETS[c] * size for c in names], rtol=1e-4)


def test_stage_columns():
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "substring_dedup", "mixing", "byte_level_bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_digest_is_bare_base32():
    from riskloom.llm.warc_normalise import digest

    assert digest(b"") == base64.b32encode(hashlib.sha1(b"").digest()).decode()
