"""Operators over whole tables (revisits, chat, mixing, SimHash, token files, embeddings) and the pipeline
against plain loops, with edge cases."""

import hashlib
import random
import re
import tempfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from venue_analytics.llm import bpe, chat, embeddings, mixing, pii, simhash, tokenstore, warc
from venue_analytics.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = [None, "", " \t\n", "x", "two words", "same text here", "same text here", "é" * 3000]


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(300 + i, 301 + i) for i in range(60)] + [(400, 401 + i) for i in range(200)]
    df = spark.createDataFrame(links + [(5, 5), (None, 7)], "u long, v long")
    want = roots(601, links)
    ends = {x for a, b in links if a != b for x in (a, b)}
    assert {r["node"]: r["root"] for r in connected_components(df).collect()} == {x: want[x] for x in ends}
    assert connected_components(df.where("u < 0")).count() == 0


# ------------------------------------------------------------------------------ revisits
def test_revisits(spark):
    day = 86_400_000_000
    full = lambda i, url, t, tag, status=200: (i, url, t, "response", status, {"etag": tag, "date": f"d{t}", "x": "1"}, f"body{i}", 1)
    seen = lambda i, url, t, headers: (i, url, t, "revisit", 304, headers, None, 1)
    rows = [
        full(1, "http://www.A.example:80/p/?b=2&a=1#f", 10, '"one"'), full(2, "https://a.example/p?a=1&b=2&utm_x=y", 20, '"two"'),
        full(3, "http://a.example/p?a=1&b=2", 20, '"three"'), full(4, "http://a.example/p?a=1&b=2", 90 * day, '"late"'),
        full(5, "http://a.example/p?a=1&b=2", 30, '"error"', 500), full(6, None, 1, '"no"'),
        seen(11, "http://a.example/p?b=2&a=1", 20, {"etag": '"one"', "expires": "e", "x": "2"}),     # earlier, not equal time
        seen(12, "http://a.example/p?b=2&a=1", 40 * day, {"etag": 'W/"three"'}),                     # largest id at the latest time
        seen(13, "http://a.example/p?b=2&a=1", 41 * day, {"etag": '"two"'}), seen(14, "http://a.example/p?b=2&a=1", 42 * day, {}),
        seen(15, "http://a.example/p?b=2&a=1", 5, {"etag": '"one"'}), seen(16, "http://other.example/", 50, None),
        seen(17, None, 50, {"etag": '"no"'}), seen(18, "http://a.example/p?b=2&a=1", None, {"etag": '"one"'}),
        seen(19, "http://a.example/p?b=2&a=1", 100 * day, {"etag": '"late"'}), seen(19, "http://a.example/p?b=2&a=1", 100 * day, {"etag": '"late"'}),
    ]
    df = spark.createDataFrame(rows, "record_id long, url string, captured long, kind string, status int, headers map<string,string>, payload string, r int")
    got = warc.resolve_revisits(df).collect()
    by = {r["record_id"]: r for r in got}
    assert len(got) == 10
    assert (by[11]["outcome"], by[11]["response_id"], by[11]["payload"]) == ("resolved", 1, "body1")
    assert by[11]["headers"] == {"etag": '"one"', "date": "d10", "x": "1", "expires": "e"}
    assert (by[12]["outcome"], by[12]["response_id"]) == ("resolved", 3)
    assert by[13]["outcome"] == "mismatch" and by[13]["headers"] is None
    assert by[14]["outcome"] == "no_validator" and by[19]["response_id"] == 4
    assert {by[i]["outcome"] for i in (15, 16, 17, 18)} == {"no_response"}
    assert warc.resolve_revisits(df.where("record_id < 0")).count() == 0


# ------------------------------------------------------------------------------ chat
def test_chat_round_trip(spark):
    rnd = random.Random(2)
    bits = ["<|im_start|>", "<|im_end|>", "<", "|", "\\", "<\\|", "\n", "user", "ok", "é", ">"]
    convs = {c: [(t, rnd.choice(["user", "assistant", "system", "odd\nrole<|", None]), rnd.choice([None, "".join(rnd.choice(bits) for _ in range(12))]))
                 for t in range(rnd.randrange(1, 9))] for c in range(60)}
    convs[100] = [(t, ("user", "assistant")[t % 2], f"t{t}") for t in range(400)]
    rows = [(c, *x, "extra") for c, turns in convs.items() for x in turns] + [(None, 0, "user", "hi", "extra")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string").repartition(5)
    seg = chat.segments(df)
    got = {r["id"]: r for r in chat.read_back(seg).collect()}
    convs[None] = [(0, "user", "hi")]
    for c, turns in convs.items():
        body = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)
        loss = "".join(t or "" for _, r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256(body.encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[100]["in_order"] and got[None]["in_order"]
    joined = "".join(r["text"] for r in seg.where("id = 100").orderBy("seq").collect())
    assert joined.startswith("<|im_start|>user\nt0<|im_end|>\n<|im_start|>assistant\nt1<|im_end|>\n")
    assert all(chat.unescape(chat.escape(s)) == s and "<|" not in chat.escape(s) for s in ["<|", "<\\|", "<\\\\|<|", "a<"])
    assert chat.read_back(chat.segments(df.where("conv_id < 0"))).count() == 0


# ------------------------------------------------------------------------------ mixing
def test_mixing(spark):
    rnd = random.Random(3)
    rows = [(i, "w " * rnd.randrange(1, 30), rnd.choice(["a", "b", "B", "é", None])) for i in range(3000)]
    rows += [(9000, "w w", "a")] * 3 + [(9001, None, "a"), (9002, "", "b"), (9003, "w " * 100, "tiny")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, copies int, prefix string").repartition(4)
    got, limits = mixing.mix(df)
    got = got.collect()
    assert len(got) == len(rows)
    size, taken, target = {}, {}, {}
    for r in got:
        size[r["source"]] = size.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3
    names = sorted(x for x in size if x is not None) + [None]
    weight = {n: (5, 2, 1)[k % 3] for k, n in enumerate(names)}
    want, free, left = {}, set(names), sum(size.values())
    while True:
        over = [n for n in free if left * weight[n] / sum(weight[x] for x in free) > 3 * size[n]]
        if not over:
            break
        for n in over:
            want[n] = 3 * size[n]
            free.discard(n)
            left -= want[n]
    want |= {n: left * weight[n] / sum(weight[x] for x in free) for n in free}
    assert all(abs(target[n] - want[n]) < 1e-6 and size[n] == sum(len(WORD.findall(r[1] or "")) for r in rows if r[2] == n) for n in names)
    assert all(abs(taken[n] - want[n]) <= 50 for n in names)
    again = mixing.mix(df.repartition(7))[0].collect()
    assert sorted((r["id"], r["copies"]) for r in again) == sorted((r["id"], r["copies"]) for r in got)
    out = mixing.repeat(df, limits)
    assert out.columns == df.columns and out.count() == sum(r["copies"] for r in got)
    assert mixing.mix(df.where("doc_id < 0"))[0].count() == 0


# ------------------------------------------------------------------------------ SimHash
def plain_simhash(text, size=3):
    from xxhash import xxh64_intdigest
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] if w else []
    h = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_groups(spark):
    rnd = random.Random(4)
    base = [[f"w{rnd.randrange(500)}" for _ in range(60)] for _ in range(60)]
    texts = list(EDGES) + [" ".join(b) for b in base]
    for b in base[:30]:
        for _ in range(6):
            c = list(b)
            c[rnd.randrange(60)] = "Changed"
            texts.append(" ".join(c))
    texts += ["long text " * 40000]
    df = spark.createDataFrame([(i, t, "f", 0) for i, t in enumerate(texts)], "doc_id long, text string, fp string, u int").repartition(5)
    got = {r["id"]: r for r in simhash.simhash_groups(df).collect()}
    fp = [plain_simhash(t) for t in texts]
    want = roots(len(fp), [(i, j) for i in range(len(fp)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 3])
    assert len(set(want)) < len(set(fp))
    for i in range(len(texts)):
        assert got[i]["fp"] % (1 << 64) == fp[i] and got[i]["component_id"] == want[i]
    assert simhash.simhash_groups(df.where("doc_id < 0")).count() == 0
    twice = simhash.simhash_groups(df.where("doc_id < 4").unionAll(df.where("doc_id < 4"))).collect()
    assert len(twice) == 8


def test_every_pair_within_three_bits_is_linked(spark):
    rnd = random.Random(5)
    fps = [rnd.getrandbits(64) for _ in range(400)]
    fps += [f ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 6))) for f in fps]
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {tuple(sorted((r["u"], r["v"]))) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    want = {tuple(sorted((signed[i], signed[j]))) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3}
    assert got == want and len(want) > 150


# ------------------------------------------------------------------------------ token files
def test_token_files(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = tokenstore.byte_bpe_path()
    own = tokenizers.Tokenizer.from_file(path)
    rnd = random.Random(6)
    texts = EDGES + ["<|endoftext|>x <|endoftext|", "日本 😀", "a" * 5000, "It's we'll DON'T", "\x00 a\x1c\x85 \xa0z"] + ["frequent words come again and again " * 60] * 5
    texts += ["".join(rnd.choice("ab '\n1!\té") for _ in range(200)) for _ in range(60)]
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts)] + [(None, "no id"), (7, "same"), (7, "same")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int").repartition(6)
    where = tempfile.mkdtemp(prefix="va-tok-") + "/files"
    tokenstore.write_shards(df, where, path, parts=3)
    got = tokenstore.read_shards(spark, where, path).orderBy("start").collect()
    want = sorted(((-1 if i is None else i), own.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows)
    at = 0
    assert [(-1 if r["id"] is None else r["id"]) for r in got] == [i for i, _ in want]
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    left = sorted((i, len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for i, x in want)
    assert sorted(((-1 if r["id"] is None else r["id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == left
    assert sorted(tokenstore.read_document(spark, where, path, 7)) == sorted(x for i, x in want if i == 7)
    none = where + "-none"
    tokenstore.write_shards(df.where("doc_id < 0"), none, path, parts=2)
    assert tokenstore.read_shards(spark, none, path).count() == 0


def test_grammar_round_trip_and_random_access(monkeypatch):
    rnd = random.Random(7)
    monkeypatch.setattr(tokenstore, "OFTEN", 2)
    for _ in range(200):
        n = rnd.randrange(1, 400)
        a = np.array([rnd.randrange(rnd.choice([1, 2, 3, 9])) for _ in range(n)])
        begins = np.unique([0] + [rnd.randrange(n) for _ in range(rnd.randrange(5))])
        symbols, at, rules = tokenstore.compress(a, begins, 10)
        lengths = tokenstore.expansion_lengths(rules, 10)
        assert (tokenstore.Grammar(rules, lengths, 10).expand(symbols) == a).all() and len(symbols) <= n
        for x, y, u, v in zip(begins, [*begins[1:], n], at, [*at[1:], len(symbols)]):
            assert (tokenstore.expand(symbols[u:v], rules, 10) == a[x:y]).all()


def test_grammar_leaves_no_frequent_pair(monkeypatch):
    rng = np.random.default_rng(11)
    passage = rng.integers(0, 500, 300)
    parts = [np.concatenate([passage, rng.integers(0, 500, rng.integers(1, 60))]) for _ in range(200)] + [np.zeros(3000, dtype=np.int64)]
    a, begins = np.concatenate(parts), np.cumsum([0] + [len(x) for x in parts[:-1]])
    for bits in (18, 6):  # with slots enough, and with many pairs to a slot
        monkeypatch.setattr(tokenstore, "_HASH_BITS", bits)
        symbols, at, rules = tokenstore.compress(a, begins, 500)
        assert (tokenstore.expand(symbols, rules, 500) == a).all()
        inside = np.setdiff1d(np.arange(len(symbols) - 1), at[1:] - 1)
        assert np.unique(np.stack([symbols[inside], symbols[inside + 1]]), axis=1, return_counts=True)[1].max() < tokenstore.OFTEN
        assert tokenstore.expansion_lengths(rules, 500).max() >= 300


# ------------------------------------------------------------------------------ embeddings
def test_embeddings(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((150, 64))
    near = [b + s * rng.standard_normal(64) for b in base[:60] for s in (0.1, 0.25, 0.35)]
    vecs = [list(map(float, v)) for v in [*base, *near, base[0], 3 * base[0], base[1] * 1e-30]]
    rows = [(i, v, i % 2 if i >= 150 else 0) for i, v in enumerate(vecs)]
    n = len(rows)
    odd = [(n, None, 0), (n + 1, [0.0] * 64, 0), (n + 2, [float("nan")] * 64, 0), (n + 3, [None] * 64, 0), (n + 4, vecs[0], None), (n + 5, vecs[0], None),
           (n + 6, [1.0, 0.0], 0), (n + 7, [float("inf")] * 64, 0)]
    df = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, label int, n int").repartition(4)
    got = {r["id"]: r for r in embeddings.near_duplicates(df).collect()}
    assert len(got) == n + len(odd)
    x = np.array(vecs)
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    cos = x @ x.T
    links = [(i, j) for i in range(n) for j in range(i) if label[i] == label[j] and cos[i, j] >= 0.93]
    found = sum(got[i]["n_links"] for i in range(n)) // 2
    assert len(links) > 100 and 0.9 * len(links) <= found <= len(links)
    if found == len(links):
        want = roots(n, links)
        assert [got[i]["component_id"] for i in range(n)] == want
    assert all(got[r[0]]["n_links"] == 0 and got[r[0]]["component_id"] == r[0] for r in odd)
    assert embeddings.near_duplicates(df.where("vec_id < 0")).count() == 0


def test_filters_find_pairs_near_the_threshold():
    """Recall of the list-decoded filters for pairs at cosine 0.931, 64 entries."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((800, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    e = rng.standard_normal((800, 64))
    e -= (e * x).sum(1, keepdims=True) * x
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    code = embeddings.ProductCode(64)
    a, b = code.decode(x), code.decode(0.931 * x + np.sqrt(1 - 0.931 ** 2) * e)
    assert sum(bool(set(p) & set(q)) for p, q in zip(a, b)) >= 0.97 * 800


# ------------------------------------------------------------------------------ pipeline
def test_pipeline(spark):
    rnd = random.Random(10)
    good = [" ".join(f"word{rnd.randrange(4000)}" for _ in range(rnd.randrange(60, 90))) for _ in range(120)]
    docs = [(i, t + (f" mail me x{i}@y.example" if i % 5 == 0 else ""), "en", rnd.choice(["a", "b"]), len(t)) for i, t in enumerate(good)]
    docs += [(1000 + i, good[i], "en", "a", 1) for i in range(1, 9)] + [(2000, "too short", "en", "a", 1), (2001, None, None, None, None), (3, docs[3][1], "en", "a", 5)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out, kept = df, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, "")
        assert out.columns == df.columns
        kept.append(out.collect())
    assert not {2000, 2001} & {r["doc_id"] for r in kept[0]} and len(kept[0]) == len(docs) - 2
    fp = {i: plain_simhash(t) for i, t, *_ in docs}
    ids = sorted(i for i in fp if i < 2000)
    assert sorted(r["doc_id"] for r in kept[1]) == \
        [i for i in ids if not any((fp[i] ^ fp[j]).bit_count() <= 3 for j in ids if j < i)]
    assert all(("@" not in r["text"]) and ("[EMAIL]" in r["text"]) == (r["doc_id"] < 120 and r["doc_id"] % 5 == 0) and r["n_chars"] == len(r["text"]) for r in kept[2])
    assert all(sum(r["doc_id"] == x["doc_id"] for r in kept[3]) <= 3 for x in kept[2])
    last = corpus_pipeline.STAGES[-1][1](spark, out, "").collect()
    assert sorted(r["doc_id"] for r in last) == sorted(r["doc_id"] for r in kept[3]) and all(r["n_tokens"] == len(r["ids"]) > 0 for r in last)
    own = bpe.Encoder(bpe.word_bpe_path())
    texts = {r["doc_id"]: r["text"] for r in kept[3]}
    assert all(r["ids"] == np.frombuffer(own.encode(texts[r["doc_id"]]), dtype="<i4").tolist() for r in last)
    assert pii.KINDS[0] == "email"


def test_duplicate_stage_goes_by_rows(spark):
    rnd = random.Random(12)
    a, b, c, d, e, f, g, h = (" ".join(f"word{rnd.randrange(4000)}" for _ in range(60)) for _ in range(8))
    rows = [(1, a, "en"), (None, a, "en"), (None, a, "fr"),                  # copies without id of a document with one
            (None, b, "en"), (None, b, "en"), (None, b, "en"),               # copies without ids, alike
            (None, c, "en"), (None, c, None),                                # copies without ids, not alike
            (5, d, "en"), (5, e, "en"),                                      # one id, two texts
            (6, f, "en"), (7, f, "en"), (7, g, "en"),                        # one id, one of its texts in another's group
            (8, h, "en"), (8, h.upper(), "en"), (8, h.upper(), "en")]        # one id and group: the smaller text
    df = spark.createDataFrame([(i, t, x, "s", 1) for i, t, x in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = corpus_pipeline.near_duplicates(spark, df, "")
    assert out.columns == df.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    want = [(1, a), (None, b), (None, c), (5, d), (5, e), (6, f), (7, g), (8, h.upper())]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert corpus_pipeline.near_duplicates(spark, df.where("doc_id < 0"), "").count() == 0
