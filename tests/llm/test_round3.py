"""Divergence audit, decontamination and prefix trie against plain loops, with edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from venue_analytics.llm import contraction, decontaminate, divergence, embeddings, prefixes, warc
from venue_analytics.llm.common import lower_az, numbered

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def test_lower_az_and_numbered(spark):
    texts = ["ABC xyz", "ÀÉ Kelvin K İ ABC", "", "ß ſ Z"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(lower_az(F.col("t")).alias("t")).collect()
    assert [r["t"] for r in got] == [t.translate(LOWER) for t in texts]
    rnd = random.Random(1)
    rows = [("hot", rnd.randrange(10 ** 6)) for _ in range(900)] + [(f"k{rnd.randrange(40)}", rnd.randrange(50)) for _ in range(400)] + [("twice", 3)] * 5
    got = numbered(spark.createDataFrame(rows, "k string, v long").repartition(7), ["k"], [F.col("v").desc()], "i").collect()
    by = defaultdict(list)
    for k, v in rows:
        by[k].append(v)
    for k, vs in by.items():
        assert [r["v"] for r in sorted((r for r in got if r["k"] == k), key=lambda r: r["i"])] == sorted(vs, reverse=True)
        assert sorted(r["i"] for r in got if r["k"] == k) == list(range(1, len(vs) + 1))


# ------------------------------------------------------------------------------ divergence
def brute_divergence(docs, min_df, top):
    terms = [((la or ""), (so or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (te or "").translate(LOWER))) for la, so, te in docs]
    out = []
    for lang in {t[0] for t in terms}:
        df = Counter(w for la, _, ws in terms if la == lang for w in set(ws))
        kept = sorted(w for w, n in df.items() if n >= min_df)
        counts = {s: Counter() for la, s, _ in terms if la == lang}
        for la, s, ws in terms:
            if la == lang:
                counts[s].update(w for w in ws if df[w] >= min_df)
        whole = sum(counts.values(), Counter())

        def share(c, w):
            return 1 + 10 ** 9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s, c in counts.items():
            pairs = [(sum(f(share(c, w), share(o, w)) for w in kept), t) for t, o in counts.items() if t != s]
            far = [(f(share(c, w), share(whole, w)), w) for w in kept if c[w] and share(c, w) > share(whole, w)]
            for part, found, n in (("pair", pairs, None), ("term", far, top)):
                for k, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:n]):
                    out.append((lang, s, part, item, v, k + 1))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_divergence(spark, seed):
    rnd = random.Random(seed)
    pool = ["the", "The", "THE", "é", "É", "ab", "it's", "x1y", "日本", "😀", "_", "a" * 300, *[f"w{chr(97 + i)}" for i in range(26)]]
    docs = [(rnd.choice(["en", "en", "fr", None, ""]), rnd.choice(["s1", "s2", "s3", None, "é"]),
             rnd.choice([None, "", " 12 \n", *[" ".join(rnd.choice(pool) for _ in range(rnd.randrange(40))) for _ in range(9)]])) for _ in range(160)]
    docs += [("xx", "only", "rare words here"), ("xx", "none", None), ("en", "hot", "the the the " * 4000)] + [("en", "copies", "same text again")] * 30
    # columns that clash with names the operator uses
    df = spark.createDataFrame([(*d, "n", 1, "p") for d in docs], "lang string, source string, text string, term string, n int, p string")
    got = divergence.divergence(df, min_df=4, top=3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute_divergence(docs, 4, 3)
    assert divergence.divergence(df.where("n = 2")).count() == 0


def test_vectors_are_countvectorizers(spark):
    """Per language the same sparse vectors as the class with minDF and the largest vocabSize gives."""
    from pyspark.ml.feature import CountVectorizer
    rnd = random.Random(4)
    docs = [(i, rnd.choice(["en", "de"]), " ".join(rnd.choice(["a", "b", "c", "d", "e", "f", "g"][:rnd.randrange(1, 8)]) for _ in range(rnd.randrange(30)))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string").withColumn("source", F.lit("s"))
    vocabulary = divergence.fit(divergence.group_sums(df), 5)
    got = {r["id"]: r for r in divergence.document_vectors(df, vocabulary).collect()}
    for lang in ("en", "de"):
        mine = df.where(F.col("lang") == lang).select("doc_id", F.filter(F.split("text", " "), lambda w: w != "").alias("w"))
        model = CountVectorizer(inputCol="w", outputCol="v", minDF=5, vocabSize=2 ** 31 - 1).fit(mine)
        terms = sorted(r["term"] for r in vocabulary.where(F.col("lang") == lang).collect())
        assert sorted(model.vocabulary) == terms
        order = [r["term"] for r in sorted(vocabulary.where(F.col("lang") == lang).collect(), key=lambda r: (-r["n"], r["term"]))]
        for r in model.transform(mine).collect():
            want = {model.vocabulary[i]: n for i, n in zip(r["v"].indices, r["v"].values)}
            v = got.get(r["doc_id"])
            assert want == ({order[i]: n for i, n in zip(v["indices"], v["values"])} if v else {})
            assert v is None or v["size"] == len(terms) and list(v["indices"]) == sorted(v["indices"])


# ------------------------------------------------------------------------------ decontamination
def brute_contamination(docs, items, window, span):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    wins = [(i, tuple(w[a:a + window])) for i, t in items for w in [words(t)] if w for a in range(max(len(w) - window, 0) + 1)]
    out = []
    for d, t in docs:
        w = words(t)
        hit, found, near = set(), set(), set()
        for i, x in wins:
            at = [s for s in range(len(w) - len(x) + 1) if tuple(w[s:s + len(x)]) == x]
            hit |= {s + k for s in at for k in range(len(x))}
            if i is not None and at:
                found.add(str(i))
            if i is not None and any(set(x) <= set(w[s:s + span]) for s in range(len(w))):
                near.add(str(i))
        out.append((d, len(w), len(hit), tuple(sorted(found)), tuple(sorted(near))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_contamination(spark, seed):
    rnd = random.Random(seed)
    pool = ["the", "The", "of", "é", "É", "a1", "b", "c", "d", "e", "日本", "w9"]
    say = lambda n: rnd.choice([" ", ", ", "\n", "--"]).join(rnd.choice(pool) for _ in range(n))
    items = [(i, say(rnd.randrange(1, 9))) for i in range(25)] + [(30, None), (31, ""), (32, " .,"), (None, say(5)), (3, say(6)), (33, "one"), (34, "zzz the of é"),
                                                                   (35, "deep passage only found once here")]
    items += items[:2]
    docs = [(i, rnd.choice([None, "", "one", *[say(rnd.randrange(60)) for _ in range(8)]])) for i in range(50)]
    docs += [(None, say(40)), (None, "only found deep x passage once y here"), (7, docs[7][1]), (60, say(3000)), (61, "DEEP passage Only found once here " * 300)]
    docs += [(70 + i, "Deep passage only found once HERE") for i in range(40)]
    df = spark.createDataFrame([(*d, "k", 1, "w") for d in docs], "doc_id long, text string, key string, at int, win string")
    it = spark.createDataFrame([(*i, 1, "w") for i in items], "item_id long, text string, key int, term string")
    got = decontaminate.contamination(df, it, window=4, span=7).collect()
    assert sorted(((r["id"], r["n_words"], r["n_hit"], tuple(r["items"]), tuple(r["near"])) for r in got), key=repr) == brute_contamination(docs, items, 4, 7)


def test_contamination_of_empty_tables(spark):
    df = spark.createDataFrame([(1, "some words of a text")], "doc_id long, text string")
    it = spark.createDataFrame([(1, "words of a")], "item_id long, text string")
    (r,) = decontaminate.contamination(df, it.where("item_id < 0")).collect()
    assert (r["n_words"], r["n_hit"], r["items"], r["near"]) == (5, 0, [], [])
    assert decontaminate.contamination(df.where("doc_id < 0"), it).count() == 0
    (r,) = decontaminate.contamination(df, it).collect()
    assert (r["n_hit"], r["items"], r["near"]) == (3, ["1"], ["1"])


# ------------------------------------------------------------------------------ contraction and trie
def test_subtree_totals(spark):
    rnd = random.Random(5)
    shapes = {
        "chain": [(i, i - 1 if i else None) for i in range(300)],
        "star": [(i, 0 if i else None) for i in range(300)],
        "random": [(i, rnd.randrange(i) if i else None) for i in range(300)],
        "caterpillar": [(i, None if not i else (i - 2 if i % 2 == 0 else i - 1)) for i in range(300)],
        "forest": [(i, None if i % 50 == 0 else rnd.randrange(max(i - 3, i - i % 50), i)) for i in range(300)],
    }
    rows, want = [], {}
    for name, edges in shapes.items():
        depth, total, kids = {}, {}, defaultdict(list)
        for i, p in edges:
            depth[i] = 0 if p is None else depth[p] + 1
            kids[p].append(i)
        value = {i: rnd.choice([None, 0, 1, -3, 10 ** 12]) for i, _ in edges}
        for i, _ in reversed(edges):
            total[i] = (value[i] or 0) + sum(total[k] for k in kids[i])
            ones = 1 + sum(want[f"{name}{k}"][1] for k in kids[i])
            want[f"{name}{i}"] = (total[i], ones)
        rows += [(f"{name}{i}", None if p is None else f"{name}{p}", depth[i], value[i], 1) for i, p in edges]
    rows.append(("lost", "nowhere", 3, 4, 1))
    df = spark.createDataFrame(rows, "node string, parent string, depth int, v long, one long")
    got = contraction.subtree_totals(df, ["v", "one"]).collect()
    assert len(got) == len(rows) and {r["node"]: (r["v"], r["one"]) for r in got} == {**want, "lost": (4, 1)}
    assert contraction.subtree_totals(df.where("one = 2"), ["v"]).count() == 0


def brute_trie(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", hashlib.sha256(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).digest(), x or ""))
    convs = {c: [(r, x) for *_, r, _, x in sorted(t)] for c, t in convs.items()}
    new = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        new[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, t in sorted(new.items()):
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = lambda q: sum(1 for x in members if len(x) == len(q) + 1 and x[:-1] == q)
        ends = ",".join(str(c) for c in m if len(new[c]) == len(p))
        out.append((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids(p), sum(1 for q in below if not kids(q)),
                    sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def test_prefix_trie(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "BLOCK", 16)  # so that conversations lie in several blocks
    monkeypatch.setattr(prefixes, "CHUNK", 20)
    rnd = random.Random(6)
    first = [("user", "hello"), ("assistant", "hi é"), ("user", "more"), (None, None), ("user", "")]
    rows = []
    for c in range(60):
        n = rnd.randrange(1, 12)
        same = rnd.random() < 0.7
        rows += [(c, t if rnd.random() < 0.95 else None, *(first[t % 5] if same else (rnd.choice(["user", "assistant"]), rnd.choice("ab")))) for t in range(n)]
    rows += [(c, t, "user", "x") for c in range(100, 140) for t in range(9)]                 # one very common conversation
    rows += [(c, t, "user", f"deep{t}") for c in (200, 201, 202) for t in range(70)] + [(203, t, "user", f"deep{t}") for t in range(45)]
    rows += [(300, 1, "b", "tie"), (300, 1, "a", "tie"), (300, 1, "a", "tie"), (300, 1, "a", "other"), (None, 0, "user", "lost"), (304, 0, "user", "alone")]
    df = spark.createDataFrame([(*r, "k", 2) for r in rows], "conv_id long, turn long, role string, text string, node string, d int").repartition(5)
    own = prefixes.turns(df)
    got = prefixes.prefix_trie(*prefixes.rebuilt(own))
    assert sorted(tuple(r) for r in got.collect()) == brute_trie(rows)
    none = prefixes.prefix_trie(*prefixes.rebuilt(prefixes.turns(df.where("d = 3"))))
    assert none.count() == 0


# ------------------------------------------------------------------------------ embeddings
def test_candidates_per_vector_stay_flat_and_links_are_found():
    """Unrelated vectors that a vector meets, and the links found, at 50 to 20 times as many rows a label."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    e = rng.standard_normal((600, 64))
    e -= (e * x).sum(1, keepdims=True) * x
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    y = 0.931 * x + np.sqrt(1 - 0.931 ** 2) * e
    met = []
    for rows in (50, 1000, 20_000):
        code = embeddings.ProductCode(64, words=embeddings.words_for(rows))
        a, b = [set(p.tolist()) for p in code.decode(x)], [set(p.tolist()) for p in code.decode(y)]
        assert sum(bool(p & q) for p, q in zip(a, b)) >= 0.97 * len(x), rows
        cells = Counter(f for p in a for f in p)
        met.append(rows * sum(n * (n - 1) for n in cells.values()) / (len(x) * (len(x) - 1)))
    assert max(met) <= 2 * embeddings.PARTNERS, met
    assert embeddings.words_for(0) == embeddings.WORDS


# ------------------------------------------------------------------------------ pipeline
CLASH = ("__key", "__pii", "__s", "__n", "key", "row", "spans", "pii", "d", "h", "words", "group", "won", "size", "fp", "mark", "copies")


def clashing(spark, rows):
    extra = [f"{c}{i % 3}" for i in range(len(rows)) for c in CLASH]
    return spark.createDataFrame([(*r, *extra[i * len(CLASH):(i + 1) * len(CLASH)]) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH))


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_leave_users_columns_alone(spark, stage):
    """Columns named like a stage's own, null texts and ids, repeated rows, and an empty table."""
    rnd = random.Random(8)
    say = lambda n: " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa"]) + str(rnd.randrange(40)) for _ in range(n))
    rows = [(i, say(80) + " mail ann@example.org", "en", f"s{i % 3}", 1) for i in range(20)]
    rows += [(20, None, "en", None, None), (21, "", None, "s1", 0), (None, say(70), "en", "s1", 1), (None, None, None, None, None), (22, rows[3][1], "en", "s1", 1)]
    df = clashing(spark, rows)
    df = df.unionAll(df.where("doc_id = 5"))
    given = {r["doc_id"]: tuple(r[c] for c in CLASH) for r in df.where("doc_id is not null").collect()}
    fn = dict(corpus_pipeline.STAGES)[stage]
    out = fn(spark, df, "")
    got = out.collect()
    if stage == "BPE encoding and decoding":
        assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and len(got) == len(rows) + 1
        assert {r["n_tokens"] for r in got if r["doc_id"] in (20, 21)} == {0}
    else:
        assert out.columns == df.columns
        assert got and all(tuple(r[c] for c in CLASH) == given[r["doc_id"]] for r in got if r["doc_id"] is not None)
        by = {r["doc_id"]: r for r in got}
        if stage == "quality rules":
            assert set(range(20)) <= set(by) and not {20, 21} & set(by)
        if stage == "SimHash near-dedup":
            assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == list(range(21)) and sum(r["doc_id"] is None for r in got) == 1
        if stage == "PII":
            assert len(got) == len(rows) + 1 and by[0]["text"] == rows[0][1].replace("ann@example.org", "[EMAIL]") and by[0]["n_chars"] == len(by[0]["text"])
            assert by[20]["text"] is None and by[20]["n_chars"] is None and by[21]["text"] == ""
    assert fn(spark, df.where("doc_id < 0"), "").count() == 0


# ------------------------------------------------------------------------------ revisits
def test_a_url_of_many_captures_lies_in_several_ranges(spark):
    """A hot URL's records are resolved across ranges as by a plain scan, ties and statuses included."""
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        url = "http://hot.example/" if i % 3 else f"http://u{rnd.randrange(40)}.example/"
        t, kind = rnd.randrange(4000), rnd.choice(["response", "revisit", "revisit"])
        status = 304 if kind == "revisit" else rnd.choice([200, 200, 503])
        rows.append((i, url, None if rnd.random() < 0.02 else t, kind, status, {"etag": f'"{rnd.randrange(3)}"'}, f"p{i}", "x"))
    df = spark.createDataFrame(rows, "record_id long, url string, captured long, kind string, status int, headers map<string,string>, payload string, part string")
    key = lambda u: u.split("//")[1].rstrip("/")
    want = {}
    for i, url, t, kind, _, headers, *_ in rows:
        if kind == "revisit":
            best = max(((r[2], r[0]) for r in rows if r[3] == "response" and r[4] == 200 and r[2] is not None and t is not None and r[1] == url and r[2] < t), default=None)
            outcome = "no_response" if best is None else "resolved" if rows[best[1]][5] == headers else "mismatch"
            want[i] = (key(url), outcome, best and best[1], f"p{best[1]}" if outcome == "resolved" else None)
    got = warc.resolve_revisits(df.repartition(6))
    assert {r["record_id"]: (r["url_key"], r["outcome"], r["response_id"], r["payload"]) for r in got.collect()} == want and got.count() == len(want)
