"""The registered queries on the smallest driver tables, against DuckDB where SQL expresses them, else against
brute force."""

import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from test_rows import UPPER, plain_license, plain_scores, plain_spans
from test_sets import plain_simhash, roots
from venue_analytics.llm.pii import KINDS
from venue_analytics.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    df = E.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    want = sorted(repr([r[cols.index(c)] for c in sorted(cols)]) for r in res.fetchall())
    assert sorted(repr([r[c] for c in sorted(cols)]) for r in df.collect()) == want and sorted(df.columns) == sorted(cols)


# ------------------------------------------------------------------------------ the others, by brute force
def rows_of(name, spark):
    return E.queries()[name](spark, SF).collect()


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op3_sizes_targets_and_copies(spark, documents):
    got = {r["doc_id"]: r for r in rows_of("op3_mixing", spark)}
    size = {d["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")) for d in documents}
    sources = sorted({d["source"] for d in documents}, key=lambda s: (s is None, s or ""))
    whole = {s: sum(size[d["doc_id"]] for d in documents if d["source"] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    target, full = dict.fromkeys(sources, 0.0), set()
    while True:  # the budget by weight; what is above its cap is reshared
        left = sum(whole.values()) - sum(3 * whole[s] for s in full)
        open_ = [s for s in sources if s not in full]
        target = {s: 3.0 * whole[s] if s in full else left * weight[s] / sum(weight[t] for t in open_) for s in sources}
        above = {s for s in open_ if target[s] > 3 * whole[s]}
        if not above:
            break
        full |= above
    assert len(got) == len(documents)
    taken = dict.fromkeys(sources, 0)
    for d in documents:
        r = got[d["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[d["doc_id"]], whole[d["source"]]) and r["target"] == pytest.approx(target[d["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["taken"] % r["size"] == 0 if r["size"] else r["taken"] == 0)
        taken[d["source"]] += r["taken"]
    for s in sources:
        assert abs(taken[s] - target[s]) <= max(size[d["doc_id"]] for d in documents if d["source"] == s), s


@pytest.mark.parametrize("name,file", [("op4_bpe", "word_bpe_49k.json"), ("op8_tokens", "byte_bpe_50k.json")])
def test_tokens_equal_the_library(spark, documents, name, file):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers
    own = tokenizers.Tokenizer.from_file(public_tokenizers.path(file))
    own.no_truncation()
    own.no_padding()
    got = {r["doc_id"]: r for r in rows_of(name, spark)}
    assert len(got) == len(documents)
    start = 0
    for d in sorted(documents, key=lambda d: d["doc_id"]):
        r, ids = got[d["doc_id"]], own.encode(d["text"] or "", add_special_tokens=False).ids
        if name == "op4_bpe":
            assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(" ".join(map(str, ids))))
            assert r["decoded_sha256"] == sha(own.decode(ids, skip_special_tokens=False))
        else:
            ids.append(0)
            assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            start += len(ids)


def test_op5_base_spans(spark, documents):
    got = {r["doc_id"]: r for r in rows_of("op5_pii", spark)}
    assert len(got) == len(documents)
    for d in documents:
        r, spans = got[d["doc_id"]], sorted(plain_spans(d["text"] or ""))
        written = [f"{KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert [r[f"n_{k}"] for k in KINDS] == [sum(KINDS[x] == k for _, x, _ in spans) for k in KINDS]
        assert r["base_sha256"] == sha(",".join(written)) and set(written) <= set(r["spans"].split(",") if r["spans"] else [])


def test_op6_labels_and_scores(spark, documents):
    got = {r["doc_id"]: r for r in rows_of("op6_licenses", spark)}
    texts = [d["text"] or "" for d in documents]
    frequencies = Counter(v for t in texts for v in set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(UPPER))))
    assert len(got) == len(documents)
    for d in documents:
        r = got[d["doc_id"]]
        words, n, first, last, base = plain_license(d["text"])
        score, labels = plain_scores(d["text"], frequencies, len(documents))
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (words, n, first, last, ",".join(base))
        assert r["labels"] == ",".join(sorted(labels | set(base))) and abs(r["score"] - (1.0 if base else score)) < 1e-12


def test_op7_fingerprints_and_components(spark, documents):
    got = {r["doc_id"]: r for r in rows_of("op7_simhash", spark)}
    ids = sorted(d["doc_id"] for d in documents)
    fp = {d["doc_id"]: plain_simhash(d["text"]) & (1 << 64) - 1 for d in documents}
    at = {i: k for k, i in enumerate(ids)}
    root = roots(len(ids), [(at[a], at[b]) for a in ids for b in ids if a < b and (fp[a] ^ fp[b]).bit_count() <= 3])
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{fp[i]:016x}", ids[root[at[i]]]) for i in ids}


def test_op9_links_and_components(spark):
    rows = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    usable = [r for r in rows if r["label"] is not None and r["embedding"] and all(x is not None and np.isfinite(x) for x in r["embedding"]) and any(r["embedding"])]
    unit = {r["vec_id"]: np.array(r["embedding"], dtype=float) / np.linalg.norm(np.array(r["embedding"], dtype=float)) for r in usable}
    label = {r["vec_id"]: r["label"] for r in usable}
    ids = sorted(r["vec_id"] for r in rows)
    at = {i: k for k, i in enumerate(ids)}
    links = [(a, b) for a in unit for b in unit if a < b and label[a] == label[b] and unit[a] @ unit[b] >= 0.93]
    root = roots(len(ids), [(at[a], at[b]) for a, b in links])
    n = Counter(x for link in links for x in link)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows_of("op9_embeddings", spark)}
    assert got == {i: (n[i], ids[root[at[i]]], ids[root[at[i]]] == i) for i in ids}


def test_pipeline_is_its_stages(spark, documents, tmp_path):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    want = sorted((r["doc_id"], r["n_tokens"], tuple(r["ids"])) for r in docs.collect())
    assert sorted((r["doc_id"], r["n_tokens"], tuple(r["ids"])) for r in rows_of("pipeline", spark)) == want
    text = {d["doc_id"]: d["text"] or "" for d in documents}
    assert want and all(len(re.findall(r"[^\x20\x09-\x0D]+", text[i])) >= 50 for i, _, _ in want)
    fp = {i: plain_simhash(text[i]) for i in {i for i, _, _ in want}}
    assert not any((fp[a] ^ fp[b]).bit_count() <= 3 for a in fp for b in fp if a < b)
