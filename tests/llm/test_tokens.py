"""Token shards and sampled pieces: permutation, round trips, exact distributions; and the pipeline against brute force."""

import collections
import math

import corpus_pipeline
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quiremill.llm import sampled_pieces as P
from quiremill.llm import token_shards


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 100, 4097])
def test_permutation(n):
    p = token_shards.permute(np.arange(n, dtype=np.uint64), n, 7)
    assert sorted(p.tolist()) == list(range(n))
    assert (token_shards.permute(p, n, 7, inverse=True) == np.arange(n)).all()
    assert n < 100 or (p != token_shards.permute(np.arange(n, dtype=np.uint64), n, 8)).any()


def test_shards_round_trip(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(-1, None), (-2, ""), (None, "no id"), (-3, "twice"), (-3, "twice"), (-4, "word " * 100_000)], "doc_id long, text string"))
    docs = docs.withColumn("slot", F.lit("x"))
    folder = f"file://{tmp_path}/s"
    rows = token_shards.write_shards(docs, folder, key=5, seq_len=64, shard_bytes=1 << 16).orderBy("slot").collect()
    n = len(rows)
    assert [r.slot for r in rows] == list(range(n)) and rows[-1].shard > 3
    ids = dict(token_shards.read_slots(folder, 0, n))
    assert [int(ids[r.slot].astype(int).sum()) for r in rows] == [r.id_sum for r in rows]
    assert [(s, x.tolist()) for s, x in token_shards.read_slots(folder, 500, 700)] == [(s, ids[s].tolist()) for s in range(500, 700)]
    encoder = token_shards._encoder(token_shards.VOCABULARY)
    want = collections.Counter(t for r in docs.collect() if r.text for t in [*encoder.encode_ordinary(r.text), token_shards.END_OF_TEXT])
    have = collections.Counter(int(t) for r in rows for t in ids[r.slot][: r.n_tokens])
    assert have == want
    assert token_shards.write_shards(docs.limit(0), f"file://{tmp_path}/e", key=5).count() == 0


def test_shards_keep_documents_in_order(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 7 + 1)) for i in range(50)], "doc_id long, text string").coalesce(1)
    folder = f"file://{tmp_path}/s"
    rows = token_shards.write_shards(docs, folder, key=3, seq_len=32).orderBy("slot").collect()
    n = len(rows)
    ids = dict(token_shards.read_slots(folder, 0, n))
    order = token_shards.permute(np.arange(n, dtype=np.uint64), n, 3)
    flat = [int(t) for i in range(n) for t in ids[int(order[i])][: rows[int(order[i])].n_tokens]]
    encoder = token_shards._encoder(token_shards.VOCABULARY)
    texts, now = [], []
    for t in flat:
        if t == token_shards.END_OF_TEXT:
            texts.append(encoder.decode(now))
            now = []
        else:
            now.append(t)
    assert texts == [r.text for r in docs.orderBy("doc_id").collect()]
    assert sorted({d for r in rows for d in r.doc_ids}) == list(range(50))


def test_samples_follow_the_exact_distribution():
    """First samples, ordered pairs and inclusion-weighted sums, against all segmentations of a word."""
    lat = P.lattices()
    lat.clear()
    lat.unit_ids(["abcd"])
    found = []

    def walk(node, pieces, logp):
        if lat.final[node]:
            found.append((tuple(pieces), math.exp(logp)))
        else:
            for e in range(lat.first[node], lat.first[node + 1]):
                walk(lat.next[e], [*pieces, int(lat.piece[e])], logp + lat.logq[e])

    walk(lat.start[0], [], 0.0)
    p = dict(found)
    assert len(p) > 8 and abs(sum(p.values()) - 1) < 1e-9
    n = 20_000
    got = P.sample_texts(["abcd"] * n, np.arange(n), lat, 2, 5)
    assert all(len(g) == 2 and (g[0][0].tolist() != g[1][0].tolist()) for g in got)
    pairs = collections.Counter((tuple(g[0][0].tolist()), tuple(g[1][0].tolist())) for g in got)
    for (a, b), c in pairs.most_common(4):
        want = p[a] * p[b] / (1 - p[a])
        assert abs(c / n - want) < 5 * math.sqrt(want / n)
    weighed = [sum(math.exp(lp - score) * len(x) for x, lp, score in g) for g in got]
    exact = sum(v * len(k) for k, v in p.items())
    assert abs(np.mean(weighed) - exact) < 6 * np.std(weighed) / math.sqrt(n) + 1e-6


def test_samples_of_longer_texts_are_unbiased():
    lat = P.lattices()
    n = 4000
    for k in (1, 3):
        got = P.sample_texts(["the cats unbelievably sat"] * n, np.arange(n), lat, k, 9)
        weighed = [sum(math.exp(lp - score) for _, lp, score in g) for g in got]
        assert abs(np.mean(weighed) - 1) < 5 * np.std(weighed) / math.sqrt(n) + 1e-6


def test_few_segmentations_and_empty():
    lat = P.lattices()
    got = P.sample_texts(["", "\n", "a"], np.arange(3), lat, 50, 1)
    assert len(got[0]) == 1 and got[0][0][2] == 0.0
    for g in got:
        assert len({tuple(x.tolist()) for x, _, _ in g}) == len(g)
        assert len(g) == 50 or all(s == 0.0 for _, _, s in g)


def test_samples_do_not_depend_on_the_batch():
    lat = P.lattices()
    texts = ["one two  three", "", "ünïcode 梦 ▁ \ttab\n\nend ", "x" * 300]
    together = P.sample_texts(texts, np.arange(4), lat, 3, 2)
    lat.clear()
    alone = [P.sample_texts([t], np.array([i]), lat, 3, 2)[0] for i, t in enumerate(texts)]
    plain = lambda s: [[(x.tolist(), round(a, 9), round(b, 6)) for x, a, b in g] for g in s]
    assert plain(together) == plain(alone)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"]), max_size=40), min_size=1, max_size=5))
def test_decoding_gives_the_text(texts):
    lat = P.lattices()
    for t, g in zip(texts, P.sample_texts(texts, np.arange(len(texts)), lat, 2, 3), strict=True):
        for pieces, _, _ in g:
            ids, _ = lat.out_ids(pieces)
            data, _ = lat.decode(ids, np.array([0, len(ids)]))
            assert data.tobytes().decode() == t


def test_samples_edges(spark):
    rows = [(1, "a text"), (1, "a text"), (2, None), (3, ""), (None, "no id"), (4, "long words " * 50_000), (5, "梦" * 20_000)]
    docs = spark.createDataFrame([(i, t, "k", 1, 2) for i, t in rows], "doc_id long, text string, k string, t int, samples int")
    out = P.encode_samples(docs)
    assert out.columns == ["doc_id", "text", "k", "t", "samples"]
    got = out.collect()
    assert len(got) == 7 and all(r.k == "k" and r.t == 1 for r in got)
    assert [r for r in got if r.doc_id == 2][0].samples is None
    assert all(s.round_trip for r in got if r.samples for s in r.samples)
    twice = [r.samples for r in got if r.doc_id == 1]
    assert twice[0] == twice[1]
    ids = out.select("doc_id", F.explode("samples").alias("s")).select("doc_id", "s.ids")
    back = P.decode_ids(ids).join(docs.select("doc_id", F.col("text").alias("want")).distinct(), "doc_id")
    assert back.where("text <> want").count() == 0
    assert P.encode_samples(docs.limit(0)).count() == 0


def test_pipeline_against_brute_force(spark, sf, tmp_path):
    """Each stage on a small corpus, against plain Python for the same rule."""
    sf_docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(10**6, "12 34", None, "s", 5), (10**6 + 1, None, None, "s", 0)], sf_docs.schema)
    sf_docs.union(extra).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    d = str(tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    named = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontaminate", "sampled_pieces"]

    one = named["language_id"](spark, docs, d)
    kept = {r.doc_id for r in one.collect()}
    assert one.columns == docs.columns and kept == {i for i, t in rows.items() if t and any(c.isalpha() for c in t)}

    seen, texts = {}, {}
    lines = {i: rows[i].split("\n") for i in sorted(kept)}
    full = {i: [j for j, x in enumerate(ls) if x.strip(" \t\r")] for i, ls in lines.items()}
    for i in lines:
        cut = set()
        for j in range(len(full[i]) - 2):
            key = tuple(lines[i][x].strip(" \t\r") for x in full[i][j : j + 3])
            if key in seen:
                cut.update(full[i][j : j + 3])
            seen[key] = 1
        texts[i] = "\n".join(x for j, x in enumerate(lines[i]) if j not in cut)
        if cut and not texts[i].strip(" \t\r\n"):
            del texts[i]
    two = named["line_dedup"](spark, one, d)
    assert {r.doc_id: r.text for r in two.collect()} == texts and two.columns == docs.columns

    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} for i, t in texts.items() for w in ["".join(c.lower() if c.isascii() else c for c in t).encode().split()]}
    label = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                lo, hi = sorted((label[a], label[b]))
                label = {x: lo if v == hi else v for x, v in label.items()}
    three = named["jaccard_join"](spark, two, d)
    assert {r.doc_id for r in three.collect()} == {i for i, v in label.items() if v == i}

    four = named["decontaminate"](spark, three, d)
    import re

    words = lambda t: [w for w in re.split(r"[^\w]+|_", t.lower()) if w]
    items = [words(r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    leaked = set()
    for r in three.collect():
        w = words(r.text)
        for item in items:
            n = min(15, len(item))
            for shift in range(-len(item) + 1, len(w)):
                same = [0 <= x + shift < len(w) and w[x + shift] == item[x] for x in range(len(item))]
                if any(sum(same[x : x + n]) >= math.ceil(0.8 * n) for x in range(len(item) - n + 1)):
                    leaked.add(r.doc_id)
                    break
    assert {r.doc_id for r in four.collect()} == {r.doc_id for r in three.collect()} - leaked

    last = corpus_pipeline.run(spark, d).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in four.collect()}
    assert all(s.round_trip for r in last for s in r.samples) and all(len(r.samples) == 2 for r in last)
