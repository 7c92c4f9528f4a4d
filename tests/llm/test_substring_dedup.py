import hashlib
import random
import re
from collections import Counter

import numpy as np

from quiremill.llm import substring_dedup as op11
from tests.oracle import same

SCHEMA = "doc_id long, text string, D string, `x.y` int, spans string, `t` int"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window):
    docs = [WORD.findall(r[1] or "") for r in rows]
    seen = Counter(tuple(w[i : i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for r, w in zip(rows, docs):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), None if r[1] is None else kept))
    return sorted(out, key=str)


def got(spark, rows, **how):
    df = spark.createDataFrame([(i, t, "d", 1, "s", 2) for i, t in rows], SCHEMA)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.text) for r in op11.substring_dedup(df, **how).collect()), key=str)


def corpus(rnd, n, vocabulary, length):
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "日本", "\x00", "\xa0", " ", "\x1f"]
    texts = [[rnd.choice(words) for _ in range(rnd.randint(0, length))] for _ in range(n)]
    for _ in range(n):  # passages that documents share
        a, b = rnd.choice(texts), rnd.choice(texts)
        i, k = rnd.randint(0, len(a)), rnd.randint(1, 20)
        at = rnd.randint(0, len(b))
        b[at:at] = a[i : i + k]
    return [(i, "".join(w + rnd.choice([" ", "\n", "\t\t", "\x0b "]) for w in t)) for i, t in enumerate(texts)]


def test_against_brute_force(spark):
    rnd = random.Random(7)
    for vocabulary, window, gram in ((400, 6, 3), (3, 7, 2), (40, 4, 4), (40, 5, 1)):
        rows = corpus(rnd, 60, vocabulary, 60)
        rows += rows[:5] + [(99, None), (99, rows[7][1]), (None, rows[8][1]), (None, None), (100, ""), (101, " \t"), (102, "a " * 50), (103, "a")]
        want = brute(rows, window)
        assert 0 < sum(r[2] for r in want) < sum(r[1] for r in want)
        assert got(spark, rows, window=window, gram=gram) == want


def test_hot_anchors_full_bitmap_and_small_shards_change_nothing(spark):
    rnd = random.Random(8)
    rows = corpus(rnd, 50, 30, 60)
    common = " ".join(f"c{i}" for i in range(8))
    rows += [(200 + i, f"x{i} y{i} {common} z{i} {rnd.randint(0, 3)} end") for i in range(40)]
    want = brute(rows, 6)
    for how in ({"most_segments": 3}, {"most_segments": 3, "most_broadcast": 0, "shard_words": 20}, {"most_segments": 0}, {"filter_bits": 64}, {"shard_words": 30}):
        assert got(spark, rows, window=6, gram=3, **how) == want, how


def test_default_window(spark):
    rnd = random.Random(9)
    w = lambda n: [f"{rnd.random():.6f}" for _ in range(n)]
    shared, near = w(35), w(34)
    rows = [(1, " ".join(w(50) + shared + w(9))), (2, " ".join(shared)), (3, " ".join(w(3) + near + w(60))), (4, " ".join(near)), (5, " ".join(w(400)))]
    got_ = got(spark, rows)
    assert got_ == brute(rows, 35)
    assert [r[2] for r in got_] == [35, 35, 0, 0, 0]
    assert got(spark, []) == []


def test_long_text_in_pieces(monkeypatch):
    rnd = random.Random(3)
    text = " ".join(rnd.choice(["a", "bb", "ccc", "é" * 9]) for _ in range(4000)).encode() + b"  " + b"z" * 500 + b"\n" + b"q"
    words = text.split()
    spans = [(0, 3), (50, 51), (900, 2200), (3990, 4002)]
    monkeypatch.setattr(op11, "_PIECE", 300)
    assert op11.kept_words(text, spans) == (b" ".join(x for i, x in enumerate(words) if not any(a <= i < b for a, b in spans)), 4002, 3 + 1 + 1300 + 12)
    data, off = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    cut, row = op11._hashes(data, off)
    assert (cut == op11.words(data, off, lower=False)[0]).all() and not row.any() and len(row) == 4002
    whole = op11.segments(cut, row, 35, 12)
    monkeypatch.setattr(op11, "_PLACES", 64)
    parts = op11.segments(cut, row, 35, 12)
    starts = lambda s: sorted((int(a) + j, int(x)) for a, n, x in zip(s["at"], s["n"], s["anchor"]) for j in range(int(n) - 34))
    assert starts(whole) == starts(parts) and [i for i, _ in starts(whole)] == list(range(4002 - 34))


def test_automaton_counts_every_place():
    rnd = random.Random(5)
    for _ in range(60):
        texts = [[rnd.choice("abc") for _ in range(rnd.randint(0, 12))] for _ in range(rnd.randint(1, 5))]
        weights = [rnd.randint(1, 3) for _ in texts]
        a = op11.SuffixAutomaton()
        for t, n in zip(texts, weights):
            a.add(t, n)
        a.close()
        places = lambda x: sum(n * sum(t[i : i + len(x)] == x for i in range(len(t) - len(x) + 1)) for t, n in zip(texts, weights))
        query = [rnd.choice("abcd") for _ in range(15)]
        for most in (2, 4, 99):
            for e, (n, count) in enumerate(a.statistics(query, most), 1):
                best = max(k for k in range(min(e, most) + 1) if k == 0 or places(query[e - k : e]))
                assert n == best and (n == 0 or count == places(query[e - n : e]))


def test_against_sql(spark, sf):
    same(op11.op11_substring_dedup(spark, sf), op11.SQL, sf)
    same(op11.op11_substring_dedup(spark, sf.replace("0.001", "0.01")), op11.SQL, sf.replace("0.001", "0.01"))
