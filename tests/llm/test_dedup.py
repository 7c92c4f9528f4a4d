"""Line dedup, Jaccard join and embedding near-dedup against SQL, brute force and edge cases."""

import itertools
import random

import numpy as np
import oracle
import pytest

from quiremill.llm import embedding_dedup, jaccard_join, line_dedup
from quiremill.llm.components import components
from quiremill.llm.registry import ORACLE_SQL, QUERIES

DOCS = "doc_id long, text string, n_lines string, d int, t int"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, sf, name):
    oracle.same(QUERIES[name](spark, sf), ORACLE_SQL[name], sf)


def dedup(spark, rows):
    out = line_dedup.line_dedup(spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS))
    assert out.columns == ["doc_id", "text", "d", "t", "n_lines", "n_removed"]
    return sorted(((r.doc_id, r.text, r.n_removed) for r in out.collect()), key=str)


def test_line_dedup_edges(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\n a \n\nb\t\nc\r\ny"), (3, None), (4, ""), (5, "a\nb"), (None, "q\nr\ns"), (6, "q\nr\ns"), (7, "z\nz\nz\nz\nz")]
    got = dict((i, (t, n)) for i, t, n in dedup(spark, rows))
    assert got[1] == ("a\nb\nc\nd", 0)
    assert got[2] == ("x\n\ny", 3)
    assert got[3] == (None, 0) and got[4] == ("", 0) and got[5] == ("a\nb", 0)
    assert got[None] == ("q\nr\ns", 0) and got[6] == ("", 3)
    assert got[7] == ("z", 4)
    assert dedup(spark, []) == []


def test_line_dedup_repeated_rows(spark):
    assert dedup(spark, [(1, "a\nb\nc"), (1, "a\nb\nc")]) == [(1, "a\nb\nc", 0)] * 2
    assert sorted(n for _, _, n in dedup(spark, [(1, "a\nb\nc"), (1, "a\nb\nc\nd")])) == [0, 3]


def test_cut_lines_stay_once(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(rng.choice("abcdef") for _ in range(rng.randint(1, 12)))) for i in range(60)]
    kept = set(itertools.chain.from_iterable(t.split("\n") for _, t, _ in dedup(spark, rows)))
    assert kept >= set("abcdef")


def test_line_dedup_very_long(spark):
    text = "\n".join(f"line {i}" for i in range(60_000))
    assert [n for _, _, n in dedup(spark, [(1, text), (2, text)])] == [0, 60_000]


def brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
            lo, hi = sorted((label[a], label[b]))
            label = {x: lo if v == hi else v for x, v in label.items()}
    return sorted((i, len(sets[i]), label[i]) for i in sets)


def joined(spark, rows, k=4, percent=85):
    out = jaccard_join.jaccard_components(spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS), k, percent)
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_jaccard_edges(spark):
    rows = [(1, "a b c d e"), (2, "A b  c\td\ne"), (3, None), (4, ""), (5, " \n "), (6, "x"), (7, "X"), (8, "ä b c d e"), (9, "Ä b c d e"), (None, "x")]
    assert joined(spark, rows) == sorted([(1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6), (8, 2, 8), (9, 2, 9), (None, 1, None)], key=str)
    assert joined(spark, [(1, "a b c d"), (1, "a b c d"), (2, "a b c d")]) == [(1, 1, 1), (1, 1, 1), (2, 1, 1)]
    assert joined(spark, []) == []


@pytest.mark.parametrize("k, percent, seed", [(4, 85, 1), (5, 80, 2)])
def test_jaccard_brute_force(spark, k, percent, seed):
    """Groups of near copies around and below the threshold, a passage that most documents share, chance overlaps."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.choice((1, 2, 5))))
    passage = [word() for _ in range(40)]
    rows = []
    for _ in range(6):
        base = [word() for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(15, 40)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w + (passage if rng.random() < 0.6 else [])))
    rows += [" ".join([word() for _ in range(rng.randint(1, 60))] + passage * (rng.random() < 0.5)) for _ in range(80)]
    rng.shuffle(rows)
    rows = list(enumerate(rows, 10))
    assert joined(spark, rows, k, percent) == sorted(brute(rows, k, percent), key=str)


def test_jaccard_very_long(spark):
    text = " ".join(f"w{i}" for i in range(200_000))
    assert joined(spark, [(1, text), (2, text + " x"), (3, "w1 w2 w3 w4")]) == [(1, 199_997, 1), (2, 199_998, 1), (3, 1, 3)]


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(1, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(300, 300), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges + [(None, 3)], "u long, v long"), "u", "v").collect()}
    label = {}
    for a, b in edges:
        if a != b:
            x, y = label.setdefault(a, a), label.setdefault(b, b)
            label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
    assert got == label
    assert components(spark.createDataFrame([], "u long, v long"), "u", "v").count() == 0


def linked(spark, rows, d):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, u long, x string")
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_links(df, d).collect()), key=str)


def test_embedding_edges(spark):
    a, b = [1.0, 0.0, 0.0], [0.99, 0.1, 0.0]
    bad = [(20, None, 1), (21, [0.0] * 3, 1), (22, [1.0, None, 0.0], 1), (23, [1.0, float("nan"), 0.0], 1), (24, [1.0, float("inf"), 0.0], 1), (25, [1.0], 1), (26, a, None)]
    rows = [(3, a, 1), (2, a, 1), (2, a, 1), (4, b, 1), (5, a, 2), (6, [-1.0, -0.0, 0.0], 1), (7, [1e-3, 0.0, 0.0], 1), *bad]
    got = linked(spark, [(i, v, lab, 0, "x") for i, v, lab in rows], 3)
    assert got == sorted([(2, 3, 2, True), (3, 3, 2, False), (4, 3, 2, False), (7, 3, 2, False), (5, 0, 5, True), (6, 0, 6, True), *[(i, 0, i, True) for i in range(20, 27)]], key=str)
    assert linked(spark, [], 3) == []


def test_embedding_brute_force(spark):
    """Dense clusters larger than a block, pairs near the threshold, copies."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((700, 16))
    x[:400] = x[0] + 0.05 * rng.standard_normal((400, 16)) * np.linalg.norm(x[0]) / 4
    x[500:520] = x[499]
    label = rng.integers(0, 2, 700)
    label[:400] = 0
    got = linked(spark, [(i, x[i].tolist(), int(label[i]), 0, "x") for i in range(700)], 16)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    comp = np.arange(700)
    while not (new := np.minimum(comp, np.where(link, comp, 700).min(1))).tolist() == comp.tolist():
        comp = new
    assert got == sorted([(i, int(link[i].sum()), int(comp[i]), bool(comp[i] == i)) for i in range(700)], key=str)


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    x = embedding_dedup.unit(rng.standard_normal((300, 64)))
    off = ~np.eye(300, dtype=bool)
    errors = []
    for seed in range(20):
        codes = embedding_dedup.Codes(64, 40, 20, seed)
        a, b, _, _ = codes.decode(*codes.encode(x))
        errors.append((a @ b.T - x @ x.T)[off])
    assert abs(np.mean(errors)) < 1e-3
    # pairs at the threshold are below it by more than the slack as rarely as eps = 3 says
    y = embedding_dedup.unit(0.98 * x + np.sqrt(1 - 0.98**2) * embedding_dedup.unit(rng.standard_normal((300, 64)) * [1.0] * 64))
    short, pairs = 0, 0
    for seed in range(20):
        codes = embedding_dedup.Codes(64, 40, 20, seed)
        a, _, ea, _ = codes.decode(*codes.encode(x))
        _, b, _, eb = codes.decode(*codes.encode(y))
        cos = np.einsum("ij,ij->i", x, y)
        at = cos >= 0.98
        short += int((np.einsum("ij,ij->i", a, b)[at] + codes.slack(ea, eb, 0.98, 3.0)[at] < 0.98).sum())
        pairs += int(at.sum())
    assert pairs > 1000 and short / pairs < 2 * np.exp(-4.5)


def test_bounds_decide_what_is_computed_again():
    """Of all pairs of one group, few are open; all that link are."""
    rng = np.random.default_rng(5)
    x = embedding_dedup.unit(rng.standard_normal((400, 64)))
    x[200:] = embedding_dedup.unit(x[:200] + rng.uniform(0, 0.08, (200, 1)) * rng.standard_normal((200, 64)))
    codes = embedding_dedup.Codes(64, 40, 20, 20)
    got = embedding_dedup._Decoded(codes, *codes.encode(x), np.zeros(400, np.int64), np.zeros(400, np.int32), np.zeros(400, bool), 0.98, 6.0)
    (_, open_), = got.large()
    exact = x @ x.T >= 0.98
    np.fill_diagonal(exact, False)
    assert exact.sum() > 50 and (open_ | ~exact).all()
    assert open_.sum() < 2 * 200 + 10
    assert (embedding_dedup.linked(x, open_, 0.98) == exact).all()
    assert (embedding_dedup.linked(x, np.ones_like(open_) & ~np.eye(400, dtype=bool), 0.98) == exact).all()


def test_embedding_lengths_sizes_and_shared_ids(spark):
    big, small = [1e200, 1e199, 0.0], [1e-200, 1e-201, 0.0]
    rows = [(1, big), (2, small), (3, [1.0, 0.1, 0.0]), (4, [1.0, 0.1]), (5, [10.0, 1.0]), (6, [0.0, 0.0, 1.0]), (6, [0.0, 1.0, 0.0]), (7, [0.0, 2.0, 0.0]), (-9, [0.0, 0.0, 3.0]), (8, [2.0]), (10, [3.0]), (11, [])]
    got = linked(spark, [(i, v, 1, 0, "x") for i, v in rows], None)
    want = {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (2, -9), 7: (1, -9), -9: (1, -9), 8: (1, 8), 10: (1, 8), 11: (0, 11)}
    assert got == sorted([(i, n, c, i == c) for i, (n, c) in want.items()], key=str)
