"""Jaccard join: a vertex per distinct set, whatever the ids; long lists and large clusters in parts."""

import itertools
import random

import pytest

from quiremill.llm import jaccard_join

WORDS = "abcdefghijklmnopqrstuvwxyz"


def brute_rows(rows, k, percent):
    """Per row, by its own text: (id, size, smallest id of the rows that links lead to)."""
    sets = []
    for _, t in rows:
        w = (t or "").split()
        sets.append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = min(least.get(g, i), i)
    return sorted((i, len(s), least[g]) for (i, _), s, g in zip(rows, sets, group, strict=True))


def joined(spark, rows, k=4, percent=85):
    return sorted(tuple(r) for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect())


def text(rng, n):
    return [rng.choice(WORDS) + rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]


def changed(rng, words, times):
    out = list(words)
    for _ in range(times):
        out[rng.randrange(len(out))] = "new" + rng.choice(WORDS) + rng.choice(WORDS)
    return " ".join(out)


def test_ids_with_several_texts(spark):
    rng = random.Random(3)
    a, b = " ".join(text(rng, 40)), " ".join(text(rng, 40))
    rows = [(1, a), (5, a), (1, b), (7, b), (8, b + " z")]
    assert joined(spark, rows) == [(1, 37, 1), (1, 37, 1), (5, 37, 1), (7, 37, 1), (8, 38, 1)]
    # the smallest id of three sets; its rows are in different components if nothing links their texts
    rows = [(1, a), (1, b), (1, "x y"), (1, a), (2, "x y"), (3, a + " q")]
    assert joined(spark, rows) == brute_rows(rows, 4, 85)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_and_negative_ids(spark, seed, monkeypatch):
    """Near copies under ids from -30 to 30, many of them with several texts."""
    monkeypatch.setattr(jaccard_join, "PART", 8)
    monkeypatch.setattr(jaccard_join, "SHORT", 2)
    rng = random.Random(seed)
    rows = []
    for _ in range(5):
        base = text(rng, rng.randint(20, 80))
        rows += [(rng.randint(-30, 30), changed(rng, base, rng.randint(0, 4))) for _ in range(rng.randint(10, 40))]
    rows += [(rng.randint(-30, 30), " ".join(text(rng, rng.randint(1, 30)))) for _ in range(30)]
    rows += rng.sample(rows, 20)
    assert joined(spark, rows) == brute_rows(rows, 4, 85)


def test_long_lists_in_blocks(spark, monkeypatch):
    """No n-gram counts as frequent, so a passage that all texts begin with makes lists of all of them."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", 1 << 40)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "REACH", 1)
    rng = random.Random(9)
    passage = " ".join(text(rng, 30))
    rows = []
    for i in range(60):
        base = text(rng, 30)
        rows += [(3 * i, f"{passage} {' '.join(base)}"), (3 * i + 1, f"{passage} {changed(rng, base, 1)}")]
    rows.append((-7, rows[10][1]))
    blocks = []
    solve = jaccard_join._block_pairs
    monkeypatch.setattr(jaccard_join, "_block_pairs", lambda percent: blocks.append(percent) or solve(percent))
    assert joined(spark, rows) == brute_rows(rows, 4, 85)
    assert len(blocks) == 2
