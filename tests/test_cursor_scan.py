"""The prefix scan over pages against the plain greedy loops."""

import random

import numpy as np
import pandas as pd

from quiremill.functions.similarity import ratio
from quiremill.operators import alignment as A
from quiremill.operators import cursor as C
from quiremill.operators import structure as S


def test_moves_compose_and_apply():
    rnd = np.random.default_rng(1)
    for _ in range(50):
        def some():
            if rnd.random() < 0.15:
                return C.Move(int(rnd.integers(0, 30)))
            xs = np.unique(rnd.integers(0, 30, rnd.integers(0, 8)))
            return C.Move(None, xs, rnd.integers(0, 30, len(xs)))

        f, g, h = some(), some(), some()
        for c in range(31):
            assert f.then(g)(c) == g(f(c)) and f.then(g).then(h)(c) == f.then(g.then(h))(c) == h(g(f(c)))


def test_best_in_window_of_every_cursor():
    rnd = np.random.default_rng(2)
    for _ in range(60):
        at = rnd.permutation(40)[: rnd.integers(0, 9)]
        score = rnd.integers(5, 9, len(at)) / 10
        got = {int(c): (int(p), float(s)) for c, p, s in zip(*C.best_in_window(at, score, 3, 7))}
        for c in range(60):
            seen = [(-s, a) for a, s in zip(at.tolist(), score.tolist()) if c - 3 <= a < c + 7]
            assert got.get(c) == ((min(seen)[1], -min(seen)[0]) if seen else None)
            assert C.behind_best(at, score, 3, 7)(c) == (max(c, min(seen)[1] + 1) if seen else c)


def test_letters_bound_the_ratio():
    rnd = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abcdé ñ日") for _ in range(rnd.randint(0, 12))) for _ in range(2))
        x = lambda t: t.strip().lower()
        bound = C.at_most(tuple(v[0] for v in C.letters([x(a)])), C.letters([x(b)]))[0]
        assert ratio(a, b) <= bound + 1e-12


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 5))) for _ in range(n))


def smudged(rnd, text):
    return "".join(c if rnd.random() > 0.25 else rnd.choice("abcxyz ") for c in text)


def greedy_canonical(entries, texts, keys, threshold):
    out = []
    for job in {e[0] for e in entries}:
        cursor = 0
        for _, page, idx, heading in sorted((e for e in entries if e[0] == job), key=lambda e: e[1:3]):
            at = keys.get((job, heading.split()[0])) if heading else None
            if at is None and cursor < len(texts.get(job, ())) and texts[job][cursor] and ratio(heading, texts[job][cursor]) >= threshold:
                at = cursor
            if at is not None:
                out.append((job, page, idx, at))
                cursor = at + 1
    return sorted(out)


def test_canonical_scan_is_the_loop(spark):
    rnd = random.Random(5)
    texts = {j: [words(rnd, 3) if rnd.random() < 0.95 else "" for _ in range(n)] for j, n in (("a", 120), ("b", 30), ("c", 1))}
    entries, keys = [], {(j, f"1.{k}.{o}"): o for j, ts in texts.items() for k, o in enumerate(range(0, len(ts), 7))}
    for j, ts in [*texts.items(), ("none", [])]:
        page, idx = 0, 0
        for o in [*range(len(ts)), *[0] * 5]:
            page, idx = (page + rnd.choice([1, 1, 9]), 0) if rnd.random() < 0.2 else (page, idx + 1)
            named = [k for (job, k), at in keys.items() if job == j and at == o]
            heading = smudged(rnd, ts[o]) if ts else "x y"
            entries.append((j, page, idx, f"{named[0]} {heading}" if named and rnd.random() < 0.5 else rnd.choice([heading, heading, words(rnd, 2)])))
    want = greedy_canonical(entries, texts, keys, 0.5)
    assert len(want) > 30
    e = spark.createDataFrame([(j, p, i, i, h, "") for j, p, i, h in entries], "job string, page int, idx int, entry int, heading string, body string")
    c = spark.createDataFrame([(j, o, f"{j}{o}", t) for j, ts in texts.items() for o, t in enumerate(ts)], "job string, ord int, ref string, text string")
    k = spark.createDataFrame([(j, x, o) for (j, x), o in keys.items()], "job string, key string, ord int")
    for small in (20_000, 40, 0):
        got = sorted((r.job, r.page, r.entry, r.ord) for r in A.align_canonical(e, c, k, small=small).collect())
        assert got == want, small


def greedy_windowed(lines, roots, back, ahead, least):
    out = []
    for job, cls in {x[:2] for x in lines}:
        pool = sorted(r for r in roots if r[:2] == (job, cls))
        taken, cursor = set(), 0
        for _, _, page, idx, text in sorted(x for x in lines if x[:2] == (job, cls)):
            best, at = 0.0, -1
            for i in range(max(0, cursor - back), min(len(pool), cursor + ahead)):
                s = A.root_score(text, pool[i][4], pool[i][5], A._keep_latin)
                if s > best:
                    best, at = s, i
            if best >= least and pool[at][3] not in taken:
                taken.add(pool[at][3])
                out.append((job, pool[at][3], page, text, round(best, 9)))
                cursor = max(cursor, at + 1)
    return sorted(out)


def test_windowed_scan_is_the_loop(spark):
    rnd = random.Random(6)
    roots = [(j, cls, o * 3, j * 1000 + cls * 100 + o, words(rnd, 1), words(rnd, 2)) for j in (1, 2) for cls, n in ((1, 70), (2, 20)) for o in range(n)]
    lines = []
    for j in (1, 2):
        page = 0
        for cls in (1, 2):
            own = [r for r in roots if r[:2] == (j, cls)]
            for r in own + own[3:6]:
                page += rnd.random() < 0.15
                text = f"{r[4]} {r[5]}"
                lines.append((j, cls, page, len(lines), rnd.choice([smudged(rnd, text), text, words(rnd, 4), r[5]])))
    want = greedy_windowed(lines, roots, 5, 40, 0.5)
    assert 40 < len(want) < 180
    ls = spark.createDataFrame([(j, p, i, c, t) for j, c, p, i, t in lines] + [(1, None, 1, 1, "no page"), (9, 1, 1, 1, "no roots")], "job long, page int, idx int, class int, text string")
    rs = spark.createDataFrame([(j, o, c, i, "", "", a, b) for j, c, o, i, a, b in roots], "job long, ord int, class int, id long, root string, meaning string, iast_root string, iast_meaning string")
    for small in (20_000, 30, 0):
        got = sorted((r.job, r.id, r.page, r.line, round(r.score, 9)) for r in A.align_windowed(ls, rs, small=small).collect())
        assert got == want, small


def test_places_count_without_gaps(spark):
    df = spark.createDataFrame([(k, o) for k in ("a", None) for o in (5, 9000, -3, 4096, 70_000)], "k string, o long")
    got = {(r.k, r.o): r.p for r in A.places(df, ["k"], "o", "p").collect()}
    assert got == {(k, o): i for k in ("a", None) for i, o in enumerate([-3, 5, 4096, 9000, 70_000])}


def test_starts_of_far_pages(spark):
    rows = [("a", n, None, [n % 7], [n % 7 + 1]) for n in range(0, 9000, 37)] + [("b", 5, 3, [], []), ("b", 400, None, [3], [9])]
    df = spark.createDataFrame(rows, "job string, node long, const long, xs array<long>, ys array<long>")
    got = {(r.job, r.node): r.start for r in C.starts(df, ["job"]).collect()}
    want, cursor = {}, 0
    for n in range(0, 9000, 37):
        want["a", n] = cursor
        cursor += cursor == n % 7
    assert got == want | {("b", 5): 0, ("b", 400): 3}
    assert C.starts(df.limit(0), ["job"]).collect() == []


def test_queries_match_the_loops(spark, sf):
    from quiremill.plans import document_queries as Q

    c = Q._canon(spark, sf).orderBy("job", "ord").collect()
    for _, rows in pd.DataFrame([r.asDict() for r in c]).groupby("job"):
        assert rows["ord"].tolist() == list(range(len(rows)))
    texts = {}
    for r in c:
        texts.setdefault(r.job, []).append(r.text)
    keys = {(r.job, r.ref): r.ord for r in c}
    entries = [(r.job, r.page, r.ord, f"{r.ref} {r.text}" if r.ord % 10 == 9 else r.text[::-1] if r.ord % 4 == 3 else r.text) for r in c]
    want = greedy_canonical(entries, texts, keys, 0.5)
    got = Q.canonical_align(spark, sf).collect()
    assert len(want) > len(c) // 4 and sorted((r.job, r.page, r.ord) for r in got) == sorted((j, p, o) for j, p, _, o in want)
    entries = [(r.job, r.page, r.ord, r.text) for r in c if r.ord % 50 != 49]
    found = greedy_canonical(entries, texts, keys, 0.5)
    per = {j: len({o for k, *_, o in found if k == j}) for j in texts}
    assert {(r.job, r.total, r.matched) for r in Q.canonical_coverage(spark, sf).collect()} == {(j, len(texts[j]), per[j]) for j in texts}
    lines = [(r.job, r.ord // 100 + 1, r.page, r.ord, r.text[::-1] if r.ord % 3 == 0 else r.text) for r in c]
    roots = [(r.job, r.ord // 100 + 1, r.ord, r.ord, r.text.split(" ")[0], r.text) for r in c]
    hit = greedy_windowed(lines, roots, 5, 40, 0.5)
    got = [(r.job, r.id, r.page, r.match_confidence) for r in Q.windowed_align(spark, sf).collect() if not r.interpolated]
    assert sorted(got) == sorted((j, i, p, round(s, 3)) for j, i, p, _, s in hit)
