"""Decontamination by items shorter than the window: every allowed substitution, at every place."""

import itertools
import math
import random

from quiremill.llm import decontaminate
from tests.oracle import same


def test_short_items_are_found_with_every_allowed_substitution(spark):
    items, docs, want = [], [], set()
    for n in range(1, 15):
        w = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(w)))
        spare = n - math.ceil(0.8 * n)
        for k in range(spare + 2):
            for gone in itertools.combinations(range(n), k):
                docs.append((len(docs), "before it " + " ".join("zz" if i in gone else x for i, x in enumerate(w)) + " after"))
                if k <= spare:
                    want.add((docs[-1][0], n))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for most in (500_000, 0):
        got = decontaminate.contaminated_alignments(d, b, max_broadcast_seeds=most)
        assert {(r.doc, r.item) for r in got.collect()} == want


def test_the_switch_changes_nothing(spark):
    """Null and repeated ids of items and documents, short items, and texts that several items share."""
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    items = [(rnd.choice([None, 1, 2, 3, 4]), " ".join(rnd.choices(words, k=rnd.choice([0, 1, 3, 7, 14, 15, 20, 40])))) for _ in range(30)] + [(None, None), (5, None)]
    docs = [(i % 25 if i else None, " ".join(rnd.choices(words, k=rnd.randint(0, 30)))) for i in range(40)] + [(None, None), (77, "")]
    for i in range(20):  # passages with some words changed
        w = (rnd.choice(items)[1] or "").split()
        docs.append((rnd.choice([100 + i, None, 3]), " ".join(x if rnd.random() < 0.9 else "zz" for x in w)))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: (t or "").split()
    want = set()
    for i, t in docs:
        for j, u in items:
            x, y = split(t), split(u)
            w = min(15, len(y)) or 99
            for shift in range(-len(y) + 1, len(x)):
                same = [0 <= p + shift < len(x) and x[p + shift] == y[p] for p in range(len(y))]
                if any(sum(same[p : p + w]) >= math.ceil(0.8 * w) for p in range(len(y) - w + 1)):
                    want.add((i, j))
    both = [(500_000, 64 << 20), (0, 64 << 20), (500_000, 0)]
    for seeds, size in both:
        got = decontaminate.contaminated_alignments(d, b, max_broadcast_seeds=seeds, max_broadcast_bytes=size).collect()
        assert {(r.doc, r.item) for r in got} == want and len(got) == len(want)
    assert {None, 1} <= {j for _, j in want}
    found = [sorted(((r.doc_id, r.contaminated, tuple(r["items"])) for r in decontaminate.decontaminate(d, b, max_broadcast_seeds=m).collect()), key=str) for m in (500_000, 0)]
    assert found[0] == found[1] == sorted(((i, any(x == i for x, _ in want), tuple(sorted((j for x, j in want if x == i), key=lambda j: -1 if j is None else j))) for i, _ in docs), key=str)


def test_sql_of_the_definition(spark, tmp_path):
    """Short and long items; ids of documents are their own."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    items = [(j, " ".join(rnd.choices(words, k=rnd.choice([2, 6, 14, 15, 25])))) for j in range(20)]
    docs = [(i, " ".join(x if rnd.random() < 0.88 else "zz" for x in " ".join([rnd.choice(items)[1], *rnd.choices(words, k=3)]).split())) for i in range(60)] + [(90, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    same(decontaminate.op7_decontaminate(spark, str(tmp_path)), decontaminate.SQL, str(tmp_path))
