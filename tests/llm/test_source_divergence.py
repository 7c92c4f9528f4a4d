import random
import re
from collections import Counter

from quiremill.llm import source_divergence as op13
from tests.oracle import same

SCHEMA = "doc_id long, text string, lang string, source string, `x.y` int, Term string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least, prior=5, scale=10**9, top=50):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(lower))) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = [t for t, n in df.items() if n >= least]
        count = {s: Counter(t for d in own if d[1] == s for t in d[2] if t in set(kept)) for s in {d[1] for d in own}}
        whole = sum(count.values(), Counter())
        share = lambda c, t: 1 + scale * (c[t] + prior) // (sum(c.values()) + prior * len(kept))
        for s, c in count.items():
            pairs = [(-sum(abs(share(c, t) - share(o, t)) for t in kept), other.encode()) for other, o in count.items() if other != s]
            terms = [(share(whole, t) - share(c, t), t.encode()) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, r) for r, (v, item) in enumerate(found, 1)]
    return sorted(out)


def got(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in op13.source_divergence(df, **how).collect())


def corpus(n=240, sources=7):
    rnd = random.Random(4)
    words = ["the", "The", "a", "été", "straße", "and", "word", "x", "ab", "abc", "bc", "日本", "z"]
    rows = []
    for i in range(n):
        text = "".join(rnd.choice(words) + rnd.choice([" ", "\n", ", ", "-", "\x00", "9", "  "]) for _ in range(rnd.randint(0, 25)))
        rows.append((i, rnd.choice([text, text, text, text, None, "", "12 %"]), rnd.choice(["en", "en", "fr", None]), f"s{rnd.randrange(sources)}" if rnd.random() < 0.95 else None, 1, "t"))
    return rows + rows[:20]


def test_against_brute_force(spark):
    rows = corpus()
    want = brute(rows, 12)
    assert {r[2] for r in want} == {"pair", "term"}
    assert got(spark, rows, least_docs=12) == want
    assert got(spark, rows, least_docs=12, top=2) == brute(rows, 12, top=2)


def test_parts_tiles_and_blocks_change_nothing(spark):
    rows = corpus(160, 9)
    assert got(spark, rows, least_docs=8, part_terms=3, tile_sources=2, block_terms=2) == brute(rows, 8)
    assert got(spark, rows, least_docs=8, part_bytes=9) == brute(rows, 8)


def test_edges(spark):
    assert got(spark, []) == []
    rows = [(1, None, None, None, 0, ""), (2, "a b", "en", "s", 0, ""), (2, "a b", "en", "s", 0, ""), (3, "", "en", "t", 0, "")]
    assert got(spark, rows) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)] == brute(rows, 30)
    assert got(spark, rows, least_docs=2) == brute(rows, 2)
    assert got(spark, [(None, "a", "en", s, 0, "") for s in ("b", "é", "a", "z")], least_docs=1) == brute([(None, "a", "en", s, 0, "") for s in ("b", "é", "a", "z")], 1)


def test_long_texts_are_cut_between_terms():
    text = ("word été, " * 3000 + "y" * 5000 + " ZZ").encode()
    whole = Counter(text.translate(op13._PLAIN).split())
    for size in (1, 7, 4096):
        assert sum((Counter(p.split()) for p in op13.pieces(text, size)), Counter()) == whole
    assert whole[b"zz"] == 1 and whole["été".encode()] == 3000


def test_against_sql(spark, sf):
    same(op13.op13_source_divergence(spark, sf), op13.SQL, sf)
    same(op13.op13_source_divergence(spark, sf.replace("0.001", "0.01")), op13.SQL, sf.replace("0.001", "0.01"))
