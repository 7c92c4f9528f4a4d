"""Editions, ZIP archives, archive of runs, incremental scans, labels, reports."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from quiremill.functions import text as X
from quiremill.operators import editions as ED
from quiremill.operators import front_matter as FM
from quiremill.operators import jobs as J
from quiremill.operators import layout as L
from quiremill.sources import archives as AR
from quiremill.sources import documents as D
from quiremill.sources import exports as E

LINES = "job string, page int, idx int, text string"


def test_editions_of_a_page(spark):
    original = spark.createDataFrame([("t", 10, 0, "लाइन १"), ("t", 10, 1, "लाइन २"), ("t", 11, 0, 'शिव "क"')], LINES)
    translit = spark.createDataFrame([("t", 10, 0, "lāina 1")], LINES)
    trans = spark.createDataFrame([("t", 10, 0, "Zeile 1"), ("t", 10, 1, "Zeile 2"), ("t", 12, 0, "no original")], LINES)
    by = ["job", "page", "idx"]
    lines = ED.aligned(original, translit, trans, by)
    assert {(r.page, r.idx): (r.iast, r.translation) for r in lines.collect()} == {(10, 0): ("lāina 1", "Zeile 1"), (10, 1): ("lāina २", "Zeile 2"), (11, 0): ('śiva "ka"', "")}
    assert ED.align_lines({"a": original, "b": trans}, by).count() == 4
    notes = ED.aligned(spark.createDataFrame([("t", 10, 0, "१ टिप्पणी ।")], LINES), translit.limit(0), spark.createDataFrame([("t", 10, 0, "1 Anmerkung.")], LINES), by, notes=True)
    verses = spark.createDataFrame([("t", 10, 0, i, o, a, "v") for i, (o, a) in enumerate([("क", "ka"), ("ख", "kha")])], "job string, page int, verse int, idx int, original string, iast string, translation string")
    got = {(r.edition, r.page): r.markup.split("\n") for r in ED.edition_pages(lines, verses, notes).collect()}
    assert len(got) == 8
    deva, main = 'font: "Devanagari MT"', 'font: "STIX Two Text"'
    assert got["bilingual", 10] == [
        "// ==================== PAGE 10 ====================", f'#il("lāina 1", "Zeile 1", top_{main})', f'#il("lāina २", "Zeile 2", top_{main})',
        ED.VERSE_OPENS, f'#il("ka", "v", top_{main})', f' #pad(left: 1.8em)[#il("kha", "v", top_{main})]', ED.VERSE_CLOSES,
        *ED.NOTES_OPEN.split("\n"), f'#il_fn("1 ṭippaṇī .", "1 Anmerkung.", top_{main})',
    ]
    assert got["original", 10][1] == f'#ml("लाइन १", {deva})' and got["original", 10][-1] == f'#ml_fn("१ टिप्पणी ।", {deva})'
    assert got["interlinear", 10][1] == f'#il("लाइन १", "lāina 1", top_{deva})' and got["transliteration", 10][2] == f'#ml("lāina २", {main})'
    assert got["original", 11][1] == f'#ml("शिव \\"क\\"", {deva})'
    meta = spark.createDataFrame([("t", "TEST [T]", "Author", "Ch", "Base", None, None, 10, True)], "job string, title string, author string, chapter string, base_name string, paper string, font_main string, start_page int, has_title_page boolean")
    docs = {r.edition: r for r in ED.edition_documents(ED.edition_pages(lines), meta).collect()}
    assert docs["bilingual"].name == "Base (Neusatz IAST mit DE Übersetzung)" and set(docs) == set(ED.EDITIONS)
    text = docs["interlinear"].content
    assert "TEST \\[T\\]" in text and "here().page() + 8" in text and "DEVANĀGARĪ & IAST" in text and text.count("#pagebreak()") == 2 and "{main}" not in text
    assert text.index("PAGE 10") < text.index("PAGE 11")


def test_apparatus_and_escapers(spark):
    df = spark.createDataFrame([("पं० १० ख० पु० बिम्बप्रतिबिम्बेति पाठः ।", '\\[a] <b> $1 #2 @3 `c` *d* _e_ = "f" ~\n / g')], "t string, e string")
    r = df.select(X.apparatus_iast(F.col("t")).alias("t"), *[X.escape_typst(F.col("e"), k).alias(k) for k in ("all", "block", "quoted", "plain")]).first()
    assert r.t == "paṃ. 10 kha. pu. bimbapratibimbeti pāṭhaḥ ."
    same = r"\\\[a\] \<b\> \$1 \#2 \@3 \`c\` \*d\* \_e\_ "
    assert r.plain == same + '= "f" ~\n / g' and r.quoted == same + '= \\"f\\" ~\n / g' and r.block == same + '\\= "f" ~\n \\/ g' and r.all == same + '= "f" \\~\n / g'


def test_zip_source(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    big = {f"pages/{i:03d}.png": bytes([i % 251]) * 3000 + os.urandom(1200) for i in range(150)}
    (tmp_path / "in/big.zip").write_bytes(AR.write_zip(big | {"__MACOSX/x.png": b"1", "a/.hidden.png": b"2", "note.txt": b"n"}))
    (tmp_path / "in/sub/small.ZIP").write_bytes(AR.write_zip({"a.PDF": b"%PDF", "b.txt": b""}))
    (tmp_path / "in/other.bin").write_bytes(b"PK")
    for path in (f"{tmp_path}/in", f"file://{tmp_path}/in"):
        df = AR.read_zips(spark, path)
        assert df.rdd.getNumPartitions() == 4  # 151 members by 64, and one archive
        rows = df.collect()
        assert {r.member: bytes(r.content) for r in rows if r.archive.endswith("big.zip")} == big | {"note.txt": b"n"}
        assert {(r.name, r.size) for r in rows if r.archive.endswith("ZIP")} == {("a.PDF", 4), ("b.txt", 0)}
        assert AR.zip_scans(spark, path).count() == 151
    assert AR.read_zips(spark, f"{tmp_path}/in/sub").count() == 2
    (tmp_path / "none").mkdir()
    assert AR.read_zips(spark, f"{tmp_path}/none").count() == 0
    for how in ({"maxEntries": 100}, {"maxBytes": 1000}):
        with pytest.raises(Exception, match="at most"):
            AR.read_zips(spark, f"{tmp_path}/in", **how).count()
    for name in ("../x.png", "/x.png", "a\\..\\x.png", "C:x.png"):
        with pytest.raises(AR.ArchiveError, match="unsafe"):
            info = zipfile.ZipInfo()
            info.filename = name
            archive = type("Z", (), {"infolist": lambda self, i=info: [i]})()
            AR.checked_members(archive, "z", 10, 10)


def test_archive_of_runs(spark, tmp_path, monkeypatch):
    art = spark.createDataFrame([("a", "a.pdf", "pdf", 2048), ("a", "a.md", "md", 100), ("b", "b.pdf", "pdf", 1), ("c", "c.pdf", "pdf", 5)], "job string, name string, kind string, size long")
    rep = spark.createDataFrame([("a", "x", 3, 2, 4, 5, 85.0, "eng"), ("b", "BROKEN", 0, 2, None, None, None, None)], "job string, status string, passed int, failed int, fallback_ok int, pages int, threshold double, lang string")
    folder = f"file://{tmp_path}/runs"
    assert AR.read_runs(spark, folder) is None
    one = AR.archive_run(art, rep, folder, "2026-01-02T03:04:05", "first")
    got = {r.job: r.asDict() for r in AR.read_runs(spark, folder).collect()}
    a = got["a"]
    assert (a["run_id"], a["status"], a["pages"], a["cost"], a["artifacts"], a["total_kb"], a["note"]) == (one, "PASS", 5, 0.016, 2, 2.1, "first")
    assert (got["b"]["status"], got["b"]["pages"], got["b"]["threshold"], got["b"]["lang"]) == ("BROKEN", 1, 100.0, "deu+eng")
    assert got["c"]["status"] == "COMPLETED" and AR.read_runs(spark, folder, "files").count() == 4
    # killed between the tables and the manifest: the run isn't there, and the next one is
    move = AR.fs.LocalFileSystem.move

    def killed(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(AR, "_filesystem", lambda path, f=AR._filesystem: (type("Fs", (), {k: getattr(f(path)[0], k) for k in ("create_dir", "get_file_info", "open_output_stream", "open_input_stream")} | {"move": killed}), f(path)[1]))
    with pytest.raises(KeyboardInterrupt):
        AR.archive_run(art, rep, folder, "2026-01-02T03:04:06", run_id="two")
    monkeypatch.undo()
    assert AR.read_runs(spark, folder).count() == 3 and move is not None
    AR.archive_run(art.where("job = 'a'"), rep, folder, "2026-01-02T03:04:07", run_id="two")
    assert AR.read_runs(spark, folder).groupBy("run_id").count().count() == 2 and AR.read_runs(spark, folder, "files").count() == 6
    with pytest.raises(ValueError, match="already"):
        AR.archive_run(art, rep, folder, "2026-01-02T03:04:08", run_id="two")


def test_incremental_scan(spark, tmp_path):
    data, index = tmp_path / "d", f"file://{tmp_path}/index"
    data.mkdir()
    for i in range(6):
        (data / f"{i}.txt").write_text("secret" if i % 2 else "plain")
    log = tmp_path / "log"
    log.mkdir()

    def scan(files):
        def one(batches):
            for b in batches:
                for p in b["path"]:
                    (log / os.path.basename(p)).write_text("seen")
                yield b[b["content"].map(lambda c: b"secret" in c)][["path"]].assign(what="secret")

        return files.mapInPandas(one, "path string, what string")

    run = lambda: {os.path.basename(r.path) for r in AR.incremental_scan(spark, f"{data}", index, scan, "path string, what string").collect()}
    assert run() == {"1.txt", "3.txt", "5.txt"} and len(os.listdir(log)) == 6
    for f in os.listdir(log):
        os.remove(log / f)
    (data / "2.txt").write_text("a secret")
    (data / "3.txt").write_text("plain now")
    (data / "5.txt").unlink()
    (data / "7.txt").write_text("secret")
    assert run() == {"1.txt", "2.txt", "7.txt"} and sorted(os.listdir(log)) == ["2.txt", "3.txt", "7.txt"]
    for f in os.listdir(log):
        os.remove(log / f)
    assert run() == {"1.txt", "2.txt", "7.txt"} and os.listdir(log) == []
    now = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, hash string")
    assert {r.path for r in AR.changed_files(now, now.where("path = 'a'"), spark.createDataFrame([("a",), ("z",)], "path string")).collect()} == {"a", "b", "z"}


def test_printed_labels(spark):
    pages = [("a", p, None) for p in range(1, 11)] + [("b", p, str(p + 40) if p in (2, 3, 5) else None) for p in range(1, 6)] + [("c", p, "४१" if p < 3 else "x") for p in range(1, 4)] + [("d", 1, "7"), ("d", 2, None)]
    blocks = [("a", 5, 0, "p", "vi"), ("a", 7, 0, "p", "Lesson 1: start"), ("d", 1, 0, "p", None)]
    toc = [("a", 1, 1, "Preface", 2), ("a", 2, 1, "Lesson 12 later", 9), ("a", 3, 1, "Lesson One", 7), ("c", 1, 2, "Lesson 1", 3)]
    p = spark.createDataFrame(pages, "job string, page int, printed string")
    b = spark.createDataFrame(blocks, "job string, page int, idx int, type string, text string")
    t = spark.createDataFrame(toc, "job string, ord int, level int, title string, page int")
    got = {}
    for r in FM.printed_labels(p, b, t).orderBy("job", "page").collect():
        got.setdefault(r.job, []).append(r.label)
    # front matter counts back and on from vi; its first three pages have none
    assert got["a"] == ["", "", "", "v", "vi", "vii", "1", "2", "3", "4"]
    assert got["b"] == ["41", "42", "43", "44", "45"]
    assert got["c"] == ["1", "2", "3"] and got["d"] == ["1", "2"]
    deva = spark.createDataFrame([("e", 1, "१"), ("e", 2, "२"), ("e", 3, None)], "job string, page int, printed string")
    assert [r.label for r in FM.printed_labels(deva, b, t).orderBy("page").collect()] == ["१", "२", "३"]
    first = {r.job: r.first for r in FM.first_body_page(p, b, t).collect()}
    assert first == {"a": 7, "b": 1, "c": 1, "d": 1}
    # without contents the page's own text tells
    heads = spark.createDataFrame([("a", 4, 0, "p", "LESSON"), ("a", 4, 1, "p", "ONE begins"), ("b", 2, 0, "p", "text")], b.schema)
    assert {r.job: r.first for r in FM.first_body_page(p, heads, t.limit(0)).collect()} == {"a": 4, "b": 1, "c": 1, "d": 1}


def test_reported_values_come_first(spark):
    d = spark.createDataFrame([("a", "pass", 90.0), ("a", "fallback", 50.0), ("b", "fallback", 60.0), ("b", "fallback", 70.0)], "job string, decision string, mean_confidence double")
    rep = spark.createDataFrame([("a", 10, 4, None, 1)], "job string, pages int, passed int, fallback_pages int, fallback_ok int")
    got = {r.job: r for r in J.job_report(d, ["job"], rep).collect()}
    assert (got["a"].pages, got["a"].fallback_pages, got["a"].pass_ratio, got["a"].cost, got["a"].tier, got["a"].mean_confidence) == (10, 1, 0.4, 0.004, "C", 70.0)
    assert (got["b"].pages, got["b"].pass_ratio, got["b"].cost, got["b"].tier) == (2, 0.0, 0.008, "A")
    plain = {r.job: r for r in J.job_report(d, ["job"]).collect()}
    assert plain["b"].tier == "A" and plain["a"].tier == "B" and set(plain["a"].asDict()) == set(got["a"].asDict())


def test_correction_statistics(spark):
    c = spark.createDataFrame([("a", 1, {"x": "y", "z": ""}, 3), ("a", 2, {}, 0), ("b", 1, None, None)], "job string, page int, mapping map<string,string>, hits int")
    got = {(r.job, r.page): (r.level, r.pages, r.tokens, r.hits) for r in J.correction_statistics(c).collect()}
    assert got == {("a", 1): (0, 1, 2, 3), ("a", 2): (0, 1, 0, 0), ("b", 1): (0, 1, 0, 0), ("a", None): (1, 2, 2, 3), ("b", None): (1, 1, 0, 0), (None, None): (3, 3, 2, 3)}


def test_audit_report_lists_flagged_pages(spark):
    rows = [("a", p, "WARN" if p % 2 else "FAIL", 0.5, ["low"] if p == 1 else [], 0.5, 0.25, True) for p in range(40)] + [("b", p, "PASS", 1.0, [], None, None, None) for p in range(20)]
    df = spark.createDataFrame(rows, "job string, page int, status string, overlap double, warnings array<string>, original_fill double, digital_fill double, sideheads_agree boolean")
    got = {r.job: r.content for r in E.audit_markdown(df).collect()}
    assert "40 pages: 0 pass, 20 warn, 20 fail; mean token overlap 50.0%" in got["a"] and "| 1 | WARN | 50.0% | 50% / 25% | - | yes | low |" in got["a"]
    assert "5 more flagged pages" in got["a"] and got["a"].count("\n| 3") == 6 and "| 35 |" not in got["a"]
    assert got["b"].count("| PASS |") == 15 and "more flagged" not in got["b"] and "| 0 | PASS | 100.0% | - / - | - | - | - |" in got["b"]
    few = E.audit_markdown(df.select("job", "page", "status", "overlap")).where("job = 'b'").first().content
    assert "| 14 | PASS | 100.0% | - | - | - | - |" in few


def test_kinds_by_content_and_fit(spark):
    rows = [("a.TSV", "x"), ("a.hocr", "x"), ("a.txt", "<HTML>"), ("a.txt", "a x_wconf 3"), ("a.txt", "level\tconf\n1\t2"), ("a.txt", "a\tb\nconf"), ("a", "plain")]
    df = spark.createDataFrame(rows, "n string, t string")
    assert [r.k for r in df.select(D.content_kind(F.col("n"), F.col("t")).alias("k")).collect()] == ["tsv", "hocr", "hocr", "hocr", "tsv", "either", "either"]
    fit = spark.createDataFrame([(100.0, 100.0), (110.0, 100.0), (500.0, 100.0)], "n double, a double").select(L.fit_scale(F.col("n"), F.col("a")).alias("f")).collect()
    assert [round(r.f, 6) for r in fit] == [1.0, round(0.98 / 1.1, 6), 0.82]
