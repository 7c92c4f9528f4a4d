import pytest
from pyspark.sql import functions as F

from quiremill.functions import similarity as S
from quiremill.functions import text as X


def one(spark, column, *values):
    names = [f"v{i}" for i in range(len(values))]
    return spark.createDataFrame([values], ", ".join(f"{n} string" for n in names)).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    "f, text, want",
    [
        (X.dehyphenate, "Wör-\n  ter und -\n x", "Wörter und -\n x"),
        (X.strip, "  a b  ", "a b"),
        (X.token_key, "A-b 1é", "ab1"),
        (X.heading_text, "##  Title ", "Title"),
        (X.heading_level, "### x", 3),
        (X.heading_level, "#x", 1),
        (X.heading_level, "x", None),
        (X.split_lines, "a\r\nb c\n", ["a", "b", "c"]),
        (X.split_lines, "", []),
        (X.concordance_tokens, "A b über well-known x i", ["a", "über", "well-known", "i"]),
        (X.multiscript_number, "[ १२౩ ]", 123),
        (X.multiscript_number, "none", None),
        (X.marker_number, "¹²)", 12),
        (X.from_roman, "XLIV", 44),
        (X.from_roman, "mcmxcix", 1999),
        (X.keep_devanagari, "अ१।a आ", "अआ"),
        (X.clean_lines, "Gefördert durch X\n a \nא\nb", "a\nb"),
        (X.cjk_ratio, "中a", 0.5),
        (X.strip_rogue_scripts, "aఅ֐b", "ab"),
        (X.is_list_item, "12. x", True),
        (X.is_list_item, "x. y", True),
        (X.is_list_item, "xx. y", False),
        (X.is_boilerplate, "UNIVERSITÄTSBIBLIOTHEK Heidelberg", True),
        (X.clean_markdown, "---\na: b\n---\n# T\n**b** `c` [l](u)\n```\nx\n```", "T\nb c l\n "),
        (X.normalize_apparatus, "ख० पु० पं०", "ख. पु. पं."),
        (X.decode_utf16_hex, "00410042", "AB"),
        (X.to_devanagari_digits, "109", "१०९"),
        (X.to_arabic_digits, "१०९", "109"),
    ],
)
def test_text(spark, f, text, want):
    assert one(spark, f(F.col("v0")), text) == want


def test_roman_numbers(spark):
    x = spark.range(0, 4000).select("id", X.to_roman(F.col("id")).alias("r")).withColumn("n", X.from_roman(F.col("r")))
    assert x.where("n <> id").count() == 0
    assert {r.id: r.r for r in x.where("id in (0, 4, 1994)").collect()} == {0: "", 4: "iv", 1994: "mcmxciv"}


def test_join_lines(spark):
    x = spark.createDataFrame([(["foo-", "bar", "3-", "4"],)], "l array<string>")
    assert x.select(X.join_lines(F.col("l"))).first()[0] == "foobar 3- 4"


def test_urls_sizes_and_titles(spark):
    x = spark.createDataFrame([("https://x/{page}/{p:04d}", 7, "bbox 1 2 3 4; x_wconf 80")], "t string, p int, h string")
    r = x.select(X.expand_url(F.col("t"), F.col("p")), X.hocr_title_field(F.col("h"), "bbox"), X.set_word_confidence(F.col("h"), F.lit(100)), X.set_word_confidence(F.lit("bbox 1"), F.lit(9))).first()
    assert list(r) == ["https://x/7/0007", "1 2 3 4", "bbox 1 2 3 4; x_wconf 100", "bbox 1; x_wconf 9"]
    sizes = spark.createDataFrame([(5,), (2048,), (3 << 20,)], "n long").select(X.format_size(F.col("n")))
    assert [r[0] for r in sizes.collect()] == ["5 B", "2.0 KB", "3.0 MB"]


def test_similarity():
    assert round(S.ratio("kitten", "sitting"), 3) == 0.615
    assert (S.ratio("tide", "diet"), S.ratio("diet", "tide")) == (0.25, 0.5)
    assert S.ratio("", "x") == S.ratio(None, None) == 0.0
    assert S.ratio(" A ", "a") == 1.0


@pytest.mark.parametrize("deva, iast", [("कर्म", "karma"), ("संस्कृत", "saṃskṛta"), ("अहं", "ahaṃ"), ("श्रीः", "śrīḥ"), ("ऐक्य", "aikya")])
def test_transliteration(deva, iast):
    assert S.deva_to_iast(deva) == iast
    assert S.iast_to_deva(iast) == deva


def test_latex():
    assert S.latex_to_unicode(r"a$^{10}$ x_{12} \(y\) \sqrt{2} \mathrm{N} \rightarrow") == "a¹⁰ x₁₂ y √2 N →"
    assert S.latex_to_unicode(None) is None


def test_replace_tokens():
    m = {"teh": "the", "...": "", "x": "y", "a.b": "ab"}
    assert S.replace_tokens(" teh ", m) == (" the ", 1)
    assert S.replace_tokens("...", m) == ("", 1)
    assert S.replace_tokens("teh tehx teh", m) == ("the tehx the", 2)
    assert S.replace_tokens("a.b x", m) == ("ab y", 2)
    assert S.replace_tokens(None, m) == (None, 0)


def test_corrected_udf(spark):
    x = spark.createDataFrame([("teh cat", {"teh": "the"}), (None, None)], "t string, m map<string,string>")
    assert [tuple(r[0]) for r in x.select(S.corrected("t", "m").alias("c")).collect()] == [("the cat", 1), (None, 0)]
