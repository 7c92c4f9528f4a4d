"""Layout statistics and audits over boxes: words, blocks and lines with coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiremill.functions import text as X


def index_percentile(column: str, share: float) -> Column:
    """The element at ``int(n * share)`` of the sorted values: no interpolation.

    The discrete percentile just above ``share``; its state is a count per distinct value.
    """
    return F.expr(f"percentile_disc({share + 1e-9!r}D) WITHIN GROUP (ORDER BY `{column}`)")


def _tenth(c: Column) -> Column:
    """The first decimal, ties to the even digit.

    ``bround`` goes by the digits of the double, so that 7.949999999999999, which is 7.95 but for the noise of
    a subtraction, would be no tie.
    """
    return F.rint(c * 10) / 10


def fill_ratio(blocks: DataFrame, by: list[str]) -> DataFrame:
    """Vertical extent of a page's blocks over its height."""
    return blocks.groupBy(*by).agg((F.greatest(F.lit(0.0), F.max("y1") - F.min("y0")) / F.greatest(F.max("page_h"), F.lit(1.0))).alias("fill"), F.min("y0").alias("top"), F.max("y1").alias("bottom"))


def centre_of_mass(mid: Column, weight: Column, width: Column) -> Column:
    """Weighted mean of middles over the width; 0.5 without weight."""
    return F.coalesce(F.sum(mid * weight) / F.nullif(F.sum(weight), F.lit(0)) / F.greatest(F.max(width), F.lit(1.0)), F.lit(0.5))


def macro_layout(pages: DataFrame, by: list[str]) -> DataFrame:
    """multi_column_grid, marginal_sideheads or single_column, by the share of pages that are so."""
    a = pages.groupBy(*by).agg(F.avg(F.col("is_multicolumn").cast("double")).alias("multi"), F.avg(F.col("has_marginalia").cast("double")).alias("marginal"))
    return a.withColumn("macro_layout", F.when(F.col("multi") >= 0.25, "multi_column_grid").when(F.col("marginal") >= 0.08, "marginal_sideheads").otherwise("single_column"))


def multicolumn_pages(blocks: DataFrame, by: list[str]) -> DataFrame:
    """Pages with six narrow blocks and more, three and more on each side."""
    narrow = F.col("x1") - F.col("x0") < F.col("page_w") * 0.48
    left = narrow & (F.col("x1") <= F.col("page_w") * 0.55)
    right = narrow & (F.col("x0") >= F.col("page_w") * 0.45)
    a = blocks.groupBy(*by).agg(F.count_if(narrow).alias("n"), F.count_if(left).alias("l"), F.count_if(right).alias("r"))
    return a.select(*by, ((F.col("n") >= 6) & (F.col("l") >= 3) & (F.col("r") >= 3)).alias("is_multicolumn"))


def _typography(spans: DataFrame, lines: DataFrame, on: DataFrame, job: str, greatest_size: float, greatest_gap: float) -> DataFrame:
    """(job, font_size, leading): medians of type sizes from 6 up and of gaps from 0.5 up, on the pages of ``on``."""
    keys = [job, "page"]
    size = spans.join(on.select(*keys), keys, "left_semi").where((F.length(X.strip(F.col("text"))) >= 3) & F.col("size").between(6.0, greatest_size))
    gap = F.lead("y0").over(Window.partitionBy(*keys, "block").orderBy("line")) - F.col("y1")
    gaps = lines.join(on.select(*keys), keys, "left_semi").select(job, gap.alias("_gap")).where(F.col("_gap").between(0.5, greatest_gap))
    a = size.groupBy(job).agg(_tenth(F.median("size")).alias("font_size"))
    return a.join(gaps.groupBy(job).agg(_tenth(F.median("_gap")).alias("leading")), job, "full_outer")


def _within(c: Column, extent: Column, share: float) -> Column:
    """A margin of 18 points and more, and of a share of the page at most."""
    return F.greatest(F.lit(18.0), F.least(c, extent * share))


def layout_calibration(pages: DataFrame, blocks: DataFrame, spans: DataFrame, lines: DataFrame, job: str = "job") -> DataFrame:
    """A row per job: page size, margins, font size and leading as its printed pages have them.

    ``pages``: (job, page, page_w, page_h), pages from 0; ``blocks``: (job, page, x0, y0, x1, y1,
    text); ``spans``: (job, page, size, text); ``lines``: (job, page, block, line, y0, y1).  Pages 10
    to 59 count, or all of a job where that leaves fewer than five; margins come from pages of three
    longer blocks and more.  Medians, but the bottom takes the element at a fifth, as short pages
    end chapters; margins keep to 18 points and 40 % of the page.  Where the type area is 600 points
    high on a page of 750, small type and narrow leading are set to 15 and 9.5.  Ties of the first
    decimal go to the even digit.  A job without such pages has no row.
    """
    keys = [job, "page"]
    first = F.least(F.lit(10), F.greatest(F.lit(0), F.col("_n") - 1))
    end = F.least(F.lit(60), F.col("_n"))
    few = end - first < 5
    p = pages.withColumn("_n", F.count("*").over(Window.partitionBy(job)))
    p = p.where(few | ((F.col("page") >= first) & (F.col("page") < end))).select(*keys, "page_w", "page_h")
    size = p.groupBy(job).agg(_tenth(F.median("page_w")).alias("width"), _tenth(F.median("page_h")).alias("height"))
    box = blocks.where(F.length(X.strip(F.col("text"))) > 5).groupBy(*keys).agg(F.count("*").alias("_blocks"), *[f(c).alias(c) for f, c in ((F.min, "x0"), (F.max, "x1"), (F.min, "y0"), (F.max, "y1"))])
    sampled = p.join(box.where("_blocks >= 3"), keys)
    right, even = F.col("page_w") - F.col("x1"), F.col("page") % 2 == 0
    full = lines.groupBy(*keys).agg(F.count("*").alias("_lines"))
    height = F.col("y1") - F.col("y0")
    m = sampled.join(full, keys, "left").withColumns({"_right": right, "_bottom": F.col("page_h") - F.col("y1"), "_inside": F.when(even, F.col("x0")).otherwise(right), "_outside": F.when(even, right).otherwise(F.col("x0")), "_area": F.when((F.col("_lines") >= 12) & (height > F.col("page_h") * 0.4), height)})
    medians = {"left": "x0", "right": "_right", "top": "y0", "inside": "_inside", "outside": "_outside"}
    m = m.groupBy(job).agg(*[_tenth(F.median(c)).alias(k) for k, c in medians.items()], _tenth(index_percentile("_bottom", 0.2)).alias("bottom"), F.median("_area").alias("_area"))
    out = m.join(size, job).join(_typography(spans, lines, sampled, job, 48.0, 30.0), job, "left")
    extent = {k: "height" if k in ("top", "bottom") else "width" for k in (*medians, "bottom")}
    out = out.withColumns({k: _tenth(_within(F.col(k), F.col(e), 0.4)) for k, e in extent.items()})
    tall = F.coalesce((F.col("_area") >= 600) & (F.col("height") >= 750), F.lit(False))
    grown = lambda c, least, to: F.when(tall & F.coalesce(F.col(c) < least, F.lit(True)), to).otherwise(F.col(c))
    return out.select(job, "width", "height", *extent, (F.abs(F.col("inside") - F.col("outside")) >= 4.0).alias("is_asymmetric"), grown("font_size", 14.5, 15.0).alias("font_size"), grown("leading", 8.0, 9.5).alias("leading"))


def sidehead_blocks(blocks: DataFrame, by: list[str], header: float = 85.0, footer: float = 750.0) -> DataFrame:
    """Content blocks between header and footer with ``is_sidehead``: short ones at the left edge.

    ``blocks`` has block_type, box, text and page_w; blocks under 18 x 6.5 points or three characters are left out.
    """
    t = F.length(X.strip(F.regexp_replace("text", r"\s+", " ")))
    ok = (F.col("block_type") == 0) & (F.length(X.strip(F.col("text"))) >= 2) & (F.col("y0") >= header) & (F.col("y1") <= footer)
    big = (F.col("x1") - F.col("x0") >= 18.0) & (F.col("y1") - F.col("y0") >= 6.5) & (t >= 3)
    side = (F.col("x0") < F.col("page_w") * 0.28) & (F.col("x1") < F.col("page_w") * 0.35) & (t <= 80)
    return blocks.where(ok & big).withColumn("is_sidehead", side)


def layout_profile(pages: DataFrame, blocks: DataFrame, spans: DataFrame, lines: DataFrame, job: str = "job") -> DataFrame:
    """A row per job: macro layout, margins, zones and type of its pages.

    Inputs as of ``layout_calibration``, ``blocks`` with block_type as well.  The size is that of the
    first page.  Margins are medians over all blocks of the body, inside and outside over pages by
    their parity, within 18 points and 45 % of the page.  A job without blocks of its body has the
    margins of an empty page: 50 points at the sides, 55 at top and bottom.  The marginal zone is
    null unless side-heads make the layout.
    """
    keys = [job, "page"]
    size = pages.groupBy(job).agg(F.count("*").alias("total_pages"), F.min_by("page_w", "page").alias("page_w"), F.min_by("page_h", "page").alias("page_h"))
    b = sidehead_blocks(blocks.drop("page_w", "page_h").join(size.select(job, "page_w"), job), keys)
    main, side = ~F.col("is_sidehead"), F.col("is_sidehead")
    mid = F.when(main & (F.col("x1") - F.col("x0") < F.col("page_w") * 0.42), (F.col("x0") + F.col("x1")) / 2)
    half = F.col("page_w") * 0.5
    per_page = b.groupBy(*keys).agg(
        F.count_if(side).alias("_side"), F.count_if(main).alias("_main"), F.count_if(mid < half).alias("_l"), F.count_if(mid >= half).alias("_r"),
        F.min(F.when(main, F.col("x0"))).alias("_x0"), (F.max("page_w") - F.max(F.when(main, F.col("x1")))).alias("_out"),
    )
    marginal = (F.col("_side") > 0) & (F.col("_main") >= 2)
    even = F.col("page") % 2 == 0
    per_page = per_page.withColumns({"_marginal": marginal, "_multi": (F.col("_l") + F.col("_r") >= 6) & (F.col("_l") >= 3) & (F.col("_r") >= 3), "_in": F.when(even, F.col("_x0")).otherwise(F.col("_out")), "_ex": F.when(even, F.col("_out")).otherwise(F.col("_x0"))})
    shares = per_page.groupBy(job).agg(F.count_if("_marginal").alias("pages_with_marginalia"), F.count_if("_multi").alias("pages_with_multicolumn"), F.median("_in").alias("_in"), F.median("_ex").alias("_ex"))
    of = lambda c, which: F.median(F.when(which, F.col(c)))
    heads = side & F.col("_marginal")
    body = b.join(per_page.select(*keys, "_marginal"), keys).groupBy(job).agg(*[of(c, main).alias(f"_{c}") for c in ("x0", "x1", "y0", "y1")], of("x0", heads).alias("_m0"), of("x1", heads).alias("_m1"))
    x = size.join(shares, job, "left").join(body, job, "left").join(_typography(spans, lines, per_page.where("_main > 0"), job, 24.0, 25.0), job, "left")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("pages_with_marginalia", "pages_with_multicolumn")}
    w, h = F.col("page_w"), F.col("page_h")
    x = x.withColumns(counts).withColumns({
        "left": _within(F.coalesce("_x0", F.lit(50.0)), w, 0.45), "right": _within(w - F.coalesce("_x1", w - 50.0), w, 0.45),
        "top": _within(F.coalesce("_y0", F.lit(55.0)), h, 0.45), "bottom": _within(h - F.coalesce("_y1", h - 55.0), h, 0.45),
        "_m0": F.coalesce("_m0", F.lit(45.0)), "_m1": F.coalesce("_m1", F.lit(150.0)),
        "marginalia_ratio": F.col("pages_with_marginalia") / F.col("total_pages"), "multicolumn_ratio": F.col("pages_with_multicolumn") / F.col("total_pages"),
    })
    x = x.withColumns({"inside": _within(F.coalesce("_in", "left"), w, 0.45), "outside": _within(F.coalesce("_ex", "right"), w, 0.45)})
    layout = F.when(F.col("multicolumn_ratio") >= 0.25, "multi_column_grid").when(F.col("marginalia_ratio") >= 0.08, "marginal_sideheads").otherwise("single_column")
    tenth = lambda c: F.bround(c, 1)
    zone = F.struct(tenth(F.col("_m0")).alias("x0"), tenth(F.col("_m1")).alias("x1"), tenth(F.col("_m1") - F.col("_m0")).alias("width"), tenth(F.col("left") - F.col("_m1")).alias("gutter"))
    text = F.struct(tenth(F.col("left")).alias("x0"), tenth(w - F.col("right")).alias("x1"), tenth(w - F.col("right") - F.col("left")).alias("width"))
    return x.select(
        job, "total_pages", tenth(w).alias("width"), tenth(h).alias("height"), layout.alias("macro_layout"), "pages_with_marginalia", F.bround("marginalia_ratio", 3).alias("marginalia_ratio"),
        "pages_with_multicolumn", F.bround("multicolumn_ratio", 3).alias("multicolumn_ratio"), *[tenth(F.col(c)).alias(c) for c in ("left", "right", "inside", "outside", "top", "bottom")],
        (F.abs(F.col("inside") - F.col("outside")) >= 4.0).alias("is_asymmetric"), "font_size", "leading", F.when(layout == "marginal_sideheads", zone).alias("marginal_zone"), text.alias("body_zone"),
    )


def scan_margins(pages: DataFrame, by: list[str]) -> DataFrame:
    """5th and 95th percentile of the ink's extents, by linear interpolation."""
    return pages.groupBy(*by).agg(F.percentile("x0", 0.05).alias("left"), F.percentile("x1", 0.95).alias("right"), F.percentile("y0", 0.05).alias("top"), F.percentile("y1", 0.95).alias("bottom"))


def synthesize_profile(samples: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """Medians of sampled measures, with defaults for those that no sample has."""
    return samples.agg(*[F.coalesce(F.median(k), F.lit(float(v))).alias(k) for k, v in defaults.items()])


def word_collisions(words: DataFrame, by: list[str], step: float = 1.5, most: float = 3.0) -> DataFrame:
    """Words of one line (their top to the nearest ``step``) whose boxes overlap by more than ``most``."""
    line = F.rint(F.col("y0") / step) * step
    w = Window.partitionBy(*by, "line").orderBy("x0", "x1")
    lap = F.least("x1", F.col("next_x1")) - F.col("next_x0")
    return words.withColumn("line", line).withColumns({"next_x0": F.lead("x0").over(w), "next_x1": F.lead("x1").over(w)}).where(lap > most)


def layout_audit(words: DataFrame, pages: DataFrame, by: list[str], min_clash_pairs: int = 2, blocks: DataFrame | None = None, spans: DataFrame | None = None, least_width: float = 0.25, least_size: float = 5.5) -> DataFrame:
    """Per page its clashes and whether it is at fault; pages without words count as clean.

    With ``blocks`` (by, x0, x1, text; ``pages`` then has page_w) text narrower than a share of the page
    is a fault of pages of 25 words and more, with ``spans`` (by, size, text) the smallest type of
    pages of 15 words and more.  A page with several faults is one faulty page.
    """
    c = word_collisions(words, by).groupBy(*by).agg(F.count("*").alias("clashes"))
    measures = [] if blocks is None else ["page_w"]
    a = pages.select(*by, *measures).dropDuplicates(by).join(c, by, "left").withColumn("clashes", F.coalesce("clashes", F.lit(0)))
    faulty = F.col("clashes") >= min_clash_pairs
    if blocks is None and spans is None:
        return a.withColumn("faulty", faulty)
    a = a.join(words.groupBy(*by).agg(F.count("*").alias("words")), by, "left").withColumn("words", F.coalesce("words", F.lit(0)))
    if blocks is not None:
        extent = blocks.where(F.length(X.strip(F.col("text"))) > 8).groupBy(*by).agg((F.max("x1") - F.min("x0")).alias("text_w"))
        share = F.when(F.col("page_w") > 0, F.col("text_w") / F.col("page_w")).otherwise(1.0)
        a = a.join(extent, by, "left").withColumn("narrow", F.coalesce((F.col("words") >= 25) & F.col("text_w").isNotNull() & (share < least_width), F.lit(False)))
        faulty = faulty | F.col("narrow")
    if spans is not None:
        least = spans.where(X.strip(F.col("text")) != "").groupBy(*by).agg(F.min("size").alias("min_size"))
        a = a.join(least, by, "left").withColumn("tiny", F.coalesce((F.col("words") >= 15) & (F.col("min_size") < least_size), F.lit(False)))
        faulty = faulty | F.col("tiny")
    return a.withColumn("faulty", faulty)


def audit_summary(audit: DataFrame, reference_pages: int | None = None, min_clash_pairs: int = 2) -> DataFrame:
    """Counts of pages by fault over a whole ``layout_audit``, the share of clean pages in percent (100 without pages) and whether the page counts agree."""
    pages, faulty = F.count("*"), F.count_if("faulty")
    score = F.when(pages == 0, 100.0).otherwise(F.bround((pages - faulty) / pages * 100, 2))
    counts = [F.count_if(F.col("clashes") >= min_clash_pairs).alias("collisions")] + [F.count_if(c).alias(f"{c}_pages") for c in ("narrow", "tiny") if c in audit.columns]
    agree = F.lit(True) if reference_pages is None else pages == reference_pages
    return audit.agg(pages.alias("pages"), (pages - faulty).alias("clean_pages"), score.alias("quality_percent"), *counts, agree.alias("concordance_ok"))


def clean_share(audit: DataFrame) -> DataFrame:
    """Percentage of pages without fault; 100 for no pages."""
    return audit.agg(F.count("*").alias("pages"), F.count_if("faulty").alias("faulty_pages")).withColumn("clean_percent", F.when(F.col("pages") == 0, 100.0).otherwise(100.0 * (F.col("pages") - F.col("faulty_pages")) / F.col("pages")))


def page_verdict(overlap: Column, orig_tokens: Column, dig_tokens: Column, lost_sidehead: Column, fill_delta: Column, orig_fill: Column, centre_delta: Column) -> tuple[Column, Column]:
    """(status, warnings) of a page pair; ratios are rounded before they are compared, the overlap isn't."""
    fill_delta, orig_fill, centre_delta = (F.round(x, 3) for x in (fill_delta, orig_fill, centre_delta))
    fail = (overlap < 0.45) & ((orig_tokens > 20) | (dig_tokens > 20))
    moderate = ~fail & (overlap < 0.65) & (orig_tokens > 15)
    fill = (fill_delta > 0.35) & (orig_fill > 0.40)
    shift = centre_delta > 0.18
    warnings = F.array_compact(
        F.array(
            F.when(fail, "low token overlap").when(moderate, "moderate token overlap"),
            F.when(lost_sidehead, "side-head lost"),
            F.when(fill, "vertical fill differs"),
            F.when(shift, "horizontal density shifted"),
        )
    )
    return F.when(fail, "FAIL").when(F.size(warnings) > 0, "WARN").otherwise("PASS"), warnings


def page_pairs(original: DataFrame, digital: DataFrame, by: list[str]) -> DataFrame:
    """Pages (by, text) that both editions have: (by, original, digital)."""
    o = original.select(*by, F.col("text").alias("original"))
    return o.join(digital.select(*by, F.col("text").alias("digital")), by)


def _token_set(c: Column) -> Column:
    """The distinct tokens of a text; a null text has none."""
    return F.array_distinct(X.concordance_tokens(F.coalesce(c, F.lit(""))))


def _overlap(a: str, b: str) -> Column:
    """Jaccard overlap from the sizes of two sets and ``shared``; two empty ones agree wholly."""
    union = F.col(a) + F.col(b) - F.col("shared")
    return F.when(union == 0, 1.0).otherwise(F.col("shared") / union)


def token_overlaps(pairs: DataFrame) -> DataFrame:
    """Adds the distinct tokens of both texts of a pair, those they share, and their Jaccard overlap; null texts have none."""
    p = pairs.withColumns({"_o": _token_set(F.col("original")), "_d": _token_set(F.col("digital"))})
    p = p.select(*pairs.columns, F.size("_o").alias("original_tokens"), F.size("_d").alias("digital_tokens"), F.size(F.array_intersect("_o", "_d")).alias("shared"))
    return p.withColumn("overlap", _overlap("original_tokens", "digital_tokens"))


def cross_overlaps(passages: DataFrame, documents: DataFrame) -> DataFrame:
    """Each passage (item_id, text) with each document (doc_id, text): their distinct tokens, those they share, and the Jaccard overlap.

    Nothing blocks a pair, so weak and empty overlaps are there too.  Null texts have no tokens; rows of one id
    or without id are rows of their own.  Shared tokens are counted from a join by token, to which each pair
    comes once with none.
    """

    def sets(t: DataFrame, key: str, name: str) -> DataFrame:
        # Numbered where they are read, then dealt out, as a file may be one task; nothing is tokenised before.
        rows = t.select(key, F.monotonically_increasing_id().alias(f"_{name}"), "text").repartition(f"_{name}")
        return rows.select(key, f"_{name}", _token_set(F.col("text")).alias("_set")).select(key, f"_{name}", F.size("_set").alias(f"{name}_tokens"), "_set")

    b, d = sets(passages, "item_id", "item"), sets(documents, "doc_id", "doc")
    word = lambda t: t.withColumn("_word", F.explode_outer("_set")).drop("_set")
    keys = ["item_id", "doc_id", "_item", "_doc", "item_tokens", "doc_tokens"]
    met = word(d).join(word(b), "_word").select(*keys, F.lit(1).alias("_n"))
    every = d.drop("_set").crossJoin(b.drop("_set")).select(*keys, F.lit(0).alias("_n"))
    p = every.unionAll(met).groupBy(*keys).agg(F.sum("_n").cast("int").alias("shared"))
    return p.drop("_item", "_doc").withColumn("overlap", _overlap("item_tokens", "doc_tokens"))


def concordance(pairs: DataFrame, page_difference: Column | None = None) -> DataFrame:
    """Counts of verdicts, mean overlap and the verdict over all."""
    page_difference = F.lit(0) if page_difference is None else page_difference
    a = pairs.agg(F.count("*").alias("pages"), *[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("PASS", "WARN", "FAIL")], F.avg("overlap").alias("mean_overlap"))
    bad = (F.col("fail") > 0.05 * F.col("pages")) | (F.abs(page_difference) > 2)
    verdict = F.when((F.col("fail") > 0) | (page_difference != 0), F.when(bad, "FAIL").otherwise("WARN")).when(F.col("warn") > 0.2 * F.col("pages"), "WARN").otherwise("PASS")
    return a.withColumn("verdict", verdict)


def missing_references(expected: DataFrame, pages: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by, missing): the distinct expected references (by, ref) that the page (by, text) doesn't hold, sorted.

    A page that isn't there, or whose text is null, holds none; a null reference isn't one.  References meet the text as one row
    a page, so the text travels once.
    """
    by = by or ["job", "page"]
    refs = expected.where("ref is not null").groupBy(*by).agg(F.sort_array(F.collect_set("ref")).alias("_refs"))
    x = refs.join(pages.select(*by, "text"), by, "left")
    gone = F.filter("_refs", lambda r: ~F.coalesce(F.contains(F.col("text"), r), F.lit(False)))
    return x.select(*by, gone.alias("missing")).where(F.size("missing") > 0)


def fit_levels(pages: DataFrame, ladder: list[tuple[int, float]]) -> DataFrame:
    """The first level of a ladder of (level, capacity) at which each page's content fits, else the last.

    Step-down without a loop, as fitting depends on the page alone; ``converged`` tells which fit.
    """
    fit = F.coalesce(*[F.when(F.col("need") <= capacity, level) for level, capacity in sorted(ladder)])
    return pages.select("job", "page", F.coalesce(fit, F.lit(max(level for level, _ in ladder))).alias("level"), fit.isNotNull().alias("converged"))


def table_shape(rows: DataFrame, by: list[str]) -> DataFrame:
    """Most columns, longest cell and number of numeric columns of Markdown tables (by, idx, text)."""
    cells = F.transform(F.split(F.regexp_replace("text", r"^\||\|$", ""), r"\|"), X.strip)
    r = rows.where(~F.col("text").rlike(r"^\|?[\s:|-]+$")).withColumn("cells", cells)
    flat = r.select(*by, "idx", F.posexplode("cells").alias("c", "cell"))
    head = F.min("idx").over(Window.partitionBy(*by))
    flat = flat.withColumn("is_head", F.col("idx") == head)
    cols = flat.groupBy(*by, "c").agg(F.max(F.length("cell")).alias("w"), F.coalesce(F.bool_and(F.when(~F.col("is_head"), F.col("cell").rlike(r"^[-+]?[\d.,]+%?$"))), F.lit(False)).alias("numeric"))
    return cols.groupBy(*by).agg((F.max("c") + 1).alias("columns"), F.max("w").alias("longest"), F.count_if("numeric").alias("numeric_columns"))


def fit_scale(needed: Column, available: Column, least: float = 0.82) -> Column:
    """The factor by which a page's content is scaled: 1 where it fits, else 0.98 of what would fit, at least ``least``."""
    return F.when(needed > available, F.greatest(F.lit(least), 0.98 * available / needed)).otherwise(1.0)


def offset_status(delta: Column, tight: float = 1.5, loose: float = 3.0) -> Column:
    """PASS, WARN or FAIL of a distance in points; null (nothing to compare) passes."""
    d = F.abs(delta)
    return F.when(d.isNull() | (d <= tight), "PASS").when(d <= loose, "WARN").otherwise("FAIL")


def typographic_diff(pages: DataFrame, superscript_most: float = 0.50) -> DataFrame:
    """Pages with a status for footer, hairline and superscript offsets, and ``verdict``: WARN unless all pass."""
    s = {c: offset_status(F.col(f"{c}_delta")) for c in ("footer", "hairline")}
    s["superscript"] = F.when(F.abs(F.coalesce("superscript_delta", F.lit(0.0))) <= superscript_most, "PASS").otherwise("WARN")
    x = pages.withColumns({f"{k}_status": v for k, v in s.items()})
    return x.withColumn("verdict", F.when(F.array_max(F.array(*[(F.col(f"{k}_status") != "PASS").cast("int") for k in s])) == 1, "WARN").otherwise("PASS"))
