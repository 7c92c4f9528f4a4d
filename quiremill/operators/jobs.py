"""Jobs: reports, progress, access, validation, catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiremill.functions import text as X
from quiremill.operators.quality import quality_tier

COST_PER_PAGE = 0.004
#: Stage, least seconds, seconds a page, constant, most seconds.
ESTIMATES = [
    ("ingress", 1.0, 0.25, 0.0, None),
    ("preprocess", 1.0, 0.8, 0.0, None),
    ("local_ocr", 1.5, 1.0, 0.0, None),
    ("cloud_fallback", 1.5, 1.8, 0.0, None),
    ("sandwich", 2.0, 0.4, 3.0, 15.0),
    ("typeset", 2.0, 0.2, 2.0, 10.0),
    ("correction", 2.0, 0.3, 3.0, 12.0),
    ("report", 1.0, 0.1, 1.5, 8.0),
]
# What a language code, a typesetting mode and a paper size can be.
LANGUAGE = r"^[A-Za-z0-9+_-]{2,32}$"
TYPESET_MODES = ("reconstructed_1to1", "scholarly_reflow", "dictionary_grid", "paginated", "1to1")
PAPERS = ("iso-b5", "b5", "a4", "a5", "us-letter")
#: Suffix of an artefact and what it is for, in the order in which they are tried.
PURPOSES = [("_sandwich.pdf", "facsimile with text layer"), ("_digital.pdf", "typeset edition"), (".pdf", "document"), (".tei.xml", "TEI edition"), (".xml", "markup"), (".epub", "e-book"), (".book.json", "document model"), (".json", "data"), (".md", "text"), (".hocr", "layout"), (".txt", "plain text")]


def job_report(decisions: DataFrame, by: list[str], reported: DataFrame | None = None) -> DataFrame:
    """Statistics of page decisions: confidences, shares, tier and cost.

    ``reported`` (by, pages, passed, fallback_pages, fallback_ok), any column absent or null where unknown: what a job's
    report states counts before what is computed; confidences are always computed.
    """
    a = decisions.groupBy(*by).agg(
        F.count("*").alias("pages"),
        F.count_if(F.col("decision") == "fallback").alias("fallback_pages"),
        F.round(F.avg("mean_confidence"), 2).alias("mean_confidence"),
        F.round(F.min("mean_confidence"), 2).alias("min_confidence"),
        F.round(F.max("mean_confidence"), 2).alias("max_confidence"),
    )
    if reported is None:
        share = F.col("fallback_pages") / F.col("pages")
        return a.withColumns({"pass_ratio": (F.col("pages") - F.col("fallback_pages")) / F.col("pages"), "tier": quality_tier(F.coalesce("mean_confidence", F.lit(0.0)), share), "cost": F.col("fallback_pages") * COST_PER_PAGE})
    names = [c for c in ("pages", "passed", "fallback_pages", "fallback_ok") if c in reported.columns]
    a = a.join(reported.select(*by, *[F.col(c).alias(f"_{c}") for c in names]), by, "left")
    said = lambda c, other: F.coalesce(f"_{c}", other) if c in names else other
    pages, fallback = said("pages", F.col("pages")), said("fallback_pages", F.col("fallback_pages"))
    a = a.withColumns({"_n": pages, "_f": fallback, "_k": said("fallback_ok", fallback)}).withColumn("_p", said("passed", F.col("_n") - F.col("_f")))
    a = a.withColumns({"pages": F.col("_n"), "fallback_pages": F.col("_f")})
    none = F.col("pages") == 0
    passed, corrected = F.when(none, 0.0).otherwise(F.col("_p") / F.col("pages")), F.when(none, 0.0).otherwise(F.col("_k") / F.col("pages"))
    a = a.withColumns({"pass_ratio": passed, "tier": quality_tier(F.coalesce("mean_confidence", F.lit(0.0)), corrected), "cost": F.col("_k") * COST_PER_PAGE})
    return a.drop("_n", "_f", "_k", "_p", *[f"_{c}" for c in names])


def stage_progress(counts: DataFrame) -> DataFrame:
    """Eight rows a job from (job, pages, done map<stage, pages>): status, percent, estimated seconds."""
    rows = []
    for i, (stage, least, per_page, fixed, most) in enumerate(ESTIMATES):
        n = F.col("pages")
        seconds = F.greatest(F.lit(least), per_page * n + fixed)
        rows.append(F.struct(F.lit(i + 1).alias("ord"), F.lit(stage).alias("stage"), (F.least(seconds, F.lit(most)) if most else seconds).alias("estimate_s"), F.coalesce(F.element_at("done", stage), F.lit(0)).alias("done")))
    x = counts.select("job", "pages", F.inline(F.array(*rows)))
    percent = F.when(F.col("pages") == 0, 0.0).otherwise(F.least(F.lit(100.0), 100.0 * F.col("done") / F.col("pages")))
    status = F.when(F.col("pages") == 0, "pending").when(F.col("done") >= F.col("pages"), "completed").when(F.col("done") > 0, "running").otherwise("pending")
    return x.withColumns({"percent": percent, "status": status})


def overall_progress(stages: DataFrame) -> DataFrame:
    return stages.groupBy("job").agg((100.0 * F.count_if(F.col("status") == "completed") / F.count("*")).alias("percent"), F.sum(F.when(F.col("status") != "completed", F.col("estimate_s")).otherwise(0.0)).alias("left_s"))


def may(action: str, is_admin: Column, is_authenticated: Column, user: Column, email: Column, assigned_to: Column) -> Column:
    """Whether a user may ``view`` or ``trigger`` a job.

    Admins may all, an assignee what is theirs; an unassigned job is for all to view and for
    whoever is signed in to trigger.
    """
    assigned = F.coalesce(assigned_to, F.lit("")) != ""
    own = assigned & (assigned_to.eqNullSafe(user) | assigned_to.eqNullSafe(email))
    free = ~assigned & (F.lit(True) if action == "view" else is_authenticated)
    return F.coalesce(is_admin, F.lit(False)) | F.coalesce(own, F.lit(False)) | F.coalesce(free, F.lit(False))


def valid_job_name(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[A-Za-z0-9_.-]{1,64}$") & ~c.contains(".."), F.lit(False))


def valid_run_id(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[A-Za-z0-9_.-]{1,64}$"), F.lit(False))


def valid_language(c: Column, default: str = "deu+eng") -> Column:
    """The stripped code, or the default for what can't be one."""
    code = X.strip(c)
    return F.when(code.rlike(LANGUAGE), code).otherwise(default)


def _whole_number(c: Column, most: int) -> Column:
    text = X.strip(c.cast("string"))
    return F.coalesce(text.rlike(r"^[+-]?\d+$") & text.try_cast("long").between(0, most), F.lit(False))


def valid_threshold(c: Column) -> Column:
    return _whole_number(c, 100)


def valid_limit(c: Column) -> Column:
    return _whole_number(c, 100_000)


def valid_mode(c: Column) -> Column:
    """The stripped typesetting mode, or an empty string."""
    return F.when(X.strip(c).isin(*TYPESET_MODES), X.strip(c)).otherwise("")


def valid_paper(c: Column) -> Column:
    """The stripped paper size in lower case, or an empty string."""
    paper = F.lower(X.strip(c))
    return F.when(paper.isin(*PAPERS), paper).otherwise("")


def merged_options(*layers: Column) -> Column:
    """The first layer that sets an option: flag, configuration, environment, default."""
    return F.coalesce(*layers)


def job_catalogue(inputs: DataFrame, outputs: DataFrame, reports: DataFrame) -> DataFrame:
    """All jobs known from any side, with page counts, cost and whether there is a report; latest first."""
    i = inputs.groupBy("job").agg(F.count("*").alias("input_pages"), F.max("modified").alias("i_modified"))
    o = outputs.groupBy("job").agg(F.count("*").alias("artifacts"), F.sum("size").alias("bytes"), F.max("modified").alias("o_modified"))
    x = i.join(o, "job", "full_outer").join(reports.select("job", F.col("fallback_pages"), F.lit(True).alias("r")), "job", "left")
    return x.select("job", F.coalesce("input_pages", F.lit(0)).alias("input_pages"), F.coalesce("artifacts", F.lit(0)).alias("artifacts"), F.coalesce("bytes", F.lit(0)).alias("bytes"), (F.coalesce("fallback_pages", F.lit(0)) * COST_PER_PAGE).alias("cost"), F.coalesce("r", F.lit(False)).alias("has_report"), F.greatest("i_modified", "o_modified").alias("modified"))


def correction_statistics(corrections: DataFrame) -> DataFrame:
    """(job, page, level, pages, tokens, hits) of corrections (job, page, mapping, hits): a row per page, per job and for all.

    ``level`` is 0 for a page, 1 for a job (page null), 3 for all (both null); one pass by grouping sets.  A page without corrections counts with none.
    """
    x = corrections.select("job", "page", F.coalesce(F.size(F.map_keys("mapping")), F.lit(0)).alias("_t"), F.coalesce("hits", F.lit(0)).alias("_h"))
    return x.rollup("job", "page").agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("pages"), F.sum(F.greatest("_t", F.lit(0))).cast("long").alias("tokens"), F.sum("_h").cast("long").alias("hits"))


def artifact_inventory(files: DataFrame) -> DataFrame:
    """(job, file, size, purpose): the purpose by the first suffix that fits."""
    purpose = F.lit("other")
    for suffix, what in reversed(PURPOSES):
        purpose = F.when(F.col("file").endswith(suffix), what).otherwise(purpose)
    return files.select("job", "file", "size", purpose.alias("purpose"))


def unfinished(pages: DataFrame, results: DataFrame, on: list[str]) -> DataFrame:
    """Pages without a result that isn't empty: what is left to do."""
    return pages.join(results.where("size > 0").select(*on).distinct(), on, "left_anti")


def flagged_rows(pages: DataFrame, most: int = 35, otherwise: int = 15) -> DataFrame:
    """Pages that don't pass, at most ``most``; if all pass, the first ``otherwise`` of all (a report's feature)."""
    from pyspark.sql import Window

    w = Window.partitionBy("job").orderBy((F.col("status") == "PASS").cast("int"), "page")
    bad = F.sum((F.col("status") != "PASS").cast("int")).over(Window.partitionBy("job"))
    x = pages.withColumns({"_n": F.row_number().over(w), "_bad": bad})
    return x.where(F.when(F.col("_bad") > 0, (F.col("status") != "PASS") & (F.col("_n") <= most)).otherwise(F.col("_n") <= otherwise)).drop("_n", "_bad")
