"""Quality gate: confidences of OCR words, summed up by page, and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid_words(words: DataFrame, conf: str = "conf", text: str | None = "text") -> DataFrame:
    """Words that count: a confidence of 0 or more, and text that isn't blank."""
    ok = F.col(conf) >= 0
    if text:
        ok = ok & (F.regexp_replace(text, r"(?U)\s+", "") != "")
    return words.where(ok)


def low_confidence_words(words: DataFrame, max_conf: float | None, all_words: bool = False, conf: str = "conf") -> DataFrame:
    """Words of at most ``max_conf``; a limit drops words without confidence, ``all_words`` keeps all."""
    return words if all_words or max_conf is None else words.where(F.col(conf) <= max_conf)


def quality_gate(words: DataFrame, threshold: float, pages: DataFrame | None = None, page: str = "page", conf: str = "conf") -> DataFrame:
    """One row per page: count, mean, least, greatest, five lowest confidences, decision.

    The mean is rounded to three places before it is held against the threshold.  ``pages`` adds
    pages without words, which fail with mean 0 and a note.  The five lowest are ranked within the
    page and cut before and after the shuffle, so no task holds a page's confidences.
    """
    rank = F.row_number().over(Window.partitionBy(page).orderBy(conf))
    lowest = words.where(F.col(conf).isNotNull()).select(page, conf).withColumn("_rank", rank).where("_rank <= 5")
    lowest = lowest.groupBy(F.col(page).alias("_page")).agg(F.sort_array(F.collect_list(conf)).alias("low_samples"))
    agg = words.groupBy(page).agg(
        F.count(conf).alias("word_count"),
        F.round(F.avg(conf), 3).alias("mean_confidence"),
        F.min(conf).alias("min_confidence"),
        F.max(conf).alias("max_confidence"),
    )
    agg = agg.join(lowest, F.col(page).eqNullSafe(F.col("_page")), "left").drop("_page")
    agg = agg.withColumn("low_samples", F.coalesce("low_samples", F.array().cast(lowest.schema["low_samples"].dataType)))
    if pages is not None:
        agg = pages.select(page).distinct().join(agg, page, "left").withColumns(
            {"word_count": F.coalesce("word_count", F.lit(0)), "mean_confidence": F.coalesce("mean_confidence", F.lit(0.0)), "low_samples": F.coalesce("low_samples", F.array().cast("array<double>"))}
        )
    passed = (F.col("word_count") > 0) & (F.col("mean_confidence") >= threshold)
    return agg.withColumns(
        {"threshold": F.lit(float(threshold)), "passed": passed, "decision": decision(passed), "note": F.when(F.col("word_count") == 0, "no words recognised")}
    )


def decision(passed: Column) -> Column:
    return F.when(passed, "pass").otherwise("fallback")


def quality_tier(avg: Column, corrected_ratio: Column) -> Column:
    """A, B or C from the mean confidence and the share of pages whose text came from the better recognition."""
    return F.when((corrected_ratio >= 0.8) | (avg >= 95), "A").when((avg >= 85) | (corrected_ratio >= 0.3), "B").otherwise("C")


def gate_counters(decisions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How many pages passed, failed and went to the fallback."""
    return decisions.groupBy(*(by or [])).agg(
        F.count("*").alias("pages"), F.count_if("passed").alias("passed_pages"), F.count_if(~F.col("passed")).alias("fallback_pages")
    )
