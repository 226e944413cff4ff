"""Recognition scores: counters of each page, then one aggregation for all groupings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.constants import DEFAULT_IOU, EMPTY_TEXT_TYPES, SCORE_WEIGHTS
from pagelens.functions.geometry import in_reading_order
from pagelens.functions.text import cer, normalize_text
from pagelens.operators.match import greedy_match
from pagelens.operators.pages import boxed, full


def is_scorable(r: Column) -> Column:
    """Legible Ukrainian text of a type that has text."""
    return (r["language"] == "uk") & (r["legibility"] == "legible") & ~r["type"].isin(EMPTY_TEXT_TYPES)


def compared(regions: Column, normalize=normalize_text) -> Column:  # noqa: ANN001
    """Regions with four coordinates, their text in the form in which it is compared; others are rejected."""
    one = lambda r: F.struct(*[r[c].alias(c) for c in ("bbox", "type", "language", "legibility")], normalize(r["text"]).alias("text"))
    return F.transform(boxed(regions), one)


def page_text(regions: Column, truth: bool) -> Column:
    """Compared texts in reading order, joined by spaces.  Truth counts only where scorable, a prediction unless image or graph."""
    ok = is_scorable if truth else lambda r: ~r["type"].isin(EMPTY_TEXT_TYPES)
    texts = F.transform(F.filter(in_reading_order(regions), ok), lambda r: r["text"])
    return F.array_join(F.filter(texts, lambda t: t != ""), " ")


def page_counters(truth: DataFrame, predictions: DataFrame, threshold: float = DEFAULT_IOU, normalize=normalize_text) -> DataFrame:  # noqa: ANN001
    """Counters of each truth page (image, source, annotation_source, tp, fp, fn, class_ok, cer_sum, cer_n, page_cer).

    ``truth`` has (image, source, annotation_source, regions), ``predictions`` (image, regions), each one row an image.
    Pages without predictions or without regions count.  One join by image; all else stays in the row, and each
    region's text is normalised once.
    """
    # Both sides are partitioned by image before the work of normalising, which the join then needs anyway; a
    # scan of a few large files would otherwise do that work in as few tasks.
    truth, predictions = truth.repartition("image"), predictions.repartition("image")
    t = truth.select("image", "source", "annotation_source", compared(F.col("regions"), normalize).alias("t"))
    p = predictions.select("image", compared(F.col("regions"), normalize).alias("p"))
    empty = F.filter("t", lambda _: F.lit(False))
    j = t.join(p, "image", "left").withColumn("p", F.coalesce("p", empty)).withColumn("m", greedy_match(F.col("p"), F.col("t"), threshold))
    pairs = F.transform("m", lambda m: F.struct(F.get("p", m["p"]).alias("p"), F.get("t", m["t"]).alias("t")))
    scored = F.transform(F.filter("pairs", lambda x: is_scorable(x["t"])), lambda x: cer(x["p"]["text"], x["t"]["text"]))
    n = F.size("m")
    return j.withColumn("pairs", pairs).withColumn("scored", scored).select(
        "image", "source", "annotation_source",
        n.cast("bigint").alias("tp"), (F.size("p") - n).cast("bigint").alias("fp"), (F.size("t") - n).cast("bigint").alias("fn"),
        F.size(F.filter("pairs", lambda x: x["p"]["type"] == x["t"]["type"])).cast("bigint").alias("class_ok"),
        F.aggregate("scored", F.lit(0.0), lambda a, x: a + x).alias("cer_sum"), F.size("scored").cast("bigint").alias("cer_n"),
        cer(page_text(F.col("p"), False), page_text(F.col("t"), True)).alias("page_cer"),
    )


def _ratio(a: Column, b: Column) -> Column:
    return a.cast("double") / F.greatest(F.lit(1).cast("bigint"), b).cast("double")


_SUMS = ["tp", "fp", "fn", "class_ok", "cer_sum", "cer_n", "page_cer"]


def score(sums: DataFrame, *keys: str) -> DataFrame:
    """Scores from summed counters (and ``pages``); a group without pages gives zeros, with the full schema."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    tp, precision, recall = z("tp"), _ratio(z("tp"), z("tp") + z("fp")), _ratio(z("tp"), z("tp") + z("fn"))
    out = sums.select(
        *keys, F.col("pages"), tp.alias("matched_regions"), precision.alias("precision"), recall.alias("recall"),
        (F.lit(2.0) * precision * recall / F.greatest(F.lit(1e-12), precision + recall)).alias("f1"),
        _ratio(z("class_ok"), tp).alias("class_acc"), _ratio(z("cer_sum"), z("cer_n")).alias("cer"), _ratio(z("page_cer"), F.col("pages")).alias("page_cer"),
    )
    good = lambda c: F.lit(1.0) - F.least(F.col(c), F.lit(1.0))
    w = SCORE_WEIGHTS
    total = F.col("f1") * w["f1"] + F.col("class_acc") * w["class_acc"] + good("cer") * w["cer"] + good("page_cer") * w["page_cer"]
    return out.withColumn("score", total).withColumn("proxy_score", F.col("f1") * good("cer"))


def overall(counters: DataFrame) -> DataFrame:
    """One row of scores over all pages."""
    return score(counters.agg(F.count("*").alias("pages"), *[F.sum(c).alias(c) for c in _SUMS]))


def grouped(counters: DataFrame) -> DataFrame:
    """Scores overall, by source and by annotation source, from one aggregation with grouping sets.

    Null and empty keys are the group ``unknown``.  Columns ``grouping`` (overall, source, annotation_source), ``key``.
    """
    key = lambda c: F.coalesce(full(F.col(c)), F.lit("unknown"))
    c = counters.withColumn("source", key("source")).withColumn("annotation_source", key("annotation_source"))
    sets = [[], [F.col("source")], [F.col("annotation_source")]]
    sums = c.groupingSets(sets, F.col("source"), F.col("annotation_source")).agg(
        F.grouping("source").alias("gs"), F.grouping("annotation_source").alias("ga"), F.count("*").alias("pages"), *[F.sum(x).alias(x) for x in _SUMS]
    )
    label = F.when(F.col("gs") == 0, "source").when(F.col("ga") == 0, "annotation_source").otherwise("overall")
    name = F.when(F.col("gs") == 0, F.col("source")).when(F.col("ga") == 0, F.col("annotation_source")).otherwise("overall")
    return score(sums.withColumn("grouping", label).withColumn("key", name), "grouping", "key")
