"""Mixing sources to target weights.

A source's target is its share of all words by weight, but no more than a
given number of times its size. A source is first taken whole as often as its
target holds it; what is left is filled by Efraimidis-Spirakis sampling:
every document draws an exponential key divided by its quality weight, the
documents with the smallest keys are taken until their words fill the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logloom.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), most_times: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row each.

    Sources in code point order, null last, have the weights in turn. Targets
    share the sum of all sizes by weight; one that passes `most_times` its
    source's size stops there and the rest is shared anew. That ends where
    every free source has the same target per weight, so sources in the order
    of their limit per weight are stopped as long as the share of those after
    them still reaches it. The windows hold one row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    table = sizes.select("source", "source_size", weight.alias("weight"))
    table = table.withColumn("stop", F.col("source_size") * float(most_times))
    by_limit = Window.orderBy(F.col("stop") / F.col("weight"), "weight", F.col("source").isNull(), "source")
    earlier, whole = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    table = table.select(
        "*",
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("stop").over(earlier), F.lit(0.0))).alias("left_words"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))).alias("left_weight"),
    )
    table = table.withColumn("stopped", F.col("left_words") * F.col("weight") >= F.col("stop") * F.col("left_weight"))
    free = ~F.col("stopped")
    # the first source that isn't stopped has what all free ones share
    share = F.max(F.when(free, F.col("left_weight"))).over(whole)
    words = F.max(F.when(free, F.struct("left_weight", "left_words"))).over(whole)["left_words"]
    target = F.when(F.col("stopped"), F.col("stop")).otherwise(words * F.col("weight") / share)
    return table.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    work: Scratch,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    labels: DataFrame | None = None,
    seed: str = "mix",
    weights: tuple[int, ...] = (5, 2, 1),
    most_times: int = 3,
    bins: int = 4096,
) -> DataFrame:
    """One row per row of `docs`: id, digest (of the text), size, source_size, target, times, taken.

    times says how often the mix takes the document, taken is size * times.
    The quality weight of a document is 2 if the best of its `labels` (id,
    quality) is 1, 0.5 if that is 0, else 1. The documents of a source are cut
    into `bins` by key; words are summed by bin, and only the bin in which the
    source's rest ends is sorted, so no task sees a whole source. The document
    that crosses the end is taken if that comes nearer to it. Documents
    without words are never taken. Keys depend on seed, id and text alone:
    reruns agree, equal rows may swap. A null text has size 0; null is a
    source of its own. An empty table gives no rows.
    """
    text = F.col(text_column)
    named = F.concat_ws("|", F.lit(seed), F.col(id_column).cast("string"), F.md5(text.cast("binary")))
    sized = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(text).alias("digest"),
        F.col(source_column).alias("source"),
        word_count(text).alias("size"),
        F.conv(F.substring(F.md5(named), 1, 12), 16, 10).cast("long").alias("drawn"),
    )
    if labels is None:
        sized = sized.withColumn("weight", F.lit(1.0))
    else:
        best = labels.groupBy(F.col(id_column).alias("l_id")).agg(F.max("quality").alias("label"))
        weight = F.when(F.col("label") == 1, 2.0).when(F.col("label") == 0, 0.5).otherwise(1.0)
        sized = sized.join(best, F.col("id") == F.col("l_id"), "left").withColumn("weight", weight)
    # -ln of a uniform number in (0, 1), over the weight
    key = -F.ln((F.col("drawn") + 0.5) / float(1 << 48)) / F.col("weight")
    sized = sized.select("id", "digest", "source", "size", "drawn", key.alias("key"))
    # bins of about equal numbers of documents if all weights are 1
    place = F.floor((1 - F.exp(-F.col("key"))) * bins).cast("int")
    sized = work.keep(sized.withColumn("bin", F.least(place, F.lit(bins - 1))), "sizes")

    by_bin = work.keep(sized.groupBy("source", "bin").agg(F.sum("size").alias("words")), "bins")
    targets = source_targets(by_bin.groupBy("source").agg(F.sum("words").alias("source_size")), weights=weights, most_times=most_times)
    rest = F.col("target") - F.col("rounds") * F.col("source_size")
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("rounds", rounds).withColumn("rest", rest)
    targets = work.keep(targets.withColumnRenamed("source", "t_source"), "targets")

    # the bin in which the rest of a source ends, and the words of the bins before it
    running = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = by_bin.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    ends = sums.join(targets, F.col("source").eqNullSafe(F.col("t_source")))
    ends = ends.where("before <= rest AND rest < before + words")
    ends = ends.select(F.col("t_source").alias("e_source"), F.col("bin").alias("end_bin"), "before")
    plan = targets.join(ends, F.col("t_source").eqNullSafe(F.col("e_source")), "left").drop("e_source")
    plan = work.keep(plan, "plan")

    planned = sized.join(plan, F.col("source").eqNullSafe(F.col("t_source")))
    clear = planned.where("end_bin IS NULL OR bin <> end_bin")
    clear = clear.withColumn("more", F.when(F.col("bin") < F.col("end_bin"), 1).otherwise(0))
    order = Window.partitionBy("source").orderBy("key", "drawn", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.col("before") + F.sum("size").over(order)
    close = planned.where("bin = end_bin").withColumn("reach", reach)
    # taken if it ends within the rest, or passes its end by less than half
    close = close.withColumn("more", F.when(2 * F.col("reach") - F.col("size") <= 2 * F.col("rest"), 1).otherwise(0)).drop("reach")
    times = F.when(F.col("size") > 0, F.col("rounds") + F.col("more")).otherwise(0)
    return clear.unionByName(close).select(
        F.col("id").alias(id_column),
        "digest",
        "size",
        "source_size",
        F.col("target").cast("double").alias("target"),
        times.cast("long").alias("times"),
        (F.col("size") * times).cast("long").alias("taken"),
    )


def take_mix(
    docs: DataFrame, work: Scratch, *, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with all their columns, whatever their names.

    Rows that agree in id and text are all taken as often as the least taken of them.
    """
    part = work.part()
    mixed = mix(docs, part, id_column=id_column, text_column=text_column, **options)
    times = mixed.groupBy(F.col(id_column).alias("m_id"), F.col("digest").alias("m_digest")).agg(F.min("times").alias("m_times"))
    times = work.keep(times.where("m_times > 0"), "times")
    part.drop()
    copies = times.select("m_id", "m_digest", F.explode(F.expr("sequence(1L, m_times)"))).alias("t")
    digest = F.xxhash64(F.col(f"d.`{text_column}`"))
    same = F.col(f"d.`{id_column}`").eqNullSafe(F.col("t.m_id")) & (digest == F.col("t.m_digest"))
    return docs.alias("d").join(copies, same).select(*[F.col(f"d.`{c}`") for c in docs.columns])
