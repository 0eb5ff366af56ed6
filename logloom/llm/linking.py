"""Groups of linked records: connected components, and links found in buckets without listing all pairs of a bucket."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from logloom.scratch import Scratch


# Rows of links and buckets for one task: they are short, and many small tasks cost more than the work in them.
LINKS_PER_TASK = 50_000
ROWS_PER_TASK = 20_000
# Members of a bucket that are compared one by one to see which have any partner.
SMALL = 32
# Records of a bucket's largest group that the others meet in a round.
HEADS = 8
# Bitmaps of 4 kB that `maybe_among` broadcasts at most, 8 MB in all; each has PER_BITMAP places.
BITMAPS = 2048
PER_BITMAP = 32_768


def maybe_among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose `id` is one of `ids`, and a few others: a filter before an exact join, so that few rows travel to it.

    A broadcast bit stands for each id's hash. There are 32 bits or more for
    an id up to 2 million of them; of more ids, which share the bits that
    there are, more other rows get through, but none is lost.
    """
    among = ids.select("id").where("id IS NOT NULL")
    count = min(BITMAPS, 1 + 32 * among.count() // PER_BITMAP)
    hashed = F.pmod(F.xxhash64("id"), F.lit(count * PER_BITMAP))
    numbered = among.select(hashed.alias("hashed")).groupBy(F.bitmap_bucket_number("hashed").alias("bucket"))
    bitmaps = numbered.agg(F.bitmap_construct_agg(F.bitmap_bit_position("hashed")).alias("bits"))
    # 64 bits at a time, so that a look at a bit is a shift
    words = F.transform(F.sequence(F.lit(0), F.lit(PER_BITMAP // 64 - 1)), lambda i: F.conv(F.hex(F.substr("bits", 8 * i + 1, F.lit(8))), 16, -10).cast("long"))
    bitmaps = bitmaps.select("bucket", words.alias("words"))
    place = F.bitmap_bit_position(hashed).cast("int")
    word = F.get("words", F.shiftright(place, 6))
    # the first byte is the highest of its word
    is_set = F.call_function("shiftright", word, (7 - F.shiftright(place, 3) % 8) * 8 + place % 8).bitwiseAND(F.lit(1)) == 1
    met = rows.join(F.broadcast(bitmaps), F.bitmap_bucket_number(hashed) == F.col("bucket"))
    return met.where(is_set).select(*[f"`{c}`" for c in rows.columns])


def components(links: DataFrame, work: Scratch) -> DataFrame:
    """(id, component): for every end of a link the smallest id that links reach.

    `links` has two columns of one orderable type; rows with a null end or two
    equal ends say nothing. Every round hangs the neighbours of an id under
    the smallest of them ("large star" over larger neighbours, "small star"
    over smaller ones) until all ids hang under the last one; ids with very
    many neighbours only ever meet the one row that holds their smallest
    neighbour, in a join that adaptive execution splits.
    """
    a, b = (F.col(name) for name in links.columns)
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = work.keep(edges.where((a != b) & a.isNotNull() & b.isNotNull()).distinct(), "links")
    tasks = 1 + edges.count() // LINKS_PER_TASK
    while not _settled(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = F.least("u", "lowest")
        large = _with_lowest(both, work, tasks).where("v > u").select(F.col("v").alias("u"), lowest.alias("v"))
        large = work.keep(large.distinct().coalesce(tasks), "large-star")
        met = _with_lowest(large, work, tasks)
        ends = F.array(F.struct("u", F.col("lowest").alias("v")), F.struct(F.col("v").alias("u"), F.col("lowest").alias("v")))
        small = met.select(F.explode(ends).alias("edge")).select("edge.*").where("u <> v")
        edges = work.keep(small.distinct().coalesce(tasks), "small-star")
    found = edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return found.unionAll(roots.join(found, "id", "left_anti"))


def _with_lowest(edges: DataFrame, work: Scratch, tasks: int) -> DataFrame:
    """The smallest neighbour beside every edge; it is written first so that the join can split hot ids."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("lowest"))
    return edges.join(work.keep(lowest.coalesce(tasks), "lowest"), "u")


def _settled(edges: DataFrame) -> bool:
    """Whether every id hangs under one other, and that one under none."""
    hanging = edges.groupBy("u").agg(F.count("*").alias("n"))
    held = edges.select(F.col("v").alias("held")).distinct()
    return hanging.join(held, F.col("u") == F.col("held"), "left").where("n > 1 OR held IS NOT NULL").isEmpty()


def link_buckets(
    buckets: DataFrame,
    records: DataFrame | None,
    near: Callable[[str, str], Column],
    verifier: Callable[[DataFrame], Callable[[DataFrame], DataFrame]],
    work: Scratch,
    *,
    likely: Callable[[str, str], Column] | None = None,
    rounds: int = 5,
) -> DataFrame:
    """Verified links (a, b) that join every two records which share a bucket, are `near` and pass a check.

    `buckets` has rows (key, id), `records` has `id` and what `near(left,
    right)`, a condition on two aliases of its rows, looks at; without
    `records` the rows of `buckets` carry that. `verifier` is
    called once with all ids (`id`) that may have a link and returns a
    function that keeps of rows (a, b) the true links.

    Not every link is returned, but the same groups result. In a round the
    records of a bucket meet some of the bucket's largest group so far, other
    ones each time, and two that are `likely` (a condition like `near`) are
    checked; a bucket full of copies so costs a row per copy, not a row per
    pair. Rounds go on while the pairs whose ends lie in different groups are
    many times more than the rows, links are found and, after the second, a
    round leaves a tenth fewer of them, `rounds` times at most. At last all of
    these pairs that are `near` are checked, each in the first bucket that it
    shares. Rows with nothing near them in their small bucket are left out
    from the start, and tables are deleted as soon as the next ones are
    written: `work` should hold nothing but what is made here.
    """
    groups = work.keep(buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared-buckets")
    keyed = buckets.withColumnsRenamed({"id": "bucket_id", "key": "id"})
    shared = maybe_among(keyed, groups.select(F.col("key").alias("id"))).withColumnsRenamed({"id": "key", "bucket_id": "id"}).join(groups, "key")
    if records is None:
        every = work.keep(shared, "bucket-rows")
        tasks = 1 + every.count() // ROWS_PER_TASK
    else:
        shared = work.keep(shared, "shared-rows")
        tasks = 1 + shared.count() // ROWS_PER_TASK
        every = work.keep(shared.join(maybe_among(records, shared), "id").coalesce(tasks), "bucket-rows")
        work.release(shared)
    # a row with nothing near it in its small bucket makes no pair there; a record without other rows has no link
    other = every.where(f"n <= {SMALL}").alias("o")
    met = every.where(f"n <= {SMALL}").alias("s").join(
        other, (F.col("s.key") == F.col("o.key")) & (F.col("s.id") != F.col("o.id")) & near("s", "o"), "left_semi"
    )
    rows = met.unionAll(every.where(f"n > {SMALL}")).drop("n").withColumn("component", F.col("id"))
    rows = work.keep(rows.coalesce(tasks), "candidate-rows")
    work.release(every)
    tasks = 1 + rows.count() // ROWS_PER_TASK
    verify = verifier(work.keep(rows.select("id").distinct().coalesce(tasks), "candidates"))
    links: list[DataFrame] = []

    def mixed_buckets() -> DataFrame:
        """Buckets that hold several groups: the largest one, its smallest id, and how many rows there are of it and of all."""
        sizes = rows.groupBy("key", "component").agg(F.count("*").alias("n"), F.min("id").alias("head"))
        sizes = sizes.groupBy("key").agg(
            F.count("*").alias("groups"), F.sum("n").alias("all"), F.max(F.struct("n", "component", "head")).alias("top")
        )
        top = [F.col("top.n").alias("n"), F.col("top.component").alias("largest"), F.col("top.head").alias("head")]
        return work.keep(sizes.where("groups > 1").select("key", "all", *top).coalesce(tasks), "mixed-buckets")

    def relabelled(found: DataFrame) -> DataFrame:
        """The rows after each group took the label of the largest group that new links join it to, if that is larger."""
        members = work.keep(rows.select("id", "component").distinct().coalesce(tasks), "members")
        sizes = members.groupBy("component").agg(F.count("*").alias("n"))
        named = work.keep(members.join(sizes, "component").select("id", F.struct("n", "component").alias("group")), "named")
        ends = found.join(named.selectExpr("id AS a", "group AS x"), "a").join(named.selectExpr("id AS b", "group AS y"), "b")
        steps = ends.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x <> y")
        steps = steps.groupBy("x").agg(F.max("y").alias("y")).selectExpr("x.component AS source", "y.component AS target")
        steps = work.keep(steps.coalesce(tasks), "steps")
        again = steps.selectExpr("source AS target", "target AS beyond")
        steps = steps.join(again, "target", "left").select("source", F.coalesce("beyond", "target").alias("target"))
        labelled = rows.join(steps, F.col("component") == F.col("source"), "left")
        labelled = labelled.withColumn("component", F.coalesce("target", "component")).drop("source", "target", "largest", "head", "n")
        return replaced(labelled, "labelled-rows")

    def replaced(new: DataFrame, label: str) -> DataFrame:
        """`new`, which is made of the rows, written in their place."""
        new = work.keep(new.coalesce(tasks), label)
        work.release(rows)
        return new

    before = None
    for turn in range(rounds + 1):
        mixed = mixed_buckets()
        pairs, members = mixed.agg(F.sum(F.expr("(all - n) * all")), F.sum("all")).first()
        rows = replaced(rows.join(mixed.drop("all"), "key"), "mixed-rows")
        if turn == rounds or not pairs or pairs <= 2 * members or (links and links[-1].isEmpty()):
            break
        if turn > 1 and 10 * pairs > 9 * before:
            break
        before = pairs
        # the smallest id, which leads to few different heads; after that some HEADS by chance
        chance = F.xxhash64(F.lit(turn), "id")
        heads = rows.where("component = largest AND id = head") if not turn else rows.where(
            (F.col("component") == F.col("largest")) & (F.pmod(chance, F.greatest(F.lit(1), F.expr(f"n div {HEADS}"))) == 0)
        )
        met = rows.where("component <> largest").alias("s").join(heads.alias("h"), F.col("s.key") == F.col("h.key"))
        met = met.where((likely if likely and turn else near)("s", "h")).select(F.col("s.id").alias("s"), F.col("h.id").alias("h"))
        if turn:
            by_chance = F.struct(F.xxhash64(F.lit(turn), "h"), "h")
            met = met.groupBy("s").agg(F.min(by_chance)["h"].alias("one"), F.max(by_chance)["h"].alias("two"))
            met = met.select("s", F.explode(F.array("one", "two")).alias("h"))
        links.append(work.keep(verify(_ends(met, "s", "h")), "links-to-heads"))
        rows = relabelled(links[-1])

    rows = rows.join(rows.groupBy("id").agg(F.collect_set("key").alias("keys")).withColumnRenamed("id", "keys_id"), F.col("id") == F.col("keys_id"))
    rows = replaced(rows.drop("keys_id"), "rest-rows")
    strays = rows.where("component <> largest").alias("s")
    met = strays.join(rows.alias("o"), F.col("s.key") == F.col("o.key")).where(
        (F.col("s.component") != F.col("o.component"))
        & ((F.col("o.component") == F.col("o.largest")) | (F.col("s.id") < F.col("o.id")))
        & near("s", "o")
        & (F.col("s.key") == F.array_min(F.array_intersect("s.keys", "o.keys")))
    )
    links.append(work.keep(verify(_ends(met, "s.id", "o.id")), "links-of-strays"))
    return functools.reduce(DataFrame.unionAll, links)


def _ends(met: DataFrame, left: str, right: str) -> DataFrame:
    return met.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).distinct()
