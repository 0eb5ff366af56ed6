"""Merkle manifest of a dataset: hash trees per source below one root, and the proof of every row.

A row's leaf is the hash of its fields. Within a source the leaves ascend by
id; every three consecutive nodes, the last ones perhaps fewer, have the hash
of them as parent, until one node is left, the subroot. The subroots, in
order of the sources, have the root above them in the same way.

The levels are built by one grouping each, a third of the rows of the one
below, and stored as nodes that name their parent. A recursive query then
climbs from every leaf to the root: each step joins the node above, takes the
siblings for the proof and folds the hash that the leaf has now, so that a row
changed since the manifest was made is known by the root it arrives at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from logloom.operators.lookup import skew_lookup
from logloom.operators.numbering import dense_numbers
from logloom.scratch import Scratch

ARITY = 3
# Nodes above more than one in WIDE of all leaves are broadcast: that many on a level at most.
WIDE = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def hash_of(*parts: Column) -> Column:
    """The hash of concatenated strings, as bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaf_hash(fields: Sequence[Column]) -> Column:
    """The hash of a row: each field as its count of UTF-8 bytes, a colon and the value, or `-` if null."""
    texts = [field.cast("string") for field in fields]
    return hash_of(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _at(above: Column) -> Column:
    """Where a node goes: three times the number of the run above and the place in it; `above` for the last node of a tree."""
    inside = ARITY * (F.col("base") + F.floor(F.col("pos") / ARITY)) + F.col("pos") % ARITY
    return F.coalesce(F.when(F.col("n") > 1, inside), above).cast("long")


def _levels(nodes: DataFrame, most: int, above: Column, work: Scratch) -> tuple[DataFrame, DataFrame]:
    """The runs of all levels above `nodes`, and the last node of every tree.

    `nodes` has tree, pos, n (nodes of the tree on this level), base (the
    number of the tree's first run above), hash and leaves (rows beneath).
    Runs have run (their number), at (see `_at`), children (the hashes, end to
    end) and leaves. `most` is the largest n.
    """
    runs, tops = [], []
    while True:
        nodes = nodes.withColumn("at", _at(above))
        nodes = nodes if not runs else work.keep(nodes, f"level-{len(runs)}", compression="zstd")
        if runs:
            runs[-1] = nodes.select("run", "at", "children", "leaves")
        tops.append(nodes.where("n = 1").select("tree", "hash", "leaves"))
        if most <= 1:
            break
        below = nodes.where("n > 1").withColumn("run", F.expr(f"at div {ARITY}"))
        held = below.groupBy("tree", "n", "base", "run").agg(
            F.array_sort(F.collect_list(F.struct("pos", "hash"))).alias("held"), F.sum("leaves").alias("leaves")
        )
        children = F.concat(*[F.coalesce(F.get("held", F.lit(i))["hash"], F.lit(b"")) for i in range(ARITY)])
        held = held.withColumn("children", children)
        n = F.ceil(F.col("n") / ARITY)
        nodes = held.select(
            "tree", (F.col("run") - F.col("base")).alias("pos"), n.alias("n"), (F.col("base") + n).alias("base"),
            "run", "children", hash_of(_hex(F.col("children"))).alias("hash"), "leaves",
        )
        runs.append(nodes)
        most = -(-most // ARITY)
    return _union(runs), _union(tops)


def _union(parts: list[DataFrame]) -> DataFrame | None:
    found = None
    for part in parts:
        found = part if found is None else found.unionAll(part)
    return found


# One step up per round: `at` leads to the run above, whose other children are the siblings.
CLIMB = f"""
WITH RECURSIVE climb (leaf, depth, at, folded, siblings) AS (
    SELECT leaf, depth, at, folded, siblings FROM {{start}}
    UNION ALL
    SELECT leaf, depth + 1, next,
           unhex(sha2(lower(hex(concat(before, folded, after))), 256)),
           concat(before, after)
    FROM (SELECT c.leaf, c.depth, c.folded, r.at AS next,
                 substring(r.children, 1, cast(32 * (c.at % {ARITY}) AS int)) AS before,
                 substring(r.children, cast(32 * (c.at % {ARITY}) + 33 AS int)) AS after
          FROM climb c JOIN {{runs}} r ON c.at div {ARITY} = r.run)
)
SELECT leaf, depth, at, folded, siblings FROM climb
"""


def _climb(start: DataFrame, runs: DataFrame, work: Scratch, *, to_the_end: bool = False) -> DataFrame:
    """The rows of `start` and those of all steps up from them, written; `to_the_end`: the steps alone, the hash where one arrives at the root."""
    spark = start.sparkSession
    limit = "spark.sql.cteRecursionRowLimit"
    was = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # all leaves climb
    try:
        climb = spark.sql(CLIMB, start=start, runs=runs)
        if to_the_end:
            climb = climb.where("siblings IS NOT NULL").select("leaf", "depth", F.when(F.col("at").isNull(), F.col("folded")).alias("folded"), "siblings")
        return work.keep(climb, "climb", compression="zstd")
    finally:
        spark.conf.set(limit, was)


def merkle_manifest(
    docs: DataFrame,
    work: Scratch,
    *,
    fields: Sequence[str] = FIELDS,
    id_column: str = "doc_id",
    source_column: str = "source",
    now: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of `docs`: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    `now` maps fields to what they are by now (expressions over `docs`); the
    folded root comes from these and the siblings of the original tree, and
    verified says whether it is the root. proof_sha256 is the hash of the
    siblings, level by level up to the root, left to right; of nothing if
    there are none.

    Every field may be null. Rows without id come first in their source, rows
    of one id in the order of their leaves, so rows repeated whole are leaves
    side by side; rows without source are a source of their own, the first
    one. A very long text costs its hashing only. Columns other than `fields`,
    whatever their names, say nothing. An empty table gives no rows.
    """
    spark = docs.sparkSession
    column = {name: F.col(f"`{name}`") for name in {*fields, id_column, source_column}}
    changed = column | (now or {})
    rows = docs.select(
        column[id_column].alias("id"),
        F.struct(column[source_column].alias("name")).alias("source"),  # equal where the name is null
        leaf_hash([column[f] for f in fields]).alias("hash"),
        leaf_hash([changed[f] for f in fields]).alias("folded"),
    )
    leaves = dense_numbers(rows, ["source", "id", "hash", "folded"], "leaf", work)
    leaves = work.keep(leaves, "leaves", compression="zstd")
    sources = leaves.groupBy("source").agg(F.count("*").alias("n"), F.min("leaf").alias("base"))
    sources = work.keep(dense_numbers(sources, ["source"], "tree", work), "sources")
    count, trees, most = sources.agg(F.sum("n"), F.count("*"), F.max("n")).first()
    id_type = docs.schema[id_column].dataType.simpleString()
    if not count:
        return spark.createDataFrame(
            [], f"`{id_column}` {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        )
    # numbers of runs: a tree of n leaves has fewer than n, the top tree's come after all others
    above = ARITY * (F.lit(count) + F.floor(F.col("tree") / ARITY)) + F.col("tree") % ARITY if trees > 1 else F.lit(None).cast("long")
    leaves = skew_lookup(leaves, sources, ["source"], "n", ["leaf"], "inner")
    leaves = leaves.select("id", "leaf", "hash", "folded", "tree", "n", "base", (F.col("leaf") - F.col("base")).alias("pos"))
    leaves = work.keep(leaves.withColumn("leaves", F.lit(1).cast("long")), "placed-leaves", compression="zstd")
    runs, subroots = _levels(leaves, most, above, work)
    subroots = work.keep(subroots, "subroots")
    top = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(trees).cast("long").alias("n"),
        F.lit(count).cast("long").alias("base"), "hash", "leaves",
    )
    top_runs, roots = _levels(top, trees, F.lit(None).cast("long"), work)
    root = roots.select("hash").first()[0]
    found = [part for part in (runs, top_runs) if part is not None]
    climbed = _climb_all(leaves, found, above, count, work)
    proofs = climbed.groupBy("leaf").agg(
        F.max_by("folded", "depth").alias("folded_root"),
        F.array_sort(F.collect_list(F.when(F.col("siblings").isNotNull(), F.struct("depth", "siblings")))).alias("steps"),
    )
    proof = F.sha2(F.array_join(F.transform("steps", lambda s: _hex(s["siblings"])), ""), 256)
    proofs = proofs.select("leaf", "folded_root", proof.alias("proof"))
    kept = skew_lookup(leaves.select("id", "leaf", "hash", "tree"), _named(subroots), ["tree"], "beneath", ["leaf"], "inner")
    told = kept.join(proofs, "leaf")
    return told.select(
        F.col("id").alias(id_column),
        _hex(F.col("hash")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        _hex(F.lit(bytes(root))).alias("root"),
        F.col("proof").alias("proof_sha256"),
        _hex(F.col("folded_root")).alias("folded_root"),
        (F.col("folded_root") == F.lit(bytes(root))).alias("verified"),
    )


def _named(subroots: DataFrame) -> DataFrame:
    return subroots.select("tree", F.col("hash").alias("subroot"), F.col("leaves").alias("beneath"))


def _climb_all(leaves: DataFrame, found: list[DataFrame], above: Column, count: int, work: Scratch) -> DataFrame:
    """The steps of all leaves up to the root: below in joins that shuffle, above by nodes that are broadcast.

    Near the root all leaves meet the same few nodes. Those above more than
    one in WIDE of the leaves are few and broadcast; the others have as few
    leaves each, so no task of the shuffled joins gets a hot one.
    """
    none = F.lit(None).cast("binary").alias("siblings")
    start = leaves.select("leaf", F.lit(0).alias("depth"), _at(above).alias("at"), "folded", none)
    if not found:
        return start
    runs = work.keep(_union(found), "runs", compression="zstd")
    wide = F.col("leaves") * WIDE > count
    climbed = start
    if not runs.where(~wide).isEmpty():
        climbed = _climb(start, runs.where(~wide), work)
    wide_runs = F.broadcast(runs.where(wide))
    # the rows whose next node is a broadcast one climb on
    ends = climbed.join(wide_runs.select(F.col("run").alias("next")), F.expr(f"at div {ARITY}") == F.col("next"), "left_semi")
    ends = ends.select("leaf", "depth", "at", "folded", none)
    higher = _climb(ends, wide_runs.select("run", "at", "children"), work, to_the_end=True)
    # the last run is above all leaves, so all hashes arrive in the second climb
    below = climbed.where("siblings IS NOT NULL").select("leaf", "depth", F.lit(None).cast("binary").alias("folded"), "siblings")
    return below.unionAll(higher)
