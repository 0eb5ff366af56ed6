"""A lookup join whose hot keys are spread over tasks by measured counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# A key with more than one in PARTS of all rows is split; so at most PARTS keys are, into 2 * PARTS pieces in all.
PARTS = 1024


def skew_lookup(
    large: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    rows: str,
    spread: Sequence[str],
    how: str = "left",
    parts: int = PARTS,
) -> DataFrame:
    """`large` with the columns of `small`, whose rows for hot keys are repeated and met by a share of the key's rows each.

    `small` has each key once and in `rows` how many rows of `large` hold it;
    it is read three times and should be a written table. The columns `spread`
    tell the rows of a key apart. No task gets more than about one in `parts`
    of the rows because of one key, with or without adaptive execution. The
    list of hot keys, `parts` rows at most, is broadcast.
    """
    total = small.agg(F.sum(rows).alias("total")).scalar()
    pieces = F.ceil(F.col(rows) * parts / total)
    hot = small.where(F.col(rows) * parts > total).select(*keys, pieces.alias("skew_pieces"))
    piece = F.coalesce(F.pmod(F.xxhash64(*spread), F.col("skew_pieces")), F.lit(0))
    spread_out = large.join(F.broadcast(hot), list(keys), "left").withColumn("skew_piece", piece).drop("skew_pieces")
    every = F.sequence(F.lit(0).cast("long"), F.greatest(pieces, F.lit(1).cast("long")) - 1)
    repeated = small.withColumn("skew_piece", F.explode(every))
    return spread_out.join(repeated, [*keys, "skew_piece"], how).drop("skew_piece")
