"""Fuzzy hierarchy match (JOIN-7, WIN-1, S-24, S-25).

Two name paths match when they have equal length and at every level one
name contains the other.  Each left row takes the matching right row with
the smallest id; unmatched left rows are reported.

No pairs are enumerated per size class.  A path's form says at which levels
its names are non-empty; the forms that occur are few.  For a pair of forms
containment at a common non-empty level becomes equality of a *piece*, a
substring of at most ``gram`` characters: every name has a key, the rarest of
its pieces of the full length (a shorter name is its own key), and a name that
contains another one has the other's key among its pieces.  So a name meets
those that hold its key, and those whose key it holds, which is linear in the
length of a name.

The weights of the pieces (right paths that hold it; right paths keyed by it)
tell for every left name how many right paths it would meet, and each left
path meets the right ones at its cheapest level only: a name that a third of
all paths share is passed over wherever another level tells more.  Names are
compared as distinct names first; paths are then verified at every level.
Two forms without a common non-empty level match in all their rows; their
winner is the smallest id of the right form, an aggregate, so no pairs are
built for them either.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import arrays_match
from pageloom.session import materialize

#: A name's place: the right path's form and the level.
_AT = ["rform", "k"]


def pieces(c: Column, gram: int) -> Column:
    """Distinct substrings of 1 to ``gram`` characters."""
    n = F.length(c)
    each = F.transform(F.sequence(F.lit(1), F.lit(gram)), lambda ln: F.when(
        ln <= n, F.transform(F.sequence(F.lit(1), n - ln + 1), lambda i: F.substring(c, i, ln)))
        .otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.flatten(each))


def _may_be_key(name: str, gram: int) -> Column:
    return F.length("g") == F.least(F.lit(gram), F.length(name))


def _filled(names: Column) -> Column:
    """Per level, whether the name is non-empty."""
    return F.transform(names, lambda x: F.length(x) > 0)


def _paths(df: DataFrame, names: str) -> DataFrame:
    """Rows whose names can match at all: a NULL name matches nothing."""
    return df.where(F.col(names).isNotNull() & ~F.exists(names, lambda x: x.isNull()))


class Index(NamedTuple):
    """The right side's tables."""

    paths: DataFrame  # rform, rnames, rk
    pieces: DataFrame  # rform, k, b, g: the distinct names by piece
    keys: DataFrame  # rform, k, b, key: the distinct names by key
    weights: DataFrame  # rform, k, g, held, keyed: right paths that hold the piece; that are keyed by it


def index(R: DataFrame, gram: int) -> Index:
    """Keys and weights of the right paths ``R(rnames, rk, rform)``.  The
    weights are written before they are joined to the pieces: both sides are
    then plain inputs, and a piece that many names hold is split."""
    names = (R.select("rform", F.posexplode("rnames").alias("k", "b")).where(F.length("b") > 0)
             .groupBy(*_AT, "b").agg(F.count(F.lit(1)).alias("n")))
    held_by = names.withColumn("g", F.explode(pieces(F.col("b"), gram)))
    held = materialize(held_by.groupBy(*_AT, "g").agg(F.sum("n").alias("held")), "match-held")
    keys = materialize(held_by.where(_may_be_key("b", gram)).join(held, [*_AT, "g"])
                       .groupBy(*_AT, "b").agg(F.min(F.struct("held", "g")).alias("rarest"), F.first("n").alias("n"))
                       .select(*_AT, "b", "n", F.col("rarest.g").alias("key")), "match-keys")
    keyed = keys.groupBy(*_AT, F.col("key").alias("g")).agg(F.sum("n").alias("keyed"))
    weights = materialize(held.join(keyed, [*_AT, "g"], "left")
                          .select(*_AT, "g", "held", F.coalesce("keyed", F.lit(0)).alias("keyed")), "match-weights")
    return Index(R, held_by.drop("n"), keys.drop("n"), weights)


def cheapest_levels(L: DataFrame, shared: DataFrame, right: Index, gram: int) -> DataFrame:
    """For every left path ``L(lnames, lform)`` and right form ``shared(lform,
    rform, levels)``: the level at which it meets the fewest right paths, the
    name and key there and that number, ``meets``.  Pairs that meet none
    (there is a level at which no right name fits) are left out."""
    at = (L.join(shared, "lform").withColumn("k", F.explode("levels"))
          .select("lnames", *_AT, F.element_at("lnames", F.col("k") + 1).alias("a")))
    held = F.coalesce("held", F.lit(0))
    costs = (at.select(*_AT, "a").distinct().withColumn("g", F.explode(pieces(F.col("a"), gram)))
             .join(right.weights, [*_AT, "g"], "left").groupBy(*_AT, "a")
             .agg(F.min(F.when(_may_be_key("a", gram), F.struct(held.alias("held"), "g"))).alias("rarest"),
                  F.sum(F.coalesce("keyed", F.lit(0))).alias("back")))
    costs = materialize(costs.select(*_AT, "a", F.col("rarest.g").alias("key"),
                                     (F.col("rarest.held") + F.col("back")).alias("meets")), "match-costs")
    best = at.join(costs, [*_AT, "a"]).groupBy("lnames", "rform").agg(F.min(F.struct("meets", "k", "a", "key")).alias("best"))
    return best.select("lnames", "rform", "best.*").where("meets > 0")


def candidates(chosen: DataFrame, right: Index, gram: int) -> DataFrame:
    """``lnames, rk, rnames`` of the paths whose names at the chosen level
    contain one another; ``chosen`` from :func:`cheapest_levels`."""
    mine = chosen.select(*_AT, "a", "key").distinct()
    within = (mine.join(right.pieces.withColumnRenamed("g", "key"), [*_AT, "key"])
              .where(F.contains("b", "a")).select(*_AT, "a", "b"))
    around = (mine.drop("key").withColumn("key", F.explode(pieces(F.col("a"), gram)))
              .join(right.keys, [*_AT, "key"])
              .where(F.contains("a", "b") & (F.col("a") != F.col("b"))).select(*_AT, "a", "b"))
    named = chosen.select("lnames", *_AT, "a").join(within.unionByName(around), [*_AT, "a"])
    paths = right.paths.select("rform", "rk", "rnames", F.posexplode("rnames").alias("k", "b"))
    return named.join(paths, [*_AT, "b"]).select("lnames", "rk", "rnames")


def fuzzy_path_match(left: DataFrame, right: DataFrame, left_key: str = "sid",
                     right_key: str = "city_id", gram: int = 4) -> DataFrame:
    """``left(left_key, names array<string>)`` against ``right(right_key,
    names)``: one row per left row with the winning ``right_key`` (NULL when
    unmatched) and ``matched``.  ``gram`` is the length of the pieces; it
    bears on the work alone, never on the result.

    The table of forms is bounded by the depth of the paths, not by the row
    counts."""
    # Copies collapse first: equal name paths share one result, and among
    # equal right paths only the smallest id can win.  A path held by a
    # third of all rows is then one row on each side, not a third of pairs.
    left_rows = left.select(F.col(left_key).alias("sid_"), "names")
    # Both are written: each is read several times below.
    L = materialize(_paths(left.select(F.col("names").alias("lnames")).distinct(), "lnames")
                    .withColumn("lform", _filled(F.col("lnames"))), "match-left")
    R = materialize(_paths(right.groupBy(F.col("names").alias("rnames")).agg(F.min(F.col(right_key)).alias("rk")), "rnames")
                    .withColumn("rform", _filled(F.col("rnames"))), "match-right")

    lforms = L.select("lform", F.size("lform").alias("n")).distinct()
    rforms = R.groupBy("rform").agg(F.min("rk").alias("lowest")).withColumn("n", F.size("rform"))
    both = F.zip_with("lform", "rform", lambda a, b: a & b)
    levels = F.filter(F.transform(both, lambda x, i: F.when(x, i)), lambda i: i.isNotNull())
    forms = materialize(lforms.join(rforms, "n").select("lform", "rform", "lowest", levels.alias("levels")), "match-forms")

    # forms without a common non-empty level: all their rows match, the smallest id wins
    free = L.join(forms.where(F.size("levels") == 0), "lform").select("lnames", F.col("lowest").alias("rk"))

    idx = index(R, gram)
    chosen = materialize(cheapest_levels(L, forms.select("lform", "rform", "levels"), idx, gram), "match-chosen")
    cand = candidates(chosen, idx, gram).where(arrays_match(F.col("lnames"), F.col("rnames"))).select("lnames", "rk")
    winners = cand.unionByName(free).groupBy("lnames").agg(F.min("rk").alias("winner"))
    return (left_rows.join(winners, F.col("names").eqNullSafe(F.col("lnames")), "left")
            .select(F.col("sid_").alias(left_key), F.col("winner").alias(right_key),
                    F.col("winner").isNotNull().alias("matched")))
