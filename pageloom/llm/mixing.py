"""Operator 3: mixing sources to target weights.

Every source has a weight; the mix has a size, of which each source gets a
share in proportion to its weight, but at most ``MOST`` times what it has;
what a source can't take goes to the others by weight.  A source whose
target is k whole epochs and a fraction takes every document k times, and
the fraction by Efraimidis-Spirakis sampling: a document's key is an
exponential variable divided by its quality weight, the documents are sorted
by key within the source, and those whose running size fits the fraction are
taken once more; what the first that doesn't fit leaves over is given, in the
same order, to documents small enough for it, the last of them if that comes
nearer to the target.  Documents are taken whole.  The
variable is drawn from a hash of identifier, size and seed, so reruns agree.

No source is sorted in one task (``common.running_sums``).

Cases: a null text has size 0; a null source is a source of its own, ordered
last; a source whose documents are all empty has target 0 and takes nothing;
a null quality counts as no label; rows that repeat
are separate documents (equal in key, hence adjacent); an empty table gives an
empty table.  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import WORD, running_sums, written

#: A source gives at most this many epochs.
MOST = 3
LEAST_QUALITY = 1e-3
#: Weights of the sources in code-point order, repeating.
CYCLE = (5.0, 2.0, 1.0)


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = 1.0) -> DataFrame:
    """``sizes`` (``source, source_size``) plus ``weight`` and ``target``:
    the fill level at which the capped shares add up to ``share`` of all
    sizes.  A source reaches its cap at level ``MOST * size / weight``; the
    level is found from running sums of caps and weights in that order."""
    # code-point order is byte order of UTF-8, Spark's order of strings; null last
    ranked = running_sums(sizes.select("*", F.col("source").isNull().alias("unnamed"), F.lit(1).alias("one")),
                          [], ["unnamed", "source"], {"rank": "one"}, "mix-sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in CYCLE]), (F.col("rank") % len(CYCLE) + 1).cast("int"))
    weighted = ranked.select("source", "source_size", weight.alias("weight"),
                             (F.lit(MOST) * F.col("source_size")).cast("double").alias("cap"))
    by_level = running_sums(weighted.withColumn("level", F.col("cap") / F.col("weight")), [],
                            ["level", F.col("source").isNull(), "source"],
                            {"caps": "cap", "weights": "weight"}, "mix-levels")
    total = by_level.agg((F.sum("source_size") * F.lit(share)).alias("total"), F.sum("weight").alias("all_weights"))
    # the first source in level order whose own level would use up the total:
    # it and all after it stay below their caps
    filled = by_level.crossJoin(F.broadcast(total)).where(
        F.col("caps") + F.col("level") * (F.col("all_weights") - F.col("weights")) >= F.col("total"))
    level = filled.agg(F.min_by((F.col("total") - F.col("caps")) / (F.col("all_weights") - F.col("weights")),
                                F.struct("level", F.col("source").isNull(), "source")).alias("fill"))
    return weighted.crossJoin(F.broadcast(level)).select(
        "source", "source_size", "weight",
        F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("fill"), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, labels: DataFrame | None = None, share: float = 1.0, seed: int = 0, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id_col, size, source_size, target,
    times`` (how often the mix takes the document) and ``taken`` (the words
    that makes).  ``labels`` gives the quality weights (:func:`quality_of`),
    without it all weigh 1; ``row_col`` names a column to hand through, as
    the link back to the rows.  Texts are only measured, never shuffled."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       size_in_words(F.col(text_col)).alias("size"),
                       F.col(row_col).alias("row") if row_col else F.lit(None).cast("string").alias("row"))
    rows = quality_of(rows, labels) if labels is not None else rows.withColumn("q", F.lit(1.0))
    rows = rows.withColumn("q", F.greatest("q", F.lit(LEAST_QUALITY)))
    # a number in (0, 1] from 52 bits of a digest
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")), "size"))
    unit = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1) / F.lit(float(1 << 52))
    rows = written(rows.withColumn("key", -F.ln(unit) / F.col("q")).drop("q"), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = written(targets(sizes, share), "mix-targets")
    order = ["key", "id", "size", "row"]
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goal = goals.select("source", "source_size", "target", whole.cast("long").alias("whole"),
                        (F.col("target") - whole * F.col("source_size")).alias("rest"))
    runs = _beside(running_sums(rows, ["source"], order, {"before": "size"}, "mix-keys"), goal)
    fits = (F.col("size") > 0) & (F.col("whole") < MOST) & (F.col("before") + F.col("size") <= F.col("rest"))
    runs = written(runs.withColumn("chosen", fits).drop("before"), "mix-first")
    # what the first document that didn't fit left over goes, in the same order, to smaller ones
    gaps = runs.groupBy("source").agg((F.first("rest") - F.sum(F.when(F.col("chosen"), F.col("size")).otherwise(0)))
                                      .alias("gap"))
    small = ~F.col("chosen") & (F.col("whole") < MOST) & (F.col("size") <= F.col("gap"))
    late = _beside(runs, gaps).withColumn("late", F.when(small, F.col("size")).otherwise(F.lit(0)))
    late = running_sums(late, ["source"], order, {"filled": "late"}, "mix-late")
    more = F.col("chosen") | ((F.col("late") > 0) & (F.col("filled") + F.col("late") / 2 <= F.col("gap")))
    times = F.col("whole") + more.cast("long")
    return late.select(F.col("id").alias(id_col), "size", "source_size", "target", times.alias("times"),
                       (times * F.col("size")).alias("taken"), *([F.col("row").alias(row_col)] if row_col else []))


def _beside(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``by_source`` (one row per source).  Those
    are copied to SPREAD keys, so a source with most of the rows is joined in
    parts."""
    copies = by_source.withColumnRenamed("source", "__s").withColumn(
        "__part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    dealt = rows.withColumn("__deal", F.pmod(F.hash("key", "size"), F.lit(SPREAD)))
    same = F.col("source").eqNullSafe(F.col("__s")) & (F.col("__deal") == F.col("__part"))
    return dealt.join(copies, same).drop("__s", "__part", "__deal")


#: Keys over which a source's rows are dealt when they meet its target.
SPREAD = 32


def quality_of(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` (``id``) with a weight ``q`` from ``labels`` (``doc_id,
    quality``): 2 for good, 1/2 for bad, 1 without a label; of several labels
    the mean."""
    by_id = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("labelled")).agg(
        F.avg(F.when(F.col("quality") > 0, 2.0).when(F.col("quality") <= 0, 0.5)).alias("w"))
    return rows.join(by_id, rows["id"] == by_id["labelled"], "left").select(*rows.columns, F.coalesce("w", F.lit(1.0)).alias("q"))
