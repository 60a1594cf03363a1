"""Parent/child hierarchies (HIER-1, HIER-2, AGG-4, AGG-5, SRT-1, SNK-5).

``hierarchy_paths`` computes path and level of every node by pointer
doubling: each round joins the unfinished nodes to the current state of
their next ancestor, so the covered chain doubles and a tree of depth ``d``
settles in about ``log2(d)`` rounds, whatever its size.  Dirty data comes
out as rows: ``orphan`` when an ancestor's parent row is absent, ``cycle``
when the chain repeats an id (self-loops, cycles, and tails into a cycle).

Each round is cut from its lineage by writing it as a table into the
shared folder named by ``spark.checkpoint.dir`` (``materialize``), so a
lost executor recomputes one round at most.  A round writes only the rows
it advanced; settled rows stay where they settled and are never rewritten.
The join key is the ancestor id; a hot ancestor (a root with a third of all
nodes below it) is one row on the target side and many on the active side
-- the skew AQE's skew-join split handles -- and nodes whose ancestor is
settled leave the loop in that round.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pageloom.session import materialize, new_run_id

OK, ORPHAN, CYCLE = "ok", "orphan", "cycle"


def _init_state(nodes: DataFrame, name_col: str | None) -> DataFrame:
    is_root = F.col("pid").isNull() | (F.col("pid") == 0)
    names = F.array(F.col(name_col)) if name_col else F.lit(None).cast("array<string>")
    self_loop = ~is_root & (F.col("pid") == F.col("id"))
    return nodes.select(
        "id", "pid",
        F.array(F.col("id")).alias("path"),
        names.alias("names"),
        F.col("pid").alias("nxt"),
        F.when(is_root, F.col("pid")).alias("root_pid"),
        F.when(is_root, F.lit(OK)).when(self_loop, F.lit(CYCLE)).alias("status"))


def _step(active: DataFrame, targets: DataFrame) -> DataFrame:
    """Advance every unsettled row by one doubling step: join it to the
    current state of its next ancestor (``targets`` holds the latest state
    of every node)."""
    a = active.alias("a")
    s = targets.select(F.col("id").alias("s_id"), F.col("path").alias("s_path"), F.col("names").alias("s_names"),
                       F.col("nxt").alias("s_nxt"), F.col("root_pid").alias("s_root_pid"),
                       F.col("status").alias("s_status"))
    j = a.join(s, F.col("a.nxt") == F.col("s_id"), "left")
    found = F.col("s_id").isNotNull()
    new_path = F.when(found, F.concat("s_path", "a.path")).otherwise(F.col("a.path"))
    new_names = F.when(found, F.concat("s_names", "a.names")).otherwise(F.col("a.names"))
    repeats = (F.size(F.array_distinct(new_path)) < F.size(new_path)) | \
        (F.col("s_status").isNull() & F.array_contains(new_path, F.col("s_nxt")))
    status = (F.when(~found, F.lit(ORPHAN))
              .when(F.col("s_status") == CYCLE, F.lit(CYCLE))
              .when(repeats, F.lit(CYCLE))
              .otherwise(F.col("s_status")))
    return j.select(
        F.col("a.id").alias("id"), F.col("a.pid").alias("pid"),
        new_path.alias("path"), new_names.alias("names"),
        F.when(found, F.col("s_nxt")).otherwise(F.col("a.nxt")).alias("nxt"),
        F.when(found, F.col("s_root_pid")).alias("root_pid"),
        status.alias("status"))


def _settled(tables):
    return reduce(DataFrame.unionByName, [t.where(F.col("status").isNotNull()) for t in tables])


def hierarchy_paths(nodes: DataFrame, name_col: str | None = None) -> DataFrame:
    """HIER-1: ``id, pid, path, level, status, root_pid`` (+ ``name_path``
    when ``name_col`` is given).  ``path`` lists ids root-first joined by
    ``|``; a root (pid 0 or NULL) has path ``id`` and level 1.  Orphans keep
    the partial path from their topmost existing ancestor; cycle rows have
    NULL path and level.

    Runs its rounds when called (an iterative job) and returns a lazy
    DataFrame over the round tables.  The first round writes every row once;
    each later round writes only the rows that were still unsettled, and a
    row's settled version stays in the table of the round that settled it,
    so settled rows are never rewritten.  The targets of a round are the
    settled rows of all tables plus the latest unsettled ones."""
    cols = ["id", "pid"] + ([name_col] if name_col else [])
    run = new_run_id()
    obs = Observation()
    # round 1 runs on the initial projection directly and writes every row
    # once (already-settled roots and the advanced rest); later rounds write
    # only the rows that were still unsettled
    init = _init_state(nodes.select(*cols), name_col)
    first = init.where(F.col("status").isNotNull()).unionByName(
        _step(init.where(F.col("status").isNull()), init))
    tables = [materialize(first.observe(obs, F.count(F.when(F.col("status").isNull(), 1)).alias("active")),
                          "hier", slot=f"{run}-r1")]
    # The unsettled count is observed while each table is written (no extra
    # job).  A stage re-run after a lost executor may count twice; only
    # "zero or not" is used, which that cannot change.
    for i in count(2):  # each round doubles the chains covered, so this ends
        if obs.get["active"] == 0:
            break
        active = tables[-1].where(F.col("status").isNull())
        # latest state of every node: settled rows of the older tables plus
        # the whole latest table (its settled and its still-active rows)
        targets = _settled(tables[:-1]).unionByName(tables[-1]) if len(tables) > 1 else tables[-1]
        obs = Observation()
        stepped = _step(active, targets)
        tables.append(materialize(stepped.observe(obs, F.count(F.when(F.col("status").isNull(), 1)).alias("active")),
                                  "hier", slot=f"{run}-r{i}"))
    state = _settled(tables)
    cyc = F.col("status") == CYCLE
    out = state.select(
        "id", "pid",
        F.when(~cyc, F.array_join(F.transform("path", lambda x: x.cast("string")), "|")).alias("path"),
        F.when(~cyc, F.size("path")).cast("int").alias("level"),
        "status", "root_pid",
        *([F.when(~cyc, F.col("names")).alias("name_path")] if name_col else []))
    return out


def children(nodes: DataFrame) -> DataFrame:
    """AGG-4: the children of every parent in long form (``pid, id``) with
    the child count; rows without a parent are the children of NULL.  The
    count is a partial aggregate and is written first, so that the join back
    has two plain inputs and a parent with a third of all rows below it is
    split (skew joins are not split above an aggregate)."""
    counts = materialize(nodes.groupBy(F.col("pid").alias("cpid")).agg(F.count(F.lit(1)).alias("n_children")), "children")
    rows = nodes.select("pid", "id")
    return rows.join(counts, F.col("pid").eqNullSafe(F.col("cpid"))).drop("cpid")


def tree_stats(nodes: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """AGG-5: one row per node reachable from id 0, plus the root row.
    The root has level 1 and path ``''``; a node has level = its hierarchy
    level + 1 and path ``'|' + path``; ``sub_count`` = number of children."""
    paths = paths if paths is not None else hierarchy_paths(nodes)
    counts = (nodes.where(F.col("pid").isNotNull()).groupBy(F.col("pid").alias("cpid"))
              .agg(F.count(F.lit(1)).alias("sub_count")))
    reach = paths.where((F.col("status") == OK) & (F.col("root_pid") == 0))
    rows = (reach.join(counts, reach["id"] == counts["cpid"], "left")
            .select((F.col("level") + 1).cast("int").alias("level"),
                    F.concat(F.lit("|"), F.col("path")).alias("path"),
                    F.coalesce(F.col("sub_count"), F.lit(0)).cast("bigint").alias("sub_count")))
    # the root row always exists: a global aggregate over the children of 0
    root = (counts.where(F.col("cpid") == 0)
            .agg(F.coalesce(F.sum("sub_count"), F.lit(0)).cast("bigint").alias("sub_count"))
            .select(F.lit(1).cast("int").alias("level"), F.lit("").alias("path"), "sub_count"))
    return rows.unionByName(root)


def stat_lines(stats: DataFrame) -> DataFrame:
    """SNK-5 body: ``%d\\t%s\\t%d`` lines, sorted by numeric level then path
    (SRT-1; the original sorted by the first character of the line)."""
    return (stats.orderBy("level", "path")
            .select(F.format_string("%d\t%s\t%d", "level", "path", "sub_count").alias("line")))


def save_lines(lines: DataFrame, path: str) -> None:
    """SNK-5: write one text line per row."""
    lines.write.mode("overwrite").text(path)


def path_names(rows: DataFrame, names: DataFrame, key_col: str = "city_id",
               path_col: str = "path", id_col: str = "city_id", name_col: str = "city_name",
               numeric_ids: bool = False) -> DataFrame:
    """JOIN-6: names of every id of a ``|``-joined path, order kept.  Rows
    with an id that has no name get ``missing`` > 0 (the unmatched report)
    and a NULL name path.  With ``numeric_ids`` the tokens are read as
    integers (S-23, ``try_cast``: a malformed token counts as missing
    instead of failing the job).  Each regrouped row holds one path, so a
    group is as long as the path, never larger."""
    ex = rows.select(key_col, F.posexplode(F.split(F.col(path_col), r"\|", -1)).alias("pos", "tok"))
    key_type = "bigint" if numeric_ids else "string"
    ex = ex.withColumn("tok", F.col("tok").try_cast(key_type))
    nm = names.select(F.col(id_col).cast(key_type).alias("tok"), F.col(name_col).alias("nm"))
    j = ex.join(nm, "tok", "left")
    g = j.groupBy(key_col).agg(
        F.sort_array(F.collect_list(F.struct("pos", "nm"))).alias("parts"),
        F.count_if(F.col("nm").isNull()).alias("missing"))
    return g.select(key_col,
                    F.when(F.col("missing") == 0, F.transform("parts", lambda p: p["nm"])).alias("name_path"),
                    F.col("missing").cast("bigint").alias("missing"))
