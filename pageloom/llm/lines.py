"""Operator 9: line dedup by a deletion-neighbourhood join.

Two lines are near copies if one turns into the other by at most one edit: a
character (code point) changed, added or left out; white space counts as one
space, at the ends as none.  The rule is the same for lines of any length.  A
line goes if the same line, or a near copy of it, occurs earlier, by document
identifier and then line number.  All of it is DataFrame functions.

Every line stands for its variants: itself and itself without one character.
Lines that differ in one character have the same variant without it, at the
same place; a line with one more character has the other line among its
variants.  The variants' hashes are grouped; per key only the earliest line is
kept, by a partial minimum, so no group emits its pairs.  That the candidates'
texts are one edit apart is then verified.

Before that, variants that can meet no other line's are left out.  An edit
leaves either the start or the end of a line as it is, so a line whose start
and end no other line has is its own only near copy.  The others are cut into
pieces: the edit lies in one of them, and all around that piece is equal.  A
piece whose surroundings no other line has goes; the rest are cut again until
they are short, and only they get variants.  Equal lines fold into one before
anything else.

Cases: a null text stays null; an empty text has one empty line; lines
without a word are kept; a null identifier comes last, equal ones are ordered by
the text's hash; rows equal in identifier and text count as one document and
keep the same lines; an empty table gives an empty table.  All columns of
the input are handed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import SPACE, written

#: Pieces a line, or a piece of it, is cut into.
PIECES = 16
#: Characters up to which a piece is not cut again.
SHORT = 32


def _normal(line: Column) -> Column:
    """The line's words with single spaces between them."""
    odd = F.contains(line, F.lit("  "))
    for c in "\t\v\f\r":
        odd = odd | F.contains(line, F.lit(c))
    # most lines have nothing to replace, which is cheap to see
    return F.trim(F.when(odd, F.regexp_replace(line, rf"{SPACE}{{2,}}|[\x09-\x0D]", " ")).otherwise(line))


def _occurrences(docs: DataFrame) -> DataFrame:
    """Every line's place ``at`` (unnamed, id, hash of the text, line number),
    ``size`` in characters, hashes ``k0, k1``, and ``ends``, the hashes of its
    start and its end.  These are nearly half the shorter line of a pair long,
    in steps that most neighbouring sizes share, so that most lines have one of each."""
    lines = docs.where(F.col("text").isNotNull()).select("id", "hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    rows = lines.select(F.struct(F.col("id").isNull().alias("unnamed"), "id", "hash", "pos").alias("at"),
                        _normal(F.col("line")).alias("normal")).withColumn("size", F.length("normal"))

    def reach(shorter: str) -> Column:
        step = f"greatest(1, cast(pow(2, floor(log2({shorter})) - 4) as int))"
        return F.expr(f"case when {shorter} > 0 then cast(({shorter} div 2) div {step} * {step} as int) end")

    rows = rows.select("*", reach("size").alias("r0"), reach("(size - 1)").alias("r1"))
    start, end = ([F.xxhash64(F.lit(side), cut(F.col("normal"), F.col(r))) for r in ("r0", "r1")] for side, cut in ((0, F.left), (1, F.right)))
    other = F.col("r1") != F.col("r0")
    ends = F.array_compact(F.array(start[0], end[0], F.when(other, start[1]), F.when(other, end[1])))
    return rows.select("at", "size", F.xxhash64("normal").alias("k0"), F.xxhash64(F.lit(1), "normal").alias("k1"), ends.alias("ends"))


def _shared(keys: DataFrame, key: str, tag: str) -> DataFrame:
    """The rows whose key another row has.  A merge join at every size: the
    keys grow with the lines."""
    met = written(keys.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key), tag)
    return keys.join(met.hint("merge"), key, "left_semi")


def _pieces(lines: DataFrame) -> DataFrame:
    """``at``, ``longer`` (the line is the longer one of its pairs), ``key``
    (hash of all around the piece), ``part`` (the piece) and ``off`` (the
    characters before it), for pieces whose surroundings another line has.  Each line stands as the longer of a pair
    and as one that isn't; both lines of a pair are cut by the size of the shorter."""
    size = F.length("part") - F.col("longer").cast("int")
    sides = lines.select("at", F.col("normal").alias("part"), F.explode(F.array(F.lit(False), F.lit(True))).alias("longer"))
    todo = sides.select("at", "longer", F.xxhash64(size).alias("key"), "part", F.lit(0).alias("off"), size.alias("size")).where("size > 0")
    done = []
    while True:
        todo = written(todo, "line-pieces")
        done.append(todo.where(F.col("size") <= SHORT))
        todo = todo.where(F.col("size") > SHORT)
        if todo.isEmpty():
            break
        cut = todo.select("*", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))).alias("j")).select(
            "*", F.expr(f"cast(size * cast(j as long) div {PIECES} as int)").alias("before"),
            F.expr(f"cast(size - size * cast(j + 1 as long) div {PIECES} as int)").alias("after"))
        part = F.expr("substring(part, before + 1, length(part) - before - after)")
        cut = cut.select("at", "longer", F.expr("xxhash64(key, j, left(part, before), right(part, after))").alias("key"),
                         part.alias("part"), (F.col("off") + F.col("before")).alias("off"), (F.col("size") - F.col("before") - F.col("after")).alias("size"))
        todo = _shared(cut, "key", "line-around")
    pieces = done[0]
    for more in done[1:]:
        pieces = pieces.unionByName(more)
    return pieces


def _near(lines: DataFrame) -> DataFrame:
    """``at`` of the lines (``at, normal``) that have an earlier near copy among them."""
    def variants(gone: str) -> str:
        # the hash must not depend on where the character was: of the joined text, not of both parts
        return f"transform(sequence(1, length(part)), i -> struct({gone} as gone, off + i - 1 as without, xxhash64(left(part, i - 1) || substring(part, i + 1)) as v))"

    # the place of a changed character counts, that of one more does not
    itself = "array(struct(0 as gone, -1 as without, xxhash64(part) as v))"
    made = _pieces(lines).select("key", "at", "longer", F.inline(F.expr(
        f"case when longer then {variants('0')} else concat({itself}, {variants('i')}) end")))
    made = written(made, "line-variants")
    same = ["key", "gone", "v"]
    groups = made.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(F.when(~F.col("longer"), F.col("at"))).alias("low"),
                                     F.min(F.when(F.col("longer"), F.struct("at", "without"))).alias("low_longer"))
    groups = written(groups.where("if(gone > 0, n > 1, low is not null and low_longer is not null)").drop("n"), "line-groups")
    # changed: the same place gone from both; else one line is the other's variant
    itself = (F.col("gone") == 0) & ~F.col("longer")
    pairs = made.join(groups, same).select("at", F.when(itself, F.col("low_longer.at")).otherwise(F.col("low")).alias("first"),
                                           F.when(itself, F.col("low_longer.without")).otherwise(F.col("without")).alias("without"))
    pairs = pairs.where(F.col("first") < F.col("at")).groupBy("at", "first").agg(F.min("without").alias("without"))
    other = lines.select(F.col("at").alias("first"), F.col("normal").alias("other"))
    return pairs.join(lines, "at").join(other, "first").where(one_edit("normal", "other", "without")).select("at").distinct()


def one_edit(a: str, b: str, place: str) -> Column:
    """Whether the texts are equal without the character after ``place``
    others, taken from the longer one or, at equal lengths, from both: they
    are then at most one edit apart.  Linear, unlike the edit distance function."""
    def rest(x: str) -> str:
        return f"(left({x}, {place}) || substring({x}, {place} + 2))"

    return F.expr(f"case length({a}) - length({b}) when 0 then {rest(a)} = {rest(b)} when 1 then {rest(a)} = {b} "
                  f"when -1 then {a} = {rest(b)} else false end")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct, the text with only the
    lines that stay), ``lines`` and ``kept_lines`` (numbers of lines)."""
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        F.xxhash64(id_col, text_col).alias("hash"))
    texts = whole.select("id", "hash", "text")
    # lines without a word are left out of the table when it is read, lest the
    # filter have their characters counted twice
    occurrences = written(_occurrences(texts), "line-occurrences").where("size > 0")
    distinct = written(occurrences.groupBy("k0", "k1", "ends").agg(
        F.min("at").alias("at"), F.count(F.lit(1)).alias("times")), "line-distinct")
    # the candidates' texts, from the documents where they occur first.  Joins of
    # documents are merge joins at every size: what they meet grows with them
    candidates = _shared(distinct.select("at", F.explode("ends").alias("end")), "end", "line-ends")
    by_doc = candidates.groupBy(F.col("at.id").alias("i"), F.col("at.hash").alias("h")).agg(F.collect_set("at.pos").alias("places"))
    of_doc = F.col("id").eqNullSafe(F.col("i")) & (F.col("hash") == F.col("h"))
    found = texts.hint("merge").join(by_doc, of_doc).select(
        "id", "hash", F.split("text", "\n", -1).alias("parts"), F.explode("places").alias("pos")).select(
        F.struct(F.col("id").isNull().alias("unnamed"), "id", "hash", "pos").alias("at"),
        _normal(F.element_at("parts", F.col("pos") + 1)).alias("normal")).dropDuplicates(["at"])
    near = written(_near(written(found, "line-candidates")), "line-near")
    drops = distinct.drop("ends").join(near.withColumn("near", F.lit(True)), "at", "left").select(
        "k0", "k1", F.col("at").alias("first"), "times", F.coalesce("near", F.lit(False)).alias("near"))
    drops = written(drops.where("near or times > 1").select("k0", "k1", "first", "near"), "line-drops")
    gone = occurrences.select("at", "k0", "k1").join(drops, ["k0", "k1"]).where(F.col("near") | (F.col("at") != F.col("first")))
    by_doc = gone.groupBy(F.col("at.id").alias("i"), F.col("at.hash").alias("h")).agg(F.collect_set("at.pos").alias("places"))
    joined = whole.hint("merge").join(by_doc, of_doc, "left")
    parts = F.split("text", "\n", -1)
    holes = F.map_from_entries(F.transform("places", lambda p: F.struct(p.alias("key"), F.lit(True).alias("value"))))
    kept = F.when(F.col("places").isNull(), F.col("text")).otherwise(
        F.array_join(F.filter(parts, lambda _, i: F.try_element_at(F.col("holes"), i).isNull()), "\n"))
    lines = F.when(F.col("text").isNotNull(), F.size(parts)).cast("long")
    return joined.withColumn("holes", holes).select(
        F.col("row").withField(f"`{text_col}`", kept).alias("row"), lines.alias("lines"),
        (lines - F.coalesce(F.size("places"), F.lit(0))).alias("kept_lines"))
