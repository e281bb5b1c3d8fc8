"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Each source gets a target number of words: weights share the total, no target
exceeds ``MOST`` times its source, and what a capped source can't take is shared
out again. A source is taken in complete epochs first; for the fraction that
remains, documents come in the order of exponential keys -ln(u) / w, where u is
a hash of the document and w its quality weight, until their sizes, summed in
that order, meet the budget.

Prefix sums never order a whole source in one task: keys fall into ranges, the
sums of the ranges are few, and only the range where the budget ends is ordered
document by document; of repeated rows, which share a key, as many are taken as
fit. The words that are then still missing, fewer than the next document has,
are filled with the one document whose size comes nearest. The outcome is one
cut and one last document for each source, joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, WORD_PATTERN, materialize, tidy, whole, with_row

WEIGHTS, MOST, SEED = (1.0, 2.0, 3.0), 3, 20
#: Documents that one range of keys holds, about.
RANGE_ROWS = 5000
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """Weight of a document, 0.25 to 1: symbols lower it, and capitals beyond the tenth that prose has."""
    length = F.length(text)
    share = lambda marks: F.when(length > 0, (length - F.length(F.translate(text, marks, ""))) / length).otherwise(0.0)
    loss = F.least(F.lit(0.5), 5 * share(SYMBOLS)) + F.least(F.lit(0.25), F.greatest(F.lit(0.0), share(CAPITALS) - 0.1))
    return F.lit(1.0) - F.coalesce(loss, F.lit(0.0))


def sampling_key(doc_id: Column, text: Column, seed: int = SEED, weight: Column | None = None) -> Column:
    """The exponential key; equal for rows with equal id and text, the same in every run. weight: positive, instead of quality()."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id.cast("string"), text), 11)
    return -F.log((bits + 0.5) / float(1 << 53)) / (quality(text) if weight is None else weight)


def _range(key: Column, ranges: Column) -> Column:
    return F.floor((1 - F.exp(-0.75 * key)) * ranges)


def ranked(sources: DataFrame) -> DataFrame:
    """sources with their rank by code point from 0, null last.

    Sorted in ranges; a rank is the place in the range plus the rows of the
    ranges before, so no task sorts all sources.
    """
    place = [F.col("source").isNull(), F.col("source")]
    parts = max(1, -(-sources.count() // RANGE_ROWS))
    s = materialize(sources.repartitionByRange(parts, *place).sortWithinPartitions(*place).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = s.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n")  # a row for RANGE_ROWS sources
    return s.join(before, part == F.col("part")).withColumn("rank", F.col("at") - F.shiftleft(F.col("part"), 33) + F.col("before")).drop("at", "part", "before")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """sources (source, source_size, ...) with their target, as double.

    Weights go round the sources by code point, null last. All sources not yet
    capped share what the capped ones leave by weight; those whose share exceeds
    ``most`` times their size become capped, until there are none: each round is
    one sum over the sources, and the capped ones only grow.
    """
    cycle = F.array(*map(F.lit, weights))
    s = ranked(sources).withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
    s = materialize(s.withColumn("cap", most * F.col("source_size").cast("double")))
    level, known = None, -1
    while True:
        capped = F.lit(False) if level is None else F.col("cap") < level * F.col("weight")
        free = s.agg(F.sum("source_size").alias("all"), F.sum(F.when(capped, F.col("cap"))).alias("taken"), F.sum(F.when(~capped, F.col("weight"))).alias("weight"), F.count_if(capped).alias("n")).first()
        if free["n"] == known:
            break
        known, level = free["n"], (free["all"] - (free["taken"] or 0.0)) / free["weight"] if free["weight"] else 0.0
    return s.withColumn("target", F.when(capped, F.col("cap")).otherwise(F.lit(level) * F.col("weight"))).drop("rank", "weight", "cap")


def sizes(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """(__row, id, source, size, key[, __doc]) of rows (__row, id, source, text[, weight, __doc]), written once."""
    weight = F.col("weight") if "weight" in rows.columns else None
    whole = [c for c in rows.columns if c == "__doc"]
    return materialize(rows.select(ROW, "id", "source", words_in(F.col("text")).alias("size"), sampling_key(F.col("id"), F.col("text"), seed, weight).alias("key"), *whole))


def plan(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """A row for each source of sizes(): of (the source), source_size, target, and which documents are taken.

    ranges, epochs, end (the range where the budget ends, -1 for none), cut (the
    last key that fits in that range), tie and tie_row (of the repeated rows
    after that, those up to tie_row), last and last_row (the filling document).
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    s = targets(sources, weights, most).withColumn("ranges", F.ceil(F.col("n") / RANGE_ROWS)).drop("n")
    epochs = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("int")
    s = s.withColumn("epochs", epochs).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    s = materialize(s.withColumnRenamed("source", "of"))
    same = F.col("source").eqNullSafe(F.col("of"))
    join_on = lambda name: F.col("of").eqNullSafe(F.col(name))

    ranged = sized.join(s.where("budget > 0"), same).withColumn("range", _range(F.col("key"), F.col("ranges")))
    sums = ranged.groupBy("of", "range").agg(F.sum("size").alias("sum"), F.first("budget").alias("budget"))
    upto = Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = sums.withColumn("before", F.coalesce(F.sum("sum").over(upto), F.lit(0))).where("before < budget and before + sum >= budget")
    ends = materialize(ends.select(F.col("of").alias("end_of"), F.col("range").alias("end"), "before"))
    last = ranged.join(ends, join_on("end_of") & (F.col("range") == F.col("end")))
    ties = last.groupBy("of", "key").agg(F.sum("size").alias("sum"), F.max("size").alias("each"), F.first("budget").alias("budget"), F.first("before").alias("before"))
    upto = Window.partitionBy("of").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    upto = ties.withColumn("upto", F.col("before") + F.sum("sum").over(upto))
    fits = F.col("upto") <= F.col("budget")
    cut = upto.groupBy(F.col("of").alias("cut_of")).agg(
        F.max(F.when(fits, F.col("key"))).alias("cut"),
        (F.first("budget") - F.coalesce(F.max(F.when(fits, F.col("upto"))), F.first("before"))).alias("gap"),
        F.min(F.when(~fits, F.struct("key", "each"))).alias("next"),
    )
    # Rows with the next key are repeated rows, equal in size: as many as fit are taken, by row.
    cut = materialize(cut.withColumn("some", F.coalesce(F.floor(F.col("gap") / F.col("next.each")), F.lit(0))))
    again = sized.join(cut.where("some > 0"), F.col("source").eqNullSafe(F.col("cut_of")) & (F.col("key") == F.col("next.key")))
    parts = again.groupBy("cut_of", F.shiftright(ROW, 33).alias("part")).agg(F.count("*").alias("n"), F.first("some").alias("some"))
    parts = parts.withColumn("before", F.sum("n").over(Window.partitionBy("cut_of").orderBy("part")) - F.col("n")).where("before < some and before + n >= some")
    parts = parts.select(F.col("cut_of").alias("part_of"), "part", (F.col("some") - F.col("before")).alias("nth"))
    tie = again.join(parts, F.col("cut_of").eqNullSafe(F.col("part_of")) & (F.shiftright(ROW, 33) == F.col("part")))
    tie = tie.withColumn("at", F.row_number().over(Window.partitionBy("cut_of").orderBy(ROW))).where("at = nth").select(F.col("cut_of").alias("tie_of"), F.col("key").alias("tie"), F.col(ROW).alias("tie_row"))

    cuts = s.join(ends, join_on("end_of"), "left").join(cut, join_on("cut_of"), "left").join(tie, join_on("tie_of"), "left")
    gap = F.col("gap") - F.when(F.col("tie").isNotNull(), F.col("some") * F.col("next.each")).otherwise(0)
    cuts = materialize(cuts.select("of", "source_size", "target", "ranges", "epochs", F.when(F.col("budget") > 0, F.coalesce("end", "ranges")).otherwise(-1).alias("end"), "cut", "tie", "tie_row", gap.alias("gap")))

    left = sized.join(cuts.where("gap > 0"), same).where((F.col("size") > 0) & ~_selected())
    nearest = F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "key", ROW)
    last = left.groupBy("of").agg(F.min(nearest).alias("n"), F.first("gap").alias("gap")).where("n.off < gap").select(F.col("of").alias("last_of"), F.col("n.key").alias("last"), F.col(f"n.{ROW}").alias("last_row"))
    return materialize(cuts.join(last, join_on("last_of"), "left").drop("last_of", "gap"))


def _selected() -> Column:
    """Whether a document of sizes(), joined to its source's plan, comes before the cut."""
    at = _range(F.col("key"), F.col("ranges"))
    fits = F.coalesce(F.col("key") <= F.col("cut"), F.lit(False)) | F.coalesce((F.col("key") == F.col("tie")) & (F.col(ROW) <= F.col("tie_row")), F.lit(False))
    return (at < F.col("end")) | ((at == F.col("end")) & fits)


def _taken(sized: DataFrame, cuts: DataFrame) -> DataFrame:
    """Documents of sizes() with their source's plan and how often they are taken."""
    fills = F.coalesce(F.col(ROW) == F.col("last_row"), F.lit(False))
    return sized.join(cuts, F.col("source").eqNullSafe(F.col("of"))).withColumn("times", F.col("epochs") + (_selected() | fills).cast("int"))


@tidy
def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight_col: str | None = None, seed: int = SEED, **options) -> DataFrame:
    """(id, source, size, source_size, target, times) for each row of docs.

    size is the number of words, 0 for null texts; a null source is a source.
    A source without words has target 0. Of repeated rows as many are taken as
    fit. An empty table gives no rows. The same rows give the same mix in every
    run, in whatever order they are read. weight_col, if given, holds positive
    weights used instead of quality().
    """
    sized = sizes(_rows(docs, id_col, text_col, source_col, weight_col), seed)
    return _taken(sized, plan(sized, **options)).select("id", "source", "size", "source_size", "target", "times")


@tidy
def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight_col: str | None = None, seed: int = SEED, **options) -> DataFrame:
    """docs, each row as often as the mix takes it."""
    sized = sizes(_rows(docs, id_col, text_col, source_col, weight_col, whole(docs)), seed)
    taken = _taken(sized, plan(sized.drop("__doc"), **options)).where("times > 0")
    return taken.select("__doc", F.explode(F.sequence(F.lit(1), F.col("times")))).select("__doc.*")


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, weight_col: str | None, *more: Column) -> DataFrame:
    weight = [F.col(weight_col).cast("double").alias("weight")] if weight_col else []
    return with_row(docs, F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"), *weight, *more)
