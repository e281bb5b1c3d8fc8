"""Names and documents: expressions that read tile names, paths, keys and configuration values."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed format of tile names: column and row counted from 1, then the slice.
TILE = r"Tile_(\d+)-(\d+)_s(\d+)"


def _number(name: Column, group: int) -> Column:
    found = F.regexp_extract(name, TILE, group)
    return F.when(found != "", found.cast("int"))


def tile_x(name: Column) -> Column:
    """Column of a tile from 0; null if the name isn't a tile's. Two and three digits are read alike."""
    return _number(name, 1) - 1


def tile_y(name: Column) -> Column:
    return _number(name, 2) - 1


def tile_slice(name: Column) -> Column:
    return _number(name, 3)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_name(path: Column) -> Column:
    """Name of the folder that holds path; null for a bare name."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def without_suffix(name: Column, suffix: str) -> Column:
    """The name without the suffix, as a whole and not as a set of letters."""
    return F.when(name.endswith(suffix), F.substring(name, F.lit(1), F.length(name) - len(suffix))).otherwise(name)


def key_numbers(key: Column) -> Column:
    """Integers of a key such as "(0, 1)"."""
    return F.transform(F.regexp_extract_all(key, F.lit(r"(-?\d+)"), 1), lambda x: x.cast("int"))


def zero_filled(number: Column, width: int) -> Column:
    """Padded on the left to width; longer numbers stay whole."""
    text = number.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def number_label(x: Column, digits: int) -> Column:
    """A number as part of a name: rounded, with the point as an underscore."""
    return F.replace(F.round(x, digits).cast("string"), F.lit("."), F.lit("_"))


def resolution(lines: DataFrame, key: str) -> DataFrame:
    """(key, res_y, res_x) of files given as lines (key, n, line).

    The first line that speaks of a resolution or pixel size and holds two
    integers counts; else the line numbered 5; else the file has none (null).
    """
    numbers = F.transform(F.regexp_extract_all("line", F.lit(r"(\d+)"), 1), lambda x: x.cast("int"))
    two = lines.select(key, "n", F.lower("line").rlike("resolution|pixel size").alias("said"), numbers.alias("v"))
    fits = F.size("v") >= 2
    best = two.groupBy(key).agg(F.min_by("v", F.when(F.col("said") & fits, F.col("n"))).alias("first"), F.min_by("v", F.when((F.col("n") == 5) & fits, F.col("n"))).alias("fifth"))
    v = F.coalesce("first", "fifth")
    return best.select(key, F.get(v, F.lit(0)).alias("res_y"), F.get(v, F.lit(1)).alias("res_x"))


def text_resolution(text: Column, words: list[str], line: int = 5) -> Column:
    """resolution() of a whole text as struct<y,x>, without a row for each line: null if it has none.

    words: what a line must speak of, in lower case; line: the number of the one
    that counts otherwise, from 0. Numbers that an int can't hold are null.
    """
    said = "|".join(map(re.escape, words))
    read = lambda c: F.struct(F.lower(c).rlike(said).alias("said"), F.regexp_extract_all(c, F.lit(r"(\d+)"), 1).alias("v"))
    lines = F.transform(F.split(text, "\n"), read)
    first = F.get(F.filter(lines, lambda p: p["said"] & (F.size(p["v"]) >= 2)), F.lit(0))["v"]
    other = F.get(lines, F.lit(line))["v"]
    v = F.coalesce(first, F.when(F.size(other) >= 2, other))
    return F.when(v.isNotNull(), F.struct(v[0].try_cast("int").alias("y"), v[1].try_cast("int").alias("x")))


def volume_type(dtype: Column, top: Column) -> Column:
    """How a viewer shows a volume: labels as segmentation, everything else as image."""
    labels = dtype.isin("bool", "uint64") | ((dtype == "uint8") & (top <= 1))
    return F.when(labels, "segmentation").otherwise("image")


def missing_fields(doc: Column, required: list[str]) -> Column:
    """Required fields that a JSON object lacks; all of them if it is no object."""
    keys = F.coalesce(F.json_object_keys(doc), F.array().cast("array<string>"))
    return F.array_except(F.array(*map(F.lit, required)), keys)


def running_offset(groups: DataFrame, order: str, extent: str, name: str = "offset") -> DataFrame:
    """Sum of the extents of the groups before each, in order."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)  # one row for a group of datasets
    return groups.withColumn(name, F.coalesce(F.sum(extent).over(before), F.lit(0)))


def tail(name: Column, separator: str) -> Column:
    """What follows the first separator; the whole name if there is none."""
    at = F.instr(name, separator)
    return F.when(at > 0, F.substring(name, at + len(separator), F.length(name))).otherwise(name)
