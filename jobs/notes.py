"""Incremental catalogue of the notes that come with acquired tiles.

    python -m jobs.notes --input '/data/documents.parque[t]' --output /data/notes --checkpoint /data/notes-mark [--config notes.json]

Notes are texts (doc_id, source, text): the source is the folder they belong to.
Each run takes the files that are new since the last one, as a file stream whose
checkpoint is the mark, and ends when there are none. For each note it reads the
resolution, counts lines and words, and tells copies. A note without a
resolution takes it from the note before in its folder, else from the one after.

output/read/batch=N has what was read of the texts of a batch, output/catalogue
the result, a folder for each source. A batch that comes again after a failure
overwrites its own folder, and the catalogue of the folders it touches is made
anew from all that was read, so that nothing is lost or doubled. Folders that
get no new note stay as they are.

Repeated notes, equal in all columns, count once. A note without id has a place
of its own: it keeps its resolution, but takes none and gives none.
"""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import names
from lamella.operators import asof
from lamella.sources import store

log = logging.getLogger("jobs.notes")
DEFAULTS = Path(__file__).with_name("notes.json")
INPUT = "doc_id long, source string, text string"
READ = "doc_id long, source string, n_lines int, n_words long, digest string, res struct<y:int,x:int>, folder string"
CATALOGUE = "doc_id long, source string, n_lines int, n_words long, digest string, copy_of long, res_y int, res_x int, filled_from string, from_id long, folder string"
#: White space as in the words of a note.
WORD = r"[^\x20\x09-\x0D]+"


def read_notes(notes: DataFrame, config: dict) -> DataFrame:
    """(doc_id, source, n_lines, n_words, digest, res) of each distinct note; lines without a word don't count."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))
    return notes.select(
        "doc_id",
        "source",
        F.size(lines).alias("n_lines"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
        F.sha2("text", 256).alias("digest"),
        names.text_resolution(F.col("text"), config["words"], config["line"]).alias("res"),
    ).distinct()


def catalogue(read: DataFrame, config: dict) -> DataFrame:
    """The catalogue of notes read: with the resolution that holds for each, where it is from, and the first copy.

    copy_of is the least id of an equal text of the same source, null for that note itself.
    """
    own = read.where("res is not null and doc_id is not null")
    given = own.groupBy("source", F.col("doc_id").alias("from_id")).agg(F.min("res").alias("given"))
    numbered = read.select("source", F.col("doc_id").alias("at")).where("at is not null").distinct()
    before = asof.banded(numbered, given, "at", "from_id", config["band"], by=["source"], carry=["given"])
    after = asof.banded(numbered, given, "at", "from_id", config["band"], back=False, by=["source"], carry=["given"])
    name = lambda df, prefix: df.select(F.col("source").alias(f"{prefix}_source"), F.col("at").alias(f"{prefix}_at"), F.col("from_id").alias(f"{prefix}_id"), F.col("given").alias(prefix))
    same = lambda prefix: F.col("source").eqNullSafe(F.col(f"{prefix}_source")) & (F.col("doc_id") == F.col(f"{prefix}_at"))
    found = read.join(name(before, "previous"), same("previous"), "left").join(name(after, "next"), same("next"), "left")
    first = read.groupBy(F.col("source").alias("of"), F.col("digest").alias("as")).agg(F.min("doc_id").alias("first"))
    found = found.join(first, F.col("source").eqNullSafe(F.col("of")) & F.col("digest").eqNullSafe(F.col("as")))
    use = lambda own, previous, following: F.when(F.col("res").isNotNull(), own).when(F.col("previous").isNotNull(), previous).when(F.col("next").isNotNull(), following)
    res = use(F.col("res"), F.col("previous"), F.col("next"))
    return found.select(
        "doc_id",
        "source",
        "n_lines",
        "n_words",
        "digest",
        F.when(F.col("first") != F.coalesce("doc_id", F.col("first") - 1), F.col("first")).alias("copy_of"),
        res["y"].alias("res_y"),
        res["x"].alias("res_x"),
        use(F.lit("own"), F.lit("previous"), F.lit("next")).alias("filled_from"),
        use(F.col("doc_id"), F.col("previous_id"), F.col("next_id")).alias("from_id"),
    )


def folder(source: Column) -> Column:
    """The folder of a source; blank and null ones have their own."""
    return F.coalesce(F.concat(F.lit("in_"), source), F.lit("none"))


def run(spark: SparkSession, source: str, output: str, mark: str, config: dict | None = None) -> DataFrame:
    """Take what is new and wait until it is done; the whole catalogue as it stands then.

    source: a path that the file stream lists, with or without wildcards.
    """
    config = json.loads(DEFAULTS.read_text()) | (config or {})

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mine = f"{output}/read/batch={number}"
        notes = read_notes(batch, config).withColumn("folder", folder(F.col("source")))
        notes.write.mode("overwrite").partitionBy("folder").parquet(mine)
        counted = spark.read.schema(READ).parquet(mine).groupBy("folder").agg(F.count("*").alias("n"))
        total = counted.agg(F.count("*").alias("folders"), F.sum("n").alias("notes")).first()
        log.info("batch %d: read %d notes of %d folders", number, total["notes"] or 0, total["folders"])
        if not total["folders"]:
            return
        every = spark.read.schema(f"{READ}, batch long").parquet(f"{output}/read").join(counted.select("folder"), "folder", "left_semi")
        made = catalogue(every.drop("batch", "folder").distinct(), config).withColumn("folder", folder(F.col("source")))
        # Rebalanced: a folder that has most of the notes is written by many tasks.
        made.hint("rebalance", "folder").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("folder").parquet(f"{output}/catalogue")
        log.info("batch %d: wrote %s", number, f"{output}/catalogue")

    stream = spark.readStream.schema(INPUT).option("maxFilesPerTrigger", config["files_per_batch"]).parquet(source)
    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", mark).trigger(availableNow=True).start()
    query.awaitTermination()
    done = store.read(spark, f"{output}/catalogue", CATALOGUE, missing_ok=True).drop("folder")
    log.info("catalogue: %d notes", done.count())
    return done


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    for name in ("--input", "--output", "--checkpoint"):
        parser.add_argument(name, required=True)
    parser.add_argument("--config", help="JSON; overrides the defaults beside this file")
    given = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    config = json.loads(Path(given.config).read_text()) if given.config else None
    spark = SparkSession.builder.appName("notes").getOrCreate()
    try:
        run(spark, given.input, given.output, given.checkpoint, config)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
