"""Line dedup on levelled sorted runs of line hashes.

The state is a set of runs.  A run is a table of (mark, n), the 128-bit hash of
a line's key and the number of documents that have it, bucketed and sorted by
mark.  All runs have the same buckets, so runs and batches meet in merge joins
that move no run.  A new batch of documents

* counts the documents of each of its keys,
* merge-anti-joins the runs with what they already know to be repeated, and
* adds the rest as a run of level 0.

As soon as a level holds ``fan_in`` runs, they are merged into one run of the
next level, so ``b`` batches leave about ``fan_in * log(b)`` runs, and each key is
written once per level.  At the end all runs are merged, and the lines whose key
was found in ``least`` documents or more go.

A line is what stands between two \\n.  Its key is the line without white space
(WORD_SPACE) at either end and with A-Z lower-cased; lines with an empty key
always stay.  Everything is DataFrame code; the batches, their keys and the runs
are never gathered, and a key of any frequency is counted before it is moved.

Defined cases: a null text is an empty one and has one empty line; each row is a
document of its own, so rows that repeat one doc_id, or a null one, count each;
very long texts are split like any other, and a text's lines are looked up by
position, in time linear in their number; an empty table gives an empty result;
of the input only doc_id and text are read, ``drop_repeated`` keeps all columns.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_dir, stage
from .common import WORD_SPACE

LEAST_DOCUMENTS, FAN_IN, BATCHES = 10, 2, 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line as it is compared; ASCII lines take the fast way to lower case."""
    bare = F.btrim(line, F.lit(WORD_SPACE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def line_marks(docs: DataFrame) -> DataFrame:
    """(id, text_mark, marks): hashes of the keys of all lines of a row, null for empty keys."""
    marks = F.transform(
        F.transform(lines_of(F.col("text")), line_key), lambda key: F.when(key != "", F.md5(key))
    )
    return docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_mark"), marks.alias("marks"))


def file_batches(docs: DataFrame, batches: int = BATCHES) -> list[DataFrame]:
    """``docs``, read from files, as at most ``batches`` tables of whole files each."""
    files = sorted(docs.inputFiles())
    n = min(batches, len(files))
    if n < 2:
        return [docs]
    read = docs.sparkSession.read.schema(docs.schema)
    return [read.parquet(*[unquote(f) for f in files[k::n]]) for k in range(n)]


class LineRuns:
    """The levelled runs of one deduplication; ``close`` deletes them."""

    def __init__(self, spark: SparkSession, least: int = LEAST_DOCUMENTS, fan_in: int = FAN_IN):
        if least < 1 or fan_in < 2:
            raise ValueError(f"least {least} or fan_in {fan_in} is out of range")
        self.spark, self.least, self.fan_in = spark, least, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []
        self.batches: list[DataFrame] = []

    def _write(self, counts: DataFrame) -> tuple[str, str]:
        name, path = f"line_run_{uuid.uuid4().hex}", run_dir(self.spark, "line-run")
        writer = counts.write.bucketBy(self.buckets, "mark").sortBy("mark").option("path", path).option("compression", "zstd")
        writer.saveAsTable(name, format="parquet")
        return name, path

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"drop table if exists {name}")
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _merge(self, runs: list[tuple[str, str]]) -> tuple[str, str]:
        """One run of the sums of ``runs``, by merge joins of their buckets."""
        rows = self.spark.table(runs[0][0])
        for name, _ in runs[1:]:
            more = self.spark.table(name).withColumnRenamed("n", "m")
            both = rows.hint("merge").join(more, "mark", "full_outer")
            rows = both.select("mark", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
        merged = self._write(rows)
        self._drop(runs)
        return merged

    def add(self, docs: DataFrame) -> None:
        """Count the lines of a new batch of documents."""
        marks = stage(line_marks(docs), "line-marks")
        self.batches.append(marks)
        each = marks.select(F.explode(F.array_distinct("marks")).alias("mark")).where("mark is not null")
        fresh = each.groupBy(F.unhex("mark").alias("mark")).agg(F.count("*").alias("n"))
        for level in self.levels:
            for name, _ in level:
                known = self.spark.table(name).where(F.col("n") >= self.least)
                fresh = fresh.join(known.hint("merge"), "mark", "left_anti")
        self._place(self._write(fresh), 0)

    def _place(self, run: tuple[str, str], level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_in:
            runs, self.levels[level] = self.levels[level], []
            self._place(self._merge(runs), level + 1)

    def compact(self) -> None:
        """Merge all runs into one."""
        runs = [run for level in self.levels for run in level]
        if len(runs) > 1:
            self.levels = [[] for _ in self.levels] + [[self._merge(runs)]]

    def repeated(self) -> DataFrame:
        """(mark, n) of the keys of at least ``least`` documents among all batches."""
        self.compact()
        paths = [path for level in self.levels for _, path in level]
        if not paths:
            return self.spark.createDataFrame([], "mark binary, n long")
        # Read as plain files: the adaptive planner can then split the lines of a very frequent key.
        return self.spark.read.schema("mark binary, n long").parquet(*paths).where(F.col("n") >= self.least)

    def dropped_lines(self) -> DataFrame:
        """(id, text_mark, gone): for each document with repeated lines their positions from 0."""
        repeated = self.repeated()
        found = []
        for marks in self.batches:
            lines = marks.select("id", "text_mark", F.posexplode("marks").alias("nth", "mark")).where("mark is not null")
            found.append(lines.withColumn("mark", F.unhex("mark")))
        if not found:
            return self.spark.createDataFrame([], "id long, text_mark long, gone array<int>")
        rows = found[0]
        for more in found[1:]:
            rows = rows.unionByName(more)
        hits = rows.join(repeated.select("mark"), "mark", "left_semi")
        return hits.groupBy("id", "text_mark").agg(F.collect_set("nth").alias("gone"))

    def close(self) -> None:
        self._drop([run for level in self.levels for run in level])
        self.levels, self.batches = [], []


def drop_repeated(batches: list[DataFrame], least: int = LEAST_DOCUMENTS, fan_in: int = FAN_IN) -> DataFrame:
    """All rows of ``batches`` without repeated lines, with ``n_lines`` and ``n_dropped``.

    The batches have the same columns; columns of those two names are replaced.
    """
    runs = LineRuns(batches[0].sparkSession, least, fan_in)
    for batch in batches:
        runs.add(batch.select("doc_id", "text"))
    gone = stage(runs.dropped_lines(), "line-gone")
    runs.close()
    docs = batches[0]
    for batch in batches[1:]:
        docs = docs.unionByName(batch)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("whole"))
    same = F.col("whole.doc_id").eqNullSafe(gone["id"]) & (F.xxhash64(F.col("whole.text")) == gone["text_mark"])
    met = held.join(gone.hint("merge"), same, "left").select("whole", "gone", lines_of(F.col("whole.text")).alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    left = F.array_join(F.transform(kept, lambda nth: F.get("lines", nth)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("whole.text")).otherwise(left)
    return met.select(
        *[text.alias(c) if c == "text" else F.col(f"whole.`{c}`") for c in names],
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
