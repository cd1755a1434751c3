"""Lines found in many documents, kept in levelled sorted runs of line hashes.

A run is a table of distinct line hashes with the number of documents that hold the line, bucketed
and sorted by the hash. Every batch of documents merges with the runs there are: hashes that some
run already knows to be common are taken out by an anti join, the others become a run of level 0.
When a level has ``fanout`` runs, they are merged into one of the next level, so a hash is written
again at most once a level. All runs have the same buckets, so a batch's merges move the batch only.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage, scratch_path

#: Fixed values of the contract: blanks stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


class LineRuns:
    """Runs of ``(h1, h2, docs)``: line hashes and in how many documents of their batches they stood.

    A hash counts as common once one run has it in ``least`` documents. Later batches leave it out,
    which changes no answer: its number is only asked to be ``least`` or more.
    """

    def __init__(self, spark: SparkSession, least: int, fanout: int = 4, buckets: int | None = None):
        self.spark, self.least, self.fanout = spark, least, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        # Spark 4.1 takes a union of bucketed scans for partitioned by the bucket, which it is not, and
        # would add up the rows of one hash apart.
        spark.conf.set("spark.sql.unionOutputPartitioning", "false")

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def unseen(self, counts: DataFrame) -> DataFrame:
        """The rows of ``counts`` whose hash is in no run as common: one merge per run."""
        for run in self.runs():
            counts = counts.join(run.where(F.col("docs") >= self.least), HASH, "left_anti")
        return counts

    def add(self, hashes: DataFrame) -> None:
        """A batch ``(h1, h2)``, one row for each document that has the line."""
        counts = hashes.groupBy(*HASH).agg(F.count("*").alias("docs"))
        self._keep(self.unseen(counts), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._keep(self._merged([self.spark.table(name) for name in full]), level + 1)
            for name in full:
                self._remove(name)
            level += 1

    def common(self) -> DataFrame:
        """``(h1, h2)`` of the lines found in ``least`` documents or more, over all runs."""
        return self._merged(self.runs()).where(F.col("docs") >= self.least).select(*HASH)

    def drop(self) -> None:
        """Remove all runs."""
        for name in (name for level in self.levels for name in level):
            self._remove(name)
        self.levels = [[]]

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        empty = self.spark.createDataFrame([], "h1 long, h2 long, docs long")
        return reduce(DataFrame.union, runs or [empty]).groupBy(*HASH).agg(F.sum("docs").alias("docs"))

    def _keep(self, rows: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
        writer.option("path", scratch_path(self.spark, "run")).saveAsTable(name)
        self.levels[level].append(name)

    def _remove(self, name: str) -> None:
        where = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()[1]
        self.spark.sql(f"DROP TABLE {name}")
        _delete(self.spark, where)


def _delete(spark: SparkSession, where: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """A to Z lower-cased, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_keys(text: Column) -> Column:
    """The key of each line of a text, as an array."""
    return F.transform(F.split(ascii_lower(text), "\n"), lambda line: F.btrim(line, F.lit(BLANKS)))


def _two_hashes(value: Column, names: list[str]) -> list[Column]:
    """128 bits of hash, as two numbers of independent seeds."""
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit(1), value).alias(names[1])]


def common_lines(docs: DataFrame, min_docs: int, min_chars: int, batches: int, fanout: int) -> DataFrame:
    """``(h1, h2)`` of the keys found in ``min_docs`` rows of ``docs(_id, _text)`` or more."""
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64("_id", "_text"), F.lit(batches)).cast("int").alias("batch")
    keys = docs.select(batch, F.explode(F.array_distinct(line_keys(F.col("_text")))).alias("key"))
    hashes = keys.where(F.char_length("key") >= min_chars).select("batch", *_two_hashes(F.col("key"), HASH))
    path = scratch_path(spark, "line-hashes")
    hashes.write.partitionBy("batch").parquet(path)
    kept = spark.read.schema(hashes.select(*HASH, "batch").schema).parquet(path)
    runs = LineRuns(spark, min_docs, fanout)
    for number in range(batches):
        runs.add(kept.where(F.col("batch") == number).select(*HASH))
    found = cut_lineage(runs.common())
    runs.drop()
    _delete(spark, path)
    return found


def drop_common_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = 6,
    fanout: int = 3,
) -> DataFrame:
    """Per row of ``docs``: the id, ``n_lines``, ``n_dropped`` and ``kept``, the text without common lines.

    Lines end at ``\\n``. A line's key is the line without blanks at its ends, A to Z lower-cased; a
    key of ``min_chars`` code points or more that stands in ``min_docs`` rows or more loses all its
    lines, in every row. Other lines stay as they are, joined by ``\\n``. ``documents`` are rows:
    repeated rows and repeated or null ids each count and each keep their row. Null and empty texts
    are one empty line, which stays if ``min_chars`` is 1 or more. An empty table gives none; other
    columns are not looked at. A key repeated in one row counts once.

    Texts themselves are moved at most once, when they meet the places of their dropped lines; these
    are found per distinct text, so copies share one entry.
    """
    digest = ["d1", "d2"]
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].alias("_id"), text.alias("_text"))
    common = common_lines(rows, min_docs, min_chars, batches, fanout)
    named = rows.select("_id", "_text", *_two_hashes(F.col("_text"), digest))
    lines = named.select(*digest, F.posexplode(F.split(ascii_lower(F.col("_text")), "\n")).alias("place", "line"))
    keys = lines.select(*digest, "place", F.btrim("line", F.lit(BLANKS)).alias("key"))
    hashed = keys.where(F.char_length("key") >= min_chars).select(*digest, "place", *_two_hashes(F.col("key"), HASH))
    dropped = hashed.join(common, HASH, "left_semi").groupBy(*digest).agg(F.collect_set("place").alias("_dropped"))
    parts = F.split("_text", "\n")
    places = F.sequence(F.lit(0), F.size(parts) - 1)
    stay = F.transform(F.array_except(places, "_dropped"), lambda place: F.get(parts, place))
    return named.join(dropped, digest, "left").select(
        F.col("_id").alias(id_col),
        F.size(parts).cast("long").alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_dropped").isNull(), F.col("_text")).otherwise(F.array_join(stay, "\n")).alias("kept"),
    )
