"""Mixing sources to target weights by Poisson replication.

Every document of a source is repeated a Poisson number of times whose mean is the source's target
repetition rate. The count inverts the distribution at a uniform number hashed from the seed and
the document's id, so it is the same on every run and needs no state. Copies are then shuffled
over all partitions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage

#: Up to this many table entries of all sources together are sent to all tasks.
BROADCAST_ENTRIES = 200_000
UNIFORM_HEX = 13  # 52 bits


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from the seed and some columns; null counts as the text "null"."""
    texts = [F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *texts).cast("binary"))
    return F.conv(F.substring(digest, 1, UNIFORM_HEX), 16, 10).cast("double") / float(16**UNIFORM_HEX)


def poisson_tables(rates: DataFrame, key: str) -> DataFrame:
    """``(key, cdf)``: P(count <= k) for k = 0, 1, ... of each ``rate``, to where 52 bits end.

    Terms are summed as logarithms, since exp(-rate) vanishes for rates above 700. The number of
    entries grows with the rate alone.
    """
    upto = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 20).cast("int")
    steps = rates.where("rate > 0").select(key, "rate", F.explode(F.sequence(F.lit(0), upto)).alias("k"))
    before = W.partitionBy(key).orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    growth = F.when(F.col("k") == 0, -F.col("rate")).otherwise(F.log("rate") - F.log(F.greatest("k", F.lit(1))))
    terms = steps.select(key, "k", F.exp(F.sum(growth).over(before)).alias("p"))
    sums = terms.select(key, F.struct("k", F.sum("p").over(before).alias("c")).alias("e"))
    return sums.groupBy(key).agg(F.array_sort(F.collect_list("e")).getField("c").alias("cdf"))


def repetition_rates(
    docs: DataFrame,
    source_col: str,
    size: Column,
    weights: Mapping[str | None, float] | None,
    temperature: float,
) -> DataFrame:
    """``(source, size, rate)``: how often a document of each source is to be repeated on average.

    The mix is as large as the input. Without ``weights`` a source's target share goes with its
    size to the power ``temperature``; with them, sources not named get none.
    """
    sizes = docs.groupBy(docs[source_col].alias("source")).agg(F.sum(size).alias("size"))
    if weights is None:
        target = F.when(F.col("size") > 0, F.pow(F.col("size").cast("double"), F.lit(temperature)))
        sizes = sizes.withColumn("weight", target)
    else:
        named = docs.sparkSession.createDataFrame(list(weights.items()), "name string, weight double")
        named = F.broadcast(named)  # as many rows as the caller has named
        sizes = sizes.join(named, F.col("source").cast("string").eqNullSafe(F.col("name")), "left").drop("name")
    sizes = sizes.withColumn("weight", F.when(F.col("size") > 0, F.coalesce("weight", F.lit(0.0))).otherwise(F.lit(0.0)))
    sizes = cut_lineage(sizes)
    all_size, all_weight = sizes.agg(F.sum("size"), F.sum("weight")).first()
    if not all_size or not all_weight:
        return sizes.select("source", "size", F.lit(0.0).alias("rate"))
    rate = F.lit(float(all_size)) * F.col("weight") / F.lit(float(all_weight)) / F.col("size")
    return sizes.select("source", "size", F.when(F.col("size") > 0, rate).otherwise(F.lit(0.0)).alias("rate"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Mapping[str | None, float] | None = None,
    temperature: float = 0.5,
    seed: int = 11,
) -> DataFrame:
    """The copies that make up the mix: all columns of ``docs``, ``copy`` (from 1) and ``shuffle_key``.

    A document's size is that of its text in bytes. Copies are dealt to partitions by the hash of
    ``shuffle_key`` (a hash of seed, id and copy) and sorted by it there, which shuffles them over
    the whole mix. Documents whose count is 0 are not in it: that is the sampling.

    Null sources are a source of their own. A null id is taken as the text "null". Rows that
    repeat an id get the same count each. Sources whose texts are all null or empty have size 0,
    rate 0 and no copies; an empty table gives none. Columns of ``docs`` named like the two new
    ones are replaced.

    The rate tables are joined as a broadcast if their entries, which are counted, are few; else by
    shuffle, where Spark splits the partitions of hot sources.
    """
    size = F.coalesce(F.octet_length(docs[text_col].cast("string")).cast("long"), F.lit(0))
    rates = repetition_rates(docs, source_col, size, weights, temperature)
    tables = cut_lineage(poisson_tables(rates, "source"))
    entries = tables.agg(F.sum(F.size("cdf"))).first()[0] or 0
    tables = tables.withColumnRenamed("source", "_source").withColumnRenamed("cdf", "_cdf")
    if entries <= BROADCAST_ENTRIES:
        tables = F.broadcast(tables)
    # Drawn below the join, so that the hash is made once a row and not once a table entry.
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns if c not in ("copy", "shuffle_key")]).alias("_doc"),
        docs[id_col].alias("_id"),
        docs[source_col].alias("_of"),
        uniform(seed, docs[id_col]).alias("_u"),
    )
    counted = rows.join(tables, F.col("_of").eqNullSafe(F.col("_source"))).select(
        "_doc", "_id", F.size(F.filter("_cdf", lambda c: c <= F.col("_u"))).cast("long").alias("_n")
    )
    copies = counted.where("_n > 0").select("_doc", "_id", F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("copy"))
    names = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("_id", "copy")]
    key = F.md5(F.concat_ws("|", F.lit(f"shuffle {seed}"), *names).cast("binary"))
    out = copies.select("_doc.*", "copy", key.alias("shuffle_key"))
    return out.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
