"""Bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import ID, TEXT, texts


def held_out(id_col: Column, parts: int, remainder: int) -> Column:
    """Whether a row belongs to the part whose labels are not learned from. Null ids do not."""
    fold = F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(parts)) == remainder
    return F.coalesce(fold, F.lit(False))


def labelled(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    rows: int,
    fold: tuple[int, int] | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 7,
) -> DataFrame:
    """At most ``rows`` labels in hash order, with the whole texts they belong to: id, text, label.

    Labels that are null, and those of the held-out ``fold`` (parts, remainder), are not drawn.
    The drawn labels are joined as a broadcast, whose size ``rows`` bounds.
    """
    known = labels.select(labels[id_col].alias(ID), labels[label_col].cast("int").alias("_label")).dropna()
    if fold:
        known = known.where(~held_out(F.col(ID), *fold))
    order = [F.xxhash64(F.col(ID).cast("string"), F.lit(seed)), F.col(ID), F.col("_label")]
    drawn = known.orderBy(*order).limit(rows)
    return texts(docs, id_col, text_col).join(F.broadcast(drawn), ID).select(ID, TEXT, "_label")
