"""SimHash near-duplicates with bit-sliced comparison.

Texts get 64-bit fingerprints of their word shingles. Two fingerprints within ``radius`` bits agree
in all but ``radius`` of ``BLOCKS`` runs of bits, so each distinct fingerprint is filed once under
every choice of ``BLOCKS - radius`` runs, and only those filed together are compared. The
comparison is bit-sliced: 64 fingerprints of a bucket stand side by side in a lane block, one
64-bit word per bit plane, and carry-save counters add the differing bits of all 64 at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm.batches import map_texts, text_column
from tallyloom.llm.components import components
from tallyloom.session import cut_lineage

BITS, BLOCKS, SEED = 64, 5, 42
#: Buckets with more fingerprints than this are cut into parts, and the pairs of parts spread out.
PART = 4096
#: (query, lane block) comparisons worked on at once: 64 pairs each, a few MB of counters.
WORK = 1 << 14
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The bits set in over half the shingle hashes; zero without words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=False)
        parts = [joined[a:b] for a, b in spans]
    counts, n = np.zeros(BITS, np.int64), len(parts)
    for k in range(0, n, 65536):  # unpacked bits of one slice at a time
        some = parts[k : k + 65536]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, some, repeat(SEED)), np.uint64, len(some))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    packed = np.packbits(2 * counts > n, bitorder="little")
    return int(packed.view(np.int64)[0])


def _start(shingle: int):
    return lambda: lambda batch: [pa.array([fingerprint(t, shingle) for t in batch], pa.int64())]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp long)`` per row, over whole texts. Null and empty texts have fingerprint zero."""
    return map_texts(docs, id_col, text_col, "fp long", _start(shingle))


def _masks(radius: int) -> list[int]:
    """For each choice of runs of bits that must agree, its bits as a signed mask."""
    edges = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
    runs = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(c) for c in combinations(runs, BLOCKS - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _filed(fps: DataFrame, radius: int) -> DataFrame:
    """Each fingerprint under each of its keys."""
    keys = F.array(
        *[
            F.struct(F.lit(i).alias("file"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in enumerate(_masks(radius))
        ]
    )
    return fps.select("fp", F.inline(keys))


def _pairs_of_parts(filed: DataFrame) -> DataFrame:
    """Buckets of two and more, as units of work ``(file, key, p, q, fp, part)``.

    A bucket of up to ``PART`` fingerprints is one unit. A larger one is cut by hash into parts
    and every pair of parts p <= q is a unit, so one key never meets in one task.
    """
    sizes = filed.groupBy("file", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / PART).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    return (
        filed.join(sizes, ["file", "key"])
        .withColumn("parts", parts)
        .withColumn("part", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "file", "key", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "fp", "part"
        )
    )


def _packed(lanes: np.ndarray) -> np.ndarray:
    """Booleans (..., 64) as one 64-bit word each."""
    return np.ascontiguousarray(np.packbits(lanes, axis=-1, bitorder="little")).view(np.uint64)[..., 0]


def close_lanes(fps: np.ndarray, part: np.ndarray, starts: np.ndarray, radius: int):
    """Yield arrays (row, row) of fingerprints of one unit within ``radius`` bits of each other.

    ``fps`` holds units one after the other, beginning at ``starts``. Each unit is padded to whole
    lane blocks. Within a unit of two parts only pairs across them are compared, since each part
    has a unit of its own.
    """
    rows = len(fps)
    ends = np.append(starts[1:], rows)
    sizes = ends - starts
    unit = np.repeat(np.arange(len(starts)), sizes)
    blocks = -(-sizes // 64)
    first_block = np.cumsum(blocks) - blocks
    place = np.arange(rows) - starts[unit]
    lane = first_block[unit] * 64 + place
    total = int(blocks.sum())
    row_of = np.full(total * 64, -1, np.int64)
    row_of[lane] = np.arange(rows)
    standing = np.zeros((total, 64), np.uint64)
    standing.reshape(-1)[lane] = fps
    second = np.zeros(total * 64, bool)
    second[lane] = part > 0
    valid, side = _packed(row_of.reshape(total, 64) >= 0), _packed(second.reshape(total, 64))
    across = np.zeros(len(starts), bool)
    np.logical_or.at(across, unit, part != part[starts][unit])
    bits = np.unpackbits(standing.view(np.uint8).reshape(total, 64, 8), axis=2, bitorder="little")
    planes = _packed(bits.transpose(2, 0, 1))

    # Row r meets the blocks of its unit from its own on: later rows only.
    count = (first_block + blocks)[unit] - lane // 64
    upto = np.cumsum(count)
    low = 0
    while low < rows:
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + WORK, "right")))
        some = np.arange(low, high)
        query = np.repeat(some, count[some])
        block = np.arange(len(query)) - np.repeat(np.cumsum(count[some]) - count[some], count[some]) + lane[query] // 64
        own = block == lane[query] // 64
        later = np.where(own, ~((np.uint64(2) << (lane[query] % 64).astype(np.uint64)) - np.uint64(1)), ALL)
        alive = valid[block] & later
        mixed = across[unit[query]]
        alive &= np.where(mixed, np.where(part[query] > 0, ~side[block], side[block]), ALL)
        ones = np.zeros(len(query), np.uint64)
        counters = [ones, *[np.zeros_like(ones) for _ in range(max(1, (radius + 1).bit_length()) - 1)]]
        over = ~alive
        for k in range(BITS):
            carry = planes[k][block] ^ np.where(fps[query] >> np.uint64(k) & np.uint64(1), ALL, np.uint64(0))
            for c in range(len(counters)):  # a carry-save adder per lane
                counters[c], carry = counters[c] ^ carry, counters[c] & carry
            over |= carry
            if len(counters) and k % 8 == 7:
                over |= _above(counters, radius)
                keep = over != ALL  # a block is abandoned once every lane is beyond the radius
                if not keep.all():
                    query, block, over = query[keep], block[keep], over[keep]
                    counters = [x[keep] for x in counters]
                if not len(query):
                    break
        if len(query):
            hits = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            entry, bit = np.nonzero(hits)
            yield query[entry], row_of[block[entry] * 64 + bit]
        low = high


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter stands above the radius."""
    above, equal = np.zeros_like(counters[0]), np.full_like(counters[0], ALL)
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            equal = equal & counters[i]
        else:
            above, equal = above | (equal & counters[i]), equal & ~counters[i]
    return above


def spanning(rows: int, pairs) -> np.ndarray:
    """The root of every row, by hooking the larger root of each pair to the smaller."""
    root = np.arange(rows)
    for a, b in pairs:
        while len(a):
            ra, rb = root[a], root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(up := root[root], root):
                root = up
    return root


def _links(units: DataFrame, radius: int) -> DataFrame:
    """Edges that connect what is linked within each unit: at most one per fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def edges(table: np.ndarray) -> pa.RecordBatch:
            change = np.any(table[1:, :4] != table[:-1, :4], axis=1)
            starts = np.concatenate(([0], np.flatnonzero(change) + 1))
            fps, part = table[:, 4].view(np.uint64), (table[:, 5] != table[:, 2]).astype(np.int8)
            root = spanning(len(table), close_lanes(np.ascontiguousarray(fps), part, starts, radius))
            linked = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays(
                [pa.array(table[linked, 4]), pa.array(table[root[linked], 4])], ["a", "b"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
            rows = np.concatenate([*held, rows])
            last = np.flatnonzero(np.any(rows[:, :4] != rows[-1, :4], axis=1))
            cut = last[-1] + 1 if len(last) else 0  # the last unit may go on in the next batch
            if cut:
                yield edges(rows[:cut])
            held = [rows[cut:]]
        if held and len(held[0]):
            yield edges(held[0])

    units = units.repartition("file", "key", "p", "q").sortWithinPartitions("file", "key", "p", "q", "part", "fp")
    return units.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 3,
) -> DataFrame:
    """Per row: the id, ``fp`` (long), ``component`` (its smallest fingerprint) and ``component_id``.

    Fingerprints link at ``radius`` or fewer differing bits; a component is what links reach, and
    ``component_id`` the smallest id in it (null only if all its ids are null). Null and empty
    texts share fingerprint zero, which links like any other. Repeated rows each keep their row;
    an empty table gives none; other columns are not looked at.

    Copies meet in one fingerprint by partial minima before anything is compared, so a group of
    copies costs one row per task. Fingerprints, edges and labels are kept as tables in the shared
    folder; no list of them reaches the driver.
    """
    return grouped(cut_lineage(fingerprints(docs, id_col, text_col, shingle)), id_col, radius)


def grouped(of_rows: DataFrame, id_col: str, radius: int) -> DataFrame:
    """The same from rows ``(id, fp)`` that are kept as a table."""
    distinct = of_rows.groupBy("fp").agg(F.min(id_col).alias("smallest"))
    fps = cut_lineage(distinct)
    edges = _links(_pairs_of_parts(_filed(fps.select("fp"), radius)), radius)
    rooted = cut_lineage(components(edges).join(fps, F.col("node") == fps.fp).select("fp", "root", "smallest"))
    per_root = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    roots = rooted.select("fp", "root").join(per_root, "root")
    labels = cut_lineage(
        fps.join(roots, "fp", "left").select(
            "fp",
            F.coalesce("root", "fp").alias("component"),
            F.when(F.col("root").isNull(), F.col("smallest")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )
    return of_rows.join(labels, "fp").select(id_col, "fp", "component", "component_id")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """One row of ``docs`` of each group of near copies, with all its columns: that of the smallest id.

    Rows with their fingerprints are kept as a table once. Which of them stays is settled on ids
    and fingerprints alone, with partial minima per group; the rows themselves are moved once, when
    that choice is joined back. A null id counts as larger than any other. Of rows that share id
    and fingerprint, the first in the order of their columns stays. Null and empty texts are one
    group, fingerprint zero; an empty table gives none; column names do not matter.
    """
    fp = text_column(docs, text_col, "fp long", _start(shingle))["fp"]
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = cut_lineage(docs.select(whole, docs[id_col].alias("id"), fp.alias("fp")))
    found = grouped(rows.select("id", "fp"), "id", radius)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("first")
    # A struct makes null ids equal, and one exchange serves both the join and the window.
    own = F.struct("id").alias("own")
    stays = found.groupBy("component").agg(first).select("first.id", "first.fp").select(own, "fp")
    kept = rows.select("row", own, "fp").join(stays, ["own", "fp"])
    order = [F.col("row")[c] for c in docs.columns]
    place = F.row_number().over(W.partitionBy("own", "fp").orderBy(*order))
    return kept.withColumn("place", place).where("place = 1").select("row.*")
