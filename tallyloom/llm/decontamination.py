"""Benchmark decontamination with a distributed positional inverted index.

``index_documents`` turns documents into shards, each a row with a run of documents
and the postings of all their words: sorted positions per term. ``search_index`` asks every shard
for every window of the test texts: it starts from the window's rarest term, by frequencies over
all documents, and intersects the lists of its other terms, moved by their offsets, from rare to frequent. What is
left are exact phrases; the same lists give proximity matches. Postings never leave their shard,
so nothing is shuffled, and no word, however frequent, gathers in one task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import texts
from tallyloom.session import cut_lineage

#: Bytes that belong to words, lower-cased; all others become blanks. Bytes of 128 and up are
#: parts of code points outside ASCII.
WORD_BYTES = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
#: Test texts up to this size go to all tasks at once; more go in blocks, one after the other.
#: Their windows take about a hundred times as much memory in a task.
BLOCK_BYTES = 1 << 20
#: A shard ends with the document that takes its texts to this size.
SHARD_BYTES = 8 << 20
#: Empty positions between two documents of a shard; no phrase or proximity reaches across.
GAP = 64
#: Candidate places worked on at once.
WORK = 1 << 20

SHARD = "shard string, ids array<{id}>, n_words array<int>, terms array<binary>, starts binary, positions binary"


def words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class Numbers(dict):
    """A number for each word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def index_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shards of a positional inverted index over whole texts; write it to search it again.

    One row per shard, a run of documents of about ``SHARD_BYTES``: their ids and word counts in
    order, the distinct terms, and per term (``starts``) the sorted ``positions``.
    """
    source = texts(docs, id_col, text_col)
    schema = SHARD.format(id=source.schema["_id"].dataType.simpleString())

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(np.nan_to_num(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)))
            cuts = np.searchsorted(size, np.arange(SHARD_BYTES, size[-1] if len(size) else 0, SHARD_BYTES)) + 1
            for low, high in pairwise(np.unique([0, *cuts, len(size)]).tolist()):
                yield batch.slice(low, high - low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, batch in enumerate(shards(batches)):
            numbers, runs = Numbers(), []
            for text in batch.column(1):
                found = words(text.as_py())
                runs.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
            sizes = np.fromiter(map(len, runs), np.int64, len(runs))
            places = np.arange(sizes.sum()) + np.repeat(np.arange(len(runs)) * GAP, sizes)
            tokens = np.concatenate(runs)
            order = np.argsort(tokens, kind="stable")
            counts = np.bincount(tokens, minlength=len(numbers))
            starts = np.concatenate(([0], np.cumsum(counts)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{TaskContext.get().partitionId()}-{k}"]),
                    one(batch.column(0)),
                    one(pa.array(sizes, pa.int32())),
                    one(pa.array(numbers.keys(), pa.binary())),
                    pa.array([starts.astype(np.int64).tobytes()], pa.binary()),
                    pa.array([places[order].astype(np.int32).tobytes()], pa.binary()),
                ],
                ["shard", "ids", "n_words", "terms", "starts", "positions"],
            )

    return source.mapInArrow(run, schema)


def one(values: pa.Array) -> pa.Array:
    """A list array with all values in its only row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class Windows:
    """The distinct windows of test texts: term numbers, offsets, and the items they belong to."""

    def __init__(self, items: list[tuple[str, bytes | None]], width: int):
        numbers, owners = Numbers(), {}
        for item, text in items:
            found = words(text)
            ids = [numbers[w] for w in found]
            if ids:
                for i in range(max(1, len(ids) - width + 1)):
                    owners.setdefault(tuple(ids[i : i + width]), set()).add(item)
        self.terms = list(numbers)
        self.items = sorted({i for some in owners.values() for i in some})
        rank = {item: k for k, item in enumerate(self.items)}
        self.length = np.fromiter(map(len, owners), np.int64, len(owners))
        # Shorter windows repeat their first word in place, which asks nothing new.
        self.term = np.array([w + w[:1] * (width - len(w)) for w in owners], np.int64).reshape(-1, width)
        steps = np.arange(width)
        self.offset = np.where(steps < self.length[:, None], steps, 0)
        self.owner = np.array([rank[i] for some in owners.values() for i in sorted(some)], np.int64)
        self.owned = np.concatenate(([0], np.cumsum([len(some) for some in owners.values()]))).astype(np.int64)

    def rank(self, frequency: np.ndarray) -> None:
        """Put the terms of each window in order, from rare to frequent; those that occur nowhere last."""
        times = np.where(frequency > 0, frequency, np.iinfo(np.int64).max)[self.term]
        order = np.argsort(times, axis=1, kind="stable")
        self.term = np.take_along_axis(self.term, order, axis=1)
        self.offset = np.take_along_axis(self.offset, order, axis=1)


def _steps(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


class Shard:
    """The postings of a shard for the terms of the test texts."""

    def __init__(self, asked: list[bytes], terms: list[bytes], starts: bytes, positions: bytes):
        starts, positions = np.frombuffer(starts, np.int64), np.frombuffer(positions, np.int32)
        number = {t: i for i, t in enumerate(terms)}
        here = np.array([number.get(t, -1) for t in asked], np.int64)
        self.count = np.where(here >= 0, starts[here + 1] - starts[here], 0)
        self.start = np.cumsum(self.count) - self.count
        runs = [positions[starts[i] : starts[i + 1]] for i in here.tolist() if i >= 0]
        self.position = np.concatenate(runs).astype(np.int64) if runs else np.zeros(0, np.int64)
        # Sorted by term, then position: one list for all intersections.
        self.key = np.repeat(np.arange(len(asked)), self.count) << 32 | self.position

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether each term stands at its place."""
        wanted = term << 32 | place
        at = np.searchsorted(self.key, wanted)
        at[at == len(self.key)] = 0
        return (place >= 0) & (self.key[at] == wanted) if len(self.key) else np.zeros(len(wanted), bool)

    def near(self, term: np.ndarray, place: np.ndarray, slop: int) -> np.ndarray:
        """Whether each term stands within ``slop`` words of its place."""
        low = np.searchsorted(self.key, term << 32 | np.maximum(place - slop, 0))
        high = np.searchsorted(self.key, term << 32 | np.maximum(place + slop, 0), "right")
        return (high > low) & (place + slop >= 0)

    def search(self, w: Windows, slop: int, near_terms: int):
        """Windows and where they begin, and windows near which their rarest word stands.

        Proximity needs the first ``near_terms`` terms of the ranked windows only, a phrase all.
        """
        width = w.term.shape[1]
        here = self.count[w.term] > 0 if len(w.term) else np.zeros(w.term.shape, bool)
        possible = np.flatnonzero(here[:, : max(2, near_terms)].all(axis=1))
        whole = here[possible].all(axis=1)
        term, offset = w.term[possible], w.offset[possible]
        exact, near = [], []
        # Windows that overlap mostly share their two rarest terms: meet those lists once.
        pair = np.stack([term[:, 0], term[:, 1], offset[:, 1] - offset[:, 0]], axis=1)
        pairs, which = np.unique(pair, axis=0, return_inverse=True)
        which = which.reshape(-1)
        of_pair = np.argsort(which, kind="stable")
        first = np.searchsorted(which[of_pair], np.arange(len(pairs) + 1))
        counts = self.count[pairs[:, 0]]
        upto = np.cumsum(counts)
        low = 0
        while low < len(pairs):
            high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + WORK, "right")))
            some = np.repeat(np.arange(low, high), counts[low:high])
            within = _steps(counts[low:high])
            place = self.position[self.start[pairs[some, 0]] + within]
            close = self.near(pairs[some, 1], place + pairs[some, 2], slop)
            some, place = some[close], place[close]
            # Each place of a pair is a candidate for all windows that begin with the pair.
            many = first[some + 1] - first[some]
            row = of_pair[np.repeat(first[some], many) + _steps(many)]
            begin = np.repeat(place, many) - offset[row, 0]
            rows, begins = row, begin
            for k in range(2, min(near_terms, width)):
                left = self.near(term[rows, k], begins + offset[rows, k], slop)
                rows, begins = rows[left], begins[left]
            near.append((possible[rows], begins + offset[rows, 0]))
            row, begin = row[whole[row]], begin[whole[row]]
            for k in range(1, width):
                left = self.has(term[row, k], begin + offset[row, k])
                row, begin = row[left], begin[left]
            exact.append((possible[row], begin))
            low = high
        nothing = [(np.zeros(0, np.int64),) * 2]
        return [tuple(map(np.concatenate, zip(*(found or nothing), strict=True))) for found in (exact, near)]


def _lists(key: np.ndarray, value: np.ndarray, rows: int, values: pa.Array) -> pa.Array:
    """Per row the sorted distinct values, as a list array."""
    pairs = np.unique(np.stack([key, value], axis=1), axis=0) if len(key) else np.zeros((0, 2), np.int64)
    ends = np.searchsorted(pairs[:, 0], np.arange(rows + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values.take(pa.array(pairs[:, 1])))


def _in_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[Counter]:
    for batch in batches:
        found = Counter()
        for text in batch.column(1):
            found.update(words(text.as_py()))
        yield found


def _in_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[bytes, int]]:
    for batch in batches:
        for terms, starts in zip(batch.column("terms"), batch.column("starts"), strict=True):
            counts = np.diff(np.frombuffer(starts.as_py(), np.int64))
            yield dict(zip(terms.as_py(), counts.tolist(), strict=True))


def frequencies(rows: DataFrame, count, items: list) -> np.ndarray:
    """How often each word of the test texts, numbered as in ``Windows``, occurs in all documents."""
    numbers = Numbers()
    for _, text in items:
        for word in words(text):
            numbers[word]
    asked = rows.sparkSession.sparkContext.broadcast(list(numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(asked.value), np.int64)
        for found in count(batches):
            total += np.fromiter((found.get(w, 0) for w in asked.value), np.int64, len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["term", "n"])

    out = np.zeros(len(numbers), np.int64)
    for r in rows.mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    asked.destroy()
    return out


def _search_block(index: DataFrame, asked: Broadcast, width: int, slop: int, near_terms: int) -> DataFrame:
    """Per document of the index: its words, hit positions as spans, and item ids.

    ``asked`` has the items and the frequencies of their words.
    """
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    schema = f"shard string, shard_row int, id {id_type}, n_words int, spans array<struct<a:int,b:int>>, items array<string>, near array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = Windows(asked.value[0], width)
        w.rank(asked.value[1])
        names = pa.array(w.items, pa.string())
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values
                sizes = batch.column("n_words")[i].values.to_numpy().astype(np.int64)
                shard = Shard(w.terms, *[batch.column(c)[i].as_py() for c in ("terms", "starts", "positions")])
                (row, begin), (near_row, near_place) = shard.search(w, slop, near_terms)
                rows = len(sizes)
                base = np.cumsum(sizes + GAP) - sizes - GAP
                doc = np.searchsorted(base, begin, "right") - 1
                spans = _spans(doc, begin - base[doc], w.length[row], rows)
                owned = w.owned[row + 1] - w.owned[row]
                item = _owners(w, row, owned)
                near_doc = np.searchsorted(base, near_place, "right") - 1
                near_owned = w.owned[near_row + 1] - w.owned[near_row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(batch.column("shard")[i], rows),
                        pa.array(np.arange(rows), pa.int32()),
                        ids,
                        pa.array(sizes, pa.int32()),
                        spans,
                        _lists(np.repeat(doc, owned), item, rows, names),
                        _lists(np.repeat(near_doc, near_owned), _owners(w, near_row, near_owned), rows, names),
                    ],
                    ["shard", "shard_row", "id", "n_words", "spans", "items", "near"],
                )

    return index.mapInArrow(run, schema)


def _search_blocks(index: DataFrame, tests: DataFrame, width: int, slop: int, near_terms: int) -> DataFrame:
    """The same for test texts of any size, one block after the other.

    The driver holds the texts of one block at a time. A block's hits, of documents that have any,
    are a table before the next block is fetched, so that its broadcast can go.
    """
    context = index.sparkSession.sparkContext
    size = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    block, hits = F.pmod(F.xxhash64("item", "text"), F.lit(n)), []
    for k in range(n):
        items = tests.where(block == k).collect()
        asked = context.broadcast((items, frequencies(index, _in_shards, items)))
        found = _search_block(index, asked, width, slop, near_terms).where("size(items) > 0 OR size(near) > 0")
        hits.append(cut_lineage(found.select("shard", "shard_row", "spans", "items", "near")))
        asked.destroy()
    every = lambda c: F.array_sort(F.flatten(F.collect_list(c)))  # noqa: E731  as many lists as blocks
    of_row = reduce(DataFrame.union, hits).groupBy("shard", "shard_row").agg(
        merged(every("spans")).alias("spans"),
        *[F.array_distinct(every(c)).alias(c) for c in ("items", "near")],
    )
    rows = index.select("shard", F.posexplode(F.arrays_zip("ids", "n_words")).alias("shard_row", "row"))
    rows = rows.select("shard", "shard_row", F.col("row.ids").alias("id"), F.col("row.n_words").alias("n_words"))
    none = {"spans": "array<struct<a:int,b:int>>", "items": "array<string>", "near": "array<string>"}
    empty = {c: F.coalesce(c, F.array().cast(kind)) for c, kind in none.items()}
    return rows.join(of_row, ["shard", "shard_row"], "left").withColumns(empty)


def _owners(w: Windows, row: np.ndarray, owned: np.ndarray) -> np.ndarray:
    return w.owner[np.repeat(w.owned[row], owned) + _steps(owned)]


def _spans(doc: np.ndarray, begin: np.ndarray, length: np.ndarray, rows: int) -> pa.Array:
    """Per document the merged spans [a, b) of its hit words."""
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], (begin + length)[order]
    if len(doc):
        # Lift each document above the last, so that one running maximum serves all.
        lift = doc * (int(end.max()) + 1)
        reach = np.maximum.accumulate(end + lift)
        new = np.concatenate(([True], begin[1:] + lift[1:] > reach[:-1]))
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(doc)) - 1
        doc, begin, end = doc[heads], begin[heads], (reach - lift)[tails]
    values = pa.StructArray.from_arrays([pa.array(begin, pa.int32()), pa.array(end, pa.int32())], ["a", "b"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(rows + 1)), pa.int32()), values)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    width: int = 10,
    slop: int = 2,
    near_terms: int = 3,
) -> DataFrame:
    """Per row of ``docs``: the id, ``n_words``, ``spans`` of hit words, ``items`` and ``near``.

    A window is ``width`` consecutive words of a test item, or all words of a shorter item. A
    document word inside an occurrence of a window is hit; ``items`` are the ids (as strings,
    sorted) of items with occurring windows. ``near`` lists items of which some window has its
    ``near_terms`` rarest words within ``slop`` words of their places: evidence, not a verdict.
    Rarest are those with the fewest occurrences in all of ``docs``, of equals the first; a word
    that occurs nowhere is passed over.

    Null and empty texts have no words and no hits, and items without words have no windows. A
    null item id is listed as "null"; items that share an id count once. Repeated rows and null
    document ids each keep their row; an empty table gives none; other columns are not looked at.

    The size of the test texts is checked: up to ``BLOCK_BYTES`` they go to the tasks in one
    broadcast; beyond that in blocks of that size (one item at least) against the index, which is
    then kept as a table. The driver holds one block at a time.
    """
    tests = benchmark.select(
        F.coalesce(benchmark[item_col].cast("string"), F.lit("null")).alias("item"),
        benchmark[item_text].cast("string").cast("binary").alias("text"),
    )
    if width + slop >= GAP:
        raise ValueError(f"width and slop must stay below {GAP}")
    index = index_documents(docs, id_col, text_col)
    size = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    if size <= BLOCK_BYTES:
        items = tests.collect()
        often = frequencies(texts(docs, id_col, text_col), _in_texts, items)
        asked = docs.sparkSession.sparkContext.broadcast((items, often))
        found = _search_block(index, asked, width, slop, near_terms)
    else:
        index = cut_lineage(index)
        found = _search_blocks(index, cut_lineage(tests.distinct()), width, slop, near_terms)
    return found.select(F.col("id").alias(id_col), "n_words", "spans", "items", "near")


def merged(spans: Column) -> Column:
    """Sorted spans with those that touch or overlap made one."""
    none = F.slice(spans, 1, 0)

    def add(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["a"].alias("a"), F.greatest(last["b"], span["b"]).alias("b"))
        kept = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(span["a"] <= last["b"], F.concat(kept, F.array(longer))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, none, add)


def n_hit(spans: Column) -> Column:
    """Words in merged spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
