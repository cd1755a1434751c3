"""Phrase collocation mining over vertically partitioned, depth-truncated suffix subtrees.

Every word position begins a suffix, cut at ``longest`` words. Words, then pairs of words, are the
first prefixes counted; a suffix ends where a pair rarer than ``least`` begins, because no phrase
across it can be frequent. Equal suffixes are added up; what is left are the leaves. They are
grouped by prefix so that a group holds about ``budget`` leaves: a prefix with more is taken one
word longer, until its parts fit. Each group is sorted and walked once as a subtree by itself; a node's
count is the total of the leaves below it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm.batches import small_batches
from tallyloom.session import cut_lineage

#: Fixed values of the contract: bytes that end a piece, and blanks between words.
STOPS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Tokens of a batch that are no words: nothing between two blanks, and the end of a piece.
NOTHING, END = b"", b"\n"
TABLE = bytes(0x0A if b in STOPS else 0x20 if b in BLANKS else b for b in range(256))
#: Bits of the filters of frequent words and pairs, whatever the data: 1 MB each. A false hit costs
#: work and changes no count.
FILTER_BITS, FILTER_PART = 1 << 23, 1 << 15
#: Distinct words a task adds up before it passes them on.
KEEP = 200_000


def _filter(places: DataFrame) -> np.ndarray:
    """The bits ``at`` of ``places``. Made in Spark; at most 1 MB reaches the driver."""
    # The built-in functions count positions from one within a part.
    parts = places.select((F.col("at") + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
    )
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for part, packed in parts.collect():
        start = (part - 1) * FILTER_PART // 8
        bits[start : start + FILTER_PART // 8] = np.frombuffer(packed, np.uint8)
    return bits


def _let_through(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    at = at % FILTER_BITS
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def frequent_words(single: DataFrame) -> np.ndarray:
    """The filter of the words in ``single (lang, words)``."""
    key = F.concat(F.col("lang").cast("binary"), F.lit("\t").cast("binary"), F.col("words").cast("binary"))
    return _filter(single.select(F.pmod(F.crc32(key), F.lit(FILTER_BITS)).alias("at")))


def _passing(bits: np.ndarray, lang: str, words: Iterable[bytes]) -> np.ndarray:
    """Whether the filter of words lets each of some words through."""
    start = zlib.crc32(lang.encode() + b"\t")
    return _let_through(bits, np.fromiter((zlib.crc32(w, start) for w in words), np.int64))


class Numbers(dict):
    """A number for each token, in order of appearance."""

    def __missing__(self, token: bytes) -> int:
        self[token] = number = len(self)
        return number


def tokens(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of the words of some texts in order, 1 where a piece ends, and the words by number."""
    joined = END.join(texts).lower().translate(TABLE).replace(END, b" \n ")
    numbers = Numbers({NOTHING: 0, END: 1})
    ids = np.fromiter(map(numbers.__getitem__, joined.split(b" ")), np.int32)
    return np.append(ids[ids > 0], 1), list(numbers)


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    for batch in batches:
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            texts.setdefault(lang, []).append(text)
        for lang, some in texts.items():
            yield lang, *tokens(some)


def _counted(langs: list[str], words: list[bytes], counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
        ["lang", "words", "n"],
    )


COUNTED = "lang string, words string, n long"


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy("lang", "words").agg(F.sum("n").alias("n"))


def word_counts(rows: DataFrame) -> DataFrame:
    """``(lang, words, n)``: occurrences of every word, each followed by a blank."""

    def run(batches):
        total: Counter = Counter()
        for lang, ids, words in _by_language(batches):
            times = np.bincount(ids, minlength=len(words)).tolist()
            for word, n in zip(words[2:], times[2:], strict=True):
                total[lang, word + b" "] += n
            if len(total) > KEEP:
                yield _counted([k[0] for k in total], [k[1] for k in total], list(total.values()))
                total.clear()
        if total:
            yield _counted([k[0] for k in total], [k[1] for k in total], list(total.values()))

    return _added(rows.mapInArrow(run, COUNTED))


def _usable(lang: str, ids: np.ndarray, words: list[bytes], frequent: np.ndarray) -> np.ndarray:
    """Whether each position is a word that may be frequent."""
    good = _passing(frequent, lang, (w + b" " for w in words))
    good[:2] = False
    return good[ids]


def _pairs(lang: str, ids: np.ndarray, words: list[bytes], usable: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions at which a pair of usable words begins, hashes of the distinct pairs, and which one it is."""
    at = np.flatnonzero(usable[:-1] & usable[1:])
    pairs, which = np.unique(ids[at].astype(np.int64) << 32 | ids[at + 1], return_inverse=True)
    seed = zlib.crc32(lang.encode())
    of_word = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))
    first, second = of_word[pairs >> 32], of_word[pairs & 0xFFFFFFFF]
    hashed = (first ^ first >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + second
    hashed = (hashed ^ hashed >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9)
    return at, (hashed ^ hashed >> np.uint64(31)).view(np.int64), which


def frequent_pairs(rows: DataFrame, frequent: np.ndarray, least: int) -> np.ndarray:
    """The filter of pairs of neighbouring words, each let through, that occur ``least`` times.

    Pairs are counted by a hash of 64 bits; equal hashes of different pairs add up and at worst let a
    rare pair through, as the filter does.
    """

    def run(batches):
        for lang, ids, words in _by_language(batches):
            _, hashed, which = _pairs(lang, ids, words, _usable(lang, ids, words, frequent))
            if len(hashed):
                yield pa.RecordBatch.from_arrays([pa.array(hashed), pa.array(np.bincount(which))], ["pair", "n"])

    counts = rows.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return _filter(counts.where(F.col("n") >= least).select(F.pmod("pair", F.lit(FILTER_BITS)).alias("at")))


def leaf_counts(rows: DataFrame, frequent: np.ndarray, pairs: np.ndarray, longest: int) -> DataFrame:
    """``(lang, words, n)``: suffixes of 2 to ``longest`` words, cut before the first pair that is
    not frequent, with their totals."""
    def run(batches):
        for lang, ids, words in _by_language(batches):
            at, hashed, which = _pairs(lang, ids, words, _usable(lang, ids, words, frequent))
            linked = np.zeros(len(ids) + longest, bool)  # to the next word, by a frequent pair
            linked[at] = _let_through(pairs, hashed)[which]
            start = np.flatnonzero(linked)
            # A suffix as a row of word numbers; 0 stands behind its end.
            more = np.ones(len(start), bool)
            columns = [ids[start]]
            for k in range(1, longest):
                more = more & linked[start + k - 1]
                columns.append(np.where(more, ids[np.minimum(start + k, len(ids) - 1)], 0))
            rank, counts = _distinct(columns)
            names = [b" ".join([words[i] for i in row if i]) + b" " for row in zip(*(c[rank].tolist() for c in columns), strict=True)]
            if names:
                yield _counted([lang] * len(names), names, counts)

    return _added(rows.mapInArrow(run, COUNTED))


def _distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each distinct one, and how often it occurs."""
    rank = columns[0].astype(np.int64)
    first, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for column in columns[1:]:  # exact: each step numbers the distinct beginnings of one word more
        _, first, rank, counts = np.unique(rank << 32 | column, return_index=True, return_inverse=True, return_counts=True)
    return first, counts


def prefix(words: Column, length: int) -> Column:
    """The first words, the blank behind them included."""
    return F.concat(F.substring_index(words, " ", length), F.lit(" "))


def n_words(words: Column) -> Column:
    return F.char_length(words) - F.char_length(F.replace(words, F.lit(" "), F.lit("")))


def grouped(leaves: DataFrame, budget: int, longest: int) -> DataFrame:
    """The leaves with ``cut``, the length of the prefix they are filed under, and ``part``, a group.

    Prefixes begin with two words. One with more than ``budget`` leaves is made a word longer; these
    are at most a ``budget``-th of the leaves, and so are broadcast. Prefixes are dealt to
    groups by hash, twice as many as budgets are needed.
    """
    spark = leaves.sparkSession
    filed, size = leaves.withColumn("cut", F.lit(2)), leaves.count()
    for cut in range(2, longest):
        here = prefix(F.col("words"), cut).alias("_prefix")
        heavy = filed.where(F.col("cut") == cut).groupBy("lang", here).agg(F.count("*").alias("_n"))
        heavy = cut_lineage(heavy.where(F.col("_n") > budget).select(F.col("lang").alias("_lang"), "_prefix"))
        if not heavy.count():
            break
        same = (F.col("lang") == F.col("_lang")) & (prefix(F.col("words"), cut) == F.col("_prefix")) & (F.col("cut") == cut)
        longer = F.when(F.col("_prefix").isNotNull(), F.col("cut") + 1).otherwise(F.col("cut"))
        filed = filed.join(F.broadcast(heavy), same, "left").withColumn("cut", longer).select("lang", "words", "n", "cut")
    groups = 2 * max(1, -(-size // budget))
    filed = filed.withColumn("_length", F.least(F.col("cut"), n_words(F.col("words"))))
    filed_under = F.expr("substring_index(words, ' ', _length)")
    part = F.pmod(F.xxhash64("lang", filed_under), F.lit(groups)).cast("int")
    wide = max(groups, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return filed.withColumn("part", part).repartition(wide, "part").sortWithinPartitions("lang", "words")


def walk(rows, least: int) -> Iterator[tuple[str, str, int]]:
    """``(lang, words, total)`` of the nodes of two and more words, from sorted ``(lang, words, n, cut)``.

    Nodes of the current path wait on a stack; a node is closed when a leaf outside it comes, and its
    total goes to the node above. A node no shorter than its cut lies in this group alone, so
    rare ones go; the totals of shorter ones are parts, and all are passed on.
    """
    path: list[str] = []
    totals: list[int] = []
    lang, cut = None, 0

    def close(depth):
        while len(path) > depth:
            total = totals.pop()
            if len(path) >= 2 and (total >= least or len(path) < cut):
                yield lang, " ".join(path) + " ", total
            path.pop()
            if totals:
                totals[-1] += total

    for new_lang, words, n, new_cut in rows:
        parts = words[:-1].split(" ")
        common = 0
        if new_lang == lang:
            while common < len(path) and common < len(parts) and path[common] == parts[common]:
                common += 1
        yield from close(common)
        lang, cut = new_lang, new_cut
        path.extend(parts[common:])
        totals.extend([0] * (len(parts) - common))
        totals[-1] += n
    yield from close(0)


def subtree_counts(leaves: DataFrame, least: int, budget: int, longest: int) -> DataFrame:
    """``(lang, words, n)`` of the phrases of two and more words that occur ``least`` times."""

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)

        some = []
        for node in walk(rows(), least):
            some.append(node)
            if len(some) == 10_000:
                yield packed(some)
                some = []
        if some:
            yield packed(some)

    def packed(nodes):
        langs, words, totals = zip(*nodes, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(langs), pa.array(words), pa.array(totals, pa.int64())], ["lang", "words", "n"])

    filed = grouped(leaves, budget, longest).select("lang", "words", "n", "cut")
    return _added(filed.mapInArrow(run, COUNTED)).where(F.col("n") >= least)


def phrase_counts(
    docs: DataFrame, lang_col: str, text_col: str, least: int, budget: int, longest: int
) -> tuple[DataFrame, DataFrame]:
    """``(lang, words, n)`` of all words and phrases that occur ``least`` times, and ``(lang, n)``,
    the number of all words."""
    small_batches(docs.sparkSession)
    lang = F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("_lang")
    rows = docs.where(docs[text_col].isNotNull()).select(lang, docs[text_col].cast("string").cast("binary").alias("_text"))
    words = cut_lineage(word_counts(rows))
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    single = words.where(F.col("n") >= least)
    frequent = frequent_words(single)
    pairs = frequent_pairs(rows, frequent, least)
    leaves = cut_lineage(leaf_counts(rows, frequent, pairs, longest))
    return cut_lineage(single.union(subtree_counts(leaves, least, budget, longest))), sizes


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    covered_percent: int = 100,
    budget: int = 500_000,
) -> DataFrame:
    """Per language the ``top`` phrases by score: ``lang, rank, phrase, a, l, r, n, score``.

    A to Z are lower-cased; texts are split at ``.,;:!?`` and line ends into pieces and those at blanks
    and tabs into words. A phrase has 2 to ``longest`` words of one piece and occurs ``a >= least``
    times. Cut in two it scores ``floor(1000 * a * n / (l * r))`` with the counts of its parts and of
    all words; the lowest-scoring cut counts, of equals the one with the shortest first part. Phrases
    inside a longer one with ``100 * f(longer) >= covered_percent * a`` go. Order: score and ``a`` falling,
    phrase by UTF-8 bytes. A null language is ``und``; null and empty texts have no words; ids are not
    looked at, so repeated rows count each; an empty table gives none.
    """
    counts, sizes = phrase_counts(docs, lang_col, text_col, least, budget, longest)
    return ranked(counts, sizes, top, covered_percent)


def ranked(counts: DataFrame, sizes: DataFrame, top: int, covered_percent: int = 100) -> DataFrame:
    """Scores and ranks of the phrases in ``counts (lang, words, n)``, as ``collocations`` states."""
    plain = counts.select("lang", F.expr("substr(words, 1, length(words) - 1)").alias("phrase"), F.col("n").alias("f"))
    candidates = plain.withColumn("size", F.size(F.split("phrase", " "))).where(F.col("size") >= 2)
    # Whoever lies in a longer phrase lies in one that is a word longer and no rarer than that.
    inner = F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))
    covers = candidates.where(F.col("size") > 2).select("lang", F.explode(inner).alias("phrase"), "f")
    covers = covers.groupBy("lang", "phrase").agg(F.max("f").alias("_longer"))
    open_ = (F.col("_longer") * 100 >= F.col("f") * covered_percent).eqNullSafe(F.lit(True))
    kept = candidates.join(covers, ["lang", "phrase"], "left").where(~open_)
    cuts = kept.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).select(
        "lang",
        "phrase",
        F.col("f").alias("a"),
        "k",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("rest"),
    )
    part = lambda name, n: plain.select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    both = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(sizes, "lang")
    score = F.expr("(cast(a as decimal(18, 0)) * 1000 * cast(n as decimal(18, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")
    best = both.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("_b"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    flat = best.select("lang", "phrase", "_b.*").withColumn("rank", F.row_number().over(order).cast("long"))
    return flat.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
