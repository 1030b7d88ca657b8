"""Benchmark decontamination with SimHash over item-sized windows.

A window is as long as an item. One that is 0.8 similar to it holds most of its shingles, in any order, so windows are
laid at all starts where enough of a document's shingles belong to items of that length; no other window can be that
similar. A window's SimHash weighs every shingle by its number of occurrences. Fingerprints are looked up among items of
the window's length by a multi-index of ``BLOCKS`` blocks of 12 or 13 bits: of two fingerprints within ``RADIUS`` differing
bits, one block differs in at most ``NEAR`` bits. Items enter the index with all values that close to their own, so the equi-join
on blocks returns all fingerprints within the radius, and about one in four of other ones by chance. An exact
weighted-shingle similarity (sum of the smaller counts over sum of the larger ones) then verifies the candidates. All
steps are DataFrame operations.

At similarity 0.8 an angle between shingle vectors of 27 degrees makes each of 64 bits differ with probability 0.15, so
19 differing bits are exceeded about once in 1,000 windows at the threshold itself, and far more rarely above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import staged

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, NEAR = 5, 3
RADIUS = BLOCKS * (NEAR + 1) - 1
BROADCAST_ROWS = 1_000_000
PIECE = 64  # starts of windows that are cut from one run of words


def _small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A staged table, broadcast if its counted rows (of a few numbers each) are within the bound."""
    return F.broadcast(df) if df.count() <= most else df


def word_hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", -1)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def shingles(hashes: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order, repeats included."""
    n = F.greatest(F.size(hashes) - (size - 1), F.lit(0))
    return F.transform(F.slice(hashes, F.lit(1), n), lambda x, i: F.xxhash64(x, *[F.get(hashes, i + j) for j in range(1, size)]))


def fingerprint(shingle_column: str) -> Column:
    """64-bit SimHash of an array column of hashes: a bit is 1 if set in over half of them."""
    return F.expr(
        f"""aggregate(
              transform(sequence(0, 63), b -> aggregate({shingle_column}, 0, (n, s) -> n + cast(shiftrightunsigned(s, b) & 1L AS INT))),
              named_struct('b', 0, 'f', 0L),
              (a, n) -> named_struct('b', a.b + 1, 'f', a.f | CASE WHEN 2 * n > size({shingle_column}) THEN shiftleft(1L, a.b) ELSE 0L END),
              a -> a.f)"""
    )


def _blocks(print_: Column, near: int = 0) -> Column:
    """The values of all blocks, each with its number above 16 bits; and those that differ from them in up to ``near`` bits."""
    edges = [64 * i // BLOCKS for i in range(BLOCKS + 1)]

    def values(i):
        most = (1 << (edges[i + 1] - edges[i])) - 1
        value = F.shiftrightunsigned(print_, edges[i]).bitwiseAND(most).cast("int")
        masks = F.filter(F.sequence(F.lit(0), F.lit(most)), lambda m: F.bit_count(m) <= near) if near else F.array(F.lit(0))
        return F.transform(masks, lambda m: value.bitwiseXOR(m) + (i << 16))

    return F.explode(F.flatten(F.array(*[values(i) for i in range(BLOCKS)])))


def _starts(similarity: float) -> Column:
    """All starts whose windows hold enough positions of the sorted array ``hits`` for the similarity.

    Two bags of m and m' shingles are s similar only if they share s / (1 + s) * (m + m'). Windows whose first hit is
    number i start after the hit before it, and late enough to reach the last hit that they need.
    """
    need = f"cast(greatest(ceil({similarity / (1 + similarity)!r}D * (least(n, n_words) + n_words - 2 * k + 2) - 1e-6D), 1) as int)"
    return F.expr(
        f"""flatten(transform(
              filter(transform(CASE WHEN size(hits) >= {need} THEN sequence(0, size(hits) - {need}) ELSE cast(array() AS array<int>) END,
                               i -> struct(greatest(hits[i + {need} - 1] - (n_words - k), CASE WHEN i > 0 THEN hits[i - 1] + 1 ELSE 0 END, 0) AS lo,
                                           least(hits[i], greatest(n - n_words, 0)) AS hi)),
                     x -> x.lo <= x.hi),
              x -> sequence(x.lo, x.hi)))"""
    )


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity): the best window of each document for each item it leaks.

    Texts are lower-cased and cut into words at blanks; start counts words from 0. Items of fewer than five words
    have one shingle, the whole of them; items without words or with a null id never match. Null document ids and
    texts match nothing. Repeated rows of a document give one result. Of equally similar windows the one with the smallest start is told, then the
    shortest. Other columns are ignored. Texts of any length are
    searched whole; without documents or items there are no leaks.
    """
    hashed = benchmark.where("item_id is not null").select("item_id", word_hashes(F.col("text")).alias("h")).where(F.size("h") > 0).distinct()
    items = None
    for size in range(1, SHINGLE + 1):
        own = hashed.where(F.size("h") >= SHINGLE if size == SHINGLE else F.size("h") == size)
        own = own.select("item_id", F.size("h").alias("n_words"), F.lit(size).alias("k"), shingles(F.col("h"), size).alias("s"))
        items = own if items is None else items.unionByName(own)
    items = staged(items, "benchmark-items")
    wanted = staged(items.select("n_words", "k", F.explode("s").alias("s")).distinct(), "benchmark-shingles")
    sizes = sorted(r.k for r in wanted.select("k").distinct().collect())  # at most five
    texts = docs.where("doc_id is not null").select("doc_id", word_hashes(F.col("text")).alias("h"))
    spots = None
    for size in sizes:
        runs = texts.select("doc_id", F.size("h").alias("n"), F.posexplode(shingles(F.col("h"), size)).alias("p", "s"))
        met = runs.join(_small(wanted.where(F.col("k") == size).drop("k")), "s")
        met = met.groupBy("doc_id", "n", "n_words").agg(F.sort_array(F.collect_set("p")).alias("hits")).withColumn("k", F.lit(size))
        spots = met if spots is None else spots.unionByName(met)
    empty = "doc_id long, item_id long, start int, n_words int, similarity double"
    if spots is None:
        return docs.sparkSession.createDataFrame([], empty)
    spots = staged(spots, "shared-shingles")  # written, so that no lambda sorts the hits again
    spots = staged(spots.select("doc_id", "k", "n_words", F.explode(_starts(similarity)).alias("start")).distinct(), "window-places")
    pieces = spots.groupBy("doc_id", "k", "n_words", (F.col("start") - F.col("start") % PIECE).alias("base")).agg(F.collect_list("start").alias("starts"))
    places = staged(pieces.groupBy("doc_id").agg(F.collect_list(F.struct("k", "n_words", "base", "starts")).alias("w")), "windows-of-documents")
    # every start is a row of ``spots``, so the bound on these holds for the arrays, too
    joined = texts.join(F.broadcast(places) if spots.count() <= BROADCAST_ROWS // 2 else places, "doc_id")
    pieces = joined.select("doc_id", "h", F.explode("w").alias("w")).select("doc_id", "w.*", F.slice("h", F.col("w.base") + 1, F.col("w.n_words") + PIECE - 1).alias("h"))
    pieces = staged(pieces, "passages")
    cut = None
    for size in sizes:
        own = pieces.where(F.col("k") == size).select("doc_id", "k", "n_words", "base", shingles(F.col("h"), size).alias("all"), F.explode("starts").alias("start"))
        own = own.select("doc_id", "k", "n_words", "start", F.slice("all", F.col("start") - F.col("base") + 1, F.col("n_words") - (size - 1)).alias("s"))
        cut = own if cut is None else cut.unionByName(own)
    windows = staged(cut.withColumn("fp", fingerprint("s")), "windows")
    prints = items.withColumn("fp", fingerprint("s"))
    near = (
        windows.select("doc_id", "n_words", "start", "fp", _blocks(F.col("fp")).alias("block"))
        .join(prints.select("item_id", "n_words", F.col("fp").alias("item_fp"), _blocks(F.col("fp"), NEAR).alias("block")), ["n_words", "block"])
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
        .select("doc_id", "n_words", "start", "item_id")
        .distinct()
    )
    near = staged(near, "candidates")
    counts = windows.select("doc_id", "n_words", "start", F.size("s").alias("n"), F.explode("s").alias("s"))
    counts = counts.groupBy("doc_id", "n_words", "start", "n", "s").agg(F.count("*").alias("c"))
    item_counts = items.select("item_id", F.size("s").alias("item_n"), F.explode("s").alias("s")).groupBy("item_id", "item_n", "s").agg(F.count("*").alias("item_c"))
    shared = near.join(counts, ["doc_id", "n_words", "start"]).join(item_counts, ["item_id", "s"])
    shared = shared.groupBy("doc_id", "item_id", "start", "n_words", "n", "item_n").agg(F.sum(F.least("c", "item_c")).alias("both"))
    scored = shared.withColumn("similarity", F.col("both") / (F.col("n") + F.col("item_n") - F.col("both"))).where(F.col("similarity") >= similarity)
    best = F.max_by(F.struct("start", "n_words", "similarity"), F.struct("similarity", -F.col("start"), -F.col("n_words")))
    return scored.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.start", "b.n_words", F.round("b.similarity", 6).alias("similarity"))
