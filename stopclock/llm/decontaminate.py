"""Benchmark decontamination with DataFrame functions only.

A document is contaminated by an item if some window of it, as many words long as the item,
has a weighted shingle similarity of at least ``SIMILARITY`` with it: words lowered,
shingles of five words with their counts as weights, the sum of the smaller counts over the
sum of the larger ones.

Windows are built where shingles of items lie dense enough for that similarity, in whatever
order, in the lengths of the items whose rarest shingles the document has; no other window
can reach it.  Each different window gets a SimHash of its weighted shingles.  An index over
twelve blocks of the 64 bits proposes items of its length: of 22 differing bits at most one
falls into some block, so looking a block up with none or one bit changed finds every
fingerprint within that radius.  At a similarity of 0.8 about one pair in 100,000 lies beyond
it; as an item also shares one of its rarest shingles with each window that is similar
enough, those are proposed beside, and no match is lost.  What is proposed is compared exactly.
A phrase that many items share is among the rarest of none of them, so it pairs nothing.

Results in special cases: null or empty texts of documents and null or blank items match
nothing; items of fewer than five words are one shingle, compared as a whole; repeated rows
and null ids are kept row by row (``contaminated`` lists a repeated match once); equal
windows in a document count once, at the first place; empty tables give an empty result.
Columns other than ``doc_id`` and ``text`` are carried along by ``clean`` and not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopclock.llm.common import cut, split_by

SHINGLE = 5
SIMILARITY = 0.8
#: Differing bits within which the index finds every pair, and its blocks: some block has at
#: most ``RADIUS // BLOCKS`` of them, which is one.
RADIUS, BLOCKS = 22, 12


def _words(text: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t-\\r]+")
    return F.filter(parts, lambda w: w != "")


def _shingles(words: Column, size: int) -> Column:
    """Hashes of the shingles of a column that is already computed."""
    count = F.size(words) - size + 1
    hashed = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size)))
    )
    return F.when(count > 0, hashed).otherwise(F.array().cast("array<bigint>"))


def _features(hashes: Column) -> Column:
    """The shingle hashes of a computed column, each mixed with how often it has come so far.

    Sets of these compare as the counted shingles do.
    """
    numbered = F.transform(
        hashes, lambda h, i: F.xxhash64(h, F.size(F.filter(F.slice(hashes, 1, i + 1), lambda x: x == h)))
    )
    once = F.transform(hashes, lambda h: F.xxhash64(h, F.lit(1)))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), numbered).otherwise(once)


def _weighted(a: Column, b: Column) -> Column:
    """Weighted similarity of two texts by their features."""
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared)


def fingerprint(hashes: Column) -> Column:
    """SimHash of a computed column of features: bits set in more than half of them."""
    # Two bits are counted at once, in the halves of a long.
    halves = F.lit((1 << 32) + 1)
    counts = F.transform(
        F.sequence(F.lit(0), F.lit(31)),
        lambda b: F.aggregate(
            hashes,
            F.lit(0).cast("long"),
            lambda acc, h: acc + F.call_function("shiftrightunsigned", h, b).bitwiseAND(halves),
        ),
    )
    size = F.size(hashes)
    bits = F.transform(
        counts,
        lambda c, b: F.when(2 * c.bitwiseAND(F.lit((1 << 32) - 1)) > size, F.call_function("shiftleft", F.lit(1).cast("long"), b))
        .otherwise(F.lit(0).cast("long"))
        .bitwiseOR(
            F.when(2 * F.shiftrightunsigned(c, 32) > size, F.call_function("shiftleft", F.lit(1).cast("long"), b + 32))
            .otherwise(F.lit(0).cast("long"))
        ),
    )
    return F.aggregate(bits, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(x))


def _blocks(fp: Column, changed: bool) -> Column:
    """Block keys of a fingerprint; with ``changed`` those with one bit changed as well."""
    keys, low = [], 0
    for j in range(BLOCKS):
        width = 64 // BLOCKS + (j < 64 % BLOCKS)
        bits = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1)).bitwiseOR(F.lit(j << 8))
        keys += [bits, *(bits.bitwiseXOR(F.lit(1 << b)) for b in range(width) if changed)]
        low += width
    return F.array(*keys)


def within_radius(windows: DataFrame, items: DataFrame) -> DataFrame:
    """w, item: all pairs of fingerprints (n, fp) of one length that differ in ``RADIUS`` bits
    at most."""
    left = windows.select("w", "n", "fp", F.explode(_blocks(F.col("fp"), False)).alias("block"))
    right = items.select("item", "n", F.col("fp").alias("item_fp"), F.explode(_blocks(F.col("fp"), True)).alias("block"))
    met = left.join(right, ["n", "block"])
    return met.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS).select("w", "item").distinct()


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, n (words), size (of its shingles), shingles, hashes (their features), item (a
    number of the content), fp."""
    items = benchmark.select("item_id", _words(F.col("text")).alias("words"))
    items = items.withColumn("n", F.size("words")).filter("n > 0")
    sizes = [
        items.filter((F.col("n") >= k) if k == SHINGLE else (F.col("n") == k)).select(
            "item_id", "n", F.lit(k).alias("size"), _shingles(F.col("words"), k).alias("shingles")
        )
        for k in range(1, SHINGLE + 1)
    ]
    rows = reduce(DataFrame.union, sizes).withColumn("hashes", _features(F.col("shingles")))
    return rows.withColumn("item", F.xxhash64("size", "shingles")).withColumn("fp", fingerprint(F.col("hashes")))


def _rarest(items: DataFrame) -> DataFrame:
    """item, n, h (shingle), feature: of each content the features that fewest contents have,
    so many that a window of the similarity has one of them."""
    contents = items.dropDuplicates(["item"])
    each = contents.select(
        "item", "n", F.size("hashes").alias("m"), F.explode(F.arrays_zip("shingles", "hashes")).alias("s")
    ).select("item", "n", "m", F.col("s.shingles").alias("h"), F.col("s.hashes").alias("feature"))
    common = each.groupBy("feature").agg(F.count("*").alias("items"))
    order = Window.partitionBy("item").orderBy("items", "feature")
    ranked = each.join(common, "feature").withColumn("rank", F.row_number().over(order))
    most = F.col("m") - F.ceil(F.col("m") * SIMILARITY - 1e-9) + 1
    return ranked.filter(F.col("rank") <= most).select("item", "n", "h", "feature")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, start (word), n_words, similarity: the best window of each
    document for each item that reaches the similarity, the first one of equals."""
    items = cut(_items(benchmark), "items")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    rarest = cut(_rarest(items), "rarest-shingles")
    found = [
        _of_size(texts, items.filter(F.col("size") == k), rarest.filter(F.least("n", F.lit(SHINGLE)) == k), k)
        for (k,) in items.select("size").distinct().collect()
    ]
    if not found:
        found = [_of_size(texts.limit(0), items, rarest, SHINGLE)]
    return reduce(DataFrame.union, found)


def _of_size(texts: DataFrame, items: DataFrame, rarest: DataFrame, size: int) -> DataFrame:
    key = ["doc_id", "text_hash"]
    worded = texts.select(*key, _words(F.col("text")).alias("words"))
    hashed = worded.select(*key, F.size("words").alias("words_n"), _shingles(F.col("words"), size).alias("all"))
    known = items.select(F.explode("shingles").alias("h")).distinct()
    lengths = rarest.groupBy("h").agg(F.collect_set("n").alias("lengths"))
    known = known.join(lengths, "h", "left").select("h", F.coalesce("lengths", F.array().cast("array<int>")).alias("lengths"))
    # The outer form: for the inner one Spark adds a filter that it pushes below the arrays,
    # which would cut the text anew for every shingle.
    seeds = (
        hashed.select(*key, "words_n", F.posexplode_outer("all").alias("at", "h"))
        .join(known, "h")
        .groupBy(*key)
        .agg(
            F.max("words_n").alias("words_n"),
            F.sort_array(F.collect_set("at")).alias("at"),
            F.array_distinct(F.flatten(F.collect_set("lengths"))).alias("lengths"),
        )
        .select(*key, "words_n", "at", F.explode("lengths").alias("n"))
    )
    # A window of ``held`` shingles and an item of ``shingle_n`` share ``need`` at the least
    # similarity.  Wherever so many places fit into a window, all starts that cover them count.
    shingle_n = F.col("n") - (size - 1)
    held = F.least(F.col("n"), F.col("words_n")) - (size - 1)
    need = F.ceil((shingle_n + F.col("held")) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9).cast("int")
    seeds = seeds.withColumn("held", held).withColumn("need", need).filter(F.size("at") >= F.col("need"))
    last = F.transform(
        F.slice("at", F.col("need"), F.size("at")), lambda x, i: F.struct(F.get("at", i).alias("a"), x.alias("b"))
    )
    dense = F.filter(last, lambda p: p["b"] - p["a"] < F.col("held"))
    top = F.col("words_n") - (size - 1) - F.col("held")
    starts = F.transform(
        dense, lambda p: F.sequence(F.greatest(F.lit(0), p["b"] - F.col("held") + 1), F.least(p["a"], top))
    )
    places = (
        seeds.select(*key, "n", F.array_distinct(F.flatten(starts)).alias("starts"))
        .filter(F.size("starts") > 0)
        .groupBy(*key)
        .agg(F.collect_set(F.struct("n", "starts")).alias("places"))
    )
    places = cut(places, "window-places")
    # Few texts have windows; the others are not shuffled, and no text is cut into words
    # before it is known to be one of the few.
    maybe, _ = split_by(texts, F.col("text_hash"), places, F.col("text_hash"))
    same = maybe["doc_id"].eqNullSafe(places["doc_id"]) & (maybe["text_hash"] == places["text_hash"])
    few = maybe.join(places, same).select(maybe["doc_id"], maybe["text_hash"], "text", "places").dropDuplicates(key)
    few = few.select(*key, "places", _words(F.col("text")).alias("words"))
    windows = (
        few.select(*key, "places", _shingles(F.col("words"), size).alias("all"))
        .select(*key, "all", F.explode("places").alias("place"))
        .select(*key, "all", "place.n", F.explode("place.starts").alias("start"))
        .select(*key, "n", "start", F.slice("all", F.col("start") + 1, F.col("n") - (size - 1)).alias("hashes"))
    )
    windows = windows.withColumn("w", F.xxhash64("n", "hashes")).withColumn("hashes", _features(F.col("hashes")))
    windows = cut(windows, "windows")
    # The same window stands in many documents: it is fingerprinted and compared once.
    distinct = windows.dropDuplicates(["w"]).select("w", "n", "hashes")
    distinct = cut(distinct.withColumn("fp", fingerprint(F.col("hashes"))), "window-fingerprints")
    contents = items.dropDuplicates(["item"]).select("item", "n", "fp", F.col("hashes").alias("item_hashes"))
    shared = distinct.select("w", "n", F.explode("hashes").alias("feature")).join(rarest, ["n", "feature"])
    proposed = within_radius(distinct, contents).union(shared.select("w", "item")).distinct()
    good = (
        proposed.join(distinct.select("w", "hashes"), "w")
        .join(contents.select("item", "item_hashes"), "item")
        .select("w", "item", _weighted(F.col("hashes"), F.col("item_hashes")).alias("similarity"))
        .filter(F.col("similarity") >= SIMILARITY)
    )
    return (
        windows.select(*key, "w", "n", "start")
        .join(good, "w")
        .join(items.select("item", "item_id").distinct(), "item")
        .groupBy(*key, "item_id", F.col("n").alias("n_words"))
        .agg(
            F.max(F.struct("similarity", (-F.col("start")).alias("before"))).alias("best"),
        )
        .select(*key, "item_id", (-F.col("best.before")).alias("start"), "n_words", "best.similarity")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs``, all columns, without the contaminated rows."""
    bad = contaminated(docs.select("doc_id", "text"), benchmark)
    bad = cut(bad.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "leaks")
    own = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    maybe, rest = split_by(docs, own, bad, F.col("__hash"))
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (own == F.col("__hash"))
    return rest.union(maybe.join(bad, same, "left_anti"))
