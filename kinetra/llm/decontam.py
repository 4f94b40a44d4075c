"""Benchmark decontamination, with DataFrame functions only.

Texts become lower-case words (runs of letters and digits) and word shingles,
each a 64-bit hash.  A benchmark item of ``n`` words is compared with windows
of ``n`` words:

1. Windows.  A window as similar as asked holds at least
   ``t (a + b) / (1 + t)`` shingles of the item (``a``, ``b``: shingles of
   window and item), and the best one can be moved so that it begins with such
   a shingle or ends the text.  So windows start where a text shares a
   shingle with an item of that size and enough others follow; this drops no
   window that could pass.
2. SimHash of each distinct window and of each item, shingles weighted by how
   often they occur.
3. Multi-index: fingerprints within ``radius`` bits agree in one of ``blocks``
   blocks up to ``radius // blocks`` bits.  Items are entered under every such
   variant of each block; windows look up their blocks among items of their
   size.  All pairs within the radius are found, and only those are kept.
4. Exact weighted Jaccard similarity of the shingles, ``sum min / sum max``.

The benchmark's shingles are written first and joined as a table, so Spark
broadcasts them only if the written size is below its threshold and shuffles
otherwise.

An item of fewer words than a shingle is one shingle of all its words; texts are
hashed by that count of words as well, and a window holds it or does not.

Defined cases: null and empty texts, and items without words, match nothing;
letters of scripts without spaces are words of their own; repeated rows are matched each and give equal rows once; extra columns
are ignored; empty tables give no rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetra.session import materialize

SHINGLE, SIMILARITY = 5, 0.8
BITS, BLOCKS, RADIUS = 64, 8, 15

WORD_GAP = r"[^\p{L}\p{N}]+"
#: Letters of scripts without spaces (Thai, Lao, Tibetan, Burmese, Khmer, kana,
#: Han); the first range is there to pass over all others quickly.
UNSPACED = (r"[\x{0E00}-\x{3FFFF}&&[\x{0E00}-\x{109F}\x{1780}-\x{17FF}\x{3005}-\x{3007}"
            r"\x{3040}-\x{30FF}\x{31F0}-\x{31FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}"
            r"\x{FF66}-\x{FF9D}\x{20000}-\x{3FFFF}]]")


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; a letter of a script without
    spaces is a word of its own."""
    apart = F.regexp_replace(F.lower(text), UNSPACED, " $0 ")
    return F.array_remove(F.split(apart, WORD_GAP), "")


def hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """Hash of each shingle of the text's words; one of all words if there are
    fewer.  The words are bound to a lambda variable, so that no optimiser
    rule can copy the splitting into the loop over the shingles."""
    def of(w: Column) -> Column:
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(
            F.size(w) < shingle, F.array(F.xxhash64(w))).otherwise(_grams(w, shingle))

    return F.transform(F.array(words(text)), of)[0]


def _grams(w: Column, n: int) -> Column:
    """Hash of each ``n`` words in a row, of an array of so many words at least."""
    return F.transform(F.sequence(F.lit(0), F.size(w) - n),
                       lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))


def _short_leaks(docs: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    """Leaks of items of fewer words than a shingle (item, size, h: the one
    hash of all their words): windows of that size are such a hash as well, so
    they are as similar if equal and not at all otherwise."""
    def windows(w: Column, n: int) -> Column:
        each = F.transform(_grams(w, n), lambda h, i: F.struct(
            F.lit(n).alias("size"), i.alias("start"), h.alias("h")))
        return F.when(F.size(w) >= n, each).otherwise(F.array())

    def of(w: Column) -> Column:
        return F.concat(*[windows(w, n) for n in sizes])

    grams = docs.select(F.col("doc_id").alias("key"), F.xxhash64("text").alias("tid"), F.explode_outer(
        F.transform(F.array(words(F.col("text").cast("string"))), of)[0]).alias("g"))
    return grams.select("key", "tid", "g.size", "g.start", "g.h").join(
        items.select("item", "size", F.col("h")[0].alias("h")), ["size", "h"]).select(
        F.col("key").alias("doc_id"), "tid", F.col("item").alias("item_id"),
        F.col("start").cast("long").alias("start_word"), F.col("size").cast("long").alias("n_words"),
        F.lit(0).alias("distance"), F.lit(1.0).alias("similarity"))


def _n_words(h: Column, shingle: int = SHINGLE) -> Column:
    """Words of a text of as many as ``shingle`` words; of shorter ones it is
    their one shingle that counts."""
    return F.when(F.size(h) == 0, 0).otherwise(F.size(h) + shingle - 1)


def _shingled(rows: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """key, tid (hash of the text: rows may repeat a key), h hashes."""
    return rows.select(F.col(key).alias("key"), F.xxhash64(text).alias("tid"),
                       hashes(F.col(text).cast("string"), shingle).alias("h"))


def simhash(h: Column) -> Column:
    """SimHash of an array of hashes; a shingle weighs as often as it occurs."""
    def voted(x: Column, b: Column) -> Column:
        return F.call_function("shiftrightunsigned", x, b).bitwiseAND(F.lit(1).cast("long")) == 1

    def add(fp: Column, b: Column) -> Column:
        yes = F.size(F.filter(h, lambda x: voted(x, b)))
        return fp.bitwiseOR(F.when(yes * 2 > F.size(h), F.call_function(
            "shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), add)


def _blocks(fp: Column, blocks: int) -> list[Column]:
    width = BITS // blocks
    return [F.shiftrightunsigned(fp, width * b).bitwiseAND(F.lit((1 << width) - 1))
            for b in range(blocks)]


def variants(items: DataFrame, blocks: int, radius: int) -> DataFrame:
    """Every item under all values of its blocks within ``radius // blocks`` bits."""
    width = BITS // blocks
    masks = [sum(1 << b for b in flips) for k in range(radius // blocks + 1)
             for flips in combinations(range(width), k)]
    entry = F.explode(F.array(*[F.struct(F.lit(b).alias("block"), v.alias("value"))
                                for b, v in enumerate(_blocks(F.col("fp"), blocks))]))
    flip = F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))
    return items.withColumn("e", entry).withColumn("m", flip).select(
        "item", "size", "fp", "e.block", F.col("e.value").bitwiseXOR(F.col("m")).alias("value"))


def _required(a: Column, b: Column, t: float) -> Column:
    """Least number of common shingles of sets of ``a`` and ``b`` at similarity ``t``."""
    return F.ceil((a + b) * F.lit(t / (1 + t)) - F.lit(1e-9)).cast("int")


def find_leaks(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE,
               similarity: float = SIMILARITY, radius: int = RADIUS,
               blocks: int = BLOCKS) -> DataFrame:
    """One row per document, item and window of the document that is as
    similar: doc_id, item_id, start_word, n_words, distance, similarity."""
    return _leaks(docs, benchmark, shingle, similarity, radius, blocks).drop("tid").distinct()


def _leaks(docs: DataFrame, benchmark: DataFrame, shingle: int, similarity: float,
           radius: int, blocks: int) -> DataFrame:
    """The rows of ``find_leaks`` with tid, the hash of the document's text."""
    words_of = words(F.col("text").cast("string"))
    items = materialize(benchmark.select(
        F.col("item_id").alias("item"), F.xxhash64("text").alias("tid"),
        hashes(F.col("text").cast("string"), shingle).alias("h"), F.size(words_of).alias("size")).distinct(),
        "items").filter("size > 0")
    short = items.filter(F.col("size") < shingle)
    sizes = sorted(r[0] for r in short.select("size").distinct().collect())  # fewer than ``shingle``
    items = items.filter(F.col("size") >= shingle)
    counted = items.select("item", "tid", "size", F.explode("h").alias("h")).groupBy(
        "item", "tid", "size", "h").agg(F.count(F.lit(1)).alias("weight"))
    counted = materialize(counted, "item-shingles")

    # 1. windows that hold enough shingles of an item
    shared = materialize(counted.select("h", "item", "tid", "size").withColumnRenamed("tid", "itid"),
                         "shared")
    texts = _shingled(docs.select("doc_id", "text"), "doc_id", "text", shingle)
    # outer: a plain explode would add a filter that computes the hashes twice
    hits = texts.select("key", "tid", _n_words(F.col("h"), shingle).alias("n"),
                        F.posexplode_outer("h").alias("at", "h")).join(shared, "h")
    found = hits.groupBy("key", "tid", "n", "item", "itid", "size").agg(
        F.array_sort(F.collect_set("at")).alias("at"))  # places within one text
    span = F.greatest(F.least("size", "n") - (shingle - 1), F.lit(1))   # shingles of the window
    of_item = F.greatest(F.col("size") - (shingle - 1), F.lit(1))
    found = found.withColumn("span", span).withColumn(
        "least", _required(F.col("span"), of_item, similarity)).filter("size(at) >= least").withColumn(
        "last", F.greatest(F.col("n") - F.col("size"), F.lit(0)))
    begins = F.filter(F.transform("at", lambda p, i: F.when(
        (p <= F.col("last")) & (F.get("at", i + F.col("least") - 1) < p + F.col("span")), p)),
        lambda p: p.isNotNull())
    ends = F.when(F.get("at", F.size("at") - F.col("least")) >= F.col("last"),
                  F.array("last")).otherwise(F.array().cast("array<int>"))
    starts = materialize(found.select("key", "tid", "size", "span", F.explode(
        F.array_union(begins, ends)).alias("start")).distinct(), "windows")
    wanted = materialize(starts.groupBy("key", "tid").agg(F.collect_set(
        F.struct("size", "span", "start")).alias("windows")), "texts-with-windows")
    again = _shingled(docs.select("doc_id", "text").join(
        wanted.select("key", "tid").withColumnRenamed("tid", "t"),
        F.col("doc_id").eqNullSafe(F.col("key")) & (F.xxhash64("text") == F.col("t")), "left_semi"),
        "doc_id", "text", shingle).dropDuplicates(["key", "tid"])
    windows = again.join(wanted.withColumnRenamed("key", "k").withColumnRenamed("tid", "t"),
                         F.col("key").eqNullSafe(F.col("k")) & (F.col("tid") == F.col("t"))).select(
        "key", "tid", "h", F.explode("windows").alias("w")).select(
        "key", "tid", "w.size", "w.start",
        F.slice("h", F.col("w.start") + 1, F.col("w.span")).alias("h"))
    # equal windows of many texts are compared once
    windows = materialize(windows.withColumn("wid", F.sha2(F.concat_ws(
        ",", F.col("size").cast("string"), F.col("h").cast("array<string>")), 256)), "window-hashes")
    distinct = materialize(windows.groupBy("wid", "size").agg(F.first("h").alias("h")), "distinct-windows")
    wcounted = materialize(distinct.select("wid", F.explode("h").alias("h")).groupBy(
        "wid", "h").agg(F.count(F.lit(1)).alias("weight")), "window-shingles")

    # 2. fingerprints, 3. multi-index
    item_fp = materialize(items.select(F.struct("item", "tid").alias("item"), "size",
                                       simhash(F.col("h")).alias("fp")), "item-fingerprints")
    index = materialize(variants(item_fp, blocks, radius), "index")
    window_fp = materialize(distinct.select("wid", "size", simhash(F.col("h")).alias("fp")),
                            "window-fingerprints")
    probe = window_fp.select("wid", "size", F.col("fp").alias("wfp"), F.explode(F.array(*[
        F.struct(F.lit(b).alias("block"), v.alias("value"))
        for b, v in enumerate(_blocks(F.col("fp"), blocks))])).alias("p")).select(
        "wid", "size", "wfp", "p.block", "p.value")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("wfp")))
    near = probe.join(index, ["size", "block", "value"]).withColumn("distance", distance).filter(
        F.col("distance") <= radius).select("wid", "item.item", "item.tid", "distance").distinct()
    near = materialize(near, "near")

    # 4. exact similarity
    totals = counted.groupBy("item", "tid").agg(F.sum("weight").alias("b"))
    wtotals = wcounted.groupBy("wid").agg(F.sum("weight").alias("a"))
    both = near.join(wcounted.select("wid", "h", F.col("weight").alias("ww")), "wid").join(
        counted.select(F.col("item").alias("i"), F.col("tid").alias("t"), "h", "weight"),
        ["h"]).filter("item <=> i AND tid = t")
    common = both.groupBy("wid", "item", "tid", "distance").agg(
        F.sum(F.least("ww", "weight")).alias("c"))
    same = common.join(totals.select(F.col("item").alias("i"), F.col("tid").alias("t"), "b"),
                       F.col("item").eqNullSafe(F.col("i")) & (F.col("tid") == F.col("t"))).join(
        wtotals, "wid").withColumn("similarity", F.col("c") / (F.col("a") + F.col("b") - F.col("c"))
                                   ).filter(F.col("similarity") >= similarity - 1e-12)
    found = windows.select("wid", "key", "tid", "start", "size").join(
        same.select("wid", "item", "distance", "similarity"), "wid").select(
        F.col("key").alias("doc_id"), "tid", F.col("item").alias("item_id"),
        F.col("start").cast("long").alias("start_word"), F.col("size").cast("long").alias("n_words"),
        F.col("distance").cast("int").alias("distance"), "similarity")
    return found.unionByName(_short_leaks(docs, short, sizes)) if sizes else found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item.  Rows of one
    doc_id are one document; rows without doc_id are told apart by their text."""
    def apart(doc_id: Column, tid: Column) -> Column:
        return F.when(doc_id.isNull(), tid).otherwise(F.lit(0).cast("long"))

    leaks = materialize(_leaks(docs, benchmark, SHINGLE, SIMILARITY, RADIUS, BLOCKS).select(
        F.col("doc_id").alias("id"), apart(F.col("doc_id"), F.col("tid")).alias("apart")).distinct(), "leaks")
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["id"]) & (
        apart(docs["doc_id"], F.xxhash64(docs["text"])) == leaks["apart"]), "left_anti")
