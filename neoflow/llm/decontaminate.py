"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every WINDOW consecutive words (13) the least hash of a GRAM-word gram among
the WINDOW - GRAM + 1 grams inside is kept, on both sides; equal spans of 13
words so share a kept gram, wherever they lie. Fingerprints of documents and
benchmark are joined, and the hits extended word by word to both sides: a hit
counts if at least 13 words agree. Items of fewer words are looked up whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neoflow.llm.rows import select_rows
from neoflow.session import shared_dir

WINDOW, GRAM = 13, 6
#: Benchmark fingerprints (16 bytes each) up to which they are broadcast; beyond it Spark joins by a shuffle.
BROADCAST_FINGERPRINTS = 1_000_000
#: Matched (document, fingerprint) rows up to which they are broadcast for the second look.
BROADCAST_MATCHES = 500_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; null counts as empty. (``lower`` is the faster
    way for texts that are all ASCII.)"""
    text = F.coalesce(text, F.lit(""))
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, _UPPER, _LOWER)))


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), _NO_WORD), "")


def _indices(first: Column | int, last: Column) -> Column:
    """first..last, empty if there is none."""
    first = F.lit(first) if isinstance(first, int) else first
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def grams(w: Column, n: int) -> Column:
    """Hashes of all n-word grams, tagged by n."""
    return F.transform(_indices(1, F.size(w) - n + 1), lambda i: F.xxhash64(F.lit(n), F.slice(w, i, n)))


def winnow(g: Column) -> Column:
    """The least gram hash of each window, each once."""
    span = WINDOW - GRAM + 1
    return F.array_distinct(F.transform(_indices(1, F.size(g) - span + 1),
                                        lambda i: F.array_min(F.slice(g, i, span))))


def _around(w: Column, i: Column, n: int) -> list[Column]:
    """Up to WINDOW - 1 words before place ``i`` (0-based), nearest first, and those from ``i`` on."""
    reach = WINDOW - 1
    first = F.greatest(i - reach, F.lit(0))
    return [F.reverse(F.slice(w, first + 1, i - first)).alias("before"),
            F.slice(w, i + 1, n + reach).alias("after")]


def _agree(a: Column, b: Column) -> Column:
    """Number of leading equal elements."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    stop = F.array_position(same, False)
    return F.when(stop == 0, F.size(same)).otherwise(stop - 1).cast("int")


def _bench_prints(bench: DataFrame) -> tuple[DataFrame, list[int]]:
    """(fp, n, need, item_id, before, after) of the benchmark, and the word counts of short items (under WINDOW of them)."""
    items = (bench.select("item_id", words(F.col("text")).alias("w"))
             .filter(F.size("w") > 0).withColumn("m", F.size("w")))
    short = sorted(r["m"] for r in items.filter(F.col("m") < WINDOW).select("m").distinct().collect())
    long = (items.filter(F.col("m") >= WINDOW).withColumn("g", grams(F.col("w"), GRAM))
            .withColumn("kept", winnow(F.col("g")))
            .withColumn("i", F.explode(F.filter(_indices(0, F.size("g") - 1),
                                                lambda i: F.array_contains("kept", F.get("g", i)))))
            .select(F.get("g", "i").alias("fp"), F.lit(GRAM).alias("n"), F.lit(WINDOW).alias("need"), "item_id",
                    *_around(F.col("w"), F.col("i"), GRAM)))
    for m in short:
        long = long.union(items.filter(F.col("m") == m).select(
            F.xxhash64(F.lit(m), "w").alias("fp"), F.lit(m), F.lit(m), "item_id",
            F.array().cast("array<string>"), "w"))
    return long, short


def decontaminate(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """``docs(doc_id, text)``, ``bench(item_id, text)`` -> (doc_id, tkey, n_words, n_hit, items),
    ``tkey`` the text's xxhash64.

    One row per document row: its word count, how many of its words lie in an
    occurrence of a benchmark window, and the sorted ids of the items whose windows
    occur. Null or empty texts have no words; an empty benchmark hits nothing;
    rows that repeat a doc_id are judged each by its own text. A null item_id
    marks words but isn't listed. Other columns aren't read.
    """
    shared_dir(docs.sparkSession)  # where checkpoint() writes
    docs = docs.select("doc_id", F.xxhash64("text").alias("tkey"), "text")
    prints, short = _bench_prints(bench.select("item_id", "text"))

    distinct = prints.select("fp").distinct()
    if distinct.count() <= BROADCAST_FINGERPRINTS:
        distinct = F.broadcast(distinct)
    # w and g are columns of their own: named inside a lambda, an expression would be worked out for each element.
    lists = [winnow(F.col("g")), *(F.array_distinct(grams(F.col("w"), m)) for m in short)]
    matched = (docs.withColumn("w", words(F.col("text"))).withColumn("g", grams(F.col("w"), GRAM))
               .select("doc_id", "tkey", F.explode(F.concat(*lists) if short else lists[0]).alias("fp"))
               .join(distinct, "fp").distinct()).checkpoint()
    by_doc = matched.groupBy("doc_id", "tkey").agg(F.collect_list("fp").alias("fps"))
    if matched.count() <= BROADCAST_MATCHES:
        by_doc = F.broadcast(by_doc)

    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["tkey"] == b["tkey"])
    found = (docs.join(by_doc, same(docs, by_doc))
             .select(docs["doc_id"], docs["tkey"], words(docs["text"]).alias("w"), "fps"))
    places = None
    for n in (GRAM, *short):
        part = (found.withColumn("g", grams(F.col("w"), n))
                .withColumn("i", F.explode(F.filter(_indices(0, F.size("g") - 1),
                                                    lambda i: F.array_contains("fps", F.get("g", i)))))
                .select("doc_id", "tkey", "i", F.get("g", "i").alias("fp"),
                        *_around(F.col("w"), F.col("i"), n)))
        places = part if places is None else places.union(part)
    places = places.withColumnsRenamed({"before": "d_before", "after": "d_after"})
    left, right = _agree(F.col("d_before"), F.col("before")), _agree(F.col("d_after"), F.col("after"))
    hits = (places.join(prints, "fp")
            .withColumns({"l": left, "r": right})
            .withColumn("l", F.when(F.col("need") < WINDOW, 0).otherwise(F.col("l")))
            .filter((F.col("r") >= F.col("n")) & (F.col("l") + F.col("r") >= F.col("need")))
            .select("doc_id", "tkey", "item_id",
                    F.struct((F.col("i") - F.col("l")).alias("s"), (F.col("i") + F.col("r")).alias("e")).alias("run")))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("last"))
    covered = F.aggregate(
        F.array_sort(F.collect_set("run")), zero,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["last"]))).alias("n"),
            F.greatest(acc["last"], x["e"]).alias("last")), lambda acc: acc["n"])
    per_doc = hits.groupBy("doc_id", "tkey").agg(
        covered.alias("n_hit"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    all_docs = docs.select("doc_id", "tkey", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return (all_docs.join(per_doc, same(all_docs, per_doc), "left")
            .select(all_docs["doc_id"], all_docs["tkey"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def contaminated() -> Column:
    """At least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that aren't contaminated."""
    found = decontaminate(docs, bench).filter(contaminated())
    return select_rows(docs, found.select("doc_id", "tkey", F.lit(0).alias("keep")).distinct())
