"""Exact Jaccard join of n-gram sets, by a partitioned universe.

Sets that link differ in at most (|r| + |s|) * (1 - t) / (1 + t) tokens. The hash
universe is cut into more segments than that, so two linked sets agree in some
segment (pigeonhole). Sets are indexed by size band; a set near the lower end
of its band is looked up in the band below as well. In a segment allotted 2, a
set is also indexed under its one-deletion neighbours, which finds segments
that differ in one token and so lets one segment stand for two; a cost model
on the number of sets of each band decides how many segments are allotted 2.

A set's index entries are hashes. Owners of hash ranges get them Golomb-coded and
answer which occur twice; only those are grouped. Candidates of a segment are
chained and verified; what is still in different components is then compared
pair by pair. Odd sketches (parities of hashed tokens, whose Hamming distance
never exceeds the difference of the sets) rule pairs out without their texts;
all others are verified on the full sets.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from neoflow.llm.components import components
from neoflow.llm.golomb import Universe, answered, shuffle_width, with_bitmaps
from neoflow.llm.rows import select_rows
from neoflow.session import scratch_path

#: Ratio of the largest to the least set of a band.
BAND = 1.8
#: Bits of an odd sketch, at least; larger sets have two to four bits a token, up to MOST_SKETCH.
SKETCH, MOST_SKETCH = 1024, 1 << 17
#: Index entries that are coded together, and keys of sets a task knows that it has met.
CHUNK, LATELY = 400_000, 200_000
#: Cost model: rows a candidate pair is worth, and the chance that a set holds a given token of another one.
PAIR_COST, COMMON = 4.0, 0.02
#: Segments beyond the least number that the cost model chooses from, as shares of it.
SPARE = (0, 0.02, 0.04, 0.06, 0.08, 0.1, 0.13, 0.16, 0.2, 0.25, 0.3, 0.4, 0.5, 0.7, 1, 1.5, 2, 3, 5, 8)
_TILTS = np.geomspace(0.01, 30, 60)
#: Candidates of one segment compared at a time.
BLOCK = 2048
#: Sets of a segment that meet in one task, at most about twice as many; more are split and met block against block.
MEET = 20_000
#: Documents looked up again up to which their ids (8 bytes each) are broadcast; beyond it Spark joins by a shuffle.
BROADCAST_IDS = 500_000
#: Words whose hashes a worker keeps during a task.
CACHE_WORDS = 200_000

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_EMPTY = np.empty(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_words = _Words()


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles of a text (A-Z lowered); of fewer
    words, one of the whole sequence; none without words."""
    words = (text or b"").lower().split()
    if not words:
        return _EMPTY
    if len(_words) > CACHE_WORDS:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    k = min(n, len(h))
    total = np.full(len(h) - k + 1, np.uint64(k), np.uint64)
    for i in range(k):
        total = mix(total * _M1 + h[i:len(h) - k + 1 + i])
    return np.unique(total)


class Threshold:
    """Jaccard similarity of at least num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def linked(self, both: int, a: int, b: int) -> bool:
        return self.den * both >= self.num * (a + b - both)

    def differ(self, a, b):
        """Tokens that linked sets of these sizes can differ in, at most."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def largest(self, n: int) -> int:
        """Size of the largest set that can link with one of n tokens."""
        return n * self.den // self.num


@lru_cache(maxsize=None)
def band_end(band: int) -> int:
    """Largest size in a band; bands 0 and 1 hold sizes 1 and 2."""
    return 1 if band == 0 else max(band_end(band - 1) + 1, math.floor(band_end(band - 1) * BAND))


def band_of(n: int) -> int:
    b = 0
    while band_end(b) < n:
        b += 1
    return b


def thin_share(n: int, m: int, two: int, errors: int) -> float:
    """At most the share of sets of ``n`` tokens that hold no more than ``errors`` in ``m`` segments,
    the first ``two`` counting up to 2: Chernoff's bound, whose factors the segments' counts stay under."""
    none = (1 - 1 / m) ** n
    one = n / m * (1 - 1 / m) ** (n - 1)
    e = np.exp(-_TILTS)
    with np.errstate(divide="ignore"):
        log = ((m - two) * np.log(none + (1 - none) * e) if m > two else 0.0) + (
            two * np.log(none + one * e + max(0.0, 1 - none - one) * e * e))
    return float(np.exp(np.minimum(0.0, log + _TILTS * errors).min()))


def allocate(band: int, threshold: Threshold, sets: int) -> tuple[int, int]:
    """(segments, how many of them are allotted 2) of a band: the least of index rows plus expected
    candidate pairs, those of sets that hold too few segments included. Allotments add up to more
    than the tokens that linked sets differ in; segments beyond that make up for empty ones."""
    least, end = (band_end(band - 1) + 1 if band else 1), band_end(band)
    sizes = sorted({least, (least + end) // 2, end})
    allowed = [int(threshold.differ(n, threshold.largest(n))) for n in sizes]
    errors = int(threshold.differ(end, threshold.largest(end)))
    best = None
    for two in sorted({*range(0, min(16, (errors + 1) // 2) + 1),
                       *np.linspace(0, (errors + 1) // 2, 24).astype(int).tolist()}):
        for more in SPARE:
            m = errors + 1 - two + math.ceil(more * (errors + 1 - two))
            size = end / m
            thin = sets * max(thin_share(n, m, two, d) for n, d in zip(sizes, allowed))
            rows = sets * (min(m, end) + two * size) + thin * m
            # chance that all (in a segment allotted 2: all but one) of a segment's tokens are met in another set
            pairs = sets * sets / 2 * ((m - two) * COMMON ** size + two * (1 + size / COMMON) * COMMON ** size)
            cost = rows + PAIR_COST * (pairs + thin * thin / 2 * m)
            if best is None or cost < best[0]:
                best = (cost, m, two)
    return best[1], best[2]


class Index:
    """How sets are indexed: for each band its segments and allotments."""

    def __init__(self, counts: dict[int, int], threshold: Threshold, seed: int = 0):
        self.threshold, self.seed, self.bands = threshold, seed, {}
        self.entries = 0  # expected, at most
        for band in counts:
            for b in (band, band - 1):
                if b >= 0 and b not in self.bands:
                    sets = counts.get(b, 0) + counts.get(b + 1, 0)
                    self.bands[b] = m, two = allocate(b, threshold, sets)
                    self.entries += sets * (m + two * (band_end(b) // m + 1))

    def signatures(self, s: np.ndarray) -> np.ndarray:
        """Hashes under which a set of sorted tokens is indexed and looked up."""
        n = len(s)
        own = band_of(n)
        out = [self._of(s, own, int(self.threshold.differ(n, self.threshold.largest(n))))]
        least = -(-n * self.threshold.num // self.threshold.den)
        if own > 0 and least <= band_end(own - 1):
            out.append(self._of(s, own - 1, int(self.threshold.differ(n, band_end(own - 1)))))
        return np.concatenate(out)

    def _of(self, s: np.ndarray, band: int, errors: int) -> np.ndarray:
        m, two = self.bands[band]
        # Tokens are sorted, so a segment (a range of hashes) is a run of them.
        seg = ((s >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        token = mix(s + np.uint64(self.seed))
        first = np.flatnonzero(np.diff(seg, prepend=-1))
        size = np.diff(first, append=len(s))
        total = np.add.reduceat(token, first)
        held = seg[first]
        tag = mix(np.arange(m, dtype=np.uint64) + np.uint64(band << 32))
        out = [mix(tag[held] ^ (total * _M1))]
        paired = (held < two) & (size > 1)
        if two:
            at = np.flatnonzero(np.repeat(paired, size))
            out.append(mix(tag[seg[at]] ^ ((np.repeat(total, size)[at] - token[at]) * _M1)))
        # Sets that share none of these differ in two tokens or more of each paired segment and one of each
        # other one held: more than linked sets can, if either counts that many. Sets that don't
        # are also found by what they lack: empty segments, and such as one deletion empties.
        if len(held) + int(paired.sum()) <= errors:
            lacks = np.ones(m, bool)
            lacks[held[(held >= two) | paired]] = False
            out.append(mix(tag[lacks]))
        return np.concatenate(out)


def odd_sketch(s: np.ndarray) -> bytes:
    size = min(MOST_SKETCH, max(SKETCH, 1 << (2 * len(s)).bit_length()))
    bits = np.bincount((mix(s) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch of the same set with ``size`` 64-bit words."""
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def set_key(s: np.ndarray) -> bytes:
    """Equal for equal sets; for others with a chance of 2**-96."""
    return hashlib.blake2b(s.tobytes(), digest_size=12).digest()


def _sets(n_words: int):
    def run(batches):
        for batch in batches:
            n, key, band = [], [], []
            for t in batch.column(1):
                s = shingles(t.as_py(), n_words)
                n.append(len(s))
                key.append(set_key(s))
                band.append(band_of(len(s)) if len(s) else -1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                 pa.array(band, pa.int32())], names=["doc_id", "tkey", "n", "key", "band"])
        _words.clear()
    return run


_SIGNED = ("sid long, doc_id long, tkey long, key binary, n long, sketch binary, "
           "sender long, chunk long, owner long, blob binary, own binary")


def _signed(n_words: int, index: Index, universe: Universe):
    """Rows of two kinds: sets (each once for each task that meets it; ``sid`` numbers them) and,
    for each chunk of index entries and owner, their codes and the sets they belong to."""
    fields = pa.schema([(n, pa.binary() if kind == "binary" else pa.int64())
                        for n, kind in (x.split() for x in _SIGNED.split(", "))])

    def run(batches):
        seen: set[bytes] = set()
        sender, chunk, held, entries, owners, sets = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def flush():
            fp = np.concatenate(entries)
            own = np.repeat(np.array(owners, np.uint32), [len(e) for e in entries])
            return pa.RecordBatch.from_pylist(
                [{"sender": sender, "chunk": chunk, "owner": owner, "blob": blob, "own": own[at].tobytes()}
                 for owner, at, blob in universe.messages(fp)], schema=fields)

        for batch in batches:
            rows = []
            for doc_id, text, tkey in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                s = shingles(text.as_py(), n_words)
                if not len(s) or (key := set_key(s)) in seen:
                    continue
                rows.append({"sid": (sender << 32) + sets, "doc_id": doc_id, "tkey": tkey, "key": key,
                             "n": len(s), "sketch": odd_sketch(s)})
                owners.append(sets)
                entries.append(np.unique(index.signatures(s)))
                if len(seen) >= LATELY:
                    seen.clear()  # a set met again after that is numbered once more
                seen.add(key)
                sets += 1
                held += len(entries[-1])
                if held >= CHUNK:
                    yield flush()
                    chunk, held, entries, owners = chunk + 1, 0, [], []
                if len(rows) >= 1000:
                    yield pa.RecordBatch.from_pylist(rows, schema=fields)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=fields)
        if entries:
            yield flush()
        _words.clear()
    return run


def _met(batches):
    """Index entries that occur twice: (sig, sid)."""
    for batch in batches:
        for r in batch.to_pylist():
            value, hit = answered(r["blob"], r["bitmap"])
            own = np.frombuffer(r["own"], np.uint32)[hit].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((r["owner"] << 32) + value[hit]), pa.array((r["sender"] << 32) + own)], names=["sig", "sid"])


def _shingled(n_words: int):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingles(t.as_py(), n_words).tobytes() for t in batch.column(1)],
                                           pa.binary())], names=["sid", "tokens"])
    return run


def _far(a: bytes, b: bytes) -> int:
    """Hamming distance of two sketches, the longer one folded."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    size = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())


def _near(threshold: Threshold):
    """Pairs (a, b) whose sizes and sketches allow a link."""
    def run(batches):
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = [max(na, nb) <= threshold.largest(min(na, nb)) and _far(x, y) <= threshold.differ(na, nb)
                    for na, nb, x, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _verified(threshold: Threshold):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                at = np.searchsorted(x, y)
                both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                keep.append(threshold.linked(both, len(x), len(y)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))
    return run


def _across(threshold: Threshold):
    """Rows (sig, low, high, sid, n, sketch, component, block) sorted by the first three: pairs of
    one segment in different components that sizes and sketches allow, compared in blocks; where
    ``low`` and ``high`` differ only those of one block with the other."""
    def pairs(rows, apart):
        comp = np.array([r[3] for r in rows], np.int64)
        if (comp == comp[0]).all():
            return
        order = np.argsort([r[1] for r in rows], kind="stable")
        sid, n, comp, block = (np.array([r[i] for r in rows], np.int64)[order] for i in (0, 1, 3, 4))
        size = min(len(r[2]) for r in rows) // 8
        sk = np.stack([folded(np.frombuffer(rows[i][2], np.uint64), size) for i in order])
        for i in range(len(sid)):
            end = int(np.searchsorted(n, threshold.largest(int(n[i])), side="right"))
            for first in range(i + 1, end, BLOCK):
                part = slice(first, min(first + BLOCK, end))
                meets = comp[part] != comp[i]
                if apart:
                    meets &= block[part] != block[i]
                other = np.flatnonzero(meets) + first
                far = np.bitwise_count(sk[other] ^ sk[i]).sum(-1, dtype=np.int64)
                at = other[far <= threshold.differ(n[other], n[i])]
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), sid[i])), pa.array(sid[at])], names=["a", "b"])

    def run(batches):
        now, rows = None, []
        for batch in batches:
            for sig, low, high, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if (sig, low, high) != now:
                    yield from pairs(rows, now[1] != now[2]) if len(rows) > 1 else ()
                    now, rows = (sig, low, high), []
                rows.append(rest)
        yield from pairs(rows, now[1] != now[2]) if len(rows) > 1 else ()
    return run


def in_blocks(placed: DataFrame, sizes: DataFrame) -> DataFrame:
    """``placed(sig, sid, ...)`` of the segments in ``sizes(sig, sets)``, with ``block``, ``low`` and ``high``:
    the sets of a segment in random blocks of about MEET, each block once with itself and with each other one."""
    blocks = F.ceil(F.col("sets") / F.lit(MEET)).cast("long")
    return (placed.join(sizes.select("sig", blocks.alias("blocks")), "sig")
            .withColumn("block", F.pmod(F.xxhash64("sid", F.lit(2)), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
            .drop("blocks", "other"))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"jaccard-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def jaccard_join(docs: DataFrame, n_words: int = 3, num: int = 90, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """``docs(doc_id, text)`` -> (membership, links).

    ``membership(doc_id, tkey, n_shingles, key, component)``: one row per document row, with its
    text's xxhash64, its set's size and key and the least key that links reach from it. ``links(a, b)``:
    verified links between keys, enough to connect every two sets that links connect.
    Texts without words (null or empty too) have the empty set's key and link with
    nothing; rows that repeat a doc_id count each; an empty table gives none.
    """
    threshold = Threshold(num, den)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                       F.xxhash64("text").alias("tkey"))
    members = _written(docs.mapInArrow(_sets(n_words), "doc_id long, tkey long, n long, key binary, band int"), "sets")
    counts = {r["band"]: r["n"] for r in members.filter("n > 0").groupBy("key").agg(F.min("band").alias("band"))
              .groupBy("band").agg(F.count("*").alias("n")).collect()}
    index = Index(counts, threshold)
    signed = _written(docs.mapInArrow(_signed(n_words, index, Universe(index.entries, shuffle_width(docs))), _SIGNED),
                      "signed")
    sets = signed.filter("sid is not null")
    messages = signed.filter("owner is not null").select("sender", "chunk", "owner", "blob", "own")
    met = _written(with_bitmaps(messages, index.entries).select("sender", "owner", "blob", "own", "bitmap")
                   .mapInArrow(_met, "sig long, sid long"), "met")

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        pairs = pairs.distinct()
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
        where = _written(sets.select("sid", F.col("doc_id").alias("at_id"), F.col("tkey").alias("at_key"))
                         .join(wanted, "sid"), f"{name}-where")
        if where.count() <= BROADCAST_IDS:
            where = F.broadcast(where)
        tokens = (docs.join(where, F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("tkey") == F.col("at_key")))
                  .select("sid", "text").mapInArrow(_shingled(n_words), "sid long, tokens binary")
                  .groupBy("sid").agg(F.first("tokens").alias("tokens")))
        a = tokens.select(F.col("sid").alias("a"), F.col("tokens").alias("x"))
        b = tokens.select(F.col("sid").alias("b"), F.col("tokens").alias("y"))
        return _written(pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y")
                        .mapInArrow(_verified(threshold), "a long, b long"), name)

    side = lambda c: sets.select(F.col("sid").alias(c), F.col("n").alias(f"n_{c}"),
                                 F.col("sketch").alias(f"sketch_{c}"))
    before = F.lag("sid").over(Window.partitionBy("sig").orderBy("sid"))
    chained = (met.select(before.alias("a"), F.col("sid").alias("b")).filter("a is not null and a <> b").distinct())
    near = _written(chained.join(side("a"), "a").join(side("b"), "b")
                    .select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
                    .mapInArrow(_near(threshold), "a long, b long"), "near")
    links = verify(near, "links")
    first = components(links)

    placed = (met.distinct().join(first.withColumnRenamed("node", "sid"), "sid", "left")
              .select("sig", "sid", F.coalesce("component", "sid").alias("component")))
    # The two sets of a segment with no third have been compared as a link of the chain; of segments
    # with the same sets one is enough.
    open_sigs = (placed.groupBy("sig").agg(
                     F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("sets"),
                     F.bit_xor(F.xxhash64("sid")).alias("x"), F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("y"))
                 .filter("low <> high and sets > 2").groupBy("sets", "x", "y").agg(F.min("sig").alias("sig"))
                 .select("sig", "sets"))
    across = _written(in_blocks(placed, open_sigs).join(sets.select("sid", "n", "sketch"), "sid")
                      .select("sig", "low", "high", "sid", "n", "sketch", "component", "block")
                      .repartition("sig", "low", "high").sortWithinPartitions("sig", "low", "high")
                      .mapInArrow(_across(threshold), "a long, b long"), "across")
    links = links.union(verify(across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "more"))
    # Sets that several tasks have met are numbered more than once; the key says that they are one.
    named = lambda c: sets.select(F.col("sid").alias(c), F.col("key").alias(f"key_{c}"))
    links = _written(links.join(named("a"), "a").join(named("b"), "b").filter("key_a <> key_b")
                     .select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct(), "all-links")
    final = components(links).withColumnRenamed("node", "key")
    return (members.join(final, "key", "left")
            .select("doc_id", "tkey", F.col("n").alias("n_shingles"), "key", F.coalesce("component", "key").alias("component")),
            links)


def component_ids(docs: DataFrame, n_words: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the least doc_id in its component
    that isn't null; its own if it has no words."""
    membership = jaccard_join(docs, n_words, num, den)[0]
    least = membership.groupBy("component").agg(F.min("doc_id").alias("least"))
    return (membership.join(least, "component")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id"))
                    .otherwise(F.col("least")).alias("component_id")))


def keep_one(docs: DataFrame, n_words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs``, all columns, but of each group that links connect only the
    one with the least doc_id (ids that are null come last; of rows that repeat it, one)."""
    membership = _written(jaccard_join(docs, n_words, num, den)[0].filter("n_shingles > 0"), "membership")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tkey")
    least = (membership.groupBy("component").agg(F.min(place).alias("least"), F.count("*").alias("n"))
             .filter("n > 1").drop("n"))
    verdict = membership.join(least, "component").select("doc_id", "tkey", (place == F.col("least")).cast("int").alias("keep"))
    return select_rows(docs, verdict.distinct())
