"""Near duplicates by HyperMinHash.

A set of word shingles is held as BUCKETS registers. A bucket keeps the least value
of its own hash function over the set (so a small set leaves no bucket empty), and
of that value only how many zeros it leads with and the MANTISSA bits after the
first one: 16 bits a register.

1. Sets that are equal are one from here on (by a 96-bit key).
2. Each ROWS registers make a band. Sets that share a band are candidates: two sets of
   similarity s share one of BUCKETS / ROWS bands with a chance of 1 - (1 - s**ROWS)**bands,
   which at 0.8 leaves out one pair in 20 million.
3. Registers also agree by chance. The estimate of a pair's similarity is the share of
   equal registers, corrected by the chance that two different minima fall into one
   register at the sets' sizes; pairs more than MARGIN below the threshold are left out
   (over five standard deviations).
4. All others are verified on the full sets. First each set meets, of its bands' least
   sets, the one with the best estimate; what verified links connect is one component.
   Then, in bands that still hold several components, sets of different ones meet in
   blocks inside a task: where sizes, estimate and odd sketches (whose Hamming distance
   never exceeds the difference of two sets) allow a link, the sets' shingles are
   fetched, and each verified link makes two components one, so that a task gives at
   most one link a component and block. Links inside a component are left out, but
   none that connects two.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neoflow.llm.components import components
from neoflow.llm.jaccard_join import folded, odd_sketch
from neoflow.session import scratch_path

BUCKETS, ROWS = 128, 4
BANDS = BUCKETS // ROWS
MANTISSA = 10
#: Estimates this far below the threshold are no candidates.
MARGIN = 0.2
#: Sets of a band, and shingles of theirs, that meet in one task, at most about twice as many; more are
#: split and met block against block.
MEET, MEET_SHINGLES = 4_000, 2_000_000
#: Texts looked up again up to which their ids (8 bytes each) are broadcast; beyond it Spark joins by a shuffle.
BROADCAST_IDS = 500_000
#: Words whose hashes a task keeps, shingles hashed at a time, and keys of sets a task has met lately.
CACHE_WORDS, STEP, LATELY = 200_000, 2048, 200_000

_SEEDS = np.random.default_rng(12).integers(0, 1 << 64, (2, BUCKETS), dtype=np.uint64, endpoint=False)
_SEEDS[1] |= np.uint64(1)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.empty(0, np.uint64)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


class Shingler:
    """Texts to sorted distinct 64-bit hashes of their ``n``-word shingles (A-Z lowered; words are split at
    space and the five control characters from tab on); of fewer words one of the whole sequence; none without words."""

    def __init__(self, n: int):
        self.n, self.words = n, {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        if not words:
            return _EMPTY
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        known = self.words
        h = np.fromiter((known.get(w) or known.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in words),
                        np.uint64, len(words))
        k = min(self.n, len(h))
        total = np.full(len(h) - k + 1, np.uint64(k), np.uint64)
        for i in range(k):
            total = _stir(total * _MUL + h[i:len(h) - k + 1 + i])
        return np.unique(total)


def registers(s: np.ndarray) -> np.ndarray:
    """The registers of a set that isn't empty: leading zeros (six bits) and mantissa of each bucket's least value."""
    least = np.full(BUCKETS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(s), STEP):
        x = (s[i:i + STEP] ^ _SEEDS[0][:, None]) * _SEEDS[1][:, None]
        np.minimum(least, x.min(1), out=least)
    least = np.maximum(least, np.uint64(1))
    top = np.frexp(least.astype(np.longdouble))[1].astype(np.int64)  # bits in use, 1 to 64
    fraction = (least << (np.uint64(64) - top.astype(np.uint64))) << np.uint64(1)
    return ((64 - top).astype(np.uint16) << np.uint16(MANTISSA)) | (fraction >> np.uint64(64 - MANTISSA)).astype(np.uint16)


def by_chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that registers of sets without a common shingle agree, at sizes ``n`` and ``m``.

    A register covers values of [0, 1) as wide as its binade's part; summed over the binades, each
    part's chance for the one set times that for the other (densities n (1-x)**(n-1), m (1-x)**(m-1))."""
    n, m = np.asarray(n, float)[..., None], np.asarray(m, float)[..., None]
    zeros = np.arange(64)
    width = 2.0 ** -(zeros + 1 + MANTISSA)
    low, high = 2.0 ** -(zeros + 1), 2.0 ** -zeros
    power = n + m - 1
    inside = np.exp(power * np.log1p(-low)) - np.where(high >= 1, 0.0, np.exp(power * np.log1p(-np.minimum(high, 1 - 1e-16))))
    return np.minimum((width * n * m / power * inside).sum(-1), 0.5)


def similarity(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity from the number of equal registers, corrected for those equal by chance."""
    chance = by_chance(n, m)
    return (equal / BUCKETS - chance) / (1 - chance)


class Rule:
    """A link: Jaccard similarity of at least num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.least = num / den - MARGIN

    def linked(self, both: int, n: int, m: int) -> bool:
        return self.den * both >= self.num * (n + m - both)

    def differ(self, n, m):
        """Shingles that linked sets of these sizes differ in, at most."""
        return (n + m) * (self.den - self.num) // (self.den + self.num)

    def sizes(self, n, m):
        """The smaller set is large enough for a link."""
        return self.den * np.minimum(n, m) >= self.num * np.maximum(n, m)

    def estimates(self, a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Estimated similarity of pairs (rows of registers ``a``, or one row, and ``b``, sizes ``n`` and ``m``);
        0 where the sizes or the estimate rule a link out."""
        out = np.zeros(len(m))
        at = np.flatnonzero(self.sizes(n, m))
        if len(at):
            n = np.broadcast_to(n, m.shape)
            equal = ((a if a.ndim == 1 else a[at]) == b[at]).sum(-1)
            found = similarity(equal, n[at], m[at])
            out[at] = np.where(found >= self.least, found, 0.0)
        return out


_SIGNED = "doc_id long, tkey long, n long, key binary, registers binary, sketch binary"


def _signed(n_words: int):
    """Size, key, registers and sketch of every text's set; the last two only where the task hasn't met the set lately."""
    def run(batches):
        shingle, lately = Shingler(n_words), {}
        for batch in batches:
            n, keys, regs, sketches = [], [], [], []
            for t in batch.column(1):
                s = shingle(t.as_py())
                n.append(len(s))
                key = hashlib.blake2b(s.tobytes(), digest_size=12).digest() if len(s) else None
                keys.append(key)
                if key is None or key in lately:
                    regs.append(None)
                    sketches.append(None)
                    continue
                if len(lately) >= LATELY:
                    lately.clear()
                lately[key] = True
                regs.append(registers(s).tobytes())
                sketches.append(odd_sketch(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(regs, pa.binary()), pa.array(sketches, pa.binary())],
                names=["doc_id", "tkey", "n", "key", "registers", "sketch"])
    return run


def _banded(batches):
    """(name, bands: the band's registers as one integer each)."""
    for batch in batches:
        regs = b"".join(batch.column(1).to_pylist())
        flat = pa.array(np.frombuffer(regs, "<i8"))
        offsets = pa.array(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], names=["name", "bands"])


def _regs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), BUCKETS)


def _estimated(rule: Rule):
    """Rows (a, b, n_a, n_b, registers of a and b): the pairs that the estimate lets pass, with it."""
    def run(batches):
        for batch in batches:
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            got = rule.estimates(_regs(batch.column(4)), _regs(batch.column(5)), n, m)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(got)], names=["a", "b", "estimate"]).filter(
                pa.array(got > 0, pa.bool_()))
    return run


def _shingled(n_words: int):
    def run(batches):
        shingle = Shingler(n_words)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingle(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())],
                names=["name", "tokens"])
    return run


def shared(x: np.ndarray, y: np.ndarray) -> int:
    """How many shingles two sorted sets share."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _verified(rule: Rule):
    """Rows (a, b, shingles of a and b): the pairs that are links."""
    def run(batches):
        for batch in batches:
            sets = [[np.frombuffer(t.as_py(), np.uint64) for t in batch.column(i)] for i in (2, 3)]
            keep = [rule.linked(shared(x, y), len(x), len(y)) for x, y in zip(*sets)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


class _Block:
    """Sets of one band, (name, n, registers, component, block, extra) each, in the order of their components'
    sizes: members of smaller components look for links to larger ones."""

    def __init__(self, rows: list[list], blocks_differ: bool):
        self.names = [r[0] for r in rows]
        self.n = np.array([r[1] for r in rows], np.int64)
        self.regs = np.frombuffer(b"".join(r[2] for r in rows), np.uint16).reshape(len(rows), BUCKETS)
        comp = np.unique([r[3] for r in rows], return_inverse=True)[1]
        size = np.bincount(comp)
        rank = np.empty(len(size), np.int64)
        rank[np.argsort(size, kind="stable")] = np.arange(len(size))
        self.component = rank[comp]
        self.block = np.array([r[4] for r in rows], np.int64) if blocks_differ else None
        self.extra = [r[5] for r in rows]

    def candidates(self, rule: Rule, now: np.ndarray):
        """(set, those of larger components that the estimate lets pass, best first); sets that are one
        component in ``now`` by then don't meet."""
        for i in np.flatnonzero(self.component < self.component.max()):
            meets = (self.component > self.component[i]) & (now != now[i])
            if self.block is not None:
                meets &= self.block != self.block[i]
            other = np.flatnonzero(meets)
            if len(other):
                got = rule.estimates(self.regs[i], self.regs[other], self.n[i], self.n[other])
                yield i, other[np.argsort(-got, kind="stable")[:np.count_nonzero(got)]]


def _waiting(rule: Rule):
    """Extra: the sketch. The sets of a block for which sizes, estimate and sketches allow a link to another component."""
    def run(block: _Block):
        size = min(map(len, block.extra)) // 8
        sketch = np.stack([folded(np.frombuffer(x, np.uint64), size) for x in block.extra])
        may = np.zeros(len(block.names), bool)
        for i, other in block.candidates(rule, block.component):
            far = np.bitwise_count(sketch[other] ^ sketch[i]).sum(-1, dtype=np.int64)
            other = other[far <= rule.differ(block.n[i], block.n[other])]
            may[other] = True
            may[i] |= len(other) > 0
        return [(block.names[i],) for i in np.flatnonzero(may)]
    return run


def _joining(rule: Rule):
    """Extra: the shingles. Verified links that make the block's components one."""
    def run(block: _Block):
        sets = [np.frombuffer(x, np.uint64) for x in block.extra]
        now, out = block.component.copy(), []
        for i, other in block.candidates(rule, now):
            for j in other:
                if now[i] != now[j] and rule.linked(shared(sets[i], sets[j]), len(sets[i]), len(sets[j])):
                    now[now == now[i]] = now[j]
                    out.append((block.names[i], block.names[j]))
        return out
    return run


_MEETING = ["band", "value", "low", "high"]


def _in_blocks(met, names: list[str], keep: bool):
    """Rows of _MEETING and a block's sets, sorted by the first: what ``met`` gives for each block of several
    components, with its place if ``keep``; where ``low`` and ``high`` differ, sets of one meet those of the other."""
    def found(place, rows):
        if len(rows) > 1 and len({r[3] for r in rows}) > 1:
            got = met(_Block(rows, place[2] != place[3]))
            if got:
                at = [pa.array([x] * len(got), pa.int64()) for x in place] if keep else []
                yield pa.RecordBatch.from_arrays([*at, *(pa.array(c, pa.binary()) for c in zip(*got))],
                                                 names=_MEETING * keep + names)

    def run(batches):
        now, rows = None, []
        for batch in batches:
            for band, value, low, high, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if (band, value, low, high) != now:
                    yield from found(now, rows)
                    now, rows = (band, value, low, high), []
                rows.append(rest)
        yield from found(now, rows)
    return run


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"hyperminhash-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _name(doc_id: Column, key: Column) -> Column:
    """A set's name: its least doc_id, in bytes that sort as the ids do (no id last), and its key."""
    number = F.lpad(F.hex(doc_id.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.unhex(F.coalesce(F.concat(F.lit("00"), number), F.lit("01" + "0" * 16))), key)


def _id(name: Column) -> Column:
    number = F.conv(F.hex(F.substring(name, 2, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    return F.when(F.hex(F.substring(name, 1, 1)) == "00", number)


def near_duplicates(docs: DataFrame, n_words: int = 4, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """``docs(doc_id, text)`` -> (membership, links).

    ``membership(doc_id, n_shingles, key, component_id)``: one row per row of ``docs``, with its set's size and
    key and the least doc_id that links reach from it. ``links(a, b)``: verified links between
    keys, which connect all sets that links connect (but for pairs that share no band, see above). A text
    without words (null and empty too) has a null key and its own id, and links with nothing; equal
    texts, and texts with equal sets, share a key; a null doc_id comes last; rows that repeat a doc_id
    count each; further columns are not read; an empty table gives no rows.
    """
    rule = Rule(num, den)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                       F.xxhash64("text").alias("tkey"))
    members = _written(docs.mapInArrow(_signed(n_words), _SIGNED), "members")
    # One row a set, copies summed up before the shuffle; ``at`` is a row where its text can be found.
    sets = _written(members.filter("n > 0").groupBy("key").agg(
        F.first("n").alias("n"), F.max("registers").alias("registers"), F.max("sketch").alias("sketch"),
        F.min("doc_id").alias("least"),
        F.min(F.struct("doc_id", "tkey")).alias("at"), F.count("*").alias("rows"))
        .withColumn("name", _name(F.col("least"), F.col("key"))), "sets")
    bands = _written(sets.select("name", "registers").mapInArrow(_banded, "name binary, bands array<long>")
                     .select("name", F.posexplode("bands").alias("band", "value"))
                     .withColumn("band", F.col("band").cast("long")), "bands")
    several = (bands.groupBy("band", "value").agg(F.min("name").alias("first"), F.count("*").alias("sets"))
               .filter("sets > 1").drop("sets"))
    common = _written(bands.join(several, ["band", "value"]), "common")

    def tokens(names: DataFrame, step: str) -> DataFrame:
        """(name, tokens) of the sets ``names``, their texts read again."""
        at = _written(sets.select("name", F.col("at.doc_id").alias("at_id"), F.col("at.tkey").alias("at_key"))
                      .join(names, "name"), f"{step}-at")
        if at.count() <= BROADCAST_IDS:
            at = F.broadcast(at)
        # Rows that repeat an id and a text give a set twice; one is enough.
        return _written(docs.join(at, F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("tkey") == F.col("at_key")))
                        .select("name", "text").mapInArrow(_shingled(n_words), "name binary, tokens binary")
                        .groupBy("name").agg(F.first("tokens").alias("tokens")), f"{step}-tokens")

    side = lambda c: sets.select(F.col("name").alias(c), F.col("n").alias(f"n_{c}"),
                                 F.col("registers").alias(f"registers_{c}"))
    starred = (common.filter("name <> first").select(F.col("first").alias("a"), F.col("name").alias("b")).distinct())
    near = _written(starred.join(side("a"), "a").join(side("b"), "b")
                    .select("a", "b", "n_a", "n_b", "registers_a", "registers_b")
                    .mapInArrow(_estimated(rule), "a binary, b binary, estimate double")
                    .groupBy("b").agg(F.max_by("a", F.struct("estimate", "a")).alias("a")), "near")
    known = tokens(near.select(F.explode(F.array("a", "b")).alias("name")).distinct(), "near")
    has = lambda c, t: known.select(F.col("name").alias(c), F.col("tokens").alias(t))
    links = _written(near.join(has("a", "x"), "a").join(has("b", "y"), "b").select("a", "b", "x", "y")
                     .mapInArrow(_verified(rule), "a binary, b binary"), "links")
    joined = components(links).select(F.col("node").alias("name"), "component")

    placed = (common.select("band", "value", "name").join(sets.select("name", "n"), "name")
              .join(joined, "name", "left").withColumn("component", F.coalesce("component", "name")))
    # Of bands with the same sets one is enough.
    still = _written(
        placed.groupBy("band", "value").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("sets"),
            F.sum("n").alias("shingles"),
            F.bit_xor(F.xxhash64("name")).alias("x"), F.bit_xor(F.xxhash64("name", F.lit(1))).alias("y"))
        .filter("low <> high").groupBy("sets", "shingles", "x", "y").agg(F.min(F.struct("band", "value")).alias("b"))
        .select("b.band", "b.value", F.greatest(F.ceil(F.col("sets") / MEET), F.ceil(F.col("shingles") / MEET_SHINGLES))
                .cast("long").alias("blocks")), "open")
    blocked = _written(placed.join(still, ["band", "value"])
                       .withColumn("block", F.pmod(F.xxhash64("name", F.lit(2)), F.col("blocks")))
                       .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
                       .select("band", "value", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                               "name", "n", "component", "block"), "blocked")

    def meet(rows: DataFrame, extra: DataFrame, run, schema: str) -> DataFrame:
        payload = sets.select("name", "registers").join(extra, "name")
        return (rows.join(payload, "name").select(*_MEETING, "name", "n", "registers", "component", "block", "extra")
                .repartition(*_MEETING).sortWithinPartitions(*_MEETING).mapInArrow(run, schema))

    waiting = _written(meet(blocked, sets.select("name", F.col("sketch").alias("extra")),
                            _in_blocks(_waiting(rule), ["name"], True),
                            "band long, value long, low long, high long, name binary"), "waiting")
    opened = tokens(waiting.select("name").distinct(), "open").withColumnRenamed("tokens", "extra")
    more = meet(blocked.join(waiting, [*_MEETING, "name"], "left_semi"), opened,
                _in_blocks(_joining(rule), ["a", "b"], False), "a binary, b binary")
    links = _written(links.union(more), "all-links")
    final = components(links)

    # A component's least name begins with its least id. Sets of one row without a link stand for themselves.
    ids = _written(sets.join(final.withColumnRenamed("node", "name"), "name", "left")
                   .filter("component is not null or rows > 1")
                   .select("key", _id(F.coalesce("component", "name")).alias("component_id")), "ids")
    key = lambda c: F.substring(c, 10, 12)
    return (members.select("doc_id", F.col("n").alias("n_shingles"), "key").join(ids, "key", "left")
            .select("doc_id", "n_shingles", "key", F.coalesce("component_id", "doc_id").alias("component_id")),
            links.select(key(F.col("a")).alias("a"), key(F.col("b")).alias("b")))


def component_ids(docs: DataFrame, n_words: int = 4, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: the least doc_id in its component that isn't null
    (its own if it has no words), and whether it is the row's own. Rows that repeat the least id are all kept."""
    membership = near_duplicates(docs, n_words, num, den)[0]
    return membership.select("doc_id", "n_shingles", "component_id",
                             F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
