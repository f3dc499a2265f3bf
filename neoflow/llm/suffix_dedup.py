"""Removal of long repeated byte strings, by threshold-bounded interval expansion
on Burrows-Wheeler transforms.

A byte goes if it lies in a LENGTH-byte string that also starts earlier. Finding
who has to be compared with whom is a distributed job, comparing them a BWT:

1. Of exact copies only the first text goes on.
2. Of each run of LENGTH bytes the least GRAM-byte hash is kept (winnowing), so
   that equal strings of LENGTH bytes share an anchor at the same place. The
   Golomb-coded exchange finds anchors that occur twice.
3. Occurrences whose whole surroundings (all strings around the anchor) are
   equal need no further look: all but the first go.
4. What is left is one place for each different surroundings of an anchor. Texts
   that such anchors connect form groups; the regions around their places go to
   shards, whole groups to each. Places of anchors with more than LINKED
   surroundings, and of groups with more than GROUP places, meet by the longer
   common core of half of their strings (67 or 66 bytes) instead. First only hashes
   of cores and of the strings' bytes are dealt out: of equal bytes all but the first go, and
   a core that is left with one needs no comparison. Cores with more than HOT
   different ones are halved again, so that their strings share more bytes, down to
   single strings. The text of what is left is cut once, what overlaps for one core in one piece.
   Each shard's BWT is extended backwards breadth first: after step k it is known
   which neighbours in the suffix array agree in k bytes; it stops at LENGTH. In
   an interval of equal strings all but the first go.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neoflow.fs import delete_path
from neoflow.llm.components import components
from neoflow.llm.golomb import Universe, answered, shuffle_width, with_bitmaps
from neoflow.session import scratch_path

LENGTH, GRAM = 100, 32
#: Strings of LENGTH bytes around an anchor, less one.
REACH = LENGTH - GRAM
#: Bytes whose anchors are worked out at a time.
BLOCK = 1 << 17
#: Anchors that are coded together.
CHUNK = 1_000_000
#: Bytes of a shard.
SHARD = 1 << 18
#: Surroundings of an anchor up to which it connects texts, and places of connected texts that share a shard.
LINKED, GROUP = 16, 20_000
#: Different surroundings of one core up to which they meet in a shard.
HOT = 4_000
#: Places whose cores a task makes at a time.
ROWS = 50_000
#: Hot cores (8 bytes each) up to which they are broadcast.
BROADCAST_ROWS = 1_000_000
#: Buckets of texts, at most (Spark's own limit).
MOST_BUCKETS = 100_000

_LAST_ID = (1 << 63) - 1
_rng = np.random.default_rng(11)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPAN = BLOCK + 4 * LENGTH + 1
_POWERS = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(_SPAN, _BASE))])
_UNDO = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(_SPAN, _INVERSE))])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """Best of each run of ``width`` values."""
    done = 1
    while done * 2 <= width:
        x = best(x[:-done], x[done:])
        done *= 2
    return best(x[:len(x) - (width - done)], x[width - done:]) if width > done else x


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, hash of the surroundings) of the kept grams of a text."""
    raw, n = np.frombuffer(text, np.uint8), len(text)
    found = []
    if n < LENGTH:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.uint64),)
    for first in range(0, n - GRAM + 1, BLOCK):
        # grams [first, last) are this block's; all strings that hold them lie in [a, b)
        last = min(first + BLOCK, n - GRAM + 1)
        a, b = max(0, first - REACH), min(n, last + GRAM - 1 + REACH)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw[a:b]] * _POWERS[:b - a])])
        g = _mix((sums[GRAM:] - sums[:-GRAM]) * _UNDO[:b - a - GRAM + 1])
        low = _slide(g, REACH + 1, np.minimum)                      # of each string in [a, b)
        edge = np.zeros(REACH, np.uint64)
        high = _slide(np.concatenate([edge, low, edge]), REACH + 1, np.maximum)  # over the strings that hold a gram
        at = np.flatnonzero(high[:len(g)] == g)
        at = at[(at + a >= first) & (at + a < last)]
        lead = np.minimum(at + a, REACH)
        tail = np.minimum(n - at - a, LENGTH)
        around = _mix((sums[at + tail] - sums[at - lead]) * _UNDO[at - lead])
        around = _mix(around + (lead * 1000 + tail).astype(np.uint64) * _BASE)
        found.append((g[at], (at + a).astype(np.uint64), around))
    return tuple(np.concatenate(x) for x in zip(*found))


_MESSAGE = ("sender long, chunk long, owner long, blob binary, doc binary, place binary, around binary, "
            "ids array<long>, tkeys array<long>")


def _sender(universe: Universe):
    fields = pa.schema([("sender", pa.int64()), ("chunk", pa.int64()), ("owner", pa.int64()), ("blob", pa.binary()),
                        ("doc", pa.binary()), ("place", pa.binary()), ("around", pa.binary()),
                        ("ids", pa.list_(pa.int64())), ("tkeys", pa.list_(pa.int64()))])

    def run(batches):
        sender, chunk, docs, parts, held = TaskContext.get().partitionId(), 0, [], [], 0

        def flush():
            fp = np.concatenate([p[0] for p in parts])
            doc = np.repeat(np.arange(len(parts), dtype=np.uint32), [len(p[0]) for p in parts])
            place = np.concatenate([p[1] for p in parts])
            around = np.concatenate([p[2] for p in parts])
            rows = []
            for owner, at, blob in universe.messages(_mix(fp)):  # kept hashes are the least: unmixed, most go to a few owners
                of, mine = np.unique(doc[at], return_inverse=True)
                rows.append({"sender": sender, "chunk": chunk, "owner": owner, "blob": blob,
                             "doc": mine.astype(np.uint32).tobytes(), "place": place[at].tobytes(),
                             "around": around[at].tobytes(), "ids": [docs[i][0] for i in of],
                             "tkeys": [docs[i][1] for i in of]})
            return pa.RecordBatch.from_pylist(rows, schema=fields)

        for batch in batches:
            for ident, tkey, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                got = anchors(text.as_py())
                if len(got[0]):
                    docs.append((ident, tkey))
                    parts.append(got)
                    held += len(got[0])
                if held >= CHUNK:
                    yield flush()
                    chunk, docs, parts, held = chunk + 1, [], [], 0
        if parts:
            yield flush()
    return run


_SUSPECT = "anchor long, around long, id long, tkey long, place long"


def _suspects(batches):
    for batch in batches:
        for r in batch.to_pylist():
            value, hit = answered(r["blob"], r["bitmap"])
            doc = np.frombuffer(r["doc"], np.uint32)[hit]
            yield pa.RecordBatch.from_arrays(
                [pa.array((r["owner"] << 32) + value[hit]), pa.array(np.frombuffer(r["around"], np.int64)[hit]),
                 pa.array(np.array(r["ids"], np.int64)[doc]), pa.array(np.array(r["tkeys"], np.int64)[doc]),
                 pa.array(np.frombuffer(r["place"], np.int64)[hit])],
                names=["anchor", "around", "id", "tkey", "place"])


_CORE = "core long, same long, id long, tkey long, place long, low byte, high byte"


def _cores(batches):
    """Halves of the strings wanted around places, those that start ``low`` to ``high`` bytes before a place: hash of the
    core, the bytes that they all hold, and of all their bytes with where the place lies in them."""
    digest, least = xxhash.xxh64_intdigest, np.uint64(1 << 63)
    signed = lambda hashes: pa.array((np.array(hashes, np.uint64) ^ least).view(np.int64))
    for batch in batches:
        ident, tkey, texts, lists = batch.columns
        ident, tkey, texts = ident.to_numpy(), tkey.to_numpy(), texts.to_pylist()
        sizes = np.array([len(t) for t in texts], np.int64)
        rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        wanted = [c.to_numpy() for c in lists.flatten().flatten()]
        for at in range(0, len(rows), ROWS):
            of = np.tile(rows[at:at + ROWS], 2)
            core, p, low, high = (c[at:at + ROWS].astype(np.int64) for c in wanted)
            mid = (low + high) // 2
            core, p, low, high = np.tile(core, 2), np.tile(p, 2), np.concatenate([low, mid + 1]), np.concatenate([mid, high])
            a, b = p - low, p - high + LENGTH
            start, end = np.maximum(p - high, 0), np.minimum(sizes[of], a + LENGTH)
            on = np.flatnonzero((a >= 0) & (b <= sizes[of]) & (low <= high) & (end - start >= LENGTH))
            of, core, p, low, high, a, b, start, end = (c[on] for c in (of, core, p, low, high, a, b, start, end))
            seed = core.view(np.uint64) * np.uint64(131) + low.astype(np.uint64)
            text = [texts[i] for i in of]
            cores = [digest(t[i:j], k) for t, i, j, k in zip(text, a.tolist(), b.tolist(), seed.tolist())]
            same = [digest(t[i:j], k) for t, i, j, k in zip(text, start.tolist(), end.tolist(),
                                                            ((p - start) * 1000 + end - p).tolist())]
            yield pa.RecordBatch.from_arrays(
                [signed(cores), signed(same), *map(pa.array, (ident[of], tkey[of], p, low.astype(np.int8), high.astype(np.int8)))],
                names=["core", "same", "id", "tkey", "place", "low", "high"])


_SETTLED = "again boolean, core long, id long, tkey long, place long, low byte, high byte"


def _settled(batches):
    """Rows of cores come sorted by core, bytes and place. Of equal bytes all but the first are marked ``again``; the
    first stays if its core has others. One row is kept between batches, the first of the bytes last seen."""
    last, out = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy() for c in batch.columns]
        if last is not None:
            cols = [np.concatenate([[v], c]).astype(c.dtype) for v, c in zip(last, cols)]
        core, same, *where = cols[:5]
        differs = lambda c: np.concatenate([[True], c[1:] != c[:-1]])
        first = differs(core) | differs(same)
        lead = np.maximum.accumulate(np.where(first, np.arange(len(core)), 0))
        on = np.any([c != c[lead] for c in where], axis=0)  # a row that repeats id and text isn't handed on
        firsts = np.flatnonzero(first)
        fresh = differs(core[firsts])
        met = ~fresh | np.append(~fresh[1:], False)  # one of several in its core
        kept = met.copy()
        if last is not None:
            if out:
                kept[0], met[0] = False, True
        last, out = [c[firsts[-1]] for c in cols], bool(met[-1])
        on[firsts[kept]] = True
        at = np.flatnonzero(on)
        yield pa.RecordBatch.from_arrays([pa.array(~first[at]), *(pa.array(c[at]) for c in [core, *where, *cols[5:]])],
                                         names=["again", "core", "id", "tkey", "place", "low", "high"])


_PART = "core long, id long, tkey long, start long, part binary"


def _parts(batches):
    """The bytes of each text that are wanted for a core, overlapping ones in one part."""
    for batch in batches:
        out = {"core": [], "id": [], "tkey": [], "start": [], "part": []}
        for ident, tkey, text, ranges in zip(*(c.to_pylist() for c in batch.columns)):
            of: dict[int, list[tuple[int, int]]] = {}
            for r in ranges:
                of.setdefault(r["core"], []).append((r["start"], min(r["end"], len(text))))
            for core, wanted in of.items():
                for a, b in merged(wanted):
                    for k, v in zip(out, (core, ident, tkey, a, text[a:b])):
                        out[k].append(v)
        yield pa.RecordBatch.from_arrays([*(pa.array(out[k], pa.int64()) for k in ("core", "id", "tkey", "start")),
                                          pa.array(out["part"], pa.binary())], names=list(out))


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Order of the keys, each key's rank and the last rank; equal keys share one."""
    order = np.argsort(key)
    in_order = key[order]
    fresh = np.zeros(len(key), np.int64)
    np.cumsum(in_order[1:] != in_order[:-1], out=fresh[1:])
    rank = np.empty(len(key), np.int64)
    rank[order] = fresh
    return order, rank, int(fresh[-1])


def suffix_array(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by at least ``depth`` symbols (below 512), and each suffix's place
    in it: seven symbols packed into one key, then prefix doubling."""
    n = len(symbols)
    key, k = np.zeros(n, np.int64), 7
    for j in range(k):
        key[:max(0, n - j)] |= symbols[j:].astype(np.int64) << (9 * (k - 1 - j))
    order, rank, last = _ranked(key)
    while k < depth and last < n - 1:
        follow = np.zeros(n, np.int64)
        follow[:-k or None] = rank[k:] + 1 if k < n else 0
        order, rank, last = _ranked(rank * (last + 2) + follow)
        k *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def equal_runs(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, boundary): boundary[j] where suffixes j - 1 and j of the order differ within ``length`` symbols.

    One backward extension at a time: suffixes j - 1 and j that begin with the same symbol c
    agree in k + 1 symbols if no boundary of step k lies between their rests, the
    suffixes that c precedes in the transform. So common prefixes come out by increasing value.
    """
    order, place = suffix_array(symbols, length)
    n = len(symbols)
    first = symbols[order]
    boundary = np.concatenate([[True], first[1:] != first[:-1]])
    rest = place[np.minimum(order + 1, n - 1)]
    rest[order == n - 1] = 0
    undecided = np.flatnonzero(~boundary)
    here, before, decided = rest[undecided], rest[undecided - 1], 0
    for _ in range(length - 1):
        count = np.cumsum(boundary, dtype=np.int32)
        differ = count.take(here, mode="clip") != count.take(before, mode="clip")  # all lie inside: spares the test
        now = int(np.count_nonzero(differ))
        if now == decided:  # no boundary is new, so the next steps would find none either
            break
        boundary[undecided[differ]] = True
        decided = now
        if decided * 8 > len(undecided):  # pairs told apart stay so; they are looked up again until they are many
            left = np.flatnonzero(~differ)
            undecided, here, before, decided = undecided[left], here[left], before[left], 0
    return order, boundary


def repeated_starts(parts: list[bytes], ident: np.ndarray, tkey: np.ndarray, start: np.ndarray,
                    length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(part, start in the text) of the strings of ``length`` that come earlier in these parts, by part and start;
    parts start at ``start`` of the text (ident, tkey)."""
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.zeros(int(ends[-1]) + 1, np.int64)
    text = np.ones(len(symbols), bool)
    text[ends] = False
    symbols[text] = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64) + 1  # 0 parts them
    order, boundary = equal_runs(symbols, length)
    run = np.cumsum(boundary) - 1
    whole = np.repeat(ends, sizes + 1) - np.arange(len(symbols)) >= length  # others hold a separator, so equal none of these
    inside = np.flatnonzero(whole[order] & (np.bincount(run)[run] > 1))
    order, run = order[inside], run[inside]
    part = np.repeat(np.arange(len(parts)), sizes + 1)[order]
    by_text = np.lexsort((tkey, ident))
    rank = np.empty(len(parts), np.int64)  # place of the part's text in the order of texts
    rank[by_text] = np.cumsum(np.concatenate(
        [[False], (np.diff(ident[by_text]) != 0) | (np.diff(tkey[by_text]) != 0)]))
    st = order - (ends[part] - sizes[part]) + start[part]
    by = np.lexsort((st, rank[part], run))
    run, part, st = run[by], part[by], st[by]
    rk = rank[part]
    lead = np.concatenate([[True], run[1:] != run[:-1]])[:len(run)]
    first = np.maximum.accumulate(np.where(lead, np.arange(len(by)), 0))
    again = (rk != rk[first]) | (st != st[first])
    part, st = part[again], st[again]
    by = np.lexsort((st, part))
    return part[by], st[by]


_RUN = "id long, tkey long, start long, end long"


def _runs(parts, ident, tkey, start):
    """Intervals of bytes covered by strings that come earlier."""
    where = [np.array(c, np.int64) for c in (ident, tkey, start)]
    part, st = repeated_starts(parts, *where)
    cut = (np.diff(part) != 0) | (np.diff(st) > LENGTH)
    some = [True] * bool(len(part))
    first, last = np.flatnonzero(np.concatenate([some, cut])), np.flatnonzero(np.concatenate([cut, some]))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (where[0][part[first]], where[1][part[first]], st[first],
                                                             st[last] + LENGTH)],
                                      names=["id", "tkey", "start", "end"])


def _sharded(batches):
    """Rows come sorted by core; whole cores are gathered up to SHARD bytes."""
    now, rows, size = None, [], 0
    for batch in batches:
        for core, ident, tkey, start, part in zip(*(c.to_pylist() for c in batch.columns)):
            if core != now and size >= SHARD:
                yield _runs(*zip(*rows))
                rows, size = [], 0
            now = core
            rows.append((part, ident, tkey, start))
            size += len(part)
    if rows:
        yield _runs(*zip(*rows))


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs: touching and overlapping ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _joined(batches):
    """Each text's intervals as maximal runs."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        lists = batch.column(2)
        start, end = (c.to_numpy() for c in lists.flatten().flatten())
        of = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        by = np.lexsort((start, of))
        of, start, end = of[by], start[by], end[by]
        apart = of * (int(end.max(initial=0)) + 1)
        reached = np.maximum.accumulate(end + apart) - apart  # furthest end of the text's runs so far
        cut = (of[1:] != of[:-1]) | (start[1:] > reached[:-1])
        some = [True] * bool(len(of))
        first, last = np.flatnonzero(np.concatenate([some, cut])), np.flatnonzero(np.concatenate([cut, some]))
        at = np.concatenate([[0], np.cumsum(np.bincount(of[first], minlength=len(lists)))])
        runs = pa.StructArray.from_arrays([pa.array(start[first]), pa.array(reached[last])], fields=list(kind.value_type))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                          pa.ListArray.from_arrays(pa.array(at, pa.int32()), runs, type=kind)],
                                         names=["id", "tkey", "runs"])


def _removed(with_kept: bool):
    fields = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        ("kept_sha", pa.binary()), ("kept", pa.binary())])

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text, copy, runs in zip(*(c.to_pylist() for c in batch.columns)):
                spans = [(0, len(text))] if copy and len(text) >= LENGTH else merged(
                    [(r["start"], min(r["end"], len(text))) for r in runs or ()])
                kept, at = [], 0
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                kept = b"".join([*kept, text[at:]])
                rows.append({"doc_id": doc_id, "n_bytes": len(text), "kept_sha": hashlib.sha256(kept).digest(),
                             "spans": [{"start": a, "end": b} for a, b in spans],
                             "kept": kept if with_kept else None})
            yield pa.RecordBatch.from_pylist(rows, schema=fields)
    return run


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"suffix-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _dropped(df: DataFrame) -> None:
    """Deletes what _written() wrote."""
    for folder in {unquote(x.rpartition("/")[0]) for x in df.inputFiles()}:
        delete_path(df.sparkSession, folder, recursive=True)


def _dealt(docs: DataFrame, width: int) -> DataFrame:
    """The texts, written once in buckets by (id, tkey): joins with them shuffle their other side only.

    Buckets are known to a catalog alone, so the table is named in the session's for as long as it takes to look it up.
    """
    spark, width = docs.sparkSession, min(width, MOST_BUCKETS)
    name = f"spark_catalog.default.neoflow_texts_{uuid.uuid4().hex}"
    (docs.repartition(width, "id", "tkey").write.format("parquet").bucketBy(width, "id", "tkey").option("compression", "zstd")
     .option("path", scratch_path(spark, "suffix-texts")).saveAsTable(name))
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the files stay: the table has a path of its own


def _at_texts(texts: DataFrame, listed: DataFrame, how: str = "inner") -> DataFrame:
    """``texts`` of _dealt() joined with rows of documents; texts are neither shuffled nor sorted."""
    return texts.join(listed.hint("shuffle_hash"), ["id", "tkey"], how)


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def remove_repeats(docs: DataFrame, with_kept: bool = True) -> DataFrame:
    """``docs(doc_id, text)`` -> (doc_id, n_bytes, spans, kept_sha, kept), one row per row.

    Texts are UTF-8 bytes (null: empty); ``spans`` are the maximal removed runs, ``kept``
    the other bytes (null unless ``with_kept``). Texts are ordered by doc_id, null ids
    last; different texts with one id by their hash. Rows that repeat id and text
    count as one document and come out alike. Texts under LENGTH bytes stay whole.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("id"),
                       F.xxhash64("text").alias("tkey"),
                       F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    width = shuffle_width(docs)
    docs = _dealt(docs, width)
    long = F.length("text") >= LENGTH
    members = _written(docs.filter(long).select("id", "tkey", F.sha2("text", 256).alias("sha"),
                                                F.length("text").alias("n")).distinct(), "members")
    first = members.groupBy("sha").agg(F.min(F.struct("id", "tkey")).alias("first"), F.count("*").alias("copies"),
                                       F.first("n").alias("n"))
    first = _written(first, "first")
    copies = _written(members.join(first.filter("copies > 1").select("sha", "first"), "sha")
                      .filter(F.struct("id", "tkey") != F.col("first")).select("id", "tkey"), "copies")
    total = first.agg(F.sum("n")).first()[0] or 0
    expected = 2 * total // (REACH + 2)
    universe = Universe(expected, width)

    source = docs.filter(long).select("id", "tkey", "text")
    messages = _written(_at_texts(source, copies, "left_anti").mapInArrow(_sender(universe), _MESSAGE), "messages")
    suspects = _written(with_bitmaps(messages, expected).select("owner", "blob", "doc", "place", "around", "ids",
                                                                "tkeys", "bitmap")
                        .mapInArrow(_suspects, _SUSPECT), "suspects")
    _dropped(messages)
    # Rows that repeat id and text have sent their anchors twice: min() and struct comparison see them as one.
    place = F.struct("id", "tkey", "place")
    around = _written(suspects.groupBy("anchor", "around").agg(F.min(place).alias("first"),
                                                               F.max(place).alias("last")), "around")
    whole = (suspects.join(around.filter(F.col("first") != F.col("last")).select("anchor", "around", "first"),
                           ["anchor", "around"])
             .filter(place != F.col("first"))
             .select("id", "tkey", F.greatest(F.col("place") - REACH, F.lit(0)).alias("start"),
                     (F.col("place") + LENGTH).alias("end")))

    node = lambda c: F.struct(F.col(f"{c}.id").alias("id"), F.col(f"{c}.tkey").alias("tkey"))
    several = (around.groupBy("anchor").agg(F.count("*").alias("n"), F.min("first").alias("hub")).filter("n > 1"))
    places = _written(around.join(several, "anchor")
                      .select(node("first").alias("node"), node("hub").alias("hub"), "n", "first.place"), "places")
    group = components(places.filter(F.col("n") <= LINKED).select(F.col("node").alias("a"), F.col("hub").alias("b")))
    placed = (places.join(group, "node", "left")
              .select("node", "place", "n", F.coalesce("component", "node").alias("component")))
    large = (placed.filter(F.col("n") <= LINKED).groupBy("component").agg(F.count("*").alias("size"))
             .filter(F.col("size") > GROUP).select("component", F.lit(True).alias("large")))
    meets = (F.col("n") <= LINKED) & F.col("large").isNull()
    own = (placed.join(F.broadcast(large), "component", "left")  # one row for GROUP places at least
           .groupBy(F.col("node.id").alias("id"), F.col("node.tkey").alias("tkey"))
           .agg(F.xxhash64(F.first("component")).alias("group"),
                F.collect_set(F.when(meets, F.col("place"))).alias("grouped"),
                F.collect_set(F.when(~meets, F.col("place"))).alias("places")))
    own = _written(own, "own")
    nothing, most = F.lit(0).cast("byte"), F.lit(REACH).cast("byte")
    wanted = own.filter(F.size("places") > 0).select("id", "tkey", F.transform("places", lambda p: F.struct(
        F.lit(0).cast("long").alias("core"), p.alias("place"), nothing.alias("low"), most.alias("high"))).alias("wanted"))
    start, end = F.greatest(F.col("place") - F.col("high"), F.lit(0)).alias("start"), (F.col("place") - F.col("low") + LENGTH).alias("end")
    grouped = own.select("id", "tkey", F.col("group").alias("core"), F.explode("grouped").alias("place"),
                         nothing.alias("low"), most.alias("high"))
    compare, equal = [grouped.select("core", "id", "tkey", start, end)], []
    while True:  # each round halves the strings of a core: seven at most
        cores = _written(_at_texts(source, wanted).select("id", "tkey", "text", "wanted").mapInArrow(_cores, _CORE)
                         .repartition(width, "core").sortWithinPartitions("core", "same", "id", "tkey", "place")
                         .mapInArrow(_settled, _SETTLED), "cores")
        equal.append(cores.filter("again").select("id", "tkey", start, end))
        firsts = cores.filter("not again")
        hot = _written(firsts.groupBy("core").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("core"), "hot")
        n_hot = hot.count()
        if n_hot == 0:
            compare.append(firsts.select("core", "id", "tkey", start, end))
            break
        compare.append(firsts.join(_small(hot, n_hot), "core", "left_anti").select("core", "id", "tkey", start, end))
        wanted = _written(firsts.join(_small(hot, n_hot), "core", "left_semi").groupBy("id", "tkey")
                          .agg(F.collect_list(F.struct("core", "place", "low", "high")).alias("wanted")), "wanted")
    ranges = _written(reduce(DataFrame.unionByName, compare).groupBy("id", "tkey")
                      .agg(F.collect_list(F.struct("core", "start", "end")).alias("ranges")), "ranges")
    parts = _at_texts(source, ranges).select("id", "tkey", "text", "ranges").mapInArrow(_parts, _PART)
    compared = (parts.repartition(width, "core").sortWithinPartitions("core").mapInArrow(_sharded, _RUN))

    runs = reduce(DataFrame.unionByName, [whole, compared, *equal])
    runs = _written(runs.groupBy("id", "tkey").agg(F.collect_set(F.struct("start", "end")).alias("runs"))
                    .mapInArrow(_joined, "id long, tkey long, runs array<struct<start:bigint,end:bigint>>"), "runs")
    touched = (runs.select("id", "tkey", F.lit(False).alias("copy"), "runs")
               .unionByName(copies.select("id", "tkey", F.lit(True).alias("copy"), F.lit(None).cast(
                   runs.schema["runs"].dataType).alias("runs"))))
    return (_at_texts(docs, touched, "left").select("doc_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "runs")
            .mapInArrow(_removed(with_kept), "doc_id long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, "
                                             "kept_sha binary, kept binary"))
