"""Sequence packing by non-negative least squares over the length histogram.

1. Texts are tokenised and cut into pieces of at most WINDOW tokens.
2. Lengths are counted. Combinations of up to three length bins that fill the
   window are enumerated, and non-negative least squares finds how often to
   repeat each so that together they use the histogram up. Repeat counts are
   rounded down; what they leave is packed greedily, largest first, also into
   the gaps of the solved combinations. All this works on counts: its size
   depends on WINDOW alone.
3. Every piece gets its rank among the pieces of its length (counts per task
   and prefix sums, no group of pieces meets in one task), and the rank says
   which repeat of which combination it belongs to.
"""

from __future__ import annotations

import os
import re
from array import array
from collections import Counter, defaultdict
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from neoflow.session import scratch_path

WINDOW = 4096
END_ID = 2
#: Lengths are solved for in bins of so many tokens.
BIN = 32
#: Distinct words whose ids a worker keeps (twice as many for a while).
CACHE_WORDS = 200_000
#: Counts of (task, length) up to which their prefix sums are broadcast (24 bytes each); beyond it Spark joins by a shuffle.
BROADCAST_COUNTS = 400_000
#: Codec of the written ids.
CODEC = "zstd"

#: Letters whose lower case is one letter, then marks: encoded the same apart as together.
_PLAIN = "^(?P<core>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<end>[.,;:!?)%*&#$]*)$"
_LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch


def id_kind(vocabulary: int) -> str:
    """How ids are stored."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


class WordTokenizer:
    """Ids of texts, little-endian in two bytes each (four if the vocabulary needs them), by a tokenizer that
    drops white space: words between blanks are encoded apart from each other, each once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = id_kind(self.tokenizer.get_vocab_size())
        self.code = {"<u2": "H", "<u4": "I"}[self.kind]
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.mark = self.tokenizer.encode("|", add_special_tokens=False).ids[0]
        self.marks: dict[str, bytes] = {"": b""}
        self.model = self.tokenizer.model
        probe = ["q", "hello", "unbelievably", "été", "naïveté", "àíñßø", "überaus", "señor"]
        self.direct = all(self._by_model(w) == raw for w, raw in self._ask(probe).items())

    def _ask(self, words: list[str]) -> dict[str, bytes]:
        """Encodes words in few calls, a mark between each two; words with the mark inside on their own."""
        out: dict[str, bytes] = {}
        own = [w for w in words if "|" in w]
        rest = [w for w in words if "|" not in w]
        for w, e in zip(own, self.tokenizer.encode_batch_fast(own, add_special_tokens=False) if own else ()):
            out[w] = np.array(e.ids, self.kind).tobytes()
        for at in range(0, len(rest), 4096):
            some = rest[at:at + 4096]
            [e] = self.tokenizer.encode_batch_fast([" | ".join(some)], add_special_tokens=False)
            ids = np.array(e.ids, self.kind)
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
            raw, first, size = ids.tobytes(), 0, ids.itemsize
            for w, end in zip(some, ends.tolist()):
                out[w] = raw[size * first:size * end]
                first = end + 1
        return out

    def _by_model(self, core: str) -> bytes:
        """A word of lower-case letters, by the model alone: no normalizing and cutting to be done."""
        piece = core if core.isascii() else core.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return array(self.code, [t.id for t in self.model.tokenize(piece)]).tobytes()

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words and of words that aren't just letters; new ones are encoded."""
        known, old, ask = self.known, self.old, []
        for w in words:
            if w not in known:
                raw = old.get(w)
                if raw is None and self.direct and _LETTERS(w):
                    raw = self._by_model(w)
                if raw is None:
                    ask.append(w)
                else:
                    known[w] = raw
        known.update(self._ask(ask))
        return [known[w] for w in words]

    def _word_ids(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words. A word of Latin letters with marks after it is its lower-case
        letters and the marks, each encoded once."""
        plain = pc.extract_regex(words, _PLAIN)
        core = pc.coalesce(pc.utf8_lower(pc.struct_field(plain, "core")), words).dictionary_encode()
        end = pc.coalesce(pc.struct_field(plain, "end"), "").dictionary_encode()
        ends = end.dictionary.to_pylist()
        if new := [m for m in ends if m not in self.marks]:
            self.marks.update(self._ask(new))
        cores = self.learn(core.dictionary.to_numpy(zero_copy_only=False).tolist())
        return pc.binary_join_element_wise(pa.array(cores, pa.large_binary()).take(core.indices),
                                           pa.array([self.marks[m] for m in ends], pa.large_binary()).take(end.indices),
                                           pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        if len(self.known) > CACHE_WORDS:  # words still in use come back from the old ones
            self.known, self.old = {"": b""}, self.known
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        for blank in "\t\n\r":
            texts = pc.replace_substring(texts, blank, " ")
        split = pc.split_pattern(texts, " ")
        words = split.flatten().dictionary_encode()
        ids = self._word_ids(words.dictionary).take(words.indices)
        _, ends, raw = ids.buffers()  # the ids of all words in a row, and where each word's end
        ends = np.frombuffer(ends, np.int64)[ids.offset:ids.offset + len(ids) + 1][split.offsets.to_numpy()].tolist()
        raw = memoryview(raw or b"")
        return [bytes(raw[a:b]) for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """One for each worker process, so that its words serve all its tasks."""
    return WordTokenizer(path)


def _byte_letters() -> str:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, as code points from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in printable)}
    return "".join(chr(other.get(b, b)) for b in range(256))


_BYTE_LETTERS = _byte_letters()


def _groups(lengths: list[int], size: int = 1 << 22):
    """Runs of texts with about ``size`` bytes each."""
    first = total = 0
    for i, n in enumerate(lengths):
        total += n
        if total >= size:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(lengths):
        yield first, len(lengths)


def _cutter(path: str):
    def run(batches):
        tok, part, ranks = word_tokenizer(path), TaskContext.get().partitionId(), Counter()
        end = np.array([END_ID], tok.kind).tobytes()
        size = len(end)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), pc.fill_null(batch.column(1), "")
            for a, b in _groups(pc.binary_length(texts).to_pylist()):
                out = {"doc_id": [], "start": [], "length": [], "doc_tokens": [], "part": [], "rank": [], "ids": []}
                for doc_id, raw in zip(ids[a:b], tok.encode(texts[a:b])):
                    raw += end
                    n = len(raw) // size
                    for start in range(0, n, WINDOW):
                        m = min(WINDOW, n - start)
                        for k, v in zip(out, (doc_id, start, m, n, part, ranks[m],
                                              raw if m == n else raw[size * start:size * (start + m)])):
                            out[k].append(v)
                        ranks[m] += 1
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(v, pa.int64()) for k, v in out.items() if k != "ids"),
                     pa.array(out["ids"], pa.binary())], names=list(out))
    return run


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lawson and Hanson's active-set method for min |a x - b|, x >= 0."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tol, ridge = 1e-8 * max(1.0, np.abs(b).max(initial=0)), 1e-9
    for _ in range(3 * a.shape[0]):
        w = a.T @ (b - a @ x)
        w[active] = -np.inf
        j = int(w.argmax())
        if w[j] <= tol:
            break
        active[j] = True
        while True:
            at = np.flatnonzero(active)
            part = a[:, at]
            s = np.linalg.solve(part.T @ part + ridge * np.eye(len(at)), part.T @ b)
            if s.min() > 0:
                x[:] = 0
                x[at] = s
                break
            low = s <= 0
            step = (x[at][low] / (x[at][low] - s[low] + 1e-300)).min()
            x[at] += step * (s - x[at])
            active[at[x[at] <= 1e-12]] = False
            x[~active] = 0
            if not active.any():
                return x
    return x


def combinations(bins: list[int], top: int) -> list[tuple[int, ...]]:
    """One to three of ``bins`` that add up to ``top``."""
    there, out = set(bins), []
    for i in bins:
        if i == top:
            out.append((i,))
        for j in bins:
            if j > i:
                break
            if i + j == top:
                out.append((i, j))
            k = top - i - j
            if 0 < k <= j and k in there:
                out.append((i, j, k))
    return out


def solve(histogram: dict[int, int]) -> list[tuple[list[tuple[int, int]], int]]:
    """Length -> count, to patterns ([(length, times), ...], repeats) that use every
    piece once and hold at most WINDOW tokens each."""
    left = Counter({k: v for k, v in histogram.items() if v > 0})
    queues: dict[int, list[int]] = defaultdict(list)
    for length in sorted(left, reverse=True):
        queues[-(-length // BIN)].append(length)
    bins = sorted(queues)
    combos = combinations(bins, WINDOW // BIN)
    opened: list[tuple[list[int], int]] = []
    if combos:
        row = {b: i for i, b in enumerate(bins)}
        a = np.zeros((len(bins), len(combos)))
        for c, combo in enumerate(combos):
            for b in combo:
                a[row[b], c] += 1
        weight = np.array(bins, float)[:, None] / (WINDOW // BIN)  # a token left over counts alike in every bin
        counts = np.array([sum(left[n] for n in queues[b]) for b in bins], float)
        repeats = np.floor(nnls(a * weight, counts * weight[:, 0]) + 1e-6).astype(int)
        for c in np.flatnonzero(repeats):
            want = int(repeats[c])
            while want > 0:
                pick: list[int] = []
                for b in combos[c]:
                    there = next((n for n in queues[b] if left[n] > pick.count(n)), None)
                    if there is None:
                        break
                    pick.append(there)
                if len(pick) < len(combos[c]):
                    break
                m = min(want, *(left[n] // k for n, k in Counter(pick).items()))
                for n in pick:
                    left[n] -= m
                opened.append((pick, m))
                want -= m
    lengths = sorted((n for n in left if left[n] > 0))
    done: Counter = Counter()

    def fill(content: list[int], m: int) -> None:
        stack = [(content, m, lengths)]
        while stack:
            content, m, _ = stack.pop()
            gap = WINDOW - sum(content)
            at = np.searchsorted(lengths, gap, side="right") - 1
            while at >= 0 and left[lengths[at]] == 0:
                lengths.pop(at)
                at -= 1
            if at < 0:
                done[tuple(content)] += m
                continue
            n = lengths[at]
            q = gap // n
            if left[n] < q * m:  # not enough to give each its most
                if m > 1 and left[n] >= q:
                    stack.append((content, m - left[n] // q, lengths))
                    m = left[n] // q
                elif m > 1:
                    stack.append((content, m - 1, lengths))
                    m, q = 1, left[n]
                else:
                    q = left[n]
            left[n] -= q * m
            stack.append((content + [n] * q, m, lengths))

    for content, m in opened:
        fill(content, m)
    while lengths:
        n = lengths[-1]
        if left[n] == 0:
            lengths.pop()
            continue
        fill_times = max(1, min(left[n], left[n] * n // WINDOW))
        q = min(WINDOW // n, left[n])
        m = max(1, min(left[n] // q, fill_times))
        left[n] -= q * m
        fill([n] * q, m)
    return [(sorted(Counter(c).items(), reverse=True), m) for c, m in done.items()]


class Places:
    """(length, rank among the pieces of that length) -> (sequence, offset)."""

    def __init__(self, patterns: list[tuple[list[tuple[int, int]], int]]):
        rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        used, sequence = Counter(), 0
        for content, repeats in patterns:
            offset = 0
            for length, times in content:
                rows[length].append((used[length], sequence, times, offset))
                used[length] += times * repeats
                offset += times * length
            sequence += repeats
        self.rows = {k: np.array(v, np.int64) for k, v in rows.items()}
        self.sequences = sequence

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for at in np.split(order, cuts) if len(order) else ():
            n = int(length[at[0]])
            seg = self.rows[n]
            hit = seg[np.searchsorted(seg[:, 0], rank[at], side="right") - 1]
            k = rank[at] - hit[:, 0]
            sequence[at] = hit[:, 1] + k // hit[:, 2]
            offset[at] = hit[:, 3] + k % hit[:, 2] * n
        return sequence, offset


def _wide(ids: bytes, tokens: int) -> np.ndarray:
    """Stored ids in four bytes each."""
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * tokens else "<u4").astype("<u4")


def _placer(places: Places, wide: bool, with_ids: bool):
    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            s, o = places(t["length"].to_numpy(), t["rank"].to_numpy())
            t = t.drop_columns(["rank"]).append_column("sequence_id", pa.array(s)).append_column("offset", pa.array(o))
            if wide:
                ids = [_wide(i, n) for i, n in zip(t["ids"].to_pylist(), t["length"].to_pylist())]
                t = t.append_column("ids_crc32", pa.array([crc32(i) for i in ids], pa.int64()))
                t = t.set_column(t.schema.get_field_index("ids"), "ids",
                                 pa.array([i.tobytes() if with_ids else None for i in ids], pa.binary()))
            yield from t.combine_chunks().to_batches()
    return run


def pack(docs: DataFrame, tokenizer_path: str, with_ids: bool = True, wide: bool = True) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per piece: (doc_id, start, length, doc_tokens, ids, sequence_id,
    offset, ids_crc32).

    ``ids`` are little-endian uint32 (null unless ``with_ids``); without ``wide`` they are in two bytes each
    where the vocabulary allows (``id_kind``) and there is no ``ids_crc32``. Each document
    ends with END_ID, so a null or empty text is one piece of one token. Documents up to
    WINDOW tokens stay whole; longer ones are cut every WINDOW tokens. Rows that
    repeat a doc_id are packed each, null ids too; an empty table gives no rows; further columns
    aren't read.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "packing-pieces")
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
     .mapInArrow(_cutter(tokenizer_path),
                 "doc_id long, start long, length long, doc_tokens long, part long, rank long, ids binary")
     .write.option("compression", CODEC).parquet(path))
    pieces = spark.read.parquet(path)
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # The ids stay where they are while their ranks are joined.
    if counts.count() <= BROADCAST_COUNTS:
        first = F.broadcast(first)
    places = Places(solve(histogram))
    ranked = (pieces.join(first, ["part", "length"])
              .select("doc_id", "start", "length", "doc_tokens", "ids", (F.col("first") + F.col("rank")).alias("rank")))
    placed = "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"
    return ranked.mapInArrow(_placer(places, wide, with_ids), placed + ", ids_crc32 long" * wide)


def padded_length(tokens):
    """Length of a sequence with padding: WINDOW, but a power of two stays."""
    return F.when(tokens.cast("long").bitwiseAND(tokens.cast("long") - 1) == 0, tokens).otherwise(WINDOW)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, tokens, padded, ids, pieces): the packed sequences themselves, at most WINDOW ids
    each, with what lies where in them (offset, doc_id, start, length, doc_tokens)."""
    place = ("offset", "doc_id", "start", "length", "doc_tokens")
    parts = F.array_sort(F.collect_list(F.struct(*place, "ids")))
    nothing = F.lit(b"").cast("binary")
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), parts.alias("parts"))
            .select("sequence_id", "tokens", padded_length(F.col("tokens")).alias("padded"),
                    F.aggregate("parts", nothing, lambda done, x: F.concat(done, x["ids"])).alias("ids"),
                    F.transform("parts", lambda x: F.struct(*(x[c].alias(c) for c in place))).alias("pieces")))


_PIECE = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _read_back(batches):
    """Sequences' pieces, with the CRC-32 of their ids in four bytes each."""
    for batch in batches:
        rows = []
        for sequence, tokens, ids, pieces in zip(*(c.to_pylist() for c in batch.columns)):
            held = _wide(ids, tokens)
            for p in pieces:
                own = held[p["offset"]:p["offset"] + p["length"]]
                rows.append((p["doc_id"], p["start"], p["length"], crc32(own), p["doc_tokens"], sequence, p["offset"]))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 7)], names=list(_PIECE))


def packed_pieces(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Packs ``docs``, writes the sequences and reads each piece back from its place in them: (doc_id,
    start, length, ids_crc32, doc_tokens, sequence_id, offset). Nulls, empty and repeated rows as in ``pack``."""
    path = scratch_path(docs.sparkSession, "packing-sequences")
    sequences(pack(docs, tokenizer_path, wide=False)).write.option("compression", CODEC).parquet(path)
    return (docs.sparkSession.read.parquet(path).select("sequence_id", "tokens", "ids", "pieces")
            .mapInArrow(_read_back, ", ".join(f"{c} long" for c in _PIECE)))


__all__ = ["Places", "WordTokenizer", "combinations", "nnls", "pack", "packed_pieces", "padded_length", "sequences", "solve"]
