"""Toxicity: a convolutional text classifier trained in numpy.

A word's embedding is the sum of three hashed rows (the word, its first 4 bytes
and its first 6). Filters of widths 1, 2 and 3 slide over the words,
each filter's largest answer over the whole text is kept, a logistic layer
joins them. Thresholds are calibrated for each language, which is guessed
from the text's function words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neoflow.llm.labelled import held_out, training_rows

#: Labelled documents of each class it is fitted on, at most.
TRAIN_PER_CLASS = 3_000
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 15, 12, 8, (1, 2, 3)
PIECES = 3
#: What a clean text marked weighs against a toxic one missed (both as shares of their class).
FALSE_ALARM = 3.0
#: Words of a training document at most; longer labelled documents aren't fitted on (all are scored whole).
TRAIN_WORDS = 4_000
#: Distinct words whose filter answers a task keeps.
CACHE_WORDS = 1 << 19
PAD = max(WIDTHS) - 1

_WORD = re.compile(r"\w+")

# Frequent function words of the languages thresholds are calibrated for.
FUNCTION_WORDS = {
    "en": frozenset("the of and to in that is was for it with as his on be at by this are from".split()),
    "de": frozenset("der die und das von zu mit sich des auf ist im dem nicht ein eine als auch es an".split()),
    "fr": frozenset("de la le et les des en un du une que est pour qui dans par plus pas au sur".split()),
    "es": frozenset("de la que el en y los se del las un por con una su para es al lo como".split()),
}
ALL_FUNCTION_WORDS = frozenset().union(*FUNCTION_WORDS.values())
#: The guess is the language most of whose function words occur, the last one if none does.
LANGUAGES = [*FUNCTION_WORDS, "other"]


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def buckets(word: str) -> tuple[int, ...]:
    """Rows of the embedding table for a word; 0 is the empty row."""
    raw = word.encode("utf-8", "surrogatepass")
    return (1 + crc32(raw, 1) % (BUCKETS - 1), 1 + crc32(raw[:4], 2) % (BUCKETS - 1),
            1 + crc32(raw[:6], 3) % (BUCKETS - 1))


def _rows(n: int, rng) -> np.ndarray:
    table = rng.normal(0, 0.1, (n, DIM)).astype(np.float32)
    table[0] = 0
    return table


@dataclass
class Net:
    table: np.ndarray
    filters: list[np.ndarray]          # for each width: (width, DIM, FILTERS)
    bias: list[np.ndarray]
    out: np.ndarray
    base: float
    cuts: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))
    constant: float | None = None

    def word_answers(self, ids: np.ndarray) -> np.ndarray:
        """(words, PIECES) bucket rows -> (words, sum of widths * FILTERS): what each word
        adds to each filter at each of its places."""
        e = self.table[ids].sum(1)
        return np.concatenate([e @ w[o] for w in self.filters for o in range(len(w))], axis=1)

    def logit(self, answers: np.ndarray) -> float:
        """``answers``: a row for each word of one document, in order; PAD empty words follow."""
        n, k, best = len(answers), 0, []
        for w, b in zip(WIDTHS, self.bias):
            total = answers[:, k * FILTERS:(k + 1) * FILTERS]
            if w > 1:
                total = total.copy()
            for o in range(1, w):
                total[: max(0, n - o)] += answers[o:, (k + o) * FILTERS:(k + o + 1) * FILTERS]
            k += w
            best.append(np.maximum((total.max(0) if n else 0) + b, 0))
        return float(np.concatenate(best) @ self.out + self.base)

    def probability(self, logits: np.ndarray, langs: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(logits), self.constant)
        return 1.0 / (1.0 + np.exp(-np.clip(logits - self.cuts[langs], -40, 40)))


class Vocabulary:
    """Numbers words from 1 on; ``rows`` are their bucket rows, row 0 the empty word's."""

    def __init__(self):
        self.at: dict[str, int] = {}

    def number(self, words: list[str]) -> np.ndarray:
        at = self.at
        return np.fromiter((at.setdefault(w, len(at) + 1) for w in words), np.int32, len(words))

    def rows(self) -> np.ndarray:
        out = np.zeros((len(self.at) + 1, PIECES), np.int32)
        for w, i in self.at.items():
            out[i] = buckets(w)
        return out


def train(docs: list[np.ndarray], ids: np.ndarray, y: np.ndarray, epochs: int | None = None, batch: int = 32, rate: float = 0.1,
          seed: int = 3) -> Net:
    """Adagrad on the class-balanced logistic loss over documents of word numbers. With one class only, every score is
    that class; without rows, 0."""
    rng = np.random.default_rng(seed)
    epochs = epochs or min(14, max(7, 36_000 // max(1, len(docs))))  # few documents are gone over more often
    net = Net(_rows(BUCKETS, rng), [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
              [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
              np.abs(rng.normal(0, 0.3, FILTERS * len(WIDTHS))).astype(np.float32)
              * np.resize([1, 1, -1], FILTERS * len(WIDTHS)).astype(np.float32), 0.0)
    if len(set(y.tolist())) < 2:
        net.constant = float(y[0]) if len(y) else 0.0
        return net
    seqs = [np.concatenate([d, np.zeros(PAD, d.dtype)]) for d in docs]
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    sums = {"table": np.full((BUCKETS, 1), 1e-6, np.float32), "out": np.full_like(net.out, 1e-6), "base": 1e-6}
    fsum, bsum = [np.full_like(w, 1e-6) for w in net.filters], [np.full_like(b, 1e-6) for b in net.bias]
    for epoch in range(epochs):
        lr = rate / (1 + epoch * 0.3)
        order = rng.permutation(len(seqs))
        for start in range(0, len(order), batch):
            some = order[start:start + batch]
            tokens = np.concatenate([seqs[i] for i in some])
            ends = np.cumsum([len(seqs[i]) for i in some])
            starts = np.concatenate([[0], ends[:-1]])
            uniq, inv = np.unique(tokens, return_inverse=True)
            e = net.table[ids[uniq]].sum(1)
            hidden, where = [], []
            for w, f, b in zip(WIDTHS, net.filters, net.bias):
                total = (e @ f[0])[inv]
                for o in range(1, w):
                    total[:-o] += (e @ f[o])[inv[o:]]
                # windows that would leave the document lie in its padding
                arg = np.stack([s + total[s:t - PAD if t - PAD > s else s + 1].argmax(0)
                                for s, t in zip(starts, ends)])
                where.append(arg)
                hidden.append(np.take_along_axis(total, arg, 0) + b)
            h = np.concatenate(hidden, 1)
            r = np.maximum(h, 0)
            p = 1 / (1 + np.exp(-np.clip(r @ net.out + net.base, -30, 30)))
            dz = ((p - y[some]) * weight[some] / len(some)).astype(np.float32)
            dh = (dz[:, None] * net.out) * (h > 0)
            d_out, d_base = r.T @ dz, float(dz.sum())
            de = np.zeros_like(e)
            for j, (w, f, b, arg) in enumerate(zip(WIDTHS, net.filters, net.bias, where)):
                g = dh[:, j * FILTERS:(j + 1) * FILTERS]
                for o in range(w):
                    u = inv[np.minimum(arg + o, len(inv) - 1)]
                    df = np.einsum("nf,nfd->df", g, e[u])
                    np.add.at(de, u, g[:, :, None] * f[o].T[None])
                    fsum[j][o] += df * df
                    f[o] -= lr * df / np.sqrt(fsum[j][o])
                db = g.sum(0)
                bsum[j] += db * db
                b -= lr * db / np.sqrt(bsum[j])
            sums["out"] += d_out * d_out
            net.out -= lr * d_out / np.sqrt(sums["out"])
            sums["base"] += d_base * d_base
            net.base -= lr * d_base / np.sqrt(sums["base"])
            moved = np.flatnonzero(np.abs(de).sum(1))
            flat = ids[uniq[moved]].ravel()
            grad = np.repeat(de[moved], PIECES, axis=0)
            rows, at = np.unique(flat, return_inverse=True)
            acc = np.zeros((len(rows), DIM), np.float32)
            np.add.at(acc, at, grad)
            sums["table"][rows, 0] += (acc * acc).mean(1)
            net.table[rows] -= lr * acc / np.sqrt(sums["table"][rows])
            net.table[0] = 0
    return net


def best_cut(logits: np.ndarray, y: np.ndarray) -> float | None:
    """Logit with the least share of toxic texts missed plus FALSE_ALARM times that of clean ones marked, in the middle of equally good ones; None without both classes."""
    if (y == 1).sum() < 8 or (y == 0).sum() < 8:
        return None
    s = np.sort(logits)
    cuts = np.concatenate([[s[0] - 1], (s[1:] + s[:-1]) / 2, [s[-1] + 1]])
    pos, neg = np.sort(logits[y == 1]), np.sort(logits[y == 0])
    wrong = np.searchsorted(pos, cuts) / len(pos) + FALSE_ALARM * (1 - np.searchsorted(neg, cuts) / len(neg))
    best = cuts[wrong <= wrong.min() + 1e-12]
    return float((best[0] + best[-1]) / 2)


class _Known(dict):
    """Word -> row, given out on first sight; ``fresh`` has the words without answers yet."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self)
        self.fresh.append(word)
        return row


class Scorer:
    """Scores texts one by one. The filter answers of seen words are kept; beyond
    CACHE_WORDS words it starts afresh with the next text."""

    def __init__(self, net: Net):
        self.net = net
        self._reset()

    def _reset(self) -> None:
        self.known = _Known()
        self.answers = np.empty((CACHE_WORDS // 8, sum(WIDTHS) * FILTERS), np.float32)
        self.langs = np.empty((len(self.answers), len(FUNCTION_WORDS)), np.uint8)

    def __call__(self, text: str | None) -> tuple[float, int]:
        words = words_of(text)
        if len(self.known) > CACHE_WORDS:
            self._reset()
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if fresh := self.known.fresh:
            end = len(self.known)
            while end > len(self.answers):
                self.answers = np.concatenate([self.answers, np.empty_like(self.answers)])
                self.langs = np.concatenate([self.langs, np.empty_like(self.langs)])
            first = end - len(fresh)
            self.answers[first:end] = self.net.word_answers(np.array([buckets(w) for w in fresh]))
            self.langs[first:end] = 0
            for i, w in enumerate(fresh):
                if w in ALL_FUNCTION_WORDS:
                    self.langs[first + i] = [w in own for own in FUNCTION_WORDS.values()]
            fresh.clear()
        counts = self.langs[at].sum(0, dtype=np.int64)
        lang = int(counts.argmax()) if counts.any() else len(counts)
        return self.net.logit(self.answers[at]), lang


def guess(words: list[str]) -> int:
    counts = [sum(map(own.__contains__, words)) for own in FUNCTION_WORDS.values()]
    return counts.index(max(counts)) if any(counts) else len(counts)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Net:
    """Net trained on folds 2 to 4, thresholds calibrated on fold 1 (TRAIN_PER_CLASS rows a
    class; fold 0 is never read)."""
    rows = (training_rows(docs, labels, label, TRAIN_PER_CLASS)
            .filter(F.length("text") <= 30 * TRAIN_WORDS)  # what is too long stays on the executors
            .select("doc_id", "label", "fold", "text").orderBy("doc_id").toLocalIterator())
    vocabulary, sample = Vocabulary(), []
    for r in rows:
        words = words_of(r["text"])
        if len(words) <= TRAIN_WORDS:
            sample.append((r["label"], r["fold"], guess(words), vocabulary.number(words)))
    return fit_sample(sample, vocabulary.rows())


def fit_sample(sample: list[tuple[int, int, int, np.ndarray]], ids: np.ndarray) -> Net:
    """From (label, fold, language, word numbers) of each document."""
    fitted = [r for r in sample if r[1] != 1]
    net = train([r[3] for r in fitted], ids, np.array([r[0] for r in fitted]))
    if net.constant is None:
        held = [r for r in sample if r[1] == 1] or fitted
        z = np.array([net.logit(net.word_answers(ids[r[3]])) for r in held])
        y, lang = np.array([r[0] for r in held]), np.array([r[2] for r in held])
        common = best_cut(z, y)
        common = 0.0 if common is None else common
        for k in range(len(LANGUAGES)):
            own = best_cut(z[lang == k], y[lang == k])
            net.cuts[k] = common if own is None else own
    return net


def _score(net: Net):
    def run(batches):
        scorer = Scorer(net)
        for batch in batches:
            got = [scorer(t.as_py()) for t in batch.column(1)]
            p = net.probability(np.array([g[0] for g in got]), np.array([g[1] for g in got], dtype=int))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p, pa.float64()), pa.array([LANGUAGES[g[1]] for g in got])],
                names=["doc_id", "score", "guessed_language"])
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, guessed_language) for every row of
    ``docs``; null and empty texts are scored as texts without words."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(_score(fit(docs, labels)), "doc_id long, score double, guessed_language string")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), "guessed_language"))
