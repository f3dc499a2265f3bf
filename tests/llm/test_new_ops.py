"""Hard negatives, HyperMinHash near duplicates and the Merkle manifest against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import SCHEMA, jaccard_components, low, sha
from pyspark.sql import functions as F

from neoflow.llm import hyperminhash, merkle
from neoflow.llm.hard_negatives import Kept, Mining, finite, hard_negatives, products, quantised, slots, suffix_answers


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], SCHEMA)


# ----------------------------------------------------------- hard negatives

ROWS = "id long, label long, vector array<long>, anchor boolean"


def brute_negatives(rows, m=Mining()):
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    out = []
    for a in (r for r in rows if r[3]):
        others = sorted((r for r in rows if r[0] != a[0]), key=lambda r: (-score(a, r), r[0]))
        for p in [r for r in others if r[1] == a[1]][:m.positives]:
            sp = score(a, p)
            window = [r for r in others if r[1] != a[1] and m.low * sp <= 100 * score(a, r) <= m.high * sp]
            out += [(a[0], p[0], k, r[0], sp, score(a, r)) for k, r in enumerate(window[:m.negatives], 1)]
    return sorted(out)


def mined(spark, rows, m=Mining()):
    return sorted(map(tuple, hard_negatives(spark.createDataFrame(rows, ROWS), m).collect()))


def test_negatives_against_all_pairs(spark):
    rng = random.Random(3)
    # small numbers, so that many scores tie; one label has a third of the rows
    rows = [(i, rng.choice([0, 0, 0, 1, 2, 3, 4]), [rng.randint(-2, 4) for _ in range(6)], i % 7 == 0) for i in range(300)]
    assert mined(spark, rows) == brute_negatives(rows) and len(brute_negatives(rows)) > 200
    other = Mining(positives=2, negatives=4, low=80, high=100)
    assert mined(spark, rows, other) == brute_negatives(rows, other)


def test_negatives_edges(spark):
    rows = [(1, 0, [5, 5], True), (2, 0, [4, 4], False), (3, 1, [3, 3], False), (4, 1, [3, 3], False), (5, None, [9, 9], True),
            (None, 1, [3, 3], True), (6, 1, None, False), (7, 1, [None, 3], False), (8, 9, [9, 9], True), (9, 1, [4], False),
            (10, 2, [], False), (3, 1, [3, 3], False), (3, 1, [3, 4], False)]
    clean = [(1, 0, [5, 5], True), (2, 0, [4, 4], False), (3, 1, [3, 3], False), (4, 1, [3, 3], False), (8, 9, [9, 9], True),
             (9, 1, [4, 0], False), (10, 2, [0, 0], False)]
    assert mined(spark, rows) == brute_negatives(clean) != []
    assert mined(spark, []) == [] and mined(spark, rows[1:3]) == []
    extra = spark.createDataFrame(rows, ROWS).withColumns({"x": F.lit(1), "rank": F.lit(2), "cell": F.lit(3), "limits": F.lit(4)})
    assert sorted(map(tuple, hard_negatives(extra).collect())) == brute_negatives(clean)
    v = spark.createDataFrame([([0.5, -0.001],), ([float("nan")],), ([float("inf")],), ([None],), (None,), ([],)], "v array<float>")
    assert [r[0] for r in v.filter(finite(F.col("v"))).select(quantised(F.col("v"))).collect()] == [[128, -1], []]


def test_slots_and_their_merge():
    limits = np.array([[9, 5, 5, -3]])
    assert slots(np.array([[10, 9, 6, 5, 0, -3, -4]]), limits).tolist() == [[-1, 0, 0, 2, 2, 3, 3]]
    m = Mining(positives=2, negatives=2, low=50, high=100)
    rows = [(0, 9, 1), (0, 8, 2), (1, 4, 3), (1, 4, 4)]
    assert suffix_answers([(7, 10), (8, 4)], rows, m) == [(7, 10, [(1, 9), (2, 8)]), (8, 4, [(3, 4), (4, 4)])]
    kept = Kept(2, 2)
    for part in ([0, 0, 1], [5, 7, 1], [9, 8, 7]), ([0, 0], [7, 6], [3, 4]):
        kept.add(*map(np.array, part))
    assert sorted(zip(kept.group.tolist(), kept.score.tolist(), kept.id.tolist())) == [(0, 7, 3), (0, 7, 8), (1, 1, 7)]
    big = np.array([[1 << 40, 3]])
    assert products(big, np.array([[1 << 13, 5]])).tolist() == [[(1 << 53) + 15]]
    with pytest.raises(OverflowError):
        products(big, big)


# -------------------------------------------------------------- HyperMinHash

def near(spark, rows, **k):
    got = hyperminhash.component_ids(frame(spark, rows), **k).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}, {r["doc_id"]: r["kept"] for r in got}


def changed(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10 ** 6)}"
    return words


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(5)
    rows, base = [], [[f"v{rng.randrange(40)}" for _ in range(rng.choice([3, 4, 5, 6, 9, 20, 60, 150]))] for _ in range(40)]
    for i in range(400):  # groups of copies at all similarities, some hot
        words = base[min(rng.randrange(40), rng.randrange(40))]
        rows.append((1000 - i, " ".join(changed(words, rng, rng.choice([0, 0, 1, 1, 2, 3, 5])))))
    want = jaccard_components(rows, 4, 80, 100)
    got, kept = near(spark, rows)
    assert got == want and kept == {i: i == c for i, (_, c) in want.items()}
    assert len({c for _, c in want.values()}) < 350


def test_chain_of_near_copies_is_one_component(spark):
    words = [f"v{i}" for i in range(300)]
    chain = [words[2 * i:2 * i + 100] for i in range(60)]  # neighbours link, those far apart share nothing
    rows = [(i, " ".join(w)) for i, w in enumerate(chain)]
    assert near(spark, rows)[0] == jaccard_components(rows, 4, 80, 100) == {i: (97, 0) for i in range(60)}


def test_near_duplicate_edges(spark):
    rows = [(5, "a b c d e"), (4, "A B C D E"), (3, None), (2, ""), (1, " \t\n"), (9, "a b"), (8, "a  b"), (7, "a b c"),
            (6, "x " * 60_000), (10, "x x x x x")]
    got, kept = near(spark, rows)
    assert got == jaccard_components(rows, 4, 80, 100) and kept[4] and not kept[5] and kept[3] and kept[2]
    assert near(spark, []) == ({}, {})
    odd = frame(spark, [(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (None, None)]).withColumns(
        {"name": F.lit("n"), "tkey": F.lit(1), "key": F.lit(2), "n": F.lit(3), "registers": F.lit(4)})
    out = sorted(((str(r.doc_id), r.component_id, r.kept) for r in hyperminhash.component_ids(odd).collect()), key=str)
    assert out == [("5", 5, True), ("5", 5, True), ("None", 5, False), ("None", None, False)]
    negative = near(spark, [(-3, "a b c d e"), (2, "a b c d e"), (-9, "q")])[0]
    assert negative == {-3: (2, -3), 2: (2, -3), -9: (1, -9)}


def test_registers_and_the_correction_for_chance():
    rng = np.random.default_rng(0)
    draw = lambda n: np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
    for n, m in ((1, 1), (5, 4), (200, 260)):
        equal = [(hyperminhash.registers(draw(n)) == hyperminhash.registers(draw(m))).sum() for _ in range(1500)]
        chance = float(hyperminhash.by_chance(n, m))
        assert 0.7 * chance < np.mean(equal) / hyperminhash.BUCKETS < 1.3 * chance
    for n in (5, 500):
        errors = []
        for _ in range(200):
            s = draw(int(n * 1.2))
            a, b = s[:n], s[len(s) - n:]
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            equal = (hyperminhash.registers(a) == hyperminhash.registers(b)).sum()
            errors.append(hyperminhash.similarity(equal, n, n) - true)
        assert abs(np.mean(errors)) < 0.01 and np.abs(errors).max() < hyperminhash.MARGIN
    one = hyperminhash.registers(np.array([7], np.uint64))
    assert one.dtype == np.uint16 and len(one) == hyperminhash.BUCKETS


# ------------------------------------------------------------------- Merkle

def brute_manifest(rows, changes=lambda i, text: text):
    """{(doc_id, leaf): (subroot, root, proof_sha256, folded)} of unique rows (doc_id, text, lang, source, n_chars)."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha("".join(map(part, (r[0], r[3], r[2], r[4], text))))

    def up(nodes):
        """Root and each node's steps."""
        steps, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
        while len(level) > 1:
            for i, a in enumerate(at):
                run = a // 8 * 8
                steps[i].append((level[run:a], level[a + 1:run + 8]))
            at, level = [a // 8 for a in at], [sha("".join(level[i:i + 8])) for i in range(0, len(level), 8)]
        return level[0], steps
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for g in langs}
    own = {g: up([leaf(r, r[1]) for r in t]) for g, t in trees.items()}
    root, top = up([own[g][0] for g in langs])
    out = {}
    for g, above in zip(langs, top):
        for r, steps in zip(trees[g], own[g][1]):
            now, proof = leaf(r, changes(r[0], r[1])), ""
            for left, right in steps + above:
                now, proof = sha("".join(left) + now + "".join(right)), proof + "".join(left + right)
            out[r[0], leaf(r, r[1])] = (own[g][0], root, sha(proof), now)
    return out


def found(spark, rows, changed=None):
    got = merkle.documents_manifest(spark.createDataFrame(rows, SCHEMA), changed).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("p"),
        merkle.folded(F.col("given"), F.col("proof")).alias("f")).collect()
    return {(r.doc_id, r.leaf): (r.subroot, r.root, r.p, r.f) for r in got}, len(got)


def test_manifest_against_brute_force(spark):
    """Trees of one block and of several (two rounds, the last subtree cut short), a lone leaf, a null language."""
    rng = random.Random(1)
    langs = ["big"] * 4700 + ["mid"] * 600 + ["é"] * 9 + ["z"] + [None] * 8 + ["", "A", "a"]
    rows = [(i * 3 - 500, f"Text {i % 50}" if i % 11 else None, g, rng.choice(["s", None]), rng.choice([i, None]))
            for i, g in enumerate(langs)]
    rng.shuffle(rows)
    want = brute_manifest(rows, lambda i, text: low(text) if text is not None and i % 2 == 0 else text)
    got, n = found(spark, rows, F.when(F.col("doc_id") % 2 == 0, F.lower("text")).otherwise(F.col("text")))
    assert got == want and n == len(rows)
    roots = {v[1] for v in got.values()}
    assert len(roots) == 1 and 0 < sum(v[3] in roots for v in got.values()) < n


def test_manifest_edges(spark):
    assert found(spark, []) == ({}, 0)
    one = [(1, "x", "en", None, 1)]
    got, _ = found(spark, one)
    [((_, leaf), value)] = got.items()
    assert value == (leaf, leaf, sha(""), leaf) and got == brute_manifest(one)
    odd = [(None, None, None, None, None), (None, "", None, None, None), (2, "é" * 50_000, "en", "s", -1), (3, "b", "en", "s", 0)]
    assert found(spark, odd)[0] == brute_manifest(odd)
    twice = spark.createDataFrame(odd + odd, SCHEMA).withColumns({"tree": F.lit(1), "block": F.lit(2), "root": F.lit(3)})
    got = merkle.documents_manifest(twice).select("*", merkle.folded(F.col("leaf"), F.col("proof")).alias("f")).collect()
    assert len(got) == 8 and all(r.f == r.root for r in got) and len({r.root for r in got}) == 1


def test_columns_in_the_order_of_the_contract(spark):
    [row] = spark.createDataFrame([(1, "té")], "a long, b string").select(merkle.leaf("a", F.lit(None), "b").alias("h")).collect()
    assert row.h == sha("1:1-3:té")
