"""Exact dedup, suffix dedup and the Jaccard join against brute force, with edge rows."""

import itertools
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from helpers import SCHEMA, exact_groups, jaccard_components, remove_repeats, sha

from neoflow.llm import golomb, jaccard_join, suffix_dedup
from neoflow.llm.components import components
from neoflow.llm.exact_dedup import drop_copies, exact_dedup
from neoflow.llm.jaccard_join import Index, Threshold, band_of, component_ids, keep_one
from neoflow.llm.suffix_dedup import equal_runs, merged

SF001 = "/root/testdata/sf0.001"


def frame(spark, rows):
    """Documents with clashing extra columns."""
    df = spark.createDataFrame([(i, t, "xx", "s", 0) for i, t in rows], SCHEMA)
    from pyspark.sql import functions as F
    return df.withColumns({"key": F.lit("k"), "sha": F.lit(1), "kept": F.lit("x"), "fp": F.lit(2), "n": F.lit(3)})


def prose(n, seed, words=60):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(words)]
    return [rng.choice(pool) for _ in range(n)]


@pytest.fixture(scope="module")
def near_rows():
    """Texts in families that differ in a few words, copies, short, empty and null ones."""
    rng, rows, i = random.Random(4), [], 0
    for family in range(12):
        base = prose(rng.choice([4, 9, 30, 120, 400]), family, 500)
        for _ in range(8):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                at = rng.randrange(len(w))
                w[at:at + 1] = [rng.choice(["zz", "yy zz", ""])]
            rows.append((i, rng.choice([str.upper, str])(" ".join(w))))
            i += 1
    return rows + [(i, None), (i + 1, ""), (i + 2, " \n"), (i + 3, "one"), (i + 4, "ONE"), (i + 5, "one two")]


def test_rice_codes():
    rng = np.random.default_rng(0)
    for values in ([], [0], [5, 5, 5], [0, 1 << 40], sorted(rng.integers(0, 1 << 35, 1000).tolist()), [7] * 300):
        assert golomb.rice_decode(golomb.rice_encode(np.array(values, dtype=np.int64))).tolist() == list(values)


def test_owners_get_each_value_of_a_chunk_once():
    """A third of all rows are copies: an owner decodes one value for them, and answers for every row."""
    rng = np.random.default_rng(4)
    universe = golomb.Universe(30_000, 1)
    fp = rng.integers(0, 1 << 64, 20_000, dtype=np.uint64)
    chunks = [np.concatenate([part, np.full(5_000, 77, np.uint64)]) for part in (fp[:10_000], fp[9_000:])]
    rows = [(0, c, owner, at, blob) for c, part in enumerate(chunks) for owner, at, blob in universe.messages(part)]
    assert sum(len(golomb.counted_decode(r[4])[0]) for r in rows) <= 21_002
    group = golomb.pd.DataFrame([(r[0], r[1], r[2], r[4]) for r in rows], columns=["sender", "chunk", "owner", "blob"])
    maps = golomb._answer(group)["bitmap"]
    places = [universe.place(c)[1] for c in chunks]
    values, counts = np.unique(np.concatenate(places), return_counts=True)
    for (_, c, _, at, blob), bitmap in zip(rows, maps):
        value, hit = golomb.answered(blob, bitmap)
        assert (value == places[c][at]).all() and (hit == np.isin(value, values[counts > 1])).all()


def test_exact_dedup_edges(spark):
    rows = [(1, "Ab"), (2, "aB"), (3, None), (4, ""), (5, "é"), (6, "É"), (7, "ab"), (8, "x" * 300_000), (9, "X" * 300_000)]
    got = {r["doc_id"]: r for r in exact_dedup(frame(spark, rows)).collect()}
    want = exact_groups(rows)
    assert {i: (r["keep_id"], r["group_size"]) for i, r in got.items()} == want
    assert {i for i, r in got.items() if r["kept"]} == {k for k, _ in want.values()}
    assert got[2]["sha"].hex() == sha("ab")
    assert exact_dedup(frame(spark, rows[:0])).count() == 0


def test_exact_dedup_repeated_rows_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "c"), (2, "d")]
    got = exact_dedup(frame(spark, rows)).collect()
    assert len(got) == 6 and sum(r["kept"] for r in got) == 4
    left = drop_copies(frame(spark, rows))
    assert left.columns == frame(spark, rows[:0]).columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in left.collect()))) == sorted(
        map(str, [(1, "a"), (1, "b"), (None, "c"), (2, "d")]))


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)]
    edges += [(7, 7), (3, None)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        if b is not None and a != b:
            up[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for x in list(up)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 80, 100)])
def test_jaccard_join(spark, near_rows, n, num, den):
    want = jaccard_components(near_rows, n, num, den)
    got = {r[0]: (r[1], r[2]) for r in component_ids(frame(spark, near_rows), n, num, den).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(near_rows) - 20
    left = {r["doc_id"] for r in keep_one(frame(spark, near_rows), n, num, den).collect()}
    assert left == {i for i, (_, c) in want.items() if c == i}


def test_jaccard_edges(spark):
    assert component_ids(frame(spark, [])).count() == 0
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "q"), (2, "r"), (3, None), (None, None)]
    got = sorted(map(str, map(tuple, component_ids(frame(spark, rows)).collect())))
    assert got == sorted(map(str, [(1, 2, 1), (1, 2, 1), (None, 2, 1), (2, 1, 2), (2, 1, 2), (3, 0, 3), (None, 0, None)]))
    assert sorted(map(str, (r["doc_id"] for r in keep_one(frame(spark, rows)).collect()))) == sorted(
        map(str, [1, 2, 2, 3, None]))


def test_linked_sets_share_a_signature():
    """At the largest difference allowed, also where segments are allotted 2."""
    rng = np.random.default_rng(1)
    t = Threshold(90, 100)
    for sets in (1, 10 ** 9, 10 ** 12):
        for size in (10, 19, 20, 37, 60, 150, 700):
            index = Index({b: sets for b in range(band_of(size) + 3)}, t)
            for _ in range(30):
                pool = np.unique(rng.integers(0, 1 << 63, 2 * size, dtype=np.uint64))
                a = np.sort(rng.choice(pool, size, replace=False))
                more = int(rng.integers(0, size // 9 + 1))
                drop = max(0, int(t.differ(size, size + more)) - more) // 2
                b = np.sort(np.concatenate([rng.permutation(a)[drop:],
                                            np.setdiff1d(pool, a)[:drop + more]]))
                both = len(np.intersect1d(a, b))
                if t.linked(both, len(a), len(b)):
                    assert np.intersect1d(index.signatures(a), index.signatures(b)).size


def linked_pairs(t, size, n, rng):
    """Pairs of sets that differ in as many tokens as they may, tokens missing from either in turn."""
    while n:
        pool = np.unique(rng.integers(0, 1 << 64, 2 * size, dtype=np.uint64))
        a = np.sort(rng.choice(pool, size, replace=False))
        more = int(rng.integers(0, t.largest(size) - size + 1))
        drop = max(0, int(t.differ(size, size + more)) - more) // 2
        b = np.sort(np.concatenate([rng.permutation(a)[drop:], rng.permutation(np.setdiff1d(pool, a))[:drop + more]]))
        if t.linked(len(np.intersect1d(a, b)), len(a), len(b)):
            n -= 1
            yield a, b


def test_linked_small_sets_share_a_signature_with_any_number_of_sets():
    """Empty segments that are allotted 2 too: their number grows with that of the sets."""
    rng, t = np.random.default_rng(2), Threshold(80, 100)
    lost = {}
    for sets in (10 ** 5, 10 ** 6, 10 ** 7, 10 ** 8, 10 ** 9):
        for size in range(4, 17):
            index = Index({b: sets for b in range(band_of(size) + 3)}, t)
            n = sum(not np.intersect1d(index.signatures(a), index.signatures(b)).size
                    for a, b in linked_pairs(t, size, 200, rng))
            if n:
                lost[sets, size] = n
    assert not lost


def test_unlike_sets_share_no_empty_segment():
    rng, t = np.random.default_rng(3), Threshold(80, 100)
    index = Index({b: 10 ** 4 for b in range(20)}, t)
    for size in (60, 163, 291, 402, 523):
        sigs = np.concatenate([np.unique(index.signatures(np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))))
                               for _ in range(500)])
        assert np.unique(sigs, return_counts=True)[1].max() <= 5


def test_large_group_of_one_segment_in_blocks(spark, near_rows, monkeypatch):
    """Every two sets meet once, whatever the number of blocks; the links are the same."""
    rows = [(7, i, i) for i in range(60)] + [(8, i, i) for i in range(3)]
    placed = spark.createDataFrame(rows, "sig long, sid long, component long")
    sizes = spark.createDataFrame([(7, 60), (8, 3)], "sig long, sets long")
    monkeypatch.setattr(jaccard_join, "MEET", 9)
    groups: dict = {}
    for r in jaccard_join.in_blocks(placed, sizes).collect():
        groups.setdefault((r["sig"], r["low"], r["high"]), []).append((r["sid"], r["block"]))
    met = [(sig, *sorted((a, b))) for (sig, low, high), g in groups.items()
           for (a, x), (b, y) in itertools.combinations(g, 2) if low == high or x != y]
    assert sorted(met) == [(s, a, b) for s, n in ((7, 60), (8, 3)) for a, b in itertools.combinations(range(n), 2)]
    assert max(map(len, groups.values())) < 40
    monkeypatch.setattr(jaccard_join, "MEET", 2)
    got = {r[0]: (r[1], r[2]) for r in component_ids(frame(spark, near_rows), 3, 60, 100).collect()}
    assert got == jaccard_components(near_rows, 3, 60, 100)


def test_suffix_dedup_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert spans_of(docs) == remove_repeats(rows)


def spans_of(docs):
    return {r["doc_id"]: (r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]),
                          r["kept_sha"].hex()) for r in suffix_dedup.remove_repeats(docs).collect()}


@pytest.mark.parametrize("hot, linked, group", [(4_000, 16, 20_000), (2, 1, 20_000), (4_000, 16, 3)])
def test_suffix_dedup_edges(spark, monkeypatch, hot, linked, group):
    """Edges of texts, periodic texts, hot cores, shared passages, strings one byte too short."""
    for name, value in (("HOT", hot), ("LINKED", linked), ("GROUP", group)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(9)
    words = lambda n: " ".join(prose(n, rng.random(), 900))
    shared, line = words(40)[:150], words(12)[:60]
    rows = [(0, None), (1, ""), (2, "a" * 99), (3, "a" * 350), (4, "ab" * 120), (5, words(30) + shared), (6, shared + words(30)),
            (7, words(5) + shared[:100] + words(5)), (8, words(5) + shared[1:100] + "#" + words(5)), (9, shared),
            (10, shared[:100]), (11, "é" * 80), (12, "ü" + "é" * 80), (13, words(2000)), (14, "ab" * 120)]
    rows += [(20 + i, words(20) + line + words(20)) for i in range(8)]
    rows += [(40 + i, rows[13][1][50 * i:50 * i + 400]) for i in range(5)]
    assert spans_of(frame(spark, rows)) == remove_repeats(rows)


def test_suffix_dedup_halves_hot_cores_until_few_meet(spark, monkeypatch):
    """A passage between different words: no shard meets more than HOT of a core, and the result is whole."""
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    monkeypatch.setattr(suffix_dedup, "GROUP", 3)
    kept, written = {}, suffix_dedup._written
    monkeypatch.setattr(suffix_dedup, "_written", lambda df, name: kept.setdefault(name, []).append(
        written(df, name)) or kept[name][-1])
    rng = random.Random(4)
    passage = " ".join(prose(30, 8, 900))[:140]
    rows = [(i, " ".join(prose(12, rng.random(), 900)) + passage + " ".join(prose(12, rng.random(), 900))) for i in range(20)]
    assert spans_of(frame(spark, rows)) == remove_repeats(rows)
    assert len(kept["cores"]) > 1  # rounds of halving
    met = kept["ranges"][0].selectExpr("explode(ranges) AS r").groupBy("r.core").count()
    assert met.filter("count > 3").count() == 0


def test_settled_keeps_one_row_between_batches():
    rows = [(1, 1, 5, 0, 9), (1, 1, 5, 0, 9), (1, 1, 6, 0, 2), (1, 2, 5, 0, 1), (2, 1, 5, 0, 3), (2, 1, 7, 0, 3), (3, 1, 5, 0, 4),
            (3, 3, 5, 0, 6), (3, 4, 5, 0, 7)]
    # equal bytes: all but the first again; the first on if its core has others, each once
    want = [(False, 1, 5, 9), (True, 1, 6, 2), (False, 1, 5, 1), (True, 2, 7, 3), (False, 3, 5, 4), (False, 3, 5, 6), (False, 3, 5, 7)]
    kinds = (pa.int64(),) * 5 + (pa.int8(),) * 2
    names = ["core", "same", "id", "tkey", "place", "low", "high"]
    for size in range(1, len(rows) + 1):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*((*r, 0, 34) for r in rows[i:i + size])), kinds)],
                                              names=names) for i in range(0, len(rows), size)]
        got = [(r["again"], r["core"], r["id"], r["place"]) for b in suffix_dedup._settled(batches) for r in b.to_pylist()]
        assert sorted(got) == sorted(want)


def test_suffix_dedup_repeats_nulls_and_empty(spark):
    text = " ".join(prose(40, 3, 400))
    rows = [(1, text), (1, text), (None, text), (2, "short")]
    got = [(r["doc_id"], len(r["kept"])) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(1, len(text)), (1, len(text)), (None, 0), (2, 5)]))
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_backward_extension_ends_once_no_boundary_is_new(monkeypatch):
    counted, cumsum = [], np.cumsum
    monkeypatch.setattr(np, "cumsum", lambda *a, **k: counted.append(1) or cumsum(*a, **k))
    _, boundary = equal_runs(np.ones(50, np.int64), 2000)
    assert boundary.tolist() == [True] + [False] * 49
    assert len(counted) < 20  # not one for each of 2,000 steps


def test_equal_runs_by_backward_extension():
    rng = np.random.default_rng(3)
    for n, sigma, length in ((1, 2, 3), (60, 2, 5), (300, 3, 9), (200, 1, 17)):
        s = rng.integers(0, sigma, n) + 1
        s[-1] = 0
        order, boundary = equal_runs(s, length)
        heads = [tuple(s[i:i + length]) for i in order]
        assert heads == sorted(heads)
        assert boundary.tolist() == [True] + [a != b for a, b in zip(heads, heads[1:])]


def test_anchors_don_t_depend_on_blocks(monkeypatch):
    text = " ".join(prose(3000, 1, 800)).encode()
    whole = [x.tolist() for x in suffix_dedup.anchors(text)]
    monkeypatch.setattr(suffix_dedup, "BLOCK", 777)
    assert [x.tolist() for x in suffix_dedup.anchors(text)] == whole
    places = np.array(whole[1], dtype=int)
    for i in range(len(text) - suffix_dedup.LENGTH + 1):  # every string holds an anchor
        assert ((places >= i) & (places <= i + suffix_dedup.REACH)).any()


def test_owners_of_anchors_get_even_shares(monkeypatch):
    """Anchors are the least hashes of their surroundings, so owners must not be told by their size."""
    monkeypatch.setattr(suffix_dedup, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [" ".join(prose(400, i, 5_000)).encode() for i in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60), pa.int64())] * 2 + [pa.array(texts, pa.binary())],
                                       names=["id", "tkey", "text"])
    rows = [r for b in suffix_dedup._sender(golomb.Universe(5_000, 25))([batch]) for r in b.to_pylist()]
    sizes = [len(r["place"]) // 8 for r in rows]
    assert len(sizes) == 25 and max(sizes) < 2 * sum(sizes) / 25


def test_owner_looks_at_each_value_once(monkeypatch):
    """An owner's answers cost what its values cost together, not what they cost for every message."""
    rng = np.random.default_rng(8)
    lists = [np.sort(rng.integers(0, 4_000, int(n))) for n in rng.integers(1, 40, 300)]
    sorted_values, unique, isin = [], np.unique, np.isin
    monkeypatch.setattr(golomb.np, "unique", lambda x, *a, **k: sorted_values.append(len(x)) or unique(x, *a, **k))
    monkeypatch.setattr(golomb.np, "isin", lambda x, y, **k: sorted_values.append(len(x) + len(y)) or isin(x, y))
    blobs = [golomb.counted_encode(x) for x in lists]
    sorted_values.clear()
    got = golomb._answer(pd.DataFrame({"sender": range(300), "chunk": 0, "owner": 7, "blob": blobs}))
    assert sum(sorted_values) <= sum(map(len, lists))
    often = Counter(int(v) for x in lists for v in x)
    for x, blob, bitmap in zip(lists, blobs, got["bitmap"]):
        values, hit = golomb.answered(blob, bitmap)
        assert values.tolist() == x.tolist() and hit.tolist() == [often[int(v)] > 1 for v in x]


def test_texts_are_dealt_out_once(spark, monkeypatch):
    """No join with texts shuffles or sorts them, however many rows it has, and groups of one component are not dealt out."""
    made, written = [], suffix_dedup._written
    monkeypatch.setattr(suffix_dedup, "_written", lambda df, name: made.append((name, df)) or written(df, name))
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(suffix_dedup, "LINKED", 1)
    passage = " ".join(prose(40, 8, 900))
    rows = [(i, " ".join(prose(12, i, 900)) + passage + " ".join(prose(12, 50 + i, 900))) for i in range(6)] + [(9, passage), (10, passage)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(before, ("false", "-1")):
        spark.conf.set(k, v)
    try:
        out = suffix_dedup.remove_repeats(frame(spark, rows))
        assert {r["doc_id"]: (r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), r["kept_sha"].hex())
                for r in out.collect()} == remove_repeats(rows)
        joins = 0
        for name, df in [*made, ("out", out)]:
            todo = [df._jdf.queryExecution().executedPlan()]
            while todo:
                node = todo.pop()
                columns = [node.output().apply(i).name() for i in range(node.output().size())]
                assert "text" not in columns or node.nodeName() not in ("Exchange", "BroadcastExchange", "Sort"), name
                assert not (node.nodeName() == "SortMergeJoin" and "large" in columns), name
                joins += node.nodeName() == "ShuffledHashJoin"
                todo += [node.children().apply(i) for i in range(node.children().size())]
        assert joins >= 4  # copies, cores, ranges, runs
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("neoflow_texts")]


def test_joined_makes_maximal_runs_of_each_text():
    rng = random.Random(6)
    lists = [[(a := rng.randrange(300), a + rng.randrange(1, 60)) for _ in range(rng.randrange(12))] for _ in range(40)] + [[]]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(41), pa.int64()), pa.array(range(41), pa.int64()),
         pa.array([[{"start": a, "end": b} for a, b in x] for x in lists], kind)], names=["id", "tkey", "runs"])
    for part in (batch, batch.slice(3, 20), batch.slice(40), batch.slice(0, 0)):
        (got,) = suffix_dedup._joined([part])
        assert got.schema.field("runs").type == kind
        assert [(r["id"], [(x["start"], x["end"]) for x in r["runs"]]) for r in got.to_pylist()] == [
            (i, merged(lists[i])) for i in part.column(0).to_pylist()]


def test_merged_runs():
    assert merged([(5, 9), (0, 3), (3, 4), (6, 12)]) == [(0, 4), (5, 12)]
