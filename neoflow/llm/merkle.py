"""Merkle manifest of a dataset, by a butterfly exchange.

Rows are the leaves of one tree a group (say, a language), in key order; the trees'
roots are the leaves of the tree above. Every FANOUT consecutive nodes of a level
have one parent, the SHA-256 of their hex digests.

1. Leaves get their place in their tree by a range sort and a prefix sum over
   the partitions' counts, and are packed in aligned blocks of FANOUT**LEVELS.
   A block's subtree is hashed inside a task.
2. Butterfly: in round r a block swaps the root of the subtree above it with the
   blocks whose r-th digit (base FANOUT) differs, and each of them hashes the
   parent. All blocks below a node so hold its digest and the siblings on the
   way up, after as many rounds as there are levels, and nothing is passed down.
   A subtree that is cut short by the end of its tree has fewer blocks; they
   share out those that would hear from the missing ones.
3. Each block joins its way up to the ways inside it: a proof for each leaf.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from neoflow.llm.golomb import shuffle_width
from neoflow.session import scratch_path

FANOUT = 8
#: Levels hashed inside a block: FANOUT**LEVELS leaves (about 100 bytes each) are one row.
LEVELS = 3
#: Rows (partitions and trees, or trees; under 1 kB each) up to which a join's small side is broadcast.
BROADCAST_ROWS = 20_000
#: Hex digits of a digest.
DIGEST = 64

#: One level of a proof: the run's other digests, left to right, and how many of them are on the left.
STEP = "struct<siblings: string, position: int>"


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(c: Column | str) -> Column:
    """A value as part of a leaf: ``-`` if null, else its length in UTF-8 bytes, ``:`` and its text."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column | str) -> Column:
    """Hex SHA-256 of the fields in their order."""
    return F.sha2(F.concat(*(field(c) for c in columns)), 256)


def levels(nodes: list[str], several: bool) -> list[list[str]]:
    """The levels of a block, leaves first: up to its one root, or, where its tree has ``several``
    blocks, LEVELS above the leaves whether or not one node is left before."""
    out = [nodes]
    while len(out) <= LEVELS if several else len(out[-1]) > 1:
        last = out[-1]
        out.append([_digest("".join(last[i:i + FANOUT])) for i in range(0, len(last), FANOUT)])
    return out


def steps_inside(nodes: list[str], several: bool) -> list[list[dict]]:
    """For each leaf of a block the steps from it to the block's root."""
    tree = levels(nodes, several)
    out = [[{"siblings": "".join(level[run * FANOUT:j] + level[j + 1:(run + 1) * FANOUT]), "position": j % FANOUT}
            for j in range(len(level)) for run in [j // FANOUT]] for level in tree[:-1]]
    return [[step[i // FANOUT ** up] for up, step in enumerate(out)] for i in range(len(nodes))]


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"merkle-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _blocks(leaves: DataFrame) -> DataFrame:
    """``leaves(tree, key, digest, item)`` -> (tree, block, blocks, items): the trees' leaves in the order
    of key and digest, in aligned blocks; ``blocks`` is how many their tree has."""
    width = shuffle_width(leaves)
    order = ["tree", "key", "digest"]
    ranked = _written(leaves.repartitionByRange(width, *order).sortWithinPartitions(*order)
                      .withColumn("part", F.spark_partition_id())
                      .withColumn("row", F.monotonically_increasing_id()), "sorted")
    runs = _written(ranked.groupBy("part", "tree").agg(F.min("row").alias("first"), F.count("*").alias("n")), "runs")
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy("tree")
    places = runs.select(F.col("part").alias("at"), F.col("tree").alias("of"),
                         (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("base"),
                         F.ceil(F.sum("n").over(total) / FANOUT ** LEVELS).alias("blocks"))
    at = (F.col("part") == F.col("at")) & F.col("tree").eqNullSafe(F.col("of"))
    placed = (ranked.join(_small(places, runs.count()), at)
              .withColumn("place", F.col("row") + F.col("base"))
              .withColumn("block", F.floor(F.col("place") / FANOUT ** LEVELS)))
    # A group is one block: FANOUT**LEVELS rows at most.
    return _written(placed.groupBy("tree", "block", "blocks").agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "item"))).alias("items")), "blocks")


def _roots(batches):
    for batch in batches:
        nodes = [_root(n, m) for n, m in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(nodes, pa.string())],
                                         names=["tree", "block", "blocks", "node"])


def _root(nodes: list[str], blocks: int) -> str:
    return levels(nodes, blocks > 1)[-1][0]


def _round(state: DataFrame, r: int) -> DataFrame:
    """Round ``r``: blocks swap ``node`` with those whose r-th digit differs; blocks of trees that
    have fewer levels keep what they have."""
    stride, span = FANOUT ** r, FANOUT ** (r + 1)
    active = F.col("blocks") > stride
    start = F.floor(F.col("block") / stride) * stride
    held = F.least(F.lit(stride), F.col("blocks") - start)  # blocks there are in the sender's subtree
    low = F.explode(F.sequence(F.col("block") - start, F.lit(stride - 1).cast("long"), held))
    sent = (state.filter(active).withColumn("low", low)
            .withColumn("digit", F.explode(F.array(*(F.lit(d) for d in range(FANOUT)))))
            .withColumn("to", F.floor(F.col("block") / span) * span + F.col("digit") * stride + F.col("low"))
            .filter("to < blocks")
            .select("tree", "to", "blocks", F.struct(F.floor((F.col("block") % span) / stride).alias("digit"), "node").alias("part"),
                    F.when(F.col("to") == F.col("block"), F.col("way")).alias("way")))
    kept = state.filter(~active).select("tree", F.col("block").alias("to"), "blocks",
                                        F.struct(F.lit(0).cast("long").alias("digit"), "node").alias("part"), "way")
    heard = (sent.unionByName(kept).groupBy("tree", "to", "blocks")
             .agg(F.sort_array(F.collect_list("part")).alias("parts"), F.first("way", ignorenulls=True).alias("way")))
    own = F.floor((F.col("to") % span) / stride)
    siblings = F.array_join(F.filter("parts", lambda x: x["digit"] != own)["node"], "")
    step = F.struct(siblings.alias("siblings"), own.cast("int").alias("position"))
    return heard.select(
        "tree", F.col("to").alias("block"), "blocks",
        F.when(active, F.sha2(F.array_join(F.col("parts.node"), ""), 256)).otherwise(F.col("parts")[0]["node"]).alias("node"),
        F.when(active, F.concat("way", F.array(step))).otherwise(F.col("way")).alias("way"))


def _butterfly(blocks: DataFrame) -> DataFrame:
    """(tree, block, root, way): for each block its tree's root and the steps from the block's root to it."""
    nodes = blocks.select("tree", "block", "blocks", F.col("items.digest").alias("digests"))
    schema = T.StructType([blocks.schema[c] for c in ("tree", "block", "blocks")]).add("node", "string")
    state = _written(nodes.mapInArrow(_roots, schema), "roots")
    most = state.agg(F.max("blocks")).first()[0] or 1
    state = state.withColumn("way", F.array().cast(f"array<{STEP}>"))
    r = 0
    while FANOUT ** r < most:
        state = _round(state, r)
        r += 1
    return _written(state.select("tree", "block", F.col("node").alias("root"), "way"), "ways")


def _inside(batches):
    """A block a batch, with the steps inside it for each of its leaves."""
    steps = pa.list_(pa.list_(pa.struct([("siblings", pa.string()), ("position", pa.int32())])))
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            ways = steps_inside(one.column(2)[0].as_py(), one.column(1)[0].as_py() > 1)
            yield pa.RecordBatch.from_arrays([one.column(0), *one.columns[3:], pa.array([ways], steps)],
                                             names=["items", "root", "way", "inside"])


def _proofs(blocks: DataFrame, ways: DataFrame) -> DataFrame:
    """(item, digest, root, proof) of every leaf, its proof reaching to the root of ``ways``."""
    named = ways.select(F.col("tree").alias("of"), F.col("block").alias("at"), "root", "way")
    at = (F.col("block") == F.col("at")) & F.col("tree").eqNullSafe(F.col("of"))
    full = (blocks.join(_small(named, ways.count()), at)
            .select("items", "blocks", F.col("items.digest").alias("digests"), "root", "way"))
    schema = T.StructType([full.schema["items"], full.schema["root"], full.schema["way"]])
    got = full.mapInArrow(_inside, schema.add("inside", T.ArrayType(full.schema["way"].dataType)))
    one = got.select("root", "way", F.explode(F.arrays_zip("items", "inside")).alias("x"))
    return one.select("x.items.item", "x.items.digest", "root", F.concat("x.inside", "way").alias("proof"))


def manifest(leaves: DataFrame) -> DataFrame:
    """``leaves(tree, key, digest, item)`` -> (item, digest, subroot, root, proof), one row a leaf.

    A tree's leaves ascend by key, leaves with one key by digest; a null key comes first. Trees
    ascend likewise, a null tree first. ``item`` is a struct handed through. ``subroot`` is the
    root of the leaf's tree (a lone leaf itself), ``root`` that of all trees, and ``proof`` the
    steps (siblings, position) from the leaf to the root. Repeated rows are leaves each;
    without rows there are none.
    """
    blocks = _blocks(leaves.select("tree", "key", "digest", "item"))
    ways = _butterfly(blocks)
    trees = ways.filter("block = 0").select(
        F.lit(0).alias("tree"), F.col("tree").alias("key"), F.col("root").alias("digest"),
        F.struct(F.col("tree").alias("tree")).alias("item"))
    upper = _blocks(trees)
    top = _written(_proofs(upper, _butterfly(upper)).select(
        F.col("item.tree").alias("of"), F.col("root").alias("top"), F.col("proof").alias("last")), "top")
    ways = _written(
        ways.join(_small(top, top.count()), F.col("tree").eqNullSafe(F.col("of")))
        .select("tree", "block", F.struct(F.col("root").alias("subroot"), F.col("top").alias("root")).alias("roots"),
                F.concat("way", "last").alias("way")), "whole-ways")
    return (_proofs(blocks, ways.withColumnRenamed("roots", "root"))
            .select("item", "digest", "root.subroot", "root.root", "proof"))


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    def up(below: Column, step: Column) -> Column:
        left = step["position"] * DIGEST
        return F.sha2(F.concat(F.substring(step["siblings"], F.lit(1), left), below,
                               F.substring(step["siblings"], left + 1, F.length(step["siblings"]))), 256)
    return F.aggregate(proof, digest, up)


def proof_digest(proof: Column) -> Column:
    """Hex SHA-256 of all siblings of a proof, level by level."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: s["siblings"]), ""), 256)


def documents_manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """``docs(doc_id, source, lang, n_chars, text)``: a tree a language -> (doc_id, leaf, given, subroot, root,
    proof). ``given`` is the leaf's digest with ``changed`` in place of the text, to be checked against the
    root. Any of the columns may be null; further columns are not read."""
    whole = lambda text: leaf("doc_id", "source", "lang", "n_chars", text)
    given = whole(changed) if changed is not None else whole("text")
    leaves = docs.select(F.col("lang").alias("tree"), F.col("doc_id").alias("key"), whole("text").alias("digest"),
                         F.struct("doc_id", given.alias("given")).alias("item"))
    return manifest(leaves).select("item.doc_id", F.col("digest").alias("leaf"), "item.given", "subroot", "root", "proof")
