"""The pipeline's stages against brute force, each on what the one before kept."""

import corpus_pipeline
import pytest
from helpers import SCHEMA, contamination, exact_groups, jaccard_components
from pyspark.sql import functions as F
from test_text_ops import check_packed

from neoflow.llm import quality
from neoflow.session import scratch_path

SF001 = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def written(spark, df):
    path = scratch_path(spark, "t-stage")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns

    model = quality.fit(docs, labels)
    want = {i for i, t in rows(docs) if model.score(quality.np.array([quality.features(t)]))[0] >= quality.CUT}
    docs = written(spark, STAGES["quality_classifier"](spark, docs, SF001))
    assert docs.columns == columns and {i for i, _ in rows(docs)} == want

    want = {keep for keep, _ in exact_groups(rows(docs)).values()}
    docs = written(spark, STAGES["exact_dedup"](spark, docs, SF001))
    assert docs.columns == columns and {i for i, _ in rows(docs)} == want

    want = {i for i, (_, least) in jaccard_components(rows(docs), 5, 80, 100).items() if i == least}
    docs = written(spark, STAGES["near_duplicates"](spark, docs, SF001))
    assert docs.columns == columns and {i for i, _ in rows(docs)} == want

    want = {i for i, (n, hit, _) in contamination(rows(docs), bench).items() if not (hit > 0 and 20 * hit >= n)}
    docs = written(spark, STAGES["decontamination"](spark, docs, SF001))
    assert docs.columns == columns and {i for i, _ in rows(docs)} == want and len(want) > 100

    packed = STAGES["packing"](spark, docs, SF001).withColumn("ids", F.lit(None).cast("binary"))
    check_packed(packed.collect(), rows(docs))
    end = corpus_pipeline.run(spark, SF001)
    assert sorted(map(tuple, end.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        map(tuple, packed.select("doc_id", "start", "length", "ids_crc32").collect()))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_edge_rows_in_every_stage(spark, name):
    odd = [(None, "no id"), (1, None), (2, ""), (3, "twice the same row"), (3, "twice the same row"), (4, "x " * 50_000), (5, "é ß")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], SCHEMA).withColumns(
        {"__keep_": F.lit(1), "key": F.lit("k"), "score": F.lit(0.5), "sha": F.lit("s")})
    got = STAGES[name](spark, docs, SF001)
    n = got.count()
    if name != "packing":
        assert got.columns == docs.columns and n <= len(odd)
        assert STAGES[name](spark, docs.limit(0), SF001).count() == 0
    if name in ("exact_dedup", "near_duplicates"):
        assert n == (5 if name == "exact_dedup" else 6)  # a null and an empty text are equal texts, and sets that link with nothing


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_of_any_name_are_handed_on(spark, name):
    """Names that the stages use themselves travel with their values."""
    names = ["quality_score", "__own", "__id", "__tkey", "__keep", "row", "id", "own", "of", "at", "keep", "tkey", "key"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(60)
    plain = {r["doc_id"] for r in STAGES[name](spark, docs, SF001).collect()}
    full = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in names})
    got = STAGES[name](spark, full, SF001)
    assert got.columns == full.columns
    rows_ = got.collect()
    assert {r["doc_id"] for r in rows_} == plain and all(r[c] == f"{c}{r['doc_id']}" for r in rows_ for c in names)
