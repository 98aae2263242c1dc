"""The corpus pipeline on test rows, stage by stage against brute force."""

from collections import defaultdict

import corpus_pipeline
from pyspark.sql import functions as F
from marketmill.llm import toxicity
from tests.llm import brute, fixtures
from tests.llm.test_free import tokenizer

FOLDER = fixtures.SMALL


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "personal_data", "mixing", "packing",
    ]


def test_every_stage_against_brute_force(spark, tmp_path):
    docs = fixtures.small(spark)
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, results[-1], FOLDER).write.parquet(f"{tmp_path}/{name}")
        results.append(spark.read.parquet(f"{tmp_path}/{name}"))
    clean, single, redacted, mixed, packed = results[1:]
    assert all(r.columns == docs.columns for r in results[:-1])

    judged = toxicity.judged(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    assert ids(clean) == sorted(r["doc_id"] for r in judged if not r["toxic"])
    assert ids(single) == sorted({c for _, _, c in brute.near_duplicates(fixtures.pairs(clean))})
    assert ids(redacted) == ids(single)
    for _, text in fixtures.pairs(redacted):
        assert not any(brute.personal_data(text).values())

    sizes, words = defaultdict(int), {}
    for r in redacted.collect():
        words[r["doc_id"]] = len(brute.WORD.findall(r["text"]))
        sizes[r["source"]] += words[r["doc_id"]]
    taken = defaultdict(int)
    for r in mixed.collect():
        taken[r["source"]] += words[r["doc_id"]]
    for source, goal in brute.targets(sizes).items():
        assert abs(taken[source] - goal) <= max(words.values())

    encode = tokenizer()
    tokens = sum(len(encode(t)) for _, t in fixtures.pairs(mixed))
    rows = packed.collect()
    assert sum(r["length"] for r in rows) == tokens
    bins = len({r["sequence_id"] for r in rows})
    assert bins == brute.best_fit_bins([r["length"] for r in rows], 2048)


def through_all_stages(spark, docs, folder):
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        counts.append(docs.count())
    return docs, counts


def test_awkward_rows_go_through(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows, rows without an id, clashing columns."""
    docs = fixtures.docs(spark, source=lambda i: [None, "b", "a"][i % 3], repeat=(4, 8, 0))
    extra = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    docs = docs.unionByName(extra)
    packed, counts = through_all_stages(spark, docs, tmp_path)
    clean = toxicity.clean_only(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    pairs = fixtures.pairs(clean)
    classes = {c for i, _, c in brute.near_duplicates([p for p in pairs if p[0] is not None])}
    assert counts[1] == counts[2] == len(classes) + sum(i is None for i, _ in pairs)
    mixed = {r["doc_id"] for r in spark.read.parquet(f"{tmp_path}/mixing").collect()}
    assert {r["doc_id"] for r in packed.collect()} == mixed <= classes | {None}


def test_an_empty_table_goes_through(spark, tmp_path):
    assert through_all_stages(spark, fixtures.empty(spark), tmp_path)[1] == [0] * 5


def test_run_gives_the_last_stage(spark):
    assert "sequence_id" in corpus_pipeline.run(spark, FOLDER).columns
