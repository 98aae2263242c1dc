"""The operators with Python in their tasks against their contracts."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from marketmill.llm import components as components_module
from marketmill.llm import licence_scan, near_dup, nearest, packing, toxicity
from marketmill.llm.components import components
from tests.llm import brute, fixtures

SF01 = "/root/testdata/sf0.01"


def classes(df):
    return sorted((r[0], r[1], r[2]) for r in near_dup.classes(df).collect())


@pytest.mark.parametrize("table", [fixtures.docs, fixtures.small])
def test_near_duplicates(spark, table):
    df = table(spark)
    assert classes(df) == brute.near_duplicates(fixtures.pairs(df))


def chain(n, words=40, step=3):
    """Texts of which each is similar to its neighbours only: one class of long paths."""
    line = [f"c{i}" for i in range(n * step + words)]
    return [" ".join(line[i * step : i * step + words]) for i in range(n)]


def test_near_duplicates_in_chains_and_groups(spark):
    rng = np.random.default_rng(3)
    base = [f"g{i}" for i in range(150)]
    group = []
    for _ in range(120):  # near copies, of which many pairs are below the threshold
        copy = list(base)
        for k in rng.integers(0, 150, 3):
            copy[k] = f"x{rng.integers(1 << 40)}"
        group.append(" ".join(copy))
    texts = chain(40) + group + group[:30] + ["same words here"] * 50 + ["a b", "a  B"]
    df = fixtures.docs(spark, texts)
    want = brute.near_duplicates(fixtures.pairs(df))
    assert classes(df) == want
    assert max(Counter(c for _, _, c in want).values()) > 100


def test_an_id_with_several_texts_links_them(spark):
    a, b, c = ("x1 x2 x3 x4 x5 x6", "y1 y2 y3 y4 y5 y6", "z1 z2 z3 z4 z5 z6")
    rows = [(7, a), (5, a), (5, b), (3, b), (9, c), (9, None), (8, ""), (2, None), (2, "q r"), (4, "q  r")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = classes(df)
    assert got == brute.near_duplicates(rows)
    assert {i: c for i, _, c in got} == {7: 3, 5: 3, 3: 3, 9: 9, 8: 8, 2: 2, 4: 2}


def test_without_copies_keeps_one_row_of_each_class(spark):
    a, b = "x1 x2 x3 x4 x5 x6", "y1 y2 y3 y4 y5 y6"
    rows = [(3, b), (3, b), (5, a), (5, b), (7, a), (8, None), (8, None), (None, a), (None, a), (1, b + " y7")]
    df = spark.createDataFrame([(*r, "en", 1) for r in rows], "doc_id long, text string, kept string, id int")
    left = near_dup.without_copies(df)
    assert left.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == [
        (1, b + " y7"), (3, b), (8, None), (None, a), (None, a),
    ]


def test_bayes_limits_follow_the_posterior():
    limits = near_dup.least_agreement(0.75, 1e-3, 32, 16)
    draws = np.random.default_rng(1).beta(limits[16], 16 - limits[16] + 2, 400_000)
    assert (draws >= 0.75).mean() < 1e-3  # one agreement less is given up
    draws = np.random.default_rng(1).beta(limits[16] + 1, 16 - limits[16] + 1, 400_000)
    assert (draws >= 0.75).mean() >= 1e-3


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 1 for i in range(2, 41)} | {100: 90, 95: 90}


@pytest.mark.parametrize("task_edges", [100_000, 16])
def test_components_have_the_tasks_their_edges_need(spark, monkeypatch, task_edges):
    monkeypatch.setattr(components_module, "TASK_EDGES", task_edges)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7)]
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        context.setJobGroup(f"components-{task_edges}", "")
        found = components(spark.createDataFrame(edges, "a long, b long").repartition(60))
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"components-{task_edges}")]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert dict(found.collect()) == {i: 1 for i in range(2, 41)} | {100: 90, 95: 90}
    stages = [tracker.getStageInfo(s) for s in {s for j in jobs for s in j.stageIds}]
    tasks = sum(s.numCompletedTasks for s in stages if s)
    if task_edges > len(edges):  # only the edges as they came have a task for each partition
        assert found.rdd.getNumPartitions() == 1
        assert tasks < 6 * 60


def test_without_copies_keeps_one_of_each_class(spark):
    df = fixtures.small(spark)
    out = near_dup.without_copies(df)
    assert out.dtypes == df.dtypes
    want = {c for _, _, c in brute.near_duplicates(fixtures.pairs(df))}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(want)


def vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(12).tolist(), "x", 1) for i in range(900)]
    rows += [(i, rows[3][1], "x", 1) for i in range(900, 1000)]  # a hot vector
    rows += [(1000, None, "x", 1), (1100, [0.0] * 12, "x", 1), (1200, [float("nan")] * 12, "x", 1),
             (1300, [1.0, None], "x", 1), (1400, [1.0, 2.0], "x", 1), (1401, [1.5, 2.0], "x", 1),
             (None, [1.0, 2.0], "x", 1), (1500, [float("inf")] * 12, "x", 1), (1600, [], "x", 1),
             (0, rows[0][1], "x", 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string, rank int")


def answers(df):
    found = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(found[r["query_id"]]) + 1
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    return found


@pytest.mark.parametrize("small_groups", [False, True])
def test_nearest_with_awkward_vectors(spark, small_groups):
    df = vectors(spark)
    sizes = {"shard_rows": 100, "block_rows": 3} if small_groups else {}
    got = answers(nearest.searched(df, **sizes))
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = brute.nearest(rows[:-1])
    assert set(got) == set(want)
    hits = total = 0
    exact = {i: dict(n) for i, n in brute.nearest(rows[:-1], k=5000).items()}
    for q, near in want.items():
        total += len(near)
        hits += len({i for i, _ in near} & {i for i, _ in got[q]})
        assert len(got[q]) == len(near)
        assert all(d == pytest.approx(exact[q][i], abs=1e-12) for i, d in got[q])
        assert [x[::-1] for x in got[q]] == sorted(x[::-1] for x in got[q])
    assert hits / total >= 0.97
    assert [i for i, _ in got[900]] == [3, *range(901, 910)]


def test_nearest_recall_on_the_test_vectors(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    got = answers(nearest.searched(df, shard_rows=200))
    want = brute.nearest([(r["vec_id"], r["embedding"]) for r in df.collect()])
    hits = [len({i for i, _ in n} & {i for i, _ in got[q]}) / len(n) for q, n in want.items()]
    assert set(got) == set(want) and np.mean(hits) >= 0.95


def test_chi_square_quantile():
    draws = np.random.default_rng(0).chisquare(8, 400_000)
    assert np.quantile(draws, 0.95) == pytest.approx(nearest.chi_square_quantile(0.95, 8), rel=0.01)


def test_toxicity_finds_labelled_documents(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    half = labels.where("doc_id % 2 = 0")  # the other half is held out
    rows = {r["doc_id"]: r for r in toxicity.judged(df, half).collect()}
    assert len(rows) == df.count()
    held = [(toxic[i], rows[i]["toxic"]) for i in toxic if i % 2]
    assert sum(a == b for a, b in held) / len(held) > 0.93
    clean = [b for a, b in held if not a]
    assert sum(clean) / len(clean) < 0.03
    assert all(0 <= r["expected_severity"] <= 2 and r["severity"] in (0, 1, 2) for r in rows.values())
    out = toxicity.clean_only(df, labels)
    assert out.dtypes == df.dtypes


def test_toxicity_without_labels_and_with_awkward_rows(spark):
    df = fixtures.docs(spark)
    none = spark.createDataFrame([(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.judged(df, none).collect()
    assert len(rows) == df.count() and not any(r["toxic"] for r in rows)
    assert toxicity.clean_only(df, none).count() == df.count()
    assert toxicity.judged(fixtures.empty(spark), none).count() == 0


def test_ordinal_regression_recovers_thresholds():
    rng = np.random.default_rng(0)
    n, words = 6000, 5
    x = rng.random((n, words)) < 0.4
    true = np.array([2.0, -1.0, 0.0, 1.0, 3.0])
    score = x @ true + rng.logistic(size=n)
    grades = np.digitize(score, [1.0, 3.0])
    bounds = np.r_[0, np.cumsum(x.sum(axis=1))]
    weights, thresholds = toxicity.fit_ordinal(np.nonzero(x)[1], bounds, grades, words, 3, ridge=0)
    assert np.allclose(weights, true, atol=0.3) and np.allclose(thresholds, [1, 3], atol=0.3)


@pytest.mark.parametrize("table", [fixtures.docs, fixtures.small])
def test_licences(spark, table):
    df = table(spark)
    rows = licence_scan.digest(licence_scan.scanned(df)).collect()
    texts = dict(fixtures.pairs(df))
    assert len(rows) == df.count()
    for r in rows:
        got = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
        assert got == brute.licences(texts[r["doc_id"]]), r["doc_id"]
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1
        assert (r["score"] == 1.0) or r["n_base"] == 0


def test_automaton_gives_the_longest_runs():
    rng = np.random.default_rng(4)
    for _ in range(200):
        make = lambda n: [b"%d" % w for w in rng.integers(0, 3, n)]
        templates = [make(rng.integers(1, 9)) for _ in range(4)]
        runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        automaton, text = licence_scan.Automaton(templates), make(20)
        for k, (state, length) in enumerate(automaton.statistics(text), 1):
            want = max((n for n in range(1, k + 1) if tuple(text[k - n : k]) in runs), default=0)
            assert length == want
            run = text[k - length : k]
            ends = {(s, p) for s, t in enumerate(templates) for p in range(length, len(t) + 1) if t[p - length : p] == run}
            assert not length or set(automaton.ends[state]) == ends


def test_licence_findings_have_spans():
    scanner = licence_scan.Scanner()
    notice = licence_scan.TEMPLATES[1][1]
    words = licence_scan.words_of("some words first " + notice.replace("copy", "COPY!") + " and more")
    _, found = scanner.scan(words)
    label, cover, start, end = max(found, key=lambda f: f[1])
    assert (label, cover, start, end) == ("mit", 1.0, 3, len(words) - 2)
    changed = notice.replace("obtaining", "who obtains")
    label, cover, *_ = max(scanner.scan(licence_scan.words_of(changed))[1], key=lambda f: f[1])
    assert label == "mit" and licence_scan.MIN_COVER <= cover < 1


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("table,capacity", [(fixtures.docs, 2048), (fixtures.small, 2048), (fixtures.docs, 64)])
def test_packing(spark, table, capacity):
    import zlib

    df, encode = table(spark), tokenizer()
    rows = packing.packed(df.repartition(5), capacity=capacity).collect()
    ids = {i: encode(t) for i, t in fixtures.pairs(df)}
    by_doc = brute.grouped((r["doc_id"], r) for r in rows)
    times = Counter(i for i, _ in fixtures.pairs(df))
    assert set(by_doc) == set(ids)
    for i, own in by_doc.items():
        whole = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in own)[:: times[i]]
        at = 0
        for k, (piece, start, length, crc) in enumerate(whole):
            assert (piece, start) == (k, at) and (k == 0 or length == capacity)
            part = np.array(ids[i][at : at + length], "<u4").tobytes()
            assert len(part) == 4 * length and zlib.crc32(part) == crc
            at += length
        assert at == len(ids[i])
    for sequence in brute.grouped((r["sequence_id"], r) for r in rows).values():
        at = 0
        for r in sorted(sequence, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    bins = len({r["sequence_id"] for r in rows})
    assert bins == brute.best_fit_bins([r["length"] for r in rows], capacity)


def test_plan_is_best_fit_decreasing():
    import random

    r = random.Random(6)
    for _ in range(60):
        capacity = r.choice([5, 30, 2048])
        counts = {r.randint(1, capacity): r.randint(1, 30) for _ in range(r.randint(1, 40))}
        runs = packing.plan(counts, capacity)
        lengths = [n for n, c in counts.items() for _ in range(c)]
        most = 0
        for length, rank, each, first, _ in runs:
            later = [x[1] for x in runs if x[0] == length and x[1] > rank]
            placed = min(later, default=counts[length]) - rank
            most = max(most, first + -(-placed // each))
        assert most == brute.best_fit_bins(lengths, capacity)


def test_tokens_of_awkward_texts():
    import public_tokenizers

    words, encode = packing.WordTokens(public_tokenizers.path(packing.TOKENIZER), limit=5), tokenizer()
    for text in ["", "  a b", "a  b \n c", " a", "a ", "\n", "x\x1c y  \t z", "don't  we'll   ",
                 "é😀 ü  ß", "a  b", "١٢ ² x_y", "<|endoftext|> x", *filter(None, fixtures.TEXTS)]:
        assert np.frombuffer(words.ids(text), "<u4").tolist() == encode(text)[:-1], text[:80]


def test_empty_tables(spark):
    none = fixtures.empty(spark)
    assert near_dup.classes(none).count() == near_dup.without_copies(none).count() == 0
    assert nearest.searched(vectors(spark).limit(0)).count() == 0
    assert licence_scan.scanned(none).count() == 0
    assert packing.packed(none).count() == 0


def test_words_are_cut_once_and_pairs_over_lines_are_not_kept():
    """Plain words and their stops take no detour by the byte table; what spans a line is not kept."""
    import public_tokenizers

    words, encode = packing.WordTokens(public_tokenizers.path(packing.TOKENIZER)), tokenizer()
    cut = []
    words._bpe = lambda piece, bpe=words._bpe: cut.append(piece) or bpe(piece)
    text = "So plain words, stops. and lines.\nNext plain words! Then café, café.\nSo"
    assert np.frombuffer(words.ids(text), "<u4").tolist() == encode(text)[:-1]
    assert " words" not in cut and "," not in cut and " caf\u00e9" in cut
    assert "plain" in words and not any("\n" in word for word in words)
