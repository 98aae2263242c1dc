"""The four operators in plain DataFrame functions against their contracts."""

import math
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from marketmill.llm import mixing, pii, quality, url_rules
from tests.llm import brute, fixtures
from tools.compare import connect, differences


def labels(spark):
    return fixtures.small(spark, "labels")


@pytest.mark.parametrize("table", [fixtures.docs, fixtures.small])
def test_personal_data(spark, table):
    df = table(spark)
    got = {}
    for r in pii.digest(pii.find(df)).collect():
        got[r["doc_id"]] = r
    for i, text in fixtures.pairs(df):
        counts, digest, joined = brute.personal_digest(text)
        r = got[i]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts, (i, joined)
        assert r["base_sha256"] == digest, (i, joined, r["spans"])
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))


def test_personal_data_of_the_method_and_redaction(spark):
    df = fixtures.docs(spark)
    found = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find(df)).collect()}
    kinds = [s.split(":")[0] for s in found[9].split(",")]
    assert kinds == ["iban", "ssn", "ssn", "email"]
    out = {r["doc_id"]: r for r in pii.redact(df).collect()}
    assert pii.redact(df).columns == df.columns and pii.redact(df).count() == df.count()
    assert out[3]["text"] is None and out[3]["n_chars"] is None
    assert out[9]["text"] == (
        "my IBAN is [IBAN] and ssn [SSN] but [SSN] alone; é😀 [EMAIL]"
    )
    assert out[9]["n_chars"] == len(out[9]["text"])
    assert out[11]["text"] == fixtures.BASE and out[9]["size"] == "s"


def test_iban_check(spark):
    from pyspark.sql import functions as F

    rows = [("DE89370400440532013000", True), ("DE88370400440532013000", False),
            ("GB82 WEST 1234 5698 7654 32", True)]
    df = spark.createDataFrame(rows, "m string, ok boolean")
    assert all(r["ok"] == r["got"] for r in df.withColumn("got", pii.mod_97(F.col("m"))).collect())


@pytest.mark.parametrize("table", [fixtures.docs, fixtures.small])
def test_quality_counts(spark, table):
    df = table(spark)
    rows = quality.judged(df, labels(spark)).collect()
    texts = dict(fixtures.pairs(df))
    assert len(rows) == df.count()
    for r in rows:
        want = brute.quality(texts[r["doc_id"]])
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
               r["n_repeat_words"], r["base_failed"])
        assert got == want, r["doc_id"]
        assert not (r["kept"] and r["base_failed"])


def test_quality_score_is_the_mean_log_ratio(spark):
    """Against the same sum written out over collected buckets."""
    import math

    from pyspark.sql import functions as F

    df, buckets = fixtures.small(spark), 512
    good = {r["doc_id"] for r in labels(spark).where("quality = 1").collect()}
    hashed = quality._hashes(df, "doc_id", "text").select(
        "doc_id", quality._features(F.col("hashes"), buckets).alias("f")
    )
    per_doc = {r["doc_id"]: r["f"] for r in hashed.collect()}
    raw, trusted = [1] * buckets, [1] * buckets
    for i, f in per_doc.items():
        for b in f:
            raw[b] += 1
            trusted[b] += i in good
    want = {
        i: sum(math.log(trusted[b] / sum(trusted) / (raw[b] / sum(raw))) for b in f) / max(1, len(f))
        for i, f in per_doc.items()
    }
    for r in quality.judged(df, labels(spark), buckets).collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=1e-6)


def test_quality_tells_labelled_documents_apart(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judged(df, lab).join(lab, "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.995
    assert sum(bad) / max(1, len(bad)) < 0.2


@pytest.mark.parametrize("table", [fixtures.docs, fixtures.small])
def test_mixing_targets_and_takes(spark, table):
    df = table(spark)
    sizes, of = defaultdict(int), {}
    for r in df.collect():
        n = len(brute.WORD.findall(r["text"] or ""))
        sizes[r["source"]] += n
        of[r["doc_id"]] = (n, r["source"])
    want = brute.targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    rows = mixing.mixed(df).collect()
    assert len(rows) == df.count()
    for r in rows:
        n, s = of[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (n, sizes[s])
        assert r["target"] == pytest.approx(want[s])
        assert r["taken"] <= 3 * n and (n == 0 or r["taken"] % n == 0)
        taken[s] += r["taken"]
        largest[s] = max(largest[s], n)
    for s, goal in want.items():
        # One document's size, twice where a row is repeated.
        assert abs(taken[s] - goal) <= 2 * largest[s]
    assert sorted(rows) == sorted(mixing.mixed(df.repartition(7)).collect())


def test_mixing_equals_sql(spark):
    for folder in (fixtures.SMALL, "/root/testdata/sf0.01"):
        df = mixing.mixed(spark.read.parquet(f"{folder}/documents.parquet"))
        problems, n = differences(df, connect(folder).sql(mixing.ORACLE_SQL))
        assert problems == [] and n


def test_mix_gives_rows_as_often_as_taken(spark):
    df = fixtures.small(spark)
    want = {r["doc_id"]: r for r in mixing.mixed(df).collect()}
    out = mixing.apply_mix(df)
    assert out.dtypes == df.dtypes
    times = defaultdict(int)
    for r in out.collect():
        times[r["doc_id"]] += 1
    assert all(times[i] * r["size"] == r["taken"] for i, r in want.items())


def test_hot_source_gives_the_same_mix(spark):
    """A third and more of the rows in one source; brute-force thresholds by sorting."""
    df = fixtures.docs(spark, [f"w{i} " * (i % 7) for i in range(600)], lambda i: "hot" if i % 3 else f"s{i % 5}")
    taken = defaultdict(int)
    sizes = defaultdict(int)
    for r in mixing.mixed(df).join(df.select("doc_id", "source").distinct(), "doc_id").collect():
        taken[r["source"]] += r["taken"]
        sizes[r["source"]] += r["size"]
    for s, goal in brute.targets(sizes).items():
        assert abs(taken[s] - goal) <= 14


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com/en/x?y#z", "https://www.example.com/en/",
    "https://a.www.example.com/en/1", "http://example.com", "http://example.com?x=/en/",
    "ftp://x.net/es/a://b", "http://net/fr/", "http://notexample.com/en/", "://h/p#q", "http://é.net/fr/ü",
    "http://a.org/en/1\nx", "http://x.net/FR/",
]


def test_listed_url_rules(spark):
    rows = [(i, u, "p", "h") for i, u in enumerate(URLS)] + [(0, None, "p", "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, path string, host string")
    got = url_rules.judged(df).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = brute.host_path(dict((a, b) for a, b, *_ in rows)[r["page_id"]])
        rule, verdict = brute.listed(host, path, url_rules.RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ("allow", "block") and (verdict is None or r["verdict"] == verdict)


def test_mined_url_rules_equal_brute_force(spark):
    """Every token set of up to three, counted over the URLs the list decides."""
    from itertools import combinations

    df = url_rules.with_parts(fixtures.small(spark, "pages"))
    rule, verdict = url_rules.listed()
    rows = df.withColumns({"rule": rule, "listed": verdict, "tokens": url_rules.tokens()}).collect()
    known = [r for r in rows if r["listed"]]
    seen, agree, says = defaultdict(int), defaultdict(set), defaultdict(int)
    agreeing = defaultdict(int)
    for r in known:
        says[r["listed"]] += 1
        for n in (1, 2, 3):
            for c in combinations(sorted(r["tokens"]), n):
                seen[c] += 1
                agreeing[c, r["listed"]] += 1
                agree[c, r["listed"]].add(r["rule"])
    least = -(-len(known) * url_rules.MIN_SUPPORT // 1)
    rules = sorted(
        ((-n / seen[c], -n, len(c), list(c), v) for (c, v), n in agreeing.items()
         if n >= least and n / seen[c] >= url_rules.MIN_CONFIDENCE
         and n / seen[c] > says[v] / len(known) and len(agree[c, v]) >= url_rules.MIN_SOURCES)
    )
    got = {r["page_id"]: r["verdict"] for r in url_rules.judged(fixtures.small(spark, "pages")).collect()}
    for r in rows:
        fit = next((x[4] for x in rules if set(x[3]) <= set(r["tokens"])), url_rules.DEFAULT)
        assert got[r["page_id"]] == (r["listed"] or fit)


def test_one_listed_rule_is_no_association(spark):
    urls = ["http://www.a.net/es/x"] * 30 + ["http://b.example.com/en/x"] * 30
    urls += ["http://www.a.net/it/x", "http://c.org/en/x", "http://d.net/es"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_rules.judged(df).collect()}
    assert [got[k] for k in (0, 30, 60, 61, 62)] == ["block", "block", "allow", "allow", "allow"]


def test_empty_tables(spark):
    none = fixtures.empty(spark)
    assert pii.find(none).count() == pii.redact(none).count() == 0
    assert quality.judged(none, labels(spark).limit(0)).count() == 0
    assert mixing.mixed(none).count() == mixing.apply_mix(none).count() == 0
    pages = fixtures.small(spark, "pages").limit(0)
    assert url_rules.judged(pages).count() == 0


def test_native_plans_hold_no_python(spark):
    df = fixtures.small(spark)
    frames = [pii.find(df), quality.judged(df, labels(spark)), mixing.mixed(df),
              url_rules.judged(fixtures.small(spark, "pages"))]
    for frame in frames:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_word_count_in_sql():
    found = duckdb.sql(r"select len(regexp_extract_all('a b\tc  é', '[^\x20\x09-\x0D]+'))")
    assert found.fetchall() == [(3,)]


def test_quality_counts_and_threshold_cover_all_trusted_documents(spark):
    """More trusted documents than any sample the fit ever took; ids close together and far apart."""
    n, buckets = 24_000, 64
    words = F.concat_ws(" ", *[F.concat(F.lit("w"), F.pmod(F.xxhash64("id", F.lit(k)), F.lit(37)))
                               for k in range(51)])
    for far in (1, 1 << 40):
        df = spark.range(n).select((F.col("id") * far - 5).alias("doc_id"), words.alias("text"))
        df = df.union(df.limit(40)).union(spark.createDataFrame([(None, "w1 w2")], "doc_id long, text string"))
        lab = spark.range(n).select((F.col("id") * far - 5).alias("doc_id"), F.lit(1).alias("quality"))
        lab = lab.where(F.pmod(F.xxhash64("doc_id"), F.lit(12)) > 0)
        weights = quality.fit(df, lab, buckets)
        hashed = quality._hashes(df, "doc_id", "text")
        good = F.col("trusted_id").isNotNull().cast("long")
        ids = lab.select(F.col("doc_id").alias("trusted_id"))
        counted = (
            hashed.join(ids, F.col("doc_id") == F.col("trusted_id"), "left")
            .select(good.alias("t"), F.explode(quality._features(F.col("hashes"), buckets)).alias("b"))
            .groupBy("b").agg(F.count("*").alias("raw"), F.sum("t").alias("good")).collect()
        )
        assert sum(r["good"] for r in counted) > 20_000 * 101
        shift = math.log((sum(r["raw"] for r in counted) + buckets) / (sum(r["good"] for r in counted) + buckets))
        for r in counted:
            assert weights[r["b"]] == math.log((r["good"] + 1) / (r["raw"] + 1)) + shift
        rows = quality.judged(df, lab, buckets).cache()
        of_good = rows.join(ids, F.col("doc_id") == F.col("trusted_id")).where("n_words >= 50")
        low, mid = of_good.agg(F.percentile("score", F.array(F.lit(0.005), F.lit(0.5)))).first()[0]
        assert quality.threshold(rows, lab) == 2 * low - mid
        assert rows.where((F.col("score") >= 2 * low - mid) != F.col("kept")).where("not base_failed").count() == 0


def test_quantiles_are_those_of_all_rows(spark):
    shares = (0.0, 0.005, 0.25, 0.5, 0.999, 1.0)
    for values in ([2.5], [1.0, 2.0], [0.5] * 7 + [3.0], [k * k % 101 / 7 for k in range(999)]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        want = df.agg(F.percentile("v", F.array(*[F.lit(s) for s in shares]))).first()[0]
        assert quality.quantiles(df, "v", shares) == want
    assert quality.quantiles(df.limit(0), "v", shares) is None
