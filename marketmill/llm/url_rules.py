"""URL filters: a rule list first, then association rules mined from the URLs it decides.

Rules (host, path, verdict) decide the URLs they fit. Those verdicts are the labels: frequent
sets of URL tokens that go with one verdict are mined by FP-growth, kept by support, confidence and
evidence, and applied to the URLs that no listed rule fits. Evidence: a set goes with its verdict
more often than all labelled URLs do, and at least ``MIN_SOURCES`` listed rules have said it of URLs
that hold the set. What one listed rule alone says is that rule, not an association. A URL gives at most nine tokens
(scheme, top domain, site, first label, host, first folder, extension, first query name,
fragment), so a set of support ``MIN_SUPPORT`` bounds the number of rules: at most 129 sets of
up to three tokens a URL over 1 % of them, 12,900 rules, however many URLs there are.

Matching is by an inverted index: each rule is filed under one of its tokens, a URL looks its
own tokens up, and the strongest rule whose tokens are all there decides.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule
and is allowed unless a mined rule fits it, as is every URL that no rule of either kind fits.
Repeated rows are judged each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import json

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.llm.shared import computed_once

# (host, path, verdict). Fixed values.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
MIN_SOURCES = 2
MAX_TOKENS = 3
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def with_parts(pages: DataFrame, key="page_id", url="url") -> DataFrame:
    """page_id, url, host, path."""
    link = F.coalesce(F.col(url), F.lit(""))
    return pages.select(
        F.col(key).alias("page_id"),
        link.alias("url"),
        F.translate(F.regexp_extract(link, PARTS, 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(link, PARTS, 2).alias("path"),
    )


def listed(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits host and path, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col(
            "path"
        ).startswith(path)
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def tokens() -> Column:
    """At most nine tokens of a URL, no two of the same sort."""
    labels = F.split("host", r"\.")
    last = F.regexp_extract("path", r"([^/]*)$", 1)
    sorts = {
        "scheme": F.regexp_extract("url", r"^([a-zA-Z]+)://", 1),
        "top": F.element_at(labels, -1),
        "site": F.when(F.size(labels) > 1, F.concat_ws(".", F.slice(labels, -2, 2))).otherwise(""),
        "first": F.when(F.size(labels) > 2, F.get(labels, F.lit(0))).otherwise(""),
        "host": F.col("host"),
        "folder": F.regexp_extract("path", r"^/([^/]*)/", 1),
        "ending": F.regexp_extract(last, r"\.([A-Za-z0-9]+)$", 1),
        "query": F.regexp_extract("url", r"\?([^=&#]*)", 1),
        "fragment": F.when(F.contains(F.col("url"), F.lit("#")), "yes").otherwise(""),
    }
    named = F.array(*[F.when(v != "", F.concat(F.lit(f"{k}="), v)) for k, v in sorts.items()])
    return F.array_compact(named)


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> list[dict]:
    """Rules from rows (tokens, verdict, rule), strongest first: by confidence, support, fewest
    tokens, then the tokens themselves. A rule whose tokens hold those of a stronger rule is left
    out: it never decides. Their number is bounded by the support, see above."""
    partitions = int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    items = labelled.select(
        F.concat("tokens", F.array(F.concat(F.lit("verdict="), "verdict"))).alias("items")
    )
    model = FPGrowth(
        itemsCol="items",
        minSupport=min_support,
        minConfidence=min_confidence,
        numPartitions=partitions,
    ).fit(items)
    consequent = F.get("consequent", F.lit(0))
    found = (
        model.associationRules.where(
            consequent.startswith("verdict=") & (F.size("antecedent") <= MAX_TOKENS) & (F.col("lift") > 1)
        )
        .select(
            F.sort_array("antecedent").alias("tokens"),
            F.substr(consequent, F.lit(9)).alias("verdict"),
            "confidence",
            "support",
        )
        .collect()
    )
    ordered = sorted(
        (r.asDict() for r in found),
        key=lambda r: (-r["confidence"], -r["support"], len(r["tokens"]), r["tokens"]),
    )
    kept: list[dict] = []
    sets: set[frozenset] = set()
    for row in _with_sources(labelled, ordered):
        own = row["tokens"]
        parts = [frozenset(t for i, t in enumerate(own) if m >> i & 1) for m in range(1, 1 << len(own))]
        if not any(p in sets for p in parts):
            sets.add(frozenset(own))
            kept.append(row)
    return kept


def _with_sources(labelled: DataFrame, rules: list[dict]) -> list[dict]:
    """The mined rules whose verdict several listed rules have given to URLs that they fit. The
    driver gets one number a mined rule."""
    if not rules:
        return rules
    fitting, verdicts = _fitting(rules)
    sources = (
        labelled.select("verdict", "rule", F.explode(fitting).alias("at"))
        .where(F.col("verdict") == F.get(verdicts, F.col("at")))
        .groupBy("at")
        .agg(F.count_distinct("rule").alias("n"))
        .where(F.col("n") >= MIN_SOURCES)
        .collect()
    )
    enough = {r["at"] for r in sources}
    return [rule for i, rule in enumerate(rules) if i in enough]


def _literal(value, kind: str) -> Column:
    """One constant that the optimiser folds."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _fitting(rules: list[dict]) -> tuple[Column, Column]:
    """(numbers of the rules whose tokens are all in ``tokens``, verdicts by number)."""
    uses: dict[str, int] = {}
    for rule in rules:
        for token in rule["tokens"]:
            uses[token] = uses.get(token, 0) + 1
    index: dict[str, list[int]] = {}
    for i, rule in enumerate(rules):
        rarest = min(rule["tokens"], key=lambda t: (uses[t], t))
        index.setdefault(rarest, []).append(i)
    postings = _literal(index, "map<string,array<int>>")
    needed = _literal([r["tokens"] for r in rules], "array<array<string>>")
    verdicts = _literal([r["verdict"] for r in rules], "array<string>")
    looked_up = F.flatten(
        F.transform(
            "tokens", lambda t: F.coalesce(F.element_at(postings, t), F.array().cast("array<int>"))
        )
    )
    fitting = F.filter(looked_up, lambda r: F.size(F.array_except(F.get(needed, r), "tokens")) == 0)
    return fitting, verdicts


def decided(rules: list[dict]) -> Column:
    """The verdict of the strongest mined rule whose tokens are all in ``tokens``, else null."""
    if not rules:
        return F.lit(None).cast("string")
    fitting, verdicts = _fitting(rules)
    return F.get(verdicts, F.array_min(fitting))


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every URL."""
    rule, verdict = listed(rules)
    rows = with_parts(pages).withColumns({"rule": rule, "listed": verdict, "tokens": tokens()})
    mined = mine(
        rows.where(F.col("listed").isNotNull()).select(
            "tokens", F.col("listed").alias("verdict"), "rule"
        )
    )
    return computed_once(
        rows,
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("listed", decided(mined), F.lit(DEFAULT)).alias("verdict"),
    )
