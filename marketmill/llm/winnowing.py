"""Fingerprints of texts by winnowing, in DataFrame functions only.

A text's units are its words; a character of a script that is written without blanks is a unit
of its own. Every ``GRAM`` units in a row have a polynomial hash modulo 2^31 - 1. A column
function carries no state from one place to the next, so the hash does not roll by one unit but
by doubling: that of 2k units is made of those of k units that start k apart. In every
``WINDOW`` grams in a row the one of the smallest hash is kept, the rightmost of equal ones,
with its place. Hash and place are one number, hash first and place counted down, so that the
smallest number is that gram; the minimum of a window is found by doubling, too.

Any ``GRAM + WINDOW - 1`` units that two texts share leave a common hash in both fingerprints,
and nothing shorter than ``GRAM`` units is ever reported as shared.

Defined results: a null or empty text, or one of white space, has no marks; with fewer than
``GRAM`` units the whole sequence is one gram; with fewer than ``WINDOW`` grams all are one
window. Equal texts have equal marks. Two texts without marks are alike (1.0), one without and
one with marks are not (0.0). Places reach 2^32 - 1, more than a string can hold. Repeated rows
are rows of their own. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Characters of scripts without blanks between words: South-East Asian and ideographic ranges.
UNSPACED = r"฀-໿က-႟ក-៿⺀-꓏豈-﫿\x{20000}-\x{3FFFF}"
UNIT = rf"[^\x20\x09-\x0D{UNSPACED}]+|[{UNSPACED}]"
GRAM = 4
WINDOW = 8
PRIME = (1 << 31) - 1
BASE = 1_103_515_245
PLACE_BITS = 32
LAST_PLACE = (1 << PLACE_BITS) - 1
BUCKET_ROWS = 20_000  # rows that are put in order together


def _pairs(one: str, other: str, apart: int, join) -> Column:
    """``join`` of the elements of two arrays, the second's from ``apart`` places further on."""
    n = F.greatest(F.size(other) - apart, F.lit(0))
    return F.zip_with(F.slice(one, 1, n), F.slice(other, apart + 1, n), join)


def _grams(rows: DataFrame, units: str, k: int) -> tuple[DataFrame, str]:
    """Rows with the hashes of all k units in a row, and that column's name."""
    if k == 1:
        return rows, units
    rows, half = _grams(rows, units, k // 2)
    name = f"{units}_{k}"

    def together(one, other, apart, width):
        power = F.lit(pow(BASE, width, PRIME)).cast("long")
        return _pairs(one, other, apart, lambda a, b: (a * power + b) % PRIME)

    if k % 2:
        rows = rows.withColumn(f"{units}_{k - 1}", together(half, half, k // 2, k // 2))
        return rows.withColumn(name, together(f"{units}_{k - 1}", units, k - 1, 1)), name
    return rows.withColumn(name, together(half, half, k // 2, k // 2)), name


def with_marks(
    rows: DataFrame, text: str, marks: str, gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """The rows with one more column: the marks of a text in order of place, hash and place in
    one number each. Names that start with that column's are used on the way."""
    kept = [F.col(f"`{c}`") for c in rows.columns]
    units = f"{marks}_unit"
    word = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(UNIT), F.lit(0))
    rows = rows.withColumn(
        units, F.transform(word, lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME).cast("long")))
    )
    rows, whole = _grams(rows, units, gram)
    once = F.aggregate(units, F.lit(0).cast("long"), lambda a, h: (a * BASE + h) % PRIME)
    grams = F.when(F.size(units) >= gram, F.col(whole)).otherwise(
        F.when(F.size(units) > 0, F.array(once)).otherwise(F.slice(units, 1, 0))
    )
    last = F.lit(LAST_PLACE).cast("long")
    level = f"{marks}_min_1"
    rows = rows.withColumn(f"{marks}_gram", grams).withColumn(
        level, F.transform(f"{marks}_gram", lambda g, i: F.shiftleft(g, PLACE_BITS) + (last - i))
    )
    width = 1
    while width < window:
        step = min(width, window - width)
        width += step
        rows = rows.withColumn(f"{marks}_min_{width}", _pairs(level, level, step, lambda a, b: F.least(a, b)))
        level = f"{marks}_min_{width}"
    few = F.size(f"{marks}_min_1") < window
    least = F.filter(F.array(F.array_min(f"{marks}_min_1")), lambda m: m.isNotNull())
    return rows.select(*kept, F.array_distinct(F.when(few, least).otherwise(F.col(level))).alias(marks))


def hash_of(mark: Column) -> Column:
    return F.shiftright(mark, PLACE_BITS)


def place_of(mark: Column) -> Column:
    last = F.lit(LAST_PLACE).cast("long")
    return last - mark.bitwiseAND(last)


def listed(marks: str) -> Column:
    """``place:hash`` of all marks, by place."""
    one = lambda m: F.concat(place_of(m).cast("string"), F.lit(":"), hash_of(m).cast("string"))
    return F.array_join(F.transform(marks, one), " ")


def likeness(one: str, other: str) -> Column:
    """Share of the different hashes of two fingerprints that both hold."""
    a, b = (F.array_distinct(F.transform(c, hash_of)) for c in (one, other))
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both, F.size(F.array_union(a, b))), F.lit(1.0)).cast("double")


def _folded(values, kind: str) -> Column:
    """A literal array of any length: one string that is cut and cast when the plan is made."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def with_next(rows: DataFrame, key: str, carried: list[str], tie: str) -> DataFrame:
    """The rows, and as ``next_<name>`` what the next row holds, by descending key; after the
    last row comes the first. Rows without a key come last; equal keys are ordered by ``tie``.

    Keys are cut into ranges of about ``BUCKET_ROWS`` rows by an approximate quantile, whose
    error only makes ranges uneven. A range is ordered by one window. The first key of a range is
    sent to the range before, too, where it only says what comes next. The driver gets three
    numbers a range."""
    keys = rows.select(F.col(key).cast("long").alias("k"))
    n = keys.count()
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(16 * partitions, n // BUCKET_ROWS)
    shares = _folded((i / parts for i in range(1, parts)), "double")
    found = keys.agg(
        F.max("k").alias("most"),
        F.percentile_approx("k", shares, max(10_000, 10 * parts)).alias("cuts"),
    ).first()
    starts = sorted({*(found["cuts"] or []), found["most"]} - {None}, reverse=True)

    def range_of(k: Column) -> Column:
        """Number of starts that are not below the key, by halving; one more without a key."""
        if not starts:
            return F.lit(1)
        table = _folded(starts, "bigint")
        steps = [1 << b for b in range(len(starts).bit_length() - 1, -1, -1)]
        up = lambda at, s: F.when(F.get(table, at + s - 1) >= k, at + s).otherwise(at)
        at = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), up)
        return F.when(k.isNull(), F.lit(len(starts) + 1)).otherwise(at)

    firsts = {
        r["at"]: r["first"]
        for r in keys.groupBy(range_of(F.col("k")).alias("at")).agg(F.max("k").alias("first")).collect()
    }
    order = sorted(firsts)
    before = dict(zip(order, order[-1:] + order[:-1], strict=True))
    span = range(len(starts) + 2)
    own = F.col("range_own")
    first = F.get(_folded([firsts.get(b) or 0 for b in span], "bigint"), own)
    is_first = F.col("range_key").isNull() | (F.col("range_key") == first)
    also = F.get(_folded([before.get(b, b) for b in span], "int"), own)
    placed = (
        rows.withColumn("range_key", F.col(key).cast("long"))
        .withColumn("range_own", range_of(F.col("range_key")))
        .select(
            "*",
            F.posexplode(F.when(is_first, F.array(own, also)).otherwise(F.array(own))).alias(
                "range_copy", "range_at"
            ),
        )
    )
    ahead = Window.partitionBy("range_at").orderBy(
        "range_copy", F.desc_nulls_last("range_key"), F.xxhash64(tie), tie
    )
    return (
        placed.withColumns({f"next_{c}": F.lead(c).over(ahead) for c in carried})
        .where("range_copy = 0")
        .drop("range_key", "range_own", "range_copy", "range_at")
    )


def fingerprints(
    docs: DataFrame, key="doc_id", text="text", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """doc_id, text (null: empty) and marks of every row."""
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    return with_marks(rows, "text", "marks", gram, window)


def compared(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Each text beside the next one, and beside an edit of itself: its second half is replaced
    by as much of the beginning of the next text. Texts are exchanged once."""
    rows = with_next(fingerprints(docs, gram=gram, window=window), "doc_id", ["text", "marks"], "text")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    one = F.lit(1)
    rows = rows.withColumn(
        "edited", F.concat(F.substring("text", one, n - half), F.substring("next_text", one, half))
    )
    return with_marks(rows, "edited", "edited_marks", gram, window)


def digest(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        listed("marks").alias("fingerprint"),
        listed("edited_marks").alias("edited_fingerprint"),
        likeness("marks", "edited_marks").alias("near_edited"),
        likeness("marks", "next_marks").alias("near_next"),
    )
