"""Personal data: patterns propose spans, checksums confirm, words nearby adjust the score.

Kinds with a fixed rule (always reported): e-mail, IPv4 with parts up to 255, payment card with
14 to 19 digits that pass Luhn, phone with a plus and 10 to 15 digits. Kinds of the method: IBAN
of its country's length that passes mod 97, and nine-digit identity numbers, reported if their score reaches
``MIN_SCORE``: a prior for the kind, raised by a context word among the ``CONTEXT_CHARS``
characters before the span or as many after it, across other spans, and carried on through a
list of spans of the kind, however long. Every base span carries its score too.

Matches are the leftmost non-overlapping ones of each kind. Runs are matched possessively, and
only from where a run starts or the last match ended, which gives the same matches as the plain
patterns in time linear in the text. IBANs are proposed at every place where one can start, so
that what follows one, or only looks like one before it, does not hide it; those that pass are
then looked up in the text. Places are code points, end exclusive.

Defined results: null text is empty text, without spans. Repeated rows are judged each for
itself. A marker character that is in the text already is taken for another one that no
pattern uses, which changes no match and no place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.llm.shared import computed_once

MARK, OTHER = "\u0001", "\u0002"
_LOCAL = r"[A-Za-z0-9._%+-]"
# Country to characters of its IBAN: the registry, then countries that use IBANs unregistered.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BI=27, BR=29, BY=28, CH=21,
    CR=22, CY=28, CZ=24, DE=22, DJ=27, DK=18, DO=28, EE=20, EG=29, ES=24, FI=18, FK=18, FO=18,
    FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HN=28, HR=21, HU=28, IE=22, IL=23, IQ=23,
    IS=26, IT=27, JO=30, KW=30, KZ=20, LB=28, LC=32, LI=21, LT=20, LU=20, LV=21, LY=25, MC=27,
    MD=24, ME=22, MK=19, MN=20, MR=27, MT=31, MU=30, NI=28, NL=18, NO=15, OM=23, PK=24, PL=28,
    PS=29, PT=25, QA=29, RO=24, RS=22, RU=33, SA=24, SC=31, SD=18, SE=24, SI=19, SK=24, SM=27,
    SO=23, ST=25, SV=28, TL=23, TN=24, TR=26, UA=29, VA=22, VG=24, XK=20, YE=30,
    AO=25, BF=28, BJ=28, CF=27, CG=27, CI=28, CM=27, CV=25, DZ=26, GA=27, GQ=27, GW=25, IR=26,
    KM=27, MA=28, MG=27, ML=28, MZ=25, NE=28, SN=28, TD=27, TG=28,
)


def _iban() -> str:
    """Of each country's length; for other letters, which no country has, the whole run."""
    own = [
        "(?:{})[0-9]{{2}}(?: ?[A-Z0-9]){{{}}}".format(
            "|".join(c for c, m in IBAN_LENGTHS.items() if m == n), n - 4
        )
        for n in sorted(set(IBAN_LENGTHS.values()))
    ]
    other = rf"(?!{'|'.join(IBAN_LENGTHS)})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}}+"
    return rf"(?:{'|'.join([*own, other])})"


# Kind to pattern, in the order in which equal starts are listed.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9]){_iban()}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE = ("email", "ip", "card", "phone")
# A text without this holds no match; cheaper than the pattern.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4}
CONTEXT = {
    "email": "e-?mail|contact|write|reach",
    "ip": "address|server|host|client|login",
    "card": "card|visa|master|amex|credit|debit|payment",
    "phone": "phone|call|tel|mobile|fax|contact",
    "iban": "iban|account|bank|transfer",
    "ssn": "ssn|social|security|identity|taxpayer",
}
CONTEXT_CHARS = 40
# What stands between the spans of a list.
LISTING = r"^[^\p{L}\p{N}]{0,40}(?:(?:and|or)[^\p{L}\p{N}]{0,40})?$"
CONTEXT_GAIN = 0.3
MIN_SCORE = 0.6


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    values = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod_97(match: Column) -> Column:
    """Whether an IBAN passes its check: the first four characters moved to the end, letters as
    10 to 35, the remainder by 97 is 1."""
    plain = F.regexp_replace(match, " ", "")
    moved = F.split(F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4)), "")
    code = lambda c: F.ascii(c)
    remainder = F.aggregate(
        moved,
        F.lit(0),
        lambda a, c: F.when(code(c) < 58, (a * 10 + code(c) - 48) % 97).otherwise(
            (a * 100 + code(c) - 55) % 97
        ),
    )
    return remainder == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = _digits(match)
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def ibans(text: Column) -> Column:
    """The different IBANs of a text as they stand there, as one pattern; empty if none."""
    # Starts are tried one by one: a look-ahead takes up no text.
    start = r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})"
    proposed = F.regexp_extract_all(text, F.lit(f"{start}(?=({_iban()})(?![A-Za-z0-9]))"), 1)
    return F.array_join(F.filter(F.array_distinct(proposed), mod_97), "|")


def _pieces(text: Column, kind: str) -> Column:
    """The text cut before and after each match: every second piece is a match."""
    if kind == "iban":  # letters, digits and blanks stand for themselves in a pattern
        known = F.concat(
            F.lit("(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})("), "ibans", F.lit(")(?![A-Za-z0-9])")
        )
        marked = F.regexp_replace(text, known, F.lit(f"{MARK}$1{MARK}"))
        return F.when(F.col("ibans") != "", F.split(marked, MARK, -1))
    marked = F.regexp_replace(text, f"({PATTERNS[kind]})", f"{MARK}$1{MARK}")
    pieces = F.split(marked, MARK, -1)
    if kind in NEEDS:
        return F.when(F.contains(text, F.lit(NEEDS[kind])), pieces)
    return pieces


SPAN = "array<struct<start:int,kind:int,end:int,score:double>>"


def _after(pieces: Column, place: Column) -> Column:
    """The ``CONTEXT_CHARS`` characters after a piece. No match is shorter than 5 characters, so
    that they are in few pieces, and in the first characters of each."""
    following = F.slice(pieces, place + 2, F.lit(2 * (CONTEXT_CHARS // 5) + 3))
    parts = F.transform(following, lambda p: F.left(p, F.lit(CONTEXT_CHARS)))
    return F.left(F.array_join(parts, ""), F.lit(CONTEXT_CHARS))


def _spans(pieces: Column, kind: str) -> Column:
    """Confirmed matches with place and score; place in kind's order breaks equal starts."""
    number = list(PATTERNS).index(kind)
    start = F.struct(
        F.lit(0).alias("at"),
        F.lit("").alias("before"),
        F.lit(False).alias("listed"),
        F.array().cast(SPAN).alias("found"),
    )

    def step(a, piece_place):
        piece = piece_place["piece"]
        end = a["at"] + F.length(piece)
        near = (
            a["listed"]
            | F.lower(a["before"]).rlike(CONTEXT[kind])
            | F.lower(piece_place["after"]).rlike(CONTEXT[kind])
        )
        score = F.least(
            F.lit(1.0), F.lit(PRIOR[kind]) + F.when(near, CONTEXT_GAIN).otherwise(0.0)
        )
        accepted = _valid(kind, piece)
        if kind not in BASE:
            accepted = accepted & (score >= MIN_SCORE)
        span = F.array(
            F.struct(
                a["at"].alias("start"),
                F.lit(number).alias("kind"),
                end.alias("end"),
                score.alias("score"),
            )
        )
        is_match = piece_place["place"] % 2 == 1
        running = F.concat(a["before"], F.right(piece, F.lit(CONTEXT_CHARS)))
        return F.struct(
            end.alias("at"),
            F.right(running, F.lit(CONTEXT_CHARS)).alias("before"),
            F.when(is_match, near)
            .otherwise(a["listed"] & F.lower(piece).rlike(LISTING))
            .alias("listed"),
            F.when(is_match & accepted, F.concat(a["found"], span)).otherwise(a["found"]).alias(
                "found"
            ),
        )

    placed = F.transform(
        pieces,
        lambda p, i: F.struct(
            p.alias("piece"),
            i.alias("place"),
            F.when(i % 2 == 1, _after(pieces, i)).otherwise("").alias("after"),
        ),
    )
    found = F.aggregate(placed, start, step)["found"]
    return F.when(F.size(pieces) > 1, found).otherwise(F.array().cast(SPAN))


def find(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """doc_id, text and ``spans``: confirmed spans of every kind, by start and kind."""
    clean = F.translate(F.coalesce(F.col(text), F.lit("")), MARK, OTHER)
    rows = docs.select(F.col(key).alias("doc_id"), clean.alias("text"))
    rows = rows.withColumn("ibans", ibans(F.col("text")))
    for kind in PATTERNS:
        rows = rows.withColumn(f"p_{kind}", _pieces(F.col("text"), kind))
    for kind in PATTERNS:
        rows = rows.withColumn(f"s_{kind}", _spans(F.col(f"p_{kind}"), kind))
    every = F.array_sort(F.concat(*[F.col(f"s_{kind}") for kind in PATTERNS]))
    return computed_once(rows, "doc_id", "text", every.alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in PATTERNS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select(
        "doc_id",
        *[of(i).alias(f"n_{kind}") for i, kind in enumerate(BASE)],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, text="text") -> DataFrame:
    """The documents with every confirmed span replaced by its kind in brackets; a span that
    starts inside an earlier one goes with it. A null text stays null; the other columns stay as
    they are, ``n_chars``, where there is one, follows the text."""
    inner = docs.select(
        F.struct(*docs.columns).alias("__pii_row"), F.col(text).alias("__pii_text")
    )
    found = find(inner, "__pii_row", "__pii_text")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in PATTERNS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a, s):
        gap = F.substr(F.col("text"), a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        inside = s["start"] < a["at"]
        return F.struct(
            F.greatest(s["end"], a["at"]).alias("at"),
            F.when(inside, a["out"])
            .otherwise(F.concat(a["out"], gap, F.get(names, s["kind"])))
            .alias("out"),
        )

    done = F.aggregate("spans", start, step)
    found = found.withColumn(
        "done", F.when(F.size("spans") > 0, F.struct(done["at"].alias("at"), done["out"].alias("out")))
    )
    changed = F.concat(F.col("done.out"), F.substr(F.col("text"), F.col("done.at") + 1))
    original = F.col(f"doc_id.{text}")
    new_text = F.when(F.col("done").isNull(), original).otherwise(changed)
    rows = found.withColumn("new_text", new_text)
    columns = []
    for name, kind in docs.dtypes:
        if name == text:
            columns.append(F.col("new_text").alias(name))
        elif name == "n_chars":
            columns.append(F.length("new_text").cast(kind).alias(name))
        else:
            columns.append(F.col(f"doc_id.`{name}`").alias(name))
    return rows.select(*columns)
