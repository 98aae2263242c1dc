"""Declarative data-quality rules, run as DataFrame aggregates, and the publication gate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.contracts import DAMAGED, RAW_COLUMNS, RAW_MONEY, STAR_KEYS
from marketmill.functions import fits_minor


@dataclass(frozen=True)
class Rule:
    name: str
    table: str
    columns: tuple[str, ...]
    what: str
    critical: bool = True


@dataclass(frozen=True)
class RowRule(Rule):
    """A rule one row can break on its own. All row rules of a table share one scan."""

    def broken(self) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(RowRule):
    def broken(self) -> Column:
        return reduce(Column.__or__, [F.col(c).isNull() for c in self.columns])


@dataclass(frozen=True)
class NonNegative(RowRule):
    """Null money is not a violation; a null next to a negative does not hide it."""

    def broken(self) -> Column:
        return reduce(Column.__or__, [F.col(c) < 0 for c in self.columns])


@dataclass(frozen=True)
class NewestYear(Rule):
    """The newest timestamp exists and its year lies in [first_year, last_year]."""

    first_year: int = 2016
    last_year: int = 2019


@dataclass(frozen=True)
class UniqueKey(Rule):
    pass


@dataclass(frozen=True)
class ForeignKey(Rule):
    parent: str = ""
    parent_columns: tuple[str, ...] = ()


def unique_key(table: str, name: str | None = None) -> UniqueKey:
    key = STAR_KEYS[table]
    label = key[0] if len(key) == 1 else f"({', '.join(key)})"
    return UniqueKey(name or f"{table}_pk_unique", table, key, f"duplicate {label} groups")


def standard_rules(first_year: int = 2016, last_year: int = 2019) -> list[Rule]:
    """The twelve critical checks of the publication gate."""
    # Check names, checked columns and detail texts of the published report.
    return [
        NotNull(
            "fact_orders_required_not_null",
            "fact_orders",
            ("order_id", "customer_sk"),
            "rows with null order_id or customer_sk",
        ),
        NotNull(
            "fact_order_items_required_not_null",
            "fact_order_items",
            ("order_id", "order_item_id", "product_sk", "seller_sk", "price"),
            "rows with null keys/price",
        ),
        unique_key("fact_orders"),
        unique_key("fact_order_items", "fact_order_items_composite_pk_unique"),
        unique_key("dim_customers"),
        unique_key("dim_products"),
        unique_key("dim_sellers"),
        unique_key("dim_date"),
        NonNegative(
            "fact_order_items_non_negative_money",
            "fact_order_items",
            ("price", "freight_value"),
            "rows with negative price/freight",
        ),
        NonNegative(
            "fact_orders_non_negative_money",
            "fact_orders",
            ("payment_value_total", "gmv_items"),
            "rows with negative payment/gmv",
        ),
        NewestYear(
            "source_freshness_validation",
            "fact_orders",
            ("order_purchase_timestamp",),
            "newest purchase out of range",
            first_year=first_year,
            last_year=last_year,
        ),
        ForeignKey(
            "fact_order_items_fk_order",
            "fact_order_items",
            ("order_id",),
            "item rows without matching fact_orders",
            parent="fact_orders",
            parent_columns=("order_id",),
        ),
    ]


def relation_rules() -> list[Rule]:
    """The other relations of the schema contract, as warnings."""

    def relation(table: str, column: str, parent: str, parent_column: str) -> ForeignKey:
        return ForeignKey(
            f"{table}_fk_{parent.removeprefix('dim_')}",
            table,
            (column,),
            f"rows without matching {parent}",
            critical=False,
            parent=parent,
            parent_columns=(parent_column,),
        )

    return [
        relation("fact_orders", "customer_sk", "dim_customers", "customer_sk"),
        relation("fact_orders", "purchase_date_sk", "dim_date", "date_sk"),
        relation("fact_order_items", "product_sk", "dim_products", "product_sk"),
        relation("fact_order_items", "seller_sk", "dim_sellers", "seller_sk"),
    ]


def _finding(rule: Rule, violations: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(rule.name).alias("name"),
        violations.cast("bigint").alias("violations"),
        detail.alias("detail"),
        F.lit(rule.critical).alias("critical"),
    )


def _counted(rule: Rule, violations: Column) -> Column:
    text = F.concat(F.lit(f"{rule.what}: "), violations.cast("string"))
    return _finding(rule, violations, text)


def _stamp_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("none"))


def _freshness(rule: NewestYear, lo: Column, hi: Column) -> Column:
    # A missing newest timestamp is a violation, hence the coalesce to false.
    fresh = F.coalesce(F.year(hi).between(rule.first_year, rule.last_year), F.lit(False))
    detail = F.concat(
        F.lit("min="),
        _stamp_text(lo),
        F.lit(", max="),
        _stamp_text(hi),
        F.lit(f" (newest year expected {rule.first_year}-{rule.last_year})"),
    )
    return _finding(rule, (~fresh).cast("int"), detail)


def _kind(dtype: str) -> str:
    """How a key column travels: as a number, or as text."""
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        return "whole"
    return "day" if dtype == "date" else "text"


def _part(c: str, kind: str) -> Column:
    if kind == "whole":
        return F.col(c).cast("bigint")
    return F.unix_date(c).cast("bigint") if kind == "day" else F.col(c).cast("string")


@dataclass
class _Relation:
    """One key that is counted: rows of the table that owns it, and of each rule that refers to
    it. ``kinds`` says in which of the shared columns its parts travel."""

    number: int
    kinds: tuple[str, ...]
    columns: tuple[str, ...] = ()

    def parts(self) -> list[str]:
        return [f"{'text' if k == 'text' else 'number'}{i}" for i, k in enumerate(self.kinds)]

    def no_parent(self) -> Column:
        """Nothing owns the key; a null part matches nothing."""
        missing = reduce(Column.__or__, [F.col(c).isNull() for c in self.parts()])
        return (F.col("owners") == 0) | missing


class _Audit:
    """Tagged co-aggregation: what rules count, as slots of one aggregate over all tables.

    A row of a table becomes one tagged row per key that it owns or refers to: (relation, key,
    counts). The first of them also carries what the row rules of its table say. All tables go
    through one partial aggregate, one exchange by relation and key, and one final aggregate, in
    which duplicates and orphans can be told from the counts of a key. A hot key is one row per
    task, and each table is read once, however many rules it has.
    """

    def __init__(self, tables: Mapping[str, DataFrame], rules: list[Rule]):
        self.tables = tables
        self.relations: dict[tuple, _Relation] = {}
        # Per table: (relation, columns, slot) of its tagged rows.
        self.tagged: dict[str, list[tuple[_Relation, tuple[str, ...], str]]] = {}
        self.row_rules: dict[str, list[tuple[str, Rule]]] = {}
        self.answers = [self._answer(i, rule) for i, rule in enumerate(rules)]

    def _answer(self, i: int, rule: Rule) -> tuple[Rule, list[Column]]:
        """The rule and its measures over the counts of all keys."""
        if isinstance(rule, (RowRule, NewestYear)):
            self.row_rules.setdefault(rule.table, []).append((f"rule{i}", rule))
            if isinstance(rule, RowRule):
                return rule, [F.sum(f"rule{i}")]
            return rule, [F.min(f"rule{i}_lo"), F.max(f"rule{i}_hi")]
        if isinstance(rule, UniqueKey):
            relation = self._relation(rule.table, rule.columns, rule.table, rule.columns)
            own = F.col("relation") == relation.number
            return rule, [F.count_if(own & (F.col("owners") > 1))]
        if isinstance(rule, ForeignKey):
            relation = self._relation(rule.parent, rule.parent_columns, rule.table, rule.columns)
            self.tagged.setdefault(rule.table, []).append((relation, rule.columns, f"rule{i}"))
            own = F.col("relation") == relation.number
            return rule, [F.sum(F.when(own & relation.no_parent(), F.col(f"rule{i}")))]
        raise TypeError(f"unknown rule type: {type(rule).__name__}")

    def _relation(
        self, table: str, columns: tuple[str, ...], other: str, other_columns: tuple[str, ...]
    ) -> _Relation:
        """The relation of a key, in the form that both sides' types allow."""
        one, two = dict(self.tables[table].dtypes), dict(self.tables[other].dtypes)
        kinds = tuple(
            _kind(one[a]) if _kind(one[a]) == _kind(two[b]) else "text"
            for a, b in zip(columns, other_columns, strict=True)
        )
        key = (table, columns, kinds)
        if key not in self.relations:
            relation = _Relation(len(self.relations), kinds, columns)
            self.relations[key] = relation
            self.tagged.setdefault(table, []).append((relation, columns, "owners"))
        return self.relations[key]

    def _slots(self) -> list[str]:
        counts = {slot for rows in self.tagged.values() for *_, slot in rows}
        whole = [n for rows in self.row_rules.values() for n, r in rows if isinstance(r, RowRule)]
        return sorted(counts | {"owners", *whole})

    def _stamps(self) -> dict[str, str]:
        """Type of each timestamp that is carried, by slot."""
        return {
            name: dict(self.tables[table].dtypes)[rule.columns[0]]
            for table, rows in self.row_rules.items()
            for name, rule in rows
            if isinstance(rule, NewestYear)
        }

    def _rows(self, table: str) -> DataFrame:
        """The tagged rows of one table, from one scan of it."""
        tagged = self.tagged.get(table) or [(_Relation(-1, ()), (), "")]
        width = max((len(r.kinds) for r in self.relations.values()), default=0)
        entries = []
        for first, (relation, columns, slot) in zip([True] + [False] * len(tagged), tagged):
            parts = dict(zip(relation.parts(), map(_part, columns, relation.kinds), strict=True))
            rules = dict(self.row_rules.get(table, [])) if first else {}
            values = [F.lit(relation.number).alias("relation")]
            for i in range(width):
                for name, kind in ((f"number{i}", "bigint"), (f"text{i}", "string")):
                    values.append(parts.get(name, F.lit(None)).cast(kind).alias(name))
            for name in self._slots():
                rule = rules.get(name)
                one = rule.broken() if rule else F.lit(name == slot)
                values.append(F.coalesce(one, F.lit(False)).cast("bigint").alias(name))
            for name, kind in self._stamps().items():
                stamp = F.col(rules[name].columns[0]) if name in rules else F.lit(None).cast(kind)
                values += [stamp.alias(f"{name}_lo"), stamp.alias(f"{name}_hi")]
            entries.append(F.struct(*values))
        return self.tables[table].select(F.inline(F.array(*entries)))

    def findings(self) -> DataFrame:
        """One row per rule, from one row of figures."""
        names = sorted({*self.tagged, *self.row_rules})
        rows = reduce(DataFrame.union, map(self._rows, names))
        keys = [c for c in rows.columns if c == "relation" or c.rstrip("0123456789") in ("number", "text")]
        sums = [F.sum(c).alias(c) for c in self._slots()]
        for name in self._stamps():
            sums += [F.min(f"{name}_lo").alias(f"{name}_lo"), F.max(f"{name}_hi").alias(f"{name}_hi")]
        figures = rows.groupBy(*keys).agg(*sums).agg(
            *[m.alias(f"m{i}_{k}") for i, (_, ms) in enumerate(self.answers) for k, m in enumerate(ms)]
        )
        found = []
        for i, (rule, _) in enumerate(self.answers):
            first = F.col(f"m{i}_0")
            if isinstance(rule, NewestYear):
                found.append(_freshness(rule, first, F.col(f"m{i}_1")))
            else:
                found.append(_counted(rule, F.coalesce(first, F.lit(0).cast("bigint"))))
        return figures.select(F.inline(F.array(*found)))


def run_rules(tables: Mapping[str, DataFrame], rules: Iterable[Rule]) -> DataFrame:
    """One row per rule: name, passed, flag, violations, detail, critical. Every table that a rule
    names is read once, and all keys meet in one exchange."""
    return _report([_Audit(tables, list(rules)).findings()])


def _report(parts: list[DataFrame]) -> DataFrame:
    passed = F.col("violations") == 0
    flag = F.when(passed, "PASS").when(F.col("critical"), "FAIL").otherwise("WARN")
    return reduce(DataFrame.unionByName, parts).select(
        "name",
        passed.alias("passed"),
        flag.alias("flag"),
        "violations",
        "detail",
        "critical",
    )


def raw_findings(raw: Mapping[str, DataFrame]) -> DataFrame:
    """One critical row per raw table: rows that the reader marked as damaged (too few or too
    many fields), rows with a value that its column's type cannot take, and rows with money finer
    than sums can hold."""
    parts = []
    for table, columns in RAW_COLUMNS.items():
        if table not in raw:
            continue
        df = raw[table]
        found = dict(df.dtypes)
        broken = [
            F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()
            for c, kind in columns.items()
            if kind != "string" and found[c] == "string"
        ]
        if DAMAGED in found:
            broken.append(F.col(DAMAGED).isNotNull())
        for c in RAW_MONEY.get(table, ()):
            broken.append(~fits_minor(F.col(c).try_cast("double")))
        rule = Rule(f"{table}_rows_intact", table, (), "damaged or uncastable rows")
        broken_row = reduce(Column.__or__, broken, F.lit(False))
        counted = df.agg(F.count_if(broken_row).alias("n"))
        parts.append(counted.select(F.inline(F.array(_counted(rule, F.col("n"))))))
    return _report(parts)


def gate(report: DataFrame) -> DataFrame:
    """One row: number of checks, failures by weight, and whether publication may go on."""
    failed = ~F.col("passed")
    return report.agg(
        F.count("*").alias("checks"),
        F.count_if(failed & F.col("critical")).alias("critical_failures"),
        F.count_if(failed & ~F.col("critical")).alias("warnings"),
    ).withColumn("publishable", F.col("critical_failures") == 0)
