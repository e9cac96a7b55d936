"""Quality checks and the findings they produce.

A check contributes conditions to be counted and the finding rows built from the counts, so that any set of checks on a
table runs as one aggregation. Where repeated rows are asked for, each row is reduced to a digest and a bit for each
condition first: rows of one digest are equal and have equal bits, so one scan and one narrow shuffle give duplicates,
missing values, types and range rules together.

Conditions and findings are stated as SQL text: a wide table has hundreds of them, and text reaches the planner in one
call.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from retailspark.functions import dates, numbers
from retailspark.functions.numbers import pct
from retailspark.operators.clean import standard_name
from retailspark.session import scratch_folder

FINDING_COLUMNS = [
    "table_name",
    "check_name",
    "column_name",
    "issue",
    "needed",
    "count",
    "pct",
    "current_type",
    "expected_type",
]

NAMES, DUPLICATES, MISSING, TYPES, QUALITY = "names", "duplicates", "missing", "types", "quality"
CLEANING_CHECKS = [DUPLICATES, MISSING, TYPES, QUALITY]


@dataclass
class Check:
    """Named counts, and finding structs over their names, both as SQL."""

    aggregates: dict[str, str] = field(default_factory=dict)
    findings: list[str] = field(default_factory=list)


def _text(value: str | None) -> str:
    if value is None:
        return "cast(null as string)"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _share(part: str) -> str:
    """Percentage of the rows, 0 for an empty table."""
    return f"round(coalesce(try_divide({part} * 100.0D, cast(rows as double)), 0.0D), 2)"


def _finding(
    check: str,
    needed: str,
    count: str,
    column: str | None = None,
    issue: str | None = None,
    share: str = "cast(null as double)",
    current: str = "cast(null as string)",
    expected: str | None = None,
) -> str:
    return (
        f"named_struct('check_name', {_text(check)}, 'column_name', {_text(column)},"
        f" 'issue', {_text(issue)}, 'needed', {needed}, 'count', cast({count} as bigint),"
        f" 'pct', {share}, 'current_type', {current}, 'expected_type', {_text(expected)})"
    )


@dataclass
class _Source:
    """A table under neutral column names."""

    df: DataFrame
    names: list[str]
    types: list[str]
    numeric: set[int] = field(default_factory=set)
    whole: set[int] = field(default_factory=set)

    @classmethod
    def rows(cls, df: DataFrame) -> _Source:
        return cls(_positional(df), df.columns, [t for _, t in df.dtypes])

    def count(self, condition: str) -> str:
        return Condition(condition)

    def total(self) -> str:
        return TOTAL

    def nulls(self, i: int) -> str:
        """Missing values: NULL, and NaN where a column can hold it."""
        nan = f" or isnan(c{i})" if self.types[i] in ("float", "double") else ""
        return self.count(f"c{i} is null{nan}")

    def number(self, i: int) -> str:
        """Name of the DOUBLE reading of column ``i``."""
        self.numeric.add(i)
        return f"n{i}"

    def integer(self, i: int) -> str:
        """Name of the BIGINT reading of text column ``i``."""
        self.whole.add(i)
        return f"i{i}"

    def find(self, name: str) -> int | None:
        """Position of the column with this standardised name."""
        for i, raw in enumerate(self.names):
            if standard_name(raw) == name:
                return i
        return None

    def aggregate(self, aggregates: Mapping[str, str]) -> DataFrame:
        """One row with a count under each name: of rows that meet a condition, of all rows, or of ``EXTRA`` copies."""
        readings = {f"i{i}": numbers.integer(F.col(f"c{i}")) for i in sorted(self.whole)}
        for i in sorted(self.numeric):
            number = numbers.number(F.col(f"c{i}"), self.types[i])
            readings[f"n{i}"] = F.coalesce(readings[f"i{i}"].cast("double"), number) if i in self.whole else number
        df = self.df.withColumns(readings) if readings else self.df
        if EXTRA not in aggregates.values():
            counted = {TOTAL: "count(1)"}
            return df.selectExpr(*[f"{counted.get(sql, f'count_if({sql})')} as {name}" for name, sql in aggregates.items()])
        conditions = sorted({sql for sql in aggregates.values() if isinstance(sql, Condition)})
        masks = [
            " | ".join(f"if({c}, {1 << i}L, 0L)" for i, c in enumerate(conditions[at : at + BITS]))
            for at in range(0, len(conditions), BITS)
        ]
        marked = df.select(
            digest(self.df).alias("digest"), *[F.expr(sql).alias(f"mask{k}") for k, sql in enumerate(masks)]
        )
        kinds = marked.groupBy("digest").agg(
            F.count("*").alias("n"), *[F.min(f"mask{k}").alias(f"mask{k}") for k in range(len(masks))]
        )
        held = {c: f"if((mask{i // BITS} & {1 << i % BITS}L) <> 0, n, 0L)" for i, c in enumerate(conditions)}
        counted = {TOTAL: "n", EXTRA: "n - 1"} | held
        return kinds.selectExpr(*[f"coalesce(sum({counted[sql]}), 0L) as {name}" for name, sql in aggregates.items()])


class Condition(str):
    """SQL that is true for the rows to be counted."""


TOTAL, EXTRA = "all rows", "extra copies"
BITS = 62  # conditions that share a number

_AS_THEY_ARE = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "date")


def digest(df: DataFrame) -> Column:
    """Half of the SHA-256 of a row's values, each with its length: equal for equal rows, and for no others.

    As in a grouping, NULL equals NULL, NaN equals NaN and -0.0 equals 0.0.
    """
    parts = []
    for name, dtype in df.dtypes:
        c = F.col(f"`{name}`")
        if dtype in _AS_THEY_ARE or dtype.startswith("decimal"):
            text = c.cast("string")
        elif dtype in ("float", "double"):
            text = (c + F.lit(0.0).cast(dtype)).cast("string")
        elif dtype == "binary":
            text = F.hex(c)
        elif dtype == "timestamp":
            text = F.unix_micros(c).cast("string")
        elif dtype == "timestamp_ntz":
            text = c.cast("string")
        else:
            text = F.when(c.isNotNull(), F.to_json(F.struct(c.alias("v"))))
        # "length:text", or "-:" for NULL, all joined in one go.
        parts += [F.coalesce(F.octet_length(text).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit(""))]
    return F.unhex(F.left(F.sha2(F.concat(*parts), 256), F.lit(32)))


def _positional(df: DataFrame) -> DataFrame:
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def _count_true(conditions: list[str]) -> str:
    if not conditions:
        return "0"
    return "(" + " + ".join(f"if({c}, 1, 0)" for c in conditions) + ")"


def _names_check(s: _Source) -> Check:
    check = Check()
    issues = 0
    for i, name in enumerate(s.names):
        found = [("uppercase", name != name.lower()), ("spaces", " " in name)]
        for issue in [label for label, bad in found if bad]:
            issues += 1
            check.aggregates[f"held_{i}"] = s.count(f"c{i} is not null")
            check.findings.append(_finding(NAMES, "true", f"held_{i}", name, issue))
    check.findings.insert(0, _finding(NAMES, str(issues > 0).lower(), str(issues)))
    return check


def _duplicates_check(s: _Source) -> Check:
    return Check(
        {"rows": s.total(), "extra": EXTRA},
        [_finding(DUPLICATES, "extra > 0", "extra", share=_share("extra"))],
    )


def _missing_check(s: _Source) -> Check:
    check = Check({"rows": s.total()})
    for i, name in enumerate(s.names):
        check.aggregates[f"nulls_{i}"] = s.nulls(i)
        check.findings.append(
            _finding(MISSING, f"nulls_{i} > 0", f"nulls_{i}", name, share=_share(f"nulls_{i}"))
        )
    gaps = _count_true([f"nulls_{i} > 0" for i in range(len(s.names))])
    check.findings.insert(0, _finding(MISSING, f"{gaps} > 0", gaps))
    return check


# Expected type by column name: (test, expected, types that satisfy it). In the
# lenient set the first match decides; in the strict set every match applies.
_INTEGERS = ("int", "bigint")
_LENIENT = [
    (lambda n: n.endswith("id"), "int", _INTEGERS),
    (lambda n: "price" in n, "float", ("float", "double", *_INTEGERS)),
    (lambda n: "date" in n, "datetime", ("timestamp", "timestamp_ntz", "date")),
]
_STRICT = [
    (lambda n: n.endswith("id"), "int", ("bigint",)),
    (lambda n: "price" in n, "float", ("double", "bigint")),
    (lambda n: "date" in n, "datetime", ("timestamp", "timestamp_ntz")),
    (lambda n: n.endswith("name"), "string", ("string",)),
]


def expected_types(name: str, strict: bool = False) -> list[tuple[str, tuple[str, ...]]]:
    """What a column of this name should hold. ``endswith('id')`` also meets 'paid'."""
    low = name.lower()
    matches = [(kind, ok) for test, kind, ok in (_STRICT if strict else _LENIENT) if test(low)]
    return matches if strict else matches[:1]


def _one_of(value: str, options: tuple[str, ...]) -> str:
    return f"({value} in ({', '.join(_text(o) for o in options)}))"


def _types_check(s: _Source, strict: bool = False, nullable_int_is_drift: bool = False) -> Check:
    """Columns whose type differs from what their name calls for.

    A text column counts as the narrowest of bigint, double and string that holds
    all its values. With ``nullable_int_is_drift`` integers with missing values count
    as double, the type a NaN-based reader would give them.
    """
    check = Check()
    drifted = []
    for i, name in enumerate(s.names):
        rules = expected_types(name, strict)
        if not rules:
            continue
        current = _text(s.types[i])
        wants_number = any(kind in ("int", "float") for kind, _ in rules)
        if s.types[i] == "string" and wants_number:
            check.aggregates[f"no_int_{i}"] = s.count(
                f"c{i} is not null and {s.integer(i)} is null"
            )
            check.aggregates[f"no_num_{i}"] = s.count(
                f"c{i} is not null and {s.number(i)} is null"
            )
            current = (
                f"(case when no_int_{i} = 0 then 'bigint' when no_num_{i} = 0 then 'double'"
                " else 'string' end)"
            )
        if nullable_int_is_drift:
            check.aggregates[f"nulls_{i}"] = s.nulls(i)
            current = (
                f"(case when {_one_of(current, _INTEGERS)} and nulls_{i} > 0 then 'double'"
                f" else {current} end)"
            )
        for kind, accepted in rules:
            bad = f"(not {_one_of(current, accepted)})"
            drifted.append(bad)
            check.findings.append(_finding(TYPES, bad, "1", name, current=current, expected=kind))
    count = _count_true(drifted)
    check.findings.insert(0, _finding(TYPES, f"{count} > 0", count))
    return check


def _quality_check(s: _Source, table: str) -> Check | None:
    """Range and format rules of products, order items and customers."""
    rules: list[tuple[str, str, str]] = []

    def rule(column: str, issue: str, condition) -> None:
        i = s.find(column)
        if i is not None:
            rules.append((s.names[i], issue, condition(i)))

    if table == "products":
        rule("list_price", "negative_prices", lambda i: f"{s.number(i)} < 0")
    elif table == "order_items":
        rule("quantity", "negative_quantities", lambda i: f"{s.number(i)} < 0")
        rule("quantity", "zero_quantities", lambda i: f"{s.number(i)} = 0")
        rule("discount", "invalid_discounts", lambda i: f"not {s.number(i)} between 0 and 1")
    elif table == "customers":
        rule("phone", "multiple_phones", lambda i: f"contains(cast(c{i} as string), ',')")
    else:
        return None

    check = Check({"rows": s.total()})
    broken = []
    for n, (column, issue, condition) in enumerate(rules):
        key = f"rule_{n}"
        check.aggregates[key] = s.count(condition)
        broken.append(f"{key} > 0")
        check.findings.append(_finding(QUALITY, f"{key} > 0", key, column, issue, _share(key)))
    names = {standard_name(n) for n in s.names}
    if table == "customers" and {"first_name", "last_name"} <= names and "full_name" not in names:
        broken.append("true")
        check.findings.append(_finding(QUALITY, "true", "rows", "full_name", "missing_full_name"))
    count = _count_true(broken)
    check.findings.insert(0, _finding(QUALITY, f"{count} > 0", count))
    return check


def _run(s: _Source, table: str, checks: list[Check]) -> DataFrame:
    """Findings of the checks from a single aggregation of the source."""
    aggregates = {"rows": s.total()}
    findings: list[str] = []
    for check in checks:
        aggregates |= check.aggregates
        findings += check.findings
    found = s.aggregate(aggregates).selectExpr(f"inline(array({', '.join(findings)}))")
    # A summary row per check stays; detail rows only where there is something to do.
    return found.filter("column_name is null or needed").selectExpr(
        f"{_text(table)} as table_name", *FINDING_COLUMNS[1:]
    )


def profile_table(
    df: DataFrame, table: str, nullable_int_is_drift: bool = False
) -> DataFrame:
    """All findings of one table, from one scan."""
    s = _Source.rows(df)
    checks = [
        _names_check(s),
        _duplicates_check(s),
        _missing_check(s),
        _types_check(s, nullable_int_is_drift=nullable_int_is_drift),
        _quality_check(s, table),
    ]
    return _run(s, table, [c for c in checks if c])


def profile(tables: Mapping[str, DataFrame], **options) -> DataFrame:
    """Findings of a set of tables, one row per check and per column at fault."""
    return _union([profile_table(df, name, **options) for name, df in tables.items()])


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ------------------------------------------------------------ single checks


def column_names(df: DataFrame, table: str) -> DataFrame:
    s = _Source.rows(df)
    return _run(s, table, [_names_check(s)])


def duplicates(df: DataFrame, table: str) -> DataFrame:
    s = _Source.rows(df)
    return _run(s, table, [_duplicates_check(s)])


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Each row that occurs more than once, with its number of copies."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("copies")).filter("copies > 1")


def duplicate_sample(df: DataFrame, n: int = 4) -> DataFrame:
    """The first ``n`` rows among all copies of repeated rows, in column order."""
    groups = duplicate_groups(df).orderBy(*df.columns).limit(n)
    copies = F.sequence(F.lit(1), F.least("copies", F.lit(n)))
    return groups.withColumn("copy", F.explode(copies)).orderBy(*df.columns, "copy").limit(n)


def missing(df: DataFrame, table: str) -> DataFrame:
    s = _Source.rows(df)
    return _run(s, table, [_missing_check(s)])


# What to do about missing values: a condition on the column's lower-case name and share of missing values, and the
# advice. Fixed values are the share of 50 percent, the words looked for and the order; the first that holds counts.
ADVICE = {
    "mostly_empty": "pct > 50",
    "use_placeholder": "contains(name, 'phone') or contains(name, 'email')",
    "use_median": "contains(name, 'price')",
    "inspect": "true",
}


def missing_advice(findings: DataFrame) -> DataFrame:
    """What to do about each column with missing values, by the table of advice."""
    columns = findings.filter((F.col("check_name") == MISSING) & F.col("column_name").isNotNull())
    fitting = F.array(*[F.when(F.expr(condition), advice) for advice, condition in ADVICE.items()])
    return columns.withColumn("name", F.lower("column_name")).select(
        "table_name", "column_name", "count", "pct", F.array_compact(fitting)[0].alias("advice")
    )


def types(
    df: DataFrame, table: str, strict: bool = False, nullable_int_is_drift: bool = False
) -> DataFrame:
    s = _Source.rows(df)
    return _run(s, table, [_types_check(s, strict, nullable_int_is_drift)])


def quality(df: DataFrame, table: str) -> DataFrame:
    s = _Source.rows(df)
    check = _quality_check(s, table)
    if check is None:
        raise ValueError(f"no quality rules for table {table}")
    return _run(s, table, [check])


def date_order(orders: DataFrame) -> DataFrame:
    """One row: orders required before they were placed, dates parsed leniently."""
    types_of = dict(orders.dtypes)

    def day(name):
        return dates.parse_timestamp(F.col(name), types_of[name])

    late = day("required_date") < day("order_date")
    return orders.agg(F.count("*").alias("orders"), F.count_if(late).alias("date_issues"))


def ranges(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Smallest and largest value of each column."""
    types_of = dict(df.dtypes)
    values = df.select(*[numbers.number(F.col(c), types_of[c]).alias(c) for c in columns])
    bounds = values.agg(
        *[F.min(c).alias(f"min_{c}") for c in columns], *[F.max(c).alias(f"max_{c}") for c in columns]
    )
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.col(f"min_{c}").alias("min_value"),
            F.col(f"max_{c}").alias("max_value"),
        )
        for c in columns
    ]
    return bounds.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    return _union(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(len(df.columns)).cast("bigint").alias("column_count"),
            )
            for name, df in tables.items()
        ]
    )


def distinct_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Number of distinct values per column, NULL left out."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = _long(texts, columns).distinct().groupBy("column_name").agg(F.count("*").alias("n"))
    return _every(df, columns).join(F.broadcast(counts), "column_name", "left").select(
        F.lit(table).alias("table_name"),
        "column_name",
        F.coalesce("n", F.lit(0)).alias("distinct_values"),
    )


def _every(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column asked for, so that one without any value is reported too."""
    names = F.array(*[F.lit(c) for c in columns])
    return df.sparkSession.range(1).select(F.explode(names).alias("column_name"))


def value_counts(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values of a column with their counts, most frequent first, NULL left out."""
    value = F.col(column).cast("string").alias("value")
    counts = df.filter(F.col(column).isNotNull()).groupBy(value).agg(F.count("*").alias("count"))
    return counts.select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "value", "count"
    ).orderBy(F.desc("count"), "value")


ORPHAN_PARTS = 64


def orphans(
    child: DataFrame, child_table: str, child_key: str, parent: DataFrame, parent_table: str,
    parent_key: str, examples: int = 5,
) -> DataFrame:
    """One row: number of distinct child keys without a parent, and the first few.

    Keys are made distinct before the join, and the lost ones are gone through once.
    """
    keys = child.select(F.col(child_key).alias("k")).filter("k is not null").distinct()
    parents = parent.select(F.col(parent_key).alias("k"))
    lost = keys.join(parents, "k", "left_anti")
    # Each task keeps its first few; a handful of rows a task is left to merge.
    part = Window.partitionBy("_part").orderBy("k")
    numbered = lost.withColumn("_part", F.pmod(F.xxhash64("k"), F.lit(ORPHAN_PARTS)))
    numbered = numbered.withColumn("_n", F.row_number().over(part))
    merged = numbered.groupBy("_part").agg(
        F.count("*").alias("n"), F.collect_list(F.when(F.col("_n") <= examples, F.col("k"))).alias("first")
    ).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphaned_keys"), F.flatten(F.collect_list("first")).alias("first"))
    relationship = F.lit(f"{child_table}.{child_key} -> {parent_table}.{parent_key}")
    first = F.slice(F.sort_array("first"), 1, examples).cast("array<string>")
    return merged.select(
        relationship.alias("relationship"), "orphaned_keys", F.array_join(first, ", ").alias("examples")
    )


# ------------------------------------------------------------ numeric summary

QUARTILES = (0.25, 0.5, 0.75)
# Error of the quantile sketch that narrows the search: 1/ACCURACY of the rows.
ACCURACY = 10_000
# Half widths of the brackets that the sketch is asked for, in multiples of its error. The narrowest that is sure to hold
# a quartile and the value behind it is taken.
WIDTHS = tuple(2 * 4**k for k in range(9))


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """Column name and value, one row per non-NULL cell."""
    return df.select(*columns).unpivot([], columns, "column_name", "value").filter(
        "value is not null"
    )


def describe(df: DataFrame, table: str, columns: list[str], exact: bool = True) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max of numeric columns.

    Quartiles are exact with linear interpolation. A bounded sketch brackets each of them to a few ten-thousandths of
    the rows; the distinct values in the brackets are counted and sorted over all partitions, and the running counts of
    the partitions tell which few of them hold the quartiles. ``exact=False`` takes the sketch's answer.
    """
    values = _long(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns)
    value = F.col("value")
    cuts = [
        min(1.0, max(0.0, q + side * width / ACCURACY)) for q in QUARTILES for side in (-1, 1) for width in (*WIDTHS, 0)
    ]
    sketch = F.percentile_approx(value, [float(c) for c in cuts], ACCURACY)
    basic = values.groupBy("column_name").agg(
        F.count("*").alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        sketch.alias("cuts"),
    )
    # One row a column, written: it brackets the second scan and gives the first half of the result.
    basic = _written(basic.coalesce(1), "describe")
    if exact:
        result = basic.join(F.broadcast(_exact_quartiles(values, basic)), "column_name")
    else:
        step = len(WIDTHS) + 1
        result = basic.withColumns({f"q{i}": F.col("cuts")[(2 * i + 1) * step - 1] for i in range(3)})
    result = _every(df, columns).join(F.broadcast(result), "column_name", "left")
    return result.select(
        F.lit(table).alias("table_name"),
        "column_name",
        F.coalesce("n", F.lit(0)).alias("value_count"),
        "mean",
        "std",
        "min_value",
        *[F.col(f"q{i}").alias(f"q{int(q * 100)}") for i, q in enumerate(QUARTILES)],
        "max_value",
    )


def _written(df: DataFrame, label: str) -> DataFrame:
    folder = scratch_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _brackets(basic: DataFrame) -> DataFrame:
    """Per column and quartile: where the value's rank lies, and the least and greatest value it may be.

    A sketch of fewer rows than ``ACCURACY`` is exact; in general a cut is off by up to n / ACCURACY ranks. The bracket
    reaches over that and two ranks more on both sides.
    """
    n, step = F.col("n"), len(WIDTHS) + 1
    needed = (n / F.lit(ACCURACY) + 2.0) / n * ACCURACY  # half width that is enough
    choice = F.coalesce(*[F.when(F.lit(float(w)) >= needed, F.lit(k)) for k, w in enumerate(WIDTHS)], F.lit(-1))
    structs = []
    for i, q in enumerate(QUARTILES):
        position = F.lit(q) * (n - 1)
        low, high = (F.get("cuts", F.lit((2 * i + side) * step) + F.col("choice")) for side in (0, 1))
        structs.append(F.struct(
            F.lit(i).alias("i"), F.floor(position).alias("rank"), (position - F.floor(position)).alias("part"),
            F.when(F.col("choice") < 0, F.col("min_value")).otherwise(low).alias("lo"),
            F.when(F.col("choice") < 0, F.col("max_value")).otherwise(high).alias("hi"),
        ))
    chosen = basic.withColumn("choice", choice)
    return chosen.select("column_name", F.explode(F.array(*structs)).alias("t")).select("column_name", "t.*")


def _exact_quartiles(values: DataFrame, basic: DataFrame) -> DataFrame:
    value = F.col("value")
    targets = _brackets(basic)  # three rows a column, so safe to broadcast
    wide = targets.groupBy("column_name").agg(
        *[F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}{i}") for i in range(3) for c in ("lo", "hi")]
    )
    placed = values.join(F.broadcast(wide), "column_name")
    inside = reduce(
        lambda a, b: a | b, [value.between(F.col(f"lo{i}"), F.col(f"hi{i}")) for i in range(3)]
    )
    # Outside the brackets a row is only counted, as below each of them.
    counted = placed.groupBy("column_name", F.when(inside, value).alias("value")).agg(
        F.count("*").alias("copies"), *[F.count_if(value < F.col(f"lo{i}")).alias(f"below{i}") for i in range(3)],
    )
    counted = _written(counted, "describe-counted")
    below = counted.groupBy("column_name").agg(
        F.array(*[F.sum(f"below{i}") for i in range(3)]).alias("below")
    )
    targets = targets.join(F.broadcast(below), "column_name").withColumn("below", F.col("below")[F.col("i")])

    ordered = counted.filter("value is not null").select("column_name", "value", "copies")
    ordered = ordered.repartitionByRange("column_name", "value").withColumn("range", F.spark_partition_id())
    ordered = _written(ordered, "describe-ordered")
    # Values in front of each range, per column and bracket: as many rows as there are ranges, times three.
    held = ordered.join(F.broadcast(targets), "column_name").filter(value.between(F.col("lo"), F.col("hi")))
    ranges = held.groupBy("column_name", "i", "range").agg(F.sum("copies").alias("held"))
    before = Window.partitionBy("column_name", "i").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
    ranges = ranges.join(F.broadcast(targets), ["column_name", "i"]).withColumn("before", F.col("before") + F.col("below"))
    upto = F.col("before") + F.col("held")
    needed = [(F.col("before") <= F.col("rank") + k) & (F.col("rank") + k < upto) for k in (0, 1)]
    ranges = ranges.filter(needed[0] | needed[1]).select(
        "column_name", "i", "range", "rank", "part", "lo", "hi", "before"
    )
    # At most two ranges a quartile are ranked, each in a task of its own.
    found = ordered.join(F.broadcast(ranges), ["column_name", "range"]).filter(value.between(F.col("lo"), F.col("hi")))
    order = Window.partitionBy("column_name", "i", "range").orderBy("value")
    found = found.withColumn("upto", F.col("before") + F.sum("copies").over(order))
    first = found.withColumn("from", F.col("upto") - F.col("copies"))
    at = lambda k: F.max(F.when((F.col("from") <= F.col("rank") + k) & (F.col("rank") + k < F.col("upto")), value))
    picked = targets.select("column_name", "i", "rank", "part").join(
        first.groupBy("column_name", "i").agg(at(0).alias("low"), at(1).alias("high")), ["column_name", "i"], "left"
    )
    # The sketch's error bound rules this out; never answer from a wrong bracket.
    missed = F.col("low").isNull() | (F.col("high").isNull() & (F.col("part") > 0))
    low = F.when(missed, F.raise_error(F.lit("quartile outside its bracket")).cast("double")).otherwise(F.col("low"))
    high = F.coalesce("high", "low")
    return picked.groupBy("column_name").agg(
        *[
            F.max(F.when(F.col("i") == i, low + (high - low) * F.col("part"))).alias(f"q{i}")
            for i in range(3)
        ]
    )


# ------------------------------------------------ gates, scores and summaries


def _summaries(findings: DataFrame) -> DataFrame:
    return findings.filter(F.col("column_name").isNull())


def table_gates(findings: DataFrame) -> DataFrame:
    """Per table: whether any cleaning check is flagged."""
    flagged = F.col("needed") & F.col("check_name").isin(CLEANING_CHECKS)
    return findings.groupBy("table_name").agg(F.max(flagged).alias("needs_cleaning"))


def transforms_needed(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Which derived columns are still missing, and for how many rows."""
    wanted = {
        "enrich_products": ("products", ["brand_name", "category_name"]),
        "calculate_item_total": ("order_items", ["total_price"]),
        "calculate_order_total": ("orders", ["order_total"]),
    }
    frames = []
    for transformation, (table, columns) in wanted.items():
        if table in tables:
            absent = [c for c in columns if c not in tables[table].columns]
            rows = tables[table].agg(F.count("*").alias("n"))
            frames.append(
                rows.select(
                    F.lit(transformation).alias("transformation"),
                    F.lit(bool(absent)).alias("needed"),
                    F.lit(", ".join(absent)).alias("missing_columns"),
                    F.when(F.lit(bool(absent)), F.col("n")).otherwise(0).alias("rows_affected"),
                )
            )
    return _union(frames)


def gates(findings: DataFrame, transformations: DataFrame) -> DataFrame:
    """Three rows: is each step of the run called for?"""
    check = F.col("check_name")
    step = (
        F.when(check == NAMES, "column_standardization")
        .when(check.isin(CLEANING_CHECKS), "data_cleaning")
    )
    steps = _summaries(findings).groupBy(step.alias("step")).agg(F.max("needed").alias("needed"))
    transform = transformations.agg(F.max("needed").alias("needed")).select(
        F.lit("data_transformation").alias("step"), "needed"
    )
    return steps.unionByName(transform)


def score(findings: DataFrame) -> DataFrame:
    """One row: share of checks passed over all tables, in percent."""
    passed = (~F.col("needed")).cast("bigint")
    return _summaries(findings).agg(
        F.count("*").alias("total_checks"),
        F.sum(passed).alias("passed_checks"),
        pct(F.sum(passed), F.count("*")).alias("quality_score"),
    )


def table_score(df: DataFrame, table: str) -> DataFrame:
    """100 less the share of NULL cells (30 at most) and of repeated rows (20 at most)."""
    s = _Source.rows(df)
    cells = {f"nulls_{i}": s.nulls(i) for i in range(len(s.names))}
    stats = s.aggregate({"rows": s.total(), "extra": EXTRA} | cells).withColumn(
        "nulls", reduce(lambda a, b: a + b, [F.col(c) for c in cells])
    )
    rows = F.col("rows").cast("double")
    null_share = F.col("nulls") * 100.0 / (rows * len(s.names))
    extra_share = F.col("extra") * 100.0 / rows
    mark = F.when(
        F.col("rows") > 0,
        F.greatest(
            F.lit(0.0),
            F.round(
                100.0 - F.least(null_share, F.lit(30.0)) - F.least(extra_share, F.lit(20.0)), 2
            ),
        ),
    )
    band = (
        F.when(F.col("score") >= 90, "Excellent")
        .when(F.col("score") >= 70, "Good")
        .when(F.col("score") >= 50, "Fair")
        .when(F.col("score").isNotNull(), "Poor")
    )
    return stats.select(F.lit(table).alias("table_name"), mark.alias("score")).withColumn(
        "band", band
    )


def issue_summary(findings: DataFrame) -> DataFrame:
    """One line per table naming its flagged checks, or 'Clean'."""
    n = F.col("count").cast("string")
    label = (
        F.when(F.col("check_name") == NAMES, F.lit("columns"))
        .when(F.col("check_name") == DUPLICATES, F.concat(F.lit("duplicates ("), n, F.lit(")")))
        .when(F.col("check_name") == MISSING, F.concat(F.lit("missing ("), n, F.lit(" cols)")))
        .when(F.col("check_name") == TYPES, F.concat(F.lit("types ("), n, F.lit(" cols)")))
        .otherwise(F.lit("quality"))
    )
    labels = _summaries(findings).withColumn("label", F.when(F.col("needed"), label))
    return labels.groupBy("table_name").agg(
        F.coalesce(
            F.nullif(F.expr("listagg(label, ', ') within group (order by label)"), F.lit("")),
            F.lit("Clean"),
        ).alias("issues")
    )
