"""Data-quality rules.

A rule names its table, column and severity and finds the rows that break it. ``run_suite`` evaluates many rules with
one scan of each table and one shuffle, however many there are; ``store_failures`` keeps what broke them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starloom.contracts import QUALITY_LOG_SCHEMA
from starloom.operators.joins import overlaps

ERROR, WARN = "error", "warn"


ROW_LEVEL = ("not_null", "accepted_values", "not_accepted_values", "range")
TABLE_LEVEL = ("unique", "unique_combination", "relationship")


@dataclass(frozen=True)
class Rule:
    """One assertion. ``kind`` is not_null, unique, unique_combination, accepted_values,
    not_accepted_values, range or relationship; ``args`` holds what that kind needs."""

    layer: str
    table: str
    kind: str
    columns: tuple[str, ...]
    severity: str = ERROR
    args: Mapping[str, object] = field(default_factory=dict, hash=False)

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{'_'.join(self.columns)}"

    @property
    def column(self) -> str:
        return self.columns[0]


def breaks(kind: str, c: Column, args: Mapping[str, object]) -> Column:
    """The failing condition of a row-level rule. NULL passes everything but not_null."""
    if kind == "not_null":
        return c.isNull()
    if kind == "accepted_values":
        return F.coalesce(~c.isin(list(args["values"])), F.lit(False))
    if kind == "not_accepted_values":
        return F.coalesce(c.isin(list(args["values"])), F.lit(False))
    if kind == "range":
        low, high, inclusive = args.get("low"), args.get("high"), args.get("inclusive", True)
        bad = F.lit(False)
        if low is not None:
            bad = bad | ((c < low) if inclusive else (c <= low))
        if high is not None:
            bad = bad | ((c > high) if inclusive else (c >= high))
        return F.coalesce(bad, F.lit(False))
    raise ValueError(f"not a row-level rule: {kind}")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(breaks("not_null", F.col(column), {}))


def accepted(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.filter(breaks("accepted_values", F.col(column), {"values": values}))


def forbidden(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.filter(breaks("not_accepted_values", F.col(column), {"values": values}))


def in_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    return df.filter(breaks("range", F.col(column), {"low": low, "high": high, "inclusive": inclusive}))


def unique(df: DataFrame, columns: Sequence[str], ignore_null: bool = True) -> DataFrame:
    """Key combinations found more than once. A single-column rule leaves NULL out."""
    rows = df.dropna(subset=list(columns)) if ignore_null else df
    return rows.groupBy(*columns).agg(F.count("*").alias("rows")).filter("rows > 1")


def relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose value has no parent."""
    return (child.filter(F.col(column).isNotNull())
            .join(parent.select(F.col(parent_column).alias("_p")), F.col(column) == F.col("_p"), "left_anti"))


def one_current(dim: DataFrame, natural: str, unknown: str = "-1") -> DataFrame:
    """Natural keys with more than one version in force."""
    return (dim.filter(F.col("es_version_vigente") & (F.col(natural) != unknown))
            .groupBy(F.col(natural).alias("clave")).agg(F.count("*").alias("versiones_vigentes"))
            .filter("versiones_vigentes > 1"))


def no_overlap(dim: DataFrame, natural: str, unknown: str = "-1") -> DataFrame:
    """Versions whose validity meets that of another version of the same key."""
    versions = dim.filter(F.col(natural) != unknown).select(
        F.col(natural).alias("clave_natural"), "valido_desde", "valido_hasta")
    return overlaps(versions, ["clave_natural"], "valido_desde", "valido_hasta")


def _note(rule: int, value: Column, failed: int = 0, rows: int = 0, known: int = 0) -> Column:
    """What a row says about a rule: the value it is about, and whether it fails by itself, carries the value, or knows it
    as a parent."""
    counts = [F.lit(n).cast("bigint").alias(name) for n, name in ((failed, "failed"), (rows, "rows"), (known, "known"))]
    return F.struct(F.lit(rule).alias("rule"), value.cast("string").alias("value"), *counts)


def _notes(table: str, rules: Sequence[Rule], child: bool = True, parent_of: bool = True) -> list[Column]:
    """What each row of a table says about the rules: on itself, on its keys, and as a parent of other tables' rows."""
    notes = []
    for i, r in enumerate(rules):
        c = F.col(r.column)
        if r.kind == "relationship":
            if r.table == table and child:
                notes.append(F.when(c.isNotNull(), _note(i, c, rows=1)))
            if r.args["to"] == table and parent_of:
                parent = F.col(r.args["field"])
                notes.append(F.when(parent.isNotNull(), _note(i, parent, known=1)))
        elif r.table != table or not child:
            continue
        elif r.kind == "unique":
            notes.append(F.when(c.isNotNull(), _note(i, c, rows=1)))
        elif r.kind == "unique_combination":  # NULL counts as a value here
            notes.append(_note(i, c if len(r.columns) == 1 else F.to_json(F.array(*[F.col(x).cast("string") for x in r.columns])), rows=1))
        else:
            notes.append(F.when(breaks(r.kind, c, r.args), _note(i, c, failed=1)))
    return notes


def _check_tables(tables: Mapping[str, DataFrame], rules: Sequence[Rule], parents: Mapping[str, DataFrame]) -> None:
    """A rule whose table is missing is an error, not a pass."""
    for rule in rules:
        if rule.kind not in ROW_LEVEL and rule.kind not in TABLE_LEVEL:
            raise ValueError(f"unknown rule kind: {rule.kind}")
        if rule.table not in tables:
            raise KeyError(f"{rule.name}: table {rule.table} is missing")
        if rule.kind == "relationship" and rule.args["to"] not in parents and rule.args["to"] not in tables:
            raise KeyError(f"{rule.name}: table {rule.args['to']} is missing")


def _value_verdicts(tables: Mapping[str, DataFrame], rules: Sequence[Rule], parents: Mapping[str, DataFrame]) -> DataFrame:
    """(rule, value, sample, failed) of every value that breaks a rule; ``failed`` counts rows, for unique rules groups.

    Each table is scanned once, whatever rules use it: its rows say what they have to say about all of them, partial
    counts by (rule, value) are taken before the only shuffle, and children meet their parents' keys there without a join.
    Only numbers are aggregated, so the counts are hashed and no row is sorted; the log's text is made of failing values.
    """
    said = []
    for table in dict.fromkeys(t for r in rules for t in (r.table, r.args.get("to", r.table))):
        said.append((tables.get(table), _notes(table, rules, parent_of=table not in parents)))
        if table in parents:
            said.append((parents[table], _notes(table, rules, child=False)))
    stacked = None
    for frame, notes in said:
        if notes:
            one = frame.select(F.explode(F.array(*notes)).alias("x")).filter(F.col("x").isNotNull()).select("x.*")
            stacked = one if stacked is None else stacked.unionByName(one)
    met = stacked.groupBy("rule", "value").agg(*[F.sum(c).alias(c) for c in ("failed", "rows", "known")])
    one, many = (F.col("rule").isin([i for i, r in enumerate(rules) if r.kind == "unique_combination" and (len(r.columns) > 1) == several])
                 for several in (False, True))
    sample = (F.when(many, F.concat_ws("|", F.from_json("value", "array<string>")))
              .when(one, F.coalesce("value", F.lit(""))).otherwise(F.col("value")))
    numbers = {kind: [i for i, r in enumerate(rules) if r.kind in kind] for kind in (("unique", "unique_combination"), ("relationship",))}
    twice, child = (F.col("rule").isin(n) for n in numbers.values())
    failed = (F.when(twice, F.when(F.col("rows") > 1, 1).otherwise(0))
              .when(child, F.when(F.col("known") == 0, F.col("rows")).otherwise(0)).otherwise(F.col("failed")))
    return met.select("rule", "value", failed.cast("bigint").alias("failed")).filter("failed > 0").select("rule", "value", sample.alias("sample"), "failed")


def run_suite(tables: Mapping[str, DataFrame], rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Result of every rule: layer, entity, test, severity, failed rows and a sample value.

    ``parents`` holds frames that stand for a table where others refer to it, for suites over a batch's rows only.
    """
    _check_tables(tables, rules, parents or {})
    counts = _value_verdicts(tables, rules, parents or {}).groupBy("rule").agg(F.sum("failed").alias("failed_rows"), F.min("sample").alias("sample_value"))
    facts = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(r.layer).alias("layer_name"), F.lit(r.table).alias("entity_name"),
                               F.lit(r.name).alias("test_name"), F.lit(r.severity).alias("severity")) for i, r in enumerate(rules)])
    spark = next(iter(tables.values())).sparkSession
    declared = spark.range(0, 1, 1, 1).select(F.explode(facts).alias("x")).select("x.*")
    return declared.join(counts, "rule", "left").select(
        "layer_name", "entity_name", "test_name", "severity", F.coalesce("failed_rows", F.lit(0)).alias("failed_rows"), "sample_value")


def tag_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows with the names of the row-level rules they break in ``_broken``, an array."""
    broken = [F.when(breaks(r.kind, F.col(r.column), r.args), F.lit(r.name)) for r in rules if r.kind in ROW_LEVEL]
    none = F.array().cast("array<string>")
    return df.withColumn("_broken", F.array_compact(F.array(*broken)) if broken else none)


def failing_rows(df: DataFrame, rules: Sequence[Rule], key: str, run_id: str, counts: Observation | None = None) -> DataFrame:
    """The rows of one table that break row-level rules, as they are stored: run, table, key, rules broken, the row as JSON.

    ``counts`` observes, in the same scan, the rows read and the failures by rule (columns ``rows`` and ``r0``, ``r1`` ... in
    the order of the row-level rules), so counting costs no second pass.
    """
    own = [r for r in rules if r.kind in ROW_LEVEL]
    tagged = tag_rows(df, own)
    if counts is not None:
        tagged = tagged.observe(counts, F.count("*").alias("rows"), *[
            F.count_if(F.array_contains("_broken", r.name)).alias(f"r{i}") for i, r in enumerate(own)])
    row = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return tagged.filter(F.size("_broken") > 0).select(
        F.lit(run_id).alias("run_id"), F.lit(own[0].table if own else None).cast("string").alias("entity_name"),
        F.col(key).cast("string").alias("row_key"), F.col("_broken").alias("rules"), row.alias("row"))


def failing_values(tables: Mapping[str, DataFrame], rules: Sequence[Rule], run_id: str) -> DataFrame:
    """The values that break unique and relationship rules, as they are stored: run, table, rule, value, failures."""
    _check_tables(tables, rules, {})
    own = [r for r in rules if r.kind in TABLE_LEVEL]
    names = F.array(*[F.struct(F.lit(r.table).alias("t"), F.lit(r.name).alias("n")) for r in own])
    fact = F.element_at(names, F.col("rule") + 1)
    return _value_verdicts(tables, own, {}).select(F.lit(run_id).alias("run_id"), fact["t"].alias("entity_name"), fact["n"].alias("test_name"),
                                               F.col("sample").alias("value"), F.col("failed").alias("failed_rows"))


def store_failures(tables: Mapping[str, DataFrame], rules: Sequence[Rule], keys: Mapping[str, str], path: str, run_id: str) -> dict[str, int]:
    """Write the failing rows of every table and the failing values of the rules between rows; give the failures by row-level rule.

    Each run has its own folder (``rows/run=.../table=...`` and ``values/run=...``), so a repeated run replaces what it wrote.
    The counts are observed while the rows are written; they are bounded by the number of rules.
    """
    found = {}
    for table in dict.fromkeys(r.table for r in rules):
        own = [r for r in rules if r.table == table and r.kind in ROW_LEVEL]
        if own:
            seen = Observation(f"rules of {table}")
            failing_rows(tables[table], own, keys[table], run_id, seen).drop("run_id", "entity_name").write.mode("overwrite").parquet(
                f"{path}/rows/run={run_id}/entity={table}")
            found |= {r.name: seen.get[f"r{i}"] for i, r in enumerate(own)}
    if any(r.kind in TABLE_LEVEL for r in rules):
        failing_values(tables, rules, run_id).drop("run_id").write.mode("overwrite").parquet(f"{path}/values/run={run_id}")
    return found


def consolidate(results: DataFrame, run_id: str, as_of: datetime) -> DataFrame:
    """Quality-log rows of the failing tests."""
    values = {"run_id": F.lit(run_id), "detected_at": F.lit(as_of)}
    return results.filter("failed_rows > 0").select(*[
        values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in QUALITY_LOG_SCHEMA.fields])


def gate(results: DataFrame) -> tuple[bool, list[str]]:
    """Whether a batch may go on, and the failed error tests. Warnings never stop it.

    The results hold one row per test, so collecting them is bounded by the suite's length.
    """
    failed = [r.test_name for r in
              results.filter((F.col("severity") == ERROR) & (F.col("failed_rows") > 0))
              .select("test_name").orderBy("test_name").collect()]
    return not failed, failed


def gate_verdict(results: DataFrame) -> DataFrame:
    """The gate as a table: errors and warnings that failed, per layer, and the verdict."""
    failed = F.col("failed_rows") > 0
    return results.groupBy("layer_name").agg(
        F.count_if(failed & (F.col("severity") == ERROR)).alias("failed_errors"),
        F.count_if(failed & (F.col("severity") == WARN)).alias("failed_warnings")).withColumn(
        "verdict", F.when(F.col("failed_errors") > 0, "STOP").otherwise("GO"))


@dataclass(frozen=True)
class IssueRule:
    """A row-level defect: where it is, when it applies and what value would repair it."""

    issue_type: str
    column: str
    condition: Column
    severity: str
    repaired: Column | None = None
    description: str = ""


def issue_log(df: DataFrame, table: str, key: str, rules: Sequence[IssueRule]) -> DataFrame:
    """One row per defect found: table, row key, column, kind, severity, the value as it is and the
    value a repair would give. One pass over the table."""
    def text(c: Column | None) -> Column:
        return (F.lit(None) if c is None else c).cast("string")

    found = F.array_compact(F.array(*[
        F.when(F.coalesce(r.condition, F.lit(False)), F.struct(
            F.lit(r.column).alias("column_name"), F.lit(r.issue_type).alias("issue_type"),
            F.lit(r.severity).alias("severity"), text(r.repaired).alias("original_clean_value"),
            text(F.col(r.column)).alias("corrupted_value"), F.lit(True).alias("is_auto_detectable"),
            F.lit("yes" if r.repaired is not None else "no").alias("is_repair_suggested"),
            F.lit(r.description).alias("description")))
        for r in rules]))
    return df.select(F.lit(table).alias("table_name"), F.col(key).alias("row_primary_key"),
                     F.explode(found).alias("x")).select("table_name", "row_primary_key", "x.*")
