"""Run the steps in order over a folder of tables, with a report and a run log."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.operators.duplicates import duplicates_report
from namewright.operators.identity import assign_ids, enrich, ensure_columns, unify_ids
from namewright.operators.mapping import apply_mapping
from namewright.operators.merge import ACTION, ACTIONS, action_counts, merge
from namewright.plans.shared import path_exists, settle
from namewright.sources.mapping_csv import load_mapping, split_rejects
from namewright.sources.tables import load_table, require, table_exists, write_table

# Repaired records shown in a report.
FIXED_EXAMPLES = 5

RUN_LOG = "run_log"
RUN_LOG_FIELDS = "time timestamp, job_id string, component string, success boolean, message string, rows bigint"


@dataclass(frozen=True)
class EntityTables:
    """Names of the tables and columns a run works on."""

    entity: str = "institution"
    name_col: str = "institution"
    id_col: str = "uuid_institution"
    passthrough: tuple[str, ...] = ("uuid_institution", "english_name", "parent_institution")
    mapping: str = "institution_mapping"
    lookup: str = "institution_country"
    lookup_col: str = "uuid_country"
    deprecated_col: str = "uuid_deprecated"
    output: str = "deduplicated_institutions"
    # Relation tables that repeat the name: table to name column.
    edges: tuple[tuple[str, str], ...] = ()
    # Columns of the duplicate check; None is all. Keys are left out in any case.
    checked: list[str] | None = None


@dataclass
class StepReport:
    name: str
    success: bool | None = None
    error: str | None = None
    rows: int | None = None
    details: dict = field(default_factory=dict)


@dataclass
class RunReport:
    job_id: str
    steps: list[StepReport]

    @property
    def success(self) -> bool:
        return all(step.success is not False for step in self.steps)


def _load_mapping(
    spark: SparkSession, base: str, names: EntityTables, csv: str | None, multi_line: bool, report: StepReport
) -> None:
    """The file is parsed once; its rejected rows become the table ``<mapping>_rejects``, with their reasons."""
    if csv is None:
        report.rows = load_table(spark, base, names.mapping).count()
        report.details["skipped"] = ["no file given; the stored mapping stays"]
        return
    parsed = settle(load_mapping(spark, csv, multi_line=multi_line), "mapping-file", repaired=F.count_if("repaired"))
    accepted, rejected = split_rejects(parsed.df)
    report.details["rejected"] = write_table(rejected, base, f"{names.mapping}_rejects")["rows"]
    report.details["auto_fixed"] = parsed.measures["repaired"]
    if parsed.measures["repaired"]:
        examples = parsed.df.filter("repaired").orderBy("_ord").select("original", "normalized").limit(FIXED_EXAMPLES)
        report.details["auto_fixed_examples"] = [row.asDict() for row in examples.collect()]
    target = load_table(spark, base, names.mapping) if table_exists(spark, base, names.mapping) else None
    merged = merge(target, accepted.select("original", "normalized", "_ord"), ["original"], "_ord")
    found = write_table(merged, base, names.mapping, hidden=(ACTION,), **action_counts())
    report.rows = found["rows"]
    report.details.update({action: found[action] for action in ACTIONS})


def _apply(spark: SparkSession, base: str, names: EntityTables, as_of: Column, report: StepReport) -> None:
    mapping = load_table(spark, base, names.mapping)
    entity = load_table(spark, base, names.entity)
    mapped = apply_mapping(entity, mapping, names.name_col, as_of, list(names.passthrough))
    edges = [(table, col, load_table(spark, base, table)) for table, col in names.edges]
    for table, col, edge in edges:
        require(edge, [col], table)
    report.rows = write_table(mapped, base, names.output)["rows"]
    for table, col, edge in edges:
        output = f"deduplicated_{table}"
        report.details[output] = write_table(apply_mapping(edge, mapping, col, as_of), base, output)["rows"]


def _add_columns(spark: SparkSession, base: str, names: EntityTables, report: StepReport) -> None:
    rows = load_table(spark, base, names.output)
    require(rows, [names.id_col, names.name_col], names.output)
    had_ids = "id" in rows.columns
    rows, added = ensure_columns(rows, {names.lookup_col: "string", names.deprecated_col: "string"})
    report.details.update(added)
    if table_exists(spark, base, names.lookup):
        rows = enrich(rows, load_table(spark, base, names.lookup), names.id_col, names.lookup_col)
        report.details["executed"].append(f"{names.lookup_col} from {names.lookup}")
    else:
        report.details["skipped"].append(f"{names.lookup} does not exist")
    rows = assign_ids(rows, [names.id_col, f"original_{names.name_col}"])
    report.details["skipped" if had_ids else "executed"].append("id")
    report.rows = write_table(rows, base, names.output)["rows"]


def _update_ids(spark: SparkSession, base: str, names: EntityTables, report: StepReport) -> None:
    before = load_table(spark, base, names.output)
    require(before, ["id"], names.output)
    group = [names.name_col, names.lookup_col]
    after = unify_ids(
        before, group, names.id_col, names.deprecated_col, "was_deduplicated", changed_col="__changed"
    )
    found = write_table(after, base, names.output, hidden=("__changed",), updated=F.count_if("__changed"))
    report.rows = found["rows"]
    report.details["updated"] = found["updated"]


def _check(spark: SparkSession, base: str, names: EntityTables, report: StepReport) -> None:
    rows = load_table(spark, base, names.output)
    keys = ["id"] if "id" in rows.columns else []
    found = duplicates_report(rows, keys=keys, columns=names.checked, id_col=keys[0] if keys else None, infer_keys=True)
    report.rows = write_table(found, base, f"{names.output}_duplicates")["rows"]


def run_log(spark: SparkSession, base: str) -> DataFrame:
    """One row per step ever run; the input of errors() and component_status()."""
    path = f"{base}/{RUN_LOG}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], RUN_LOG_FIELDS)
    return spark.read.schema(RUN_LOG_FIELDS).json(path)


def _append_log(spark: SparkSession, base: str, report: RunReport) -> None:
    rows = [(report.job_id, s.name, s.success, s.error or "", s.rows) for s in report.steps if s.success is not None]
    if rows:
        logged = spark.createDataFrame(
            rows, "job_id string, component string, success boolean, message string, rows bigint"
        ).withColumn("time", F.current_timestamp())
        logged.coalesce(1).write.mode("append").json(f"{base}/{RUN_LOG}")


def last_run(spark: SparkSession, base: str) -> DataFrame:
    """The steps of the newest run."""
    log = run_log(spark, base)
    newest = log.select(F.max_by("job_id", "time")).scalar()
    return log.filter(F.col("job_id") == newest)


# The steps a mode stands for, in order.
MODES = {
    "load-mapping": ("load-mapping",),
    "apply-deduplication": ("apply-deduplication",),
    "add-columns": ("add-columns",),
    "update-uuids": ("update-uuids",),
    "check-duplicates": ("check-duplicates",),
    "run-all": ("apply-deduplication", "add-columns", "update-uuids"),
    "sync-now": ("load-mapping", "apply-deduplication", "add-columns", "update-uuids"),
}


def run_mode(
    spark: SparkSession,
    base: str,
    mode: str = "run-all",
    names: EntityTables | None = None,
    mapping_csv: str | None = None,
    as_of: Column | None = None,
    dry_run: bool = False,
    continue_on_error: bool = False,
    multi_line: bool = True,
) -> RunReport:
    """Run the steps of a mode and report on each.

    Every step reads tables, writes a new version of its output and only then counts as done, so a failed step leaves
    the tables as they were. It also ends the run unless ``continue_on_error``; the steps after it are reported as not
    run. With ``dry_run`` nothing is read or written. ``multi_line`` False lets Spark split a large mapping file, which
    must then have no line breaks inside quotes.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}; one of {', '.join(MODES)}")
    names = names or EntityTables()
    stamp = as_of if as_of is not None else F.current_timestamp()
    actions: dict[str, Callable[[StepReport], None]] = {
        "load-mapping": lambda r: _load_mapping(spark, base, names, mapping_csv, multi_line, r),
        "apply-deduplication": lambda r: _apply(spark, base, names, stamp, r),
        "add-columns": lambda r: _add_columns(spark, base, names, r),
        "update-uuids": lambda r: _update_ids(spark, base, names, r),
        "check-duplicates": lambda r: _check(spark, base, names, r),
    }
    report = RunReport(uuid.uuid4().hex, [StepReport(name) for name in MODES[mode]])
    if dry_run:
        return report
    for step in report.steps:
        try:
            actions[step.name](step)
            step.success = True
        except Exception as exc:
            step.success, step.error = False, str(exc)
            if not continue_on_error:
                break
    _append_log(spark, base, report)
    return report
