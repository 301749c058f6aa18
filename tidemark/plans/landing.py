"""Landing runs: one table (``land_table``) or a list of tables (``land_tables``)."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fs
from tidemark.config import TableConfig, check_configs, config_from_entry, normal_root
from tidemark.functions.attributes import ATTRIBUTE_TYPE
from tidemark.functions.naming import run_folder
from tidemark.operators.diff import new_records
from tidemark.operators.flatten import field_needs, flatten_items
from tidemark.operators.quality import DEFAULT_RULES, check_rules, failed_rules
from tidemark.operators.schema import enforce_schema, unified_string_schema
from tidemark.operators.stamp import check_audit_names, stamp_run
from tidemark.plans.key_index import index_run, landed_keys
from tidemark.plans.lease import LeaseLostError, RootLease
from tidemark.plans.manifest import RunEntry, landed_rows, landed_runs, record_run
from tidemark.plans.partitioning import ensure_parallelism
from tidemark.plans.reconcile import by_schema, keep_schema, key_types_differ, read_reconciled
from tidemark.session import checkpoint_root, scratch_folder
from tidemark.sinks.runs import write_run
from tidemark.sources.items import ITEM_COL, parse_items
from tidemark.sources.landed import read_landed
from tidemark.sources.scan import read_items_scan, scan_options


class EmptySourceError(RuntimeError):
    """The source has no rows and the table is configured with ``on_empty="error"``."""


class RuleViolation(RuntimeError):
    """A quality rule failed and the run was asked to stop on violations."""


class LandingError(RuntimeError):
    """Comparing with or writing under a landed root failed (the cause is chained)."""


class MalformedSourceError(LandingError):
    """The source holds export lines that are not JSON or have no ``Item``."""


#: Errors that another attempt cannot mend: configuration, data and finished folders.
NOT_RETRIED = (ValueError, FileExistsError, RuleViolation, EmptySourceError, MalformedSourceError)
MALFORMED = "malformed export line (not JSON or without Item)"


def _observed(observation: Observation, *names: str) -> dict[str, int]:
    """Metrics of a finished write; 0 where Spark dropped an input it found to be empty.

    Adaptive execution replaces a join whose source side has no rows, and the
    observation inside goes with it; a source with rows is never dropped.
    """
    try:
        got = observation.get
    except Exception:  # py4j raises different errors for a metric that never came
        got = {}
    return {n: int(got.get(n) or 0) for n in names}


def _text(e: Exception) -> str:
    return str(getattr(e, "desc", None) or e)


def _first_line(e: Exception) -> str:
    return next((ln.strip() for ln in _text(e).splitlines() if ln.strip()), type(e).__name__)


@dataclass
class RunReport:
    table_name: str
    key_kind: str
    status: str  # SUCCEEDED | FAILED
    mode: str  # full | incremental | none | skipped
    source_rows: int | None
    new_rows: int | None
    run_folder: str
    landed_rows: int | None = None
    attempts: int = 1
    rules_failed: str | None = None
    error: str | None = None


REPORT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("key_kind", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("source_rows", T.LongType()),
        T.StructField("new_rows", T.LongType()),
        T.StructField("run_folder", T.StringType()),
        T.StructField("landed_rows", T.LongType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("rules_failed", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def _is_item_frame(df: DataFrame) -> bool:
    if ITEM_COL not in df.columns:
        return False
    dt = df.schema[ITEM_COL].dataType
    return isinstance(dt, T.MapType) and dt.valueType == ATTRIBUTE_TYPE


def scan_progress(spark: SparkSession, config: TableConfig, run_at: datetime) -> str | None:
    """Folder for the pages of a run's scan, the same for every attempt of the run; None unless the scan is to resume."""
    if config.source_format != "items_scan" or str(config.options.get("resume", "")).lower() != "true":
        return None
    root = hashlib.sha256(normal_root(config.root).encode()).hexdigest()[:32]
    return f"{checkpoint_root(spark)}/tidemark/scan-progress/{root}/{run_at:%Y%m%d%H%M%S}"


def load_source(spark: SparkSession, config: TableConfig, progress: str | None = None) -> tuple[DataFrame, str | None]:
    """(source rows, staging folder or None); items stay items here (``land_table`` flattens them).

    Item lines get the input parallelism guard before parsing (CPU work per
    line); Parquet and a callable's frame are used as built (a later
    anti-join would be pushed below a repartition anyway). A scan is staged,
    so that the table is read once; the folder is the caller's to remove, as
    is ``progress``, where a scan keeps its pages.
    """
    if callable(config.source):
        return config.source(spark), None
    if config.source_format == "items_json":
        lines = spark.read.options(**config.options).text(config.source)
        return parse_items(ensure_parallelism(lines)), None
    if config.source_format == "items_scan":
        folder = scratch_folder(spark, "scan")
        return read_items_scan(spark, config.source, staging_folder=folder, progress=progress, **scan_options(config.options)), folder
    return spark.read.options(**config.options).parquet(config.source), None


def land_table(
    spark: SparkSession,
    config: TableConfig,
    run_at: datetime | None = None,
    source: DataFrame | None = None,
    rules: Sequence | None = None,
    fail_on_violation: bool | None = None,
    strategy: str | None = None,
    owner: str | None = None,
) -> RunReport:
    """Land the records of one table whose key is not landed yet.

    Reads the source (``source`` overrides ``config.source``), checks the
    rules, anti-joins with the keys of every landed run folder, stamps the
    run date/time and writes ``root/YYYY/MM/DD/HH-MM-SS/`` in one job.
    Nothing landed yet means a full load. A run with no new record leaves
    no folder. A folder of the same run left unfinished by an earlier
    attempt (no ``_SUCCESS``) is removed first, so a retry never reads its
    partial files as landed. The folder is marked with ``owner`` (default: a
    new id) before data is written to it.

    Nothing is published that is taken back: a malformed export line fails
    the write itself, and with ``fail_on_violation`` the data rules are
    evaluated by an aggregate before it. Otherwise data rules are aggregates
    observed by the write. ``rules`` and ``fail_on_violation`` override the
    table's own. An error after the folder is committed is reported with the
    run, which has landed.

    One landing at a time holds the root (``config.lease_seconds``): a second
    one waits and then compares with what the first has landed. A holder that
    was silent too long and finds its lease taken removes its run folder and
    raises :class:`~tidemark.plans.lease.LeaseLostError`.

    Jobs per run stay constant as rows grow: field discovery (items without
    ``config.fields``) and the write. The landed row count comes from the
    runs' manifests; only runs without one cost a count of Parquet metadata.
    With ``config.key_index`` one more job joins key hashes, and two write the
    index of the run. An index that cannot be written is reported with the
    run, which has landed; its keys are then read whole.
    An empty source is known from the write's own row count, by whichever
    join Spark chose, and leaves nothing behind.
    ``source_rows`` is counted by an Observation beside the join input; if a
    stage is re-run after an executor loss it can over-count, ``new_rows``
    (counted in the writing stage) cannot.
    """
    run_at = run_at or datetime.now()
    folder = run_folder(config.root, run_at)
    report = RunReport(config.name, config.key_kind, "SUCCEEDED", "full", None, None, folder)
    if rules is None:
        rules = DEFAULT_RULES if config.rules is None else config.rules
    if fail_on_violation is None:
        fail_on_violation = config.fail_on_violation

    root_existed = fs.exists(spark, config.root)
    lease = RootLease(spark, config.root, config.lease_seconds, config.lease_wait_seconds).acquire() if config.lease_seconds else None
    try:
        return _land_held(spark, config, report, run_at, source, rules, fail_on_violation, strategy, owner, root_existed, lease)
    finally:
        if lease is not None:
            if not root_existed:
                fs.drop_unused_root(spark, config.root)
            lease.release()


def _land_held(spark, config, report, run_at, source, rules, fail_on_violation, strategy, owner, root_existed, lease) -> RunReport:
    folder = report.run_folder
    if fs.exists(spark, folder):
        if fs.is_committed(spark, folder):
            raise FileExistsError(f"run folder {folder} already holds a finished run")
        fs.delete(spark, folder)

    staging = None
    progress = scan_progress(spark, config, run_at) if source is None else None
    try:
        src, staging = (source, None) if source is not None else load_source(spark, config, progress)
        if _is_item_frame(src):
            needs = None if config.fields is not None else field_needs(src)
            fields = config.fields if needs is None else sorted(needs)
            flag = "__malformed"
            while flag in {f.lower() for f in fields}:
                flag += "_"
            raw_fields = None if needs is None else {f for f, odd in needs.items() if odd}
            src = flatten_items(src, fields=fields, malformed_col=flag, raw_fields=raw_fields)
            src = src.where(~F.when(F.col(flag), F.raise_error(F.lit(MALFORMED)).cast("boolean")).otherwise(False)).drop(flag)
        elif config.as_text:
            src = enforce_schema(src, unified_string_schema(src))
        missing = [k for k in config.keys if k not in src.columns]
        if missing:
            raise ValueError(f"table {config.name!r}: key columns {missing} not in source")
        check_audit_names(src, config.audit_names)
        report = _land(spark, config, report, src, run_at, rules, fail_on_violation,
                     strategy or config.join_strategy, owner or uuid.uuid4().hex, root_existed, lease)
        if progress is not None:  # with the pages of earlier runs that were given up
            fs.delete(spark, progress.rpartition("/")[0])
        return report
    finally:
        if staging is not None:
            fs.delete(spark, staging)


def _land(spark, config, report, src, run_at, rules, fail_on_violation, strategy, owner, root_existed, lease) -> RunReport:
    folder = report.run_folder
    # Metadata rules are checked now; data rules before the write if they may stop it, else by the write itself.
    failed = {r.text for r in rules if r.metadata_only and not r.evaluate(src)[1]}
    data_rules = [r for r in rules if not r.metadata_only]

    def stop_on_violation() -> None:
        if failed and fail_on_violation:
            raise RuleViolation(f"table {config.name!r}: failed rules {[r.text for r in rules if r.text in failed]}; nothing landed")

    stop_on_violation()
    written = None
    try:
        if fail_on_violation and data_rules:
            failed |= set(failed_rules(check_rules(src, data_rules)))
            stop_on_violation()
        known = landed_runs(spark, config.root)
        landed = None
        if known.runs or known.unmarked:
            groups = by_schema(spark, known) if config.widen_types else {}
            if key_types_differ(groups, config.keys):
                landed = read_reconciled(spark, config.root, config.keys, groups=groups)
            elif config.key_index:
                landed = landed_keys(spark, known, src, config.keys)
            if landed is None:
                landed = read_landed(spark, config.root, keys=config.keys)
        report.mode = "full" if landed is None else "incremental"
        report.landed_rows = 0 if landed is None else landed_rows(spark, known)
        seen = Observation()
        observed = src.observe(
            seen, F.count(F.lit(1)).alias("rows"),
            *[r.actual(src).cast("bigint").alias(f"rule{i}") for i, r in enumerate(data_rules)],
        )
        new = stamp_run(new_records(
            observed, landed, config.keys, config.null_safe, strategy, config.broadcast_max_bytes, report.landed_rows,
        ), run_at, config.audit_names)
        fs.claim_folder(spark, folder, owner)
        written = write_run(
            new, folder, config.layout, config.keys, mode="append",
            cluster=config.cluster_per_key, options=config.write_options,
        )
    except Exception as e:
        if isinstance(e, RuleViolation):
            raise
        if fs.is_committed(spark, folder) and fs.folder_owner(spark, folder) == owner:
            report.error = f"landed; then {type(e).__name__}: {_text(e)}"
            return report
        # e.g. key columns whose type differs between run folders of the root
        try:
            if fs.exists(spark, folder) and not fs.is_committed(spark, folder):
                fs.remove_run_folder(spark, folder, config.root, drop_root=not root_existed)
        except Exception:  # best effort; a retry of this run removes it too
            pass
        if MALFORMED in str(e):
            raise MalformedSourceError(f"table {config.name!r}: {MALFORMED}; nothing landed") from e
        raise LandingError(
            f"table {config.name!r}: landing under {config.root!r} into {folder!r} failed: "
            f"{type(e).__name__}: {_first_line(e)}"
        ) from e
    if lease is not None and not lease.held():
        fs.remove_run_folder(spark, folder, config.root)
        raise LeaseLostError(f"table {config.name!r}: another landing took over {config.root!r}; nothing landed by this one")
    if written == 0:
        fs.remove_run_folder(spark, folder, config.root, drop_root=not root_existed)
        report.mode = "none"
    else:
        report.error = _describe_run(spark, config, known, folder, written, new.schema)
    report.new_rows = written
    metrics = _observed(seen, "rows", *[f"rule{i}" for i in range(len(data_rules))])
    report.source_rows = max(metrics["rows"], written)
    failed |= {r.text for i, r in enumerate(data_rules) if not r.holds(metrics[f"rule{i}"])}
    report.rules_failed = "; ".join(r.text for r in rules if r.text in failed) or None
    if report.source_rows == 0:
        # known from the write's own observation: no separate emptiness job
        if config.on_empty == "error":
            raise EmptySourceError(f"table {config.name!r}: source has no rows")
        report.mode = "skipped"
    return report


def _describe_run(spark, config, known, folder: str, rows: int, schema: T.StructType) -> str | None:
    """Write a finished run's key index and manifest; what went wrong, if anything (the run has landed either way)."""
    error, entry = None, RunEntry(rows)
    try:
        if config.key_index:
            entry = index_run(spark, folder, config.keys, rows)
    except Exception as e:
        error = f"landed without a key index: {type(e).__name__}: {_first_line(e)}"
    try:
        record_run(spark, known, folder, replace(entry, schema=keep_schema(spark, known.root, schema)))
    except Exception as e:
        error = f"landed without a manifest: {type(e).__name__}: {_first_line(e)}"
    return error


def configs_from_frame(df: DataFrame, scheme: str = "s3a", **overrides) -> list[TableConfig]:
    """TableConfigs from a config table: launcher argument columns, ``source`` and any table options.

    NULL cells are left out, unknown columns are errors. A config table has
    one row per landed table, so collecting it is bounded by the number of
    tables.
    """
    if "source" not in df.columns:
        raise ValueError("a config table needs a 'source' column")
    configs = []
    for row in df.collect():
        entry = {k: v for k, v in row.asDict().items() if v is not None}
        configs.append(config_from_entry({**entry, **overrides}, scheme))
    return configs


def land_tables(
    spark: SparkSession,
    configs: Sequence[TableConfig],
    run_at: datetime | None = None,
    max_attempts: int = 3,
    retry_wait_seconds: float = 0.0,
    max_parallel_tables: int = 1,
    job_group_prefix: str = "tidemark:",
    **land_options,
) -> DataFrame:
    """Land every table; returns one report row per table (``REPORT_SCHEMA``).

    ``configs`` is a list of TableConfig, or a small DataFrame with one row
    per table holding the launcher argument names and a ``source`` column
    (see :func:`configs_from_frame`).

    A failing table is retried up to ``max_attempts`` times with the same
    run time (so the same run folder), unless the error is one that another
    attempt cannot mend (``NOT_RETRIED``); it is then reported FAILED, with
    the attempts made and the whole error, and the others go on. Tables run one after another by
    default; ``max_parallel_tables`` > 1 submits several landings at once
    from driver threads (each is its own set of Spark jobs).
    """
    if isinstance(configs, DataFrame):
        configs = configs_from_frame(configs)
    check_configs(configs)
    run_at = run_at or datetime.now()

    sc = spark.sparkContext

    def one(cfg: TableConfig) -> RunReport:
        last_error, attempt = None, 0
        # jobs of one table share a group: visible per table, cancellable with cancelJobGroup
        sc.setJobGroup(f"{job_group_prefix}{cfg.name}", f"landing {cfg.name} into {cfg.root}")
        try:
            for attempt in range(1, max_attempts + 1):
                try:
                    rep = land_table(spark, cfg, run_at=run_at, **land_options)
                    rep.attempts = attempt
                    return rep
                except Exception as e:  # reported, the other tables go on
                    last_error = f"{type(e).__name__}: {e}"
                    if isinstance(e, NOT_RETRIED):
                        break
                    if attempt < max_attempts and retry_wait_seconds:
                        time.sleep(retry_wait_seconds)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
            sc.setLocalProperty("spark.job.description", None)
        return RunReport(
            cfg.name, cfg.key_kind, "FAILED", "none", None, None,
            run_folder(cfg.root, run_at), None, attempt, None, last_error,
        )

    if max_parallel_tables > 1:
        with ThreadPoolExecutor(max_workers=max_parallel_tables) as pool:
            reports = list(pool.map(one, configs))
    else:
        reports = [one(cfg) for cfg in configs]
    return spark.createDataFrame([tuple(asdict(r).values()) for r in reports], REPORT_SCHEMA)
