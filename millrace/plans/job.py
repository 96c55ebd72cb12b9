"""Jobs: from a pipeline's config and raw CSV files to its analytic tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from collections.abc import Mapping as Map
from dataclasses import dataclass, fields
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from millrace.errors import ConfigParseError, EvalError, MillraceError, NoFilesSucceeded, NoMapping, PipelineError
from millrace.functions.expr import project
from millrace.operators.assertions import validate_assertions
from millrace.operators.lookup import Lookup, build_registry
from millrace.operators.union import union_all
from millrace.plans.model import Mapping, PipelineConfig, parse_config
from millrace.plans.validate import validate
from millrace.sources import parquet
from millrace.sources.csv import Ingested, ingest, resolve_container
from millrace.sources.objects import Objects

log = logging.getLogger(__name__)


def error(kind: str, message: str, details: list[Any] | None = None) -> dict[str, Any]:
    return {"error": {"kind": kind, "message": message, "details": details or []}}


@dataclass(frozen=True)
class Options:
    """How a job departs from the defaults.

    ``typing``: column types ``inferred`` from each file or ``declared`` in the config. ``first_mapping``: evaluate a container's first
    mapping whatever mapping is run. ``parity_unique``: see ``assertions.checks``. ``check_config``: refuse a config with problems
    instead of running what it can.
    ``multi_line``: quoted fields may hold line ends, so a file is one task; without it large files are split. ``split_months``: large
    months become several objects, written by several tasks.
    """

    typing: str = "inferred"
    first_mapping: bool = False
    parity_unique: bool = False
    check_config: bool = False
    multi_line: bool = True
    split_months: bool = False

    @staticmethod
    def parse(doc: Any) -> Options:
        """Options from a JSON object; unknown names and values of other types are errors."""
        if not isinstance(doc, dict):
            raise TypeError("options must be an object")
        known = {f.name: type(f.default) for f in fields(Options)}
        for name, value in doc.items():
            if name not in known:
                raise ValueError(f"unknown option {name}")
            if type(value) is not known[name]:
                raise TypeError(f"option {name} must be a {known[name].__name__}")
        if doc.get("typing", "inferred") not in ("inferred", "declared"):
            raise ValueError("typing must be inferred or declared")
        return Options(**doc)


def resolve_mapping(container: str, config: PipelineConfig) -> Mapping:
    """The first mapping of a container."""
    for m in config.mappings:
        if m.source_container_id == container:
            return m
    raise NoMapping(container)


def apply_mapping(df: DataFrame, mapping: Mapping, lookups: Map[str, Lookup]) -> DataFrame:
    """A mapping's columns over typed source rows."""
    return project(df, {c.name: c.expr for c in mapping.columns}, lookups)


def ingest_mapping(
    objects: Objects, keys: Map[str, str], mapping: Mapping, config: PipelineConfig, lookups: Map[str, Lookup], options: Options | None = None, read: dict[tuple[str, ...], Ingested] | None = None
) -> DataFrame:
    """A mapping over its files (key under the pipeline: key under the root). Files that fail are logged and left out; none left is an error.

    ``read`` holds what mappings of the same container and files have in common: files are checked and typed once.
    """
    options = options or Options()
    read = {} if read is None else read
    by_container: dict[str, list[str]] = {}
    for key, full in keys.items():
        by_container.setdefault(resolve_container(key, config.source_containers).id, []).append(full)
    frames, failed = [], {}
    for name, files in by_container.items():
        container = next(c for c in config.source_containers if c.id == name)
        chosen = resolve_mapping(name, config) if options.first_mapping or name != mapping.source_container_id else mapping
        if (name, *files) not in read:
            read[name, *files] = ingest(objects, files, container.schema, options.typing, options.multi_line)
        got = read[name, *files]
        failed |= got.failed
        for group in got.groups:
            try:
                frames.append(apply_mapping(group.frame, chosen, lookups))
            except EvalError as e:
                failed |= dict.fromkeys(group.keys, PipelineError(f"evaluator error: {e}"))
    for key, e in failed.items():
        log.warning("skipping %s: %s", key, e)
    if not frames:
        raise NoFilesSucceeded
    return union_all(frames)


def run_pipeline(spark: SparkSession, root: str, pipeline_prefix: str, clean_run: bool = False, options: Options | None = None) -> dict[str, Any]:
    """Run the pipeline whose config is ``<pipeline_prefix>pipeline.json`` under ``root``; returns the report.

    Mappings fail one by one: their errors are listed and the others run. With ``clean_run`` the older objects of all the config's
    tables are deleted, whatever the run finds: a table's as soon as the first of its new results is staged, else when the run ends.
    """
    objects = Objects(spark, root)
    try:
        text = objects.read(f"{pipeline_prefix}pipeline.json")
    except Exception as e:
        return error("config_read_failed", str(e).splitlines()[0])
    try:
        config = parse_config(text)
    except ConfigParseError as e:
        return error("config_parse_failed", str(e))
    options = options or Options()
    if options.check_config and (problems := validate(config)):
        return error("config_invalid", f"{len(problems)} problem(s) in the config", [p.json() for p in problems])
    lookups = build_registry(config.lookup_mappings)
    files: dict[str, str] = {}
    for c in config.source_containers:
        for key in objects.keys(pipeline_prefix + c.path_prefix):
            if key.endswith(".csv"):
                files[key.removeprefix(pipeline_prefix)] = key
    old = {t.id for t in config.analytic_tables} if clean_run else set()

    def clean(table: str) -> None:
        if table in old:
            old.remove(table)
            objects.delete(f"{pipeline_prefix}clean/{table}/")

    written, errors = 0, []
    read: dict[tuple[str, ...], Ingested] = {}
    for mapping in config.mappings:
        found = _run_mapping(objects, files, mapping, config, lookups, pipeline_prefix, options, clean, read)
        written += found[0]
        errors += found[1]
    for table in sorted(old):
        clean(table)
    if not files:
        return error("no_files", "No CSV files found to process")
    return {"job_id": str(uuid.uuid4()), "partitions_written": written, "files_processed": len(files), "errors": errors}


def _run_mapping(objects: Objects, files: dict[str, str], mapping: Mapping, config: PipelineConfig, lookups: Map[str, Lookup], prefix: str, options: Options, clean: Callable[[str], None], read: dict[tuple[str, ...], Ingested]) -> tuple[int, list[str]]:
    container = next((c for c in config.source_containers if c.id == mapping.source_container_id), None)
    own = {k: v for k, v in files.items() if container and k.startswith(container.path_prefix)}
    if not own:
        return 0, []
    step, staged = f"ingest {mapping.id}", None
    try:
        df = ingest_mapping(objects, own, mapping, config, lookups, options, read)
        table = next((t for t in config.analytic_tables if t.id == mapping.analytic_table_id), None)
        if table is None:
            return 0, [f"table {mapping.analytic_table_id} not found"]
        step = f"collect {mapping.id}"
        supported = not mapping.partition_by or mapping.partition_by.granularity == "month"
        if supported:
            staged = parquet.stage(df, mapping, objects, prefix, options.split_months)
        violations = validate_assertions(staged.frame if staged else df, table, options.parity_unique)
        if violations:
            return 0, [f"assertion {mapping.id}: {v}" for v in violations]
        step = f"partition {mapping.id}"
        parquet.check_granularity(mapping.partition_by)
        assert staged
        step = f"upload {mapping.id}"
        clean(table.id)
        return len(staged.publish(table.id)), []
    except MillraceError as e:
        return 0, [f"{step}: {e}"]
    except Exception as e:  # what Spark raises while it runs fails this mapping only
        log.exception("%s failed", step)
        return 0, [f"{step}: {(str(e).splitlines() or [type(e).__name__])[0]}"]
    finally:
        if staged:
            staged.discard()
