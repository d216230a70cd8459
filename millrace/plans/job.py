"""The catalogue job: read every source, transform, write, check the output."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from millrace.operators.catalogue import transform
from millrace.operators.columns import coerce_and_fill, conform, normalize_names, rename
from millrace.sinks import Receipt, discard, publish, read_back, require_output, write_parquet

log = logging.getLogger(__name__)

_ABSENT = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


@dataclass(frozen=True)
class Source:
    """A named reader, with the renaming its columns need before the union."""

    name: str
    read: Callable[[SparkSession], DataFrame]
    columns: Mapping[str, str] = field(default_factory=dict)
    required: bool = False


@dataclass(frozen=True)
class Job:
    """What to read, how to treat it, and where it goes: ``lake/zone/dataset``.

    With ``add_missing_columns`` every source is conformed: exactly the canonical columns, absent
    text blank. Without it a source keeps its extra columns, and what it lacks is NULL after the
    union and takes the defaults of ``clean``.
    """

    sources: Sequence[Source]
    lake: str
    zone: str = "processed"
    dataset: str = "books"
    partition_by: Sequence[str] = ("source",)
    fail_on_source_error: bool = False
    add_missing_columns: bool = True
    normalize_keys: bool = False
    blank_is_missing: bool = False
    missing: str = "null"
    rebalance: bool = False

    @property
    def path(self) -> str:
        return f"{self.lake.rstrip('/')}/{self.zone}/{self.dataset}"


def open_sources(spark: SparkSession, job: Job) -> dict[str, DataFrame]:
    """The sources that can be opened. One whose files or table are not there is passed over, unless
    it is required or the job is set to fail; any other error, and no source at all, stops the job."""
    opened: dict[str, DataFrame] = {}
    for source in job.sources:
        try:
            opened[source.name] = source.read(spark)
        except (AnalysisException, FileNotFoundError) as e:
            absent = isinstance(e, FileNotFoundError) or e.getCondition() in _ABSENT
            if not absent or source.required or job.fail_on_source_error:
                raise
            reason = e.getCondition() if isinstance(e, AnalysisException) else e
            log.warning("source %s passed over: %s", source.name, reason)
    if not opened:
        raise ValueError("no source could be read; job stopped")
    return opened


def build(spark: SparkSession, job: Job, run_ts: datetime | None = None) -> DataFrame:
    """The job's result as one lazy plan, nothing staged in between."""
    columns = {source.name: source.columns for source in job.sources}
    prepare = conform if job.add_missing_columns else coerce_and_fill
    tables = [
        df.transform(normalize_names).transform(rename, columns[name]).transform(prepare, missing=job.missing)
        for name, df in open_sources(spark, job).items()
    ]
    return transform(tables, run_ts, job.normalize_keys, job.blank_is_missing, job.missing)


def run(spark: SparkSession, job: Job, run_ts: datetime | None = None, check: Callable[[DataFrame], None] | None = None) -> Receipt:
    """Build, write beside the dataset with the row count taken on the way, check that files are there, publish.

    Whatever fails, the dataset of the last run is still there; what the failed run wrote beside it goes.
    """
    result = build(spark, job, run_ts)
    beside = _beside(job.path)
    try:
        receipt = write_parquet(result, beside, job.partition_by, rebalance=job.rebalance)
        require_output(spark, beside)
        if check is not None:
            check(read_back(spark, receipt))
        return publish(spark, receipt, job.path)
    except Exception:
        discard(spark, beside)
        raise


def _beside(path: str) -> str:
    """A fresh hidden path in the same folder, so that renaming stays within one storage."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{name}-{uuid.uuid4().hex}"
