"""Job entry point: run the transform with job-style arguments.

``run_transform_job`` validates the arguments on the driver, transforms the
upload, writes the destination's parts and appends one row to the run
history table (read by ``sources.discovery.job_runs``).
"""

from __future__ import annotations

import json
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.writers import write_output
from ..sources.audience import scan_audience
from ..spec import AudienceSpec
from .transform import read_counts, run_transform

RUN_SCHEMA = T.StructType([
    T.StructField("Id", T.StringType()),
    T.StructField("StartedOn", T.StringType()),
    T.StructField("CompletedOn", T.StringType()),
    T.StructField("ExecutionTime", T.LongType()),
    T.StructField("JobRunState", T.StringType()),
    T.StructField("Arguments", T.MapType(T.StringType(), T.StringType())),
    T.StructField("ValuesAccepted", T.LongType()),
    T.StructField("ValuesDropped", T.LongType()),
])


def upload_name(source_key: str) -> str:
    """Partition value naming an upload: its whole key, so equal base names stay apart."""
    return source_key.strip("/") or "upload"


def _iso(ts: float) -> str:
    return datetime.fromtimestamp(ts, tz=timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")


def run_transform_job(spark: SparkSession, source_path: str, output_path: str,
                      profile: str, pii_fields: str, segment_name: str, source_key: str,
                      runs_path: str | None = None, counts_path: str | None = None,
                      **spec_options) -> dict:
    """Transform ``source_path`` and write the parts of ``profile`` below
    ``output_path`` in the layout the activation side routes
    (``output/<profile>/<segment>/…``).

    Returns the run record.  With ``counts_path`` the rows of each source file
    are counted on the way (see ``run_transform``) below it, in a folder of the
    run's id, and the record says how many values were accepted and dropped.  A failed run is recorded as FAILED and the
    error re-raised.
    """
    spec = AudienceSpec.from_args(profile, pii_fields, segment_name, source_key, **spec_options)
    started = time.time()
    run = {"Id": f"jr_{uuid.uuid4().hex}", "StartedOn": _iso(started),
           "Arguments": {"--source_key": source_key, "--output_path": output_path,
                         "--pii_fields": json.dumps(pii_fields) if not isinstance(pii_fields, str)
                         else pii_fields, "--segment_name": segment_name,
                         "--profile": profile}}
    try:
        own_counts = f"{counts_path.rstrip('/')}/run={run['Id']}" if counts_path else None
        job = run_transform(scan_audience(spark, source_path, spec), spec, counts_path=own_counts)
        try:
            write_output(job.rows, output_path, spec.profile, spec.segment_name,
                         num_parts=job.n_parts, source=upload_name(source_key), chunks=job.chunks)
        finally:
            job.release()
        run["JobRunState"] = "SUCCEEDED"
        run["n_parts"] = job.n_parts
        if own_counts:
            total = read_counts(spark, own_counts).agg(
                F.sum("accepted"), F.sum(F.col("no_value") + F.col("empty") + F.col("malformed"))).first()
            run["ValuesAccepted"], run["ValuesDropped"] = (int(x or 0) for x in total)
    except Exception:
        run["JobRunState"] = "FAILED"
        raise
    finally:
        done = time.time()
        run["CompletedOn"] = _iso(done)
        run["ExecutionTime"] = int(round(done - started))
        if runs_path:
            row = {k: run.get(k) for k in RUN_SCHEMA.fieldNames()}
            spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").json(runs_path)
    return run
