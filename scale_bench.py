#!/usr/bin/env python
"""Throughput of the whole transform + write on a replicated upload.

The contacts derived from ``customer`` are replicated ``k`` times (ids kept
distinct, by ``explode(sequence)``, no cross join), written once as JSON
lines (one file, like a single large upload), then transformed and written
in both profiles with ``$BENCH_SPLIT_BYTES`` input splits (default 32 MB).
Prints one JSON line per profile with input rows per second.

    python scale_bench.py 100            # BENCH_SF_DIR, BENCH_CPUS as in bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from segmint.plans.derived import contacts_frame  # noqa: E402
from segmint.plans.registry import BATCH_SPEC, FILE_SPEC  # noqa: E402
from segmint.plans.transform import hash_wide, run_transform  # noqa: E402
from segmint.session import local_session, scratch_path  # noqa: E402
from segmint.sinks.writers import write_batch_profile, write_file_profile  # noqa: E402
from segmint.sources.audience import scan_jsonl  # noqa: E402


def main() -> None:
    k = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, app_name="segmint-scale")
    # the replicated upload is one large file: its split size sets the scan
    # parallelism (on a cluster the default 128 MB splits of a big upload do)
    spark.conf.set("spark.sql.files.maxPartitionBytes",
                   os.environ.get("BENCH_SPLIT_BYTES", str(32 * 1024 * 1024)))
    base = contacts_frame(spark, sf_dir)
    rep = (base.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
           .withColumn("contact_id", F.col("contact_id") + F.col("r").cast("long") * 1_000_000_000)
           .drop("r"))
    path = scratch_path(spark, "scale", f"x{k}")
    rep.write.json(path)
    n_in = spark.read.text(path).count()
    # warm the Python workers once (the NFKD UDF), as in a long-running session
    hash_wide(scan_jsonl(spark, path, BATCH_SPEC.read_schema()), BATCH_SPEC) \
        .write.format("noop").mode("overwrite").save()
    single_scan = os.environ.get("BENCH_SINGLE_SCAN", "1") == "1"
    for spec, writer in ((BATCH_SPEC, write_batch_profile), (FILE_SPEC, write_file_profile)):
        t0 = time.perf_counter()
        job = run_transform(scan_jsonl(spark, path, spec.read_schema()), spec,
                            single_scan=single_scan)
        n_parts = job.n_parts
        writer(job.rows, scratch_path(spark, "scale_out"), num_parts=n_parts)
        job.release()
        dt = time.perf_counter() - t0
        print(json.dumps({"profile": spec.profile, "replicate": k, "input_rows": n_in,
                          "parts": n_parts, "sec": round(dt, 2),
                          "input_rows_per_sec": int(n_in / dt), "cpus": cpus,
                          "single_scan": single_scan}))
    spark.stop()


if __name__ == "__main__":
    main()
