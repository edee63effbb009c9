"""Command line entry point, for ``spark-submit`` or ``python -m segmint.cli``.

Subcommands mirror what the original product's users run:

* ``transform``  — the transform job (source, output, mapping, segment name);
* ``activate``   — the activation stream over a queue folder;
* ``columns``    — column discovery of a JSON-lines or CSV upload;
* ``list``       — object listing (key, last modified, size) below a folder,
  sorted by key, date or size, or one object's metadata (``--key``);
* ``runs``       — transform run history with the segment name promoted.

The session comes from the environment (``SparkSession.builder.getOrCreate``);
on a cluster its configuration, including ``spark.checkpoint.dir``, is the
cluster's own.  The web UI stays off unless ``SEGMINT_SPARK_UI=1``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans.jobs import run_transform_job
from .session import scratch_root
from .sources import discovery as D
from .streaming.activation_stream import start_activation_stream


def _show(df, limit: int | None = None) -> None:
    """All rows, one partition at a time; fewer only if the user asks for a limit."""
    for row in (df if limit is None else df.limit(limit)).toLocalIterator():
        print(json.dumps(row.asDict(recursive=True), default=str))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="segmint")
    sub = ap.add_subparsers(dest="cmd", required=True)

    t = sub.add_parser("transform", help="normalise, hash, split and write an upload")
    t.add_argument("--source", required=True, help="upload path (JSON lines or CSV)")
    t.add_argument("--source-key", help="object key used to name outputs (default: file name)")
    t.add_argument("--output", required=True, help="output root (output/<profile>/<segment>/...)")
    t.add_argument("--profile", choices=("file", "batch"), required=True)
    t.add_argument("--pii-fields", required=True,
                   help='JSON array of {"column_name": ..., "pii_type": ...}')
    t.add_argument("--segment-name", required=True)
    t.add_argument("--format", choices=("json", "csv"), default="json")
    t.add_argument("--null-policy", choices=("skip", "literal"), default="skip")
    t.add_argument("--lowercase-email", action="store_true")
    t.add_argument("--permissive", action="store_true",
                   help="read malformed lines as nulls instead of failing")
    t.add_argument("--runs", help="run history folder to append to")

    a = sub.add_parser("activate", help="run the activation stream")
    a.add_argument("--queue", required=True, help="folder of queue record files")
    a.add_argument("--audiences", required=True, help="audience catalogue pages (JSON docs)")
    a.add_argument("--segments", required=True, help="segment catalogue docs (JSON)")
    a.add_argument("--out", required=True, help="folder for outbox/dead_letter/payload")
    a.add_argument("--checkpoint", required=True)
    for name, what in (("bucket-prefix", "bucket names start with this"), ("key-prefix", "keys start with this"),
                       ("account", "only this account's events"), ("region", "only this region's events")):
        a.add_argument(f"--{name}", help=what)
    a.add_argument("--files-root", help="where object keys resolve to files")
    a.add_argument("--max-files-per-trigger", type=int, default=1)
    a.add_argument("--continuous", action="store_true", help="keep running (30 s trigger)")

    c = sub.add_parser("columns", help="column discovery")
    c.add_argument("--path", required=True)
    c.add_argument("--format", choices=("JSON", "CSV"), default="JSON")

    ls = sub.add_parser("list", help="object listing")
    ls.add_argument("--root", required=True)
    ls.add_argument("--limit", type=int, help="only so many (default: all)")
    ls.add_argument("--sort", choices=("key", "date", "size"), default="key")
    ls.add_argument("--key", help="metadata of this one object only")

    r = sub.add_parser("runs", help="run history")
    r.add_argument("--path", required=True)
    r.add_argument("--limit", type=int, help="only the newest so many (default: all)")

    args = ap.parse_args(argv)
    builder = SparkSession.builder.appName(f"segmint-{args.cmd}")
    if os.environ.get("SEGMINT_SPARK_UI") != "1":
        # no web UI (and no port) unless asked for
        builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    scratch_root(spark)

    if args.cmd == "transform":
        key = args.source_key or args.source.rstrip("/").split("/")[-1]
        run = run_transform_job(spark, args.source, args.output, args.profile, args.pii_fields,
                                args.segment_name, key, runs_path=args.runs,
                                source_format=args.format, null_policy=args.null_policy,
                                lowercase_email=args.lowercase_email,
                                read_mode="PERMISSIVE" if args.permissive else "FAILFAST")
        print(json.dumps({"JobRunId": run["Id"], "JobRunState": run["JobRunState"],
                          "n_parts": run.get("n_parts")}))
    elif args.cmd == "activate":
        from .operators.activation import EventRule, audience_catalogue, segment_catalogue
        given = {k: getattr(args, k) for k in ("bucket_prefix", "key_prefix", "account", "region")
                 if getattr(args, k) is not None}

        # read again for every micro-batch
        def aud():
            return audience_catalogue(spark.read.text(args.audiences))

        def seg():
            return segment_catalogue(spark.read.text(args.segments))

        q = start_activation_stream(spark, args.queue, aud, seg, args.out, args.checkpoint,
                                    max_files_per_trigger=args.max_files_per_trigger,
                                    available_now=not args.continuous,
                                    files_root=args.files_root, rule=EventRule(**given))
        q.awaitTermination()
    elif args.cmd == "columns":
        df = (D.discover_columns_json(spark, args.path) if args.format == "JSON"
              else D.discover_columns_csv(spark, args.path))
        _show(df.orderBy("column_name"))
    elif args.cmd == "list":
        if args.key:
            _show(D.object_metadata(spark, args.root, args.key), 1)
        else:
            _show(D.sorted_manifest(D.file_manifest(spark, args.root), args.sort), args.limit)
    elif args.cmd == "runs":
        _show(D.job_runs(spark, args.path).orderBy(F.desc("StartedOn"), "Id"), args.limit)
    return 0


if __name__ == "__main__":
    sys.exit(main())
