"""Command line: the jobs a scheduler or an analyst starts.

    python -m tidemark.jobs ingest   --servers ... --topic ... --target ... --checkpoint ...
    python -m tidemark.jobs batch    --bronze ... --silver ... --accounts ... --merchants ... [--day 2024-01-15]
    python -m tidemark.jobs backfill ... --first-day ... --last-day ...
    python -m tidemark.jobs report   bronze_type_summary [--bronze ...] [--option as_of="2024-01-31 00:00:00"]
    python -m tidemark.jobs peek     --format parquet --path ...      (bounded read of a topic, a few records)
    python -m tidemark.jobs watch    --format parquet --path ...      (records printed as they arrive)
"""

import argparse
import ast

from tidemark.plans import batch
from tidemark.plans.catalogue import REPORTS, run_report
from tidemark.schemas import LAYERS
from tidemark.session import build_session
from tidemark.sources import envelope
from tidemark.streaming import ingest


def _literal(text):
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


def _parser():
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("--master")
    parser.add_argument("--shuffle-partitions", type=int)
    jobs = parser.add_subparsers(dest="job", required=True)

    def topic(job):
        job.add_argument("--format", default="kafka")
        job.add_argument("--path")
        job.add_argument("--servers")
        job.add_argument("--topic")
        job.add_argument("--min-partitions", type=int, help="read tasks at least, beyond the topic's partitions")
        return job

    job = topic(jobs.add_parser("ingest"))
    job.add_argument("--target", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--dead-letters")
    job.add_argument("--shared", action="store_true", help="let this stream write into a target that others fill")
    job.add_argument("--log", help="folder that gets a row per commit")
    job.add_argument("--open-fields", action="store_true", help="keep fields the schema does not know in the column extra")
    job.add_argument("--max-offsets", type=int, help="records a trigger takes of a topic; all by default")
    job.add_argument("--max-files", type=int, help="files a trigger takes of a folder; all by default")
    job.add_argument("--compression", default="snappy")
    job.add_argument("--every", default="30 seconds")
    job.add_argument("--once", action="store_true", help="take what is there, then stop")
    topic(jobs.add_parser("peek"))
    job = topic(jobs.add_parser("watch"))
    job.add_argument("--once", action="store_true")

    for name in ("batch", "backfill"):
        job = jobs.add_parser(name)
        for layer in ("bronze", "silver", "accounts", "merchants"):
            job.add_argument(f"--{layer}", required=True)
    jobs.choices["batch"].add_argument("--day")
    jobs.choices["backfill"].add_argument("--first-day", required=True)
    jobs.choices["backfill"].add_argument("--last-day", required=True)

    job = jobs.add_parser("report")
    job.add_argument("name", choices=sorted(REPORTS))
    for layer in LAYERS:
        job.add_argument(f"--{layer.replace('_', '-')}")
    job.add_argument("--option", action="append", default=[], help="name=value, e.g. n=20")
    job.add_argument("--rows", type=int, default=100, help="rows to print")
    job.add_argument("--output", help="folder for the whole result, as Parquet, instead of printing")
    return parser


def _source(spark, args, streaming):
    if args.format != "kafka":
        if not streaming:
            return envelope.read_envelope(spark, args.format, args.path)
        files = getattr(args, "max_files", None)
        return envelope.stream_envelope(
            spark, args.format, args.path, **({} if files is None else {"maxFilesPerTrigger": str(files)})
        )
    if not streaming:
        return envelope.read_envelope(spark, **envelope.topic_batch_options(args.servers, args.topic, args.min_partitions))
    limit = getattr(args, "max_offsets", None)
    return envelope.stream_envelope(spark, **envelope.topic_stream_options(args.servers, args.topic, limit, args.min_partitions))


def _run(spark, args):
    if args.job == "ingest":
        trigger = {"availableNow": True} if args.once else {"processingTime": args.every}
        source = _source(spark, args, streaming=True)
        query = ingest.start_ingest(
            source, args.target, args.checkpoint, trigger, args.dead_letters, args.compression, shared=args.shared, log=args.log,
            open_fields=args.open_fields,
        )
        query.awaitTermination()
    elif args.job == "peek":
        print(ingest.preview(envelope.envelope_text(_source(spark, args, streaming=False))), "records")
    elif args.job == "watch":
        text = envelope.envelope_text(_source(spark, args, streaming=True))
        ingest.start_console(text, trigger={"availableNow": True} if args.once else None).awaitTermination()
    elif args.job == "report":
        tables = {layer: getattr(args, layer) for layer in LAYERS if getattr(args, layer)}
        options = {k: _literal(v) for k, v in (o.split("=", 1) for o in args.option)}
        result = run_report(spark, args.name, tables, **options)
        if args.output:
            result.write.parquet(args.output)
        else:
            result.show(args.rows, truncate=False)
            if not result.offset(args.rows).isEmpty():
                print(f"only the first {args.rows} rows are shown; --output stores all")
    else:
        layers = {n: getattr(args, n) for n in ("bronze", "silver", "accounts", "merchants")}
        if args.job == "batch":
            print(batch.run_day(spark, **layers, day=args.day))
        else:
            batch.backfill(spark, **layers, first_day=args.first_day, last_day=args.last_day)


def main(argv=None):
    args = _parser().parse_args(argv)
    # Writers want files of the advisory size rather than many parallel tasks.
    extra = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    writes = args.job in ("batch", "backfill")
    spark = build_session(f"tidemark-{args.job}", args.master, args.shuffle_partitions, extra if writes else None)
    spark.sparkContext.setLogLevel("WARN")
    try:
        _run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
