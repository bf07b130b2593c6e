"""Command line: load files by a rule or by flags, once or as a stream, or check a rule.

    python -m siltworks.cli -r rule.yaml -s /data/in -j etl.journal
    python -m siltworks.cli -s /data/in -d etl.events -f json
    python -m siltworks.cli -r rule.yaml -V
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siltworks.functions.naming import SourceFile, fnv1a
from siltworks.plans import rule as rules
from siltworks.plans.ingest import Journal, Outcome, ingest
from siltworks.sources import files as fs
from siltworks.streaming.ingest import collect_manifest, run_due

#: Files written in the last few seconds may still grow.
SETTLED_SECONDS = 5
#: Files of one batch at most.
PAGE = 10_000


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siltworks")
    p.add_argument("-r", "--rule", help="YAML or JSON file with one rule")
    p.add_argument("-s", "--src", help="folder of files to load")
    p.add_argument("-d", "--dest", help="table, where no rule is given")
    p.add_argument("-f", "--format", choices=["csv", "json", "parquet", "avro", "orc"])
    p.add_argument("-w", "--window", type=int, help="batch window in seconds")
    p.add_argument("-j", "--journal", help="table of runs; with it files are loaded once")
    p.add_argument("-m", "--manifest", help="table of files seen, for a stream")
    p.add_argument("-c", "--checkpoint", help="checkpoint folder of a stream")
    p.add_argument("--override", action="store_true", help="replace the table's rows")
    p.add_argument("-X", "--stream", action="store_true", help="take new files, load closed windows, and stop")
    p.add_argument("-V", "--validate", action="store_true", help="only check the rule")
    return p


def rule_of(args: argparse.Namespace) -> rules.Rule:
    if args.rule:
        found = rules.load_rules(args.rule)
        if len(found) != 1:
            raise rules.InvalidRule(f"{args.rule} has {len(found)} rules")
        return found[0]
    raw = {"Dest": {"Table": args.dest or "", "Override": args.override, "SourceFormat": args.format, "Schema": {"Autodetect": True}}}
    return rules.parse(raw | ({"Batch": {"Window": {"DurationInSec": args.window}}} if args.window else {}), "command line")


def load(spark: SparkSession, args: argparse.Namespace, rule: rules.Rule) -> list[Outcome]:
    """Load the rule's settled files that the journal doesn't have, in batches of up to PAGE for each table."""
    journal = Journal(spark, args.journal) if args.journal else None
    if args.stream:
        collect_manifest(spark, args.src, rule, args.manifest, args.checkpoint).awaitTermination()
        return run_due(spark, rule, args.manifest, F.current_timestamp(), journal)
    files = fs.settled(fs.manifest(spark, args.src).where(rule.match.condition(F.col("url"))), F.current_timestamp(), SETTLED_SECONDS)
    if journal:
        done = journal.latest().where("state = 'done'").select(F.explode("urls").alias("url"))
        files = fs.valid_files(files, done)
    placed = files.withColumn("dest", rule.destinations(F.col("url"), F.col("modified"))).orderBy("dest", "modified", "url")
    out, page, dest = [], [], None

    def run() -> None:
        if page:
            out.append(ingest(spark, rule, page, str(fnv1a("|".join(f.url for f in page))), journal))

    # the driver holds the files of one batch, and of one partition of the list
    for row in placed.toLocalIterator():
        if row["dest"] != dest or len(page) >= PAGE:
            run()
            page, dest = [], row["dest"]
        page.append(SourceFile(row["url"], row["modified"].astimezone()))
    run()
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        rule = rule_of(args)
    except rules.InvalidRule as e:
        print(f"invalid rule: {e}", file=sys.stderr)
        return 1
    if args.validate:
        print(f"{args.rule}: valid")
        return 0
    for done in load(SparkSession.builder.getOrCreate(), args, rule):
        print(f"{done.dest}: {len(done.rows_from)} files, {len(done.corrupted)} corrupt, {len(done.invalid_schema)} of another schema, {len(done.missing)} missing")
    return 0


if __name__ == "__main__":
    sys.exit(main())
