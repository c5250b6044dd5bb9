"""Command line: scan, plan, build, validate, inspect, diff, export; exit status 1, and a line on stderr, for an error."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from facetlake.sources import builder
from facetlake.sources.layout import Error

VERSION = "0.1.0"


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("facetlake", description=__doc__)
    parser.add_argument("--version", action="version", version=VERSION)
    verbs = parser.add_subparsers(dest="verb", required=True)
    for name, what in (("scan", "config"), ("plan", "config"), ("build", "config"), ("validate", "database"), ("inspect", "database"), ("diff", "database"), ("export", "database")):
        p = verbs.add_parser(name)
        p.add_argument(what)
        p.add_argument("--json", action="store_true")
        if name == "validate":
            p.add_argument("--full", action="store_true")
        if name == "inspect":
            p.add_argument("key", nargs="?")
        if name == "build":
            p.add_argument("--incremental", action="store_true")
        if name == "diff":
            p.add_argument("other")
        if name == "export":
            p.add_argument("--tile", required=True)
            p.add_argument("--format", choices=("csv", "raw", "obj", "ply", "elevation", "provenance", "quality"), default="csv")
            p.add_argument("--output", required=True)
    o = parser.parse_args(args)
    try:
        if o.verb in ("scan", "plan"):
            out = getattr(builder, o.verb)(o.config)
        else:
            spark = SparkSession.builder.getOrCreate()
            out = {
                "build": lambda: builder.build(spark, o.config, o.incremental),
                "validate": lambda: builder.validate(spark, o.database, o.full),
                "inspect": lambda: builder.inspect(spark, o.database, o.key),
                "diff": lambda: {f"{r.change} {r.face}/{r.level}/{r.morton}": 1 for r in builder.diff(spark, o.database, o.other).collect()},
                "export": lambda: builder.export(spark, o.database, o.tile, o.format, o.output),
            }[o.verb]()
    except Error as e:
        print(e, file=sys.stderr)
        return 1
    print(builder.report(out, o.json))
    return 0


if __name__ == "__main__":
    sys.exit(main())
