"""Command line: init, availability, preflight, catalog, build, get, validate and clean."""

from __future__ import annotations

import argparse
import json

from . import config as C


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tilewright")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("availability", "preflight"):
        commands.add_parser(name).add_argument("config")
    get = commands.add_parser("get")
    get.add_argument("config")
    get.add_argument("collection")
    get.add_argument("--bbox", type=float, nargs=4)
    get.add_argument("--area")
    get.add_argument("--no-cells", action="store_true")
    get.add_argument("--include-proposed", action="store_true")
    commands.add_parser("init").add_argument("folder")
    commands.add_parser("catalog").add_argument("output")
    commands.add_parser("validate-data").add_argument("path")
    make = commands.add_parser("build")
    make.add_argument("config")
    make.add_argument("output")
    make.add_argument("--degrees", type=float, action="append", required=True, help="width of square cells; one table for each")
    make.add_argument("--area")
    make.add_argument("--max-cells", type=int, default=100_000)
    make.add_argument("--allow-partial", action="store_true")
    make.add_argument("--overwrite", action="store_true")
    make.add_argument("--revision")
    clean = commands.add_parser("clean-workspace")
    clean.add_argument("config")
    clean.add_argument("output")
    download = commands.add_parser("download", help="not available: snapshots are put in place by other means")
    download.add_argument("collection")
    return parser


def main(argv: list[str] | None = None) -> int:
    parser = build_parser()
    args = parser.parse_args(argv)
    try:
        if args.command == "preflight":
            from .api import preflight

            print(json.dumps(preflight(C.load(args.config)), indent=1))
            return 0
        if args.command == "init":
            from .plans.build import init

            print(init(args.folder))
            return 0
        if args.command == "download":
            raise NotImplementedError("there is no network client: put snapshots where the configuration names them")
        from pyspark.sql import SparkSession

        from . import api
        from .operators.spatial import lonlat_grid
        from .plans import build, products

        spark = SparkSession.builder.appName("tilewright").getOrCreate()
        if args.command == "validate-data":
            print(json.dumps(products.validate(spark, args.path), indent=1))
            return 0
        if args.command == "catalog":
            print(json.dumps(build.validate_build(spark, args.output), indent=1))
            return 0
        config = C.load(args.config)
        if args.command == "build":
            box = config.areas[args.area] if args.area else config.bounds
            grids = {f"{d:g}": lonlat_grid(spark, box, d, args.max_cells) for d in args.degrees}
            made = build.build(spark, config, grids, args.output, {f"{d:g}": d for d in args.degrees}, args.allow_partial, args.revision, args.overwrite)
            print(json.dumps(made["tables"], indent=1))
            return 0
        if args.command == "clean-workspace":
            print(json.dumps(build.clean_workspace(spark, config, args.output), indent=1))
            return 0
        if args.command == "availability":
            regions = sorted({r for s in config.sources for r in s.coverage})
            print(json.dumps([r.asDict() for r in api.availability(spark, config, regions).collect()], indent=1))
            return 0
        found = api.get_layer(
            spark, config, args.collection.replace("-", "_"), tuple(args.bbox) if args.bbox else args.area, not args.no_cells, include_proposed=args.include_proposed
        )
        report = {"features": found.features.count(), "cells": found.cells.count() if found.cells is not None else None}
        print(json.dumps(report | {"coverage": [r.asDict() for r in found.coverage.collect()], "provenance": found.provenance}, indent=1))
        return 0
    except (ValueError, TypeError, OSError, KeyError, NotImplementedError) as error:
        parser.error(str(error))


if __name__ == "__main__":
    raise SystemExit(main())
