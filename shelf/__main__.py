"""Command line: python -m shelf COMMAND."""

from __future__ import annotations

import argparse
import datetime
import json
import sys

from shelf import commands
from shelf.functions.values import ensure_dump_date, output_path
from shelf.operators.exports import MULTI_FIELDS, SLICE_FIELDS, Options
from shelf.operators.series import Flatten, Preference, SeriesMode
from shelf.session import build_session
from shelf.settings import Settings, dump_settings, load_settings
from shelf.sources import datasets


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="shelf")
    parser.add_argument("--config", help="settings as JSON")
    sub = parser.add_subparsers(dest="command", required=True)
    cache = sub.add_parser("cache", help="scan archives and read dumps")
    cache.add_argument("--archives")
    cache.add_argument("--dumps")
    cache.add_argument("--rebuild", action="store_true")
    cache.add_argument("--check-md5", action="store_true", help="compare archives with their caches by content")
    cache.add_argument("--allow-dump-date-mismatch", action="store_true")
    merge = sub.add_parser("merge", help="the dataset of a cache as one file")
    merge.add_argument("--output", required=True)
    merge.add_argument("--archives", help="the archives that the cache must be up to date with")
    merge.add_argument("--allow-stale", action="store_true")
    inspect = sub.add_parser("inspect", help="summary, lookups and validation")
    for name, kind in (("book-id", int), ("archive", str), ("index", int), ("file", str)):
        inspect.add_argument(f"--{name}", type=kind)
    for name in ("validate", "archives", "ambiguous-authors", "decode-fp"):
        inspect.add_argument(f"--{name}", action="store_true")
    export = sub.add_parser("export", help="an export layout as one ZIP")
    export.add_argument("--layout", choices=("positional", "multi-series", "slice"), default="slice")
    export.add_argument("--format", choices=("plain", "ruks"), default="plain", help="ruks: positional lines with checksum and replacing book")
    export.add_argument("--output", required=True)
    for name in ("where", "split-by"):
        export.add_argument(f"--{name}")
        export.add_argument(f"--{name}-file", help="a file with the expression")
    export.add_argument("--additional", action="store_true", help="annotations and compilations beside the export")
    export.add_argument("--sequence", type=SeriesMode.parse, default=SeriesMode.AUTHOR)
    export.add_argument("--prefer-fb2", type=Preference.parse, default=Preference.COMPLEMENT)
    export.add_argument("--flatten", type=Flatten.parse, default=Flatten.ALL)
    export.add_argument("--source-library", default="")
    for p in (cache, merge, inspect, export):
        p.add_argument("--cache", required=True, help="folder of intermediates")
    for p in (merge, export):
        p.add_argument("--dump-date", default="")
    plan = sub.add_parser("rollup", help="the archives that updates would be written to")
    plan.add_argument("--finalised", required=True, help="folder of finished archives")
    plan.add_argument("--updates", required=True, help="folder of update archives")
    plan.add_argument("--active", help="folder of the archive in progress")
    fetch = sub.add_parser("fetch", help="what index pages offer beyond the archives that are here")
    fetch.add_argument("--pages", required=True)
    fetch.add_argument("--archives", required=True)
    fetch.add_argument("--pattern", default=r"fb2-(\d+)-(\d+)\.zip", help="two groups: the first and the last id")
    sub.add_parser("dumpconfig", help="all settings with their values")
    return parser


def _expression(text: str | None, path: str | None) -> str | None:
    """An expression given as text or in a file, not both."""
    if text and path:
        raise ValueError("an expression and a file of one: only one of them")
    if path:
        with open(path, encoding="utf-8") as f:
            return f.read().strip()
    return text


def _inspect(dataset: datasets.Dataset, args: argparse.Namespace) -> int:
    if args.validate:
        errors = commands.check_dataset(dataset)
        print("\n".join(errors) or "valid")
        return commands.NOT_READY if errors else commands.DONE
    if args.archives or args.ambiguous_authors:
        found = dataset.header["archives"] if args.archives else (dataset.header["database"] or {}).get("ambiguous_authors", [])
        print("\n".join(json.dumps(x, ensure_ascii=False) for x in found))
        return commands.DONE if found else commands.NO_MATCH
    row = commands.inspect(dataset, book_id=args.book_id, archive=args.archive, index=args.index, file=args.file)
    if args.decode_fp:
        row = commands.decoded_sections(row)
    found = row.toJSON().collect()  # one row, or the sections of one
    print("\n".join(found))
    return commands.DONE if found else commands.NO_MATCH


def _export(dataset: datasets.Dataset, settings: Settings, args: argparse.Namespace) -> int:
    dump_date, made_up = ensure_dump_date(args.dump_date, datetime.date.today().isoformat())
    if made_up:
        print(f"no dump date: {dump_date} is used", file=sys.stderr)
    options = Options(series=args.sequence, prefer=args.prefer_fb2, flatten=args.flatten, source_library=args.source_library, extended=args.format == "ruks")
    lines = commands.export(dataset, settings, args.layout, options, where=_expression(args.where, args.where_file), split_by=_expression(args.split_by, args.split_by_file))
    path = output_path(args.output, dump_date)
    structure = {"multi-series": MULTI_FIELDS, "slice": SLICE_FIELDS}.get(args.layout, "")
    commands.write_export(lines, path, settings, dump_date, commands.export_members(dataset, args.layout), structure)
    if args.additional:
        base = path.rpartition(".")[0] or path
        commands.write_annotations(dataset, settings, f"{base}{'_annotation' if args.layout == 'slice' else '-annotations'}.zip")
        commands.write_compilations(dataset, f"{base}-compilations.zip")
    return commands.DONE


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    settings = load_settings(args.config)
    if args.command == "dumpconfig":
        print(dump_settings(settings))
        return commands.DONE
    spark = build_session()
    if args.command == "rollup":
        plan, code = commands.rollup_folders(spark, args.finalised, args.updates, settings, args.active)
        print("\n".join(plan.orderBy("bin").toJSON().collect()))  # a row per archive
        return code
    if args.command == "fetch":
        found = commands.new_downloads(spark, args.pages, args.archives, args.pattern).toJSON().collect()  # a row per new archive
        print("\n".join(found))
        return commands.DONE if found else commands.NO_MATCH
    cache = commands.Cache(args.cache)
    if args.command == "cache":
        return commands.build_cache(spark, cache, settings, args.archives, args.dumps, args.rebuild, check_md5=args.check_md5, allow_mismatch=args.allow_dump_date_mismatch)
    if args.command == "merge" and args.archives and not args.allow_stale and not commands.cache_ready(spark, args.archives, cache, settings):
        return commands.NOT_READY
    dataset = commands.merge(spark, cache, settings, args.dump_date if args.command in ("merge", "export") else "")
    if args.command == "merge":
        order = ["locator.source", "locator.index"] if dataset.header["archives"] else ["locator.book_id"]
        print(commands.write_merged(dataset, args.output, settings, order))
        return commands.DONE
    return _inspect(dataset, args) if args.command == "inspect" else _export(dataset, settings, args)


if __name__ == "__main__":
    sys.exit(main())
