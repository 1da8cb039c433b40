"""Submit one run: ``spark-submit … tidemark/__main__.py --root URI --customers PATH --cases PATH [--dry-run]``.

Prints the manifest. Any other tables are published by calling ``sync`` with their contracts.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemark.contract import DEFAULT_CONTRACTS
from tidemark.plans.sync import Manifest, SyncOptions, sync
from tidemark.sources.tables import read_files


def main(arguments: Sequence[str] | None = None) -> Manifest:
    parser = argparse.ArgumentParser(prog="tidemark", description="Publish what changed since the last run.")
    parser.add_argument("--root", required=True, help="absolute path or URI the outputs go below")
    for contract in DEFAULT_CONTRACTS:
        parser.add_argument(f"--{contract.name}", required=True, help=f"where {contract.name} is read from")
    parser.add_argument("--format", default="parquet", help="format of the sources")
    parser.add_argument("--lake-format", default="json", choices=("json", "parquet"))
    parser.add_argument("--identity", default="lanes", choices=("lanes", "exact"), help="how the run id is derived")
    parser.add_argument("--assume-utc", action="store_true", help="read timestamps without a zone as UTC")
    parser.add_argument("--dry-run", action="store_true", help="say what would be published, write nothing")
    given = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    sources = [
        read_files(spark, contract, getattr(given, contract.name), given.format, assume_utc=given.assume_utc)
        for contract in DEFAULT_CONTRACTS
    ]
    options = SyncOptions(identity=given.identity, lake_format=given.lake_format)
    manifest = sync(spark, sources, given.root, dry_run=given.dry_run, options=options)
    print(manifest.text())
    return manifest


if __name__ == "__main__":
    main()
