"""``python -m corvidex inventory FOLDER``, ``triage FOLDER --manifest ROOT``, and ``ingest FOLDER --manifest ROOT --checkpoint FOLDER`` for what is new since the last run."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import inventory, manifest, reports, triage
from .sources import listing
from .streaming import ingest, progress


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="corvidex", description=__doc__)
    parser.add_argument("command", choices=("inventory", "triage", "ingest"))
    parser.add_argument("folder")
    parser.add_argument("--manifest", help="where the manifest is kept; triage needs it")
    parser.add_argument("--checkpoint", help="where ingest keeps what it knows")
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("corvidex").getOrCreate()
    if a.command != "inventory" and not a.manifest or a.command == "ingest" and not a.checkpoint:
        parser.error("triage needs --manifest, ingest needs --checkpoint too")
    if a.command == "ingest":
        with progress.Progress(spark) as done:
            ingest.run(spark, a.folder, a.manifest, a.checkpoint)
            print(f"{done.files} files in {done.batches} batches, {manifest.load(spark, a.manifest).count()} contents")
        return
    files = listing.files(spark, a.folder, columns=(inventory if a.command == "inventory" else triage).COLUMNS)
    if a.command == "inventory":
        info = inventory.file_info(files)
        reports.inventory(inventory.by_extension(info)).show(1000, False)
        inventory.errors(info).show(10, False)
        return
    manifest.commit(triage.entries(files, manifest.load(spark, a.manifest)), a.manifest, "triage")
    saved = manifest.load(spark, a.manifest).select("file_hash", "status")
    reports.lanes(triage.report(triage.assign(files).join(saved, "file_hash", "left").withColumn("status", F.coalesce("status", F.lit("pending"))))).show(100, False)


if __name__ == "__main__":
    main()
