"""Conversion of legacy documents: the adapter's results to statuses and totals."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import rules, schemas, storage
from ..functions import paths, text


class Progress(NamedTuple):
    """After a round: files that are done, that failed in it, and those of the latter that another round will try."""

    round: int
    done: int
    failed: int
    pending: int


#: ``convert(path, output, slot, timeout)`` returns the tool's exit code and what it wrote to its error stream.
Converter = Callable[[str, str, int, int], tuple[int, bytes]]


def attempt(pending: DataFrame, convert: Converter, exists: Callable[[str], bool], workers: int = rules.CONVERT_WORKERS, timeout: int = rules.CONVERT_TIMEOUT, number: int = 1) -> DataFrame:
    """One round over ``pending(file_hash, path, output)``: ``schemas.ATTEMPTS``, a row for each; failures are rows, never exceptions.

    ``workers`` tasks bound the tools that run at once; each uses a profile slot
    of its own. A file's task moves on with ``number``, so another round meets
    another slot.
    """

    def one(path: str, output: str, slot: int) -> tuple[bool, float, str]:
        began = time.monotonic()
        try:
            code, said = convert(path, output, slot, timeout)
            ok = code == 0 and exists(output)
            return ok, round(time.monotonic() - began, 1), "" if ok else said.decode(errors="replace")[-rules.ERROR_TAIL :]
        except TimeoutError:
            return False, float(timeout), f"timeout after {timeout} s"
        except Exception as e:  # an adapter's failure is the file's failure
            return False, round(time.monotonic() - began, 1), str(e)[-rules.ERROR_TAIL :]

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slot = TaskContext.get().partitionId()
        for pdf in parts:
            rows = [(h, path, output, number, slot, *one(path, output, slot)) for h, path, output in zip(pdf["file_hash"], pdf["path"], pdf["output"], strict=True)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schemas.ATTEMPTS.split(", ")])

    dealt = pending.select("file_hash", "path", "output").repartitionById(workers, F.pmod(F.xxhash64("file_hash") + number, F.lit(workers)).cast("int"))
    return dealt.mapInPandas(batches, schemas.ATTEMPTS)


def run(pending: DataFrame, convert: Converter, exists: Callable[[str], bool], out_folder: str, workers: int = rules.CONVERT_WORKERS, timeout: int = rules.CONVERT_TIMEOUT, retries: int = rules.CONVERT_RETRIES, progress: Callable[[Progress], None] | None = None) -> DataFrame:
    """Convert ``pending(file_hash, path)`` in rounds: ``schemas.CONVERSIONS`` with the history of each file's attempts.

    What fails is a table of its own, dealt to other tasks in the next round, at
    most ``retries`` times. Each round is written, so that a lost executor costs
    its round's tasks only; the numbers that ``progress`` is told come from the
    job that writes. The last attempt's seconds count.
    """
    named = pending.select("file_hash", "path", paths.output_path(out_folder, paths.name(F.col("path")), F.col("file_hash")).alias("output"))
    left, rounds, done, failed = storage.written(named, "convert-pending"), [], 0, 0
    for number in range(1, retries + 2):
        seen = Observation()
        counts = (F.count_if("success").alias("done"), F.count_if(~F.col("success")).alias("failed"))
        rounds.append(storage.written(attempt(left, convert, exists, workers, timeout, number).observe(seen, *counts), f"convert-round{number}"))
        done, failed = done + seen.get["done"], seen.get["failed"]
        if progress:
            progress(Progress(number, done, failed, failed if number <= retries else 0))
        if not failed:
            break
        left = rounds[-1].where("NOT success").select("file_hash", "path", "output")
    tries = F.array_sort(F.collect_list(F.struct("attempt", "slot", "success", "seconds", "error")))
    grouped = reduce(DataFrame.unionByName, rounds).groupBy("file_hash", "path", "output").agg(tries.alias("history"))
    last = F.element_at("history", -1)
    return grouped.select("file_hash", "path", last["success"].alias("success"), last["seconds"].alias("seconds"), F.when(last["success"], F.col("output")).alias("output"), last["error"].alias("error"), F.size("history").alias("attempts"), "history")


def success(code: Column, output_exists: Column) -> Column:
    return (code == 0) & output_exists


def status(ok: Column, valid: Column) -> Column:
    """``done``, ``corrupt`` (an output that can't be read) or ``failed``."""
    return F.when(ok & F.coalesce(valid, F.lit(False)), "done").when(ok, "corrupt").otherwise("failed")


def validity(facts: DataFrame) -> DataFrame:
    """``file_hash, valid, pages, text_chars``: valid PDFs have pages and no error."""
    pages = F.count(F.when(F.col("error").isNull(), F.col("page_num")))
    bad = F.count_if(F.col("error").isNotNull()) > 0
    return facts.groupBy("file_hash").agg((~bad & (pages > 0)).alias("valid"), F.when(bad, F.lit(0)).otherwise(pages).alias("pages"), F.when(bad, F.lit(0)).otherwise(F.sum(F.length("text"))).alias("text_chars"))


def entries(conversions: DataFrame, valid: DataFrame) -> DataFrame:
    """Manifest rows for finished conversions."""
    joined = conversions.join(valid, "file_hash", "left")
    return joined.select("file_hash", "path", F.lit(rules.CONVERTED_LANE).alias("lane"), status(F.col("success"), F.col("valid")).alias("convert_status"), F.col("output").alias("converted_pdf"))


def totals(results: DataFrame, workers: int = rules.CONVERT_WORKERS) -> DataFrame:
    """``results(valid, seconds)`` to one row: the parallel time is an estimate, the serial time shared out evenly.

    With ``text_chars`` in ``results``, the characters of valid files too.
    """
    valid = F.coalesce("valid", F.lit(False))
    seconds = F.coalesce(F.sum("seconds"), F.lit(0.0))
    return results.agg(F.count_if(valid).alias("n_valid"), F.count_if(~valid).alias("n_failed"), seconds.cast("double").alias("serial_s"), (seconds / 60).cast("double").alias("serial_min"), (seconds / workers / 60).cast("double").alias("parallel_min"), *([F.coalesce(F.sum(F.when(valid, F.col("text_chars"))), F.lit(0)).cast("long").alias("text_chars")] if "text_chars" in results.columns else []))


def failures(results: DataFrame) -> DataFrame:
    return results.where(~F.coalesce("valid", F.lit(False))).select("path", text.error_tail(F.col("error"), rules.ERROR_TAIL).alias("error"))
