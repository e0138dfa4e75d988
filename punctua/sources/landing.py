"""Landed JSON files: reading, validating and loading each of them once.

One file is one row. Listing and reading run on the executors; nothing here opens a file itself.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = [
    "classify_documents", "classify_payload", "parse_documents", "read_documents", "load_new_files", "load_report", "load_totals", "payload_class", "read_landing",
    "run_loads", "usage_budget",
]

def object_key(path: Column, root: str = "raw/") -> Column:
    """The part of a file path from the landing root on, so that moving a bucket changes no key."""
    at = F.instr(path, f"/{root}")
    return F.when(at > 0, F.substring(path, at + 1, F.length(path))).otherwise(path)


def read_landing(spark: SparkSession, path: str | list[str], pattern: str = "*.json") -> DataFrame:
    """A1. One row per landed file: its whole text and its key."""
    return (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        .text(path, wholetext=True)
        .select(F.col("value").alias("raw_data"), object_key(F.col("_metadata.file_path")).alias("source_file"))
    )


def payload_class(raw: Column | str, array: str = "data") -> Column:
    """A6. What a response is worth: ``accepted``, ``empty`` (kept, but collected nothing) or ``rejected``.

    A body with an ``error`` member, without the record list, or that is no JSON object is rejected.
    """
    body = F.col(raw) if isinstance(raw, str) else raw
    return _class_of(F.try_parse_json(body), array)


def _class_of(parsed: Column, array: str) -> Column:
    records = F.try_variant_get(parsed, f"$.{array}", "array<variant>")
    has_error = F.try_variant_get(parsed, "$.error", "variant").isNotNull()
    return (F.when(parsed.isNull() | has_error | records.isNull(), F.lit("rejected"))
            .when(F.size(records) == 0, F.lit("empty")).otherwise(F.lit("accepted")))


def parse_documents(raw: DataFrame, raw_col: str = "raw_data", name: str = "doc") -> DataFrame:
    """A1. Bodies as ``VARIANT``: parsed once, every field kept whatever its type; NULL for a body that is no JSON document."""
    return raw.select(*[c for c in raw.columns if c != raw_col], F.try_parse_json(raw_col).alias(name))


def read_documents(spark: SparkSession, path: str | list[str], pattern: str = "*.json") -> DataFrame:
    """A1. One row per landed file: its key and its body as a ``VARIANT`` called ``doc``.

    Write the result as a table to parse each body once and for all: staging, payload classes and the field profile read the variant. A file that
    is no JSON document stays as a row with a NULL body, so it is counted and can be reported.
    """
    return parse_documents(read_landing(spark, path, pattern))


def classify_documents(docs: DataFrame, doc: str = "doc", array: str = "data", name: str = "payload_class") -> DataFrame:
    """A6. The payload class of bodies that are parsed already."""
    return docs.withColumn(name, _class_of(F.col(doc), array))


def classify_payload(df: DataFrame, raw: str = "raw_data", array: str = "data",
                     name: str = "payload_class") -> DataFrame:
    """A6. Add the payload class; filter on it to route rejected bodies to quarantine."""
    return df.withColumn(name, payload_class(raw, array))


def first_error(raw: Column | str) -> Column:
    """Why a file did not load, NULL for one that did."""
    body = F.col(raw) if isinstance(raw, str) else raw
    return F.when(F.try_parse_json(body).isNull(), F.lit("not a JSON document"))


def load_new_files(landed: DataFrame, loaded: DataFrame | None) -> DataFrame:
    """A2 (batch form). Landed files the table does not hold yet, each once, with their load status.

    Names meet the ledger first; bodies only of new files go on.
    """
    names = landed.select("source_file").distinct()
    if loaded is not None:
        names = names.join(loaded.select("source_file").distinct(), "source_file", "left_anti")
    fresh = landed.join(names, "source_file", "left_semi").dropDuplicates(["source_file"])
    error = first_error("raw_data")
    return fresh.select("raw_data", "source_file", error.alias("first_error"),
                        F.when(error.isNull(), "LOADED").otherwise("LOAD_FAILED").alias("status"))


def load_report(batch: DataFrame) -> DataFrame:
    """A3. Files and rows per load status, with one example error."""
    return batch.groupBy("status").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("status") == "LOADED").alias("rows_loaded"),
        F.min("first_error").alias("first_error"))


def load_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A4. Files ever loaded, per raw table."""
    parts = [df.agg(F.count(F.lit(1)).alias("total_files")).select(F.lit(n).alias("table_name"), "total_files")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_loads(loads: Mapping[str, Callable[[], object]]) -> dict[str, object]:
    """A5. Run independent loads; one that fails does not stop the rest, but the run fails at the end."""
    done, failed = {}, {}
    for name, load in loads.items():
        try:
            done[name] = load()
        except Exception as error:  # noqa: BLE001 - any failure is reported below
            failed[name] = error
    if failed:
        raise RuntimeError("loads failed: " + "; ".join(f"{n}: {e}" for n, e in failed.items()))
    return done


def usage_budget(files: DataFrame, at: str, budget: int, per_run: int, as_of: Column, run_hour: int = 9) -> DataFrame:
    """E24. Files landed per calendar month against a budget, and what the scheduled runs will need.

    Runs are due on odd days at ``run_hour`` UTC. ``runs_left`` counts those still to come in the month
    of the files, seen from ``as_of``; ``headroom`` is what remains after this run and all of them.
    """
    month = F.date_trunc("month", F.col(at).cast("timestamp")).cast("date")
    used = files.groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("used"))
    days = F.sequence(F.col("month"), F.last_day("month"))
    due = F.filter(days, lambda d: (F.dayofmonth(d) % 2 == 1)
                   & (d.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(run_hour)) > as_of))
    return (
        used.withColumn("runs_left", F.size(due).cast("long"))
        .withColumn("refused", F.col("used") + F.lit(per_run) > F.lit(budget))
        .withColumn("headroom", F.lit(budget) - F.col("used") - F.lit(per_run) - F.col("runs_left") * F.lit(per_run))
    )
