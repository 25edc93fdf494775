"""Queries that go through files: CSV, JSON result sets, text and rate tables."""

from __future__ import annotations


from tallyrate import adapters
from tallyrate.catalog.attempt_queries import _assembled, _vector_columns
from tallyrate.operators import text
from tallyrate.sources import files
from tallyrate.storage import fresh_path

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def scan_csv(spark, sf_dir):
    rows = adapters.attempts(spark, sf_dir)
    path = fresh_path(spark, "attempts-csv")
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema)


@query
def csv_roundtrip(spark, sf_dir):
    rows = adapters.events(spark, sf_dir).select(
        "game_id", "eventnum", "period", "scoremargin", "actioncode", "homedescription",
        "visitordescription", "value")
    path = fresh_path(spark, "events-csv")
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema)


@query
def scan_resultset_json(spark, sf_dir):
    log = adapters.event_log(adapters.events(spark, sf_dir))
    path = fresh_path(spark, "result-sets")
    adapters.result_set_documents(log).write.json(path)
    rows = files.read_result_set(spark, path, whole_files=False).drop("position")
    return files.with_constant(rows, "SEASON_TYPE", "Regular")


@query
def scan_resultset_files(spark, sf_dir):
    """One document per file, as the logs of games are kept."""
    log = adapters.event_log(adapters.events(spark, sf_dir))
    path = fresh_path(spark, "result-set-files")
    documents = adapters.result_set_documents(log, by_game=False)
    documents.write.option("maxRecordsPerFile", 1).json(path)
    rows = files.read_result_set(spark, path).drop("position")
    return files.with_constant(rows, "SEASON_TYPE", "Regular")


@query
def scan_text(spark, sf_dir):
    path = fresh_path(spark, "text")
    adapters.table(spark, sf_dir, "documents").select("text").write.text(path)
    return text.contains_counts(files.read_lines(spark, path), "ab")


@query
def rate_table_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "rate-table")
    files.write_rates(_assembled(spark, sf_dir), path)
    return _vector_columns(files.read_rates(spark, path), "features", "f")
