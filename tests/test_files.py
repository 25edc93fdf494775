"""CSV, JSON result sets, text and rate tables through real files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tallyrate import schemas, storage
from tallyrate.adapters import result_set_documents
from tallyrate.sources import files


def test_csv_keeps_values_and_nulls(spark, tmp_path, rows_of):
    df = spark.createDataFrame(
        [(1, "a,b", 0.1, None), (2, 'say "x"', float("1e-17"), "line"), (None, None, None, "")],
        "n int, t string, d double, e string")
    files.write_csv(df, str(tmp_path / "out"))
    again = files.read_csv(spark, str(tmp_path / "out"), df.schema)
    assert rows_of(again) == rows_of(df.replace("", None))


def test_csv_inference_names_the_unnamed_index(spark, tmp_path):
    (tmp_path / "x.csv").write_text(",period,SCOREMARGIN\n0,1,TIE\n1,2,5\n")
    df = files.read_csv(spark, str(tmp_path / "x.csv"), None)
    assert df.dtypes == [("_c0", "int"), ("period", "int"), ("SCOREMARGIN", "string")]


def test_csv_header_must_match_the_schema(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path / "x.csv"), "a int, b int").collect()


def test_attempts_with_other_columns(spark, tmp_path):
    (tmp_path / "x.csv").write_text(",loc_x,extra,period\n5,23.5,e,1\n6,,,\n")
    df = files.read_attempts(spark, str(tmp_path / "x.csv"))
    assert df.dtypes == [("index", "int"), ("loc_x", "double"), ("extra", "string"), ("period", "int")]
    assert [tuple(r) for r in df.collect()] == [(5, 23.5, "e", 1), (6, None, None, None)]
    (tmp_path / "y.csv").write_text("_c0,index\n1,2\n")
    assert files.read_attempts(spark, str(tmp_path / "y.csv")).columns == ["_c0", "index"]


def document(headers, rows):
    return {"resource": "plays", "resultSets": [
        {"name": "PlayByPlay", "headers": headers, "rowSet": rows},
        {"name": "Other", "headers": ["X"], "rowSet": [[1]]}]}


def test_result_sets_of_several_files(spark, tmp_path):
    first = document(["GAME_ID", "EVENTNUM", "PERIOD", "SCOREMARGIN"],
                     [["001", 2, 1, None], ["001", 7, 1, "TIE"]])
    second = document(["PERIOD", "GAME_ID", "EVENTNUM", "HOMEDESCRIPTION"], [[4, "002", 1, "MISS x"]])
    (tmp_path / "play_001.json").write_text(json.dumps(first, indent=1))
    (tmp_path / "play_002.json").write_text(json.dumps(second))
    df = files.read_result_set(spark, str(tmp_path))
    assert df.columns == ["position", *schemas.EVENTS.names]
    got = sorted((r.GAME_ID, r.EVENTNUM, r.PERIOD, r.SCOREMARGIN, r.HOMEDESCRIPTION, r.position)
                 for r in df.collect())
    assert got == [("001", 2, 1, None, None, 0), ("001", 7, 1, "TIE", None, 1),
                   ("002", 1, 4, None, "MISS x", 0)]


def test_documents_are_bounded_and_lossless(spark, tmp_path, rows_of):
    log = spark.range(50).select(
        F.lit("007").alias("GAME_ID"), F.col("id").alias("EVENTNUM"), F.lit(1).alias("PERIOD"),
        F.lit("1:00").alias("PCTIMESTRING"),
        F.when(F.col("id") % 3 == 0, "TIE").alias("SCOREMARGIN"),
        F.lit(None).cast("string").alias("HOMEDESCRIPTION"), F.lit("x").alias("VISITORDESCRIPTION"),
        F.lit(None).cast("int").alias("EVENTMSGACTIONTYPE"))
    documents = result_set_documents(log, rows=20)
    assert documents.count() == 3
    documents.write.json(str(tmp_path / "docs"))
    again = files.read_result_set(spark, str(tmp_path / "docs"), whole_files=False)
    assert rows_of(again.drop("position")) == rows_of(log)


def test_files_with_other_headers_or_bad_cells_stop_the_read(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text(",loc_x,loc_y\n0,1.5,2\n")
    read = files.read_attempts(spark, str(tmp_path / "a"))
    assert [tuple(r) for r in read.collect()] == [(0, 1.5, 2.0)] and read.columns == ["index", "loc_x", "loc_y"]
    (tmp_path / "a" / "2.csv").write_text(",loc_y,loc_x\n0,1.5,2\n")
    with pytest.raises(Exception, match="header|CSV|FAILED_READ_FILE"):
        files.read_attempts(spark, str(tmp_path / "a")).collect()
    for cells in ("2O,1.0,2", "0,x1,2", "0,1.0"):
        path = tmp_path / f"bad-{len(cells)}-{cells[0]}.csv"
        path.write_text(f"index,loc_x,loc_y\n{cells}\n")
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
            files.read_attempts(spark, str(path)).collect()


def test_bad_documents_stop_the_read(spark, tmp_path):
    good = {"resultSets": [{"name": "p", "headers": ["GAME_ID", "EVENTNUM"], "rowSet": [["001", "1"]]}]}
    (tmp_path / "1.json").write_text(json.dumps(good))
    assert files.read_result_set(spark, str(tmp_path)).count() == 1
    (tmp_path / "2.json").write_text(json.dumps(good)[:60])
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        files.read_result_set(spark, str(tmp_path)).collect()
    good["resultSets"][0]["rowSet"][0][1] = "one"
    (tmp_path / "2.json").write_text(json.dumps(good))
    with pytest.raises(Exception, match="EVENTNUM holds one"):
        files.read_result_set(spark, str(tmp_path)).collect()


def test_constant_column_and_requests(spark):
    requests = files.requests_from_rows(spark, [(0.4, -0.05, 0, 2, 1)])
    assert requests.schema == schemas.REQUESTS
    assert files.with_constant(requests, "SEASON_TYPE", "Regular").first().SEASON_TYPE == "Regular"


def test_written_table_has_exact_size_and_no_lineage(spark):
    df = storage.written_table(spark.range(10_000_000).groupBy((F.col("id") % 3).alias("k")).count(), "t")
    plan = df._jdf.queryExecution().optimizedPlan()
    assert int(plan.stats().sizeInBytes()) < 100_000
    assert "Range" not in plan.toString()
    assert df.count() == 3


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = storage.shared_folder(spark)
    assert folder == configured if configured else folder
    assert spark.sparkContext.applicationId in storage.fresh_path(spark, "x")


class _Context:
    applicationId = "app-1"

    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class _Session:
    def __init__(self, master, folder=None):
        self.sparkContext = _Context(master)
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        storage.shared_folder(_Session("yarn"))
    with pytest.raises(RuntimeError):
        storage.shared_folder(_Session("local-cluster[2,1,1024]"))
    assert storage.shared_folder(_Session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert storage.shared_folder(_Session("local[2]")) == storage.shared_folder(_Session("local[2]"))
