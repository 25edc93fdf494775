"""The command-line jobs end to end, on files."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tallyrate import jobs, schemas
from tallyrate.storage import drop_written_tables
from tests.test_events import LOG, MADE_AT
from tests.test_rates import attempts


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(autouse=True)
def keep_session_tables(monkeypatch):
    """The jobs share the test session, whose written tables must stay."""
    monkeypatch.setattr(jobs, "drop_written_tables", lambda spark: None)


def test_prepare(spark, tmp_path):
    spark.createDataFrame(MADE_AT, "index int, game_id int, period int, minutes_remaining int, "
                          "seconds_remaining int, htm string").coalesce(1).write.csv(
        str(tmp_path / "attempts"), header=True)
    headers = schemas.EVENTS.names
    (tmp_path / "logs").mkdir()
    for game in ("001", "002"):
        rows = [list(row) for row in LOG if row[0] == game]
        (tmp_path / "logs" / f"play_{game}.json").write_text(json.dumps(
            {"resultSets": [{"name": "PlayByPlay", "headers": headers, "rowSet": rows}]}))
    jobs.main(["prepare", "--attempts", str(tmp_path / "attempts"), "--logs", str(tmp_path / "logs"),
               "--subject", "user", "--team", "O", "--out", str(tmp_path / "out")])
    merged = spark.read.csv(str(tmp_path / "out" / "attempts"), header=True)
    assert merged.columns == ["index", "game_id", "period", "minutes_remaining",
                              "seconds_remaining", "htm", "SCOREMARGIN"]
    assert merged.count() == 11
    differing = spark.read.csv(str(tmp_path / "out" / "differing_games"), header=True)
    assert differing.columns == ["GAME_ID", "from", "to"] and differing.count() == 3


def test_train_score_and_retrain(spark, tmp_path, capfd):
    path = str(tmp_path / "attempts")
    attempts(spark).write.csv(path, header=True)
    jobs.main(["train-zones", "--attempts", path, "--model", str(tmp_path / "zones")])
    jobs.main(["train-clusters", "--attempts", path, "--model", str(tmp_path / "clusters"),
               "--rates", str(tmp_path / "rates"), "--regressor", "small-forest"])
    jobs.main(["train-rates", "--rates", str(tmp_path / "rates"), "--model", str(tmp_path / "again")])
    (tmp_path / "requests.csv").write_text(
        "x_center_scaled,y_center_scaled,dist_bin,margin_cat,period\n0.4,-0.05,0,2,1\n0.2,0,3,,1\n")
    jobs.main(["score", "--model", str(tmp_path / "zones"), "--requests",
               str(tmp_path / "requests.csv"), "--out", str(tmp_path / "scored")])
    bare = spark.read.parquet(str(tmp_path / "rates")).drop("is_train")
    bare.write.parquet(str(tmp_path / "bare"))
    jobs.main(["train-rates", "--rates", str(tmp_path / "bare"), "--model", str(tmp_path / "split")])
    (tmp_path / "raw.csv").write_text(
        "x_center,y_center,dist_bin,margin_cat,period\n20,25,0,2,1\n20,25,3,,1\n20,25,0,2,99\n")
    for name in ("clusters", "again", "split"):
        jobs.main(["score", "--model", str(tmp_path / name), "--requests", str(tmp_path / "raw.csv"),
                   "--out", str(tmp_path / f"scored-{name}")])
        rows = spark.read.csv(str(tmp_path / f"scored-{name}"), header=True).orderBy("period", "dist_bin").collect()
        assert [r.prediction is None for r in rows] == [False, True, True]
        assert 0 <= float(rows[0].prediction) <= 1
    whole, partial = spark.read.csv(str(tmp_path / "scored"), header=True).orderBy(
        F.desc("x_center_scaled")).collect()
    assert 0 <= float(whole.prediction) <= 1 and whole.percent.endswith("%")
    assert (partial.dist_bin, partial.prediction, partial.percent) == ("3", None, None)


def test_jobs_start_from_the_command_line(tmp_path):
    (tmp_path / "t.txt").write_text("a\nb\nab\n\nnone\n")
    run = lambda *args: subprocess.run(
        [sys.executable, os.path.join(ROOT, "run_job.py"), *args], cwd=tmp_path, capture_output=True, text=True, timeout=200)
    assert "train-rates" in run("--help").stdout
    assert "|2           |2           |" in run("count-lines", "--text", str(tmp_path / "t.txt")).stdout


FIT = """
import sys; sys.path.insert(0, {root!r})
from tallyrate.session import build_session
from tallyrate.catalog import model_queries
spark = build_session("fit", "local[{cores}]", {{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}})
rows = model_queries.train_forest(spark, "/root/testdata/sf0.001").orderBy("feature").collect()
print("IMPORTANCES", [round(r.importance, 9) for r in rows])
"""


def test_a_seed_repeats_its_model_on_any_number_of_cores():
    found = set()
    for cores in (2, 4):
        out = subprocess.run([sys.executable, "-c", FIT.format(root=ROOT, cores=cores)], capture_output=True,
                             text=True, timeout=300).stdout
        found.add(out.partition("IMPORTANCES")[2].strip())
    assert len(found) == 1 and "" not in found


def test_count_lines(spark, tmp_path, capsys):
    (tmp_path / "t.txt").write_text("a\nb\nab\n\nnone\n")
    jobs.main(["count-lines", "--text", str(tmp_path / "t.txt")])
    assert "|2           |2           |" in capsys.readouterr().out


def test_written_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    from tallyrate import storage
    monkeypatch.setattr(storage, "shared_folder", lambda _: str(tmp_path))
    table = storage.written_table(spark.range(3), "t")
    assert table.count() == 3
    drop_written_tables(spark)
    assert not any(tmp_path.iterdir())
