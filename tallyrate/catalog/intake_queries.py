"""Reading what is not as it should be, label indexes of any size, and the life of written tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrate import adapters, storage
from tallyrate.catalog.attempt_queries import _assembled, _vector_columns, cells
from tallyrate.catalog.oracles import CELL as CELL_SQL
from tallyrate.catalog.oracles import ORACLES as STEPS
from tallyrate.catalog.oracles import _attempts, _rates
from tallyrate.functions import scalars as S
from tallyrate.functions import vector_text
from tallyrate.operators import models, zones
from tallyrate.operators.cells import CELL, FLAG
from tallyrate.operators.label_index import LabelIndexer
from tallyrate.sources import by_header, files, quarantine

QUERIES = {}
ORACLES = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function
    return register


# Orders in one file, and the headers that files take in turn.
ORDERS_A_FILE = 2000
LAYOUTS = (("index", "period", "loc_x", "shot_made_flag"), ("loc_x", "index", "shot_made_flag"),
           ("period", "shot_made_flag", "note", "loc_x", "index"))


def _attempt_files(spark: SparkSession, sf_dir: str, spoil=lambda line, key: line) -> str:
    """Line items as headed CSV files of a bounded number of orders, in three layouts."""
    rows = adapters.table(spark, sf_dir, "lineitem").select(
        F.floor(F.col("l_orderkey") / ORDERS_A_FILE).alias("file"), F.col("l_orderkey").alias("key"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("index"), F.col("l_linenumber").alias("period"),
        (F.floor("l_extendedprice") % 95).alias("loc_x"), F.concat("l_returnflag", "l_linestatus").alias("note"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("shot_made_flag"))
    layout, line, header = F.col("file") % len(LAYOUTS), F.lit(None), F.lit(None)
    for at, names in enumerate(LAYOUTS):
        line = F.when(layout == at, F.concat_ws(",", *names)).otherwise(line)
        header = F.when(layout == at, F.lit(",".join(names))).otherwise(header)
    lines = rows.select("file", "index", header.alias("header"), spoil(line, F.col("key")).alias("line"))
    ordered = F.sort_array(F.collect_list(F.struct("index", "line")))
    texts = lines.groupBy("file", "header").agg(ordered.alias("ordered")).select(
        F.concat_ws("\n", "header", F.col("ordered.line")).alias("text"))
    path = storage.fresh_path(spark, "attempt-files")
    texts.write.option("maxRecordsPerFile", 1).text(path)
    return path


_LAYOUT = f"(l_orderkey // {ORDERS_A_FILE}) % {len(LAYOUTS)}"
_MERGED = f"""
    merged as (
      select l_orderkey, (l_orderkey * 10 + l_linenumber)::integer as index,
             case when {_LAYOUT} <> 1 then l_linenumber end::integer as period,
             (floor(l_extendedprice)::bigint % 95)::double as loc_x,
             case when l_returnflag = 'R' then 1 else 0 end as shot_made_flag,
             case when {_LAYOUT} = 2 then l_returnflag || l_linestatus end as note
      from lineitem)"""


@query(f"with {_MERGED} select index, period, loc_x, shot_made_flag, note from merged")
def attempts_by_header(spark, sf_dir):
    """Files with permuted, absent and additional columns, merged by name. Small tables have no file with notes."""
    merged = by_header.read_by_name(spark, _attempt_files(spark, sf_dir))
    return merged if "note" in merged.columns else merged.withColumn("note", F.lit(None).cast("string"))


def _spoiled(line: Column, key: Column) -> Column:
    """One order in 97 has letters in its last cell, one in 101 lacks it."""
    return F.when(key % 97 == 0, F.concat(line, F.lit("x"))).when(
        key % 101 == 0, F.regexp_replace(line, ",[^,]*$", "")).otherwise(line)


_BAD = """case when l_orderkey % 97 = 0 then case when {0} = 2 then 'index holds' else 'shot_made_flag holds' end
               when l_orderkey % 101 = 0 then 'does not have ' || (4 + [0, -1, 1][{0} + 1])::varchar || ' cells'
               else 'good' end""".format(_LAYOUT)


@query(f"with {_MERGED} select {_BAD} as outcome, count(*) as n from merged group by all")
def quarantined_attempts(spark, sf_dir):
    """Good rows and bad ones by reason, from files in which some rows are spoiled."""
    found = quarantine.split_attempts(spark, _attempt_files(spark, sf_dir, _spoiled))
    reasons = found.counts().select(F.regexp_replace("reason", "holds .*$", "holds").alias("outcome"), "n")
    good = found.good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("outcome"), "n")
    return reasons.unionByName(good).groupBy("outcome").agg(F.sum("n").alias("n"))


@query("""with rows as (
            select event_id, event_id // 500 as document,
                   case when event_id % 89 = 0 then 'EVENTNUM holds' else 'good' end as outcome from events),
          whole as (select *, document % 7 = 3 as broken from rows)
          select outcome, count(*) as n from whole where not broken group by all
          union all select 'is not a JSON document of result sets', count(distinct document) from whole
          where broken having count(*) > 0""")
def quarantined_events(spark, sf_dir):
    """Result sets of which some documents are cut off and some cells are no numbers."""
    number = F.col("eventnum").cast("string")
    rows = adapters.events(spark, sf_dir).select(
        F.floor(F.col("eventnum") / 500).alias("document"), "eventnum",
        F.array(F.concat(F.lit("00"), F.col("game_id").cast("string")),
                F.when(F.col("eventnum") % 89 == 0, F.concat(F.lit("no"), number)).otherwise(number)).alias("cells"))
    documents = rows.groupBy("document").agg(F.sort_array(F.collect_list(F.struct("eventnum", "cells"))).alias("ordered"))
    result = F.struct(F.lit("PlayByPlay").alias("name"), F.array(F.lit("GAME_ID"), F.lit("EVENTNUM")).alias("headers"),
                      F.col("ordered.cells").alias("rowSet"))
    text = F.to_json(F.struct(F.array(result).alias("resultSets")))
    cut = F.when(F.col("document") % 7 == 3, F.substring(text, F.lit(1), F.length(text) - 9)).otherwise(text)
    path = storage.fresh_path(spark, "event-documents")
    documents.select(cut.alias("text")).write.text(path)
    found = quarantine.split_result_set(spark, path, whole_files=False)
    reasons = found.counts().select(F.regexp_replace("reason", "holds .*$", "holds").alias("outcome"), "n")
    good = found.good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("outcome"), "n")
    return reasons.unionByName(good).groupBy("outcome").agg(F.sum("n").alias("n"))


@query(STEPS["rate_table_roundtrip"])
def vector_text_rates(spark, sf_dir):
    """Feature vectors through CSV, half of them as dense text and half as sparse."""
    dense, sparse = vector_text.dense_text(F.col("features")), vector_text.sparse_text(F.col("features"))
    rows = _assembled(spark, sf_dir).select(
        *CELL, F.when(F.xxhash64(*CELL) % 2 == 0, dense).otherwise(sparse).alias("features"))
    path = storage.fresh_path(spark, "vector-text")
    files.write_csv(rows, path)
    return _vector_columns(files.read_rates_csv(spark, path), "features", "f")


LABEL = "case when l_linenumber < 7 then l_partkey::varchar || '-' || l_suppkey::varchar end"


@query(f"""
    with labelled as (select l_orderkey, l_linenumber, {LABEL} as label, l_returnflag || l_linestatus as mode from lineitem),
    fitted as (select * from labelled where l_orderkey % 5 <> 0),
    numbers as (select label, row_number() over (order by count(*) desc, label) - 1 as number
                from fitted where label is not null group by label),
    modes as (select mode, row_number() over (order by count(*) desc, mode) - 1 as number from fitted group by mode)
    select l_orderkey, l_linenumber, coalesce(n.number, (select count(*) from numbers)) as label_index,
           coalesce(m.number, (select count(*) from modes)) as mode_index
    from labelled l left join numbers n on l.label = n.label left join modes m on l.mode = m.mode""")
def label_index_pipeline(spark, sf_dir):
    """Many labels and few, numbered by a saved and reloaded pipeline; null labels and those that only
    rows outside the fit have come last."""
    label = F.when(F.col("l_linenumber") < 7, F.concat_ws("-", "l_partkey", "l_suppkey"))
    rows = adapters.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", label.alias("label"), F.concat("l_returnflag", "l_linestatus").alias("mode"))
    stages = [LabelIndexer(inputCols=["label", "mode"], outputCols=["label_number", "mode_number"], handleInvalid="keep"),
              VectorAssembler(inputCols=["label_number", "mode_number"], outputCol="numbers")]
    path = storage.fresh_path(spark, "label-pipeline")
    Pipeline(stages=stages).fit(rows.where("l_orderkey % 5 <> 0")).write().save(path)
    indexed = PipelineModel.load(path).transform(rows)
    return indexed.select("l_orderkey", "l_linenumber", *(
        S.vector_element(F.col("numbers"), at, 0).cast("bigint").alias(name) for at, name in enumerate(("label_index", "mode_index"))))


@query(_rates(f"select *, 0::bigint as left_over from (select * from outcomes join cell_totals using ({CELL_SQL}))"))
def intermediate_lifetime(spark, sf_dir):
    """Outcome counts with totals from written tables that two and one others read; how many of
    them are left when the result stands."""
    with storage.scope(spark) as tables:
        counted = storage.written_table(
            cells(spark, sf_dir).groupBy(*CELL, FLAG).agg(F.count(F.lit(1)).alias("shots")), "outcomes", readers=2)
        totals = storage.written_table(counted.groupBy(*CELL).agg(F.sum("shots").alias("total")), "totals", readers=1)
        written = tables.tables()
        result = tables.keep(counted.join(totals, list(CELL)), "with-totals")
    left = sum(storage.exists(spark, path) for path in written)
    return result.withColumn("left_over", F.lit(left).cast("bigint"))


@query(_attempts("""
    , half as (select loc_x, loc_y from attempts_v where loc_y < 47),
    middle as (select avg(loc_x) as x, avg(loc_y) as y from half),
    whole as (select round(sum((loc_x - x) ** 2 + (loc_y - y) ** 2), 2) as cost_of_one from half, middle)
    select unnest(range(1, 9))::integer as k, cost_of_one, true as never_rises, true as chosen_in_range from whole"""))
def zone_costs(spark, sf_dir):
    """Costs of up to eight learned zones. One zone costs the variance; more never cost more."""
    located = adapters.attempts(spark, sf_dir).where(F.col("loc_y") < 47)
    points = storage.fixed_order_table(zones.location_points(located), "points")
    costs = storage.written_table(zones.costs_by_k(points, models.SEED, range(1, 9)), "costs")
    one, chosen = costs.where("k = 1").first().cost, zones.chosen_k(costs)
    earlier = costs.select((F.col("k") + 1).alias("k"), F.col("cost").alias("before"))
    return costs.join(earlier, "k", "left").select(
        "k", F.round(F.lit(one), 2).alias("cost_of_one"),
        F.coalesce(F.col("cost") <= F.col("before"), F.lit(True)).alias("never_rises"),
        F.lit(1 <= chosen <= 8).alias("chosen_in_range"))
