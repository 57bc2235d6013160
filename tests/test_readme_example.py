"""The README's API example, run on small frames with the same column names."""

import datetime as dt
import os

from strata.functions import is_positive, to_double
from strata.operators.clean import dedupe, total_order
from strata.operators.quality import between, unique, violation_report
from strata.operators.star import activity_stats, latest_per_key, lookup_join
from strata.sinks.publish import publish, read_published

D = dt.date


def test_readme_example(spark, tmp_dir):
    raw = spark.createDataFrame([
        (1, D(2023, 1, 1), "10.5", 7, 30), (1, D(2023, 2, 1), "x", 7, 30),
        (1, D(2023, 2, 1), "12.0", 7, 30), (2, D(2023, 1, 5), "3", 8, 13),
    ], "entity_id int, date date, value_text string, dim_id int, age int")
    events = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, 2, 1)],
                                   "event_id int, entity_id int, is_click int")
    dims = spark.createDataFrame([(7, "seven"), (8, "eight")], "dim_id int, label string")

    vals = raw.withColumn("value", to_double("value_text")).filter(is_positive("value"))
    vals = dedupe(vals, ["entity_id", "date"], total_order(vals, ["entity_id", "date"])[2:])
    latest = latest_per_key(vals, ["entity_id"], "date", ties="all")
    stats = activity_stats(events, "entity_id", {"n_clicks": "is_click"}, "event_id", "n_events",
                           ratio_name="click_rate", ratio_numerators=["n_clicks"])
    fact = lookup_join(latest.join(stats, "entity_id", "left"), dims, "dim_id")
    report = {r.rule: r.violations for r in violation_report(
        fact, [unique("pk", "entity_id"), between("age_ok", "age", 14, 50)]).collect()}
    target = os.path.join(tmp_dir, "fact")
    publish(fact, target)
    live = {r.entity_id: r for r in read_published(spark, target).collect()}

    assert live[1].value == 12.0 and live[1].click_rate == 0.5 and live[1].label == "seven"
    assert live[2].value == 3.0 and live[2].n_events == 1
    assert report == {"pk": 0, "age_ok": 1}
