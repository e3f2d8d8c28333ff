"""The whole flow going on from the step that failed."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest

from strata.operators import export_csv
from strata.plans import resume
from strata.plans.jobs import FlowPaths
from strata.schemas import USER_PURCHASE
from strata.sources import read_dataset

PURCHASES = [
    ("1", "A", "a\nb", 2, dt.datetime(2010, 1, 1), Decimal("1.500"), 7, "UK"),
    ("2", "B", "", 1, dt.datetime(2010, 1, 2), Decimal("2.000"), 8, "FR"),
]
ALL = ["classified_review", "export", "load", "movie_analytics", "review_logs", "user_purchase"]


@pytest.fixture
def paths(spark, tmp_path):
    reviews = spark.createDataFrame([(7, 1, "good film"), (9, 2, "bad")], "customer_id bigint, review_id bigint, review_text string")
    logs = spark.createDataFrame([(1, "<log><ts>2024-01-01 10:00:00</ts><user_id>8</user_id><event_type>view</event_type>"
                                      "<value>1.0</value></log>")], "event_id bigint, log string")
    return FlowPaths(landing=export_csv(spark.createDataFrame(PURCHASES, USER_PURCHASE), str(tmp_path / "landing")),
                     purchase_table=str(tmp_path / "purchases"), export=str(tmp_path / "export"),
                     movie_review_csv=export_csv(reviews, str(tmp_path / "reviews")),
                     log_reviews_csv=export_csv(logs, str(tmp_path / "logs")),
                     silver_root=str(tmp_path / "silver"), gold_root=str(tmp_path / "gold"))


def gold(spark, flow):
    return {r.customer_id: tuple(r)[1:5] for r in read_dataset(spark, flow.gold).collect()}


def test_a_rerun_repeats_the_failed_step_and_what_depends_on_it(spark, paths, tmp_path, monkeypatch):
    state = str(tmp_path / "state")

    def broken(*args, **kwargs):
        raise ZeroDivisionError

    with monkeypatch.context() as m:
        m.setattr(resume, "classified_review", broken)
        with pytest.raises(ZeroDivisionError):
            resume.resumable_flow(spark, paths, state)
    assert not os.path.exists(paths.gold_root)
    again = resume.resumable_flow(spark, paths, state)
    assert again.ran == ["classified_review", "movie_analytics"]
    assert again.skipped == ["export", "load", "review_logs", "user_purchase"]
    assert gold(spark, again) == {7: (Decimal("3.000"), 1, 1, 0), 8: (Decimal("2.000"), 0, 0, 1), 9: (Decimal("0.000"), 0, 1, 0)}
    assert resume.resumable_flow(spark, paths, state).ran == []


def test_changed_inputs_parameters_and_outputs_run_again(spark, paths, tmp_path):
    state = str(tmp_path / "state")
    assert resume.resumable_flow(spark, paths, state).ran == ALL
    words = resume.resumable_flow(spark, paths, state, positive_words=["bad"])
    assert words.ran == ["classified_review", "movie_analytics"] and gold(spark, words)[9][1] == 1
    export_csv(spark.createDataFrame(PURCHASES[:1], USER_PURCHASE), paths.landing)
    fewer = resume.resumable_flow(spark, paths, state, positive_words=["bad"], concurrent_silver=False)
    assert fewer.ran == ["export", "load", "movie_analytics", "user_purchase"] and gold(spark, fewer)[8][0] == 0
    resume.LedgerTable(spark, f"{paths.silver_root}/review_logs").drop()
    assert "review_logs" in resume.resumable_flow(spark, paths, state, positive_words=["bad"]).ran
    with open(os.path.join(state, "export.json"), "w") as f:
        f.write(json.dumps({"mark": "x"})[:5])  # cut off by a crash
    os.unlink(os.path.join(state, ".export.json.crc"))
    assert "export" in resume.resumable_flow(spark, paths, state, positive_words=["bad"]).ran


def test_an_empty_landing_stops_the_flow(spark, paths, tmp_path):
    export_csv(spark.createDataFrame([], USER_PURCHASE), paths.landing)
    with pytest.raises(RuntimeError, match="is empty"):
        resume.resumable_flow(spark, paths, str(tmp_path / "state"))


def test_command_line():
    from strata.__main__ import parse

    job, params = parse(["flow", "l", "t", "e", "r", "g", "s", "o", "st", "orc", "--words", "good,great"])
    assert job == "flow" and params["fmt"] == "orc" and params["positive_words"] == ["good", "great"]
    assert (params["landing"], params["gold_root"], params["state"]) == ("l", "o", "st")
    with pytest.raises(SystemExit):
        parse(["flow", "l", "t"])
