"""The whole flow as one unit that goes on from the step that failed.

Every output is a ledger table, so a step's result is there whole or not at all and has a version.  After
a step its fingerprint (name, parameters and the state of its inputs: the version of a ledger table,
the files' paths, lengths and times of any other folder) and the versions of its outputs are noted
under ``state``.  A later run skips a step whose fingerprint is the noted one and whose outputs still have the
noted versions; a changed input or parameter, or a lost output, runs it and what depends on it again.
A note that was cut off by a crash counts as none.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from strata.functions.text import DEFAULT_POSITIVE_WORDS
from strata.operators.ledger import LedgerTable, is_ledger
from strata.operators.sinks import guarded_export, write_dataset
from strata.operators.transforms import classified_review, movie_analytics, review_logs, user_purchase
from strata.plans.jobs import (GOLD_MOVIE_ANALYTICS, SILVER_CLASSIFIED_REVIEW, SILVER_REVIEW_LOGS,
                               SILVER_USER_PURCHASE, FlowPaths, read_silver)
from strata.schemas import USER_PURCHASE, USER_PURCHASE_VARCHAR
from strata.session import _fs, path_exists
from strata.sources.csv import naming_bad_csv_record, read_bronze_csv, read_csv_typed
from strata.sources.datasets import read_dataset
from strata.streaming.arrival import fingerprint


@dataclass
class RunLedger:
    """Notes on finished steps under the folder ``path``; ``ran`` and ``skipped`` list this run's."""
    spark: SparkSession
    path: str
    ran: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)

    def state_of(self, path: str) -> str | None:
        """What tells one content of ``path`` from another; None if there is nothing."""
        if is_ledger(self.spark, path):
            return f"version {LedgerTable(self.spark, path).entry().version}"
        if not path_exists(self.spark, path):
            return None
        files = fingerprint(self.spark, path)
        return None if files is None else f"{files['files']} files {files['digest']}"

    def step(self, name: str, inputs: list[str], outputs: list[str], params: dict, action: Callable[[], object]) -> bool:
        """Run ``action`` unless it is noted as done from these inputs and parameters; returns
        whether it ran."""
        before = {p: self.state_of(p) for p in inputs}
        mark = hashlib.sha256(json.dumps([name, params, before, outputs], sort_keys=True).encode()).hexdigest()
        noted = self._note(name)
        if noted and noted["mark"] == mark and noted["outputs"] == {p: self.state_of(p) for p in outputs} \
                and None not in noted["outputs"].values():
            self.skipped.append(name)
            return False
        action()
        self._write(name, {"mark": mark, "outputs": {p: self.state_of(p) for p in outputs}})
        self.ran.append(name)
        return True

    def _note(self, name: str) -> dict | None:
        fs, file = _fs(self.spark, f"{self.path.rstrip('/')}/{name}.json")
        if not fs.exists(file):
            return None
        stream = fs.open(file)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except ValueError:
            return None
        finally:
            stream.close()

    def _write(self, name: str, note: dict) -> None:
        fs, file = _fs(self.spark, f"{self.path.rstrip('/')}/{name}.json")
        out = fs.create(file, True)
        try:
            out.write(json.dumps(note).encode("utf-8"))
        finally:
            out.close()


@dataclass(frozen=True)
class ResumedFlow:
    gold: str
    ran: list[str]
    skipped: list[str]


def resumable_flow(spark: SparkSession, paths: FlowPaths, state: str, fmt: str = "parquet",
                   positive_words: Iterable[str] = DEFAULT_POSITIVE_WORDS, concurrent_silver: bool = True) -> ResumedFlow:
    """Load, export, silver and gold as in ``bronze_to_gold``, going on from a run that failed.

    ``paths.purchase_table`` is the folder of a ledger table, as are all outputs.  An empty landing folder
    empties the table, and the flow stops there, as an empty table does in ``bronze_to_gold``."""
    ledger, root, words = RunLedger(spark, state), paths.silver_root.rstrip("/"), sorted(set(positive_words))
    silver = {n: f"{root}/{n}" for n in (SILVER_REVIEW_LOGS, SILVER_CLASSIFIED_REVIEW, SILVER_USER_PURCHASE)}
    gold = f"{paths.gold_root.rstrip('/')}/{GOLD_MOVIE_ANALYTICS}"
    table = LedgerTable(spark, paths.purchase_table)

    def load() -> None:
        table.create(USER_PURCHASE, USER_PURCHASE_VARCHAR)
        with naming_bad_csv_record(spark, paths.landing, USER_PURCHASE):
            table.refresh(read_csv_typed(spark, paths.landing))

    def export() -> None:
        if not table.rows():
            raise RuntimeError(f"{paths.purchase_table} is empty: export skipped, flow stopped")
        guarded_export(table.read(), paths.export, atomic=True)

    def logs() -> None:
        write_dataset(review_logs(read_bronze_csv(spark, paths.log_reviews_csv, "log_review")), silver[SILVER_REVIEW_LOGS], fmt, atomic=True)

    def reviews() -> None:
        write_dataset(classified_review(read_bronze_csv(spark, paths.movie_review_csv, "movie_review"), words),
                      silver[SILVER_CLASSIFIED_REVIEW], fmt, atomic=True)

    def purchases() -> None:
        write_dataset(user_purchase(read_dataset(spark, paths.export, "csv", USER_PURCHASE)), silver[SILVER_USER_PURCHASE], fmt,
                      varchar_limits=USER_PURCHASE_VARCHAR, atomic=True)

    def analytics() -> None:
        parts = [read_silver(spark, root, n, fmt) for n in (SILVER_USER_PURCHASE, SILVER_CLASSIFIED_REVIEW, SILVER_REVIEW_LOGS)]
        write_dataset(movie_analytics(*parts), gold, fmt, atomic=True)

    ledger.step("load", [paths.landing], [table.path], {}, load)
    ledger.step("export", [table.path], [paths.export], {}, export)
    steps = [("review_logs", [paths.log_reviews_csv], [silver[SILVER_REVIEW_LOGS]], {"fmt": fmt}, logs),
             ("classified_review", [paths.movie_review_csv], [silver[SILVER_CLASSIFIED_REVIEW]], {"fmt": fmt, "words": words}, reviews),
             ("user_purchase", [paths.export], [silver[SILVER_USER_PURCHASE]], {"fmt": fmt}, purchases)]
    with ThreadPoolExecutor(max_workers=len(steps) if concurrent_silver else 1, thread_name_prefix="silver") as pool:
        futures = [pool.submit(ledger.step, *s) for s in steps]
    for f in futures:  # the others' notes are written by now; then a failure is raised again
        f.result()
    ledger.step("movie_analytics", list(silver.values()), [gold], {"fmt": fmt}, analytics)
    return ResumedFlow(gold, sorted(ledger.ran), sorted(ledger.skipped))
