"""Counts about rules and rejects."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from rowsieve.operators.rules import Rule
from rowsieve.operators.split import TRACE_COLUMN, is_ko


def _rule_counts(rules: Sequence[Rule]) -> list:
    return [F.count_if(rule.failed()).alias(f"failed_{i}") for i, rule in enumerate(rules)]


def expectation_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``field, rule, failed, passed, total``: one scan and one global aggregate for all rules."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *_rule_counts(rules))
    rows = [
        F.struct(
            F.lit(rule.field).alias("field"),
            F.lit(rule.code).alias("rule"),
            F.col(f"failed_{i}").alias("failed"),
            (F.col("total") - F.col(f"failed_{i}")).alias("passed"),
            F.col("total").alias("total"),
        )
        for i, rule in enumerate(rules)
    ]
    shape = "struct<field:string,rule:string,failed:bigint,passed:bigint,total:bigint>"
    return counts.select(F.inline(F.array(*rows).cast(f"array<{shape}>")))


def observe_rules(
    df: DataFrame, rules: Sequence[Rule], name: str
) -> tuple[DataFrame, Observation | None]:
    """Attach row and per-rule counts to whatever action ``df`` runs next.

    Gives the frame and an :class:`Observation` (``None`` on a stream, where the same numbers
    arrive as ``observedMetrics`` of the query progress under ``name``; see :func:`watch_rules`).
    """
    metrics = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_ko(rules)).alias("rows_ko"),
        *_rule_counts(rules),
    ]
    if df.isStreaming:
        return df.observe(name, *metrics), None
    observation = Observation(name)
    return df.observe(observation, *metrics), observation


class StreamCounts(StreamingQueryListener):
    """What :func:`observe_rules` counts on a stream, taken from the progress of its query.

    A batch reports its progress when it is committed, so one that failed and is repeated counts once; all batches
    count, however many there are. Within ``with`` the listener is registered, at its end all reports have arrived.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.name = name
        self._spark = spark
        self._batches: dict[tuple[str, int], dict[str, int]] = {}
        self._running: set[str] = set()
        self._ended: set[str] = set()
        self._quiet = threading.Condition()

    def __enter__(self) -> StreamCounts:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        # Reports arrive on a thread of their own.
        with self._quiet:
            self._quiet.wait_for(lambda: not self._running, timeout=60)
        self._spark.streams.removeListener(self)

    def watch(self, query: StreamingQuery) -> None:
        """Wait for the end of this query before the counts are read."""
        with self._quiet:
            if str(query.runId) not in self._ended:
                self._running.add(str(query.runId))

    def onQueryStarted(self, event) -> None:  # noqa: N802  Spark's names
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self._batches[str(event.progress.id), event.progress.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._quiet:
            self._ended.add(str(event.runId))
            self._running.discard(str(event.runId))
            self._quiet.notify_all()

    @property
    def get(self) -> dict[str, int]:
        """The sums over all batches, as of an :class:`Observation`."""
        sums: dict[str, int] = {}
        for batch in list(self._batches.values()):
            for name, count in batch.items():
                sums[name] = sums.get(name, 0) + count
        return sums


def watch_rules(df: DataFrame, rules: Sequence[Rule], name: str) -> tuple[DataFrame, StreamCounts]:
    """:func:`observe_rules` for a stream, with what collects its counts."""
    observed, _ = observe_rules(df, rules, name)
    return observed, StreamCounts(df.sparkSession, name)


def observed_failures(metrics: dict, rules: Sequence[Rule]) -> dict[tuple[str, str], int]:
    """Failures per (field, code) out of the metrics that :func:`observe_rules` collected."""
    return {(rule.field, rule.code): metrics.get(f"failed_{i}", 0) for i, rule in enumerate(rules)}


def rejects_by_code(rejected: DataFrame, column: str = TRACE_COLUMN) -> DataFrame:
    """How often each code occurs in a rejected table, for any kind of trace.

    ``code, rejects`` for an array trace, ``field, code, rejects`` for a map trace. The counts
    are combined map-side, so a code that nearly every row carries costs no skew.
    """
    dtype = rejected.schema[column].dataType
    # explode_outer, as explode makes Spark compute a trace a second time to filter on its size.
    if isinstance(dtype, T.ArrayType):
        keys = ["code"]
        codes = rejected.select(F.explode_outer(column).alias("code"))
    else:
        keys = ["field", "code"]
        codes = rejected.select(F.explode_outer(column).alias("field", "code"))
        if isinstance(dtype.valueType, T.ArrayType):
            codes = codes.select("field", F.explode_outer("code").alias("code"))
    codes = codes.filter(F.col("code").isNotNull())
    return codes.groupBy(*keys).agg(F.count(F.lit(1)).alias("rejects"))
