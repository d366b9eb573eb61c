"""The escalation ladder over results as they arrive: a stateful stream.

A provider's result of a strategy is an event. The state of a document is where it stands on the
ladder, what it has spent, and the results that have arrived for strategies further up. An event
that is next in turn is judged at once, along with those that wait behind it; attempts come out
in the order of the ladder, whatever the order of the events. A strategy that has been judged, or
waits, is not judged again, so repeated events change nothing, and neither do events of a finished
document; events that come later than ``LATE`` are left out. A timer ends documents that no event has reached for ``WAIT`` of event time: those that
still wait for a result fail with ``provider_timeout``, and the state of either kind goes.

Every key costs some milliseconds a batch, in calls of the state most of all, so documents are
kept in ``BUCKETS`` by their hash: a bucket is read and written once a batch, and has one timer, for
the first end of a document. A bucket holds the documents of the last ``WAIT`` that fall into it.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from folioflow.config import ExtractionRules
from folioflow.operators.extraction import LADDER, costs
from folioflow.sources.sinks import scratch

WAIT = 6 * 3600 * 1000
LATE = "2 hours"
BUCKETS = 4096
#: What a result event has.
EVENT = "doc_id long, ts timestamp, start string, strategy string, confidence double, has_document boolean, cost double"
ATTEMPT = "doc_id long, attempt int, strategy string, confidence double, cost double, budget_spent double, accepted boolean, escalated boolean, error string"
_ATTEMPT = Row(*[f.split()[0] for f in ATTEMPT.split(", ")])
_RUNGS = range(len(LADDER))
_STATE = "doc_id: bigint, rung: int, attempt: int, spent: double, done: boolean, until: bigint, " + ", ".join(f"c{i}: double, h{i}: boolean, p{i}: double" for i in _RUNGS)


def result_events(docs: DataFrame, rules: ExtractionRules = ExtractionRules()) -> DataFrame:
    """What ``extraction.attempts`` takes as one event for each strategy from the start on, without a time."""
    price = costs(F.col("pages"), rules)
    rungs = F.array(*[F.struct(F.lit(s).alias("strategy"), F.col(f"c_{s}").alias("confidence"), F.col(f"has_{s}").alias("has_document"), price[s].alias("cost")) for s in LADDER])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "start", F.explode(rungs).alias("r")).select("doc_id", "start", "r.*")


class Ladder(StatefulProcessor):
    """The ladder of all documents of a bucket."""

    def __init__(self, rules: ExtractionRules, one_page: float) -> None:
        self.rules, self.one_page = rules, one_page

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("ladder", f"timer long, docs array<struct<{_STATE}>>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        heard: dict[int, list[Row]] = {}
        for r in rows:
            if r["ms"] >= watermark:
                heard.setdefault(r["doc_id"], []).append(r)
        if not heard:
            return
        timer, docs = self._held()
        ends = []
        for doc_id, events in heard.items():
            docs[doc_id], out = self._judged(doc_id, docs.get(doc_id), events, watermark)
            ends.append(docs[doc_id][5])
            for row in out:
                yield _ATTEMPT(*row)
        # The timer must not come after the first end.
        if timer is None or min(ends) < timer:
            timer = min(ends)
            self.handle.registerTimer(timer)
        self.state.update((timer, list(docs.values())))

    def _held(self) -> tuple[int | None, dict[int, tuple]]:
        held = self.state.get()
        return (held[0], {d[0]: tuple(d) for d in held[1]}) if held else (None, {})

    def _judged(self, doc_id: int, held: tuple | None, events: list[Row], watermark: int) -> tuple[tuple, list[tuple]]:
        """A document's new state and attempts."""
        _, rung, attempt, spent, done, _ = held[:6] if held else (doc_id, LADDER.index(events[0]["start"]), 0, 0.0, False, None)
        results = {i: held[6 + 3 * i : 9 + 3 * i] for i in _RUNGS if held[8 + 3 * i] is not None} if held else {}
        for r in events:
            results.setdefault(LADDER.index(r["strategy"]), (float(r["confidence"]), bool(r["has_document"]), float(r["cost"])))
        out = []
        while not done and rung in results:
            confidence, has, cost = results[rung]
            strategy, attempt = LADDER[rung], attempt + 1
            over = strategy == "vision" and spent + self.one_page > self.rules.budget
            accepted = has and confidence >= self.rules.accept[strategy]
            top = rung == len(LADDER) - 1
            error = "budget_cap_exceeded" if over else "all_strategies_below_threshold" if top and not accepted else None
            out.append((doc_id, attempt, strategy, confidence, cost, spent + (0.0 if over else cost), accepted and not over, attempt > 1, error))
            done = accepted or top
            spent += max(cost, 0.0)
            rung += 1
        # Results below the rung, and those of a finished document, need not be kept.
        waiting = {} if done else {i: r for i, r in results.items() if i >= rung}
        until = max(r["ms"] for r in events) + WAIT
        return (doc_id, rung, attempt, spent, done, until, *[x for i in _RUNGS for x in waiting.get(i, (None, None, None))]), out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        timer, docs = self._held()
        # Of timers that an earlier one has replaced, nothing is left to do.
        if timer is None or timer > watermark:
            return
        for doc_id, rung, attempt, spent, done, until, *_ in list(docs.values()):
            if until <= watermark:
                del docs[doc_id]
                if not done:
                    yield _ATTEMPT(doc_id, attempt + 1, LADDER[rung], 0.0, 0.0, spent, False, attempt > 0, "provider_timeout")
        if not docs:
            self.state.clear()
            return
        timer = min(d[5] for d in docs.values())
        self.handle.registerTimer(timer)
        self.state.update((timer, list(docs.values())))

    def close(self) -> None:
        pass


def escalated(events: DataFrame, rules: ExtractionRules = ExtractionRules()) -> DataFrame:
    """The attempts of a stream of result events, as columns of ATTEMPT."""
    one_page = events.sparkSession.range(1).select(costs(F.lit(1), rules)["vision"].alias("x")).first().x
    watched = events.withWatermark("ts", LATE).withColumn("ms", F.unix_millis("ts")).withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)))
    return watched.groupBy("bucket").transformWithState(statefulProcessor=Ladder(rules, one_page), outputStructType=ATTEMPT, outputMode="append", timeMode="EventTime")


def drained(spark: SparkSession, path: str, schema: StructType | str = EVENT, files: int = 1, rules: ExtractionRules = ExtractionRules()) -> DataFrame:
    """The attempts once all files at ``path`` are read, ``files`` of them a batch, with a state store on disk."""
    out, state = scratch(spark, "escalation"), scratch(spark, "escalation-state")
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

        spark.createDataFrame([], ATTEMPT).write.parquet(f"{out}/batch=-1")
        escalated(stream, rules).writeStream.outputMode("append").option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return spark.read.schema(ATTEMPT).parquet(out)
