"""The whole streaming job: source, enrichment and all layer queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderlake import schemas
from orderlake.sources import readers
from orderlake.streaming import marked, sinks
from orderlake.streaming import transforms as T


def start_order_stack(
    orders: DataFrame, lake: str, checkpoints: str, run_once: bool = False
) -> list[StreamingQuery]:
    """Start bronze, silver, revenue, fraud and velocity queries over raw events.

    Bronze holds every row that arrived; the other layers hold order events. Revenue windows
    and the orders in the last hour on each order keep what comes too late in tables of their
    own (``marked``). Where the source keeps malformed lines, those go to
    ``silver/orders_malformed`` as well.

    ``run_once`` processes what is available and stops, for backfills and tests;
    otherwise each query runs at its own interval.
    """

    def every(interval: str) -> str | None:
        return None if run_once else interval

    enriched = T.enrich_order_events(readers.only_events(orders, "order"))
    malformed = []
    if readers.CORRUPT in orders.columns:
        enriched = enriched.filter(F.col(readers.CORRUPT).isNull()).drop(readers.CORRUPT)
        # With the fields that could be read: a source cannot give the texts of bad lines alone.
        bad = orders.filter(F.col(readers.CORRUPT).isNotNull())
        malformed = [
            sinks.to_parquet(
                bad, f"{lake}/silver/orders_malformed", f"{checkpoints}/malformed", every("1 minute")
            )
        ]
    return malformed + [
        sinks.to_parquet(
            orders, f"{lake}/bronze/orders_streaming", f"{checkpoints}/bronze", every("30 seconds")
        ),
        marked.to_silver_table(enriched, f"{lake}/silver", f"{checkpoints}/silver", every("1 minute")),
        marked.to_windows(
            enriched, f"{lake}/gold", f"{checkpoints}/revenue", every=every("10 seconds")
        ),
        sinks.to_parquet(
            T.fraud_stream(enriched),
            f"{lake}/gold/fraud_alerts",
            f"{checkpoints}/fraud",
            every("10 seconds"),
        ),
        sinks.to_parquet(
            T.customer_velocity(enriched),
            f"{lake}/gold/customer_velocity",
            f"{checkpoints}/velocity",
            every("1 minute"),
        ),
        marked.to_order_velocity(
            enriched, f"{lake}/gold", f"{checkpoints}/order_velocity", every=every("1 minute")
        ),
    ]


def await_all(queries: list[StreamingQuery], poll_seconds: int = 1) -> None:
    """Wait until every query has ended; the first failure stops the others and is raised.

    Looks at these queries only: the session's list of ended queries may hold
    failures of unrelated ones.
    """
    try:
        while active := [q for q in queries if q.isActive]:
            active[0].awaitTermination(poll_seconds)
            for q in queries:
                if q.exception() is not None:
                    raise q.exception()
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def order_source(
    spark: SparkSession,
    mode: str = "file",
    path: str | None = None,
    kafka_servers: str | None = None,
    kafka_topic: str | None = None,
    files_per_trigger: int | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Raw order events from JSON files or a Kafka topic.

    ``keep_corrupt`` keeps the text of malformed lines of files; a topic's bad messages are
    kept by ``kafka.to_log_tables``.
    """
    if mode == "kafka":
        if not (kafka_servers and kafka_topic):
            raise ValueError("kafka mode needs servers and a topic")
        return readers.stream_kafka(spark, kafka_servers, kafka_topic, schemas.ORDER_EVENT)
    if mode == "file":
        if not path:
            raise ValueError("file mode needs a path")
        return readers.stream_json(
            spark, path, files_per_trigger=files_per_trigger, keep_corrupt=keep_corrupt
        )
    raise ValueError(f"unknown mode {mode!r}")
