"""The streams as commands.

``spark-submit --packages <spark-sql-kafka> cadenza/live.py visitors --servers host:9092
--checkpoint /shared/visitors --jdbc-url <url>``
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cadenza.session import build_session
from cadenza.sources import messages
from cadenza.streaming import arrivals, counts, runs

STATE_PARTITIONS = 64


def start(
    spark: SparkSession,
    stream: str,
    log,
    checkpoint: str,
    writer_for,
    delay: str | None = None,
    window: str = counts.WINDOW,
    slide: str | None = None,
    top: int = counts.TOP_SONGS,
    beats: bool = False,
    **trigger,
) -> list:
    """Start the query of ``stream`` over the (value, timestamp) log; ``writer_for`` gives the
    writer of a result table. Without ``delay`` windows go by arrival and the running one
    is shown; with it they go by event time and the last complete one is shown. The
    heartbeat is a source of every run, muted without ``beats``, so that a stream that has
    read a backlog goes on live from the same checkpoint."""
    parsed = runs.with_heartbeat(messages.parse(log), not beats, delay is not None)
    views, users, hot = (writer_for(t) for t in (runs.PV_TABLE, runs.UV_TABLE, runs.SONG_TABLE))
    if delay is None:
        trigger = trigger or {
            "processingTime": slide
            or (runs.SONG_TRIGGER if stream == "songs" else runs.VISITOR_TRIGGER)
        }

        def write_visitors(rows) -> None:
            found = arrivals.visitors(rows).persist()
            views(found.select("mid", "pv"))
            users(found.select("mid", "uv"))
            found.unpersist()

        keys, write = ("mid", "uid"), write_visitors
        if stream == "songs":
            keys, write = ("songname",), lambda rows: hot(arrivals.songs(rows, top))
        place = f"{checkpoint}/{stream}-arrival"
        return [arrivals.start(parsed, keys, write, place, window, **trigger)]
    place = f"{checkpoint}/{stream}"
    if stream == "songs":
        slide = slide or counts.SONG_SLIDE
        return [runs.start_hot_songs(parsed, hot, place, delay, window, slide, top, **trigger)]
    slide = slide or counts.VISITOR_SLIDE
    return [runs.start_visitors(parsed, views, users, place, delay, window, slide, **trigger)]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one stream until it is stopped.")
    parser.add_argument("stream", choices=["visitors", "songs"])
    parser.add_argument("--servers", required=True, help="broker addresses")
    parser.add_argument("--topic", default=messages.TOPIC)
    parser.add_argument(
        "--offset", action="append", metavar="PARTITION=OFFSET",
        help="first start, given for every partition (-2: its beginning); default: beginnings",
    )
    parser.add_argument("--rate", type=int, default=messages.RATE, help="messages of a batch")
    parser.add_argument(
        "--delay", help="windows by event time, for messages at most this late; later ones are "
        "dropped and reported. Without it windows go by arrival and nothing is late",
    )
    parser.add_argument("--window", default=counts.WINDOW)
    parser.add_argument("--slide", help="of windows, and how often arrival windows are shown")
    parser.add_argument("--top", type=int, default=counts.TOP_SONGS, help="songs of a window")
    parser.add_argument(
        "--backlog", action="store_true",
        help="mute the heartbeat: old messages are read, the last windows wait for newer ones; "
        "start again without it to go on live",
    )
    parser.add_argument("--checkpoint", required=True, help="shared folder for progress")
    parser.add_argument(
        "--partitions", default=str(STATE_PARTITIONS),
        help="state partitions, fixed once a checkpoint exists",
    )
    parser.add_argument("--jdbc-url", required=True)
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")
    args = parser.parse_args(argv)
    properties = dict(item.split("=", 1) for item in args.jdbc_property)
    spark = build_session(
        f"cadenza-{args.stream}", spark__sql__shuffle__partitions=args.partitions
    )
    offsets = None
    if args.offset:
        pairs = (item.split("=", 1) for item in args.offset)
        offsets = {int(partition): int(at) for partition, at in pairs}
    log = messages.from_kafka(
        spark, args.servers, topic=args.topic, offsets=offsets, rate=args.rate
    )
    spark.streams.addListener(runs.LateReport())
    start(
        spark,
        args.stream,
        log,
        args.checkpoint,
        lambda table: runs.jdbc_writer(args.jdbc_url, table, properties),
        args.delay,
        args.window,
        args.slide,
        args.top,
        beats=not args.backlog,
    )
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
