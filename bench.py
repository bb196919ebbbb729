"""Time every query after a warm-up; print one JSON line.

Each result is written to the no-op sink, so all columns of all rows are computed. A query runs up
to three times, as long as its runs together are short, and its least time counts. The warm-up also
fills the warehouse that the queries over day folders read; that is not timed.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from cadenza.checks.queries import QUERIES  # noqa: E402
from cadenza.session import build_session  # noqa: E402


# Queries over day folders; their source days, and what is kept of them, are in place before timing.
FILLED = ("song_features", "ledger", "active_users")
RUNS, ENOUGH = 3, 10.0  # runs of a query, and the seconds after which no further one begins


def seconds_of(run) -> float:
    """The least time of up to ``RUNS`` runs."""
    times = []
    while len(times) < RUNS and sum(times) < ENOUGH:
        started = time.perf_counter()
        run()
        times.append(time.perf_counter() - started)
    return round(min(times), 3)


def scale(folder: str) -> float | str:
    name = Path(folder).name.removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        "cadenza-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Load classes and compile the shared expressions before timing.
    for name in ("song_heat_top", *FILLED):
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        seconds[name] = seconds_of(
            lambda query=QUERIES[name]: query(spark, folder)
            .write.format("noop").mode("overwrite").save()
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale(folder),
            }
        )
    )


if __name__ == "__main__":
    with contextlib.suppress(BrokenPipeError):
        main()
