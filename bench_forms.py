"""Time the library's formulations against the plain forms on the same stored input.

Prints one JSON line; every form runs twice and the second run counts.
"""

import json
import os
import time

from bench import session
from trailmark.operators.identity import first_day_flag, stitch_identity
from trailmark.plans import journey, tracking, trends
from trailmark.sources import scratch_folder, write_files
from workload import adapters, plain


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", "8"))

    def stored(frame, name):
        path = scratch_folder(spark, name)
        write_files(frame, path)
        return spark.read.parquet(path)

    hits = stored(tracking.branded_hits(adapters.sessions(spark, sf_dir)), "hits")
    interest = stored(adapters.interest(spark, sf_dir), "interest")
    mediums = adapters.mediums(spark)
    member, device, at = "marsId", "fullVisitorId", "visitStartDateTime"

    def both(frame):
        return stitch_identity(first_day_flag(frame, member, at), member, device, at)

    forms = {
        "journey": lambda: journey.customer_journey(hits, mediums),
        "journey, plain": lambda: plain.plain_journey(hits, mediums),
        "identity on hits": lambda: both(hits),
        "identity on hits, plain": lambda: plain.plain_stitch(plain.plain_first_day(hits)),
        "slopes": lambda: trends.trend_slopes(interest),
        "slopes, plain": lambda: plain.plain_slopes(interest),
    }
    times = {}
    for name, form in forms.items():
        for _ in range(2):
            start = time.perf_counter()
            form().write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"input": sf_dir, "hits": hits.count(), "seconds": times}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
