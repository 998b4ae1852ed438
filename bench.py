"""Headline timings: prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The first flagship run builds the inputs of the single operators and warms the
JVM; it is not counted. Operators are timed as the median of three runs into a
sink that discards the rows.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks.compare_all import session
from checks.fixtures import FIXTURE_SETTINGS, prepared_tables
from checks.world import World
from tapweave.functions.stage import stage
from tapweave.operators import alighting, boarding, interline, journeys, profiles, taps, visits
from tapweave.plans import infer as plan


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run, times: int) -> float:
    spent = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        spent.append(time.perf_counter() - start)
    return round(statistics.median(spent), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cpus, cpus)
    w = World(spark, sf_dir)
    s = FIXTURE_SETTINGS

    def flagship() -> None:
        result = plan.infer(prepared_tables(spark, sf_dir), s)
        discard(result.events)
        discard(result.failed_events)

    flagship()
    for step in ("taps", "scheduled", "merged", "chains", "runs", "legs", "candidates", "rides", "judged", "events"):
        getattr(w, step)
    located, prepared_visits = stage(w.located, "located"), stage(w.visits, "visits")

    operators = {
        "drop_bursts": lambda: taps.drop_bursts(taps.parse_datetime(w.raw("taps")), s.burst_seconds),
        "nearest_release": lambda: visits.add_stop_locations(visits.add_visit_times(w.raw("stop_events")), w.raw("stops")),
        "headways": lambda: visits.add_headways(w.merged),
        "chains": lambda: interline.chain_trips(interline.link_blocks(interline.trip_ends(located))),
        "insert_chains": lambda: interline.insert_chains(prepared_visits, w.chains),
        "platform_asof_top2": lambda: boarding.score_platform_boarding(w.platform),
        "onboard_asof_top3": lambda: boarding.scored_onboard_candidates(w.tap_keys(False), w.runs),
        "alighting_band_join": lambda: alighting.alighting_candidates(w.candidates, w.runs),
        "choose_rides": lambda: plan.choose_rides(w.candidates, w.runs, s),
        "journeys_and_rules": lambda: journeys.judge_journeys(
            journeys.build_journeys(w.rides, s.wait_minutes), s.max_days_to_destination
        ),
        "journey_profiles": lambda: profiles.journey_profiles(w.events, prepared_visits),
    }
    seconds = {"flagship": timed(flagship, 1)}
    for name, build in operators.items():
        discard(build())
        seconds[name] = timed(lambda: discard(build()), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
