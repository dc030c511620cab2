"""Times the headline queries: one JSON line on standard output."""

from __future__ import annotations

import json
import os
import time

from tallymark.catalogue import QUERIES
from tallymark.session import build_session

HEADLINE = (
    "agg_abs_sum", "agg_quarter_slice", "covenant_verdicts", "ratio_ebitda_interest", "springing_condition", "evidence_decisive", "note_addressing", "reclass_and_cutoff", "entity_match_two_level",
    "risk_ranking", "submission_violations", "active_revision", "rule_cascade", "name_learning", "group_key_dedupe", "majority_vote", "event_sessions",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("OFF")
    run = lambda f: f(spark, sf_dir).write.format("noop").mode("overwrite").save()
    run(QUERIES[HEADLINE[0]])  # starts the JVM's compilers and reads the footers
    took = {}
    for name in HEADLINE:
        began = time.perf_counter()
        run(QUERIES[name])
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rstrip("/").rpartition("sf")[2]}))
    spark.stop()


if __name__ == "__main__":
    main()
