"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Every query is
built, planned and run over the whole tables; its result goes to Spark's no-op
sink. The time is the better of two runs, after one warm-up query.
``serving_lookup`` reads one account from a stored serving table.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cardwarden import registry  # noqa: E402
from cardwarden.session import local_session, scratch_path  # noqa: E402
from cardwarden.sources import serving  # noqa: E402

HEADLINE = [
    "j1_asof_fuse",
    "j2_latest_join",
    "j1_since_new_device",
    "j7_login_then_spend",
    "f8_f9_f10_spend_features",
    "f11_geo_impossible",
    "p2_drop_rules_txn",
    "p4_rule_report",
    "u1_dedup_txn",
    "a1_profile",
    "a4_latest_per_account",
    "a5_fp_decline_rate",
    "a6_shared_devices",
    "a10_mean_time_to_detect",
    "a12_weekly_loss_avoided",
    "a17_shadow_eval",
    "t1_case_queue",
    "t6_top_contributors",
    "m2_split_exact",
    "m6_roc_auc",
    "m10_psi",
    "n2_n3_case_table",
    "n4_q8_loss_and_fp",
    "n5_payload",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    known = registry.queries()

    def run(name: str) -> None:
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("j1_asof_fuse")
    times = {name: round(min(timed(lambda: run(name)) for _ in range(2)), 3) for name in names}

    if not sys.argv[1:]:
        path = scratch_path(spark, "bench-serving")
        serving.write_serving(known["a4_latest_per_account"](spark, sf_dir), path)
        table = serving.read_serving(spark, path)
        reads = sorted(
            timed(lambda: serving.lookup(table, registry.ACCOUNT).collect()) for _ in range(20)
        )
        times["serving_lookup"] = round(reads[len(reads) // 2], 4)

    print(json.dumps({
        "metric": "headline_query_seconds_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
