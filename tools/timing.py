"""Split the time of registered queries into build, plan and run: ``python tools/timing.py sf_dir name ...``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str]) -> None:
    from ticketlake.queries import REGISTRY
    from ticketlake.session import build_session

    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = argv[0]
    for name in ["daily_summary", *(argv[1:] or list(REGISTRY))]:
        t0 = time.time()
        df = REGISTRY[name].run(spark, sf_dir)
        t1 = time.time()
        plan = df._jdf.queryExecution().executedPlan().toString()
        t2 = time.time()
        df.write.format("noop").mode("overwrite").save()
        t3 = time.time()
        print(f"{name:32s} build {t1 - t0:6.2f} plan {t2 - t1:6.2f} run {t3 - t2:6.2f} chars {len(plan)}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
