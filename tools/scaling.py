"""Consolidation (C3) and keyed upsert (S9) at each scale factor: seconds
and rows/s, warm (median of 3 runs after one warm-up), on local[N].

    python tools/scaling.py [cpus]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    cpus = int(sys.argv[1]) if len(sys.argv) > 1 else 8
    from cadence.operators.upsert import conform, upsert, upsert_table
    from cadence.plans.consolidate import consolidate
    from cadence.schemas import MARKET
    from cadence.session import build_session
    from cadence.sources import testdata as td
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    out = []
    for sf in ("0.001", "0.01", "0.1"):
        d = f"/root/testdata/sf{sf}"
        market = td.market(spark, d).persist()
        macro = td.macro(spark, d).persist()
        n_market, n_macro = market.count(), macro.count()
        target, batch = td.target(spark, d).persist(), td.batch(spark, d).persist()
        n_batch = batch.count()

        def timed(fn, reps=3):
            fn()
            ts = []
            for _ in range(reps):
                t0 = time.perf_counter()
                fn()
                ts.append(time.perf_counter() - t0)
            return statistics.median(ts)

        def noop(df):
            df.write.format("noop").mode("overwrite").save()

        t_cons = timed(lambda: noop(consolidate(market, macro, created_at="2026-01-01")))
        t_ups = timed(lambda: noop(upsert(target, batch, ["coin_id", "reference_date"],
                                          ["batch_seq"], list(MARKET.names[:5]))))
        base = tempfile.mkdtemp(prefix="cadence-scaling-")
        rows = conform(batch, MARKET, stamp_col="ingested_at")
        seed = conform(target, MARKET, stamp_col="ingested_at")
        upsert_table(spark, base + "/m", seed, ["coin_id", "reference_date"], MARKET)
        t_write = timed(lambda: upsert_table(spark, base + "/m", rows,
                                             ["coin_id", "reference_date"], MARKET), reps=2)
        out.append({"sf": sf, "market_rows": n_market, "macro_rows": n_macro,
                    "consolidate_s": round(t_cons, 3),
                    "consolidate_rows_per_s": round(n_market / t_cons),
                    "upsert_s": round(t_ups, 3), "upsert_batch_rows": n_batch,
                    "upsert_rows_per_s": round(n_batch / t_ups),
                    "upsert_table_s": round(t_write, 3)})
        for df in (market, macro, target, batch):
            df.unpersist()
    print(json.dumps({"cpus": cpus, "results": out}))
    spark.stop()


if __name__ == "__main__":
    main()
