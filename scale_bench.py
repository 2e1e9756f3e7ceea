"""The supplier panel repeated 100 and 1000 times under new tickers: seconds and growth per operator.

`python scale_bench.py [sf_dir] [times ...]` prints one JSON line per size.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import functions as F

from plumbline.catalog.panels import FEATURES, supplier_panel
from plumbline.operators.mcd import robust_mahalanobis
from plumbline.operators.ranking import percentile_scores
from plumbline.operators.winsor import winsorize
from plumbline.operators.zscores import peer_zscores, self_history_zscores
from plumbline.plans.scoring import score_filings
from plumbline.session import local_session, materialize, release_scratch


def repeated(spark, sf_dir: str, times: int):
    """Every copy has tickers of its own and values moved a little, so nothing collapses."""
    copies = supplier_panel(spark, sf_dir).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    return materialize(copies.select(
        F.concat("ticker", F.lit("-"), F.col("copy").cast("string")).alias("ticker"),
        F.date_format("report_date", "yyyy-MM-dd").alias("report_date"),
        *[(F.col(f) * (1 + F.col("copy") / F.lit(1e4))).alias(f) for f in FEATURES]), "repeated")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("8", "plumbline-scale")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    jobs = {
        "winsorize": lambda p: winsorize(p, FEATURES),
        "self_z": lambda p: self_history_zscores(p, FEATURES),
        "peer_z": lambda p: peer_zscores(p, FEATURES),
        "percentile_score": lambda p: percentile_scores(p, "revenue", "score"),
        "mcd_distance": lambda p: robust_mahalanobis(p, FEATURES),
        "score_filings": lambda p: score_filings(p, FEATURES),
    }
    for times in [int(a) for a in sys.argv[2:]] or [1, 100, 1000]:
        panel = repeated(spark, sf_dir, times)
        seconds = {}
        for name, job in jobs.items():
            began = time.perf_counter()
            job(panel).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - began, 1)
        print(json.dumps({"times": times, "rows": panel.count(), "seconds": seconds}), flush=True)
        release_scratch(spark)


if __name__ == "__main__":
    main()
