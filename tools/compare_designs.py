"""Measure rainfall per country-year from gzip CSV files and from the Parquet lake (sf0.1 by default).

usage: python tools/compare_designs.py [sf_dir]   -> one JSON line
"""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from stratus.operators import observations as ob  # noqa: E402
from stratus.plans import fixtures as fx  # noqa: E402
from stratus.session import local_session  # noqa: E402
from stratus.sources.daily import read_daily_csv, write_daily_archive  # noqa: E402
from stratus.sources.lake import read_observation_lake, write_observation_lake  # noqa: E402


def timed(fn, repeat=3):
    fn()  # warm-up
    ts = []
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        ts.append(time.perf_counter() - t)
    return round(statistics.median(ts), 3)


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session("compare", 8, 16)
    spark.sparkContext.setLogLevel("ERROR")
    out = {"sf_dir": sf}

    base = tempfile.mkdtemp(prefix="stratus-compare-")
    obs = fx.fx_obs_l(spark, sf)
    csv_dir = write_daily_archive(obs, f"{base}/daily", by_year=True)
    lake = write_observation_lake(obs, f"{base}/lake")
    cty = fx.fx_country(spark, sf)
    from_csv = lambda: run(ob.country_year_average(read_daily_csv(spark, csv_dir), cty))
    from_lake = lambda: run(ob.country_year_average(read_observation_lake(spark, lake), cty))
    one_year = lambda: run(
        ob.country_year_average(read_observation_lake(spark, lake).filter(F.col("YEAR") == 2000), cty)
    )
    out["rainfall_gzip_csv_sec"] = timed(from_csv)
    out["rainfall_parquet_lake_sec"] = timed(from_lake)
    out["rainfall_one_year_lake_sec"] = timed(one_year)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
