"""The whole pipeline over 18 million CSV rows of 49 columns.

    python bench_csv.py make FOLDER     write the CSV once (about 3 GB)
    python bench_csv.py run FOLDER      time the pipeline on it
    python bench_csv.py land FOLDER     land it as Parquet in FOLDER-landed
    python bench_csv.py append FOLDER   the same without the shuffle, in FOLDER-appended
    python bench_csv.py run-landed FOLDER-landed

The rows are the flights derived from the driver's tables, repeated 30 times, with
the unused columns filled so that a row has about the width of the original file's.
"""

import os
import sys
import time

from pyspark.sql import functions as F

from bench import repeated, session
from driver_tables import flights
from punctuality.plans import pipeline
from punctuality.schema import FLIGHT_SCHEMA, NEEDED_COLUMNS
from punctuality.sources.flights import land, read_flights, read_landed

COPIES = 30
FILLERS = {"INT": 1234, "FLOAT": 12.0, "STRING": "text"}


def make(spark, folder: str) -> None:
    source = flights(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    columns = []
    for field in FLIGHT_SCHEMA.split(","):
        name, kind = field.split()
        columns.append((F.col(name) if name in NEEDED_COLUMNS else F.lit(FILLERS[kind])).alias(name))
    columns[3] = F.col("copy").cast("string").alias("OP_CARRIER_FL_NUM")
    rows = repeated(source, COPIES, tasks=16)
    rows.select(*columns).write.option("header", True).csv(folder)


def main(command: str, folder: str) -> None:
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    start = time.perf_counter()
    if command == "make":
        make(spark, folder)
    elif command == "land":
        land(read_flights(spark, folder), f"{folder}-landed")
    elif command == "append":
        land(read_flights(spark, folder), f"{folder}-appended", rebalance=False)
    elif command == "run":
        pipeline.run(spark, [folder])
    elif command == "run-landed":
        pipeline.run(spark, [], flights=read_landed(spark, folder))
    print(f"{command}: {time.perf_counter() - start:.1f} s")


if __name__ == "__main__":
    main(*sys.argv[1:])
