"""Time the whole job on a wide catalogue made of ``lineitem``: python tools/measure_catalogue.py [folder] [copies]

Every copy of a row is moved a little and written as a line of 107 fields. Prints the size
of the text and how long it takes from files to merged partitions.
"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from starloom import jobs  # noqa: E402

FIELDS = 107


def main(folder: str, copies: int) -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "32")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    place = Path(tempfile.mkdtemp(prefix="run-"))
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    moved = F.col("l_extendedprice") + F.col("copy") * F.rand(1), F.col("l_quantity") + F.rand(2)
    fillers = [F.round(F.rand(k) * 1e6, 6).cast("string") for k in range(3, FIELDS)]
    line = F.concat_ws(",", F.col("l_orderkey").cast("string"), *[m.cast("string") for m in moved], *fillers)
    rows.select(line.alias("value")).write.text(str(place / "files"))
    names = ["id BIGINT", "x DOUBLE", "y DOUBLE", *[f"f{k} DOUBLE" for k in range(3, FIELDS)]]
    (place / "definition").write_text("CREATE TABLE t (\n" + ",\n".join(names) + "\n);\n")
    size = sum(f.stat().st_size for f in (place / "files").glob("part-*")) / 1e6
    start = time.perf_counter()
    written = jobs.partition_merged(
        spark, str(place / "definition"), str(place / "files"), str(place / "out"), "x", "y", minimum=10_000, threshold=20_000
    )
    took = time.perf_counter() - start
    print(f"{size:.0f} MB in {took:.1f} s: {size / took:.1f} MB/s; {written.count()} lines")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", int(sys.argv[2]) if len(sys.argv) > 2 else 2)
