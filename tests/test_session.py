"""Session helpers."""

import subprocess
import sys
from pathlib import Path

import pytest

from parceltrail.session import require_ansi, scratch_dir, scratch_root, shuffle_partitions, stored_bytes

ROOT = Path(__file__).resolve().parent.parent


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    own = f"{shared}/{spark.sparkContext.applicationId}"
    assert first.startswith(f"{own}/x-") and first != second


def test_scratch_lies_below_the_warehouse_if_no_folder_is_named():
    assert scratch_root({"spark.sql.warehouse.dir": "hdfs://store/warehouse/"}) == "hdfs://store/warehouse/_scratch"


def test_scratch_goes_when_the_application_ends(tmp_path):
    code = (
        "import sys; from parceltrail.session import build_session, scratch_dir\n"
        "spark = build_session('x', 'local[1]', input_bytes=1 << 40, spark__ui__enabled='false',"
        " spark__checkpoint__dir=sys.argv[1])\n"
        "path = scratch_dir(spark, 'x'); spark.range(3).write.parquet(path)\n"
        "print(path, spark.read.parquet(path).count(), spark.conf.get('spark.sql.shuffle.partitions'))\n"
    )
    out = subprocess.run(
        [sys.executable, "-c", code, str(tmp_path)], cwd=ROOT, capture_output=True, text=True, timeout=200
    )
    path, rows, partitions = out.stdout.split()[-3:]
    assert path.startswith(str(tmp_path)) and (rows, partitions) == ("3", "8192")
    assert not Path(path).parent.exists()


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions(0) == 200 and shuffle_partitions(100 * 10**12) == 745_059


def test_size_of_stored_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("12345")
    (tmp_path / "b.csv").write_text("678")
    assert stored_bytes(spark, f"{tmp_path}/*.csv") == 8 and stored_bytes(spark, f"{tmp_path}/none*") == 0


def test_ansi_is_required(spark):
    require_ansi(spark)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError):
            require_ansi(spark)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
