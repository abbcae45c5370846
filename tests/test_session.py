import os
import subprocess
import sys
from pathlib import Path

from tallyshelf.session import get_spark, shuffle_width

ROOT = Path(__file__).resolve().parents[1]


def test_shuffle_width_follows_the_input():
    assert shuffle_width(0) == 200
    assert shuffle_width(10**12) == 3726
    assert shuffle_width(100 * 10**12) == 372_530


def test_a_running_session_keeps_its_settings(spark):
    width = spark.conf.get("spark.sql.shuffle.partitions")
    assert get_spark() is spark
    assert spark.conf.get("spark.sql.shuffle.partitions") == width == "4"


def test_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.ui.enabled") == "false"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert spark.sparkContext.master == "local[4]"


def test_a_submitted_master_and_width_stay():
    code = "from tallyshelf.session import get_spark; s = get_spark(); print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))"
    submitted = "--master local[2] --conf spark.sql.shuffle.partitions=7 --conf spark.ui.enabled=false pyspark-shell"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": submitted, "PYTHONPATH": str(ROOT)}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert "GOT local[2] 7" in out.stdout, out.stderr[-2000:]
