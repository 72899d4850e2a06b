"""The entry module imports and lists its queries anywhere: with PySpark
loaded from a zip, with no session, and from another folder."""

import glob
import os
import subprocess
import sys

import pyspark

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_from_zipped_pyspark(tmp_path):
    lib = os.path.join(os.path.dirname(os.path.abspath(pyspark.__file__)), "python", "lib")
    zips = sorted(glob.glob(os.path.join(lib, "*.zip")))
    assert any(z.endswith("pyspark.zip") for z in zips)
    code = ("import pyspark, __spark_entry__ as e; assert '.zip' in pyspark.__file__;"
            "assert len(e.queries()) >= 93 and len(e.oracle_sql()) >= 87")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                          env=os.environ | {"PYTHONPATH": ":".join([*zips, REPO])}, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


def test_ngrams_of_any_length(spark):
    from textmine.operators.ngrams import count_ngrams

    df = spark.createDataFrame([("a b c d e f g",)], "text string")
    out = count_ngrams(df, 6)
    assert out.columns == [*(f"word{i}" for i in range(1, 7)), "n"] and out.count() == 2
