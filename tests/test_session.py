import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.path.insert(0, {root!r})
import codeframe as cf
import pandas as pd
spark = cf.build_session("local[2]", spark__sql__shuffle__partitions="2")
spark.range(10).write.parquet({out!r})
df = cf.with_row_no(spark.read.parquet({out!r}))
print("rows", cf.chunk_map(df, lambda r, p: pd.DataFrame({{"n": [len(r)]}}), "n int", 5).count())
"""


def test_functions_travel_to_workers_from_any_folder(tmp_path):
    """Workers need not be able to import the package."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = CODE.format(root=ROOT, out=str(tmp_path / "t"))
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "rows 2" in done.stdout, done.stderr[-2000:]


def test_sized_settings():
    from codeframe.session import sized_settings
    small, large = sized_settings(10 << 30), sized_settings(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200" and small["spark.sql.files.maxPartitionBytes"] == str(128 << 20)
    assert 100_000 < int(large["spark.sql.shuffle.partitions"]) <= 200_000 and int(large["spark.sql.files.maxPartitionBytes"]) > 200 << 20
