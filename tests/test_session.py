"""The driver's work folder goes when it ends; outputs and the stored model stay."""
import os
import subprocess
import sys

CODE = """
import sys
sys.path.insert(0, {root!r})
from ledgerlake.session import build_session, output_path, shared_root, work_path
spark = build_session(master="local[2]", extra={{"spark.checkpoint.dir": {ckpt!r}}})
for path in (work_path(spark, "a"), work_path(spark, "b"), output_path(spark, "c")):
    spark.range(3).write.parquet(path)
    print("PATH", path)
assert shared_root(spark) == {ckpt!r}
"""


def test_work_tables_go_and_outputs_stay(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", CODE.format(root=root, ckpt=str(tmp_path))], capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
    paths = [line.split()[1].removeprefix("file:") for line in done.stdout.splitlines() if line.startswith("PATH")]
    assert [os.path.isdir(p) for p in paths] == [False, False, True]
