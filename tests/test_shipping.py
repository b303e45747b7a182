import os
import subprocess
import sys
from pathlib import Path

CODE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from modtally.functions import clean_text
from modtally.session import local_session
from modtally.sources.dumps import read_dumps
spark = local_session("1")
assert spark.createDataFrame([("a &lt; b",)], "t string").select(clean_text(F.col("t"))).first()[0] == "a < b"
assert [r.value for r in read_dumps(spark, [{dump!r}]).collect()] == ["x", "y"]
print("shipped")
"""


def test_executors_need_no_installed_package(tmp_path):
    """A job started elsewhere: workers cannot import the library and get it with the job."""
    import lzma

    dump = tmp_path / "RC_2018-01.xz"
    dump.write_bytes(lzma.compress(b"x\ny\n"))
    root = str(Path(__file__).resolve().parents[1])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", CODE.format(root=root, dump=str(dump))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "shipped" in done.stdout, done.stderr[-3000:]
