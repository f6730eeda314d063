"""The package reaches Python workers that do not have its folder."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from tagwerk.session import build_session, ship_package
spark = build_session("local[2]", 2)
ship_package(spark)
ship_package(spark)

def run(batches):
    import tagwerk.session
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([tagwerk.session.__file__] * batch.num_rows)], names=["f"])

print("FROM", spark.range(4).mapInArrow(run, "f string").distinct().first()[0])
"""


def test_workers_import_the_archive(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    line = next(x for x in out.stdout.splitlines() if x.startswith("FROM"))
    assert "tagwerk.zip" in line, out.stderr[-2000:]
