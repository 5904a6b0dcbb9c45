"""Time queries give the same rows whatever the zone of the driver's Python."""

import json
import os
import subprocess
import sys

NAMES = ["filter_before_anchor", "filter_after_anchor", "fn_hours_before_anchor", "last_day_cart_pairs", "last_hour_cart_pairs", "conversion_curve", "training_set", "scoring_set"]

CODE = """
import json, sys
from pyspark.sql import functions as F
from basketry.plans import registry
from basketry.session import local_session
spark = local_session(4)
out = {}
for name in sys.argv[1:]:
    df = registry.QUERIES[name](spark, "/root/testdata/sf0.01")
    r = df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    out[name] = [int(r[0]), str(r[1])]
print("RESULT" + json.dumps(out))
"""


def run(zone):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"TZ": zone, "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", CODE, *NAMES], env=env, cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return json.loads(done.stdout.split("RESULT")[1])


def test_other_zone_gives_the_utc_rows():
    utc = run("UTC")
    assert utc["last_hour_cart_pairs"][0] == 3
    assert run("America/New_York") == utc
