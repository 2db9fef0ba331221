import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_full_run(tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    for ind, val in (("dolar", "5,2"), ("selic", "0,04"), ("ipca", "0,4")):
        os.makedirs(os.path.join(land, "macro", f"indicator={ind}"))
        with open(os.path.join(land, "macro", f"indicator={ind}", "a.json"), "w") as f:
            json.dump([{"data": "01/05/2024", "valor": val}], f)
    os.makedirs(os.path.join(land, "market", "coin_id=bitcoin"))
    ms = 1714521600000
    with open(os.path.join(land, "market", "coin_id=bitcoin", "a.json"), "w") as f:
        json.dump({"prices": [[ms, 60000.0], [ms + 86400000, 60500.0]],
                   "market_caps": [[ms, 1e9]],
                   "total_volumes": [[ms, 2e7], [ms + 86400000, 2.1e7]]}, f)
    tables = os.path.join(tmp_dir, "tables")
    out = subprocess.run(
        [sys.executable, "-m", "cadence", "all", "--tables", tables,
         "--macro-landing", os.path.join(land, "macro"),
         "--market-landing", os.path.join(land, "market"), "--master", "local[2]",
         "--shuffle-partitions", "2"],
        cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert json.loads(out.stdout.strip().splitlines()[-1]) == \
        {"macro": 3, "market": 2, "consolidated": 2}
