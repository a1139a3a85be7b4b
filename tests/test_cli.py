import json
import os

from ordermill.__main__ import main
from ordermill.schemas import ORDER_COLUMNS


def test_cli_batch_and_query(spark, tmp, capsys):
    csv = os.path.join(tmp, "orders.csv")
    with open(csv, "w") as f:
        f.write(",".join(ORDER_COLUMNS) + "\n")
        f.write("A1,1,2,3,,2026-05-30,1,10.0,5,1.5,UPI,2,0,Delivered,West Hub,4,Pune,MH\n")
        f.write("B1,x,2,3,,2026-05-30,1,10.0,5,1.5,UPI,2,0,Delivered,West Hub,4,Pune,MH\n")
    raw = os.path.join(tmp, "raw")
    assert main(["batch", "--orders", csv, "--raw", raw]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["orders"] == {"total_rows": 2, "good_rows": 1, "bad_rows": 1}
    res = os.path.join(tmp, "q")
    assert main(["query", "source_volume", "--data", "/root/testdata/sf0.001", "--out", res]) == 0
    assert spark.read.parquet(res).count() == 2
    assert not spark.sparkContext._jsc.sc().isStopped()
