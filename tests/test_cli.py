import json

from tests.fixtures import ROWS
from turnstile.cli import main
from turnstile.sources.schemas import SOURCE_SCHEMAS


def test_cli_jobs(spark, scratch, capsys):
    source = f"{scratch}/src"
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, SOURCE_SCHEMAS[name]).write.parquet(f"{source}/{name}.parquet")
    assert main(["dump", "--source", source, "--out", f"{scratch}/dump", "--from", "2014-10-01",
                 "--to", "2014-10-01 23:59", "--variant", "day", "--email-suffix", "@crm.test",
                 "--profile-id", "P1"]) == 0
    assert spark.read.parquet(f"{scratch}/dump/tickets").count() == 7
    assert main(["accounts", "--source", source, "--out", f"{scratch}/acc", "--from", "2014-10-01",
                 "--to", "2014-10-01 23:59"]) == 0
    assert spark.read.parquet(f"{scratch}/acc/orders").count() == 3
    capsys.readouterr()
    assert main(["sync", "--source", source, "--state", f"{scratch}/state",
                 "--now", "2016-03-01T00:00:00"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["from"].startswith("2016-02-01") and out["counts"]["tickets"] == 0
