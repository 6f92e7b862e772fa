import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from turnstile.sources.publish import Publication
from turnstile.sources.push_source import push, push_source

ROOT = Path(__file__).resolve().parents[1]


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, v string")


def rows(pinned, name):
    return sorted(map(tuple, pinned.read(name).collect()))


def test_products_appear_together_or_not_at_all(spark, scratch):
    out = Publication(spark, f"{scratch}/p")
    assert out.pin().products == {}
    out.replace({"a": frame(spark, (1, "x")), "b": frame(spark, (1, "y"))})
    before = out.pin()
    boom = frame(spark, (2, "z")).selectExpr("id", "raise_error('boom') as v")
    with pytest.raises(Exception, match="boom"):
        out.replace({"a": frame(spark, (2, "x")), "b": boom})
    assert out.pin().products == before.products and rows(out.pin(), "a") == [(1, "x")]  # a reader sees the old ones only
    out.replace({"a": frame(spark, (3, "x"))}, drop=["b"])
    now = out.pin()
    assert rows(now, "a") == [(3, "x")] and set(now.products) == {"a"}
    assert rows(before, "a") == [(1, "x")] and rows(before, "b") == [(1, "y")]  # a pinned version stays
    with pytest.raises(KeyError, match="not published"):
        now.read("b")
    out.append({"a": spark.createDataFrame([("w", 4)], "v string, id long"), "c": frame(spark)})
    assert rows(out.pin(), "a") == [(3, "x"), (4, "w")] and rows(out.pin(), "c") == []
    out.drop("c")
    assert set(out.pin().products) == {"a"}
    out.vacuum(keep=1)
    assert rows(out.pin(), "a") == [(3, "x"), (4, "w")] and len(os.listdir(f"{scratch}/p/manifests")) <= 2  # and its checksum
    with pytest.raises(Exception):
        before.read("b").collect()


def test_publishers_do_not_overwrite_each_other(spark, scratch):
    one, two = Publication(spark, f"{scratch}/p"), Publication(spark, f"{scratch}/p")
    one.replace({"a": frame(spark, (1, "x"))})
    seen = two.pin()
    one.replace({"b": frame(spark, (2, "y"))})
    assert not two._create(seen.number + 1, {})  # the number is taken
    two.replace({"c": frame(spark, (3, "z"))})
    assert set(one.pin().products) == {"a", "b", "c"}
    # a manifest that is not complete yet is passed over
    (Path(f"{scratch}/p/manifests") / "000000000099.json").write_text('{"products": {"a"')
    assert set(one.pin().products) == {"a", "b", "c"}
    one.drop("c")
    assert one.pin().number == 100 and set(one.pin().products) == {"a", "b"}


def bodies(spark, n):
    return spark.range(n).selectExpr("id as batch_id", "id % 7 + 1 as n_rows", "concat('body ', id) as body").repartition(3)


def test_push_writes_receipts_and_skips_accepted_batches(spark, scratch):
    log = f"{scratch}/log"

    def transport(endpoint, body, key):
        number = int(body.split()[1])
        with open(log, "a") as f:
            f.write(f"{endpoint} {key}\n")
        with open(log) as f:
            tries = sum(line.endswith(f"/{number}\n") for line in f)
        if number == 3 and tries < 3:
            return 503, "busy"
        if number == 5 and tries < 2:
            raise OSError("reset")
        return (400, "bad") if number == 8 and tries < 2 else (200, "ok")

    got = push(bodies(spark, 20), "contacts", "/c", "r1", f"{scratch}/receipts", transport, first_wait=0.01)
    by = {r["batch_id"]: r for r in got.collect()}
    assert len(by) == 20 and [i for i, r in by.items() if r["status"] != 200] == [8]
    assert (by[3]["attempts"], by[5]["attempts"], by[8]["attempts"], by[0]["attempts"]) == (3, 2, 1, 1) and by[6]["n_rows"] == 7
    posts = Path(log).read_text().splitlines()
    assert len(posts) == 23 and "/c r1/contacts/0" in posts
    again = push(bodies(spark, 20), "contacts", "/c", "r1", f"{scratch}/receipts", transport, first_wait=0.01)
    assert again.filter("status = 200").count() == 20 and len(Path(log).read_text().splitlines()) == 24  # only the refused one
    assert json.loads(Path(f"{scratch}/receipts/run=r1/_done/contacts.json").read_text()) == {"sent": 1, "skipped": 19, "refused": 0}


def test_rate_of_a_task(scratch):
    import time

    times = []
    source = push_source(lambda *a: (times.append(time.monotonic()), (200, ""))[1], per_second=50)
    writer = source({"entity": "e", "endpoint": "/", "run": "r", "receipts": f"{scratch}/r"}).writer(None, False)
    writer.write(iter([{"batch_id": i, "n_rows": 1, "body": ""} for i in range(10)]))
    assert times[-1] - times[0] >= 9 / 50 - 0.01


SCRIPT = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate()
from turnstile.sources.push_source import push
log, killed = {log!r}, {killed!r}
def transport(endpoint, body, key, os=os, log=log, killed=killed):
    if body == "body 12" and not os.path.exists(killed):
        open(killed, "w").close()
        os._exit(1)  # the worker is gone in the middle of its task
    with open(log, "a") as f:
        f.write(key + chr(10))
    return 200, "ok"
bodies = spark.range(40).selectExpr("id as batch_id", "1L as n_rows", "concat('body ', id) as body").repartition(2)
print("RECEIPTS", push(bodies, "e", "/e", "r", {receipts!r}, transport).filter("status = 200").count())
"""


def test_a_killed_and_retried_task_posts_no_batch_twice(tmp_path):
    code = SCRIPT.format(root=str(ROOT), log=str(tmp_path / "log"), killed=str(tmp_path / "killed"), receipts=str(tmp_path / "r"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}  # workers need not have the package
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "RECEIPTS 40" in out.stdout, out.stderr[-2000:]
    posts = (tmp_path / "log").read_text().split()
    assert (tmp_path / "killed").exists() and sorted(posts) == sorted(f"r/e/{i}" for i in range(40))
