from turnstile.sources.sinks import append_table, replace_table, table_exists


def test_replace_then_append(spark, scratch):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    replace_table(first, "ts_sink_users", path=f"{scratch}/users")
    assert table_exists(spark, "ts_sink_users")
    # create-or-replace: a second run replaces, it does not add
    replace_table(first, "ts_sink_users", path=f"{scratch}/users")
    assert spark.table("ts_sink_users").count() == 2
    # INSERT INTO t (cols) SELECT ...: matched by name, whatever the frame's order
    append_table(spark.createDataFrame([("c", 3)], "v string, id long"), "ts_sink_users")
    assert sorted(tuple(r) for r in spark.table("ts_sink_users").collect()) == [
        (1, "a"), (2, "b"), (3, "c")]


def test_transport_exception_becomes_a_response(spark):
    from turnstile.sources.sinks import push_batches

    def transport(endpoint, body, key):
        if body == "bad":
            raise OSError("refused")
        return 200, "ok"

    bodies = spark.createDataFrame([(1, 1, "good"), (2, 1, "bad"), (3, 1, "good")], "batch_id long, n_rows long, body string")
    got = {r["batch_id"]: (r["status"], r["response"]) for r in push_batches(bodies, "contacts", "/x", transport).collect()}
    assert got == {1: (200, "ok"), 2: (-1, "OSError: refused"), 3: (200, "ok")}
