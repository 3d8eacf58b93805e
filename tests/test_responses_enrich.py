"""Response repair / unwrap / validation (O-41..O-47) and the enrichment map."""

from pyspark.sql import functions as F

from fundlake.operators import enrich, responses as RS


def test_repair_and_classify(spark):
    rows = [
        ('Final Answer": {"a": 1}}',),   # trailing brace dropped
        ('Final Answer": {"a": 1}',),    # cut too far -> '}' appended
        ("no marker here",),
        ('{"Action": "wiki", "Action Input": "acme"}',),
    ]
    df = spark.createDataFrame(rows, "raw string")
    kind, out, tool, tin = RS.classify_response(F.col("raw"))
    got = df.select(kind.alias("k"), out.alias("o"), tool.alias("t"), tin.alias("i")).collect()
    assert [(r.k, r.o, r.t, r.i) for r in got] == [
        ("final", '{"a": 1}', None, None),
        ("final", '{"a": 1}', None, None),
        ("unparseable", None, None, None),
        ("tool", None, "wiki", "acme"),
    ]


def test_unwrap_and_validate(spark):
    rows = [('{"properties": {"properties": {"k": 1}}}',), ('{"properties": {"properties": {}, "k": 2, "z": 0}}',),
            ('{"properties": {"k": "x"}}',), ('{"other": 1}',)]
    df = spark.createDataFrame(rows, "o string")
    obj = RS.unwrap_envelope(F.col("o"))
    missing, extra, bad = RS.validate_object(obj, ["k"], ["k"], {"k": ["integer"]})
    got = df.select(F.to_json(obj).alias("v"), missing.alias("m"), extra.alias("e"), bad.alias("b")).collect()
    assert [(r.v, r.m, r.e, r.b) for r in got] == [
        ('{"k":1}', "", "", ""),
        ('{"k":2,"properties":{},"z":0}', "", "properties,z", ""),
        ('{"k":"x"}', "", "", "k"),
        (None, "k", "", ""),
    ]


def test_vocabulary_violations(spark):
    df = spark.createDataFrame([("Energy, Forestry ,Space",)], "s string")
    from fundlake.schemas import CLIMATE_SECTORS
    assert df.select(RS.vocabulary_violations(F.col("s"), CLIMATE_SECTORS).alias("v")).first().v == "Space"


def test_batched_map_with_retry(spark):
    def _flaky(row):  # nested: shipped to workers by value
        if row["attempt"] == 1 and row["id"] % 2 == 0:
            raise RuntimeError("rate_limit_exceeded: slow down")
        if row["id"] == 3:
            raise ValueError("bad")
        return f'{{"id":{row["id"]}}}', 5

    df = spark.range(6).select(F.col("id"))
    out = enrich.with_retry(df, _flaky, ["id"], keep_cols=["id"], concurrency=2)
    got = sorted((r.id, r.attempt, r.value, r.error) for r in out.collect())
    assert got == [
        (0, 2, '{"id":0}', None), (1, 1, '{"id":1}', None), (2, 2, '{"id":2}', None),
        (3, 1, None, "ValueError: bad"), (4, 2, '{"id":4}', None), (5, 1, '{"id":5}', None),
    ]
    assert enrich.successes(out).count() == 5


def test_render_prompt(spark):
    df = spark.createDataFrame([("Acme", None)], "name string, year string")
    p = enrich.render_prompt("Company {name} ({year}) {{json}}", name=F.col("name"), year=F.col("year"))
    assert df.select(p.alias("p")).first().p == "Company Acme (None) {json}"


def test_observe_run_counters(spark):
    from fundlake.operators.analytics import observe_run

    def ok(row):
        if row["id"] == 1:
            raise ValueError("no")
        return "{}", 3

    res = enrich.batched_map(spark.range(4).select("id"), ok, ["id"], keep_cols=["id"])
    observed, obs = observe_run(res)
    observed.write.format("noop").mode("overwrite").save()
    m = obs.get
    assert (m["rows"], m["requests"], m["successes"], m["failures"], m["tokens"]) == (4, 4, 3, 1, 9)


def test_retry_calls_every_row_once_per_pass(spark, tmp_path):
    """Repeated and NULL keys, 64-bit keys beside NULLs, and a failing client whose
    answers differ from call to call: rows in = rows out, calls = rows + retries."""
    calls = str(tmp_path)

    def client(row):
        import os
        import random

        with open(f"{calls}/{os.getpid()}", "a") as out:
            out.write("x\n")
        if random.random() < 0.5:
            raise RuntimeError("rate_limit_exceeded")
        return str(row["id"]), 1

    big = (1 << 60) + 1
    ids = [big, None, big, None, 7] * 40
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(4)
    out = enrich.with_retry(df, client, ["id"], keep_cols=["id"])
    rows = out.collect()
    assert sorted((r.id is None, r.id or 0) for r in rows) == sorted((i is None, i or 0) for i in ids)
    assert out.count() == len(ids)  # read again: no further call
    made = sum(p.read_text().count("x") for p in tmp_path.iterdir())
    assert made == sum(r.attempt for r in rows)
    assert all(r.value == str(r.id) for r in rows if r.error is None)
