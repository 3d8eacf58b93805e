"""Union of keys, order numbers, stop per source and the reply store."""

import json
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from fundlake.operators.reconcile import reconcile_funding
from fundlake.operators.reply_store import read_store, with_stored_replies
from fundlake.session import scratch_path
from fundlake.sources.records import order_numbers, records_table
from fundlake.sources.stages import until_first_empty


def test_keys_become_columns_in_first_seen_order(spark):
    records = ['{"b":1,"a":"x"}', '{"c":2.5,"a":"y"}', '{"a":null,"d":[1],"B":true}', "oops", "[1]", None, '{"b":"t","e":{"z":1}}', '{"row":9}', "{}"]
    df = spark.createDataFrame(list(enumerate(records)), "row long, t string").repartition(4)
    got = records_table(df, "t", ["row"], keep_cols=["row"])
    assert got.columns == ["row", "b", "a", "c", "d", "_B", "e", "_row"]
    rows = {r[0]: tuple(r)[1:] for r in got.collect()}
    assert rows[0] == ("1", "x", None, None, None, None, None) and rows[1] == (None, "y", 2.5, None, None, None, None)
    assert rows[2] == (None, None, None, "[1]", True, None, None) and rows[6] == ('"t"', None, None, None, None, '{"z":1}', None)
    assert rows[7] == (None,) * 6 + (9,) and all(v == (None,) * 7 for k, v in rows.items() if k in (3, 4, 5, 8))
    with pytest.raises(ValueError):
        records_table(df, "t", ["row"], max_columns=3)
    assert records_table(df.limit(0), "t", ["row"], keep_cols=["row"]).columns == ["row"]


def test_order_numbers_and_reconciliation_under_any_partitioning(spark):
    rng = random.Random(1)
    rows = []
    for page in range(40):
        for pos in range(rng.randint(0, 9)):
            rounds = [{"round_name": "Seed", "date": rng.choice([None, "2020", "03/21"]), "amount": rng.randint(0, 99), "currency_symbol": rng.choice([None, "$", "€"])}]
            rows.append((f"p{page:03d}", pos, f"c{rng.randint(0, 6)}", json.dumps(rounds)))
    expected = {(r[0], r[1]): i for i, r in enumerate(sorted(rows))}
    df = spark.createDataFrame(rows, "page string, pos int, company_name string, funding_rounds string")
    results = []
    for n in (1, 7, 200):
        numbered = order_numbers(df.repartition(n, "pos"), ["page", "pos"])
        assert {(r.page, r.pos): r.row_ord for r in numbered.collect()} == expected
        results.append(sorted(map(tuple, reconcile_funding(numbered, materialize_elements=False).rounds.collect())))
    assert results[0] and results[0] == results[1] == results[2]
    assert order_numbers(df.limit(0), ["page", "pos"]).count() == 0


def test_stop_at_the_first_empty_page_of_each_source(spark):
    rows = [("a", 0, 3), ("a", 1, 2), ("a", 2, 0), ("a", 3, 5), ("b", 0, None), ("b", 1, 4), ("c", 0, 1), ("c", 1, 1), (None, 0, 1), (None, 1, 0)]
    df = spark.createDataFrame(rows, "host string, page int, n_rows int")
    got = until_first_empty(df, sources=["host"])
    assert sorted(map(str, got.collect())) == sorted(map(str, df.where("(host = 'a' AND page < 2) OR host = 'c' OR (host IS NULL AND page = 0)").collect()))
    assert [r.page for r in until_first_empty(df.where("host = 'a'").drop("host")).orderBy("page").collect()] == [0, 1]


class _Calls:
    """A model that counts its calls in files and dies in the middle of its first run."""

    def __init__(self, folder, die_at):
        self.folder, self.die_at = folder, die_at

    def __call__(self, row):
        n = len(os.listdir(self.folder))
        if self.die_at is not None and n >= self.die_at:
            raise SystemExit("killed")
        with open(os.path.join(self.folder, f"{row['id']}-{row['attempt']}-{threading.get_ident()}-{n}"), "w"):
            pass
        if row["attempt"] == 1 and row["id"] % 5 == 0:
            raise RuntimeError("rate_limit_exceeded")
        if row["id"] == 7:
            raise ValueError("bad")
        return json.dumps({"id": row["id"], "t": row["t"]}), 2


def test_a_killed_run_calls_only_for_what_is_missing(spark, tmp_path):
    spark.sparkContext.addPyFile(__file__)  # the model's class, for the workers
    store, calls = scratch_path(spark, "replies"), tmp_path / "calls"
    calls.mkdir()
    df = spark.createDataFrame([(i, None if i == 3 else f"t{i}") for i in range(40)], "id long, t string").repartition(2)
    args = (["id", "t"], store)
    with pytest.raises(Exception):
        with_stored_replies(df, _Calls(str(calls), 15), *args, keep_cols=["id"], flush=4)
    landed = read_store(spark, store).count()
    assert 0 < landed < 40 and landed == len(list(calls.iterdir()))
    got = with_stored_replies(df, _Calls(str(calls), None), *args, keep_cols=["id"], flush=4).collect()
    assert len(list(calls.iterdir())) == 40 + 8  # every row once, the eight limited ones twice
    by_id = {r.id: (r.attempt, r.value, r.error, r.total_tokens) for r in got}
    assert len(got) == 40 and by_id[7] == (1, None, "ValueError: bad", 0)
    assert by_id[5] == (2, '{"id": 5, "t": "t5"}', None, 2) and by_id[3] == (1, '{"id": 3, "t": null}', None, 2)
    again = with_stored_replies(df, _Calls(str(calls), 0), *args, keep_cols=["id"]).count()
    assert again == 40 and len(list(calls.iterdir())) == 48


def test_equal_inputs_share_a_call(spark, tmp_path):
    spark.sparkContext.addPyFile(__file__)
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id long, t string")
    got = with_stored_replies(df, _Calls(str(tmp_path), None), ["id", "t"], scratch_path(spark, "replies"), keep_cols=["id"], concurrency=2)
    assert sorted(r.id for r in got.collect()) == [1, 1, 2] and len(list(tmp_path.iterdir())) == 2
    assert got.where(F.col("value").isNull()).count() == 0
