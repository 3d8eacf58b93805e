"""Keyed state over arriving rows equals the batch reconciliation."""

import json
import random

import pytest

from fundlake.operators.reconcile import reconcile_funding
from fundlake.plans.views import funding_raw
from fundlake.session import scratch_path
from fundlake.streaming import rounds as S
from sf_dirs import SF_SMALL

SCHEMA = "row_ord long, company_name string, uuid string, funding_rounds string"


@pytest.fixture()
def rocks(spark):
    for key, value in S.STATE_STORE_CONF.items():
        spark.conf.set(key, value)
    yield spark
    for key in S.STATE_STORE_CONF:
        spark.conf.unset(key)


def _feed(spark, parts):
    """Feeds the parts one after the other, each by a new query over the same checkpoint."""
    landing, out, ckpt = (scratch_path(spark, n) for n in ("rounds-in", "rounds-out", "rounds-ckpt"))
    for part in parts:
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        S.land_rounds(S.rounds_stream(stream), out, ckpt).awaitTermination(600)
    return S.current_rounds(spark, out)


def _rows(df):
    cols = ["company_name", "round_rank", "round_name", "date", "amount", "currency_symbol"]
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_three_batches_with_restarts_equal_the_batch_result(rocks):
    raw = funding_raw(rocks, SF_SMALL).select("row_ord", "company_name", "uuid", "funding_rounds")
    parts = [raw.where(f"pmod(hash(row_ord), 3) = {i}") for i in (2, 0, 1)]  # not in the order of the rows
    assert _rows(_feed(rocks, parts)) == sorted(map(tuple, reconcile_funding(raw).rounds.collect()))


def test_state_in_any_arrival_order_equals_the_rule():
    rng = random.Random(3)
    for _ in range(3000):
        n = rng.randint(1, 10)
        els = [(i // 2, i % 2, rng.choice([None, None, "01/20", "02/21"]), rng.randint(-2, 9), rng.choice([None, "$", "€"])) for i in range(n)]
        arriving = els[:]
        rng.shuffle(arriving)
        state = S.RoundState()
        while arriving:
            step = rng.randint(1, 4)
            state.add(arriving[:step])
            arriving = arriving[step:]
        dated = [e for e in els if e[2] is not None]
        if not dated:
            assert state.k is None
            continue
        tail = [e for e in els if e[:2] >= dated[0][:2]]
        assert (state.k, state.date, state.amount, state.cur) == (
            dated[0][:2], dated[0][2], max(e[3] for e in tail), next((e[4] for e in tail if e[4] is not None), None))


def test_undated_elements_are_kept_only_while_a_date_could_use_them():
    early = [(i, 0, None, amount, cur) for i, (amount, cur) in enumerate([(1, None), (5, "$"), (2, "$"), (2, None), (4, None)])]
    assert [e[0] for e in S.needed(early)] == [1, 2, 4]


def test_bad_cells_and_null_companies_pass_by(rocks):
    rows = [(1, "a", "u", "not json"), (2, None, "u", "[]"), (3, "a", "u", json.dumps([{"round_name": "Seed", "date": "2021", "amount": 3}])), (4, "a", "u", None)]
    got = _feed(rocks, [rocks.createDataFrame(rows, SCHEMA)])
    assert _rows(got) == [("a", 1, "Seed", "01/21", 3, None)]
