"""A shop's CSV exports through every layer, against the same steps done by hand."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
import yaml

from terrane import run
from terrane.plans.layers import run_scoring
from terrane.plans.spec import parse_spec
from terrane.sources.tables import read_table

SPEC = """
pipeline_name: shop
version: "1"
bronze_tables:
  - {{name: orders, landing_path: "{root}/in", file_pattern: "orders*.csv", file_format: csv,
      target_delta_path: "{root}/bronze/orders", options: {{header: "true", inferSchema: "true"}}}}
  - {{name: lines, landing_path: "{root}/in", file_pattern: "lines.csv", file_format: csv,
      target_delta_path: "{root}/bronze/lines", options: {{header: "true", inferSchema: "true"}}}}
  - {{name: buyers, landing_path: "{root}/in", file_pattern: "buyers.csv", file_format: csv,
      target_delta_path: "{root}/bronze/buyers", options: {{header: true, inferSchema: true}}}}
silver:
  source_delta_path: "{root}/bronze/orders"
  target_delta_path: "{root}/silver/orders"
  quarantine_delta_path: "{root}/quarantine/orders"
  drop_duplicates: [order_id]
  validation_rules:
    - {{name: on_its_way, expr: "state IS NOT NULL AND state IN ('arrived', 'sent')"}}
    - {{name: not_early, expr: "arrived_at IS NULL OR arrived_at >= placed_at"}}
gold:
  primary_table: "{root}/silver/orders"
  target_delta_path: "{root}/gold/delays"
  joins:
    - table: "{root}/bronze/lines"
      on: [order_id]
      type: inner
    - table: "{root}/bronze/buyers"
      on: [buyer_id]
  select_expressions:
    - order_id
    - line
    - region
    - price
    - weight
    - datediff(arrived_at, promised_at) AS actual_delay_days
ml_stage:
  categorical_features: [region]
  numeric_features: [price, weight]
  hyperparameters: {{maxIter: 2, maxDepth: 2}}
  split_keys: [order_id, line]
maintenance: {{enabled: false}}
mlflow: {{experiment_name: shop}}
"""


def day(n: int) -> str:
    return str(dt.datetime(2024, 1, 1) + dt.timedelta(days=n))


@pytest.fixture(scope="module")
def shop(tmp_path_factory):
    root = tmp_path_factory.mktemp("shop")
    (root / "in").mkdir()
    rng = random.Random(5)
    orders = pd.DataFrame(
        {
            "order_id": [f"o{i}" for i in range(300)],
            "buyer_id": [f"b{rng.randrange(40)}" for _ in range(300)],
            "state": [rng.choice(["arrived", "sent", "void", None]) for _ in range(300)],
            "placed_at": [day(10 + i % 20) for i in range(300)],
            "arrived_at": [
                rng.choice([None, day(9 + i % 20), day(14 + i % 25)]) for i in range(300)
            ],
            "promised_at": [day(15 + i % 20) for i in range(300)],
        }
    )
    lines = pd.DataFrame(
        [
            {
                "order_id": f"o{rng.randrange(320)}",
                "line": i,
                "price": round(rng.random() * 90, 2),
                "weight": None if i % 11 == 0 else float(rng.randrange(500)),
            }
            for i in range(700)
        ]
    )
    buyers = pd.DataFrame({"buyer_id": [f"b{i}" for i in range(35)]})
    buyers["region"] = [["north", "south, east", "west"][i % 3] for i in range(35)]
    orders[:200].to_csv(root / "in" / "orders_a.csv", index=False)
    orders[180:].to_csv(root / "in" / "orders_b.csv", index=False)
    lines.to_csv(root / "in" / "lines.csv", index=False)
    buyers.to_csv(root / "in" / "buyers.csv", index=False, encoding="utf-8-sig")
    return root, orders, lines, buyers


def test_every_layer_matches_the_same_steps_by_hand(spark, shop):
    root, orders, lines, buyers = shop
    spec = parse_spec(yaml.safe_load(SPEC.format(root=root)))
    report = run(spark, spec)

    late = orders.arrived_at.isna() | (orders.arrived_at >= orders.placed_at)
    good = orders.state.isin(["arrived", "sent"]) & late
    assert report["bronze_record_count"] == 320 + 700 + 35
    assert report["dropped_record_count"] == 20
    assert report["silver_record_count"] == good.sum()
    assert report["quarantine_record_count"] == (~good).sum()

    rejected = read_table(spark, f"{root}/quarantine/orders").toPandas()
    for row in rejected.to_dict("records"):
        source = orders[orders.order_id == row["order_id"]].iloc[0]
        expected = []
        if source.state not in ("arrived", "sent"):
            expected.append("on_its_way")
        if source.arrived_at and source.arrived_at < source.placed_at:
            expected.append("not_early")
        assert list(row["_failed_rules"]) == expected

    gold = orders[good].merge(lines, on="order_id").merge(buyers, on="buyer_id", how="left")
    delay = (pd.to_datetime(gold.arrived_at) - pd.to_datetime(gold.promised_at)).dt.days
    got = read_table(spark, f"{root}/gold/delays").toPandas().set_index("line").sort_index()
    want = gold.assign(delay=delay).set_index("line").sort_index()
    assert report["gold_record_count"] == len(want) == len(got)
    assert got.actual_delay_days.astype("float").equals(want.delay.astype("float"))
    assert got.region.fillna("?").tolist() == want.region.fillna("?").tolist()
    assert got.weight.equals(want.weight)

    assert set(report["ml_metrics"]) == {"rmse", "mae", "r2"}
    assert report["maintenance"] == {"status": "SKIPPED"}
    scored = run_scoring(spark, spec, f"{root}/gold/delays", f"{root}/scores", ["order_id", "line"])
    # An absent region has a bucket of its own; an absent weight cannot be scored.
    assert scored == want.weight.notna().sum()
