"""Reservation fold, stock joins and the as-of join."""

import pandas as pd
from helpers import at, multiset, orders_df

from pyspark.sql import functions as F

from orderflow.operators import inventory
from orderflow.sources import fixtures as fx
from conftest import SF01


def _rows(spark, stock, quantities, product="P"):
    o = orders_df(spark, [(f"o{i}", 1, product, q, 1.0, i, i) for i, q in enumerate(quantities)])
    inv = spark.createDataFrame([(product, stock)], "product string, stock int")
    return inventory.join_stock(o, inv)


def test_greedy_fold_lets_smaller_order_through(spark):
    # stock 10; quantities 7, 5, 3, 1 -> PASS, FAIL, PASS, FAIL; reserved 10
    out = inventory.reserve_stock(_rows(spark, 10, [7, 5, 3, 1]), materialize_input=False)
    got = {r["id"]: (r["validationResult"], r["reserved"]) for r in out.collect()}
    assert got == {"o0": ("PASS", 7), "o1": ("FAIL", 7), "o2": ("PASS", 10), "o3": ("FAIL", 10)}


def test_product_without_stock_gets_no_verdict(spark):
    o = orders_df(spark, [("x", 1, "STOCKINGS", 1, 1.0, 0, 1)])
    inv = spark.createDataFrame([("JUMPERS", 10)], "product string, stock int")
    assert inventory.join_stock(o, inv).count() == 0


def test_all_pass_shortcut_equals_fold(spark):
    out = inventory.reserve_stock(_rows(spark, 100, [7, 5, 3, 1]), materialize_input=False)
    got = sorted((r["id"], r["validationResult"], r["reserved"]) for r in out.collect())
    assert got == [("o0", "PASS", 7), ("o1", "PASS", 12), ("o2", "PASS", 15), ("o3", "PASS", 16)]


def _brute(pdf):
    out = []
    for _, g in pdf.sort_values(["product", "ts", "seq"]).groupby("product"):
        r = 0
        for row in g.itertuples():
            ok = row.stock - r - row.quantity >= 0
            r += row.quantity if ok else 0
            out.append((row.id, row.seq, row.quantity, "PASS" if ok else "FAIL", r))
    return sorted(out)


def test_hot_key_segmented_fold_equals_sequential(spark):
    rows = inventory.asof_join(fx.orders(spark, SF01).where("customerId < 40"),
                               fx.inventory_changes(spark, SF01), "product")
    expect = _brute(rows.toPandas())
    for hot in (10 ** 9, 50):  # every key sequential / every key split into day segments
        out = inventory.reserve_stock(rows, hot_rows=hot, split="1 day")
        got = sorted((r["id"], r["seq"], r["quantity"], r["validationResult"], r["reserved"])
                     for r in out.collect())
        assert got == expect


def test_asof_join_matches_merge_asof_for_any_bucket_width(spark):
    o = fx.orders(spark, SF01)
    inv = fx.inventory_changes(spark, SF01)
    op = o.toPandas().sort_values("ts")
    ip = inv.toPandas().sort_values("ts")
    exp = pd.merge_asof(op, ip[["product", "stock", "ts"]], on="ts", by="product",
                        direction="backward").dropna(subset=["stock"])
    exp = sorted(zip(exp["id"], exp["stock"].astype(int)))
    for split in ("1 hour", "1 day", "30 days"):
        got = inventory.asof_join(o, inv, "product", split=split)
        assert sorted((r["id"], r["stock"]) for r in got.collect()) == exp


def test_asof_ties_resolve_to_latest_seq_and_include_equal_time(spark):
    left = spark.createDataFrame([("o1", "P", at(10), 5)], "id string, product string, ts timestamp, seq long")
    right = spark.createDataFrame([("P", 1, at(10), 1), ("P", 2, at(10), 2), ("P", 3, at(11), 3)],
                                  "product string, stock int, ts timestamp, seq long")
    got = inventory.asof_join(left, right, "product").collect()
    assert [(r["id"], r["stock"]) for r in got] == [("o1", 2)]


def test_asof_left_keeps_unmatched(spark):
    left = spark.createDataFrame([("o1", "P", at(0), 1), ("o2", "Q", at(5), 2)],
                                 "id string, product string, ts timestamp, seq long")
    right = spark.createDataFrame([("P", 4, at(1), 1)], "product string, stock int, ts timestamp, seq long")
    got = multiset(inventory.asof_join(left, right, "product", how="left").select("id", "stock"))
    assert got == [("o1", None), ("o2", None)]
    assert inventory.asof_join(left, right, "product").count() == 0


def test_line_fold_reserves_expected_units(spark):
    rows = inventory.join_stock(fx.line_orders(spark, SF01), fx.part_inventory(spark, SF01))
    out = inventory.reserve_stock(rows)
    reserved = out.where("validationResult = 'PASS'").agg(F.sum("quantity")).collect()[0][0]
    assert reserved == 933928


def test_negative_quantity_frees_stock_in_sequential_path(spark):
    # stock 10; quantities -3, 12, 2 -> PASS (reserved -3), PASS (9), FAIL (9)
    out = inventory.reserve_stock(_rows(spark, 10, [-3, 12, 2]), hot_rows=0, materialize_input=False)
    got = {r["id"]: (r["validationResult"], r["reserved"]) for r in out.collect()}
    assert got == {"o0": ("PASS", -3), "o1": ("PASS", 9), "o2": ("FAIL", 9)}


def test_running_reservation_has_no_gap(spark):
    from datetime import datetime
    rows = spark.createDataFrame([("a", "P", 7, datetime(1900, 1, 1), 1, 100), ("b", "P", 5, datetime(2024, 1, 1), 2, 100)],
                                 "id string, product string, quantity int, ts timestamp, seq long, stock int")
    for hot in (10 ** 9, 0):
        got = {r["id"]: r["reserved"] for r in inventory.reserve_stock(rows, hot_rows=hot).collect()}
        assert got == {"a": 7, "b": 12}


def test_hot_key_segments_with_negative_quantity_large_stock_and_one_date(spark):
    import random
    rnd = random.Random(4)
    for stock, low, one_date in ((2_000_000, 1, False), (3000, -20, False), (3000, 1, True)):
        data = [(f"o{i}", "P", rnd.randint(low, 5000 if stock > 10 ** 6 else 50), at(0 if one_date else i), i, stock)
                for i in range(3000)]
        rows = spark.createDataFrame(data, "id string, product string, quantity int, ts timestamp, seq long, stock int")
        exp, r = {}, 0
        for id_, _, q, _, _, s in data:
            ok = s - r - q >= 0
            r += q if ok else 0
            exp[id_] = ("PASS" if ok else "FAIL", r)
        out = inventory.reserve_stock(rows, hot_rows=300)
        assert {x["id"]: (x["validationResult"], x["reserved"]) for x in out.collect()} == exp


def _greedy(data):
    out, r = {}, {}
    for id_, p, q, _, _, s in data:
        ok = s is not None and s - r.get(p, 0) - (q or 0) >= 0
        r[p] = r.get(p, 0) + ((q or 0) if ok else 0)
        out[id_] = ("PASS" if ok else "FAIL", r[p])
    return out


ROW = "id string, product string, quantity int, ts timestamp, seq long, stock int"


def test_hot_contended_keys_with_wide_stock_are_split_and_equal_the_sequential_fold(spark, monkeypatch):
    import random
    rnd = random.Random(11)
    data = []
    for p, stock, draw in (
            ("big", 10 ** 9, lambda i: rnd.randint(1, 2_000_000)),          # contended half way
            ("powers", 10 ** 9, lambda i: 2 ** rnd.randint(0, 29)),          # starts never meet early
            ("tens", 10 ** 9 + 3, lambda i: 10 * rnd.randint(1, 10 ** 5)),   # never quite full
            ("frees", 10 ** 9, lambda i: rnd.choice([-3_000_000, 900_000, 2_500_000, 10 ** 9])),
            ("nulls", 10 ** 6, lambda i: rnd.choice([None, 0, 900, 1500]))):
        data += [(f"{p}{i}", p, draw(i), at(i), i, stock if p != "nulls" or i % 50 else None) for i in range(4000)]
    # stock that moves up and down under the orders
    data += [(f"moves{i}", "moves", rnd.randint(0, 40_000), at(i), i, 10 ** 7 + 10 ** 6 * (i // 37 % 9)) for i in range(4000)]
    rows = spark.createDataFrame(data, ROW)
    rounds = []
    real = inventory.materialize
    monkeypatch.setattr(inventory, "materialize", lambda df, name: rounds.append(name) or real(df, name))
    out = inventory.reserve_stock(rows, hot_rows=250)
    assert {x["id"]: (x["validationResult"], x["reserved"]) for x in out.collect()} == _greedy(data)
    assert rounds.count("fold-starts") <= 8  # 16 segments a key, not one round for each


def test_no_hot_key_writes_nothing(spark, monkeypatch):
    wrote = []
    monkeypatch.setattr(inventory, "materialize", lambda df, name: wrote.append(name) or df)
    assert inventory.reserve_stock(_rows(spark, 10, [7, 5, 3, 1])).count() == 4 and not wrote


def test_newest_stock_row_holds(spark):
    o = orders_df(spark, [("x", 1, "JUMPERS", 1, 1.0, 0, 1)])
    inv = spark.createDataFrame([("JUMPERS", 10, 1), ("JUMPERS", 3, 2)], "product string, stock int, seq long")
    assert [r["stock"] for r in inventory.join_stock(o, inv).collect()] == [3]


def test_asof_join_with_hot_keys_equals_plain(spark):
    o, inv = fx.orders(spark, SF01), fx.inventory_changes(spark, SF01)
    a = inventory.asof_join(o, inv, "product", target_rows=500)
    b = inventory.asof_join(o, inv, "product")
    assert multiset(a.select("id", "stock")) == multiset(b.select("id", "stock"))
