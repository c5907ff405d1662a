"""Verdict aggregation: pass counts, VALIDATED and FAILED join-backs."""

from helpers import at, orders_df, validations_df

from orderflow.operators import verdicts


def _order(spark):
    return orders_df(spark, [("1", 5, "JUMPERS", 1, 1.0, 0, 1)])


def test_three_passes_of_one_type_validate_by_default(spark):
    v = validations_df(spark, [("1", "FRAUD_CHECK", "PASS", 1, 1), ("1", "FRAUD_CHECK", "PASS", 2, 2),
                               ("1", "FRAUD_CHECK", "PASS", 3, 3)])
    ok = verdicts.orders_validated(verdicts.pass_counts(v), _order(spark))
    assert [(r["id"], r["state"]) for r in ok.collect()] == [("1", "VALIDATED")]
    strict = verdicts.orders_validated(verdicts.pass_counts(v, distinct_checks=True), _order(spark))
    assert strict.count() == 0


def test_pass_count_session_and_reach_time(spark):
    v = validations_df(spark, [("1", "ORDER_DETAILS_CHECK", "PASS", 1, 1),
                               ("1", "FRAUD_CHECK", "FAIL", 2, 2),
                               ("1", "INVENTORY_CHECK", "PASS", 200, 3),
                               ("1", "FRAUD_CHECK", "PASS", 400, 4),
                               ("1", "FRAUD_CHECK", "PASS", 1000, 5)])
    rows = sorted(verdicts.pass_counts(v).collect(), key=lambda r: r["session_start"])
    assert [(r["verdicts"], r["passes"]) for r in rows] == [(4, 3), (1, 1)]
    assert rows[0]["reach_ts"] == at(400) and rows[0]["session_end"] == at(400)
    assert rows[1]["reach_ts"] is None


def test_validated_needs_an_emission_within_the_join_window(spark):
    # the order is at 0; PASS count reaches 3 at 400 s (> 5 min later): no emission is
    # within 5 minutes of the order, so no VALIDATED
    v = validations_df(spark, [("1", "ORDER_DETAILS_CHECK", "PASS", 100, 1),
                               ("1", "FRAUD_CHECK", "PASS", 250, 2),
                               ("1", "INVENTORY_CHECK", "PASS", 400, 3)])
    assert verdicts.orders_validated(verdicts.pass_counts(v), _order(spark)).count() == 0
    v2 = validations_df(spark, [("1", "ORDER_DETAILS_CHECK", "PASS", 100, 1),
                                ("1", "FRAUD_CHECK", "PASS", 250, 2),
                                ("1", "INVENTORY_CHECK", "PASS", 300, 3)])
    assert verdicts.orders_validated(verdicts.pass_counts(v2), _order(spark)).count() == 1


def test_two_fails_give_one_failed_order(spark):
    v = validations_df(spark, [("1", "FRAUD_CHECK", "FAIL", 1, 1), ("1", "INVENTORY_CHECK", "FAIL", 2, 2),
                               ("1", "ORDER_DETAILS_CHECK", "PASS", 3, 3)])
    bad = verdicts.orders_failed(v, _order(spark)).collect()
    assert [(r["id"], r["state"], r["customerId"]) for r in bad] == [("1", "FAILED", 5)]


def test_fail_outside_window_is_ignored(spark):
    v = validations_df(spark, [("1", "FRAUD_CHECK", "FAIL", 301, 1)])
    assert verdicts.orders_failed(v, _order(spark)).count() == 0
    v = validations_df(spark, [("1", "FRAUD_CHECK", "FAIL", 300, 1)])
    assert verdicts.orders_failed(v, _order(spark)).count() == 1


def test_only_created_orders_join_back(spark):
    o = orders_df(spark, [("1", 5, "JUMPERS", 1, 1.0, 0, 1, "VALIDATED")])
    v = validations_df(spark, [("1", "FRAUD_CHECK", "FAIL", 1, 1)])
    assert verdicts.orders_failed(v, o).count() == 0
