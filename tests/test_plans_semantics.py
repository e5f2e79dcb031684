"""Results on hand-made rows where the figures are known."""

import pytest

from tests.helpers import D, rows, star
from tillscope.plans import advanced, inventory, kpi, metrics, products, sales, season, summary, tickets

YEAR = (D("2024-01-01"), D("2024-12-31"))
AS_OF = D("2024-06-30")


def test_daily_sales_need_the_calendar_but_quarter_form_does_not(spark):
    s = star(spark, [{}, {"sale_date": D("2025-03-01"), "ticket_id": "t2"}])
    assert rows(sales.daily_sales_by_chain(s, YEAR[0], D("2025-12-31")), "sale_date") == [D("2024-06-05")]
    assert rows(sales.daily_sales_by_chain_quarter(s, YEAR[0], D("2025-12-31")), "sale_date") == [
        D("2025-03-01"), D("2024-06-05")
    ]


def test_net_uses_discount_and_mean_is_per_line(spark):
    s = star(spark, [{"quantity": 3, "unit_price": 10, "discount_pct": 25}, {"unit_price": 7.5}])
    assert rows(sales.daily_sales_by_chain(s, *YEAR), "tickets", "units", "net_sales", "avg_line_value") == [
        (1, 4, pytest.approx(30), pytest.approx(15.0))
    ]


def ticket_weights(spark):
    lines = [{"ticket_id": "small", "unit_price": 10}] + [{"ticket_id": "big", "unit_price": 25}] * 4
    return star(spark, lines)


def test_items_per_ticket_are_line_weighted_by_default(spark):
    s = ticket_weights(spark)
    assert rows(tickets.weekly_ticket_by_format(s, *YEAR), "avg_items") == [pytest.approx(17 / 5)]
    assert rows(tickets.weekly_ticket_by_format(s, *YEAR, per_ticket=True), "avg_items") == [pytest.approx(5 / 2)]


def test_median_ticket_is_line_weighted_by_default(spark):
    s = ticket_weights(spark)
    assert rows(tickets.monthly_ticket_by_region(s, *YEAR), "median_ticket") == [pytest.approx(100)]
    assert rows(tickets.monthly_ticket_by_region(s, *YEAR, per_ticket=True), "median_ticket") == [pytest.approx(55)]


def test_ticket_lines_outside_the_range_count_unless_switched_off(spark):
    s = star(spark, [{}, {"sale_date": D("2023-12-31")}, {"sale_date": D("2023-12-31")}], first="2023-01-01")
    assert rows(tickets.weekly_ticket_by_format(s, *YEAR), "avg_items") == [3.0]
    assert rows(tickets.weekly_ticket_by_format(s, *YEAR, across_dates=False), "avg_items") == [1.0]


def test_tickets_without_id_are_left_out(spark):
    s = star(spark, [{}, {"ticket_id": None, "unit_price": 99}])
    assert rows(tickets.hourly_tickets(s, *YEAR), "hour", "tickets", "net_per_ticket") == [(10, 1, 10.0)]


def test_holiday_fan_out(spark):
    lines = [{"sale_date": D("2024-12-25"), "unit_price": 50}] + [
        {"sale_date": D(f"2024-06-0{d}"), "unit_price": p} for d, p in ((3, 10), (4, 20), (5, 30))
    ] + [{"sale_date": D("2024-06-08"), "unit_price": 1000}]  # a Saturday
    s = star(spark, lines)
    columns = ("holiday_name", "holiday_sales", "regular_mean", "lift_factor")
    assert rows(season.holiday_impact(s, 2024, 2024), *columns) == [("Navidad", 150.0, 20.0, 7.5)]
    assert rows(season.holiday_impact(s, 2024, 2024, corrected=True), *columns) == [("Navidad", 50.0, 20.0, 2.5)]


def test_holidays_without_regular_days_pair_with_nothing(spark):
    s = star(spark, [{"sale_date": D("2024-12-25")}])
    assert season.holiday_impact(s, 2024, 2024).count() == 0


def test_kpi_periods_share_a_day(spark):
    day = lambda n: {"sale_date": sales.days_before(AS_OF, n), "ticket_id": f"t{n}", "unit_price": 10 + n}
    s = star(spark, [day(0), day(30), day(31), day(60), day(61)])
    got = {r["kpi"]: r for r in kpi.sales_vs_previous(s, AS_OF).collect()}
    assert (got["Ventas Netas"]["current_value"], got["Ventas Netas"]["previous_value"]) == (50.0, 151.0)
    assert (got["Transacciones"]["current_value"], got["Transacciones"]["previous_value"]) == (2.0, 3.0)
    assert got["Ventas Netas"]["change_pct"] == pytest.approx(-66.89)


def test_kpi_without_base_is_null(spark):
    s = star(spark, [{"sale_date": AS_OF}])
    assert {r["change_pct"] for r in kpi.sales_vs_previous(s, AS_OF).collect()} == {None}


def test_store_may_be_best_and_worst(spark):
    s = star(spark, [{"sale_date": AS_OF}])
    assert rows(kpi.top_bottom_stores(s, AS_OF, min_days=1), "group") == ["TOP_5", "BOTTOM_5"]


def test_shares_sum_to_hundred(spark):
    s = star(spark, [{"sale_date": AS_OF, "channel": c, "unit_price": p}
                     for c, p in (("online", 1), ("mobile", 3), ("in-store", 7))])
    assert sum(rows(kpi.channel_performance(s, AS_OF), "share_pct")) == pytest.approx(100)


def alert_star(spark):
    pairs = {1: (0, [1]), 2: (100, []), 3: (7, [1] * 5), 4: (60, [1] * 5), 5: (6, [1] * 5), 6: (70, [1] * 5)}
    snapshots, lines = [], []
    for product, (stock, quantities) in pairs.items():
        snapshots.append({"inventory_id": product, "product_id": product, "final_stock": stock,
                          "snapshot_date": D("2024-06-28")})
        lines += [{"product_id": product, "quantity": q, "sale_date": sales.days_before(AS_OF, i)}
                  for i, q in enumerate(quantities)]
    # Five lines on one day: enough for the line rule, not for the day rule.
    snapshots.append({"inventory_id": 7, "product_id": 7, "final_stock": 5, "snapshot_date": D("2024-06-28")})
    lines += [{"product_id": 7, "sale_date": AS_OF}] * 5
    return star(spark, lines, snapshots, products=[{"product_id": i} for i in range(1, 8)])


def test_three_alert_definitions(spark):
    s = alert_star(spark)
    by_lines = dict(rows(inventory.stock_alerts(s, AS_OF), "product_id", "alert"))
    by_days = dict(rows(inventory.inventory_alerts_full(s, AS_OF), "product_id", "alert"))
    assert by_lines == {1: "SIN_STOCK", 2: "NORMAL", 3: "NORMAL", 4: "NORMAL", 5: "STOCK_BAJO", 6: "SOBRESTOCK",
                        7: "STOCK_BAJO"}
    assert by_days == {**by_lines, 2: "SOBRESTOCK"}
    supply = dict(rows(inventory.inventory_alerts_full(s, AS_OF), "product_id", "days_of_supply"))
    assert supply[2] is None and supply[7] is None and supply[3] == 7.0


def test_alert_summary_priority_and_critical_rows(spark):
    s = alert_star(spark)
    latest, recent = summary.build_latest_inventory(s, AS_OF), summary.build_recent_sales(s, AS_OF)
    alerts = summary.build_inventory_alerts(s, latest, recent)
    assert alerts.count() == latest.count()
    assert dict(rows(alerts, "product_id", "priority")) == {1: 1, 2: 3, 3: 4, 4: 4, 5: 2, 6: 3, 7: 2}
    assert rows(inventory.critical_alerts(alerts), "product_id")[0] == 1
    assert inventory.alerts_for_chain(alerts, "none").count() == 0


def test_latest_snapshot_outside_the_window(spark):
    s = star(spark, [], [{"inventory_id": i, "snapshot_date": D(d), "final_stock": i}
                         for i, d in ((1, "2024-01-01"), (3, "2024-03-01"), (2, "2024-02-01"))])
    assert summary.build_latest_inventory(s, AS_OF).count() == 0
    assert rows(inventory.inventory_alerts_full(s, AS_OF), "final_stock") == [3]


def test_turnover_weighs_snapshots_by_lines(spark):
    snaps = [{"final_stock": 10, "unit_cost": 2, "snapshot_date": D("2024-06-01")},
             {"final_stock": 40, "unit_cost": 2, "snapshot_date": D("2024-07-01"), "inventory_id": 2}]
    lines = [{"sale_date": D("2024-06-01"), "quantity": 1}] * 3 + [
        {"sale_date": D("2024-07-01"), "quantity": 5}, {"sale_date": D("2024-06-02"), "quantity": 100}]
    s = star(spark, lines, snaps)
    got = inventory.inventory_turnover(s, *YEAR).first()
    assert got["avg_inventory"] == pytest.approx((3 * 20 + 80) / 4)
    assert got["cost_of_sales"] == pytest.approx(16)
    assert got["turnover"] == pytest.approx(16 / 35)


def test_same_name_products(spark):
    two = [{"product_id": 1}, {"product_id": 2}]
    s = star(spark, [{"product_id": 1, "sale_date": AS_OF}, {"product_id": 2, "sale_date": AS_OF}], products=two)
    assert products.top_products(s, 2024, 2).count() == 2
    assert rows(products.top_products_by_region(s, AS_OF), "net_sales") == [20]


def test_basket_counts_product_pairs(spark):
    goods = [{"product_id": i, "product_name": f"p{i}", "category": "A" if i < 3 else "B"} for i in range(1, 6)]
    s = star(spark, [{"product_id": i, "unit_price": i} for i in range(1, 6)], products=goods)
    got = advanced.category_affinity(s, *YEAR, min_pairs=1)
    brute = [a + b for a in (1, 2) for b in (3, 4, 5)]
    assert rows(got, "category_a", "category_b", "co_occurrences", "avg_joint_value", "affinity_rank") == [
        ("A", "B", 6, pytest.approx(sum(brute) / 6), 1)
    ]


def test_basket_merges_products_of_one_name(spark):
    goods = [{"product_id": 1, "category": "A"}, {"product_id": 2, "category": "A"},
             {"product_id": 3, "category": "B", "product_name": "x"}]
    s = star(spark, [{"product_id": i} for i in (1, 2, 3)], products=goods)
    assert rows(advanced.category_affinity(s, *YEAR, min_pairs=1), "co_occurrences", "avg_joint_value") == [(1, 30.0)]


def test_trend_lag_counts_rows_not_weeks(spark):
    lines = [{"sale_date": D(d), "unit_price": p} for d, p in (("2024-01-03", 10), ("2024-01-24", 20))]
    got = advanced.weekly_trend(star(spark, lines), 2024, 2024, 2024)
    assert dict(rows(got, "iso_week", "week_growth_pct")) == {1: None, 4: 100.0}


def test_trend_windows_see_years_that_are_not_shown(spark):
    lines = [{"sale_date": D("2023-12-20"), "unit_price": 10}, {"sale_date": D("2024-01-10"), "unit_price": 15}]
    got = advanced.weekly_trend(star(spark, lines, first="2023-01-01"), 2023, 2024, 2024)
    assert rows(got, "week_growth_pct", "moving_avg_12") == [(50.0, 12.5)]


def test_elasticity(spark):
    lines = [{"sale_date": D("2024-01-10"), "unit_price": 10, "quantity": 100},
             {"sale_date": D("2024-02-10"), "unit_price": 11, "quantity": 80},
             {"sale_date": D("2024-03-10"), "unit_price": 11.2, "quantity": 80}]
    got = advanced.price_elasticity(star(spark, lines), *YEAR, min_stores=1)
    assert rows(got, "month", "elasticity") == [(D("2024-02-01"), -2.0)]


def test_cohort_retention(spark):
    shops = [{"store_id": i, "store_code": str(i)} for i in (1, 2)]
    lines = [{"store_id": 1, "sale_date": D("2024-01-10")}, {"store_id": 2, "sale_date": D("2024-01-10")},
             {"store_id": 1, "sale_date": D("2024-02-10")}]
    got = advanced.store_cohort(star(spark, lines, stores=shops), *YEAR)
    assert rows(got, "month", "active_stores", "retention_pct") == [
        (D("2024-01-01"), 2, None), (D("2024-02-01"), 1, 50.0)]


def test_segments_follow_label_order(spark):
    shops = [{"store_id": i, "store_code": str(i), "floor_area_m2": 100} for i in range(1, 9)]
    lines = [{"store_id": i, "unit_price": 10 * i, "ticket_id": f"t{i}"} for i in range(1, 9)]
    got = advanced.store_segments(star(spark, lines, stores=shops), *YEAR, min_days=1)
    assert sorted(rows(got, "segment", "stores")) == [
        ("AVERAGE", 2), ("PREMIUM", 2), ("STRONG", 2), ("UNDERPERFORMING", 2)]


def test_ranks_leave_gaps_after_ties(spark):
    shops = [{"store_id": i, "store_code": str(i)} for i in (1, 2, 3)]
    lines = [{"store_id": i, "unit_price": p} for i, p in ((1, 5), (2, 9), (3, 9))]
    got = sales.store_ranking(star(spark, lines, stores=shops), *YEAR)
    assert dict(rows(got, "store_id", "chain_rank")) == {1: 3, 2: 1, 3: 1}
    assert dict(rows(got, "store_id", "percentile")) == {1: 0.0, 2: 0.5, 3: 0.5}


def test_margin_takes_the_cost_known_on_the_day(spark):
    snaps = [{"inventory_id": 1, "snapshot_date": D("2024-02-01"), "unit_cost": 3},
             {"inventory_id": 2, "snapshot_date": D("2024-03-01"), "unit_cost": 5}]
    lines = [{"sale_date": D(d)} for d in ("2024-01-15", "2024-02-01", "2024-02-28", "2024-03-01")]
    got = metrics.margin(star(spark, lines, snaps), *YEAR)
    assert rows(got, "month", "cost", "margin", "uncosted_units") == [
        (D("2024-01-01"), None, None, 1), (D("2024-02-01"), 6, 14, 0), (D("2024-03-01"), 5, 5, 0)]


def test_daily_summary_adds_up_to_the_sales(spark):
    s = star(spark, [{"ticket_id": f"t{i}", "unit_price": i} for i in range(1, 6)])
    total = summary.build_daily_summary(s).groupBy().sum("net_sales", "tickets").first()
    assert (float(total[0]), total[1]) == (15.0, 5)


def test_store_mix_and_position(spark):
    shops = [{"store_id": i, "store_code": str(i)} for i in (1, 2)]
    lines = [{"store_id": 1, "channel": "online", "unit_price": 30}, {"store_id": 1, "unit_price": 10},
             {"store_id": 2, "unit_price": 20}]
    s = star(spark, lines, stores=shops)
    assert dict(rows(summary.build_store_performance(s), "store_id", "share_online_pct")) == {1: 75.0, 2: 0.0}
    assert dict(rows(metrics.store_vs_chain(s, *YEAR), "store_id", "position")) == {1: "above", 2: "below"}


def test_hot_ticket_forms_no_product_pairs(spark):
    """A ticket with 1500 products in each of two categories: 2.25 million pairs, counted not built."""
    n = 1500
    goods = [{"product_id": i, "sku": str(i), "product_name": f"p{i}", "category": "A" if i < n else "B"}
             for i in range(2 * n)]
    s = star(spark, [{"product_id": i, "unit_price": 1 if i < n else 3} for i in range(2 * n)], products=goods)
    got = advanced.category_affinity(s, *YEAR)
    assert rows(got, "co_occurrences", "avg_joint_value") == [(n * n, 4.0)]


def test_one_product_store_and_day_may_hold_most_lines(spark):
    """Figures of a skewed star against plain Python."""
    lines = [{"product_id": 1 if i % 3 else i % 7 + 2, "store_id": 1 if i % 3 else i % 4 + 1, "quantity": i % 5 + 1,
              "ticket_id": None if i % 3 == 1 else f"t{i % 50}", "sale_date": D("2024-06-05") if i % 3 else D("2024-06-06")}
             for i in range(3000)]
    shops = [{"store_id": i, "store_code": str(i), "chain": "ab"[i % 2]} for i in range(1, 5)]
    goods = [{"product_id": i, "sku": str(i), "product_name": f"p{i}"} for i in range(1, 9)]
    s = star(spark, lines, stores=shops, products=goods)
    want = {}
    for line in lines:
        key = (line["sale_date"], "ab"[line["store_id"] % 2])
        tickets_, units = want.setdefault(key, (set(), [0]))
        units[0] += line["quantity"]
        if line["ticket_id"]:
            tickets_.add(line["ticket_id"])
    got = sales.daily_sales_by_chain(s, *YEAR).collect()
    assert {(r["sale_date"], r["chain"]): (r["tickets"], r["units"]) for r in got} == {
        k: (len(t), u[0]) for k, (t, u) in want.items()}
    numbered = rows(products.regional_ranking(s, D("2024-06-30"), min_net=0), "product_id", "region_rank")
    units = {p: sum(x["quantity"] for x in lines if x["product_id"] == p) for p in range(1, 9)}
    assert numbered == [(p, i + 1) for i, p in enumerate(sorted(units, key=lambda p: (-units[p], p))) if units[p]]
