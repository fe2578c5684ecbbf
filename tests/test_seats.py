import datetime as dt

from pyspark.sql import functions as F

from turnstone.operators import seats


def test_block_price_and_paid_amount_are_split(frame):
    df = frame([(5, 4, 100.0, 80.0, 2)], "seat_num int, num_seats int, block_purchase_price double, paid_amount double, total_events int")
    out = seats.explode_blocks(df).orderBy("seat").collect()
    assert [r["seat"] for r in out] == [5, 6, 7, 8]
    assert {r["block_purchase_price"] for r in out} == {25.0} and {r["paid_amount"] for r in out} == {10.0}
    assert sum(r["block_purchase_price"] for r in out) == 100.0


def test_short_price_codes_leave_empty_characters(frame):
    df = frame([("A",), ("AF",), ("AFRU",), (None,)], "price_code string")
    got = [tuple(r) for r in seats.price_code_parts(df).select("pc_one", "pc_two", "pc_three", "pc_four", "pc_two_three").collect()]
    assert got == [("A", "", "", "", ""), ("A", "F", "", "", "F"), ("A", "F", "R", "U", "FR"), ("", "", "", "", "")]


SALE = (
    "price_code string, acct_rep_full_name string, acct_type_desc string, price_code_desc string, price_code_group string, row_name string, "
    "block_purchase_price double, percent_paid double, rep_department string, rep_sales_service string, tier string, add_date date, event_name string"
)


def sale(code, rep="House Rep", price=107.0, dept="Membership", desk="Service", tier="A", added=dt.date(2020, 1, 1), event="x", row="R1"):
    return (code, rep, "Individual", "Standard", "BASE", row, price, 1.0, dept, desk, tier, added, event)


def labelled(frame, *rows):
    df = seats.classified(frame(list(rows), SALE)).transform(seats.money)
    return seats.commissions(df).collect()


def test_ticket_types_by_rule_order(frame):
    got = labelled(frame, sale("AFRU"), sale("AFD"), sale("UFR"), sale("UI"), sale("YI"), sale("AG"), sale("AFR", rep="Trade Desk"), sale("AF", rep="Sponsor"), sale("AA"))
    assert [r["ticket_type"] for r in got] == [
        "Full", "Secondary", "Annual Suites", "Nightly Suites", "Nightly Suites", "Groups", "Trade", "Sponsor", "Unknown"]
    assert [r["is_upgrade"] for r in got[:3]] == [True, False, False]
    assert got[0]["is_renewal_and_upgrade_text"] == "Upgrade" and got[2]["is_renewal_and_upgrade_text"] == "Renewal"


def test_commission_last_rule_wins(frame):
    got = labelled(
        frame,
        sale("AFR", dept="Membership", desk="Service"),
        sale("AFR", dept="Premium", desk="Sales"),
        sale("AFRU", dept="Groups", desk="Service"),
        sale("XG", dept="Premium", tier="B"),
        sale("1F", dept="Premium", desk="Sales"),
        sale("YI", dept="Premium"),
    )
    assert [(r["commission_type"], round(r["commission_rate"], 4)) for r in got] == [
        ("Bowl Premier Plus Renewal", 0.014), ("Bowl Premier Plus Renewal", 0.1), ("Bowl Premier Plus Upgrade", 0.1),
        ("Hockey Premium Group", 0.1), ("Premium Sales Premier Plus New", 0.12), ("Hockey Nightly Stable - Premium", 0.1)]


def test_group_commission_doubles_in_the_window_only(frame):
    inside, outside = dt.date(2022, 10, 14), dt.date(2022, 10, 15)
    got = labelled(
        frame, sale("AG", tier="E", added=inside, event="22H1006E"), sale("AG", tier="E", added=outside, event="22H1006E"),
        sale("AG", tier="E", added=inside, event="22H1007E"))
    assert [round(r["commission_rate"], 4) for r in got] == [0.2, 0.1, 0.1]


def test_money(frame):
    got = labelled(frame, sale("ZI", price=132.0), sale("ZI", price=0.0), sale("AF", price=107.0))
    assert [r["food_fee"] for r in got] == [25, 0, 0]
    assert round(got[0]["net_revenue"], 6) == 100.0 and round(got[2]["total_tax"], 6) == 7.0
    counted = seats.seat_counts(seats.classified(frame([sale("AF"), sale("AF", price=0.0), sale("AI")], SALE))).collect()
    assert [(r["paid_seats"], r["comp_seats"]) for r in counted] == [(1, 0), (0, 1), (1, 0)]
    assert [round(r["fse_calc"] * 42, 6) for r in counted] == [1, 0, 0]


def test_parking_refund_and_standing_room(frame):
    df = frame([(10.0, 3, "J-TYPE"), (10.0, 3, "A-TYPE"), (10.0, 3, None)], "net double, n int, kind string")
    assert [r[0] for r in df.select(seats.parking_refund("net", "n", "kind")).collect()] == [25.0, 10.0, 10.0]
    rows = labelled(frame, sale("AF", row="GA1"), sale("AF", row="SRO"), sale("AF", row="R1"))
    assert [r["is_sro"] for r in rows] == [True, True, False]


def test_event_state(frame):
    df = frame([("22H1006E", dt.date(2022, 10, 6), dt.date(2022, 10, 1))], "event_name string, event_date date, add_date date")
    r = seats.event_state(df, "2022-10-06").first()
    assert (r["tier"], r["days_out_from_event"], r["is_game_over"]) == ("E", 5, False)
    assert seats.is_gameday(df, "2022-10-06").first()[0] is True
    assert seats.is_gameday(df.where(F.lit(False)), "2022-10-06").first()[0] is False
