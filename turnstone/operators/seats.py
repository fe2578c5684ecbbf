"""Plan blocks to seats: price codes, places, accounts, ticket types, money.

Each step is ``DataFrame -> DataFrame`` and adds columns only, so steps chain
with ``DataFrame.transform`` and collapse into one projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.functions import fixed_values as fixed
from turnstone.functions.rules import apply_rules
from turnstone.functions.scalars import label_of, last_match, lookup, seat_key


def explode_blocks(df: DataFrame) -> DataFrame:
    """One row per seat; the block price is split by seats, the paid amount by events and seats."""
    n = F.col("num_seats")
    seats = F.sequence(F.col("seat_num"), F.col("seat_num") + n - 1)
    money = {"block_purchase_price": F.col("block_purchase_price") / n} if "block_purchase_price" in df.columns else {}
    if "paid_amount" in df.columns:
        money["paid_amount"] = F.col("paid_amount") / F.col("total_events") / n
    if "original_block_purchase_price" in df.columns:
        money["original_block_purchase_price"] = F.col("original_block_purchase_price") / n
    return df.where(n > 0).withColumns(money).withColumn("seat", F.explode(seats))


def price_code_parts(df: DataFrame) -> DataFrame:
    """The four characters of a price code and its slices; missing characters are ''."""
    def piece(start: int, length: int) -> Column:
        return F.coalesce(F.substring("price_code", start, length), F.lit(""))

    return df.withColumns({
        "pc_one": piece(1, 1), "pc_two": piece(2, 1), "pc_three": piece(3, 1), "pc_four": piece(4, 1),
        "pc_one_two": piece(1, 2), "pc_two_three": piece(2, 2), "pc_three_four": piece(3, 2),
        "pc_two_three_four": piece(2, 3),
    })


PLACES = {
    "location_general": fixed.LOCATION_GENERAL,
    "location_specific": fixed.LOCATION_SPECIFIC,
    "location_events": fixed.LOCATION_EVENTS,
    "location_events_general": fixed.LOCATION_EVENTS_GENERAL,
    "arena_level": fixed.ARENA_LEVEL,
    "arena_level_internal": fixed.ARENA_LEVEL_INTERNAL,
}


def places(df: DataFrame) -> DataFrame:
    """All place labels of the first price-code character, 'Other' where unlisted: one look-up in a constant map."""
    other = dict.fromkeys(PLACES, "Other")
    table: dict[str, dict[str, str]] = {}
    for name, groups in PLACES.items():
        for label, codes in groups.items():  # the label stated last wins
            for code in codes:
                table.setdefault(code, dict(other))[name] = label
    rows = {code: F.array(*[F.lit(x) for x in row.values()]) for code, row in table.items()}
    found = F.try_element_at(F.create_map(*[x for code, row in rows.items() for x in (F.lit(code), row)]), F.col("pc_one"))
    df = df.withColumn("_places", F.coalesce(found, F.array(*[F.lit("Other")] * len(PLACES))))
    labels = {name: F.get("_places", F.lit(i)) for i, name in enumerate(PLACES)}
    general = labels["location_general"]
    labels["hrr_location"] = F.when(general == "General", "Bowl").otherwise(general)
    return df.withColumns(labels).drop("_places")


def premium(df: DataFrame) -> DataFrame:
    flag = F.col("pc_one").isin(fixed.PREMIUM_CODES)
    return df.withColumns({"is_premium": flag, "is_premium_text": F.when(flag, "Premium").otherwise("General")})


def accounts(df: DataFrame) -> DataFrame:
    """Resale, sponsor and trade flags, the account type built on them, and the account groups."""
    suites = F.col("pc_one").isin("U", "V", "W")
    rep = F.coalesce("acct_rep_full_name", F.lit(""))
    flagged = df.withColumns({
        "is_logitix": F.col("pc_two_three").isin("FD", "GD") & ~suites,
        "is_logitix_playoffs": (F.col("pc_four") == "L") | (F.col("pc_two_three") == "GL"),
        "is_sponsor": rep == "Sponsor",
        "is_trade": rep.contains("Trade"),
    })
    description = F.coalesce("acct_type_desc", F.lit(""))
    corporate = F.lit(False)
    for word in fixed.CORPORATE_WORDS:
        corporate = corporate | description.contains(word)
    return flagged.withColumns({
        "account_type": last_match(
            [(F.col("is_logitix"), "Broker"), (F.col("is_sponsor") | F.col("is_trade"), "Sponsor")], "Standard"),
        "acct_type_desc_group": F.when(corporate, "Corporate").otherwise("Personal"),
        "hrr_account_type": label_of(description, fixed.ACCOUNT_TRADE_LABELS, "Standard"),
    })


def plan_types(df: DataFrame) -> DataFrame:
    return df.withColumn("plan_type", label_of("pc_two", fixed.PLAN_TYPE, "Unknown"))


def flags(df: DataFrame) -> DataFrame:
    """Renewal, upgrade, host, all-inclusive and standing-room flags."""
    renewal = (F.col("pc_three") == "R") & (F.col("pc_two_three") != "GR")
    upgrade = (F.col("pc_three_four") == "RU") & (F.col("location_general") != "Suites")
    text = F.when(renewal, "Renewal").otherwise("New Business")
    inclusive = F.lower(F.coalesce("price_code_desc", F.lit(""))).contains("inclusive") | (
        F.coalesce("price_code_group", F.lit("")) == "AI")
    row = F.coalesce("row_name", F.lit(""))
    return df.withColumns({
        "is_renewal": renewal,
        "is_renewal_text": text,
        "is_upgrade": upgrade,
        "is_renewal_and_upgrade_text": F.when(upgrade, "Upgrade").otherwise(text),
        "is_host": F.col("pc_two") == "*",
        "is_all_inclusive": inclusive,
        "is_sro": row.contains("GA") | row.contains("SRO"),
    })


# Ticket type and the facts a sale must have; the last rule that fits stays.
TICKET_TYPES = [
    ("Full", ["full", "standard", "not suites", "not trade"]),
    ("Flex", ["flex", "standard", "not suites", "not trade"]),
    ("Premier", ["premier", "standard", "not suites", "not trade"]),
    ("Annual Suites", ["full or premier", "suites", "not trade"]),
    ("Sponsor", ["full, flex or premier", "sponsor", "not suites", "not trade"]),
    ("Trade", ["trade"]),
    ("Groups", ["groups", "not broker", "not suites", "not trade"]),
    ("Singles", ["singles", "not broker", "not suites", "not trade"]),
    ("Nightly Suites", ["by game", "not broker", "suites", "not trade"]),
    ("Nightly Suites", ["by game", "not broker", "stable", "not trade"]),
    ("Secondary", ["not trade", "broker"]),
]
PLAYOFF_TYPES = [
    ("Renewal Strips", ["full", "renewal", "not add-on"]),
    ("Add-on Strips", ["full", "renewal", "add-on"]),
    ("New Business Strips", ["full", "not renewal"]),
    ("Secondary", ["broker"]),
    ("Singles", ["single code"]),
]
FOOD_PLAN_TYPES = [("All-Inclusive", ["inclusive"]), ("Groups", ["groups"]), ("Singles", ["singles"])]


def ticket_types(df: DataFrame) -> DataFrame:
    """Ticket type, playoff type and food-plan type; later rules overwrite earlier ones."""
    plan, trade = F.col("plan_type"), F.col("is_trade")
    sponsor = F.col("is_sponsor") | trade
    facts = {
        "full": plan == "Full", "flex": plan == "Flex", "premier": plan == "Premier", "groups": plan == "Groups",
        "singles": plan == "Singles", "full or premier": (plan == "Full") | (plan == "Premier"),
        "full, flex or premier": (plan == "Full") | (plan == "Flex") | (plan == "Premier"),
        "by game": (plan == "Singles") | (plan == "Groups") | (plan == "Flex"),
        "sponsor": sponsor, "broker": F.col("is_logitix") & ~sponsor, "standard": ~F.col("is_logitix") & ~sponsor,
        "suites": F.col("location_general") == "Suites", "trade": trade, "stable": F.col("pc_one_two") == "YI",
        "renewal": F.col("is_renewal"), "add-on": F.col("pc_four") == "A", "single code": F.col("pc_two").isin("*", "I"),
        "inclusive": F.col("is_all_inclusive"),
    }
    return apply_rules(
        df, facts, {"type": TICKET_TYPES, "playoffs": PLAYOFF_TYPES, "food": FOOD_PLAN_TYPES},
        {"type": [("ticket_type", "Unknown")], "playoffs": [("ticket_type_playoffs", "Unknown")], "food": [("hrr_plan_type", "Plans")]})


def seat_counts(df: DataFrame) -> DataFrame:
    """Comp, paid and total seats of an exploded seat, and its full-season equivalents."""
    comp = F.col("block_purchase_price") == 0
    counted = df.withColumns({
        "is_comp": comp, "paid_seats": (~comp).cast("int"), "comp_seats": comp.cast("int"), "total_seats": F.lit(1)})
    by_game = F.col("ticket_type").isin("Singles", "Nightly Suites", "Groups", "Flex")
    held = ~by_game & (F.col("pc_two_three") != "GD") & ~comp
    return counted.withColumn("fse_calc", F.when(held, F.lit(1 / fixed.GAMES_PER_SEASON)).otherwise(F.lit(0.0)))


def plan_equivalents(event: str, full: str, premier: str) -> Column:
    """Full-season equivalents of a paid plan seat by its plan event."""
    return F.when(F.col("is_comp"), 0.0).when(F.col(event) == full, 1.0).when(
        F.col(event) == premier, fixed.PREMIER_GAMES / fixed.GAMES_PER_SEASON).otherwise(0.0)


def money(df: DataFrame) -> DataFrame:
    """Food fee, revenue without food, the four net-revenue variants, tax and commission base."""
    comp = F.col("block_purchase_price") == 0
    fee = F.when(comp, 0).otherwise(lookup("pc_one", fixed.FOOD_FEE, 0))
    event_fee = F.when(comp | (F.col("pc_three") == "N"), 0).otherwise(lookup("pc_one", fixed.FOOD_FEE_EVENTS, 0))
    with_fee = df.withColumns({"food_fee": fee, "event_food_fee": event_fee})
    with_gross = with_fee.withColumn("gross_without_food", F.col("block_purchase_price") - F.col("food_fee"))
    net = F.col("gross_without_food") / fixed.TAX_DIVISOR
    out = {
        "net_revenue": net,
        "net_revenue_resale": (F.col("block_purchase_price") * fixed.RESALE_SHARE - F.col("food_fee")) / fixed.TAX_DIVISOR,
        "total_tax": net * fixed.TAX_DIVISOR - net,
        "commissionable_amount": net * F.col("percent_paid"),
    }
    if {"pc_ticket", "pc_licfee", "surchg_amount"} <= set(df.columns):
        parts = F.col("pc_ticket") + F.col("pc_licfee") + F.col("surchg_amount")
        out["net_revenue_2223"] = F.when(F.col("is_host"), net).otherwise(parts / fixed.TAX_DIVISOR)
        out["net_revenue_2324"] = F.when(F.col("is_host"), net).otherwise(parts)
    return with_gross.withColumns(out)


def parking_refund(net: str, seats: str, kind: str) -> Column:
    """Net parking revenue with the per-seat refund added for the refunded types."""
    refund = F.when(F.col(kind).isin(fixed.PARKING_REFUND_TYPES), F.col(seats) * fixed.PARKING_REFUND_PER_SEAT)
    return F.col(net) + F.coalesce(refund, F.lit(0))


# --- commissions ---------------------------------------------------------------------
# Label, rate and the facts a sale must have ("not" marks facts it
# must lack).  Rules apply in order and the last one that fits stays.
HOCKEY_COMMISSIONS = [
    ("Bowl Premier Plus New", 0.1, ["full", "not renewal", "not lounge", "not suites"]),
    ("Bowl Premier New", 0.1, ["premier", "not renewal", "not lounge", "not suites"]),
    ("Lounge 954 Premier Plus New", 0.1, ["full", "not renewal", "lounge"]),
    ("Lounge 954 Premier New", 0.1, ["premier", "not renewal", "lounge"]),
    ("Premium Sales Premier Plus New", 0.12, ["full", "not renewal", "premium seat", "premium desk", "sales"]),
    ("Premium Sales Premier New", 0.12, ["premier", "not renewal", "premium seat", "premium desk", "sales"]),
    ("Bowl Premier Plus Renewal", 0.014, ["full", "renewal", "not lounge", "membership desk", "service", "not suites"]),
    ("Bowl Premier Renewal", 0.014, ["premier", "renewal", "not lounge", "membership desk", "service", "not suites"]),
    ("Bowl Premier Plus Renewal", 0.01, ["full", "renewal", "not lounge", "premium desk", "service", "not suites"]),
    ("Bowl Premier Renewal", 0.01, ["premier", "renewal", "not lounge", "premium desk", "service", "not suites"]),
    ("Bowl Premier Plus Renewal", 0.1, ["full", "renewal", "not lounge", "sales", "not suites"]),
    ("Bowl Premier Renewal", 0.1, ["premier", "renewal", "not lounge", "sales", "not suites"]),
    ("Lounge 954 Premier Plus Renewal", 0.01, ["full", "renewal", "lounge"]),
    ("Lounge 954 Premier Renewal", 0.01, ["premier", "renewal", "lounge"]),
    ("Bowl Premier Plus Upgrade", 0.05, ["full", "upgrade", "service"]),
    ("Bowl Premier Plus Upgrade", 0.1, ["full", "upgrade", "upgrade desk"]),
    ("Hockey D, E Tier Group", 0.1, ["groups", "tier D or E"]),
    ("Hockey B, C Tier Group", 0.06, ["groups", "tier B or C"]),
    ("Hockey B, C Tier Group - Premium", 0.04, ["groups", "tier B or C", "premium desk"]),
    ("Hockey A Tier Group", 0.04, ["groups", "tier A"]),
    ("Hockey Premium Group", 0.1, ["groups", "premium group seat", "premium desk"]),
    ("Flex", 0.04, ["flex", "not suites"]),
    ("Hockey Nightly Suites - Premium", 0.1, ["nightly suites", "premium desk"]),
    ("Hockey Nightly Suites", 0.05, ["nightly suites", "not premium desk"]),
    ("Hockey Nightly Stable - Premium", 0.1, ["stable", "premium desk"]),
    ("Hockey Nightly Stable", 0.05, ["stable", "not premium desk"]),
]
EVENT_COMMISSIONS = [
    ("Single Event Groups", 0.04, ["group code"]),
    ("Single Event Groups", 0.08, ["group code", "events desk"]),
    ("Single Event Clubs and ENN", 0.04, ["clubs or bowl"]),
    ("Single Event Suites", 0.08, ["event suites"]),
]


def commission_facts(df: DataFrame) -> dict[str, Column]:
    """What the commission rules ask about a sale; only facts whose columns exist."""
    def is_one(column: str, *values: str) -> Column:
        return reduce(lambda a, b: a | b, [F.col(column).eqNullSafe(v) for v in values])

    facts = {
        "full": ("ticket_type", "Full"), "premier": ("ticket_type", "Premier"), "groups": ("ticket_type", "Groups"),
        "flex": ("ticket_type", "Flex"), "nightly suites": ("ticket_type", "Nightly Suites"),
        "lounge": ("location_general", "Lounge 954"), "suites": ("location_general", "Suites"),
        "premium desk": ("rep_department", "Premium"), "membership desk": ("rep_department", "Membership"),
        "upgrade desk": ("rep_department", "New Business", "Groups"), "events desk": ("rep_department", "Events"),
        "sales": ("rep_sales_service", "Sales"), "service": ("rep_sales_service", "Service"),
        "tier A": ("tier", "A"), "tier B or C": ("tier", "B", "C"), "tier D or E": ("tier", "D", "E"),
        "premium group seat": ("pc_one", "1", "2", "X", "Z"), "stable": ("price_code", "YI"), "group code": ("pc_two", "G"),
        "clubs or bowl": ("location_events_general", "ENN's", "Clubs"), "event suites": ("location_events_general", "Suites"),
    }
    out = {name: is_one(column, *values) for name, (column, *values) in facts.items() if column in df.columns}
    out["renewal"], out["upgrade"] = F.col("is_renewal"), F.col("is_upgrade")
    out["premium seat"] = is_one("location_general", "Lounge 954", "Corona") | is_one("pc_one", "1", "2")
    return out


def commissions(df: DataFrame, rules: Sequence[tuple] = HOCKEY_COMMISSIONS, doubled: bool = True) -> DataFrame:
    """Commission type, rate and amount; group sales in the bonus window earn the rate twice."""
    out = apply_rules(
        df, commission_facts(df), {"commission": rules}, {"commission": [("commission_type", "Unknown"), ("commission_rate", 0.0)]})
    if doubled:
        first, last = (F.lit(d).cast("date") for d in fixed.DOUBLE_COMMISSION_ADDED)
        bonus = (F.col("ticket_type") == "Groups") & F.col("add_date").between(first, last) & F.col("event_name").isin(
            fixed.DOUBLE_COMMISSION_EVENTS)
        out = out.withColumn("commission_rate", F.col("commission_rate") * F.when(bonus, 2.0).otherwise(1.0))
    if "commissionable_amount" in df.columns:
        out = out.withColumn("rep_commissions", F.col("commissionable_amount") * F.col("commission_rate"))
    return out


def seat_ids(df: DataFrame) -> DataFrame:
    seat = ["section_name", "row_name", "seat"]
    return df.withColumns({"seat_id": seat_key(*seat), "seat_event_id": seat_key("event_name", *seat)})


def event_state(df: DataFrame, as_of) -> DataFrame:
    """Tier from the event name, days out at the sale, and whether the event is over at ``as_of``."""
    today = F.lit(as_of).cast("date")
    return df.withColumns({
        "tier": F.right("event_name", F.lit(1)),
        "days_out_from_event": F.datediff("event_date", "add_date"),
        "is_game_over": F.col("event_date") < today,
    })


def is_gameday(games: DataFrame, as_of) -> DataFrame:
    """One row: does any event take place on ``as_of``?"""
    on_day = F.count_if(F.col("event_date") == F.lit(as_of).cast("date"))
    return games.agg((on_day > 0).alias("gameday_check"))


def classified(df: DataFrame) -> DataFrame:
    """All label steps in their order of dependence."""
    steps = [price_code_parts, places, premium, plan_types, accounts, flags, ticket_types]
    for step in steps:
        df = df.transform(step)
    return df
