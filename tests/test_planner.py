"""Resolver, finder, planner and slots against plain Python written from the rules."""

import random

from pyspark.sql import functions as F

from goldleaf.operators import planner as L

DESTINATIONS = [
    (1, "Paris", "France", "# Paris\nMuseums and other things to do, top attractions everywhere in Paris itself."),
    (2, "Nice", "France", None),
    (3, "Tokyo", "Japan", "# Tokyo\n" + "x" * 60),
    (4, "New York", "United States", ""),
    (5, "York", "England", "tiny"),
    (6, "Rome", "Italy", "# Rome\nForum.\n## Food\n" + "pasta " * 20),
    (7, "Bath", "England", "# Bath\n" + "water " * 20),
    (9, "York", "Canada", "# York in Canada\n" + "snow " * 20),
]


def destinations(spark):
    return spark.createDataFrame(
        DESTINATIONS, "destination_id long, destination string, country string, description string"
    )


def python_resolve(text):
    """Dictionaries as the rules have them: last row of a city wins, first seen is tried first."""
    cities, countries = {}, {}
    for row in DESTINATIONS:
        cities[row[1].lower()] = row
        countries.setdefault(row[2].lower(), []).append(row)
    key = (text or "").strip().lower()
    if key in cities:
        return "city", cities[key][0], None
    if key in countries:
        found = countries[key]
        return "country", found[0][0] if len(found) == 1 else None, len(found)
    for city, row in cities.items():
        if key and (key in city or city in key):
            return "city", row[0], None
    return "unknown", None, None


def test_resolver_matches_python(spark):
    rng = random.Random(3)
    names = [d[1] for d in DESTINATIONS] + [d[2] for d in DESTINATIONS]
    texts = [None, "", " \t", "Atlantis", "a", "o", "york", "New", "new york city", "near Bath, England", "x" * 300]
    for _ in range(300):
        name = rng.choice(names)
        start, end = sorted(rng.sample(range(len(name) + 1), 2))
        texts.append(rng.choice(["", " ", "\n", "in "]) + rng.choice([name, name.upper(), name[start:end]]) + rng.choice(["", " ", "!"]))
    asked = spark.createDataFrame(list(enumerate(texts)), "request_id long, destination_text string")
    got = L.resolve_destination(asked, destinations(spark)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.status, r.destination_id, r.n_cities) == python_resolve(texts[r.request_id]), repr(texts[r.request_id])


def test_resolver_examples(spark):
    asked = spark.createDataFrame(
        [(1, "Paris"), (2, "germany"), (3, "Atlantis"), (4, "tokyo"), (5, "france"), (6, "ITALY ")],
        "request_id long, destination_text string",
    )
    got = {r.request_id: (r.status, r.destination_id) for r in L.resolve_destination(asked, destinations(spark)).collect()}
    assert got == {
        1: ("city", 1), 2: ("unknown", None), 3: ("unknown", None), 4: ("city", 3), 5: ("country", None), 6: ("country", 6),
    }


def test_resolver_without_destinations(spark):
    asked = spark.createDataFrame([(1, "Paris")], "request_id long, destination_text string")
    (row,) = L.resolve_destination(asked, destinations(spark).limit(0)).collect()
    assert row.status == "unknown"


def properties(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([1, 3, 6, 7]), f"P{i}", "flat", float(rng.choice([50, 60, 70, 80, 250])), 1, 2) for i in range(80)]
    rows += [(200, 1, "no price", "flat", None, 1, 2), (201, None, "no place", "flat", 10.0, 1, 2)]
    return rows, spark.createDataFrame(
        rows,
        "property_id long, destination_id long, title string, property_type string, base_price double, "
        "bedrooms int, max_guests int",
    )


def test_cheapest_under_a_ceiling_match_brute_force(spark):
    rows, df = properties(spark)
    requests = [(i, d, c) for i, (d, c) in enumerate((d, c) for d in (1, 3, 6, 7, 8, None) for c in (0.0, 50.0, 65.0, 300.0, None))]
    asked = spark.createDataFrame(requests, "request_id long, destination_id long, max_nightly_price double")
    got = {}
    for r in L.find_properties(asked, df).collect():
        got.setdefault(r.request_id, []).append((r.rank, r.property_id))
    for request_id, place, ceiling in requests:
        fits = sorted((p[4], p[0]) for p in rows if place and p[1] == place and p[4] is not None and ceiling is not None and p[4] <= ceiling)
        assert sorted(got.get(request_id, [])) == [(k + 1, pid) for k, (_, pid) in enumerate(fits[:6])]


def test_budget_check(spark):
    offers = spark.createDataFrame([(33.335, 3, 100.0), (50.0, 2, 100.0), (50.01, 2, 100.0)], "base_price double, nights int, budget double")
    got = [(r.estimated_accommodation, r.within_budget, r.remaining) for r in L.budget_check(offers).collect()]
    assert got == [(100.01, False, -0.01), (100.0, True, 0.0), (100.02, False, -0.02)]


def test_plans(spark):
    _, df = properties(spark)
    asked = spark.createDataFrame(
        [(1, "Paris", 4, 240.0), (2, "Iceland", 3, 900.0), (3, "france", 3, 900.0), (4, "Nice", 3, 900.0),
         (5, "italy", 2, 100.0), (6, "Paris", 0, 100.0), (7, None, 1, 10.0)],
        "request_id long, destination_text string, nights int, budget double",
    )
    texts = {r.request_id: (r.plan_status, r.reply) for r in L.plan_texts(asked, destinations(spark), df).collect()}
    assert texts[2] == ("unknown", (
        "I can only plan for these 8 destinations:\nBath, New York, Nice, Paris, Rome, Tokyo, York, York\n\n"
        "'Iceland' is not one of them."))
    assert texts[3] == ("ask_city", "France has several destinations in the data: Paris, Nice. Please ask for one of them.")
    assert texts[4] == ("no_properties", (
        "For Nice, no properties fit a budget of 900 over 3 nights (about 300/night). "
        "Try more nights, a higher budget, or a less expensive destination."))
    assert texts[6][0] == "incomplete" and texts[7][0] == "unknown"
    lines = texts[1][1].split("\n")
    assert lines[:4] == ["TRIP PLAN — Paris, France", "4 nights, budget 240", "", "Accommodation options within budget:"]
    assert lines[4].startswith("  [OK] P") and lines[4].endswith("(flat, 1 bed) — 50/night x 4 = 200, leaves 40")
    assert lines[-1] == "(Note: flights are not included.)"
    plans = L.plan_trips(asked, destinations(spark), df).collect()
    first = [r for r in plans if r.request_id == 1]
    assert [r.rank for r in sorted(first, key=lambda r: r.rank)] == list(range(1, len(first) + 1))
    assert all(r.within_budget and r.context.startswith("# Paris") for r in first)
    assert {r.plan_status for r in plans if r.request_id == 5} == {"planned"}
    assert [r.rank for r in plans if r.request_id == 2] == [None]


def test_long_lists_are_complete(spark):
    _, df = properties(spark)
    many = spark.range(150).selectExpr(
        "id AS destination_id", "concat('City', lpad(id, 3, '0')) AS destination", "'Big' AS country", "'' AS description"
    )
    asked = spark.createDataFrame(
        [(1, "big", 1, 1.0), (2, "zzz", 1, 1.0)], "request_id long, destination_text string, nights int, budget double"
    )
    texts = {r.request_id: r.reply for r in L.plan_texts(asked, many, df, wording="chat").collect()}
    listed = ", ".join(f"City{i:03d}" for i in range(150))
    assert texts[1] == f"Big has several destinations: {listed}. Please ask for one of them."
    assert texts[2] == f"I can only plan for these 150 destinations: {listed}. 'zzz' is not one of them."
    lists = L.place_lists(many).collect()
    assert {r.list_key for r in lists} == {"", "big"} and len(lists) == 300


def test_incomplete_requests_are_told_what_is_missing(spark):
    _, df = properties(spark)
    asked = spark.createDataFrame(
        [(1, "Paris", 0, 9.0), (2, "Paris", None, None), (3, "Paris", 2, None)],
        "request_id long, destination_text string, nights int, budget double",
    )
    texts = {r.request_id: r.reply for r in L.plan_texts(asked, destinations(spark), df).collect()}
    ending = ". For example: '4 nights in Paris with a budget of 2000 euros'."
    assert texts[1] == "ASSISTANT: I can plan that — I just need how many nights" + ending
    assert texts[2] == "ASSISTANT: I can plan that — I just need how many nights, and your budget" + ending
    assert texts[3] == "ASSISTANT: I can plan that — I just need your budget" + ending


def test_title_case_after_every_non_letter(spark):
    df = spark.createDataFrame([("guinea-bissau",), ("côte d'ivoire",), ("NEW  york",), ("",)], "t string")
    assert [r[0] for r in df.select(L.title_case(F.col("t"))).collect()] == ["Guinea-Bissau", "Côte D'Ivoire", "New  York", ""]


def test_amounts_with_thousands_separators(spark):
    texts = ["budget 1,500", "€1,200", "2,000 euros", "about 12,345.50 usd", "1,2 euros", "budget of 900"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(L.stated_budget(F.col("t"))).collect()] == [1500, 1200, 2000, 12345.5, 2, 900]


def test_chat_over_extraction_replies(spark):
    _, df = properties(spark)
    replies = spark.createDataFrame(
        [(1, 'sure: {"destination": "Paris", "nights": 4, "budget": 240}'), (2, "no idea"), (3, '{"destination": "Rome", "nights": 3, "budget": null}')],
        "message_id long, reply string",
    )
    got = {r.message_id: r.reply for r in L.chat_replies_from_replies(replies, destinations(spark), df).collect()}
    assert got[1].startswith("ASSISTANT:\nTRIP PLAN — Paris, France\n4 nights, budget 240\n")
    assert got[2] == "ASSISTANT: Sorry, I couldn't understand that (no readable details). Try e.g. '4 days in Paris with a budget of 2000 euros'."
    assert got[3].startswith("ASSISTANT: I can plan that — I just need your budget.")


def test_slots(spark):
    messages = {
        1: ("I want to go to Paris for 4 days with about 2000 euros", "Paris", 4, 2000.0, ""),
        2: ("plan 5 nights in Tokyo, budget 1500", "Tokyo", 5, 1500.0, ""),
        3: ("somewhere in Italy for a week", "Italy", 7, None, "your budget"),
        4: ("I'd like to visit Rome for 3 days", "Rome", 3, None, "your budget"),
        5: ("new york or paris, 0 nights, €12.50", "New York", 0, 12.5, "how many nights"),
        6: ("Parisian dreams", None, None, None, "which destination, and how many nights, and your budget"),
        7: (None, None, None, None, "which destination, and how many nights, and your budget"),
        8: ("united states! 2 weeks, $900", "United States", 14, 900.0, ""),
        9: ("99999999999999 nights in France: Nice", "Nice", None, None, "how many nights, and your budget"),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in messages.items()], "message_id long, message string")
    got = L.missing_slots(L.request_slots(df, destinations(spark))).collect()
    assert {r.message_id: (r.destination, r.nights, r.budget, r.missing) for r in got} == {k: v[1:] for k, v in messages.items()}


def test_chat(spark):
    _, df = properties(spark)
    messages = spark.createDataFrame(
        [(1, "4 nights in Paris for 240 euros"), (2, "I'd like to visit Rome for 3 days")], "message_id long, message string"
    )
    replies = {r.message_id: r.reply for r in L.chat_replies(messages, destinations(spark), df).collect()}
    assert replies[1].startswith("ASSISTANT:\nTRIP PLAN — Paris, France\n4 nights, budget 240\n")
    assert replies[1].endswith("\n\n(Flights are not included — no flight data on this tier.)")
    assert replies[2] == (
        "ASSISTANT: I can plan that — I just need your budget. "
        "For example: '4 nights in Paris with a budget of 2000 euros'."
    )


def test_slot_replies(spark):
    df = spark.createDataFrame(
        [(1, 'ok {"destination": "Rome", "nights": 3, "budget": null} !'), (2, "{bad"), (3, '{"nights": "4", "budget": 10.5}'), (4, None)],
        "message_id long, reply string",
    )
    got = {r.message_id: tuple(r)[1:] for r in L.parse_slot_replies(df).collect()}
    assert got == {
        1: (True, "Rome", 3, None), 2: (False, None, None, None), 3: (True, None, 4, 10.5), 4: (False, None, None, None),
    }
