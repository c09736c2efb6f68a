"""Trip planning for batches of requests: resolve, find, check, describe, reply.

The flow for one request becomes one joined plan for all of them.  All that
depends on a destination alone (its cheapest properties, its retrieved
text) is computed once per destination; requests only look it up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.functions.numbers import plain_number
from goldleaf.functions.text import first_json_object, normal_key, strip_space
from goldleaf.operators.ordering import in_ranges, joined_text
from goldleaf.operators.retrieval import context_of_guides, with_context
from goldleaf.operators.skew import lookup_join
from goldleaf.sources.tables import materialize

PROPERTIES_SHOWN = 6
GRAM = 3  # characters of the grams by which names are looked up loosely
ALL_PLACES = ""  # key of the list of all places; the others are lower-case countries

# Fixed texts.
CONTEXT_QUESTION = "top tourist attractions and things to do in "
CONTEXT_QUESTION_SHORT = "top attractions and things to do in "
CHAT_FLIGHT_NOTE = "\n\n(Flights are not included — no flight data on this tier.)"
WRITTEN_RULE = "\n\n" + "-" * 60 + "\nPLANNER:\n"
WRITTEN_NOTE = "\n\n(Note: flights are not included — no flight data on this tier.)"
# Wording of the planner on its own and behind the chat.
WORDING = {
    "planner": {
        "unknown_1": " destinations:\n",
        "unknown_2": "\n\n'",
        "several": " has several destinations in the data: ",
        "nothing_1": ", no properties fit a budget of ",
        "nothing_2": " nights (about ",
        "nothing_3": "/night). Try more nights, a higher budget, or a less expensive destination.",
        "before_type": "  (",
        "end": "\n\n(Note: flights are not included.)",
        "context": CONTEXT_QUESTION,
    },
    "chat": {
        "unknown_1": " destinations: ",
        "unknown_2": ". '",
        "several": " has several destinations: ",
        "nothing_1": ", no properties fit ",
        "nothing_2": " nights (~",
        "nothing_3": "/night). Try more nights or a higher budget.",
        "before_type": " (",
        "end": "",
        "context": CONTEXT_QUESTION_SHORT,
    },
}
ASK_PREFIX = "ASSISTANT: I can plan that — I just need "
ASK_EXAMPLE = ". For example: '4 nights in Paris with a budget of 2000 euros'."
NOT_UNDERSTOOD = (
    "ASSISTANT: Sorry, I couldn't understand that (no readable details). "
    "Try e.g. '4 days in Paris with a budget of 2000 euros'."
)
ASK_DESTINATION, ASK_NIGHTS, ASK_BUDGET = "which destination", "how many nights", "your budget"


# ---- destination resolver ---------------------------------------------------
def _city_names(destinations: DataFrame) -> DataFrame:
    """One row per city name: the last row of a repeated name stands for it."""
    return (
        destinations.groupBy(F.lower("destination").alias("key"))
        .agg(F.min("destination_id").alias("first_id"), F.max("destination_id").alias("destination_id"))
        .filter(F.col("key").isNotNull())
    )


def _country_names(destinations: DataFrame) -> DataFrame:
    """One row per country: number of its cities, and the city if there is one only."""
    return (
        destinations.groupBy(F.lower("country").alias("key"))
        .agg(F.count(F.lit(1)).alias("n_cities"), F.min("destination_id").alias("only_id"))
        .filter(F.col("key").isNotNull())
    )


def _grams(text: Column, sizes: Column) -> Column:
    """The different substrings of a text that have one of the sizes."""

    def of_size(size: Column) -> Column:
        starts = F.when(size <= F.length(text), F.sequence(F.lit(1), F.length(text) - size + 1))
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda start: F.substring(text, start, size))

    return F.array_distinct(F.flatten(F.transform(sizes, of_size)))


def contained(parts: DataFrame, wholes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The pairs (``by``, part, whole) of different texts with equal ``by`` where the whole contains the part.

    An index lists the grams of every whole, up to GRAM characters long, so it
    grows with the length of the texts.  A part is looked up by one gram, the one
    that the fewest wholes have (the part itself if it is shorter), and what is
    found is checked; a part with a gram that no whole has is in none.
    """
    index = wholes.select(*by, "whole", F.explode(_grams(F.col("whole"), F.sequence(F.lit(0), F.lit(GRAM)))).alias("gram"))
    counts = index.groupBy(*by, "gram").agg(F.count(F.lit(1)).alias("n"))
    own = _grams(F.col("part"), F.array(F.least(F.lit(GRAM), F.length("part"))))
    rarest = (
        parts.select(*by, "part", F.explode(own).alias("gram"))
        .join(counts, [*by, "gram"], "left")
        .groupBy(*by, "part")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("rarest"))
        .where("rarest.n > 0")
        .select(*by, "part", "rarest.gram")
    )
    return rarest.join(index, [*by, "gram"]).where(F.contains("whole", "part")).select(*by, "part", "whole")


def _loose_matches(keys: DataFrame, cities: DataFrame) -> DataFrame:
    """First city whose name contains the key or is contained in it (key, loose_id)."""
    names = cities.select(F.col("key").alias("name"), F.struct("first_id", "destination_id").alias("hit"))

    def sides(first: DataFrame, second: DataFrame, into: str) -> DataFrame:
        one, two = (df.select(F.lit(k).alias("side"), F.col(df.columns[0]).alias(into)) for k, df in enumerate((first, second)))
        return one.unionByName(two)

    # side 0: keys in names; side 1: names in keys
    pairs = contained(sides(keys, names, "part"), sides(names, keys, "whole"), ("side",))
    key_first = F.col("side") == 0
    return (
        pairs.select(
            F.when(key_first, F.col("part")).otherwise(F.col("whole")).alias("key"),
            F.when(key_first, F.col("whole")).otherwise(F.col("part")).alias("name"),
        )
        .join(names, "name")
        .groupBy("key")
        .agg(F.min("hit").alias("hit"))
        .select("key", F.col("hit.destination_id").alias("loose_id"))
    )


def resolve_destination(requests: DataFrame, destinations: DataFrame, id_column: str = "request_id") -> DataFrame:
    """Adds status (city, country, unknown), destination_id and n_cities to requests.

    Tiers, first match wins: city name, country name, loose containment.  For a
    country with a single city the destination is that city.  Each distinct text
    is resolved once, and the result stored: either side of the last join is then
    a plain exchange, which adaptive execution splits at a text that a third of
    the requests share.
    """
    keyed = requests.withColumn("_key", normal_key(F.col("destination_text")))
    cities, countries = materialize(_city_names(destinations), "city-names"), _country_names(destinations)
    named = materialize(
        keyed.select(F.col("_key").alias("key"))
        .filter(F.col("key") != "")
        .distinct()
        .join(cities.select("key", F.col("destination_id").alias("city_id")), "key", "left")
        .join(countries, "key", "left"),
        "request-texts",
    )
    open_keys = named.filter(F.col("city_id").isNull() & F.col("n_cities").isNull()).select("key")
    resolved = named.join(_loose_matches(open_keys, cities), "key", "left").select(
        F.col("key").alias("_key"),
        F.when(F.col("city_id").isNotNull(), "city")
        .when(F.col("n_cities").isNotNull(), "country")
        .when(F.col("loose_id").isNotNull(), "city")
        .otherwise("unknown")
        .alias("status"),
        F.coalesce("city_id", F.when(F.col("n_cities") == 1, F.col("only_id")), "loose_id").alias(
            "destination_id"
        ),
        F.when(F.col("city_id").isNull(), F.col("n_cities")).alias("n_cities"),
    )
    return keyed.join(materialize(resolved, "resolved-texts"), "_key", "left").select(
        *requests.columns,
        F.coalesce("status", F.lit("unknown")).alias("status"),
        "destination_id",
        "n_cities",
    )


# ---- property finder and budget check ---------------------------------------
def cheapest_properties(properties: DataFrame, limit: int = PROPERTIES_SHOWN) -> DataFrame:
    """One row per destination with its cheapest properties as an ordered array.

    The properties within a price ceiling, cheapest first, are a prefix of the
    properties cheapest first.  So the best ``limit`` under any ceiling are among
    the best ``limit`` overall, and no request has to be paired with all
    properties of its destination.  The rank is cut on the map side before the
    shuffle.
    """
    by_price = Window.partitionBy("destination_id").orderBy("base_price", "property_id")
    return (
        properties.filter(F.col("destination_id").isNotNull() & F.col("base_price").isNotNull())
        .withColumn("rank", F.row_number().over(by_price))
        .filter(F.col("rank") <= limit)
        .groupBy("destination_id")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "rank", "property_id", "title", "property_type", "base_price", "bedrooms", "max_guests"
                    )
                )
            ).alias("offers")
        )
    )


def _within(offers: Column, ceiling: Column) -> Column:
    return F.filter(offers, lambda o: o["base_price"] <= ceiling)


def find_properties(requests: DataFrame, properties: DataFrame, limit: int = PROPERTIES_SHOWN) -> DataFrame:
    """Cheapest properties per (request_id, destination_id, max_nightly_price) row."""
    offers = lookup_join(
        requests, cheapest_properties(properties, limit), "destination_id", spread_by="request_id"
    )
    return offers.select(
        "request_id", F.inline(_within(F.col("offers"), F.col("max_nightly_price")))
    )


def nightly_ceiling(budget: Column, nights: Column) -> Column:
    """Budget per night; NULL without a positive number of nights."""
    return F.when(nights > 0, budget.cast("double") / nights)


def stay_cost(price: Column, nights: Column) -> Column:
    return F.round(price * nights, 2)


def budget_check(offers: DataFrame) -> DataFrame:
    """Cost of a stay against the budget for rows with base_price, nights, budget."""
    price, budget = F.col("base_price").cast("double"), F.col("budget").cast("double")
    cost = stay_cost(price, F.col("nights"))
    return offers.withColumns(
        {
            "nightly_price": price,
            "estimated_accommodation": cost,
            "within_budget": cost <= budget,
            "remaining": F.round(budget - cost, 2),
        }
    )


# ---- planner ----------------------------------------------------------------
def destination_cards(
    destinations: DataFrame,
    properties: DataFrame,
    context_question: str = CONTEXT_QUESTION,
    guides: DataFrame | None = None,
) -> DataFrame:
    """Per destination: name, country, cheapest properties and retrieved context.

    The context comes from the destination's ``description``, or, where ``guides``
    (destination_id, guide_id, description) are given, from all guides of it.
    """
    question = F.concat(F.lit(context_question), "destination")
    if guides is None:
        description = F.coalesce("description", F.lit(""))
        described = with_context(destinations, description, question).withColumn(
            "context", F.when(description != "", F.col("context"))
        )
    else:
        asked = destinations.select("destination_id", question.alias("question"))
        contexts = context_of_guides(asked, guides, "destination_id")
        described = destinations.drop("context").join(contexts, "destination_id", "left")
    named = described.select(
        "destination_id",
        "destination",
        F.col("country").alias("destination_country"),
        F.coalesce(
            "context", F.concat(F.lit("(No description text available for "), "destination", F.lit(".)"))
        ).alias("context"),
    )
    return named.join(cheapest_properties(properties), "destination_id", "left")


def place_lists(destinations: DataFrame) -> DataFrame:
    """Every name of every list as rows: list_key, destination_id, destination.

    All places are one list, those of a country another.
    """
    everywhere = destinations.select(F.lit(ALL_PLACES).alias("list_key"), "destination_id", "destination")
    countries = destinations.where(F.col("country").isNotNull() & (F.col("country") != ALL_PLACES)).select(
        F.lower("country").alias("list_key"), "destination_id", "destination"
    )
    return everywhere.unionByName(countries)


def list_texts(destinations: DataFrame) -> DataFrame:
    """The complete names of each list as one text: list_key, names.

    All places are in the order of their names, those of a country by id.  Lists
    are cut into ranges, each range becomes a string, and the strings are joined
    in the order of the ranges, so no task sorts a whole list.
    """
    by = F.when(F.col("list_key") == ALL_PLACES, F.lit(None).cast("bigint")).otherwise(F.col("destination_id"))
    named = place_lists(destinations).where(F.col("destination").isNotNull())
    order = ["by", "destination"]
    ranges = in_ranges(named.select("list_key", by.alias("by"), "destination", F.col("destination").alias("names")), ["list_key", *order])
    return joined_text(ranges, ["list_key"], "_range", order, "names", ", ")


def title_case(text: Column) -> Column:
    """Upper case after every character that is no letter, lower case elsewhere."""
    parts = F.split(text, r"(?<=[^\p{L}])")
    each = F.transform(parts, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30))))
    return F.array_join(each, "")


def _planned(
    requests: DataFrame,
    destinations: DataFrame,
    properties: DataFrame,
    context_question: str,
    cards: DataFrame | None = None,
) -> DataFrame:
    """Requests with status, destination card, offers within budget and message texts."""
    resolved = materialize(resolve_destination(materialize(requests, "requests"), destinations), "resolved")
    if cards is None:
        cards = materialize(destination_cards(destinations, properties, context_question), "cards")
    # both are stored: plain exchanges, which adaptive execution splits at a destination that very many ask for
    known = resolved.join(cards, "destination_id", "left")
    nights, budget = F.col("nights"), F.col("budget").cast("double")
    ceiling = nightly_ceiling(budget, nights)
    fitting = _within(F.col("offers"), ceiling)
    status = (
        F.when(F.col("status") == "unknown", "unknown")
        .when((F.col("status") == "country") & (F.col("n_cities") > 1), "ask_city")
        .when(ceiling.isNull(), "incomplete")
        .when(F.coalesce(F.size("fitting"), F.lit(0)) <= 0, "no_properties")
        .otherwise("planned")
    )
    return known.withColumns({"ceiling": ceiling, "fitting": fitting}).withColumn("plan_status", status)


def plan_trips(
    requests: DataFrame,
    destinations: DataFrame,
    properties: DataFrame,
    context_question: str = CONTEXT_QUESTION,
    cards: DataFrame | None = None,
) -> DataFrame:
    """One row per candidate property of a request, or one row with the reason.

    Requests have request_id, destination_text, nights and budget.  ``cards`` are
    those of destination_cards, if they are stored.
    """
    planned = _planned(requests, destinations, properties, context_question, cards)
    offer = F.col("offer")
    cost = stay_cost(offer["base_price"], F.col("nights"))
    is_plan = F.col("plan_status") == "planned"
    return planned.select(
        "request_id",
        "plan_status",
        "destination",
        "nights",
        F.col("budget").cast("double").alias("budget"),
        F.when(is_plan, F.col("context")).alias("context"),
        F.explode_outer(F.when(is_plan, F.col("fitting"))).alias("offer"),
    ).select(
        "request_id",
        "plan_status",
        "destination",
        offer["rank"].alias("rank"),
        offer["property_id"].alias("property_id"),
        offer["title"].alias("title"),
        offer["base_price"].alias("nightly_price"),
        cost.alias("estimated_accommodation"),
        F.round(F.col("budget") - cost, 2).alias("remaining"),
        (cost <= F.col("budget")).alias("within_budget"),
        "context",
    )


def plan_texts(
    requests: DataFrame,
    destinations: DataFrame,
    properties: DataFrame,
    wording: str = "planner",
    keep: tuple[str, ...] = (),
    cards: DataFrame | None = None,
    lists: DataFrame | None = None,
) -> DataFrame:
    """One reply text per request: request_id, plan_status, reply and ``keep`` columns.

    ``cards`` and ``lists`` are those of destination_cards and list_texts, if they are stored.  A column ``written`` in ``requests`` holds plans written elsewhere from the
    same data; one that is not NULL follows the listed options.
    """
    say = {name: F.lit(text) for name, text in WORDING[wording].items()}
    planned = materialize(
        _planned(requests, destinations, properties, WORDING[wording]["context"], cards).drop("context", "offers"), "planned"
    )
    nights, budget = F.col("nights"), F.col("budget").cast("double")
    nights_text = nights.cast("string")

    def offer_line(offer: Column) -> Column:
        cost = stay_cost(offer["base_price"], nights)
        return F.concat(
            F.lit("  ["), F.when(cost <= budget, "OK").otherwise("OVER"), F.lit("] "), offer["title"],
            say["before_type"], offer["property_type"], F.lit(", "), offer["bedrooms"].cast("string"),
            F.lit(" bed) — "), plain_number(offer["base_price"]), F.lit("/night x "), nights_text,
            F.lit(" = "), plain_number(cost), F.lit(", leaves "), plain_number(F.round(budget - cost, 2)),
        )

    end = say["end"]
    if "written" in requests.columns:
        told = F.concat(F.lit(WRITTEN_RULE), strip_space(F.col("written")), F.lit(WRITTEN_NOTE))
        end = F.coalesce(told, end)
    plan = F.concat(
        F.lit("TRIP PLAN — "), "destination", F.lit(", "), "destination_country", F.lit("\n"), nights_text,
        F.lit(" nights, budget "), plain_number(budget), F.lit("\n\nAccommodation options within budget:\n"),
        F.array_join(F.transform("fitting", offer_line), "\n"), end,
    )
    nothing = F.concat(
        F.lit("For "), "destination", say["nothing_1"], plain_number(budget), F.lit(" over "), nights_text,
        say["nothing_2"], plain_number(F.col("ceiling")), say["nothing_3"],
    )
    lists = materialize(list_texts(destinations), "list_texts") if lists is None else lists
    n_places = destinations.agg(F.count(F.lit(1))).scalar()
    text = F.coalesce("destination_text", F.lit(""))
    unknown = F.concat(
        F.lit("I can only plan for these "), n_places.cast("string"), say["unknown_1"],
        F.coalesce("names", F.lit("")), say["unknown_2"],
        text, F.lit("' is not one of them."),
    )
    ask_city = F.concat(
        title_case(text), say["several"], "names", F.lit(". Please ask for one of them."),
    )
    missing = F.array_compact(
        F.array(
            F.when(F.coalesce(nights <= 0, F.lit(True)), F.lit(ASK_NIGHTS)), F.when(budget.isNull(), F.lit(ASK_BUDGET))
        )
    )
    incomplete = F.concat(F.lit(ASK_PREFIX), F.array_join(missing, ", and "), F.lit(ASK_EXAMPLE))
    reply = (
        F.when(F.col("plan_status") == "unknown", unknown)
        .when(F.col("plan_status") == "ask_city", ask_city)
        .when(F.col("plan_status") == "no_properties", nothing)
        .when(F.col("plan_status") == "incomplete", incomplete)
        .when(F.col("plan_status") == "planned", plan)
    )
    # Only replies that ask for a list have a key.  Either side is a plain exchange, so
    # adaptive execution splits the requests that share a list.
    keyed = planned.withColumn(
        "list_key",
        F.when(F.col("plan_status") == "ask_city", normal_key(F.col("destination_text"))).when(
            F.col("plan_status") == "unknown", ALL_PLACES
        ),
    )
    return keyed.join(lists, "list_key", "left").select("request_id", "plan_status", reply.alias("reply"), *keep)


# ---- free-text requests -----------------------------------------------------
def _name_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_'-]+"), lambda w: w != "")


def _word_runs(messages: DataFrame, most_words: Column) -> DataFrame:
    """Runs of up to ``most_words`` words of each message: message_id, start, key."""
    return (
        messages.select("message_id", _name_words(F.col("message")).alias("tokens"))
        .withColumn("n", F.explode(F.sequence(F.lit(1), most_words)))
        .filter(F.size("tokens") >= F.col("n"))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.size("tokens") - F.col("n") + 1)))
        .select("message_id", "start", F.array_join(F.slice("tokens", F.col("start"), F.col("n")), " ").alias("key"))
    )


def _place_names(destinations: DataFrame) -> DataFrame:
    """City and country names (kind 0 and 1) by their words, one row per key."""
    names = destinations.select(F.lit(0).alias("kind"), F.col("destination").alias("name")).unionByName(
        destinations.select(F.lit(1).alias("kind"), F.col("country").alias("name"))
    )
    tokens = _name_words(F.col("name"))
    return (
        names.filter(F.col("name").isNotNull())
        .select("kind", "name", F.array_join(tokens, " ").alias("key"), F.size(tokens).alias("n_words"))
        .filter(F.col("n_words") > 0)
        .groupBy("key", "n_words")
        .agg(F.min(F.struct("kind", "name")).alias("place"))
    )


def stated_nights(message: Column) -> Column:
    """Nights or days as a number, or weeks times seven; NULL if not stated."""
    low = F.lower(message)
    number = F.regexp_extract(low, r"(\d+) ?-?(?:nights?|days?)\b", 1).try_cast("int")
    weeks = F.regexp_extract(low, r"(\d+) ?-?weeks?\b", 1).try_cast("int")
    one_week = F.when(F.regexp_like(low, F.lit(r"\b(?:a|one) week\b")), 7)
    return F.coalesce(number, weeks * 7, one_week)


def stated_budget(message: Column) -> Column:
    """Amount next to a currency or after the word budget, thousands with or without commas; NULL if not stated."""
    low = F.lower(message)
    amount = r"(\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?)"
    forms = [
        amount + r" ?(?:euros?|eur|dollars?|usd|pounds?|gbp|€|\$|£)",
        r"[€$£] ?" + amount,
        r"\bbudget(?: of)?(?: about| around)? ?:? ?" + amount,
    ]
    return F.coalesce(*[F.replace(F.regexp_extract(low, form, 1), F.lit(",")).try_cast("double") for form in forms])


def request_slots(messages: DataFrame, destinations: DataFrame) -> DataFrame:
    """Destination, nights and budget stated in (message_id, message) rows.

    A destination is a city or country name that occurs as whole words: city
    before country, then the earliest mention, then the longest.  Word runs of
    the message are looked up in the list of names, so the whole text is searched
    without comparing it to every name.
    """
    places = _place_names(destinations)
    most_words = places.agg(F.coalesce(F.max("n_words"), F.lit(1))).scalar()
    mentions = (
        _word_runs(messages, most_words)
        .join(places, "key")
        .groupBy("message_id")
        .agg(F.min(F.struct("place.kind", "start", -F.col("n_words"), "place.name")).alias("best"))
        .select("message_id", F.col("best.name").alias("destination"))
    )
    return messages.join(mentions, "message_id", "left").select(
        "message_id",
        "destination",
        stated_nights(F.col("message")).alias("nights"),
        stated_budget(F.col("message")).alias("budget"),
    )


def parse_slot_replies(replies: DataFrame) -> DataFrame:
    """Slots from raw extraction replies (message_id, reply) that hold a JSON object.

    A reply without a readable object has readable = false and no slots.
    """
    body = F.col("body")
    slots = F.from_json(body, "destination string, nights string, budget string")
    return (
        replies.select("message_id", first_json_object(F.col("reply")).alias("body"))
        .select("message_id", F.json_object_keys(body).isNotNull().alias("readable"), slots.alias("slots"))
        .select(
            "message_id",
            "readable",
            F.col("slots.destination").alias("destination"),
            F.col("slots.nights").try_cast("int").alias("nights"),
            F.col("slots.budget").try_cast("double").alias("budget"),
        )
    )


def missing_slots(slots: DataFrame) -> DataFrame:
    """What is missing (empty text and zero count as missing) and the question to ask."""
    no_place = F.coalesce("destination", F.lit("")) == ""
    no_nights = F.coalesce("nights", F.lit(0)) == 0
    no_budget = F.coalesce("budget", F.lit(0.0)) == 0
    missing = F.array_compact(
        F.array(
            F.when(no_place, ASK_DESTINATION), F.when(no_nights, ASK_NIGHTS), F.when(no_budget, ASK_BUDGET)
        )
    )
    return slots.withColumn("_missing", missing).select(
        *slots.columns,
        F.array_join("_missing", ", and ").alias("missing"),
        F.when(
            F.size("_missing") > 0,
            F.concat(F.lit(ASK_PREFIX), F.array_join("_missing", ", and "), F.lit(ASK_EXAMPLE)),
        ).alias("question_back"),
    )


def _chat(slots: DataFrame, destinations: DataFrame, properties: DataFrame, **stored: DataFrame | None) -> DataFrame:
    """Replies to (message_id, destination, nights, budget, question_back) rows."""
    requests = slots.select(
        F.col("message_id").alias("request_id"),
        F.when(F.col("question_back").isNull(), F.col("destination")).alias("destination_text"),
        "nights",
        "budget",
        "question_back",
    )
    replies = plan_texts(requests, destinations, properties, wording="chat", keep=("question_back",), **stored)
    return replies.select(
        F.col("request_id").alias("message_id"),
        F.coalesce(
            "question_back", F.concat(F.lit("ASSISTANT:\n"), "reply", F.lit(CHAT_FLIGHT_NOTE))
        ).alias("reply"),
    )


def chat_replies(
    messages: DataFrame, destinations: DataFrame, properties: DataFrame, **stored: DataFrame | None
) -> DataFrame:
    """Free text in, trip plan or a question back out: message_id, reply.  ``stored`` is passed to plan_texts."""
    return _chat(missing_slots(request_slots(messages, destinations)), destinations, properties, **stored)


def chat_replies_from_replies(
    replies: DataFrame, destinations: DataFrame, properties: DataFrame, **stored: DataFrame | None
) -> DataFrame:
    """As chat_replies, with the slots in raw extraction replies (message_id, reply).

    A reply without a readable object is answered with a request to say it
    differently.
    """
    parsed = parse_slot_replies(replies)
    slots = missing_slots(parsed.drop("readable")).join(parsed.select("message_id", "readable"), "message_id")
    asked = slots.withColumn(
        "question_back", F.when(F.col("readable"), F.col("question_back")).otherwise(F.lit(NOT_UNDERSTOOD))
    )
    return _chat(asked, destinations, properties, **stored)
