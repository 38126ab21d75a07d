"""Media panels derived from the star-schema tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamix.catalog import catalog_frame, normalize_catalog
from mediamix.grain import BROADCAST_BYTES, Grain
from mediamix.session import cut_lineage, release

# Order priority that stands for each channel: (priority, channel, column prefix).
CHANNELS = [
    ("1-URGENT", "tv", "tv"),
    ("2-HIGH", "google search", "google_search"),
    ("3-MEDIUM", "facebook", "facebook"),
    ("4-NOT SPECIFIED", "email", "email"),
    ("5-LOW", "amazon", "amazon"),
]

PANEL_GRAIN = Grain(("region", "category"), "date", unique=True)

# Line number that stands for each measure of the supplier catalogue:
# (line number, measure, data type, data category).
MEASURES = [
    (1, "spend", "Absolute", "Spend"),
    (2, "impressions", "Absolute", "Response"),
    (3, "clicks", "Absolute", "Response"),
    (4, "conversions", "Absolute", "Response"),
    (5, "reach", "Absolute", "Response"),
    (6, "grp", "Rate", "Response"),
    (7, "conversion_perc", "Percentage", "Response"),
]


# Declared, so that building a plan starts no schema-inference jobs.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def money(name: str, precision: int = 14) -> Column:
    return F.col(name).cast(f"decimal({precision},2)")


# Keys whose numbers share a row of a lookup, and those that share one number of it.
BLOCK_BITS, WORD_BITS = 7, 4
# Bytes of a row of a lookup as a broadcast table, and the highest bit of each of its places.
LOOKUP_ROW = 128
TAKEN = -0x7777777777777778
# Numbers that a place can hold beside that bit.
NUMBERS = 8
# Bytes of a part as a broadcast row, and of the prices of a row of its lookup.
PART_ROW, PRICES_ROW = 48, 8 << BLOCK_BITS
PRIORITIES = [p for p, _, _ in CHANNELS]
# Place of orders of another priority, or none.
OTHER = len(CHANNELS)


def key_lookup(rows: DataFrame, key_name: str, number: Column) -> DataFrame | None:
    """(block, words): the number (0 to 7) of 128 consecutive keys in a row, four bits each.

    Line items then need no shuffle to learn what belongs to their key. None where keys
    repeat or where the table would be larger than what may be sent to every executor:
    such tables have to be joined.
    """
    key, per_word = F.col(key_name), 1 << WORD_BITS
    bits = F.call_function("shiftleft", (number + 8).cast("bigint"), (4 * key.bitwiseAND(per_word - 1)).cast("int"))
    words = 1 << (BLOCK_BITS - WORD_BITS)
    word = F.shiftright(key, WORD_BITS).bitwiseAND(words - 1)
    blocks = cut_lineage(
        rows.filter(key.isNotNull())
        .groupBy(F.shiftright(key, BLOCK_BITS).alias("block"))
        .agg(F.count("*").alias("n"), F.array(*[F.coalesce(F.bit_or(F.when(word == i, bits)), F.lit(0)).cast("bigint") for i in range(words)]).alias("words"))
    )
    places = sum(F.bit_count(F.col("words")[i].bitwiseAND(F.lit(TAKEN))) for i in range(words))
    count, repeated = blocks.agg(F.count("*"), F.count_if(F.col("n") != places)).first()
    if repeated or count * LOOKUP_ROW > BROADCAST_BYTES:
        release(blocks)
        return None
    return blocks.drop("n")


def looked_up(lines: DataFrame, lookup: DataFrame, key_name: str, name: str) -> DataFrame:
    """Lines whose key is in the lookup, with its number as ``name``."""
    key, per_word = F.col(key_name), 1 << WORD_BITS
    word = F.col("words")[F.shiftright(key, WORD_BITS).bitwiseAND((1 << (BLOCK_BITS - WORD_BITS)) - 1).cast("int")]
    place = F.call_function("shiftright", word, (4 * key.bitwiseAND(per_word - 1)).cast("int")).bitwiseAND(15)
    known = lines.join(F.broadcast(lookup), F.shiftright(key, BLOCK_BITS) == F.col("block"))
    return known.withColumn(name, place - 8).filter(F.col(name) >= 0).drop("block", "words")


def _place_in(name: str, values: Sequence[str | None]) -> Column:
    """Place of a text in ``values``, their number for any other."""
    return F.coalesce(*[F.when(F.col(name).eqNullSafe(F.lit(v)), i) for i, v in enumerate(values)], F.lit(len(values)))


def _named(values: Sequence[str | None], place: str) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]).cast("array<string>"), F.col(place))


def _few(rows: DataFrame, name: str) -> list[str | None] | None:
    """All texts of a column, if a lookup can number them."""
    found = [r[0] for r in rows.select(name).distinct().limit(NUMBERS + 1).collect()]
    return found if len(found) <= NUMBERS else None


def channel_lookup(orders: DataFrame, priorities: Sequence[str | None] = PRIORITIES) -> DataFrame | None:
    """``key_lookup`` of the place of each order's priority."""
    return key_lookup(orders, "o_orderkey", _place_in("o_orderpriority", priorities))


def with_channels(spark: SparkSession, sf_dir: str, lines: DataFrame, priorities: Sequence[str | None] = PRIORITIES) -> DataFrame:
    """Lines of known orders with ``channel_no``, the place of their order's priority in ``priorities``."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    lookup = channel_lookup(orders, priorities)
    if lookup is None:
        numbers = orders.select("o_orderkey", _place_in("o_orderpriority", priorities).alias("channel_no"))
        return lines.join(numbers, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    return looked_up(lines, lookup, "l_orderkey", "channel_no")


def with_priorities(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines of known orders with ``o_orderpriority``, whatever texts there are.

    A lookup holds their places among all priorities; more than it can number are joined.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    found = _few(orders, "o_orderpriority")
    if found is None:
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    named = with_channels(spark, sf_dir, lines, found).withColumn("o_orderpriority", _named(found, "channel_no"))
    return named.drop("channel_no")


def of_known_parts(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines whose part is known."""
    part = table(spark, sf_dir, "part").select("p_partkey")
    lookup = key_lookup(part, "p_partkey", F.lit(0))
    if lookup is None:
        return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
    return looked_up(lines, lookup, "l_partkey", "part_no").drop("part_no")


def with_regions(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines of known suppliers with their region."""
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    places = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "r_name")
    )
    # written, as the planner takes the size of unwritten joins for the product of their sides
    places = cut_lineage(places)
    return lines.join(places, F.col("l_suppkey") == F.col("s_suppkey"))


def with_parts(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines of known parts with ``p_type`` and ``p_retailprice``.

    Parts are broadcast as they are or, if they are too many for that, as a lookup with the
    prices of 128 consecutive keys in a row. More than that, repeated keys, or more types
    than a lookup can number are joined.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    same = F.col("l_partkey") == F.col("p_partkey")
    if part.count() * PART_ROW <= BROADCAST_BYTES:
        return lines.join(F.broadcast(part), same).drop("p_partkey")
    types = _few(part, "p_type")
    lookup = None if types is None else key_lookup(part, "p_partkey", _place_in("p_type", types))
    if lookup is None or lookup.count() * (LOOKUP_ROW + PRICES_ROW) > BROADCAST_BYTES:
        return lines.join(part, same).drop("p_partkey")
    in_block = (1 << BLOCK_BITS) - 1
    key = F.col("p_partkey")
    priced = F.map_from_entries(F.collect_list(F.struct(key.bitwiseAND(in_block).cast("int"), "p_retailprice")))
    prices = (
        part.filter(key.isNotNull())
        .groupBy(F.shiftright(key, BLOCK_BITS).alias("block"))
        .agg(priced.alias("priced"))
        .select("block", F.transform(F.sequence(F.lit(0), F.lit(in_block)), lambda i: F.try_element_at("priced", i)).alias("prices"))
    )
    found = looked_up(lines, cut_lineage(lookup.join(prices, "block")), "l_partkey", "type_no")
    price = F.get("prices", F.col("l_partkey").bitwiseAND(in_block).cast("int"))
    return found.withColumns({"p_type": _named(types, "type_no"), "p_retailprice": price}).drop("type_no", "prices")


def placed_lines(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines with their part and their region."""
    return with_regions(spark, sf_dir, with_parts(spark, sf_dir, lines))


def sales_lines(spark: SparkSession, sf_dir: str, columns: Mapping[str, Column]) -> DataFrame:
    """Line items of known parts with their order's priority and their region.

    ``columns`` are computed from the line items before these are joined, so that what a
    large table shuffles is days, flags and whole cents, not the timestamps, texts and
    doubles that they stand for.
    """
    lines = with_priorities(spark, sf_dir, _narrow_lines(spark, sf_dir, columns))
    return with_regions(spark, sf_dir, of_known_parts(spark, sf_dir, lines))


def _narrow_lines(spark: SparkSession, sf_dir: str, columns: Mapping[str, Column]) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", *[c.alias(name) for name, c in columns.items()])


def monthly_cpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, cpi): mean order value in whole units; one row per calendar month."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.trunc("o_orderdate", "month").alias("month"))
        .agg(F.floor(F.sum(money("o_totalprice")).cast("double") / F.count("*")).cast("double").alias("cpi"))
    )


def panel_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (date, region, category) with sales, price, promo, cpi and channels.

    Cells a channel has no line for are null.
    """
    lines = {
        "date": F.to_date("l_shipdate"),
        "price": money("l_extendedprice"),
        "quantity": money("l_quantity"),
        "tax": money("l_tax", 4),
        # a number as the aggregate: a text buffer would force a sort-based aggregate
        "promo": (F.col("l_discount") >= 0.08).cast("int"),
        "returned": F.col("l_returnflag") == "A",
    }
    columns = [
        F.sum("price").cast("double").alias("sales_revenue"),
        F.sum("quantity").cast("double").alias("sales_qty"),
        F.max("p_retailprice").alias("price_or_unitmargin"),
        F.when(F.max("promo") == 1, "Yes").otherwise("No").alias("promo_offer_flag"),
    ]
    for number, (_, _, ch) in enumerate(CHANNELS):
        mine = F.col("channel_no") == number
        columns += [
            F.sum(F.when(mine, F.col("price") * F.col("tax"))).cast("double").alias(f"{ch}_spend"),
            F.sum(F.when(mine, F.col("quantity"))).cast("double").alias(f"{ch}_impressions"),
            F.sum(F.when(mine, 1)).alias(f"{ch}_clicks"),
            F.sum(F.when(mine & F.col("returned"), 1)).alias(f"{ch}_conversions"),
        ]
    panel = (
        placed_lines(spark, sf_dir, with_channels(spark, sf_dir, _narrow_lines(spark, sf_dir, lines)))
        .groupBy("date", F.col("r_name").alias("region"), F.col("p_type").alias("category"))
        .agg(*columns)
    )
    rates = {f"{ch}_conversion_perc": F.col(f"{ch}_conversions") / F.col(f"{ch}_clicks") for _, _, ch in CHANNELS}
    return (
        panel.withColumns(rates)
        .join(monthly_cpi(spark, sf_dir), F.trunc("date", "month") == F.col("month"), "left")
        .drop("month")
    )


def panel_catalog(spark: SparkSession) -> DataFrame:
    """Catalogue of ``panel_daily``."""
    rows = [
        ("Date", "Date", "Date", "x", "No"),
        ("Sales_Qty", "Absolute", "Sales", "x", "No"),
        ("Sales_Revenue", "Absolute", "Sales", "x", "No"),
        ("Price_OR_UnitMargin", "Absolute", "Price", "x", "No"),
        ("Region", "Categorical", "Grain", "x", "No"),
        ("Category", "Categorical", "Grain", "x", "No"),
        ("Promo_Offer_Flag", "Binary", "Promo", "x", "No"),
        ("CPI", "Rate", "Macro", "x", "Yes"),
    ]
    for _, channel, ch in CHANNELS:
        rows += [
            (f"{ch}_spend", "Absolute", "Spend", channel, "No"),
            (f"{ch}_impressions", "Absolute", "Response", channel, "No"),
            (f"{ch}_clicks", "Absolute", "Response", channel, "No"),
            (f"{ch}_conversions", "Absolute", "Response", channel, "No"),
            (f"{ch}_conversion_perc", "Percentage", "Response", channel, "No"),
        ]
    return catalog_frame(spark, rows)


def supplier_catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue as a careless supplier would send it, one channel per medium and supplier.

    A field for every (priority, supplier, line number) that was sold.  Every 37th
    supplier leaves the type out, every 41st makes one up, every 43rd has ``maybe`` for
    the sign; case and spaces vary.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    sold = with_priorities(spark, sf_dir, lines).select("o_orderpriority", "l_suppkey", "l_linenumber").distinct()
    medium = F.element_at(F.create_map(*[F.lit(v) for p, c, _ in CHANNELS for v in (p, c)]), F.col("o_orderpriority"))

    def of_measure(place: int) -> Column:
        return F.element_at(F.create_map(*[F.lit(v) for m in MEASURES for v in (m[0], m[place])]), F.col("l_linenumber"))

    supplier = F.col("l_suppkey")
    known = sold.filter(F.col("l_linenumber").isin([m[0] for m in MEASURES])).select(
        supplier,
        (F.substring("o_orderpriority", 1, 1).cast("long") * 10_000_000_000 + supplier * 10 + F.col("l_linenumber")).alias("pos"),
        F.concat(medium, F.lit(" s"), supplier.cast("string")).alias("name"),
        of_measure(1).alias("measure"),
        of_measure(2).alias("type"),
        of_measure(3).alias("category"),
    )
    return known.select(
        "pos",
        F.concat(F.lit(" "), F.initcap("name"), F.lit(" "), F.col("measure")).alias("label"),
        F.concat(F.replace("name", F.lit(" "), F.lit("_")), F.lit("_"), F.col("measure")).alias("field_name"),
        F.when(supplier % 37 == 0, F.lit(None)).when(supplier % 41 == 0, "Ratio").otherwise(F.concat(F.col("type"), F.lit(" "))).alias("data_type"),
        F.upper("category").alias("data_category"),
        F.when(supplier % 50 == 0, "x").otherwise(F.initcap("name")).alias("channel"),
        F.when(supplier % 43 == 0, "maybe").otherwise("No").alias("can_be_negative"),
    )


def supplier_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the supplier catalogue that keep the contract, normalised."""
    raw = supplier_catalog_raw(spark, sf_dir).filter(
        F.col("data_type").isNotNull() & (F.col("data_type") != "Ratio") & (F.col("can_be_negative") != "maybe")
    )
    return normalize_catalog(raw)


def site_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (date, region_id) of site events."""

    def happened(kind: str) -> Column:
        return F.sum(F.when(F.col("event_type") == kind, 1))

    def worth(kind: str) -> Column:
        return F.sum(F.when(F.col("event_type") == kind, money("value"))).cast("double")

    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("date"), (F.col("user_id") % 3).cast("int").alias("region_id"))
        .agg(
            happened("view").alias("site_impressions"),
            happened("click").alias("site_clicks"),
            happened("purchase").alias("site_conversions"),
            worth("purchase").alias("sales_revenue"),
            worth("signup").alias("site_spend"),
        )
    )


def solution_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with segment (region), solution id (order key mod 20) and channel."""
    lines = {
        "date": F.trunc("l_shipdate", "month"),
        "l_linenumber": F.col("l_linenumber"),
        "l_returnflag": F.col("l_returnflag"),
        "price": money("l_extendedprice", 18),
        "quantity": money("l_quantity", 18),
        "discount": money("l_discount", 4),
    }
    return sales_lines(spark, sf_dir, lines).select(
        F.col("r_name").alias("segment"),
        F.concat(F.lit("s"), (F.col("l_orderkey") % 20).cast("string")).alias("sol_id"),
        F.col("o_orderpriority").alias("channel"),
        *lines,
    )


def solution_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel decomposition rows: (segment, sol_id, channel) with effect, spend and shares."""
    lines = solution_lines(spark, sf_dir)
    effect = F.sum("price").cast("double")
    spend = F.sum("quantity").cast("double")
    carry = F.avg(F.col("l_linenumber").cast("double"))
    return lines.groupBy("segment", "sol_id", "channel").agg(
        (effect / spend / 1000).alias("roi_total"),
        effect.alias("effect"),
        spend.alias("spend"),
        carry.alias("mean_carryover"),
        (carry * 2).alias("mean_spend_adstocked"),
    )


def solution_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long decomposition: (segment, sol_id, date, component, value).

    Lines 1-3 are paid media of their order's priority, the rest baseline components;
    ``dep_var`` and ``depVarHat`` are components of their own.
    """
    lines = solution_lines(spark, sf_dir)
    price = F.col("price")
    hat = price * (1 - F.col("discount"))
    base = F.concat(F.lit("base_"), F.lower("l_returnflag"))
    rows = F.array(
        F.struct(F.when(F.col("l_linenumber") <= 3, F.col("channel")).otherwise(base).alias("component"), hat.alias("value")),
        F.struct(F.lit("dep_var").alias("component"), price.cast("decimal(38,4)").alias("value")),
        F.struct(F.lit("depVarHat").alias("component"), hat.alias("value")),
    )
    return (
        lines.select("segment", "sol_id", "date", F.inline(rows))
        .groupBy("segment", "sol_id", "date", "component")
        .agg(F.sum("value").cast("double").alias("value"))
    )
