"""Source tables in the shape the library expects, derived from the driver tables.

Nations stand for the units of a panel, order flows from a supplier's nation to
a customer's nation for directed pairs, single orders and line items for raw
event records. Gaps are injected by key residues, since the driver tables have
none. ``oracle.py`` states the same views in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polyad.operators.grid import complete_grid
from polyad.operators.joins import key_join
from polyad.operators.schema import inline_table
from polyad.session import stage, stages
from polyad.sources.tables import read_landed

FIRST_YEAR, LAST_YEAR = 1993, 2003

# Schemas of the driver tables.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Number columns of the driver tables, which hold no NaN; filters on them reach the scan.
NAN_FREE = (
    "c_acctbal", "s_acctbal", "o_totalprice", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "value",
)

# Intervals of bloc membership, 9999 is open; unit 9 has two of them.
ROSTER = [
    (6, 1996, 9999),
    (7, 1997, 1999),
    (9, 1997, 1998),
    (9, 1998, 2000),
    (12, 1999, 9999),
    (15, 2001, 2002),
    (40, 1995, 9999),
]
REGION = (5, 20)
ELIGIBLE_FROM = 1996

# Code overrides; one joins two codes, one drops a code.
CODE_OVERRIDES = {"NATION_24": 23, "NATION_13": None}
NAME_OVERRIDES = {"Rep. NATION_5": 4, "Rep. NATION_6": None}
NAME_PATTERNS = [(rf"NATION_{k}$", k) for k in range(24)] + [("^Rep. NATION_2$", 99)]


def nulled(value: Column, where: Column) -> Column:
    return F.when(~where, value)


def landed(view: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    """Write a view that a query reads several times once per query, like a source file."""

    @wraps(view)
    def once(self: Views) -> DataFrame:
        if view.__name__ not in self.written:
            self.written[view.__name__] = stage(view(self), view.__name__)
        return self.written[view.__name__]

    return once


class Views:
    """Views of one query call; nothing written is shared between calls."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.written: dict[str, DataFrame] = {}

    def contained(self, build: Callable[[], DataFrame], name: str) -> DataFrame:
        """A stage table of what ``build`` returns; whatever was landed or staged for it goes once it is written."""
        with stages(self.spark) as inside:
            kept = inside.keep(build(), name)
        self.written.clear()
        return kept

    def table(self, name: str) -> DataFrame:
        return read_landed(self.spark, f"{self.sf_dir}/{name}.parquet", SCHEMAS[name], keep_nan=NAN_FREE)

    # -- event records ----------------------------------------------------

    def unit_orders(self) -> DataFrame:
        orders, customer = self.table("orders"), self.table("customer")
        return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("c_nationkey").alias("u"),
            F.year("o_orderdate").alias("y"),
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "o_totalprice",
            "o_orderpriority",
            "c_mktsegment",
            F.to_date("o_orderdate").alias("o_day"),
        )

    def links(self) -> DataFrame:
        return self.written.get("links") or self.build_links()

    def land_links(self) -> None:
        """Write the line-item rows once, for queries that read them as several sources."""
        if "links" not in self.written:
            self.written["links"] = stage(self.build_links(), "links")

    def build_links(self) -> DataFrame:
        """One row per line item: supplier nation a, customer nation b, ship year."""
        buyers = (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_orderkey").alias("l_orderkey"), F.col("c_nationkey").alias("b"))
        )
        sellers = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("a"))
        items = self.table("lineitem").select(
            "l_orderkey",
            "l_suppkey",
            F.year("l_shipdate").alias("y"),
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
            "l_returnflag",
            "l_linestatus",
        )
        return items.join(sellers, "l_suppkey").join(buyers, "l_orderkey").drop("l_suppkey")

    @landed
    def flows(self) -> DataFrame:
        return self.links().groupBy("a", "b", "y").agg(
            F.count("*").alias("n_links"),
            F.sum("l_extendedprice").alias("value"),
            F.sum("l_quantity").alias("quantity"),
        )

    def disputes(self) -> DataFrame:
        unknown = (F.col("a") + F.col("y")) % 7 == 0
        quantity = F.col("l_quantity").cast("int")
        return self.links().select(
            F.col("a").alias("statea"),
            F.col("b").alias("stateb"),
            F.col("y").alias("year"),
            F.col("l_linenumber").alias("dyad_rolea"),
            F.when(unknown | (F.col("l_returnflag") == "N"), -9).otherwise(1 + quantity % 5).alias("hihosta"),
            F.when(unknown | (F.col("l_linestatus") == "F"), -9).otherwise(quantity % 7).alias("fatlev"),
        )

    def trade(self) -> DataFrame:
        flows = self.flows()
        totals = flows.groupBy("a", "y").agg(F.sum("value").alias("all_value"), F.sum("quantity").alias("all_quantity"))
        shares = key_join(flows, totals, ["a", "y"], null_safe=False)
        gap = (F.col("a") + F.col("b") + F.col("y")) % 9 == 0
        return shares.select(
            F.col("a").alias("exporter_cow"),
            F.col("b").alias("importer_cow"),
            F.col("y").alias("year"),
            (100 * F.col("value") / F.col("all_value")).alias("RED_export_importance"),
            nulled(100 * F.col("quantity") / F.col("all_quantity"), gap).alias("RED_import_importance"),
        )

    def alliances(self) -> DataFrame:
        n = F.col("n_links")
        return self.flows().select(
            F.col("a").alias("stateA"),
            F.col("b").alias("stateB"),
            F.col("y").alias("year"),
            (n % 2).cast("int").alias("defense"),
            F.when(n % 3 == 0, 1).otherwise(0).alias("offense"),
            F.when(n % 5 == 0, 1).otherwise(0).alias("nonagg"),
            F.when(n % 7 != 0, (n % 2).cast("int")).alias("consul"),
        )

    def influence(self) -> DataFrame:
        """Pair rows keyed by text codes."""
        code = lambda c: F.concat(F.lit("NATION_"), F.col(c).cast("string"))
        return self.flows().select(
            code("a").alias("iso3a"), code("b").alias("iso3b"), F.col("y").alias("year"), F.col("n_links").alias("influence")
        )

    # -- unit-year tables -------------------------------------------------

    @landed
    def measures(self) -> DataFrame:
        return self.unit_orders().groupBy("u", "y").agg(
            F.count("*").alias("n"), F.avg("o_totalprice").alias("avg_price"), F.sum(F.col("o_orderkey") % 1000).alias("k")
        )

    def crosswalk(self) -> DataFrame:
        nation = self.table("nation")
        return nation.where("n_nationkey <> 24").select(F.col("n_name").alias("code"), F.col("n_nationkey").alias("unit"))

    def panel(self) -> DataFrame:
        """Every nation in every year of the window, also years without orders."""
        nation = self.table("nation").select(F.col("n_nationkey").alias("COWcode"), F.col("n_name").alias("country_name"))
        measures = self.measures().select(F.col("u").alias("COWcode"), F.col("y").alias("year"), "n")
        grid = complete_grid(measures, "COWcode", "year", FIRST_YEAR, LAST_YEAR)
        joined = key_join(grid, nation, ["COWcode"], null_safe=False)
        u, y, n = F.col("COWcode"), F.col("year"), F.col("n")
        return joined.select(
            "COWcode",
            "year",
            "country_name",
            nulled(((n * 37 + u * 11 + y * 7) % 101) / 100, (u + y) % 6 == 0).alias("v2x_libdem"),
            nulled(((n * 13 + u * 5 + y * 3) % 97) / 96, (u + y * 2) % 5 == 0).alias("v2x_corr"),
            nulled(((n * 53 + u * 29 + y * 17) % 4001) / 1000 - 2, (u * 3 + y) % 8 == 0).alias("v2exl_legitideol"),
            nulled(((n * 19 + u * 7 + y) % 1000) / 10, (u + y) % 11 == 0).alias("islmgenpct"),
            nulled(((n * 23 + u * 3 + y) % 1000) / 10, (u + y) % 13 == 0).alias("chrstgenpct"),
        )

    def roster(self) -> DataFrame:
        return inline_table(self.spark, "COWcode int, start_year int, end_year int", ROSTER)

    def ideology(self) -> DataFrame:
        latest = self.unit_orders().groupBy("u", "y").agg(
            F.max_by("o_orderpriority", "o_orderkey").alias("priority"), F.max_by("c_mktsegment", "o_orderkey").alias("segment")
        )
        label = lambda c, *names: F.when(
            F.col(c) == names[0], "leftist"
        ).when(F.col(c) == names[1], "centrist").when(F.col(c) == names[2], "rightist").when(F.col(c) == names[3], "no information")
        return latest.select(
            F.when(F.col("u") != 3, F.col("u")).alias("country_code_cow"),
            F.col("y").alias("year"),
            label("priority", "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED").alias("leader_ideology"),
            label("segment", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD").alias("hog_ideology"),
        )

    def history(self) -> DataFrame:
        return self.unit_orders().select(
            F.concat(F.lit("NATION_"), F.col("u").cast("string")).alias("countrycode"),
            F.col("y").alias("year"),
            nulled(F.col("o_totalprice") / 7, F.col("o_orderkey") % 5 == 0).alias("gdppc"),
            (F.col("o_orderkey") % 1000).cast("double").alias("pop"),
        )

    def economy(self) -> DataFrame:
        u, y, n = F.col("u"), F.col("y"), F.col("n")
        return self.measures().select(
            F.concat(F.lit("NATION_"), u.cast("string")).alias("iso2c"),
            y.alias("year"),
            nulled(F.col("avg_price") / 7, (u + y) % 3 == 0).alias("NY.GDP.PCAP.PP.KD"),
            nulled((n * 1000).cast("double"), (u * 2 + y) % 5 == 0).alias("SP.POP.TOT"),
            nulled(((n * 17 + u) % 31).cast("double"), (u + y) % 4 == 0).alias("NY.GDP.TOTL.RT.ZS"),
        )

    def governance(self) -> DataFrame:
        u, y, n = F.col("u"), F.col("y"), F.col("n")
        return self.measures().select(
            F.concat(F.lit("NATION_"), u.cast("string")).alias("iso2c"),
            y.alias("year"),
            nulled(((n * 7 + y) % 501) / 100 - 2.5, (u + y) % 3 != 0).alias("CC.EST"),
            nulled(((n * 11 + y) % 501) / 100 - 2.5, (u * 5 + y) % 4 < 2).alias("GE.EST"),
        )

    def named_orders(self) -> DataFrame:
        """Order records that name their unit in two spellings."""
        plain = F.concat(F.lit("NATION_"), F.col("u").cast("string"))
        name = F.when(F.col("o_orderkey") % 2 == 0, plain).otherwise(F.concat(F.lit("Rep. "), plain))
        return self.unit_orders().select(name.alias("name"), F.col("y").alias("year"), "o_orderkey", "o_totalprice")

    # -- spells and series ------------------------------------------------

    def spells(self) -> DataFrame:
        """One spell per order, from the order day to its last shipment; some run backwards."""
        shipped = self.table("lineitem").groupBy("l_orderkey").agg(F.to_date(F.max("l_shipdate")).alias("enddate"))
        orders = self.unit_orders().join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        return orders.select(
            F.col("u").alias("ccode"),
            F.concat(F.lit("L"), customer.cast("string")).alias("leader"),
            key.cast("string").alias("leadid"),
            F.col("o_day").alias("startdate"),
            "enddate",
            F.when(F.col("o_orderpriority") == "1-URGENT", "Irregular")
            .when(F.col("o_orderpriority") != "5-LOW", "Regular")
            .alias("entry"),
            F.col("o_orderstatus").alias("exit"),
            (key % 5).cast("int").alias("exitcode"),
            (key % 3).cast("int").alias("posttenurefate"),
            F.when(customer % 3 == 0, "F").when(customer % 3 == 1, "M").alias("gender"),
            F.when(customer % 11 != 0, 1930 + customer % 40).cast("int").alias("yrborn"),
            (key % 4).cast("int").alias("prevtimesinoffice"),
        )

    def sparse_shares(self) -> DataFrame:
        """Customer series of all years with orders, observed every third year."""
        per_year = self.table("orders").groupBy(F.col("o_custkey").alias("COWcode"), F.year("o_orderdate").alias("year")).agg(
            F.sum(F.col("o_orderkey") % 97).alias("s"), F.count("*").alias("n")
        )
        wave = (F.col("year") - 1995) % 3 == 0
        return per_year.select(
            "COWcode",
            "year",
            F.when(wave, (F.col("s") % 100).cast("double")).alias("islmgenpct"),
            F.when(wave & (F.col("n") != 2), (F.col("s") * 3 % 100).cast("double")).alias("chrstgenpct"),
        )

    def daily(self) -> DataFrame:
        """Event totals per user and day number."""
        day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
        return self.table("events").groupBy("user_id", day.alias("day")).agg(
            F.count("*").alias("n_events"), F.round(F.sum("value"), 4).alias("value")
        )

    def capitals(self) -> DataFrame:
        """Two capitals per nation, the second valid from 1998 on; nation 5 has none before, nation 3 has both in 1998 and 1999."""
        key = F.col("n_nationkey")
        nation = self.table("nation")

        def capital(first: str, last: str, shift: int) -> Column:
            return F.struct(
                F.lit(first).cast("date").alias("valid_from"),
                F.lit(last).cast("date").alias("valid_to"),
                ((key * 7 + shift) % 140 - 70).cast("double").alias("lat"),
                ((key * 31 + shift) % 340 - 170).cast("double").alias("lon"),
            )

        return (
            nation.select(
                key.alias("COWcode"),
                F.inline(F.array(capital("1900-01-01", "1997-12-31", 0), capital("1998-01-01", "2100-12-31", 13))),
            )
            .withColumn("valid_to", F.when((F.col("COWcode") == 3) & (F.year("valid_to") == 1997), F.lit("1999-12-31").cast("date")).otherwise(F.col("valid_to")))
            .where(~((F.col("COWcode") == 5) & (F.col("valid_to") < F.lit("1998-01-01").cast("date"))))
        )
