"""Film items rendered from the driver tables, so the whole flow
(items -> cleaning -> star schema -> reports) runs on data that grows with
the tables.

  film item     one per order: title 'Order <o_orderkey>', box office and
                release date rendered as messy text whose clean value is
                known exactly (o_totalprice in millions, o_orderdate), budget
                as plain dollars; no box office when o_orderstatus = 'P'
  actor         one per line: the supplier's name, case and trailing
                spaces varied by line number (one canonical key)
  director      one per order: the customer's name, upper-cased for open
                orders
  distributor   one per line: the supplier's nation name, case varied
  prod_co       one per line: the part name; bracketed (junk, dropped) for
                p_size <= 3, with a leading ', ' for p_size 4..6

seq orders items by order, line and kind: films come first, then their
credits in line order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ACTOR, CHILD_KINDS, DIRECTOR, DISTRIBUTOR, MOVIE, PROD_CO, item_seq
from ..sources.tables import table

KIND_INDEX = {MOVIE: 0, ACTOR: 1, DIRECTOR: 2, DISTRIBUTOR: 3, PROD_CO: 4}


def _title(orderkey: Column) -> Column:
    return F.concat(F.lit("Order "), orderkey.cast("string"))


def order_seq(orderkey: Column, line: Column | int, kind: str) -> Column:
    return item_seq(orderkey, 0, line * 10 + F.lit(KIND_INDEX[kind]))


def render_box_office(price: Column, priority: Column) -> Column:
    """o_totalprice (millions) as text, style by o_orderpriority; every
    style parses back to exactly the price."""
    p = price.cast("decimal(12,2)")
    return (
        F.when(priority == "1-URGENT", F.concat(F.lit("$"), F.format_number(p, 2), F.lit(" million")))
        .when(priority == "2-HIGH", F.concat(F.lit("US$"), p.cast("string"), F.lit("\\xa0Million")))
        .when(priority == "3-MEDIUM", F.concat(F.lit("$"), (p - 1).cast("string"), F.lit("–"),
                                               (p + 1).cast("string"), F.lit(" million")))
        .when(priority == "4-NOT SPECIFIED",
              F.concat(F.lit("$"), (p * F.lit(0.001).cast("decimal(4,3)")).cast("string"), F.lit(" billion")))
        .otherwise(F.concat(F.lit("$"), F.format_number(p * F.lit(1000000), 0), F.lit(" (worldwide)")))
    )


def render_release_date(d: Column) -> Column:
    """o_orderdate as text, style by day of week; every style parses back to
    the date, except 'Month yyyy', which parses to the 1st of the month.
    The last style puts a no-break space after the month."""
    dow = F.dayofweek(d)
    return (
        F.when(dow == 1, F.date_format(d, "MMMM d, yyyy"))
        .when(dow == 2, F.concat(F.date_format(d, "d MMMM yyyy"), F.lit(" (United States)")))
        .when(dow == 3, F.date_format(d, "yyyy-MM-dd"))
        .when(dow == 4, F.date_format(d, "MMM d, yyyy"))
        .when(dow == 5, F.date_format(d, "MMMM yyyy"))
        .when(dow == 6, F.date_format(d, "yyyy/M/d"))
        .otherwise(F.concat(F.date_format(d, "MMMM"), F.lit("\u00a0"), F.date_format(d, "d, yyyy"),
                            F.lit(" (premiere)")))
    )


def _varied_case(name: Column, line: Column) -> Column:
    return (
        F.when(line == 2, F.upper(name))
        .when(line == 3, F.concat(name, F.lit("  ")))
        .when(line == 4, F.lower(name))
        .otherwise(name)
    )


def _credit(seq: Column, film: Column, kind: str, value: Column) -> list[Column]:
    return [
        seq.alias("seq"),
        F.lit(None).cast("bigint").alias("page_id"),
        film.alias("film"),
        F.lit(kind).alias("kind"),
        value.alias("value"),
    ]


def driver_items(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = CHILD_KINDS) -> tuple[DataFrame, DataFrame]:
    """(film items, credit items) (schema.FILM_ITEMS, schema.CREDIT_ITEMS)
    over whole driver tables. Of other kinds than `kinds` no credit item is
    rendered: a filter on kind would come after the rendering of all."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                          "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    lineitem = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    supplier = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")

    film = _title(F.col("o_orderkey"))
    films = orders.select(
        order_seq(F.col("o_orderkey"), 0, MOVIE).alias("seq"),
        F.lit(None).cast("bigint").alias("page_id"),
        film.alias("film"),
        F.concat(F.lit("$"), F.format_number(F.col("o_totalprice") * 10, 1)).alias("budget"),
        F.when(F.col("o_orderstatus") != "P",
               render_box_office(F.col("o_totalprice"), F.col("o_orderpriority"))).alias("box_office"),
        render_release_date(F.to_date("o_orderdate")).alias("release_date"),
    )
    directors = orders.join(customer, orders.o_custkey == customer.c_custkey).select(*_credit(
        order_seq(F.col("o_orderkey"), 0, DIRECTOR), film, DIRECTOR,
        F.when(F.col("o_orderstatus") == "O", F.upper("c_name")).otherwise(F.col("c_name")),
    ))

    lines = (
        lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(part, lineitem.l_partkey == part.p_partkey)
    )
    lfilm = _title(F.col("l_orderkey"))
    line, key = F.col("l_linenumber"), F.col("l_orderkey")
    p_name, p_size = F.col("p_name"), F.col("p_size")
    prod = (F.when(p_size <= 3, F.concat(F.lit("("), p_name, F.lit(")")))
            .when(p_size <= 6, F.concat(F.lit(", "), p_name))
            .otherwise(p_name))
    values = {ACTOR: _varied_case(F.col("s_name"), line), DISTRIBUTOR: _varied_case(F.col("n_name"), line), PROD_CO: prod}
    of_line = [_credit(order_seq(key, line, kind), lfilm, kind, value) for kind, value in values.items() if kind in kinds]
    if len(of_line) == 1:
        credits = [lines.select(*of_line[0])]
    else:
        credits = [lines.select(F.explode(F.array(*[F.struct(*c) for c in of_line])).alias("i")).select("i.*")] if of_line else []
    return films, reduce(DataFrame.unionByName, [directors] * (DIRECTOR in kinds) + credits)
