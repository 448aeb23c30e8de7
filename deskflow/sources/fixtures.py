"""Adapters from the generated star-schema test tables to warehouse shapes.

The test data ships order/lineitem style tables; these functions derive the
service-desk dimensions, facts and raw (dirty) sources from them, planting
what the analytics must cope with: nulls, unresolved rows, orphans,
duplicate keys, placeholder text and bad dates.  ``ASIA`` plays the home
country.  Each adapter is a lazy DataFrame over the parquet scan, so column
pruning and filters reach the files.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from deskflow import schemas
from deskflow.functions.temporal import add_minutes
from deskflow.functions.util import local_rows

HOME_COUNTRY = "ASIA"
REPEAT_STEP = 10_000_000_000_000  # added to an incident id for each repeat of its order line

# Footer schemas of the test tables by path (read-only inputs).
_SCHEMAS: dict[str, object] = {}

RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "labels", "conversations"]


def _case(value, cases: dict, default=None):
    out = F.lit(default)
    for k, v in reversed(list(cases.items())):
        out = F.when(value == k, F.lit(v)).otherwise(out)
    return out


class Warehouse:
    """Lazy adapters over one folder of parquet test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """The parquet table ``name``; read once per warehouse, with the footer
        schema remembered per path so later reads skip the footer."""
        if name not in self._raw:
            path = f"{self.sf_dir}/{name}.parquet"
            schema = _SCHEMAS.get(path)
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            df = reader.parquet(path)
            _SCHEMAS.setdefault(path, df.schema)
            self._raw[name] = df
        return self._raw[name]

    # ---------------------------------------------------------------- dims
    @cached_property
    def dim_region(self) -> DataFrame:
        n, r = self.raw("nation"), self.raw("region")
        return (n.join(r, n.n_regionkey == r.r_regionkey)
                .select(F.col("n_nationkey").alias("region_id"), F.col("n_name").alias("region_name"),
                        F.col("r_name").alias("country")))

    def _nation_region(self) -> DataFrame:
        n, r = self.raw("nation"), self.raw("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")

    @cached_property
    def dim_client(self) -> DataFrame:
        c = self.raw("customer")
        k, bal = F.col("c_custkey"), F.col("c_acctbal")
        return (c.join(self._nation_region(), c.c_nationkey == F.col("n_nationkey"))
                .select(
                    k.alias("client_id"), F.col("c_name").alias("client_name"),
                    F.when(k % 31 != 0, F.col("c_mktsegment")).alias("industry"),
                    F.when(bal < 0, "Small").when(bal < 5000, "Medium").otherwise("Large").alias("size_segment"),
                    F.col("r_name").alias("hq_country"), F.col("n_name").alias("region_group"),
                    F.when(bal < 2500, "Bronze").when(bal < 6000, "Silver").otherwise("Gold").alias("contract_tier"),
                    bal.cast("decimal(10,2)").alias("monthly_contract_value"),
                    (F.lit(99) + (k % 10) * F.lit(Decimal("0.1"))).cast("decimal(5,2)").alias("sla_uptime_target"),
                    (15 + 15 * (k % 4)).cast("int").alias("response_time_sla_min"),
                    (240 * (1 + k % 6)).cast("int").alias("resolution_time_sla_min"),
                    (500 + 250 * (k % 5)).cast("decimal(10,2)").alias("penalty_per_breach"),
                    F.date_add(F.lit("2020-01-01").cast("date"), (k % 365).cast("int")).alias("contract_start"),
                    F.date_add(F.lit("2023-01-01").cast("date"), (k % 365).cast("int")).alias("contract_end"),
                ))

    @cached_property
    def dim_site(self) -> DataFrame:
        s = self.raw("supplier")
        k = F.col("s_suppkey")
        return (s.join(self._nation_region(), s.s_nationkey == F.col("n_nationkey"))
                .select(
                    k.alias("site_id"), k.alias("client_id"), F.col("s_name").alias("site_name"),
                    F.col("r_name").alias("country"), F.col("n_name").alias("state_region"),
                    F.col("n_name").alias("city"), F.col("s_nationkey").alias("region_id"),
                    (k * 37 % 180 - 90).cast("decimal(9,6)").alias("latitude"),
                    (k * 53 % 360 - 180).cast("decimal(9,6)").alias("longitude"),
                    _case(k % 3, {0: "HQ", 1: "Branch"}, "DC").alias("site_type"),
                ))

    @cached_property
    def dim_agent(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("agent_id"), F.col("p_name").alias("agent_name"),
            F.col("p_brand").alias("assignment_group"), F.col("p_type").alias("team"))

    @cached_property
    def dim_priority(self) -> DataFrame:
        return local_rows(self.spark, schemas.PRIORITY_ROWS, schemas.DIM_PRIORITY.simpleString())

    # --------------------------------------------------------------- facts
    @cached_property
    def fact_ticket(self) -> DataFrame:
        o = self.raw("orders")
        k = F.col("o_orderkey")
        # Some clients stay without tickets: their orders go to a neighbour.
        cust = F.when(F.col("o_custkey") % 20 == 3, F.col("o_custkey") - 1).otherwise(F.col("o_custkey"))
        open_ = k % 11 == 0
        created = add_minutes("o_orderdate", (k * 37 % 1440).cast("int"))
        rmin, smin = (k * 53 % 61).cast("int"), (k * 101 % 4320).cast("int")
        return o.select(
            k.alias("ticket_id"), cust.alias("client_id"),
            F.when(k % 97 != 0, k % 10).alias("site_id"), (k % 200).alias("agent_id"),
            _case(F.substring("o_orderpriority", 1, 1), {"1": 1, "2": 2, "5": 4}, 3).cast("int").alias("priority_id"),
            created.alias("created_at"),
            add_minutes(created, rmin).alias("first_response_at"),
            F.when(~open_, add_minutes(created, rmin + smin)).alias("resolved_at"),
            F.when(~open_, add_minutes(created, rmin + smin + 15)).alias("closed_at"),
            F.when(open_, "Open").otherwise("Closed").alias("status"),
            F.lit(240).alias("expected_sla_resolve_min"), F.lit(30).alias("sla_first_response_min"),
            F.lit(180).alias("sla_resolution_min"),
            (1 + k % 9).cast("int").alias("agent_interactions"),
            F.when(k % 17 == 0, None).when(F.col("o_orderstatus") == "F", "Satisfied")
             .when(F.col("o_orderstatus") == "O", "Neutral").otherwise("Dissatisfied").alias("survey_results"),
        )

    def _lineitem_numbered(self) -> DataFrame:
        """Every lineitem with its occurrence number (0, 1, ...) among the
        rows of its order and line number, by a fixed column order; rows
        equal in all of it are interchangeable.  Partitions are as small as
        the repeats of one order line; sorting spills where they are not.
        Dealt by order, so that the join with the orders finds the rows in
        place."""
        key = ["l_orderkey", "l_linenumber"]
        order_cols = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
                      "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
        nth = F.row_number().over(Window.partitionBy(*key).orderBy(*order_cols)) - 1
        return self.raw("lineitem").repartition("l_orderkey").select(*key, *order_cols, nth.cast("long").alias("nth"))

    @cached_property
    def fact_incident(self) -> DataFrame:
        # Some clients stay without incidents: theirs go to a neighbour.
        cust = F.when(F.col("o_custkey") % 10 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
        o = self.raw("orders").select("o_orderkey", cust.alias("client_id"))
        li = self._lineitem_numbered()
        x = li.join(o, li.l_orderkey == o.o_orderkey)
        inc_id = F.col("l_orderkey") * 10 + F.col("l_linenumber") + F.col("nth") * REPEAT_STEP
        part, supp = F.col("l_partkey"), F.col("l_suppkey")
        opened = add_minutes("l_shipdate", (part * 37 % 1440).cast("int"))
        amin, hmin = (part * 53 % 61).cast("int"), (supp * 101 % 1440).cast("int")
        reassign = (F.col("l_linenumber") - 1).cast("int")
        return x.select(
            inc_id.alias("incident_id"), "client_id", supp.alias("site_id"),
            (1 + part % 4).cast("int").alias("priority_id"),
            opened.alias("opened_at"),
            add_minutes(opened, amin).alias("acknowledged_at"),
            F.when(inc_id % 13 != 0, add_minutes(opened, amin + (1 + reassign) * hmin)).alias("resolved_at"),
            F.when(F.col("l_linestatus") == "F", "closed").otherwise("resolved").alias("incident_state"),
            reassign.alias("reassignment_count"), (part % 3).cast("int").alias("reopen_count"),
            F.when(part % 50 == 0, None).when(F.col("l_returnflag") == "R", 0).otherwise(1).cast("int").alias("made_sla"),
        )

    @cached_property
    def fact_metrics(self) -> DataFrame:
        e = self.raw("events")
        eid, v = F.col("event_id"), F.col("value")
        return e.select(
            eid.alias("metric_id"), (F.col("user_id") % 10).alias("site_id"), F.col("ts").alias("timestamp_utc"),
            (eid * 11 % 101).cast("decimal(5,2)").alias("cpu_util_pct"),
            (eid * 7 % 101).cast("decimal(5,2)").alias("mem_util_pct"),
            (eid * 13 % 101).cast("decimal(5,2)").alias("link_util_pct"),
            v.cast("decimal(8,2)").alias("latency_ms"),
            (eid % 5).cast("decimal(5,2)").alias("packet_loss_pct"),
        )

    # ------------------------------------------------------- raw sources
    @cached_property
    def raw_incident(self) -> DataFrame:
        li = self.raw("lineitem")
        part, supp, ship = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_shipdate")
        two = lambda c: F.substring((100 + c).cast("string"), 2, 2)
        opened = F.concat(F.dayofmonth(ship).cast("string"), F.lit("/"), F.month(ship).cast("string"), F.lit("/"),
                          F.year(ship).cast("string"), F.lit(" "), (part % 24).cast("string"), F.lit(":"), two(part % 60))
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("number"),
            _case(part % 7, {0: " New ", 1: "-100", 2: "nat", 3: "7", 4: "6", 5: "Resolved"}).alias("incident_state"),
            _case(part % 5, {0: "1 - High", 1: "2 - Medium", 2: "3 - Low", 3: "?"}).alias("impact"),
            _case(supp % 4, {0: "1 - High", 1: "2 - Medium", 2: "3 - Low"}, "x").alias("urgency"),
            _case(part % 6, {0: "1 - Critical", 1: "2 - High", 2: "3 - Moderate", 3: "4 - Low", 4: "5 - None"}).alias("priority"),
            F.when(supp % 4 == 0, "?").otherwise(F.concat(F.lit("v"), supp.cast("string"))).alias("vendor"),
            F.when(part % 9 == 0, "?").otherwise(opened).alias("opened_at"),
            (F.col("l_returnflag") != "R").alias("made_sla"), (F.col("l_linestatus") == "O").alias("active"),
            (F.col("l_linenumber") - 1).alias("reassignment_count"),
            F.concat(F.lit("  Group "), (supp % 20).cast("string"), F.lit(" ")).alias("assignment_group"),
            F.lit(" EMail ").alias("contact_type"),
            F.col("l_quantity").alias("sys_mod_count"),
        )

    @cached_property
    def raw_ticket(self) -> DataFrame:
        o = self.raw("orders")
        k = F.col("o_orderkey")
        return o.select(
            F.concat(F.lit("Subject "), k.cast("string")).alias("subject"), F.col("o_orderstatus").alias("answer"),
            F.when(k % 23 == 0, "Unknown Queue").otherwise(F.concat(F.lit("Brand#"), (1 + k % 25).cast("string"))).alias("queue"),
            _case(k % 9, {0: "1", 1: "High", 2: "high", 3: "P4", 4: " critical ", 5: "Low", 6: "2 - High", 7: "Medium"}).alias("priority"),
            F.lit("Incident").alias("type"), F.lit("en").alias("language"),
            F.concat(F.lit("v"), (k % 3).cast("string")).alias("version"), F.lit("Standard").alias("tag_1"),
            k.alias("seq"),
        )

    @cached_property
    def raw_metrics(self) -> DataFrame:
        e = self.raw("events")
        eid = F.col("event_id")
        return e.select(
            (eid % 3).cast("string").alias("asset_id"),
            F.when(eid % 41 != 0, (F.col("user_id") % 10).cast("string")).alias("site_id"),
            F.when(eid % 37 == 0, "bad time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:00")).alias("timestamp_utc"),
            F.when(eid % 29 == 0, "1000.00").otherwise((eid % 100).cast("string")).alias("cpu_util_pct"),
            (eid * 7 % 101).cast("string").alias("mem_util_pct"),
            (eid * 13 % 101).cast("string").alias("link_util_pct"),
            F.when(eid % 31 == 0, "n/a").otherwise((eid % 500).cast("string")).alias("latency_ms"),
            F.lit("0.1").alias("packet_loss_pct"), eid.alias("seq"),
        )

    @cached_property
    def batch_ticket(self) -> DataFrame:
        o = self.raw("orders")
        k, cust = F.col("o_orderkey"), F.col("o_custkey")
        first = o.select(
            k.alias("ticket_id"), F.when(k % 101 == 0, cust + 1000000).otherwise(cust).alias("client_id"),
            F.when(k % 103 == 0, F.lit(-1).cast("long")).otherwise(k % 10).alias("site_id"), F.lit(0).alias("seq"))
        again = o.where(k % 50 == 0).select(k.alias("ticket_id"), cust.alias("client_id"),
                                            (k % 10).alias("site_id"), F.lit(1).alias("seq"))
        return first.unionByName(again)

    @cached_property
    def raw_support(self) -> DataFrame:
        d, lab = self.raw("documents"), self.raw("labels")
        return (d.join(lab, "doc_id", "left")
                .select(F.col("doc_id").alias("support_id"), F.col("text").alias("body"),
                        F.col("source").alias("assignment_group"),
                        _case(F.col("quality"), {1: "high", 0: "low"}).alias("priority_name"),
                        F.col("lang").alias("support_level")))

    @cached_property
    def raw_support_named(self) -> DataFrame:
        """Support texts under the column names of their source."""
        return self.raw_support.select("support_id", F.col("body").alias("Body"), F.col("assignment_group").alias("Department"),
                                       F.col("priority_name").alias("Priority"), F.col("support_level").alias("Tags"))

    @cached_property
    def csv_lines(self) -> DataFrame:
        """One CSV line an order, without a header: id, client, amount, day,
        note.  Some are damaged: fields missing or too many, text in a
        number, an impossible day."""
        k, cust = F.col("o_orderkey"), F.col("o_custkey")
        day = F.date_format("o_orderdate", "yyyy-MM-dd")
        note = F.when(k % 5 == 0, F.lit('"late, ""urgent"""')).otherwise(F.lit("none"))
        field = lambda *cs: F.concat_ws(",", *[c.cast("string") for c in cs])
        return self.raw("orders").select(
            k.alias("seq"),
            F.when(k % 29 == 0, field(k, cust))
            .when(k % 31 == 0, field(k, cust, cust * 7, day, note, F.lit("extra")))
            .when(k % 37 == 0, field(k, F.concat(F.lit("C"), cust.cast("string")), cust * 7, day, note))
            .when(k % 41 == 0, field(k, cust, cust * 7, F.lit("2024-13-45"), note))
            .otherwise(field(k, cust, cust * 7, day, note)).alias("value"))

    @cached_property
    def raw_tech_support(self) -> DataFrame:
        c = self.raw("conversations")
        return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("support_id"), F.col("text").alias("body"),
                        F.col("role").alias("assignment_group"), F.lit(None).cast("string").alias("priority_name"),
                        F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("support_level"))

    def dims(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in schemas.DIMENSION_LOAD_ORDER}

    def facts(self) -> dict[str, DataFrame]:
        return {"fact_ticket": self.fact_ticket, "fact_incident": self.fact_incident, "fact_metrics": self.fact_metrics}
