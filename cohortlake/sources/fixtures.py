"""Raw subscriber relations derived from the driver's tables (FIXTURES.md section 4).

The driver's tables are clean, so the five raw relations of the pipeline are
derived from them with a fixed, documented amount of dirt (blank keys, bad
dates, negative seconds, label conflicts, exact duplicates).  Everything is a
lazy DataFrame plan over the Parquet tables; nothing is collected.  The
subscriber domain size ``n`` is a scalar subquery, evaluated once by Spark.
Duplicated rows are produced with ``explode`` over a one- or two-element array
(one pass over the input instead of a self-union).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortlake.sources.tables import table

# Fixed values of the fixture definition (FIXTURES.md section 4); they must be
# exactly these for results to agree with the DuckDB oracle.
SUBSCRIBERS_PER_CUSTOMER = 5
EVENT_SHIFT_DAYS = 8377
# Events of rarer listeners lie this much earlier, outside every window.
EARLIER_DAYS = 400
BAD_DATE_TEXT = "20010231"
LABEL_WINDOWS = {
    "train": ("2001-02-01", "2001-05-01"),
    "train_v2": ("2001-03-01", "2001-05-29"),
}


@dataclass(frozen=True)
class RawTables:
    """The five raw relations of one run, as lazy DataFrames."""

    train: DataFrame
    train_v2: DataFrame
    members_v3: DataFrame
    transactions: DataFrame
    user_logs: DataFrame

    def as_dict(self) -> dict:
        return {
            "train": self.train,
            "train_v2": self.train_v2,
            "members_v3": self.members_v3,
            "transactions": self.transactions,
            "user_logs": self.user_logs,
        }


def _domain(customer: DataFrame) -> Column:
    """Scalar subquery: number of subscriber ids (customers / 5)."""
    return customer.select(
        (F.count(F.lit(1)) / SUBSCRIBERS_PER_CUSTOMER).cast("long")
    ).scalar()


def _yyyymmdd(date_col: Column) -> Column:
    return F.date_format(date_col, "yyyyMMdd")


def _twice_when(cond: Column) -> Column:
    """Explode helper: two copies of a row where ``cond`` holds, else one."""
    return F.explode(F.when(cond, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))


def raw_labels(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """``raw_train`` / ``raw_train_v2``: churn = no order in the 90 days after the cutoff."""
    start, end = LABEL_WINDOWS[which]
    customer = table(spark, sf_dir, "customer", "c_custkey")
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
    n = _domain(customer)
    subs = customer.select((F.col("c_custkey") % n).alias("sub")).distinct()
    buyers = (
        orders.filter(
            F.col("o_orderdate").cast("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        )
        .select((F.col("o_custkey") % n).alias("sub"))
        .distinct()
        .withColumn("bought", F.lit(1))
    )
    labelled = subs.join(buyers, "sub", "left").select(
        "sub", F.when(F.col("bought").isNull(), 1).otherwise(0).alias("is_churn")
    )
    sub, key = F.col("sub"), F.col("sub").cast("string")
    pair = lambda k, v: F.struct(k.alias("msno"), F.lit(v).cast("int").alias("is_churn"))
    rows = F.array(
        F.struct(key.alias("msno"), F.col("is_churn").cast("int").alias("is_churn")),
        F.when(sub % 50 == 0, pair(key, 1)),
        F.when(sub % 60 == 0, pair(key, 2)),
        F.when(sub == 0, pair(F.lit("  "), 0)),
    )
    return labelled.select(F.inline(F.filter(rows, lambda r: r.isNotNull())))


def raw_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
    n = _domain(table(spark, sf_dir, "customer", "c_custkey"))
    first_order = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("first_order")
    )
    ck = F.col("c_custkey")
    # Every customer is a row; some are made unknown subscribers by a blank key.
    unknown = (ck % 53 == 0) | (F.col("c_mktsegment") == "BUILDING") | ((ck % n) % 8 == 0)
    return customer.join(first_order, ck == F.col("o_custkey"), "left").select(
        F.when(unknown, F.lit("  ")).otherwise((ck % n).cast("string")).alias("msno"),
        F.col("c_nationkey").cast("int").alias("city"),
        (ck % 80).cast("int").alias("bd"),
        F.when(ck % 3 == 0, "male").when(ck % 3 == 1, "female").alias("gender"),
        (ck % 5 + 3).cast("int").alias("registered_via"),
        F.when(ck % 41 == 0, F.lit(BAD_DATE_TEXT))
        .otherwise(_yyyymmdd(F.col("first_order")))
        .alias("registration_init_time"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_partkey", "l_quantity", "l_linestatus", "l_shipdate", "l_returnflag",
    )
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    n = _domain(table(spark, sf_dir, "customer", "c_custkey"))
    ok = F.col("l_orderkey")
    joined = lineitem.join(orders, ok == F.col("o_orderkey"))
    return joined.select(
        F.when(ok % 107 == 0, F.lit(None).cast("string"))
        .otherwise((F.col("o_custkey") % n).cast("string"))
        .alias("msno"),
        (F.col("l_partkey") % 41).cast("int").alias("payment_method_id"),
        F.lit(30).cast("int").alias("payment_plan_days"),
        F.col("l_quantity").cast("int").alias("plan_list_price"),
        F.col("l_quantity").cast("int").alias("actual_amount_paid"),
        F.when(ok % 211 == 0, 2).when(F.col("l_linestatus") == "O", 1).otherwise(0).cast("int").alias("is_auto_renew"),
        F.when(ok % 89 == 0, F.lit(BAD_DATE_TEXT))
        .otherwise(_yyyymmdd(F.col("o_orderdate").cast("date")))
        .alias("transaction_date"),
        F.when(ok % 97 == 0, F.lit(""))
        .otherwise(_yyyymmdd(F.col("l_shipdate").cast("date")))
        .alias("membership_expire_date"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("int").alias("is_cancel"),
        _twice_when(ok % 101 == 0).alias("_copy"),
    ).drop("_copy")


def raw_user_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    eid, etype = F.col("event_id"), F.col("event_type")
    flag = lambda t: F.when(etype == t, 1).otherwise(0).cast("long")
    return (
        events.select(
            F.when(eid % 79 == 0, F.lit("")).otherwise(F.col("user_id").cast("string")).alias("msno"),
            F.when(eid % 83 == 0, F.lit(BAD_DATE_TEXT))
            .otherwise(_yyyymmdd(F.date_sub(F.col("ts").cast("date"), F.when(eid % 10 <= F.col("user_id") % 10, EVENT_SHIFT_DAYS).otherwise(EVENT_SHIFT_DAYS + EARLIER_DAYS))))
            .alias("date"),
            F.when(eid % 89 == 0, F.lit(None).cast("long"))
            .when(etype == "error", 1)
            .otherwise(0)
            .cast("long")
            .alias("num_25"),
            flag("signup").alias("num_50"),
            flag("view").alias("num_75"),
            flag("click").alias("num_985"),
            flag("purchase").alias("num_100"),
            F.lit(1).cast("long").alias("num_unq"),
            F.when(eid % 97 == 0, -F.col("value"))
            .when(eid % 103 == 0, F.lit(None).cast("double"))
            .otherwise(F.col("value"))
            .alias("total_secs"),
            _twice_when(eid % 73 == 0).alias("_copy"),
        )
        .drop("_copy")
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(
        train=raw_labels(spark, sf_dir, "train"),
        train_v2=raw_labels(spark, sf_dir, "train_v2"),
        members_v3=raw_members(spark, sf_dir),
        transactions=raw_transactions(spark, sf_dir),
        user_logs=raw_user_logs(spark, sf_dir),
    )
