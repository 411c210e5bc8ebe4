"""Raw document collections derived from the relational test tables.

The rules are listed in ``FIXTURES.md`` section 5.  Two batches exist: batch 1 holds every
customer and order; in batch 2 some have changed, some are gone and some are new, by rules on
their data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkmart.operators.spread import CELL, hot_keys, spread_join
from sparkmart.schemas import BENEFIT_FLAGS

BENEFITS = list(BENEFIT_FLAGS.values())
SYNCED = {1: "2024-05-01 00:00:00", 2: "2024-05-08 00:00:00"}
EARLIER = "2024-04-30 00:00:00"
BUCKET_ROWS = 250_000

PRODUCT_OF_TYPE = {
    "STANDARD": "InvestmentStock", "ECONOMY": "Brokerage", "MEDIUM": "Commodity",
    "SMALL": "InvestmentFund", "LARGE": "CurrencyService", "PROMO": "Derivatives",
}
TIER_OF_SEGMENT = {
    "AUTOMOBILE": "Bronze", "BUILDING": "Silver", "FURNITURE": "Gold", "MACHINERY": "Platinum",
}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the files only once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _pick(col: Column, values: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for key, value in values.items():
        out = F.when(col == key, value).otherwise(out)
    return out


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _envelope(df: DataFrame, key: Column, doc: list[Column], synced: Column) -> DataFrame:
    return df.select(
        key.cast("string").alias("_id"), F.to_json(F.struct(*doc)).alias("data"),
        synced.cast("timestamp").alias("_fivetran_synced"),
        F.lit(False).alias("_fivetran_deleted"),
    )


def owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(owner, account): each order, and urgent ones also with the next customer."""
    orders = table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    who = F.when(urgent, F.array("o_custkey", F.col("o_custkey") + 1)) \
        .otherwise(F.array("o_custkey"))
    return orders.select(F.explode(who).alias("owner"), F.col("o_orderkey").alias("account"))


def accounts_of_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(owner, cell, accounts) of the customers that own any, the same in both batches."""
    customer = table(spark, sf_dir, "customer")
    return spread_join(
        owners(spark, sf_dir), [customer.select(F.col("c_custkey").alias("owner"))], ["owner"],
        how="inner", rows_per_slice=BUCKET_ROWS, keep_cell=True,
    ).groupBy("owner", CELL).agg(F.collect_set("account").alias("accounts"))


def raw_customers(spark: SparkSession, sf_dir: str, batch: int = 1, held: DataFrame | None = None) -> DataFrame:
    """One document per customer; customers with very many accounts have several.

    ``held`` may be ``accounts_of_owners``, written once for both batches.
    """
    customer = table(spark, sf_dir, "customer")
    held = accounts_of_owners(spark, sf_dir) if held is None else held
    docs = customer.join(held, customer.c_custkey == held.owner, "left")

    segment, balance, nation = F.col("c_mktsegment"), F.col("c_acctbal"), F.col("c_nationkey")
    benefits = F.array(*[F.lit(b) for b in BENEFITS])
    base = F.struct(
        _pick(segment, TIER_OF_SEGMENT).alias("tier"),
        F.array(benefits[nation % 10], benefits[(nation + 3) % 10]).alias("benefits"),
        F.lit(True).alias("active"))
    bonus = F.struct(F.lit("Gold").alias("tier"),
                     F.array(F.lit("concierge services")).alias("benefits"),
                     F.lit(False).alias("active"))
    entry = "array<struct<key: string, value: struct<tier: string, benefits: array<string>, " \
            "active: boolean>>>"
    tiers = F.map_from_entries(F.concat(
        F.when(segment != "HOUSEHOLD", F.array(F.struct(F.lit("base"), base)))
        .otherwise(F.array()).cast(entry),
        F.when(balance >= 5000, F.array(F.struct(F.lit("bonus"), bonus)))
        .otherwise(F.array()).cast(entry)))
    address = F.concat(F.lit("N"), nation)
    email = F.concat("c_name", F.lit("@example.com"))
    if batch == 2:
        docs = docs.filter(~((segment == "HOUSEHOLD") & (balance < 0)))
        address = F.when(balance >= 1000, address) \
            .when(balance >= 0, F.concat(F.lit("M"), nation))
        email = F.when(balance >= 8000, F.concat("c_name", F.lit("@example.org"))).otherwise(email)
    birth = F.date_add(F.lit("1970-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int"))
    fields = {
        "username": F.concat(F.lit("user"), "c_custkey"), "name": F.col("c_name"),
        "address": address, "birthdate": _iso(birth.cast("timestamp")), "email": email,
        "active": F.when(balance >= 0, "true").otherwise("false"), "accounts": F.col("accounts"),
        "tier_and_details": tiers,
    }
    raw = _envelope(docs, F.col("c_custkey"), [v.alias(k) for k, v in fields.items()],
                    _ts(SYNCED[batch]))
    if batch == 2:
        raw = raw.unionByName(_suppliers_as_customers(spark, sf_dir))
    return raw


def _suppliers_as_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New customers of batch 2; each shares the account numbered like the supplier."""
    fields = {
        "username": F.concat(F.lit("supp"), "s_suppkey"), "name": F.col("s_name"),
        "address": F.concat(F.lit("N"), "s_nationkey"),
        "birthdate": F.lit("1980-01-01T00:00:00Z"),
        "email": F.concat("s_name", F.lit("@example.com")), "active": F.lit("true"),
        "accounts": F.array("s_suppkey"),
    }
    return _envelope(table(spark, sf_dir, "supplier"), F.concat(F.lit("S"), "s_suppkey"),
                     [v.alias(k) for k, v in fields.items()], _ts(SYNCED[2]))


_BITS = {product: 1 << n for n, product in enumerate(PRODUCT_OF_TYPE.values())}


def products_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, bits): an order's set of products as a number, which is aggregated without objects;
    the same in both batches."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    bit = _pick(F.col("p_type"), {kind: str(_BITS[product]) for kind, product in PRODUCT_OF_TYPE.items()}).cast("int")
    return (
        table(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", F.coalesce(bit, F.lit(0)).alias("bit"))
        .groupBy("l_orderkey").agg(F.bit_or("bit").alias("bits"))
    )


def raw_accounts(spark: SparkSession, sf_dir: str, batch: int = 1, held: DataFrame | None = None) -> DataFrame:
    """One document per order; orders in status P have an older document as well.

    ``held`` may be ``products_of_orders``, written once for both batches.
    """
    held = (products_of_orders(spark, sf_dir) if held is None else held).withColumn("products", F.array_compact(F.array(*[
        F.when(F.col("bits").bitwiseAND(n) != 0, product) for product, n in _BITS.items()])))
    orders = table(spark, sf_dir, "orders")
    docs = orders.join(held, orders.o_orderkey == held.l_orderkey, "left")
    limit = F.floor(F.col("o_totalprice") / 100)
    products = F.col("products")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    if batch == 2:
        docs = docs.filter(~((status == "F") & (priority == "2-HIGH")))
        limit = F.when(status == "O", limit + 1).otherwise(limit)
        products = F.when((status == "F") & (priority == "5-LOW"), F.array(F.lit("Brokerage"))) \
            .otherwise(products)
    account = F.col("o_orderkey").alias("account_id")
    raw = _envelope(docs, F.concat(F.lit("A"), "o_orderkey"),
                    [account, limit.alias("limit"), products.alias("products")],
                    _ts(SYNCED[batch]))
    older = _envelope(orders.filter(status == "P"), F.concat(F.lit("B"), "o_orderkey"),
                      [account, F.lit(0).alias("limit")], _ts(EARLIER))
    raw = raw.unionByName(older)
    if batch == 2:
        new = _envelope(
            table(spark, sf_dir, "customer"), F.concat(F.lit("C"), "c_custkey"),
            [(F.lit(1_000_000_000) + F.col("c_custkey")).alias("account_id"),
             F.floor("c_acctbal").alias("limit"),
             F.array(F.lit("Derivatives")).alias("products")], _ts(SYNCED[2]))
        raw = raw.unionByName(new)
    return raw


def raw_transactions(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    """One bucket per order with line items, synced on the order date; ``until`` keeps the
    buckets that had been synced by then.  Orders with very many lines have several buckets.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    lineitem = table(spark, sf_dir, "lineitem")
    lines = lineitem \
        .join(part, F.col("l_partkey") == F.col("p_partkey")) \
        .select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_returnflag",
                "l_discount", "l_extendedprice", "p_brand", "p_retailprice")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                                   "o_orderdate")
    if until is not None:
        orders = orders.filter(F.col("o_orderdate") <= F.lit(until).cast("timestamp_ntz"))
    key = ["l_orderkey"]
    split = not hot_keys(lineitem.select(*key), key, BUCKET_ROWS, "n").isEmpty()
    tx = F.struct(
        _iso(F.col("l_shipdate")).alias("date"),
        F.floor("l_quantity").cast("int").alias("amount"),
        F.col("l_returnflag").alias("transaction_code"),
        F.when(F.col("l_discount") != 0, F.col("p_brand")).alias("symbol"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("total"))
    whole = [F.count(F.lit(1)).alias("transaction_count"), F.min("l_shipdate").alias("first"),
             F.max("l_shipdate").alias("last")]
    if split:  # counts and dates are those of the order, however many buckets it is split over
        placed = spread_join(lines, [orders.join(lines.groupBy(*key).agg(*whole), key)], key,
                             how="inner", rows_per_slice=BUCKET_ROWS, count_from=lineitem,
                             keep_cell=True, deal_by=["l_orderkey", "l_linenumber"])
        buckets = placed.groupBy(
            *key, CELL, "o_orderdate", "transaction_count", "first", "last",
        ).agg(F.collect_list(tx).alias("transactions"))
    else:  # each order is one bucket: lines meet once, and their orders after that
        dates = orders.repartition(*key).groupBy(*key, "o_orderdate").agg(F.count(F.lit(1)).alias("n"))
        buckets = lines.repartition(*key).groupBy(*key).agg(F.collect_list(tx).alias("transactions"), *whole).join(dates, key) \
            .withColumns({CELL: F.lit(0), "transactions": F.when(F.col("n") == 1, F.col("transactions")).otherwise(
                F.flatten(F.array_repeat("transactions", F.col("n").cast("int"))))})
    return _envelope(
        buckets, F.concat(F.lit("T"), "l_orderkey", F.lit("-"), CELL),
        [F.col("l_orderkey").alias("account_id"), F.col("transaction_count"),
         _iso(F.col("first")).alias("bucket_start_date"),
         _iso(F.col("last")).alias("bucket_end_date"), F.col("transactions")],
        F.col("o_orderdate"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as envelopes; error events count as deleted at the source."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("_id"), F.col("props").alias("data"),
        F.col("ts").cast("timestamp").alias("_fivetran_synced"),
        (F.col("event_type") == "error").alias("_fivetran_deleted"))


def damaged(raw: DataFrame, number: Column) -> DataFrame:
    """``raw`` with some documents damaged by their ``number`` % 40, see ``FIXTURES.md`` section 5:
    1 cut off, 2 NULL, 3 with text in place of an array, 4 without times of day, 5 without its ids."""
    kind, data = number % 40, F.col("data")
    array, time = r'"(accounts|products|transactions)":\[.*\]', r'(\d\d\d\d-\d\d-\d\d)T\d\d:\d\d:\d\dZ'
    return raw.withColumn("data", F.when(kind == 1, F.expr("left(data, length(data) - 1)"))
                          .when(kind == 2, F.lit(None).cast("string"))
                          .when(kind == 3, F.regexp_replace(data, array, '"$1":"?"'))
                          .when(kind == 4, F.regexp_replace(data, time, "$1"))
                          .when(kind == 5, F.regexp_replace(data, '"account_id":[0-9]+', '"account_id":null'))
                          .otherwise(data))


def document_number(raw: DataFrame) -> Column:
    """The number in a document's id."""
    return F.regexp_extract("_id", "([0-9]+)", 1).cast("bigint")
