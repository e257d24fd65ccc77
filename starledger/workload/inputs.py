"""Registry-like inputs derived from the test tables.

Each order stands for a space object. What a row looks like depends on its own priority,
status and price, so every derivation reads whole tables and grows with them. The SQL
twins live in `sql.py`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.sources.pages import DOCUMENTS_KEY, FIELD_COLUMNS

DIFF_KEY = "o_orderkey"
DIFF_COLUMNS = ("o_custkey", "o_orderstatus", "price", "o_orderdate", "o_orderpriority")
SNAPSHOT_DATES = ("2026-04-19", "2026-04-26")
SNAPSHOT_DATE = "2026-04-24"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "cast(o_totalprice as decimal(12,2)) as price",
        "cast(o_orderdate as date) as o_orderdate",
        "o_orderpriority",
    )


def previous_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier snapshot: urgent orders are not there yet."""
    status = F.expr(
        """case when o_orderpriority = '2-HIGH' and o_orderstatus = 'F' then ''
                when o_orderpriority = '2-HIGH' and o_orderstatus = 'O' then null
                else o_orderstatus end"""
    )
    rows = _orders(spark, sf_dir).where("o_orderpriority <> '1-URGENT'")
    return rows.withColumn("o_orderstatus", status)


def current_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later snapshot: low-priority orders are gone, some values have changed."""
    return (
        _orders(spark, sf_dir)
        .where("o_orderpriority <> '5-LOW'")
        .withColumns(
            {
                "o_orderstatus": F.expr(
                    """case when o_orderpriority = '2-HIGH' and o_orderstatus = 'F' then null
                            when o_orderpriority = '3-MEDIUM' and o_orderstatus = 'P' then 'X'
                            when o_orderpriority = '2-HIGH' and o_orderstatus = 'O' then ''
                            else o_orderstatus end"""
                ),
                "price": F.expr(
                    """cast(case when o_orderstatus = 'O' and price > 450000 then price + 1
                                 else price end as decimal(12,2))"""
                ),
                "o_orderdate": F.expr(
                    "case when price > 400000 then date_add(o_orderdate, 1) else o_orderdate end"
                ),
            }
        )
    )


def repeated_lines(spark: SparkSession, sf_dir: str, later: bool) -> DataFrame:
    """Line items keyed by order alone: a snapshot in which most keys repeat."""
    flag = "case when l_linestatus = 'O' then 'N' else l_returnflag end" if later else "l_returnflag"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", f"{flag} as flag", "l_linestatus as status"
    )


def yearly_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history: one snapshot per year with the customers that ordered in it."""
    return (
        _orders(spark, sf_dir)
        .groupBy(
            F.to_date(F.trunc("o_orderdate", "year")).alias("snapshot_date"),
            F.col("o_custkey").alias("custkey"),
        )
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.max("o_orderpriority").alias("top_priority"),
            F.max("price").alias("top_price"),
        )
    )


RAW_REGISTRY = {
    "International Designator": """
        case when o_orderstatus = 'P' and p = '2' then concat(y, '-ALPHA BETA ', k)
             when o_orderstatus = 'P' and p = '3' then concat(y, '-XXXX')
             when o_orderstatus = 'P' and p = '4' then concat(y - 40, '-', lpad(k, 9, '0'), 'A')
             when o_orderstatus = 'P' and p = '5' then ''
             else concat(y, '-', lpad(k, 9, '0'), 'A') end""",
    "National Designator": "case when p = '1' then concat('N-', o_custkey) else '' end",
    "Name of Space Object": """
        case when o_orderstatus = 'F' and p = '1' then concat('  Object ', k)
             when o_orderstatus = 'F' and p = '3' then concat('Object ', k, chr(9))
             when o_orderstatus = 'F' and p = '4' then concat('Object ', k, chr(160))
             when p = '2' then concat('OBJECT ', k, ' (ALIAS)')
             else concat('Object ', k) end""",
    "State of Registry": "concat('State ', o_custkey)",
    "Date of Launch": """
        case p when '1' then d when '2' then substring(d, 1, 7) when '3' then substring(d, 1, 4)
               when '4' then concat(' ', d, ' ')
               else case o_orderstatus when 'F' then 'bad' when 'O' then ''
                    else concat(substring(d, 1, 4), '-13') end end""",
    "Status": """
        case o_orderstatus when 'F' then 'decayed' when 'O' then 'in orbit' else 'active' end""",
    "Date of Decay": """
        case when o_orderstatus = 'F' and p = '1' then cast(date_add(o_orderdate, -10) as string)
             when o_orderstatus = 'F' or p = '2' then cast(date_add(o_orderdate, 200) as string)
             else '' end""",
    "UN Registered": """
        case p when '1' then 'T' when '2' then 'F' when '3' then ' t ' when '4' then 'f'
               else 'unknown' end""",
    "Registration Documents": """
        case when p = '5' then '' else concat('ST/SG/', o_custkey, ', A/', k) end""",
    "Function": "lower(o_orderpriority)",
    "Remarks": "''",
    "External website": "''",
}


def _described_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).selectExpr(
        "*",
        "cast(o_orderkey as string) as k",
        "year(o_orderdate) as y",
        "cast(o_orderdate as string) as d",
        "substring(o_orderpriority, 1, 1) as p",
    )


def raw_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry as raw text, '' for missing values."""
    return _described_orders(spark, sf_dir).select(
        *[F.expr(sql).alias(name) for name, sql in RAW_REGISTRY.items()]
    )


def _pages(orders: DataFrame, records: Column, found: int) -> DataFrame:
    """JSON records as landed pages of at most 50, each with the announced total."""
    # The orders are shuffled as they are; the wider JSON text is built after.
    by_page = orders.withColumn("n", F.floor(F.col("o_orderkey") / 50)).repartition("n")
    return by_page.select("n", records.alias("j")).groupBy("n").agg(
        F.concat(
            F.lit(f'{{"found": {found}, "results": ['),
            F.array_join(F.collect_list("j"), ","),
            F.lit("]}"),
        ).alias("page")
    ).select("page")


def registry_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw registry as landed JSON pages of at most 50 records.

    National designators of one priority are JSON numbers and its documents are null
    for another, so the reader's type rules matter.
    """
    orders = _described_orders(spark, sf_dir)

    def record(national: Column) -> Column:
        fields = [F.expr(RAW_REGISTRY[name]).alias(key) for key, name in FIELD_COLUMNS.items()
                  if name != "National Designator"]
        documents = F.expr(
            "case when p = '5' then null else array(concat('ST/SG/', o_custkey), concat('A/', k)) end"
        ).alias(DOCUMENTS_KEY)
        values = F.struct(
            *fields, national.alias("object.nationalDesignator_s1"), documents, F.lit(1).alias("extra")
        )
        return F.to_json(F.struct(values.alias("values")))

    national = F.expr(RAW_REGISTRY["National Designator"])
    records = F.when(F.col("p") == "2", record(F.col("o_custkey"))).otherwise(record(national))
    return _pages(orders, records, table(spark, sf_dir, "orders").count())


def weekly_pages(spark: SparkSession, sf_dir: str, later: bool) -> DataFrame:
    """A load that keeps the registry contract; the later one has other rows and values."""
    orders = _described_orders(spark, sf_dir).where("p <> '5'" if later else "p <> '1'")
    moved = "when o_orderstatus = 'P' then 'in orbit'" if later else ""
    registered = "p = '2'" if later else "p in ('2', '3')"
    values = {
        "International Designator": "concat(y, '-', lpad(k, 9, '0'), 'A')",
        "National Designator": "''",
        "Name of Space Object": "concat('Object ', k)",
        "State of Registry": "concat('State ', o_custkey % 50)",
        "Date of Launch": "d",
        "Status": f"""case {moved} when o_orderstatus = 'F' then 'decayed'
                           when o_orderstatus = 'O' then 'in orbit' else 'active' end""",
        "Date of Decay": """case when o_orderstatus = 'F' and p = '4' then cast(date_add(o_orderdate, -10) as string)
                                 when o_orderstatus = 'F' or p = '3' then cast(date_add(o_orderdate, 90) as string)
                                 else '' end""",
        "UN Registered": f"case when {registered} then 'T' else 'F' end",
        "Function": "lower(o_orderpriority)",
        "Remarks": "''",
        "External website": "''",
    }
    fields = [F.expr(values[name]).alias(key) for key, name in FIELD_COLUMNS.items()]
    return _pages(orders, F.to_json(F.struct(F.struct(*fields).alias("values"))), orders.count())


def matching_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed registry side of the matching queries."""
    return _described_orders(spark, sf_dir).where("p <> '4'").selectExpr(
        "concat(y, '-', lpad(k, 9, '0'), 'A') as `International Designator`",
        "cast(null as string) as `National Designator`",
        """case when p = '3' and o_orderstatus = 'P' then 'Cosmos Deb'
                else concat('Cosmos ', k, ' (Alias)') end as `Name of Space Object`""",
        "concat('State ', o_custkey) as `State of Registry`",
        """case when p = '3' and o_orderstatus = 'P' then cast(trunc(o_orderdate, 'month') as date)
                else o_orderdate end as `Date of Launch`""",
        """case o_orderstatus when 'F' then 'decayed' when 'O' then 'in orbit' else 'active' end
           as `Status`""",
        "case when o_orderstatus = 'F' and p = '1' then date_add(o_orderdate, 300) end as `Date of Decay`",
        "case o_orderstatus when 'F' then true when 'O' then false end as `UN Registered`",
        "concat('ST/SG/', o_custkey) as `Registration Documents`",
        "lower(o_orderpriority) as `Function`",
        "cast(null as string) as `Remarks`",
        "cast(null as string) as `External website`",
    )


CATALOG_ID = """
    case when p = '5' and o_orderstatus = 'P' then null
         when p in ('2', '3') then concat(y, '-', lpad(k, 9, '0'), 'B')
         else concat(y, '-', lpad(k, 9, '0'), 'A') end"""
CATALOG_NAME = """
    case when p = '3' and o_orderstatus = 'P' then 'COSMOS DEB'
         when p = '2' then concat('COSMOSS ', k)
         else concat('COSMOS ', k) end"""
CATALOG_DATE = """
    case when p = '3' and o_orderstatus = 'P' then cast(date_trunc('month', o_orderdate) as date)
         when price > 400000 then date_add(o_orderdate, 5)
         when o_orderstatus = 'F' then date_add(o_orderdate, 1)
         when o_orderstatus = 'O' then date_add(o_orderdate, -1)
         else o_orderdate end"""


def gp_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """General perturbations side: all but the urgent orders."""
    return _described_orders(spark, sf_dir).where("p <> '1'").selectExpr(
        f"{CATALOG_NAME} as OBJECT_NAME",
        f"""case when p = '4' and o_orderstatus = 'P' then concat(y, '-', lpad(k, 9, '0'), 'Z')
                 else {CATALOG_ID} end as OBJECT_ID""",
        "cast(o_custkey % 17 as double) as MEAN_MOTION",
        "cast(o_custkey % 10 as double) / 12 as ECCENTRICITY",
        "o_orderkey + 1 as NORAD_CAT_ID",
    )


def satcat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Satellite catalog side: all but the low-priority orders."""
    return _described_orders(spark, sf_dir).where("p <> '5' or o_orderstatus = 'P'").selectExpr(
        f"{CATALOG_NAME} as OBJECT_NAME",
        f"{CATALOG_ID} as OBJECT_ID",
        "o_orderkey + 1 as NORAD_CAT_ID",
        "concat('OWN', o_custkey % 7) as OWNER",
        f"{CATALOG_DATE} as LAUNCH_DATE",
        "case when o_orderstatus = 'F' then date_add(o_orderdate, 400) end as DECAY_DATE",
    )


def decorated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with brackets, aliases, accents, numerals and stray whitespace."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        """case p_type
             when 'ECONOMY' then concat(upper(p_name), ' [', p_brand, ']')
             when 'LARGE' then concat(p_name, '(', p_brand, ') ', p_size)
             when 'MEDIUM' then concat('É', p_name, ' VII.')
             when 'PROMO' then concat(p_name, ' XIV-Müller; ')
             when 'SMALL' then concat('  ', p_name, chr(9), ' ii ;')
             else concat(p_name, ' [x] (y) I') end as name""",
    )


# Whole catalogs for the contract queries; some values break a rule on purpose.
GP_COLUMNS = {
    "OBJECT_NAME": "case when p = '5' and o_orderstatus = 'P' then null else concat('OBJ ', k) end",
    "OBJECT_ID": """case when p = '4' and o_orderstatus = 'P' then 'none'
                         else concat(y, '-', lpad(k, 9, '0'), 'A') end""",
    "EPOCH": "concat(d, 'T06:00:00')",
    "MEAN_MOTION": "cast(o_custkey % 23 as double)",
    "ECCENTRICITY": "cast(o_custkey % 11 as double) / 10",
    "INCLINATION": "cast(o_custkey % 200 as double)",
    "RA_OF_ASC_NODE": "cast(o_orderkey % 370 as double)",
    "ARG_OF_PERICENTER": "cast(o_orderkey % 361 as double)",
    "MEAN_ANOMALY": "cast(o_orderkey % 400 as double) - 10",
    "EPHEMERIS_TYPE": "cast(case when p = '1' then -1 else 0 end as bigint)",
    "CLASSIFICATION_TYPE": "case p when '1' then 'U' when '2' then 'C' when '3' then 'S' else 'X' end",
    "NORAD_CAT_ID": "cast(o_orderkey - 5 as bigint)",
    "ELEMENT_SET_NO": "cast(o_custkey - 5 as bigint)",
    "REV_AT_EPOCH": "cast(o_orderkey % 7 - 1 as bigint)",
    "BSTAR": "case when o_orderstatus = 'P' then null else cast(o_custkey as double) / 1000 end",
    "MEAN_MOTION_DOT": "cast(0 as double)",
    "MEAN_MOTION_DDOT": "cast(0 as double)",
}
SATCAT_COLUMNS = {
    "OBJECT_NAME": "concat('OBJ ', k)",
    "OBJECT_ID": "case when p = '5' then 'none' else concat(y, '-', lpad(k, 9, '0'), 'A') end",
    "NORAD_CAT_ID": "cast(o_orderkey - 5 as bigint)",
    "OBJECT_TYPE": "case p when '1' then 'PAY' when '2' then 'R/B' when '3' then 'DEB' else 'TBA' end",
    "OPS_STATUS_CODE": "case p when '1' then '+' when '2' then 'p' when '3' then 'Q' end",
    "OWNER": "case when o_orderstatus = 'P' then null else concat('OWN', o_custkey % 7) end",
    "LAUNCH_DATE": """case when p = '2' and o_orderstatus = 'P' then date '1957-10-03'
                           else o_orderdate end""",
    "LAUNCH_SITE": "concat('SITE', o_custkey % 3)",
    "DECAY_DATE": """case when o_orderstatus = 'F' then date '1957-10-04'
                          when p = '1' then date '1950-01-01' end""",
    "PERIOD": "cast(o_custkey % 100 as double) - 1",
    "INCLINATION": "cast(o_custkey % 182 as double)",
    "APOGEE": "cast(o_custkey % 9 - 1 as bigint)",
    "PERIGEE": "cast(o_custkey % 5 as bigint)",
    "RCS": "case when p = '3' then cast(-1 as double) end",
    "DATA_STATUS_CODE": "case p when '1' then 'NEA' when '2' then 'nie' end",
    "ORBIT_CENTER": "'EA'",
    "ORBIT_TYPE": "case o_orderstatus when 'F' then 'LAN' when 'O' then 'ORB' else 'orb' end",
}


def whole_catalog(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    """All columns of a catalog, one row an order."""
    described = _described_orders(spark, sf_dir)
    return described.select(*[F.expr(sql).alias(name) for name, sql in columns.items()])


def ragged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines under one column that is named as their header; some are broken."""
    line = """
        case when p = '1' and o_orderstatus = 'P' then concat('OBJ ', k, ',', k)
             when p = '2' and o_orderstatus = 'P' then concat('OBJ ', k, ',', k, ',', d, ',more')
             when p = '3' and o_orderstatus = 'P' then concat('OBJ ', k, ',n', k, ',', d)
             when p = '4' and o_orderstatus = 'P' then concat('OBJ ', k, ',x,', y, '-13-01')
             when p = '5' then concat('OBJ ', k, ',,', d)
             else concat('OBJ ', k, ',', k, ',', d) end"""
    return _described_orders(spark, sf_dir).select(F.expr(line).alias("NAME,NUMBER,DAY"))
