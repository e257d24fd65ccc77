"""One query per operator, over whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.functions.names import with_normal_name
from starledger.functions.orbit import orbit_regime
from starledger.functions.similarity import token_set_score
from starledger.functions.text import (
    column,
    has_edge_space,
    join_documents,
    leading_year,
    parse_flag,
    partial_date,
    strip,
)
from starledger.operators import analysis, contracts, diff, events, expectations, match
from starledger.operators.contracts import Contract, Field, Rule
from starledger.plans import canonical
from starledger.sources import catalogs, landing, pages, snapshots
from starledger.sources.shared import scratch_path
from starledger.workload import inputs
from starledger.workload.inputs import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = dt.date.fromisoformat(inputs.SNAPSHOT_DATE)
AS_OF_YEAR = 1998


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[column(old).alias(new) for old, new in names.items()])


#: Short names of the registry columns, in their order.
REGISTRY_NAMES = dict(
    zip(
        pages.REGISTRY_SCHEMA.names,
        "designator national name state launch status decay registered documents function"
        " remarks website".split(),
    )
)


RAGGED_SCHEMA = T.StructType(
    [
        T.StructField("NAME", T.StringType()),
        T.StructField("NUMBER", T.LongType()),
        T.StructField("DAY", T.DateType()),
    ]
)

# --- diff ---------------------------------------------------------------------------


def _order_diff(spark: SparkSession, sf: str) -> diff.SnapshotDiff:
    return diff.diff_snapshots(
        inputs.previous_orders(spark, sf),
        inputs.current_orders(spark, sf),
        inputs.DIFF_KEY,
        inputs.DIFF_COLUMNS,
        keys_unique=True,
    )


def _line_diff(spark: SparkSession, sf: str) -> diff.SnapshotDiff:
    return diff.diff_snapshots(
        inputs.repeated_lines(spark, sf, later=False),
        inputs.repeated_lines(spark, sf, later=True),
        "l_orderkey",
        ("flag", "status"),
    )


def _history_diff(spark: SparkSession, sf: str) -> diff.SnapshotDiff:
    history = inputs.yearly_customers(spark, sf)
    return diff.diff_history(
        history, "custkey", ("n_orders", "top_priority", "top_price"), keys_unique=True
    )


@query
def diff_added(spark, sf):
    return _order_diff(spark, sf).added


@query
def diff_removed(spark, sf):
    return _order_diff(spark, sf).removed


@query
def diff_changes(spark, sf):
    return _order_diff(spark, sf).changes


@query
def diff_counts(spark, sf):
    return _order_diff(spark, sf).counts


@query
def diff_repeated_keys(spark, sf):
    return _line_diff(spark, sf).weighted_changes


@query
def diff_repeated_counts(spark, sf):
    return _line_diff(spark, sf).counts


@query
def diff_history(spark, sf):
    return _history_diff(spark, sf).changes


@query
def diff_history_membership(spark, sf):
    found = _history_diff(spark, sf)
    parts = [
        side.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n")).withColumn("change", F.lit(c))
        for side, c in ((found.added, "added"), (found.removed, "removed"))
    ]
    return parts[0].unionByName(parts[1])


# --- cleaning and loading -----------------------------------------------------------


@query
def partial_dates(spark, sf):
    raw = inputs.raw_registry(spark, sf)
    return raw.select(
        column("Name of Space Object").alias("name"),
        partial_date("Date of Launch").alias("launch"),
        leading_year("Date of Launch").alias("launch_year"),
    )


@query
def flag_parse(spark, sf):
    flags = F.expr("case l_returnflag when 'A' then ' t ' when 'N' then 'F' else 'unknown' end")
    return (
        table(spark, sf, "lineitem")
        .select(parse_flag(flags).alias("flag"), "l_linestatus")
        .groupBy("flag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def edge_whitespace(spark, sf):
    name = "Name of Space Object"
    raw = inputs.raw_registry(spark, sf)
    return raw.select(
        column(name).alias("raw_name"),
        strip(name).alias("name"),
        has_edge_space(name).alias("had_edge"),
    )


@query
def document_lists(spark, sf):
    docs = F.expr(
        """case when c_mktsegment = 'MACHINERY' then null
                else array(c_name, c_mktsegment, cast(c_nationkey as string)) end"""
    )
    return table(spark, sf, "customer").select("c_custkey", join_documents(docs).alias("documents"))


@query
def page_records(spark, sf):
    return _renamed(pages.page_records(inputs.registry_pages(spark, sf)), REGISTRY_NAMES)


@query
def page_registry(spark, sf):
    return _renamed(pages.load_registry(inputs.registry_pages(spark, sf)), REGISTRY_NAMES)


@query
def page_completeness(spark, sf):
    return pages.completeness(inputs.registry_pages(spark, sf)).select(
        "expected", "records", "problem"
    )


@query
def page_quarantine(spark, sf):
    # Event properties are JSON objects; other event types get bodies that are not pages.
    body = F.expr(
        """case event_type when 'view' then props when 'click' then concat('[', props, ']')
             when 'error' then substring(props, 2) when 'signup' then concat('{"results": ', props, '}')
             else concat('{"results": [', event_id, ']}') end"""
    )
    bad = pages.bad_pages(table(spark, sf, "events").select(body.alias("page")))
    return bad.groupBy("fault").agg(F.count(F.lit(1)).alias("n"))


SATCAT_SCHEMA = T.StructType(
    [
        T.StructField("OBJECT_NAME", T.StringType()),
        T.StructField("OBJECT_ID", T.StringType()),
        T.StructField("NORAD_CAT_ID", T.LongType()),
        T.StructField("OWNER", T.StringType()),
        T.StructField("LAUNCH_DATE", T.DateType()),
        T.StructField("DECAY_DATE", T.DateType()),
    ]
)


@query
def catalog_csv(spark, sf):
    path = scratch_path(spark, "catalog-csv")
    inputs.satcat(spark, sf).write.option("header", True).csv(path)
    return catalogs.read_catalog(spark, path, SATCAT_SCHEMA)


@query
def unreadable_cells(spark, sf):
    text = table(spark, sf, "part").select(
        F.expr("case when p_type = 'PROMO' then p_brand else cast(p_size as string) end").alias("p_size"),
        F.expr("case when p_type = 'SMALL' then 'n/a' else cast(p_partkey as string) end").alias(
            "p_partkey"
        ),
    )
    schema = T.StructType(
        [T.StructField("p_size", T.IntegerType()), T.StructField("p_partkey", T.LongType())]
    )
    return catalogs.unreadable_cells(text, schema)


@query
def landing_status(spark, sf):
    events = table(spark, sf, "events")
    landed = events.select(
        F.col("event_type").alias("source"),
        F.col("event_id").alias("batch_id"),
        F.col("ts").alias("landed_at"),
        F.col("user_id").alias("rows"),
    )
    committed = events.where("event_type in ('view', 'click')").select(
        F.col("event_type").alias("source"), F.col("event_id").alias("batch_id")
    )
    return landing.source_status(landed, committed).drop("landed_at")


@query
def landing_freshness(spark, sf):
    landed = table(spark, sf, "events").select(
        F.col("event_type").alias("source"), F.col("ts").alias("landed_at")
    )
    newest = "2024-01-31 00:00:00"
    return landing.freshness(landed, newest, hours=48).select("source", "skip")


# --- snapshot store -----------------------------------------------------------------


def _stored(spark: SparkSession, sf: str) -> str:
    base = scratch_path(spark, "snapshots")
    frames = (inputs.previous_orders(spark, sf), inputs.current_orders(spark, sf))
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(path)
    for day, df in zip(inputs.SNAPSHOT_DATES, frames):
        snapshots.save_snapshot(df, dt.date.fromisoformat(day), base, version="1.0.0")
    return base


@query
def snapshot_history(spark, sf):
    return snapshots.load_history(spark, _stored(spark, sf), version="1.1.0")


@query
def snapshot_load(spark, sf):
    base = _stored(spark, sf)
    newest = snapshots.list_snapshot_dates(spark, base)[-1]
    before = snapshots.previous_snapshot_date(spark, base, newest)
    return snapshots.load_snapshot(spark, before, base)


@query
def snapshot_dates(spark, sf):
    return snapshots.history_dates(inputs.yearly_customers(spark, sf))


def _event_log(spark: SparkSession, sf: str, key: str) -> str:
    """Row events of two snapshots of the orders, the first of them all added."""
    base = scratch_path(spark, "events")
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(path)
    before = None
    for day, df in zip(inputs.SNAPSHOT_DATES, (inputs.previous_orders(spark, sf), inputs.current_orders(spark, sf))):
        told = events.row_events(before, df, key)
        events.append_events(told, dt.date.fromisoformat(day), base)
        before = df
    return base


@query
def changelog_events(spark, sf):
    """Events of each kind that two snapshots leave, by order status."""
    history = snapshots.load_history(spark, _event_log(spark, sf, inputs.DIFF_KEY))
    return history.groupBy("snapshot_date", F.col("_event").alias("event"), "o_orderstatus").agg(
        F.count("*").alias("n")
    )


@query
def changelog_replay(spark, sf):
    """Both snapshots rebuilt from events alone; their key repeats."""
    base = _event_log(spark, sf, "o_custkey")
    days = [dt.date.fromisoformat(day) for day in inputs.SNAPSHOT_DATES]
    rebuilt = [
        events.replay(spark, base, "o_custkey", day).withColumn("as_of", F.lit(day)) for day in days
    ]
    return rebuilt[0].unionByName(rebuilt[1])


# --- contracts ----------------------------------------------------------------------

PART = Contract(
    "part",
    "1.0.0",
    (
        Field("p_partkey", T.LongType(), False, (Rule("gt", 0),)),
        Field("p_name", T.StringType(), False, (Rule("matches", r"^[a-z]+ (ring|bolt|widget)\z"),)),
        Field("p_brand", T.StringType(), False, (Rule("matches", r"^Brand#[0-9]\z"),)),
        Field("p_type", T.StringType(), True, (Rule("isin", ("ECONOMY", "LARGE", "SMALL")),)),
        Field("p_size", T.IntegerType(), True, (Rule("ge", 3), Rule("lt", 45))),
        Field("p_retailprice", T.DoubleType(), True, (Rule("le", 1500.0),)),
    ),
    key=("p_partkey",),
)

LINEITEM = Contract(
    "lineitem",
    "1.0.0",
    (
        Field("l_orderkey", T.LongType(), False),
        Field("l_quantity", T.DoubleType(), False, (Rule("ge", 2.0), Rule("le", 45.0))),
        Field("l_discount", T.DoubleType(), False, (Rule("ge", 0.0), Rule("lt", 0.1))),
        Field("l_flag", T.StringType(), False, (Rule("isin", ("A", "R")),)),
        Field("l_shipdate", T.DateType(), False, (Rule("ge", dt.date(1995, 6, 1)),)),
    ),
)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_quantity",
        "l_discount",
        "case when l_linestatus = 'O' then l_returnflag end as l_flag",
        "cast(l_shipdate as date) as l_shipdate",
    )


@query
def contract_violations(spark, sf):
    return contracts.violations(table(spark, sf, "part"), PART, keep=["p_partkey"])


@query
def contract_summary(spark, sf):
    return contracts.violation_summary(_lines(spark, sf), LINEITEM)


@query
def registry_violations(spark, sf):
    from starledger.plans.contracts import REGISTRY

    registry = pages.type_records(inputs.raw_registry(spark, sf))
    return contracts.violations(registry, REGISTRY)


@query
def gp_violations(spark, sf):
    from starledger.plans.contracts import GP

    return contracts.violation_summary(inputs.whole_catalog(spark, sf, inputs.GP_COLUMNS), GP)


@query
def satcat_violations(spark, sf):
    from starledger.plans.contracts import SATCAT

    return contracts.violation_summary(inputs.whole_catalog(spark, sf, inputs.SATCAT_COLUMNS), SATCAT)


@query
def canonical_violations(spark, sf):
    from starledger.plans.contracts import CANONICAL

    return contracts.violation_summary(_canonical(spark, sf, None), CANONICAL)


@query
def gp_csv(spark, sf):
    """The whole GP catalog, written as CSV and read with declared types."""
    from starledger.plans.contracts import GP

    path = scratch_path(spark, "gp-csv")
    inputs.whole_catalog(spark, sf, inputs.GP_COLUMNS).write.option("header", True).csv(path)
    return catalogs.read_catalog(spark, path, GP.schema)


@query
def satcat_csv(spark, sf):
    """The whole satellite catalog, written as CSV and read with declared types."""
    from starledger.plans.contracts import SATCAT

    path = scratch_path(spark, "satcat-csv")
    inputs.whole_catalog(spark, sf, inputs.SATCAT_COLUMNS).write.option("header", True).csv(path)
    return catalogs.read_catalog(spark, path, SATCAT.schema)


def _ragged(spark: SparkSession, sf: str) -> catalogs.Inspection:
    path = scratch_path(spark, "ragged-csv")
    # One column of whole lines, named as the header; with another separator it stays unquoted.
    inputs.ragged_lines(spark, sf).write.options(header=True, sep="\t").csv(path)
    return catalogs.inspect_catalog(spark, path, RAGGED_SCHEMA)


@query
def csv_quarantine(spark, sf):
    """Lines and cells that cannot be read; whether their file is named."""
    found = _ragged(spark, sf).quarantine
    return found.select("problem", "column_name", "value", F.col("file").contains("ragged-csv").alias("has_file"))


@query
def csv_accepted(spark, sf):
    """The typed rows of all other lines."""
    return _ragged(spark, sf).rows


@query
def landed_bodies(spark, sf):
    """What becomes of a catalog file with rows, of one with a header alone, of an empty one."""
    lines = inputs.satcat(spark, sf)
    outcomes = []
    for name, df in (("rows", lines), ("header only", lines.where("NORAD_CAT_ID < 0")), ("empty", None)):
        path = scratch_path(spark, "body")
        if df is None:
            lines.where("NORAD_CAT_ID < 0").select("OBJECT_NAME").write.text(path)
        else:
            df.write.option("header", True).csv(path)
        try:
            rows = catalogs.read_catalog(spark, path, SATCAT_SCHEMA)
            outcomes.append(rows.agg(F.lit(name).alias("body"), F.lit("read").alias("outcome"), F.count("*").alias("n")))
        except ValueError:
            n = F.lit(None).cast("long").alias("n")
            outcomes.append(spark.range(1).select(F.lit(name).alias("body"), F.lit("refused").alias("outcome"), n))
    return outcomes[0].unionByName(outcomes[1]).unionByName(outcomes[2])


@query
def empty_load(spark, sf):
    """Columns of a load whose pages have no records, beside those of a full one."""
    full = inputs.registry_pages(spark, sf)
    empty = full.select(F.regexp_replace("page", r'(?s)"results": \[.*', '"results": []}').alias("page"))
    parts = []
    for label, df in (("empty", pages.load_registry(empty)), ("full", pages.load_registry(full))):
        named = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("dtype")) for c, t in df.dtypes])
        counted = df.agg(F.lit(label).alias("load"), F.count("*").alias("n"))
        parts.append(counted.select("load", "n", F.inline(named)))
    return parts[0].unionByName(parts[1])


@query
def missing_columns(spark, sf):
    """Compared columns that a table lacks, with its rows."""
    wanted = (inputs.DIFF_KEY, *inputs.DIFF_COLUMNS)
    parts = []
    for name in ("orders", "lineitem", "customer"):
        df = table(spark, sf, name)
        lacking = F.array(*map(F.lit, diff.missing_columns(df, wanted)))
        counted = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        parts.append(counted.select("table_name", "n", F.explode(lacking).alias("column_name")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def snapshot_date_inside(spark, sf):
    """Snapshots whose files hold their own date: read by date, and as a history."""
    base = scratch_path(spark, "dated")
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(path)
    days = [dt.date.fromisoformat(day) for day in inputs.SNAPSHOT_DATES]
    for day, df in zip(days, (inputs.previous_orders(spark, sf), inputs.current_orders(spark, sf))):
        snapshots.save_snapshot(df.withColumn("snapshot_date", F.lit(day)), day, base)
    counted = [
        df.groupBy(F.lit(label).alias("read"), "snapshot_date", "o_orderstatus").agg(F.count("*").alias("n"))
        for label, df in (("history", snapshots.load_history(spark, base)), ("date", snapshots.load_snapshot(spark, days[1], base)))
    ]
    return counted[0].unionByName(counted[1])


@query
def edge_space_counts(spark, sf):
    return expectations.edge_space_counts(inputs.raw_registry(spark, sf))


@query
def snapshot_evolution(spark, sf):
    """Two dates of one major version, the later one with an appended column."""
    base = scratch_path(spark, "evolution")
    spark._jvm.org.apache.hadoop.fs.FileSystem.get(
        spark._jvm.java.net.URI(base), spark._jsparkSession.sessionState().newHadoopConf()
    ).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(base))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    earlier, later = map(dt.date.fromisoformat, inputs.SNAPSHOT_DATES)
    snapshots.save_snapshot(orders.drop("o_orderpriority"), earlier, base, version="1.0.0")
    snapshots.save_snapshot(orders, later, base, version="1.1.0")
    history = snapshots.load_history(spark, base, version="1.0.0")
    return history.groupBy("snapshot_date", "o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("n")
    )


def _weekly(spark: SparkSession, sf: str) -> DataFrame:
    """Two weekly runs over landed pages; the later load has other states."""
    from starledger.plans.weekly import weekly_ingest

    base = scratch_path(spark, "weekly")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for folder in (f"{base}/snapshots", f"{base}/changes"):
        fs.mkdirs(path(folder))
    load = inputs.weekly_pages(spark, sf, later=False), inputs.weekly_pages(spark, sf, later=True)
    days = [dt.date.fromisoformat(d) for d in inputs.SNAPSHOT_DATES]
    for day, landed in zip(days, load):
        last = weekly_ingest(
            landed, day, f"{base}/snapshots", as_of_year=AS_OF_YEAR, changelog_base=f"{base}/changes"
        )
    return last


@query
def weekly_run(spark, sf):
    """All reports of the second of two runs, as (report, name, passed, count)."""
    last = _weekly(spark, sf)
    reports = [
        df.select(F.lit(label).alias("report"), "name", "passed", F.col("count").cast("long").alias("n"))
        for label, df in (("expectations", last.expectations), ("drift", last.drift))
    ]
    counted = last.diff.counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit("diff").alias("report"), F.lit(c).alias("name"), F.lit(True).alias("passed"), F.col(c).alias("n"))
                    for c in ("n_added", "n_removed", "n_modified_rows", "n_modified_changes")
                ]
            )
        )
    )
    warned = last.warnings.groupBy(F.col("warning").alias("name")).agg(F.count("*").alias("n"))
    warned = warned.select(F.lit("warnings").alias("report"), "name", F.lit(False).alias("passed"), "n")
    return reports[0].unionByName(reports[1]).unionByName(counted).unionByName(warned)


@query
def changelog(spark, sf):
    """Changed values that two weekly runs left in the changelog."""
    last = _weekly(spark, sf)
    logged = spark.read.parquet(last.changelog)
    return logged.select(column("International Designator").alias("designator"), "column_name", "old_value", "new_value", "n_pairs")


@query
def contract_evolution(spark, sf):
    """Changes between the contracts that two snapshots' values keep, by tier."""
    before, after = (
        _observed_contract(df)
        for df in (inputs.previous_orders(spark, sf), inputs.current_orders(spark, sf))
    )
    found = contracts.contract_changes(before, after)
    return spark.createDataFrame(found, "column_name string, change string, tier string")


def _observed_contract(df: DataFrame) -> Contract:
    """Value sets and ranges of all rows, as a contract; a handful of values by nature."""
    row = df.agg(
        F.sort_array(F.collect_set("o_orderpriority")), F.sort_array(F.collect_set("o_orderstatus")),
        F.min("o_orderdate"), F.max("o_orderdate"),
    ).first()
    dates = (Rule("ge", row[2]), Rule("le", row[3]))
    return Contract(
        "orders",
        "1.0.0",
        (
            Field("o_orderpriority", T.StringType(), rules=(Rule("isin", tuple(row[0])),)),
            Field("o_orderstatus", T.StringType(), rules=(Rule("isin", tuple(row[1])),)),
            Field("o_orderdate", T.DateType(), rules=dates),
        ),
    )


@query
def duplicate_keys(spark, sf):
    return contracts.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


CUSTOMER = Contract(
    "customer",
    "1.0.0",
    (
        Field("c_custkey", T.LongType(), False),
        Field("c_name", T.StringType(), False),
        Field("c_mktsegment", T.StringType(), False),
        Field("c_nationkey", T.LongType(), False),
        Field("c_acctbal", T.DoubleType()),
        Field("c_phone", T.StringType()),
    ),
)


@query
def schema_contract(spark, sf):
    return contracts.schema_report(table(spark, sf, "customer"), CUSTOMER)


@query
def row_warnings(spark, sf):
    registry = pages.type_records(inputs.raw_registry(spark, sf))
    return expectations.row_warnings(registry).select(
        column("Name of Space Object").alias("name"), "warning"
    )


# --- expectations -------------------------------------------------------------------


@query
def expectations_report(spark, sf):
    before = inputs.previous_orders(spark, sf).count()
    return expectations.check_expectations(inputs.raw_registry(spark, sf), before, AS_OF_YEAR)


@query
def rare_values(spark, sf):
    return expectations.rare_values(inputs.raw_registry(spark, sf), "State of Registry", below=5)


@query
def top_values(spark, sf):
    return expectations.top_values(table(spark, sf, "part"), "p_brand")


@query
def drift_report(spark, sf):
    def as_registry(df: DataFrame) -> DataFrame:
        return df.select("*", (F.col("o_orderstatus") == "P").alias("flagged"))

    return expectations.check_drift(
        as_registry(inputs.previous_orders(spark, sf)),
        as_registry(inputs.current_orders(spark, sf)),
        _order_diff(spark, sf).added,
        flag="flagged",
        category="o_custkey",
    )


# --- names, orbits, matching --------------------------------------------------------


@query
def normalize_names(spark, sf):
    return with_normal_name(inputs.decorated_names(spark, sf), "name", "normal_name")


@query
def name_scores(spark, sf):
    """Each part's name against that of the part before it of its size and type."""
    deb = F.when(F.col("p_size") % 2 == 0, " deb").otherwise("")
    name = F.concat("p_name", F.lit(" "), F.lower("p_brand"), deb)
    before = Window.partitionBy("p_size", "p_type").orderBy("p_partkey")
    pairs = table(spark, sf, "part").select("p_partkey", name.alias("name"), F.lag(name).over(before).alias("other"))
    scored = pairs.where("other is not null").withColumn("score", token_set_score("name", "other"))
    return scored.withColumn("confidence", match.match_confidence(F.lit(match.FUZZY), F.col("score")))


@query
def orbit_regimes(spark, sf):
    regime = orbit_regime(F.col("l_quantity") / 3, F.col("l_discount") * 4)
    return (
        table(spark, sf, "lineitem")
        .groupBy(regime.alias("regime"), "l_linestatus")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    return canonical.join_catalogs(
        inputs.gp_catalog(spark, sf), inputs.satcat(spark, sf), keys_unique=True
    )


@query
def catalog_outer_join(spark, sf):
    return _catalog(spark, sf)


@query
def catalog_repeated_numbers(spark, sf):
    """Both catalogs with numbers that repeat: pairs and rows left on either side."""
    gp, satcat = (
        df.withColumn("NORAD_CAT_ID", F.expr("NORAD_CAT_ID div 7 * 7 % 1001"))
        for df in (inputs.gp_catalog(spark, sf), inputs.satcat(spark, sf))
    )
    joined = canonical.join_catalogs(gp, satcat)
    return joined.groupBy("NORAD_CAT_ID").agg(
        F.count_if(F.col("in_gp") & F.col("in_satcat")).alias("pairs"),
        F.count_if(F.col("in_gp") & ~F.col("in_satcat")).alias("gp_only"),
        F.count_if(~F.col("in_gp") & F.col("in_satcat")).alias("satcat_only"),
    )


@query
def catalog_report(spark, sf):
    return canonical.catalog_report(_catalog(spark, sf))


def _matched(spark: SparkSession, sf: str, threshold: float | None) -> DataFrame:
    return match.match_catalogs(
        match.Side(
            inputs.matching_registry(spark, sf),
            "International Designator",
            "Name of Space Object",
            "Date of Launch",
        ),
        match.Side(
            _catalog(spark, sf).where("OBJECT_ID is not null"),
            "OBJECT_ID",
            "OBJECT_NAME",
            "LAUNCH_DATE",
            tie=(canonical.CATALOG_KEY,),
        ),
        threshold,
    )


def _match_columns(matched: DataFrame) -> DataFrame:
    return matched.select(
        column("l").getField("International Designator").alias("designator"),
        F.col("r.NORAD_CAT_ID").alias("norad_cat_id"),
        "match_source",
        "match_score",
        "match_confidence",
        "source_presence",
    )


@query
def hierarchical_match(spark, sf):
    return _match_columns(_matched(spark, sf, None)).drop("match_score")


@query
def match_report(spark, sf):
    return match.match_report(_matched(spark, sf, None))


@query
def fuzzy_match(spark, sf):
    return _match_columns(_matched(spark, sf, match.FUZZY_THRESHOLD))


def _canonical(spark: SparkSession, sf: str, threshold: float | None) -> DataFrame:
    return canonical.build_canonical(
        inputs.matching_registry(spark, sf),
        inputs.gp_catalog(spark, sf),
        inputs.satcat(spark, sf),
        DAY,
        threshold,
    ).rows


@query
def canonical_rows(spark, sf):
    return _canonical(spark, sf, None)


@query
def canonical_fuzzy(spark, sf):
    return _canonical(spark, sf, match.FUZZY_THRESHOLD)


@query
def canonical_precedence(spark, sf):
    """Decay dates of three sources: the registry's, then the third one's, then the catalogs'."""
    tracking = inputs.satcat(spark, sf).where("NORAD_CAT_ID % 3 = 0").select(
        "NORAD_CAT_ID", F.date_add("LAUNCH_DATE", 333).alias("DECAY_DATE")
    )
    built = canonical.build_canonical(
        inputs.matching_registry(spark, sf), inputs.gp_catalog(spark, sf), inputs.satcat(spark, sf),
        DAY, None, tracking=tracking,
    )
    return built.rows.select("cospar_id", "norad_cat_id", "date_of_decay", "match_source")


@query
def orbit_gap(spark, sf):
    return analysis.orbit_gap(_canonical(spark, sf, None), {"OWN1": "State 1", "OWN2": "State 2"})


# --- reports ------------------------------------------------------------------------

FAMILIES = {"blue": "Blue fleet", "red": "Red fleet"}
STATES = {"NATION_1": "NATION_0", "NATION_2": "NATION_0"}


@query
def constellations(spark, sf):
    tagged = analysis.with_constellations(table(spark, sf, "part"), "p_name", FAMILIES)
    return tagged.groupBy("constellation_id", "is_megaconstellation").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def outside_constellations(spark, sf):
    rest = analysis.without_constellations(table(spark, sf, "part"), "p_name", FAMILIES)
    return rest.select("p_partkey", "p_name")


@query
def state_equivalence(spark, sf):
    nations = table(spark, sf, "nation")
    customers = table(spark, sf, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    state = F.expr(
        """case when c_mktsegment = 'BUILDING' then concat(n_name, ' (for ', c_name, ')')
                else n_name end"""
    )
    return customers.select(
        "c_custkey",
        analysis.canonical_state(state, STATES).alias("state"),
        analysis.registered_for(state).alias("registered_for"),
    )


@query
def registration_by_decade(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("launch"), (F.col("o_orderstatus") == "F").alias("flag")
    )
    return analysis.registration_by_decade(orders, "launch", "flag")


@query
def compliance_lag(spark, sf):
    orders = table(spark, sf, "orders")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").cast("date").alias("shipped")
    )
    lag = analysis.compliance_lag("shipped", F.col("o_orderdate").cast("date"))
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("o_orderstatus")
        .agg(
            F.min(lag).alias("shortest"),
            F.max(lag).alias("longest"),
            F.count(lag).alias("known"),
            F.sum(lag).alias("total_days"),
        )
    )
