"""One canonical table from the registry and the two orbital catalogs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.functions.orbit import orbit_regime
from starledger.functions.text import column, first_known
from starledger.operators.contracts import duplicate_keys, validate
from starledger.operators.match import FUZZY_THRESHOLD, Side, match_catalogs
from starledger.operators.ranking import Queue, digest_bucket, pair_by_position
from starledger.plans.contracts import CANONICAL
from starledger.sources.shared import materialize
from starledger.sources.snapshots import save_snapshot

CATALOG_KEY = "NORAD_CAT_ID"
TRACKED_DECAY = "TRACKED_DECAY_DATE"


@dataclass(frozen=True)
class CanonicalBuild:
    """Canonical rows and the one-row report of what was left out or contradictory."""

    rows: DataFrame
    report: DataFrame


def join_catalogs(gp: DataFrame, satcat: DataFrame, keys_unique: bool = False) -> DataFrame:
    """GP and SATCAT on the catalog number; rows of either side alone are kept.

    The name comes from GP, else SATCAT; the designator from SATCAT, else GP. `id_differs`
    marks rows whose designators contradict each other.
    """

    def queue(df: DataFrame, side: str) -> Queue:
        own = df.select(
            column(CATALOG_KEY),
            F.struct(*map(column, df.columns)).alias(side),
            F.lit(0).alias(f"{side}_id"),
        )
        if not keys_unique:
            numbered = own.withColumn(f"{side}_id", F.monotonically_increasing_id())
            own = materialize(numbered, f"catalog-{side}")
        row_id = F.col(f"{side}_id")
        bucket = digest_bucket(F.xxhash64(side))
        return Queue(own, bucket, (F.col(side),), row_id)

    both = pair_by_position(queue(gp, "g"), queue(satcat, "s"), [CATALOG_KEY], keys_unique)
    in_both = F.col("g").isNotNull() & F.col("s").isNotNull()
    return both.select(
        F.col(CATALOG_KEY),
        F.coalesce("s.OBJECT_ID", "g.OBJECT_ID").alias("OBJECT_ID"),
        F.coalesce("g.OBJECT_NAME", "s.OBJECT_NAME").alias("OBJECT_NAME"),
        F.col("s.OWNER").alias("OWNER"),
        F.col("s.LAUNCH_DATE").alias("LAUNCH_DATE"),
        F.col("s.DECAY_DATE").alias("DECAY_DATE"),
        F.col("g.MEAN_MOTION").alias("MEAN_MOTION"),
        F.col("g.ECCENTRICITY").alias("ECCENTRICITY"),
        F.col("g").isNotNull().alias("in_gp"),
        F.col("s").isNotNull().alias("in_satcat"),
        (in_both & ~F.col("s.OBJECT_ID").eqNullSafe(F.col("g.OBJECT_ID"))).alias("id_differs"),
    )


def catalog_report(catalog: DataFrame) -> DataFrame:
    """Catalog rows by origin, contradictory designators, and rows without a designator."""
    in_gp, in_satcat = F.col("in_gp"), F.col("in_satcat")
    return catalog.agg(
        F.count_if(in_gp & in_satcat).alias("in_both"),
        F.count_if(in_gp & ~in_satcat).alias("gp_only"),
        F.count_if(~in_gp & in_satcat).alias("satcat_only"),
        F.count_if("id_differs").alias("designators_differ"),
        F.count_if(F.col("OBJECT_ID").isNull()).alias("rows_excluded"),
    )


def with_tracking(catalog: DataFrame, tracking: DataFrame) -> DataFrame:
    """Add the decay dates of a third source, by catalog number; several count as the first."""
    known = tracking.where(F.col(CATALOG_KEY).isNotNull()).groupBy(CATALOG_KEY)
    dates = known.agg(F.min("DECAY_DATE").alias(TRACKED_DECAY))
    return catalog.join(dates, CATALOG_KEY, "left")


def to_canonical(matched: DataFrame, snapshot_date: date) -> DataFrame:
    """Matched rows in canonical columns.

    A field that several sources have takes the first known value of the registry, the
    third source where there is one, and the catalogs.
    """
    sources = ["l.Date of Decay", f"r.{TRACKED_DECAY}", "r.DECAY_DATE"]
    if TRACKED_DECAY not in matched.schema["r"].dataType.names:
        del sources[1]
    values = {
        "cospar_id": first_known(map(F.col, ("l.International Designator", "r.OBJECT_ID"))),
        "norad_cat_id": "r.NORAD_CAT_ID",
        "name_unoosa": "l.Name of Space Object",
        "object_name_celestrak": "r.OBJECT_NAME",
        "state_unoosa": "l.State of Registry",
        "country_celestrak": "r.OWNER",
        "launch_date_unoosa": "l.Date of Launch",
        "launch_date_celestrak": "r.LAUNCH_DATE",
        "status": "l.Status",
        "date_of_decay": first_known(map(F.col, sources)),
        "un_registered": "l.UN Registered",
        "registration_documents": "l.Registration Documents",
        "function": "l.Function",
        "mean_motion": "r.MEAN_MOTION",
        "eccentricity": "r.ECCENTRICITY",
        "orbit_regime_canonical": orbit_regime(F.col("r.MEAN_MOTION"), F.col("r.ECCENTRICITY")),
        "orbit_regime_confidence": F.lit(None),
        "match_source": "match_source",
        "match_score": "match_score",
        "match_confidence": "match_confidence",
        "source_presence": "source_presence",
        "function_canonical": F.lit(None),
        "function_canonical_confidence": F.lit(None),
        "snapshot_date": F.lit(snapshot_date),
    }
    columns = [(f, values[f.name]) for f in CANONICAL.fields]
    return matched.select(
        *[
            (F.col(v) if isinstance(v, str) else v).cast(f.dtype).alias(f.name)
            for f, v in columns
        ]
    )


def _unique(df: DataFrame, key: str) -> bool:
    return duplicate_keys(df, [key]).isEmpty()


def build_canonical(
    registry: DataFrame,
    gp: DataFrame,
    satcat: DataFrame,
    snapshot_date: date,
    fuzzy_threshold: float | None = FUZZY_THRESHOLD,
    keys_unique: bool | None = None,
    tracking: DataFrame | None = None,
) -> CanonicalBuild:
    """Join the catalogs, match them to the registry, and map to the canonical columns.

    `tracking` is a third source with NORAD_CAT_ID and DECAY_DATE; its dates stand between
    those of the registry and of the catalogs.

    Catalog rows without a designator are left out and counted in the report. Whether
    designators and catalog numbers are unique is looked up on the key columns alone
    unless `keys_unique` says it.
    """
    catalog_unique = designators_unique = keys_unique
    if keys_unique is None:
        catalog_unique = _unique(gp, CATALOG_KEY) and _unique(satcat, CATALOG_KEY)
    catalog = join_catalogs(gp, satcat, catalog_unique)
    if tracking is not None:
        catalog = with_tracking(catalog, tracking)
    if keys_unique is None:
        designators_unique = _unique(registry, "International Designator") and _unique(catalog, "OBJECT_ID")
    matched = match_catalogs(
        Side(registry, "International Designator", "Name of Space Object", "Date of Launch"),
        Side(
            catalog.where("OBJECT_ID is not null"),
            "OBJECT_ID",
            "OBJECT_NAME",
            "LAUNCH_DATE",
            tie=(CATALOG_KEY,),
        ),
        fuzzy_threshold,
        designators_unique,
    )
    return CanonicalBuild(to_canonical(matched, snapshot_date), catalog_report(catalog))


def publish_canonical(
    build: CanonicalBuild, snapshot_date: date, base: str, overwrite: bool = False
) -> str:
    """Check the canonical rows against their contract and store them.

    The rows are computed once into a written table. Their designators must be unique;
    the contract version goes into the files, and `snapshot_date` stays inside them.
    """
    rows = validate(materialize(build.rows, "canonical"), CANONICAL, unique_key=True)
    return save_snapshot(rows, snapshot_date, base, overwrite, version=CANONICAL.version)
