"""Registry of the queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmart.bound import AS_OF, BoundTables, bound
from haulmart.contracts import DIMENSIONS, FACTS, STAGING, contract
from haulmart.operators import profile
from haulmart.operators.checks import Check, Tables
from haulmart.operators.integrity import orphan_rows
from haulmart.operators.keys import assign_surrogate_key
from haulmart.operators.shape import looked_up
from haulmart.plans import audit, gates, measures, profiling
from haulmart.plans.clean import CLEAN_VIEWS
from haulmart.plans.facts import FACT_PLANS
from haulmart.plans.pipeline import publish_views, published
from haulmart.plans.reporting import REPORTS
from haulmart.sources.binding import scan
from haulmart.sources.feeds import REASON, reject_counts
from haulmart.sources.snapshots import reload_table

# Fixed value: the reason of rows without a required value.
MISSING = "missing_value"

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Plain result types: decimals as double, booleans as 0/1."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def _on_layers(plan: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(plan(bound(spark, sf_dir).layers))


def _on_warehouse(plan: Callable[[Tables], DataFrame]) -> Query:
    """For queries that touch most tables: load them side by side first."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        layers = bound(spark, sf_dir).layers
        layers.load_warehouse()
        return comparable(plan(layers))

    return query


def _on_bound(plan: Callable[[BoundTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(plan(bound(spark, sf_dir)))


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- sources and sinks -----------------------------------------------------


def _parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("date").alias("l_shipdate")
    )


def _ingest(table: str) -> Query:
    return _on_bound(lambda b: b.ingested(table).good)


def _ingest_rejects(b: BoundTables) -> DataFrame:
    return reject_counts(_union(b.ingested(c.name).rejects for c in STAGING))


def _named_rejects(b: BoundTables, reason: str) -> DataFrame:
    """table_name, record_key and the number of rejected rows, over all feeds."""
    parts = []
    for c in STAGING:
        rows = b.ingested(c.name).rejects.filter(F.col(REASON) == reason)
        key = F.concat_ws("|", *[F.get_json_object("record", f"$.{k}") for k in c.primary_key])
        empty = [
            F.when(F.get_json_object("record", f"$.{f.name}").isNull(), f.name)
            for f in c.fields
            if not f.nullable
        ]
        parts.append(
            rows.select(
                "table_name",
                key.alias("record_key"),
                F.concat_ws(",", *empty).alias("missing_columns"),
                "copies",
            )
        )
    keys = ["table_name", "record_key", *(["missing_columns"] if reason == MISSING else [])]
    return _union(parts).groupBy(*keys).agg(F.sum("copies").alias("rejected_rows"))


def _null_rejects(b: BoundTables) -> DataFrame:
    """Rejected rows that miss a required value, with the columns that are empty."""
    return _named_rejects(b, MISSING)


def _key_rejects(b: BoundTables) -> DataFrame:
    """Rows that lost to another row of the same key."""
    return _named_rejects(b, "duplicate_key")


def _truncate_reload(b: BoundTables) -> DataFrame:
    path = b.workspace.new_path("reloaded")
    reload_table(b.layers("staging_routes"), path)
    return reload_table(b.layers("staging_routes"), path)


def _published_counts(contracts) -> Callable[[BoundTables], DataFrame]:
    def plan(b: BoundTables) -> DataFrame:
        pipeline, _ = b.load()
        return audit.row_counts(published(pipeline.snapshots), [c.name for c in contracts])

    return plan


def _publish_views(b: BoundTables) -> DataFrame:
    b.layers.load_warehouse()
    publish_views(b.layers)
    names = [*CLEAN_VIEWS, *REPORTS]
    return audit.row_counts(b.spark.table, names)


def _step_log(b: BoundTables) -> DataFrame:
    pipeline, result = b.load()
    steps = pipeline.log.steps().filter(F.col("RunID") == result.run_id)
    return steps.filter(F.col("StepName").like("Load %")).select(
        "StepName", "RowsProcessed", "Status"
    )


def _surrogate_keys(b: BoundTables) -> DataFrame:
    """Dense keys for every order that has lines, in order of its number."""
    orders = scan(b.spark, b.sf_dir, "lineitem").select("l_orderkey").distinct()
    return assign_surrogate_key(orders, "l_orderkey", "OrderID", b.workspace)


def _contract_columns(tables: Tables) -> DataFrame:
    """Every NOT NULL column of the stored tables with the nulls found in it."""
    required = {
        c.name: {f.name: f.sql_type for f in c.fields if not f.nullable}
        for c in STAGING + DIMENSIONS + FACTS
    }
    declared = {f"{t}.{c}": kind for t, fields in required.items() for c, kind in fields.items()}
    nulls = profile.null_profile(lambda name: tables(name).select(*required[name]), audit.STORED)
    return nulls.withColumn("_name", F.concat_ws(".", "TableName", "ColumnName")).select(
        "TableName", "ColumnName", looked_up("_name", declared).alias("SqlType"), "NullCount"
    )


SOURCES: dict[str, Query] = {
    "parquet_scan": _parquet_scan,
    "ingest_sales": _ingest("staging_sales"),
    "ingest_deliveries": _ingest("staging_deliveries"),
    "ingest_routes": _ingest("staging_routes"),
    "ingest_exceptions": _ingest("staging_exceptions"),
    "ingest_rejects": _on_bound(_ingest_rejects),
    "ingest_notnull_quarantine": _on_bound(_null_rejects),
    "ingest_pk_quarantine": _on_bound(_key_rejects),
    "staging_atomic_load": _on_bound(_published_counts(STAGING)),
    "truncate_reload": _on_bound(_truncate_reload),
    "dw_atomic_publish": _on_bound(_published_counts(DIMENSIONS + FACTS)),
    "published_snapshot": _on_bound(
        lambda b: measures.sales_by_region_product_month(published(b.load()[0].snapshots))
    ),
    "publish_views": _on_bound(_publish_views),
    "etl_step_log": _on_bound(_step_log),
    "assign_surrogate_key": _on_bound(_surrogate_keys),
    "table_contracts": _on_warehouse(_contract_columns),
}


# --- layers ----------------------------------------------------------------


def _table(name: str) -> Query:
    return _on_layers(lambda tables: tables(name))


def _fact(name: str) -> Query:
    return _on_layers(lambda tables: tables(name).drop("load_ts"))


LAYER_TABLES: dict[str, Query] = {
    **{c.name: _table(c.name) for c in STAGING},
    **{name: _table(name) for name in CLEAN_VIEWS},
    **{c.name: _table(c.name) for c in DIMENSIONS},
    **{name: _fact(name) for name in FACT_PLANS},
    **{name: _table(name) for name in REPORTS},
    "orphan_rows": _on_layers(
        lambda t: orphan_rows(t.parts("staging_sales"), t.parts("clean_deliveries"), "DeliveryID")
    ),
}


# --- gates -----------------------------------------------------------------


def _single(check: Check) -> Query:
    return _on_layers(check.result)


GATES: dict[str, Query] = {
    **{
        c.key: _single(c)
        for c in [*gates.staging_checks(AS_OF), *gates.clean_checks(), *gates.warehouse_checks()]
        if not c.key.startswith("dw_not_empty_")
    },
    "gate_staging": _on_layers(lambda t: gates.gate_staging(t, AS_OF)),
    "gate_clean": _on_layers(gates.gate_clean),
    "gate_dw": _on_warehouse(gates.gate_warehouse),
    "stg_row_counts": _on_layers(lambda t: audit.row_counts(t, [c.name for c in STAGING])),
    "stg_null_detail": _on_layers(gates.null_detail),
    "dw_not_empty": _on_warehouse(
        lambda t: _union(
            c.result(t) for c in gates.warehouse_checks() if c.key.startswith("dw_not_empty_")
        )
    ),
    "dw_fk_all": _on_warehouse(gates.reference_report),
    "dw_fact_vs_clean": _on_layers(audit.fact_versus_clean),
    "dw_row_counts": _on_warehouse(
        lambda t: audit.layer_row_counts(t, [(c.layer, c.name) for c in DIMENSIONS + FACTS])
    ),
    "dw_sales_metric_summary": _on_layers(audit.sales_metrics),
}


# --- profiling and review --------------------------------------------------


def _per_view(prefix: str, plan) -> dict[str, Query]:
    return {
        f"{prefix}_{view.removeprefix('clean_')}": _on_layers(lambda t, v=view: plan(t, v))
        for view in CLEAN_VIEWS
    }


PROFILES: dict[str, Query] = {
    **_per_view("prof_retention", profiling.retention),
    **_per_view("prof_nulls", profiling.required_nulls),
    "prof_incorrect_late": _on_layers(profiling.incorrect_late),
    "prof_invalid_priority": _on_layers(profiling.invalid_priority),
    "prof_date_corrected": _on_layers(profiling.date_corrected),
    "prof_invalid_routes": _on_layers(profiling.invalid_routes),
    "prof_orphan_sales": _on_layers(
        lambda t: profiling.orphans(t, "clean_sales", "OrphanedSalesDeliveryIDs")
    ),
    "prof_orphan_exceptions": _on_layers(
        lambda t: profiling.orphans(t, "clean_exceptions", "OrphanedExceptionDeliveryIDs")
    ),
    "prof_nonpositive_sales": _on_layers(profiling.nonpositive_sales),
    "prof_future_deliveries": _on_layers(
        lambda t: profiling.future_rows(
            t, "clean_deliveries", "DeliveryDate", "FutureDatedDeliveries", AS_OF
        )
    ),
    "prof_future_exceptions": _on_layers(
        lambda t: profiling.future_rows(
            t, "clean_exceptions", "DateReported", "FutureDatedExceptions", AS_OF
        )
    ),
    "prof_sales_by_region": _on_layers(profiling.sales_by_region),
    "prof_units_by_product": _on_layers(profiling.units_by_product),
    "prof_status_distribution": _on_layers(profiling.status_distribution),
    "prof_route_efficiency": _on_layers(profiling.route_summary),
    "val_row_counts": _on_layers(profiling.layer_row_counts),
    "val_null_sales": _on_layers(profiling.null_sales),
    "val_null_deliveries": _on_layers(profiling.null_deliveries),
    "val_null_exceptions": _on_layers(profiling.null_exceptions),
    "val_late_rule_top20": _on_layers(profiling.late_rule_offenders),
    "val_priority_distribution": _on_layers(profiling.priority_distribution),
    "val_date_corrected": _on_layers(
        lambda t: profiling.date_corrected(t, "DateCorrectedCount")
    ),
    "val_orphan_sales": _on_layers(lambda t: profiling.orphan_list(t, "clean_sales", "SalesID")),
    "val_orphan_exceptions": _on_layers(
        lambda t: profiling.orphan_list(t, "clean_exceptions", "ExceptionID")
    ),
    "val_sales_profile": _on_layers(profiling.sales_profile),
    "val_region_distribution": _on_layers(profiling.region_distribution),
    "val_route_profile": _on_layers(profiling.route_profile),
}


# --- audit -----------------------------------------------------------------


def _null_profile(tables: Tables) -> DataFrame:
    return profile.null_profile(tables, audit.STORED)


def _duplicate_keys(b: BoundTables) -> DataFrame:
    """The stored tables, and the feeds as they land, which do hold duplicates."""
    feeds = [
        audit.duplicate_keys(b.landed_keys(c.name), c, c.name.replace("staging_", "feed."))
        for c in STAGING
    ]
    b.layers.load_warehouse()
    return _union([audit.all_duplicate_keys(b.layers), *feeds])


def _freshness(tables: Tables) -> DataFrame:
    utc = F.to_utc_timestamp("LastLoad", F.current_timezone())
    return audit.freshness(tables).select(
        "TableName", F.date_format(utc, "yyyy-MM-dd").alias("LastLoad"), "RowCount", "NewestDate"
    )


AUDITS: dict[str, Query] = {
    "aud_row_counts": _on_warehouse(lambda t: audit.layer_row_counts(t, audit.STORED)),
    "aud_dup_keys": _on_bound(_duplicate_keys),
    "aud_dup_keys_routes": _on_layers(
        lambda t: audit.duplicate_keys(t("fact_routes"), contract("fact_routes"))
    ),
    "aud_null_counts": _on_warehouse(
        lambda t: profile.most_null_first(profile.with_nulls(_null_profile(t)))
    ),
    "aud_null_over_20": _on_warehouse(
        lambda t: profile.most_null_first(profile.critical(_null_profile(t)))
    ),
    "aud_freshness": _on_layers(_freshness),
    "aud_fact_sizes": _on_layers(audit.fact_sizes),
    "aud_orphans": _on_warehouse(audit.orphans),
    "col_row_counts": _on_warehouse(
        lambda t: _null_profile(t)
        .groupBy("SchemaName", "TableName")
        .agg(F.max("TotalRows").alias("RowCount"))
        .orderBy("SchemaName", "TableName")
    ),
    "col_null_profile": _on_warehouse(lambda t: profile.most_null_first(_null_profile(t))),
    "col_scorecard": _on_warehouse(lambda t: profile.scorecard(_null_profile(t))),
    "col_critical": _on_warehouse(
        lambda t: profile.most_null_first(profile.critical(_null_profile(t)))
    ),
}

MEASURES: dict[str, Query] = {
    name: _on_layers(plan) for name, plan in measures.MEASURES.items()
}

QUERIES: dict[str, Query] = {
    **SOURCES,
    **LAYER_TABLES,
    **GATES,
    **PROFILES,
    **AUDITS,
    **MEASURES,
}
