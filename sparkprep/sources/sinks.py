"""Sinks: schema-enforcing full-refresh table load (IO5, IO15) and a CSV
sink that also registers a catalog table (IO6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import q

# The 37-column warehouse schema of the lead table (DDL order).
LEAD_WAREHOUSE_DDL = """
prospect_id string, lead_number bigint, lead_origin string, lead_source string, do_not_email string,
do_not_call string, converted bigint, totalvisits bigint, total_time_spent_on_website bigint,
page_views_per_visit double, last_activity string, country string, specialization string,
how_did_you_hear_about_x_education string, what_is_your_current_occupation string,
what_matters_most_to_you_in_choosing_a_course string, search string, magazine string, newspaper_article string,
x_education_forums string, newspaper string, digital_advertisement string, through_recommendations string,
receive_more_updates_about_our_courses string, tags string, lead_quality string,
update_me_on_supply_chain_content string, get_updates_on_dm_content string, lead_profile string, city string,
asymmetrique_activity_index string, asymmetrique_profile_index string, asymmetrique_activity_score bigint,
asymmetrique_profile_score bigint, i_agree_to_pay_the_amount_through_cheque string,
a_free_copy_of_mastering_the_interview string, last_notable_activity string
"""


def conform(df: DataFrame, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """Cast/select to a declared schema. ``strict``: missing or extra columns
    are an error, and so is a value that its declared type can't hold (the job
    fails; nothing becomes NULL silently). Without ``strict`` such values
    become NULL and missing columns are added as NULL."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    want = [f.name for f in schema.fields]
    have = set(df.columns)
    missing = [c for c in want if c not in have]
    extra = [c for c in df.columns if c not in set(want)]
    if strict and (missing or extra):
        raise ValueError(f"schema mismatch: missing={missing} extra={extra}")
    def cast(f: T.StructField):
        if f.name not in have:
            return F.lit(None).cast(f.dataType)
        value = q(f.name).try_cast(f.dataType)
        if not strict:
            return value
        wrong = F.concat(F.lit(f"column {f.name} does not fit {f.dataType.simpleString()}: "), q(f.name).cast("string"))
        return F.when(q(f.name).isNotNull() & value.isNull(), F.raise_error(wrong).cast(f.dataType)).otherwise(value)

    return df.select(*[cast(f).alias(f.name) for f in schema.fields])


def full_refresh_load(df: DataFrame, schema: T.StructType | str, table_name: str | None = None,
                      path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """IO5: drop-and-recreate load of a typed table: conform to the declared
    schema, then overwrite the table (catalog) or path."""
    out = conform(df, schema, strict=True)
    w = out.write.mode("overwrite").format(fmt)
    if table_name:
        if path:
            w = w.option("path", path)
        w.saveAsTable(table_name)
    elif path:
        w.save(path)
    else:
        raise ValueError("give a table name or a path")
    return out


def csv_table_sink(df: DataFrame, path: str, table_name: str | None = None, mode: str = "append",
                   partition_by: list[str] | None = None) -> None:
    """IO6: header CSV files under ``path``; with ``table_name`` the catalog
    table is created/updated over the same location. Vector columns are
    refused by CSV, so callers pass scalar columns (D10)."""
    bad = [f.name for f in df.schema.fields if f.dataType.typeName() in ("vector", "udt", "array", "map", "struct")]
    if bad:
        raise ValueError(f"CSV cannot hold non-scalar columns: {bad}")
    w = df.write.mode(mode).format("csv").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table_name:
        w.option("path", path).saveAsTable(table_name)
    else:
        w.save(path)
