"""Table schemas and era differences of the quarterly report files.

Everything in this module is a fixed value: names, order, types and renames are
those of the published quarterly extracts.
"""

from __future__ import annotations

from pyspark.sql import types as T

DELIMITER = "$"

TABLES = ("demo", "drug", "indi", "outc", "reac", "rpsr", "ther")

# Column layout per table, without the two metadata columns that end each one.
_LAYOUT = {
    "demo": """
        primaryid bigint, caseid bigint, caseversion bigint, i_f_cod string,
        event_dt bigint, mfr_dt bigint, init_fda_dt bigint, fda_dt bigint,
        rept_cod string, auth_num string, mfr_num string, mfr_sndr string,
        lit_ref string, age bigint, age_cod string, age_grp string, sex string,
        e_sub string, wt double, wt_cod string, rept_dt bigint, to_mfr string,
        occp_cod string, reporter_country string, occr_country string""",
    "drug": """
        primaryid bigint, caseid bigint, drug_seq bigint, role_cod string,
        drugname string, prod_ai string, val_vbm bigint, route string,
        dose_vbm string, cum_dose_chr string, cum_dose_unit string,
        dechal string, rechal string, lot_num string, exp_dt bigint,
        nda_num double, dose_amt string, dose_unit string, dose_form string,
        dose_freq string""",
    "indi": "primaryid bigint, caseid bigint, indi_drug_seq bigint, indi_pt string",
    "outc": "primaryid bigint, caseid bigint, outc_cod string",
    "reac": "primaryid bigint, caseid bigint, pt string, drug_rec_act string",
    "rpsr": "primaryid bigint, caseid bigint, rpsr_cod string",
    "ther": """
        primaryid bigint, caseid bigint, dsg_drug_seq bigint, start_dt bigint,
        end_dt bigint, dur double, dur_cod string""",
}

_TYPES = {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


def _struct(layout: str) -> T.StructType:
    # the DDL reader of Spark needs a running session, which an import must not ask for
    fields = (f.split() for f in layout.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


SCHEMAS = {
    table: _struct(layout + ", processing_time bigint, period string")
    for table, layout in _LAYOUT.items()
}

DELETED_SCHEMA = _struct("caseid bigint")

# Columns of the older era that have no place in the common schema.
DROPS = {"demo": ("foll_seq", "image", "death_dt", "confid")}

# Older name -> common name.
RENAMES = {
    "demo": {"isr": "primaryid", "case": "caseid", "i_f_code": "i_f_cod", "gndr_cod": "sex"},
    "drug": {"isr": "primaryid", "case": "caseid"},
    "indi": {"isr": "primaryid", "drug_seq": "indi_drug_seq"},
    "outc": {"isr": "primaryid"},
    "reac": {"isr": "primaryid"},
    "rpsr": {"isr": "primaryid"},
    "ther": {"isr": "primaryid", "drug_seq": "dsg_drug_seq"},
}

# Columns that one of the eras lacks; they are added as null where absent.
ADDS = {
    "demo": ("caseversion", "caseid", "init_fda_dt", "auth_num", "lit_ref", "age_grp",
             "reporter_country", "occr_country"),
    "drug": ("prod_ai", "caseid", "cum_dose_chr", "cum_dose_unit", "dose_amt", "dose_unit",
             "dose_form", "dose_freq"),
    "indi": ("caseid",),
    "outc": ("caseid",),
    "reac": ("caseid", "drug_rec_act"),
    "rpsr": ("caseid",),
    "ther": ("caseid",),
}

RESCUED = "_rescued_data"

ATC_CODES = "array<struct<id:string,name:string,class_type:string>>"
ENTITY_SCHEMA = "drugname string, prod_ai string, term string, entity string"
ENTITY_MAP_SCHEMA = f"entity string, atc_code {ATC_CODES}, strategy string, processing_time bigint"


def schema_of(table: str) -> T.StructType:
    """Schema of one of the seven tables; ``ValueError`` for any other name."""
    if table not in SCHEMAS:
        raise ValueError(f"unknown table {table!r}: it is none of {', '.join(SCHEMAS)}")
    return SCHEMAS[table]


def type_of(column: str) -> T.DataType | None:
    """Type a column name has in every table that holds it, or ``None``."""
    return _COLUMN_TYPES.get(column)


_COLUMN_TYPES = {f.name: f.dataType for s in SCHEMAS.values() for f in s.fields}
