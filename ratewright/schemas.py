"""Declared schemas: what is read from disclosure files and what is written.

Nothing is inferred.  Ids and amounts are read as STRING, because a quoted number read
as BIGINT or DOUBLE becomes null in Spark's JSON reader; the flatteners cast them with
``try_cast``.  Fields that publishers write either as a scalar or as a list are STRING
too and go through :func:`ratewright.functions.scalars.poly_list`.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _list_of(*fields: T.StructField) -> T.ArrayType:
    return T.ArrayType(T.StructType(list(fields)))


CORRUPT = "_corrupt_record"

HEADER_FIELDS = ("reporting_entity_name", "reporting_entity_type", "last_updated_on", "version")

SECTIONS = ("provider_references", "in_network", "out_of_network")

# ---------------------------------------------------------------- input documents

PROVIDER_REFERENCE = T.StructType(
    _strings("provider_group_id", "network_name")
    + [
        T.StructField(
            "provider_groups",
            _list_of(
                T.StructField("tin", T.StructType(_strings("type", "value", "business_name"))),
                T.StructField("npi", T.ArrayType(T.StringType())),
            ),
        )
    ]
)

CODE_FIELDS = ("billing_code", "billing_code_type", "billing_code_type_version", "name", "description")

PRICE_FIELDS = (
    "negotiated_type",
    "negotiated_rate",
    "expiration_date",
    "billing_class",
    "service_code",
    "billing_code_modifier",
    "additional_information",
    "estimated_amount",
    "setting",
)

IN_NETWORK_ITEM = T.StructType(
    _strings(*CODE_FIELDS, "negotiation_arrangement", "severity_of_illness")
    + [
        T.StructField(
            "negotiated_rates",
            _list_of(
                T.StructField("provider_references", T.ArrayType(T.StringType())),
                T.StructField("negotiated_prices", _list_of(*_strings(*PRICE_FIELDS))),
            ),
        )
    ]
)

# What the rate filter needs of an in-network item.
IN_NETWORK_KEYS = T.StructType(
    _strings("billing_code")
    + [
        T.StructField(
            "negotiated_rates",
            _list_of(T.StructField("provider_references", T.ArrayType(T.StringType()))),
        )
    ]
)

OUT_OF_NETWORK_ITEM = T.StructType(
    _strings(*CODE_FIELDS)
    + [
        T.StructField(
            "allowed_amounts",
            _list_of(
                T.StructField("tin", T.StructType(_strings("type", "value"))),
                *_strings("service_code", "billing_class"),
                T.StructField(
                    "payments",
                    _list_of(
                        *_strings("allowed_amount"),
                        T.StructField("providers", _list_of(*_strings("billed_charge", "npi"))),
                    ),
                ),
            ),
        )
    ]
)

SECTION_ITEM = {
    "provider_references": PROVIDER_REFERENCE,
    "in_network": IN_NETWORK_ITEM,
    "out_of_network": OUT_OF_NETWORK_ITEM,
}

HEADER = T.StructType(_strings(*HEADER_FIELDS))


def rate_document(sections: tuple[str, ...] = SECTIONS) -> T.StructType:
    """Read schema of a whole rate file, holding only the sections that are asked for."""
    return T.StructType(
        _strings(*HEADER_FIELDS)
        + [T.StructField(name, T.ArrayType(SECTION_ITEM[name])) for name in sections]
        + _strings(CORRUPT)
    )


INDEX_DOCUMENT = T.StructType(
    _strings(*HEADER_FIELDS)
    + [
        T.StructField(
            "reporting_structure",
            _list_of(
                T.StructField(
                    "reporting_plans",
                    _list_of(
                        *_strings(
                            "plan_name",
                            "plan_id",
                            "plan_id_type",
                            "plan_market_type",
                            "plan_sponsor_name",
                            "plan_sponser_name",
                            "issuer_name",
                        )
                    ),
                ),
                T.StructField("in_network_files", _list_of(*_strings("description", "location"))),
            ),
        )
    ]
    + _strings(CORRUPT)
)

CATALOG_DOCUMENT = T.StructType(
    [T.StructField("files", _list_of(*_strings("fileSchema", "filePath", "lastUpdatedOn")))]
)

BLOB = T.StructType(
    _strings("Name") + [T.StructField("Properties", T.StructType(_strings("Content-Length")))]
)

# One row per element of a section; ``ordinal`` is the byte offset of the element in the
# decompressed document, so it is unique, ordered and the same on every retry.
ELEMENT = T.StructType(
    [
        T.StructField("source_pricing_file", T.StringType()),
        T.StructField("section", T.StringType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("element_json", T.StringType()),
    ]
)

# ---------------------------------------------------------------- output tables

LINEAGE_FIELDS = ("payer_code", "file_month", "state", "source_version", "etl_run_id", "ingested_at")

_LINEAGE = _strings(*LINEAGE_FIELDS)

PLAN_PRICING_BRIDGE = T.StructType(
    _strings(
        "reporting_entity_name",
        "reporting_entity_type",
        "last_updated_on",
        "plan_name",
        "plan_id",
        "plan_id_type",
        "plan_market_type",
        "plan_sponser_name",
        "issuer_name",
        "description",
        "location",
        "source_index_file",
    )
    + _LINEAGE
)

TIC_PROVIDER_REFERENCE = T.StructType(
    _strings("source_pricing_file")
    + [T.StructField("provider_group_id", T.LongType())]
    + _strings("network_name", "tin_type", "tin_value", "npi", "business_name")
    + _LINEAGE
)

TIC_PRICE = T.StructType(
    _strings(
        "source_pricing_file",
        *HEADER_FIELDS,
        *CODE_FIELDS,
        "negotiation_arrangement",
        "severity_of_illness",
        "provider_references",
        "negotiated_type",
    )
    + [T.StructField("negotiated_rate", T.DoubleType())]
    + _strings(
        "expiration_date",
        "billing_class",
        "service_code",
        "billing_code_modifier",
        "additional_information",
    )
    + [T.StructField("estimated_amount", T.DoubleType())]
    + _strings("setting")
    + _LINEAGE
)

TIC_OUT_OF_NETWORK_ALLOWED = T.StructType(
    _strings(
        "source_pricing_file",
        *HEADER_FIELDS,
        *CODE_FIELDS,
        "tin_type",
        "tin_value",
        "service_code",
        "billing_class",
    )
    + [T.StructField("allowed_amount", T.DoubleType()), T.StructField("billed_charge", T.DoubleType())]
    + _strings("npi")
)

NPPES_PROVIDER = T.StructType(
    _strings(
        "npi",
        "entity_type",
        "org_name",
        "last_name",
        "first_name",
        "practice_state",
        "mailing_state",
        "taxonomy_code",
        "taxonomy_grouping",
        "taxonomy_classification",
        "taxonomy_specialization",
        "display_name",
    )
)

TABLES = {
    "plan_pricing_bridge": PLAN_PRICING_BRIDGE,
    "tic_provider_reference": TIC_PROVIDER_REFERENCE,
    "tic_price": TIC_PRICE,
    "tic_out_of_network_allowed": TIC_OUT_OF_NETWORK_ALLOWED,
    "nppes_provider": NPPES_PROVIDER,
}

LEDGER = T.StructType(
    _strings("source", "dataset", "status", "detail")
    + [T.StructField("row_count", T.LongType())]
    + _strings("etl_run_id", "recorded_at", "payer_code")
    + [T.StructField("length", T.LongType())]
    + _strings("terms")
)


def conform(df, table: str):
    """Select the columns of an output table in contract order."""
    schema = TABLES[table]
    return df.select(*[df[field.name].cast(field.dataType).alias(field.name) for field in schema])
