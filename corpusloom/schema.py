"""Fixed schemas, and the check that a table has one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import FloatType, IntegerType, StringType, StructField, StructType


def _fields(text: str) -> list[StructField]:
    kinds = {"string": StringType(), "float": FloatType(), "int": IntegerType()}
    out = []
    for part in text.split(","):
        name, kind, *need = part.split()
        out.append(StructField(name, kinds[kind], not need))
    return out


#: The columns of a sampled and of a normalized document, with * for those that must not be NULL.
DOCUMENT_SCHEMA = StructType(
    _fields(
        "text string *, source string *, source_revision string, subset string, original_id string, original_url string, license string, language string, "
        "language_score float, variety string, quality_score float, publication_date string, domain_category string, content_sha256 string *"
    )
)
NORMALIZED_SCHEMA = StructType(
    [
        *DOCUMENT_SCHEMA.fields,
        *_fields(
            "title string, raw_source_file string *, raw_record_identifier string *, normalization_version string *, _gv2_upstream_shard string, "
            "_gv2_upstream_row_group int, _gv2_upstream_commit string, upstream_metadata_json string"
        ),
    ]
)


class SchemaError(ValueError):
    """A table does not have the columns it must have."""


def assert_schema(df: DataFrame, schema: StructType, exact: bool = True) -> DataFrame:
    """``df``, if its columns have the names and types of ``schema`` (with ``exact`` no others, in this order); else an error that names every difference."""
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f"{f.name}: missing" if f.name not in have else f"{f.name}: {have[f.name].simpleString()} in place of {f.dataType.simpleString()}" for f in schema if have.get(f.name) != f.dataType]
    if exact:
        wrong += [f"{n}: not expected" for n in have if n not in schema.fieldNames()]
        if not wrong and [f.name for f in df.schema] != schema.fieldNames():
            wrong = ["columns stand in another order"]
    if wrong:
        raise SchemaError("; ".join(wrong))
    return df
