"""Vendor weather documents and readings kept as JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brisa.functions import clean
from brisa.operators.conform import conform
from brisa.params import WEATHER_FIELDS, WEATHER_NO_DATA, WEATHER_SENTINELS


def explode_documents(docs: DataFrame, text: str, item_schema: str, keep: Sequence[str]) -> DataFrame:
    """One row per element of a JSON array text, with the element's fields."""
    items = F.from_json(F.col(text), f"array<struct<{item_schema}>>")
    return docs.select(*keep, F.inline(items))


def flatten_weather(
    docs: DataFrame,
    text: str,
    fields: Mapping[str, str],
    numbers: Sequence[str],
    keep: Sequence[str],
) -> DataFrame:
    """Vendor documents to one row per place, ``published_at`` and ``forecast_at``.

    ``fields`` maps vendor to canonical names; ``numbers`` lists the canonical
    fields that are numeric.  Fillers become null: 999.9 and 999999 in numeric
    fields, the no-data text everywhere.  Names are mapped while parsing, so
    values can never be touched by the renaming.
    """
    schema = ", ".join(f"`{source}`: string" for source in fields)
    rows = explode_documents(docs, text, schema, keep)

    def field(source: str, target: str) -> Column:
        value = clean.blank_sentinels(F.col(f"`{source}`"), [WEATHER_NO_DATA])
        if target in numbers:
            value = clean.blank_numbers(clean.to_number(value), WEATHER_SENTINELS)
        return value.alias(target)

    return rows.select(*keep, *[field(s, t) for s, t in fields.items()])


def map_coded_readings(
    docs: DataFrame, text: str, keep: Sequence[str], value_type: str = "Avg"
) -> DataFrame:
    """Arrays of ``{LHCodeID, ValueTypeID, DataValue}`` as a code-to-value map.

    Only readings of the given type count, the last one of a code wins, and
    documents without any are dropped.
    """
    items = F.from_json(
        F.col(text),
        "array<struct<LHCodeID: string, ValueTypeID: string, DataValue: double>>",
    )
    wanted = F.filter(items, lambda i: i["ValueTypeID"] == value_type)
    codes = F.array_distinct(F.transform(wanted, lambda i: i["LHCodeID"]))

    def last_value(code: Column) -> Column:
        same = F.filter(F.col("_wanted"), lambda i: i["LHCodeID"] == code)
        return F.element_at(same, -1)["DataValue"]

    return (
        docs.select(*keep, wanted.alias("_wanted"), codes.alias("_codes"))
        .filter(F.size("_codes") > 0)
        .select(
            *keep,
            F.map_from_arrays(F.col("_codes"), F.transform(F.col("_codes"), last_value)).alias(
                "data"
            ),
        )
    )


# Text fields of the weather history; the codes are whole numbers, the rest numeric.
HISTORY_TEXT = ("weather",)
HISTORY_WHOLE = ("weather_code", "wind_degrees")


def weather_history(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Delimited weather history of grid cells with the cells' own columns.

    ``rows`` has ``sid`` (the cell number with letters around it), ``date`` and
    the vendor's fields; fields the file lacks come out null.  Rows of unknown
    cells stay.
    """
    layout: dict = {
        "grid_id": (clean.digits_only(F.col("sid")), "int"),
        "published_at": (F.substring("date", 1, 19), "timestamp_ntz"),
    }
    for source, target in WEATHER_FIELDS["grid_hour"].items():
        dtype = (
            "string" if target in HISTORY_TEXT else "int" if target in HISTORY_WHOLE else "double"
        )
        layout[target] = (source if source in rows.columns else None, dtype)
    out = conform(rows, layout).withColumn(
        "water_gas_pressure", F.round("water_gas_pressure", 2)
    )
    return out.join(cells, on="grid_id", how="left")


# --- documents of several vendors -------------------------------------------------

# Canonical fields that are text in every layout; the others are numbers.
TEXT_FIELDS = (
    "weather", "weather_day", "weather_night", "wind_dir", "wind_direction", "wind_degrees_direction",
    "wind_speed_level", "published_at", "forecast_at",
)


def parsed_documents(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """Documents with their text as VARIANT in ``_doc``, and the rows whose text is no JSON (or null).

    The second table is kept beside the first, so that what a vendor broke can be read again.
    """
    parsed = docs.withColumn("_doc", F.try_parse_json(F.col(text)))
    return parsed.filter(F.col("_doc").isNotNull()), parsed.filter(F.col("_doc").isNull()).drop("_doc")


def flatten_mixed(
    docs: DataFrame,
    vendor: str,
    keep: Sequence[str],
    layouts: Mapping[str, Mapping[str, str]] = WEATHER_FIELDS,
    texts: Sequence[str] = TEXT_FIELDS,
) -> DataFrame:
    """Parsed documents of all vendors to one row per element, in one pass.

    ``vendor`` names each row's layout; a layout maps the vendor's keys to canonical fields,
    and the result has the fields of all layouts.  A document is an array of elements or a
    single one; ``_item`` is the element's place.  Keys that a layout does not name are left
    in the VARIANT and cost nothing; a value of another type than expected, a filler or the
    no-data text is null.  Documents of unknown vendors give rows of nulls.
    """
    elements = F.coalesce(F.try_variant_get("_doc", "$", "array<variant>"), F.array("_doc"))
    rows = docs.select(*keep, F.col(vendor).alias("_vendor"), F.posexplode(elements).alias("_item", "_e"))
    sources: dict[str, list[Column]] = {}
    parts = {}
    for k, (layout, fields) in enumerate(layouts.items()):
        schema = ", ".join(f"`{source}`: string" for source in fields)
        parts[f"_l{k}"] = F.when(F.col("_vendor") == layout, F.try_variant_get("_e", "$", f"struct<{schema}>"))
        for source, target in fields.items():
            sources.setdefault(target, []).append(F.col(f"_l{k}.`{source}`"))
    out = []
    for target, named in sources.items():  # a row has one layout's fields, the others are null
        value = clean.blank_sentinels(F.coalesce(*named), [WEATHER_NO_DATA])
        if target not in texts:
            value = clean.blank_numbers(clean.to_number(value), WEATHER_SENTINELS)
        out.append(value.alias(target))
    return rows.withColumns(parts).select(*keep, "_vendor", "_item", *out)
