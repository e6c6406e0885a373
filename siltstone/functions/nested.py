"""Nested product records to flat columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.casts import to_double


def joined(items: Column) -> Column:
    """Comma-joined items; a missing list gives the empty string."""
    return F.coalesce(F.array_join(items, ","), F.lit(""))


def _is_number(kind: Column) -> Column:
    return kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")


def storage_columns(storage: Column) -> dict[str, Column]:
    """Capacity may be a list, a number, or absent (also null or text)."""
    raw = storage["capacity_gb"]
    kind = F.schema_of_variant(raw)
    listed = F.when(kind.startswith("ARRAY"), F.try_variant_get(raw, "$", "array<string>"))
    single = F.when(_is_number(kind), F.try_variant_get(raw, "$", "double").cast("bigint"))
    largest = F.array_max(F.transform(listed, to_double))
    return {
        "storage_options_gb": F.coalesce(F.array_join(listed, ","), single.cast("string")),
        "max_storage_gb": F.coalesce(largest, single.cast("double")),
        "storage_type": storage["type"],
    }


def spec_columns(specs: Column) -> dict[str, Column]:
    dimensions, battery = specs["dimensions"], specs["battery"]
    screen, processor = specs["screen"], specs["processor"]
    return {
        "height": to_double(dimensions["height"]),
        "width": to_double(dimensions["width"]),
        "depth": to_double(dimensions["depth"]),
        "diameter": to_double(dimensions["diameter"]),
        **storage_columns(specs["storage"]),
        "battery_capacity_mah": to_double(battery["capacity_mAh"]),
        "fast_charging": battery["fast_charging"],
        "playback_hours": to_double(battery["playback_hours"]),
        "screen_type": screen["type"],
        "screen_size_inches": to_double(screen["size_inches"]),
        "processor_brand": processor["brand"],
        "processor_model": processor["model"],
        "ram_gb": to_double(specs["ram_gb"]),
        "sensors": joined(specs["sensors"]),
        "ports": joined(specs["ports"]),
        "features": joined(specs["features"]),
        "connectivity": joined(specs["connectivity"]),
        "compatibility": joined(specs["compatibility"]),
    }


def price_columns(pricing: Column) -> dict[str, Column]:
    """Discounts without amount count as 0, those without type as the empty string."""
    price, discounts = to_double(pricing["base_price"]), pricing["discounts"]
    total = F.coalesce(
        F.aggregate(
            discounts,
            F.lit(0.0),
            lambda acc, d: acc + F.coalesce(to_double(d["amount"]), F.lit(0.0)),
        ),
        F.lit(0.0),
    )
    types = F.transform(discounts, lambda d: F.coalesce(d["type"], F.lit("")))
    return {
        "base_price": price,
        "currency": pricing["currency"],
        "discount_count": F.coalesce(F.array_size(discounts), F.lit(0)),
        "total_discount": total,
        "discount_types": joined(types),
        "effective_price": F.coalesce(price, F.lit(0.0)) - total,
    }


def product_columns(record: Column) -> dict[str, Column]:
    return {
        "product_id": record["product_id"],
        "product_name": record["name"],
        "category": record["category"],
        **spec_columns(record["specs"]),
        **price_columns(record["pricing"]),
    }


def misfits(record: Column) -> dict[str, Column]:
    """For each number of a record, whether a value is there that is no number."""
    specs, pricing = record["specs"], record["pricing"]
    numbers = {
        **{name: specs["dimensions"][name] for name in ("height", "width", "depth", "diameter")},
        "battery_capacity_mah": specs["battery"]["capacity_mAh"],
        "playback_hours": specs["battery"]["playback_hours"],
        "screen_size_inches": specs["screen"]["size_inches"],
        "ram_gb": specs["ram_gb"],
        "base_price": pricing["base_price"],
    }

    def unfit(text: Column) -> Column:
        return text.isNotNull() & to_double(text).isNull()

    capacity = specs["storage"]["capacity_gb"]
    kind = F.schema_of_variant(capacity)
    listed = F.try_variant_get(capacity, "$", "array<string>")
    found = {name: unfit(text) for name, text in numbers.items()}
    found["storage"] = F.when(kind.startswith("ARRAY"), F.exists(listed, unfit)).otherwise(
        capacity.isNotNull() & (kind != "VOID") & ~_is_number(kind)
    )
    found["discount_amount"] = F.exists(pricing["discounts"], lambda d: unfit(d["amount"]))
    return {name: F.coalesce(flag, F.lit(False)) for name, flag in found.items()}


def json_records(text: Column) -> Column:
    """Elements of a JSON array as text, keys in their own order; null if the text is not one whole array.

    The parser stops at the end of a first value. Put into an array of its own, a text
    with more after it gives several elements or none, and a text cut short ends the
    object around it, so the two tests together let whole arrays through only.
    """
    alone = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")
    inside = F.from_json(F.concat(F.lit('{"a":'), text, F.lit("}")), "a array<string>")["a"]
    return F.when(text.rlike(r"^\s*\[") & (F.size(alone) == 1), inside)


def is_record(text: Column) -> Column:
    """Whether a text is one whole JSON object with the three head fields; never null."""
    alone = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")
    inside = F.from_json(F.concat(F.lit('{"a":'), text, F.lit("}")), "a map<string, string>")["a"]
    has_head = [F.map_contains_key(inside, name) for name in ("product_id", "name", "category")]
    whole = text.rlike(r"^\s*\{") & (F.size(alone) == 1) & has_head[0] & has_head[1] & has_head[2]
    return F.coalesce(whole, F.lit(False))


def json_array_status(text: Column) -> Column:
    """`ok`, `not_array` or `malformed`; text after the first value is malformed."""
    alone = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")
    return (
        F.when(json_records(text).isNotNull(), "ok")
        .when(~text.rlike(r"^\s*\[") & F.try_parse_json(text).isNotNull() & (F.size(alone) == 1), "not_array")
        .otherwise("malformed")
    )
