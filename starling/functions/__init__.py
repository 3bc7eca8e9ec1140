from starling.functions.exprs import (  # noqa: F401
    blank_to_null, strip_ws, try_number, try_integer, try_date, iso_date, slug, null_label,
    safe_ratio, map_values, natural_key_text, hash_id, text_key, contains_ci,
)
