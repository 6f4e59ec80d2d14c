"""Column -> Column functions. All are JVM expressions except
:func:`normalize_name_udf`, the vectorised Unicode fallback."""

from .fmt import date_br, format_int_br, format_variation, growth_direction, iso_date
from .growth_math import axis_bound, hundredths_to_pct, variation_hundredths
from .parse import compose_key, lenient_short, parse_capital, parse_registry_date
from .text import lead_search_text, normalize_name, normalize_name_udf, truncate_label

__all__ = [
    "axis_bound", "compose_key", "date_br", "format_int_br", "format_variation",
    "growth_direction", "hundredths_to_pct", "iso_date", "lead_search_text",
    "lenient_short", "normalize_name", "normalize_name_udf", "parse_capital",
    "parse_registry_date", "truncate_label", "variation_hundredths",
]
