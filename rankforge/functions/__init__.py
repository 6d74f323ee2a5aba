"""Column expressions. All are built-in Spark expressions (codegen, no UDF)."""

from rankforge.functions.casting import (  # noqa: F401
    decimal_to_text, int_of, long_of, safe_date, safe_double, safe_int, safe_long, total, wide_of, yyyymmdd_to_date,
)
from rankforge.functions.dates import EPOCH, date_from_key, date_key, epoch_ts, freshest  # noqa: F401
from rankforge.functions.json import (  # noqa: F401
    array_has_struct, first_of, first_text, is_malformed, json_array_contains, json_fields, json_flag_true, json_list_as_csv, json_object, json_text,
    list_contains, list_objects, list_texts,
)
from rankforge.functions.keys import md5_key  # noqa: F401
from rankforge.functions.text import (  # noqa: F401
    blank_to_null, clean_isbn_text, collapse_literal, collapse_spaces, normalize_name, simple_lower, strip_chars,
    strip_decimal_suffix, trimmed_or_null, zs_trim,
)
