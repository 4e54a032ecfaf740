from tablecare.functions.columns import (  # noqa: F401
    CURRENCY_CHARS, CURRENCY_CODE, DATE_FORMATS, LEVEL_RANGE, all_not_null, any_null,
    blank_to_null, case_lower, case_title, case_upper, clean_currency, fix_negative,
    in_range, is_negative, parse_date, trim_spaces, try_double, try_int,
)
from tablecare.functions.text import (  # noqa: F401
    ANNOTATION_RULES, Rule, categorize, categorize_annotation, short_name,
)
