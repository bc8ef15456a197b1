from panelspark.functions.semantics import (  # noqa: F401
    WHITESPACE, col_, empty_if_null, flag, money_sum, na_text, num_text, pretty_num, rround, safe_corr,
    safe_div, sum0, to_number, trim_ws,
)
from panelspark.functions.dates import (  # noqa: F401
    compact_text, date_spine, day_number_to_date, day_of, long_label, month_name,
    parse_iso, parse_mdy, parse_ymd,
)
from panelspark.functions.text import (  # noqa: F401
    WORD_PATTERN, cut_between, drop_control, split_items, strip_fragments, strip_spans,
    strip_tags, words,
)
