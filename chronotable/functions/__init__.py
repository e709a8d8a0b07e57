"""Column expressions."""

from chronotable.functions.hashing import md5_of, row_key, row_md5
from chronotable.functions.paths import base_name, file_kind, replace_prefix
from chronotable.functions.render import concat_values, row_text, value_text
from chronotable.functions.timestamps import OPEN_END, one_milli_before, open_end

__all__ = [
    "OPEN_END",
    "base_name",
    "concat_values",
    "file_kind",
    "md5_of",
    "one_milli_before",
    "open_end",
    "replace_prefix",
    "row_key",
    "row_md5",
    "row_text",
    "value_text",
]
