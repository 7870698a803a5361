"""Column functions: built-in expressions only, so they stay inside whole-stage codegen."""

from linkloom.functions.authority import bare_id, entity_type
from linkloom.functions.links import (
    fill_template,
    indexed_prefix,
    landed_name,
    last_segment,
    percent_decode,
    safe_prefix,
    unescape_slashes,
    url_path,
    without_gz,
)
from linkloom.functions.sampling import is_orderable, sample_key
from linkloom.functions.text import all_fields, fields, header_key, header_value, line_kind, strip

__all__ = [
    "all_fields",
    "bare_id",
    "entity_type",
    "fields",
    "fill_template",
    "header_key",
    "header_value",
    "indexed_prefix",
    "is_orderable",
    "landed_name",
    "last_segment",
    "line_kind",
    "percent_decode",
    "safe_prefix",
    "sample_key",
    "strip",
    "unescape_slashes",
    "url_path",
    "without_gz",
]
