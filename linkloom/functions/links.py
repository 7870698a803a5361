"""Column expressions over URLs and link templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.fixed_values import (
    DEFAULT_EXTENSION,
    DEFAULT_FILE_NAME,
    ID_PLACEHOLDER,
    INDEX_FORMAT,
    SAFE_PREFIX_LENGTH,
)


def safe_prefix(url: Column, max_len: int = SAFE_PREFIX_LENGTH) -> Column:
    """File-name-safe form of a URL: alphanumeric runs joined and ended by one ``_``.

    NULL stays NULL; a URL without any alphanumeric character gives ``''``.
    """
    joined = F.btrim(F.regexp_replace(url, "[^A-Za-z0-9]+", "_"), F.lit("_"))
    cut = F.rtrim(F.substring(joined, 1, max_len), F.lit("_"))
    return F.when(joined == "", F.lit("")).otherwise(F.concat(cut, F.lit("_")))


def url_path(url: Column) -> Column:
    """Path part of a URL, without query, fragment and parameters of the last segment."""
    clean = F.regexp_replace(F.regexp_replace(url, r"[\t\r\n]", ""), r"^[\x00-\x20]+", "")
    path = F.regexp_extract(
        clean, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1
    )
    return F.regexp_replace(path, r";[^/]*\z", "")


def percent_decode(text: Column) -> Column:
    """Percent-decode as UTF-8. A plus stays a plus, a stray percent sign stays as it is."""
    guarded = F.replace(text, F.lit("+"), F.lit("%2B"))
    guarded = F.regexp_replace(guarded, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(F.contains(text, F.lit("%")), F.url_decode(guarded)).otherwise(text)


def landed_name(url: Column, prefix: Column | None = None) -> Column:
    """File name a dump fetched from ``url`` is stored under."""
    path = url_path(url)
    last = F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)
    name = percent_decode(last)
    name = (
        F.when(name == "", F.lit(DEFAULT_FILE_NAME))
        .when(~F.contains(name, F.lit(".")), F.concat(name, F.lit(DEFAULT_EXTENSION)))
        .otherwise(name)
    )
    name = F.replace(name, F.lit("/"), F.lit("_"))
    if prefix is not None:
        name = F.concat(prefix, name)
    packed = F.endswith(F.lower(path), F.lit(".gz"))
    return F.when(packed, without_gz(name)).otherwise(name)


def without_gz(name: Column) -> Column:
    """Drop a trailing ``.gz``; a name that is nothing else becomes the default name."""
    packed = F.lower(name.substr(-3, 3)) == ".gz"
    bare = name.substr(F.lit(1), F.length(name) - 3)
    return F.when(~packed, name).when(bare == "", F.lit(DEFAULT_FILE_NAME)).otherwise(bare)


def indexed_prefix(index: Column, url: Column) -> Column:
    """List position, zero-filled to four digits or more, followed by the safe prefix."""
    return F.concat(F.format_string(INDEX_FORMAT, index), safe_prefix(url))


def fill_template(target: Column, identifier: Column) -> Column:
    """Put ``identifier`` into every ``{ID}`` of ``target``, or append it as a path segment."""
    based = F.when(F.endswith(target, F.lit("/")), target).otherwise(
        F.concat(target, F.lit("/"))
    )
    return F.when(
        F.contains(target, F.lit(ID_PLACEHOLDER)),
        F.replace(target, F.lit(ID_PLACEHOLDER), identifier),
    ).otherwise(F.concat(based, identifier))


def last_segment(uri: Column) -> Column:
    """What follows the last slash: ``''`` after a final slash, all of it without a slash."""
    return F.substring_index(uri, "/", -1)


def unescape_slashes(path: Column) -> Column:
    r"""Turn the JSON escape ``\/`` back into ``/``."""
    return F.replace(path, F.lit("\\/"), F.lit("/"))
