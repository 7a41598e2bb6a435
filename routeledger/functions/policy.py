"""Name, path and URL policies: each gives the first broken rule's code, or NULL."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from routeledger import vocab as V

# scheme, authority, path, query, fragment of a generic URL
_URL = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


@F.pandas_udf(StringType())
def name_key(names: pd.Series) -> pd.Series:
    """Compatibility-normalised, case-folded key; Spark has no normaliser of its own."""
    return names.map(
        lambda s: None if s is None else unicodedata.normalize("NFKC", s).casefold())


def is_compatible(c: Column) -> Column:
    """Whether a text has only characters that compatibility normalisation keeps, whatever stands beside them:
    ASCII, composed Latin letters, kana and unified ideographs. Other texts may still be normal."""
    return c.rlike(r"^[\x00-\x7F\u00C0-\u00FF\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FFF]*$")


@F.pandas_udf(ArrayType(StringType()))
def nfkc_each(texts: pd.Series) -> pd.Series:
    """The compatibility-normalised texts of each array; NULL arrays stay."""
    return texts.map(lambda a: None if a is None else [
        None if s is None else unicodedata.normalize("NFKC", s) for s in a])


def url_reason(url: Column, hosts: Iterable[str]) -> Column:
    """https only, listed host, no user info, default port, no query, no fragment."""
    part = [F.regexp_extract(url, _URL, i) for i in range(1, 6)]
    scheme, authority, query, fragment = F.lower(part[0]), part[1], part[3], part[4]
    host_port = F.regexp_replace(authority, "^.*@", "")
    host = F.lower(F.regexp_replace(host_port, ":[^:]*$", ""))
    port = F.regexp_extract(host_port, ":([^:]*)$", 1)
    bad_port = (port != "") & (~port.rlike("^[0-9]{1,5}$") | (port.try_cast("int") > 65535))
    return (
        F.when(url.isNull(), "official_url_not_string")
        .when(bad_port, "url_parse_error")
        .when(scheme != "https", "https_required")
        .when(~host.isin(*hosts), "host_not_allowed")
        .when(authority.contains("@"), "userinfo_not_allowed")
        .when((port != "") & (port.try_cast("int") != 443), "port_not_allowed")
        .when(query != "", "query_not_allowed")
        .when(fragment != "", "fragment_not_allowed")
    )


def member_name_reason(name: Column) -> Column:
    """Archive member names must be plain file names."""
    parts = F.split(name, "/")
    return (
        F.when(name == "", "empty_name")
        .when(name.contains("\x00"), "nul")
        .when(name.contains("\\"), "backslash")
        .when(name.startswith("/"), "absolute_path")
        .when(name.rlike("^[A-Za-z]:"), "drive_name")
        .when(F.array_contains(parts, ".."), "parent_reference")
        .when(F.size(parts) > 1, "directory")
    )


def local_path_reason(path: Column, root: str = "raw") -> Column:
    """Relative POSIX path below ``root``, decided from the text alone."""
    parts = F.filter(F.split(path, "/"), lambda x: ~x.isin("", "."))
    return (
        F.when(path.isNull() | path.contains("\\"), "local_path_must_use_posix_separators")
        .when(path.startswith("/") | F.array_contains(parts, "..") | (F.size(parts) == 0),
              "local_path_traversal")
        .when(F.get(parts, F.lit(0)) != root, "local_path_must_be_under_raw")
    )


def special_entry_reason(is_dir: Column, flag_bits: Column, unix_mode: Column) -> Column:
    """Directories, encrypted members, links and other non-regular files; no type = regular."""
    kind = unix_mode.bitwiseAND(0o170000)
    return (
        F.when(is_dir, "directory_entry")
        .when(flag_bits.bitwiseAND(1) != 0, "encrypted")
        .when(kind == 0o120000, "symlink")
        .when(~kind.isin(0, 0o100000), "not_regular")
    )


def compression_ratio(file_size: Column, compress_size: Column) -> Column:
    """Uncompressed over compressed size; infinite for content stored in no bytes."""
    return F.when(file_size > 0, F.when(
        compress_size > 0, file_size.cast("double") / compress_size
    ).otherwise(F.lit(float("inf"))))


def oversized(file_size: Column) -> Column:
    return file_size > V.MAX_MEMBER_BYTES


def over_ratio(file_size: Column, compress_size: Column) -> Column:
    """Ratio above the limit, in whole numbers so that the limit itself passes exactly."""
    return (file_size > 0) & (
        (compress_size <= 0) | (file_size > compress_size * V.MAX_RATIO))
