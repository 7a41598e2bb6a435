"""Registry text functions as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from routeledger import vocab as V
from routeledger.functions.gtfs import strip

# Unicode blanks; Java's \s covers ASCII only
W = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"

FULL_WIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "\u3000\u301c"
HALF_WIDTH = "".join(chr(c) for c in range(0x21, 0x7F)) + " ~"


def halfwidth(c: Column) -> Column:
    """Full-width ASCII forms, ideographic space and wave dash to ASCII; kana and kanji stay."""
    return F.translate(c, FULL_WIDTH, HALF_WIDTH)


def scope_char(c: Column) -> Column:
    """The kanji two printed in place of katakana NI."""
    return F.translate(c, "二", "ニ")


def remove_blanks(c: Column) -> Column:
    return F.regexp_replace(c, f"{W}+", "")


def compare_key(c: Column) -> Column:
    """Half-width form without any blank, for comparing names and places."""
    return remove_blanks(halfwidth(F.coalesce(c, F.lit(""))))


def unwrap_cell(c: Column) -> Column:
    """Join the wrapped lines of a cell, keeping blanks inside a line."""
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), f"{W}*\\n{W}*", ""))


def text_lines(c: Column) -> Column:
    """Non-empty stripped lines."""
    return F.filter(F.transform(F.split(c, _LINE_BREAK), strip), lambda x: x != "")


# -- era dates --------------------------------------------------------------------------------

_ERA_YEAR = {**V.ERA_BASE, **{a: V.ERA_BASE[n] for a, n in V.ERA_ABBR.items()}}
_ERAS = "|".join(V.ERA_BASE)
_FULL = f"(?:{_ERAS})[0-9]+年[0-9]+月[0-9]+日"
_ABBR = r"[RHS][0-9]+\.[0-9]+\.[0-9]+"
_DATE_PARTS = f"({_ERAS}|[RHS])([0-9]+)[年.]([0-9]+)[月.]([0-9]+)"


def _era_iso(d: Column) -> Column:
    """One era date -> ISO text. Month and day ranges are not checked."""
    base = F.create_map(*[F.lit(x) for kv in _ERA_YEAR.items() for x in kv])
    year, month, day = [F.regexp_extract(d, _DATE_PARTS, i).cast("int") for i in (2, 3, 4)]
    return F.format_string(
        "%04d-%02d-%02d", F.element_at(base, F.regexp_extract(d, _DATE_PARTS, 1)) + year,
        month, day)


def _found(text: Column, *patterns: str) -> Column:
    """First pattern's first match, else the next pattern's, else NULL."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 0), F.lit("")) for p in patterns])


def _iso_dates(found: Column) -> Column:
    """All era dates of a matched text, as ISO texts in order."""
    return F.transform(
        F.regexp_extract_all(found, F.lit(f"{_FULL}|{_ABBR}"), F.lit(0)), _era_iso)


def era_date(c: Column) -> Column:
    """First era date in a text as ISO text, or NULL."""
    return F.get(_iso_dates(_found(halfwidth(c), _FULL, _ABBR)), F.lit(0))


def registration_dates(c: Column) -> Column:
    """Struct (registered_date, renewed_date, valid_from, valid_to), or NULL when unreadable.

    A labelled renewal range wins and takes the labelled first registration; otherwise a bare
    range is used and the first registration stays ''. Renewal date = start of validity.
    """
    gap = r"\s*~\s*"

    def parts(t: Column) -> Column:
        renewal = _found(t, rf"更新登録年月日:\s*{_FULL}{gap}{_FULL}",
                         rf"更新登録年月日:\s*{_ABBR}{gap}{_ABBR}")
        bare = _found(t, f"{_FULL}{gap}{_FULL}", f"{_ABBR}{gap}{_ABBR}")
        first = _found(t, rf"登録年月日:\s*{_FULL}", rf"登録年月日:\s*{_ABBR}")
        return F.struct(
            F.when(renewal.isNotNull(), F.get(_iso_dates(first), F.lit(0))).alias("first"),
            _iso_dates(F.coalesce(renewal, bare)).alias("range"))

    def fields(p: Column) -> Column:
        start = F.get(p["range"], F.lit(0))
        return F.when(start.isNotNull(), F.struct(
            F.coalesce(p["first"], F.lit("")).alias("registered_date"),
            start.alias("renewed_date"), start.alias("valid_from"),
            F.get(p["range"], F.lit(1)).alias("valid_to")))

    # one-element arrays bind each intermediate once instead of repeating it in every field
    bound = F.transform(F.transform(F.array(halfwidth(c)), parts), fields)
    return F.get(bound, F.lit(0))


# -- registration numbers ---------------------------------------------------------------------

_REGISTRATION = "^(.+?)([福交過])第([0-9]+)号$"


def registration_parts(c: Column) -> Column:
    """Struct (registration_no, authority_code, service_type_code, serial_no), or NULL.

    Only prefixes listed as old-style lose their city mark, and only in authority_code.
    """
    no = remove_blanks(halfwidth(c))
    prefix = F.regexp_extract(no, _REGISTRATION, 1)
    authority = prefix
    for old, code in V.OLD_AUTHORITY_PREFIXES.items():
        authority = F.when(prefix == old, code).otherwise(authority)
    return F.when(
        no.rlike(_REGISTRATION),
        F.struct(
            no.alias("registration_no"), authority.alias("authority_code"),
            F.regexp_extract(no, _REGISTRATION, 2).alias("service_type_code"),
            F.regexp_extract(no, _REGISTRATION, 3).alias("serial_no"),
        ),
    )


# -- service areas ----------------------------------------------------------------------------


def area_prefix(c: Column) -> Column:
    """Municipalities named before the first bracket, one per listed part."""
    head = F.get(F.split(halfwidth(c), r"\("), F.lit(0))
    names = F.transform(
        F.split(head, "[、,]"), lambda x: F.regexp_extract(x, "^(.+?[市町村])", 1))
    return F.filter(names, lambda x: x != "")


def clean_area_lines(c: Column) -> Column:
    """Service-area block without its printed labels, one entry per line."""
    labels = ("路線又は", "運送の区域")

    def unlabel(x: Column) -> Column:
        for label in labels:
            x = F.replace(x, F.lit(label), F.lit(""))
        return strip(x)

    return F.array_join(
        F.filter(F.transform(text_lines(c), unlabel), lambda x: x != ""), "\n")


def order_area_hits(hits: Column, area: Column, org_name: Column) -> Column:
    """Roster hits completed by aliases and the body's own name, ordered.

    ``hits`` is an array of (pos, name) that holds at most one entry per roster place.
    """
    def has(name: Column) -> Column:
        return F.exists(hits, lambda h: h["name"] == name)

    extra = []
    for alias, name in V.AREA_ALIASES.items():
        pos = F.instr(area, alias)
        extra.append(F.when(
            (pos > 0) & ~has(F.lit(name)),
            F.struct(pos.alias("pos"), F.lit(name).alias("name"))))
    aliased = F.array_compact(F.array(*extra))
    own = F.array_compact(F.array(F.when(
        org_name.rlike("[市町村]$") & ~has(org_name)
        & ~F.exists(aliased, lambda h: h["name"] == org_name),
        F.struct(F.lit(-1).alias("pos"), org_name.alias("name")))))
    ordered = F.array_sort(F.concat(hits, aliased, own))
    return F.transform(ordered, lambda h: h["name"])


# -- vehicle cells ----------------------------------------------------------------------------


_CELL_BREAKS = "\x0b\x0c\x1c\x1d\x1e"
_NUMBER_LINE = f"^{W}*([0-9]+){W}*$"
_BOX_LINE = rf"^{W}*\({W}*([0-9]*){W}*\){W}*$"


def cell_value(c: Column, has_inner: Column) -> Column:
    """Struct (total, inner) of a vehicle cell.

    First bare number = total; the last bracketed number = inner, an empty bracket 0; without a
    bracket the last of several bare numbers; a column without an inner box has NULL.
    """
    t = F.translate(
        F.coalesce(c, F.lit("")), FULL_WIDTH + _CELL_BREAKS, HALF_WIDTH + "\n" * len(_CELL_BREAKS))

    def number(pattern: str) -> Column:
        return F.coalesce(F.regexp_extract(t, pattern, 1).try_cast("int"), F.lit(0))

    inner = (
        F.when(t.rlike(f"(?m){_BOX_LINE}"), number(f"(?sm).*{_BOX_LINE}"))
        .when(t.rlike(f"(?sm){_NUMBER_LINE}.*{_NUMBER_LINE}"), number(f"(?sm).*{_NUMBER_LINE}"))
        .otherwise(0))
    return F.struct(
        number(f"(?m){_NUMBER_LINE}").alias("total"), F.when(has_inner, inner).alias("inner"))


def vehicle_type(label: Column, transport_type: Column, layout: str = "table") -> Column:
    """Vehicle type of a column label by ordered fragments, or NULL for an unknown label.

    A sedan column of a gap-area table counts as ordinary cars.
    """
    skip = "シート" if layout == "table" else "普通自動車"
    key = remove_blanks(label)
    out = F.lit(None).cast("string")
    for fragment, kind in reversed([r for r in V.VEHICLE_LABEL_RULES if r[0] != skip]):
        out = F.when(key.contains(fragment), kind).otherwise(out)
    if layout == "table":
        gap = (out == "セダン等") & (transport_type == V.GAP_AREA_TYPE)
        out = F.when(gap, "普通自動車").otherwise(out)
    return out


def scope_flags(words: Column) -> dict[str, Column]:
    """Seven 0/1 columns from the words of the passenger-scope box.

    The last symbol also opens the printed legend; it is no mark when the legend is there.
    """
    marks = F.transform(words, scope_char)
    legend = F.exists(words, lambda w: w.contains("その他") | w.isin("そ", "その"))
    out = {}
    for mark, column in V.SCOPE_COLUMNS.items():
        hit = F.array_contains(marks, mark)
        if mark == "ト":
            hit = hit & ~legend
        out[column] = hit.cast("int").alias(column)
    return out


# -- redaction and scans ----------------------------------------------------------------------


def redact_lines(c: Column, label: str, marker: str, required: Column) -> Column:
    """Struct (text, matched, problem): lines that start with ``label`` lose their value.

    ``problem`` is 'empty_value', 'count_mismatch' (one line expected where required, none
    elsewhere) or NULL.
    """
    lines = F.split(c, "\n")
    hits = F.filter(lines, lambda x: x.startswith(label))
    empty = F.exists(hits, lambda x: strip(F.substring(x, len(label) + 1, F.length(x))) == "")
    text = F.array_join(F.transform(
        lines, lambda x: F.when(x.startswith(label), f"{label} {marker}").otherwise(x)), "\n")
    matched = F.size(hits)
    problem = F.when(empty, "empty_value").when(
        matched != F.when(required, 1).otherwise(0), "count_mismatch")
    return F.struct(text.alias("text"), matched.alias("matched"), problem.alias("problem"))


def newline_norm(c: Column) -> Column:
    return F.replace(c, F.lit("\r\n"), F.lit("\n"))


TOKEN_PATTERN = r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"


def secret_tokens(c: Column) -> Column:
    """Every signed-token shaped string of a text."""
    return F.regexp_extract_all(c, F.lit(TOKEN_PATTERN), F.lit(0))


def redact_tokens(c: Column) -> Column:
    """Replace each token by its digest and length; longer tokens first."""
    tokens = F.array_sort(
        F.transform(F.array_distinct(secret_tokens(c)),
                    lambda x: F.struct((-F.length(x)).alias("k"), x.alias("t"))))

    def swap(text: Column, x: Column) -> Column:
        mark = F.concat(F.lit("REDACTED_TOKEN_SHA256_"), F.sha2(x["t"], 256), F.lit("_LEN_"),
                        F.length(x["t"]).cast("string"))
        return F.replace(text, x["t"], mark)

    return F.when(F.size(tokens) > 0, F.aggregate(tokens, c, swap)).otherwise(c)


def without_spaces(c: Column) -> Column:
    """Blanks and tabs removed, line breaks kept, so that a hit cannot span lines."""
    return F.regexp_replace(c, "[ \\t\u3000]+", "")


def name_candidate(words: Column, role_words: Iterable[str]) -> Column:
    """Joined words that carry no role word: the personal-name candidate of a label row."""
    roles = "|".join(role_words)
    return without_spaces(F.array_join(F.filter(words, lambda w: ~w.rlike(roles)), ""))


def half_step(c: Column) -> Column:
    """Nearest half, ties up, on exact decimals."""
    return (F.floor(c * 2 + F.lit(0.5).cast("decimal(2,1)")) / 2).cast("decimal(3,1)")


def split_list(c: Column) -> Column:
    """';'-list to array without empty entries."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: x != "")
