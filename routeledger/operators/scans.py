"""Whole-text scans: leaked names, token coverage between revisions, roster hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeledger.functions import text as T
from routeledger.functions.policy import is_compatible, nfkc_each

# A needle of SHORT characters or more holds a whole window of WINDOW grams, and its smallest gram there is
# one of the grams that the text has chosen; a shorter needle is a gram of its own length. Fixed at every size.
GRAM, WINDOW = 4, 5
SHORT = GRAM + WINDOW - 1
_PORTION, _SLOT_BITS = 1 << 20, 20


def _letters(texts):
    """The code points of a column of texts behind each other, and where each text begins (one entry more)."""
    import numpy as np

    at = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), at


def _grams(letters, k: int):
    """A hash of every k characters, different for each k."""
    import numpy as np

    out = np.full(max(len(letters) - k + 1, 0), k, np.uint64)
    for j in range(k if len(out) else 0):
        out = (out ^ letters[j:j + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _row_pieces(texts, lengths, chosen: bool):
    """(row, piece): exact grams of the given lengths, and with ``chosen`` the smallest gram of each window."""
    import numpy as np

    letters, at = _letters(texts)
    size = np.diff(at)
    rows, pieces = [], []

    def add(values, span: int) -> None:
        count = np.maximum(size - span + 1, 0)
        row = np.repeat(np.arange(len(size)), count)
        place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(at[:-1], count)
        values = values[place]
        new = np.ones(len(row), bool)  # neighbouring windows mostly choose the same gram
        new[1:] = (row[1:] != row[:-1]) | (values[1:] != values[:-1])
        rows.append(row[new])
        pieces.append(values[new])

    for k in lengths:
        add(_grams(letters, k), k)
    if chosen and len(letters) >= SHORT:
        grams = _grams(letters, GRAM)
        n = len(grams) - WINDOW + 1
        add(np.minimum.reduce([grams[j:j + n] for j in range(WINDOW)]), SHORT)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(pieces).view(np.int64)


def _piece_rows(column: str, lengths: list[int], chosen: bool, own_length: bool = False, wanted=None):
    """The batches' other columns with a ``_piece`` a row; with own_length a short text has its own length only.

    ``wanted`` is a bit map of slots that pieces of needles fall in; others are left out.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(column).to_pylist()
            rest = batch if own_length else batch.drop_columns([column])
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            a = 0
            while a < len(texts):
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _PORTION)))
                part = texts[a:b]
                if own_length:
                    # a text of SHORT or more has choices only, a shorter one its whole self
                    row, piece = _row_pieces(part, [], True)
                    for k in lengths:
                        short = [i for i, t in enumerate(part) if len(t) == k]
                        r, p = _row_pieces([part[i] for i in short], [k], False)
                        row, piece = np.concatenate([row, np.array(short, np.int64)[r]]), np.concatenate([piece, p])
                else:
                    row, piece = _row_pieces(part, lengths, chosen)
                if wanted is not None:
                    slot = piece.view(np.uint64) >> np.uint64(64 - _SLOT_BITS)
                    some = wanted[slot]
                    row, piece = row[some], piece[some]
                out = rest.slice(a, b - a).take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(piece)], [*out.schema.names, "_piece"])
                a = b
    return run


def _slots_of(pieces: DataFrame):
    """The bit map of the slots of ``_piece``: one row of at most 2**15 numbers, however many pieces there are."""
    import numpy as np

    slot = F.shiftrightunsigned("_piece", 64 - _SLOT_BITS)
    words = pieces.select(slot.alias("s")).groupBy(F.shiftright("s", 5).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s & 31 as int))")).alias("bits"))
    row = words.agg(F.collect_list("word").alias("word"), F.collect_list("bits").alias("bits")).first()
    out = np.zeros((1 << (_SLOT_BITS - 5), 32), bool)
    bits = np.array(row["bits"], np.uint64)
    out[np.array(row["word"], np.int64)] = (bits[:, None] >> np.arange(32, dtype=np.uint64)) & np.uint64(1) == 1
    return out.ravel()


def _kinds(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def occurrences(hay: DataFrame, keys: list[str], text: str, needles: DataFrame, needle: str) -> DataFrame:
    """(keys, needle) wherever a needle occurs in a text: an equi join on pieces, then verification.

    Texts give their grams of each length below SHORT that a needle has, so a short needle meets only the
    texts that hold it; and the smallest gram hash of each of their windows. A longer needle meets texts on
    the one of its own choices that fewest needles share, so needles with a common beginning do not meet alike.
    """
    names = needles.select(F.col(needle).alias("_needle")).where("_needle != ''").distinct()
    size = F.char_length("_needle")
    bits = names.agg(F.bit_or(F.when(size < SHORT, F.expr("shiftleft(1, char_length(_needle))")).otherwise(1))).first()[0] or 0
    lengths = [k for k in range(1, SHORT) if bits >> k & 1]
    every = names.mapInArrow(_piece_rows("_needle", lengths, True, own_length=True), "_needle string, _piece bigint")
    shared = every.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    met = every.join(shared, "_piece").groupBy("_needle").agg(F.min(F.struct("_n", "_piece")).alias("_p")).select(
        "_needle", F.col("_p._piece").alias("_piece"))
    pieces = hay.select(*keys, F.col(text).alias("_hay")).where("_hay != ''").mapInArrow(
        _piece_rows("_hay", lengths, bits & 1 == 1, wanted=_slots_of(met)), f"{_kinds(hay, keys)}, _piece bigint")
    pairs = pieces.join(met, "_piece").select(*keys, "_needle").distinct()
    # texts that come from compressed files look small enough to broadcast; they are not
    return hay.select(*keys, F.col(text).alias("_hay")).join(pairs.hint("merge"), keys).where(
        F.contains("_hay", F.col("_needle")))


def leak_scan(
    texts: DataFrame, text_id: str, text: str,
    candidates: DataFrame, candidate_id: str, candidate: str,
) -> DataFrame:
    """(text_id, candidate_id) wherever a blank-free candidate occurs in a blank-free text.

    Only ids leave the scan, never the found value.
    """
    clean = candidates.select(
        F.col(candidate_id), T.without_spaces(F.col(candidate)).alias("_needle")
    ).where(F.col("_needle") != "")
    hay = texts.select(F.col(text_id), T.without_spaces(F.col(text)).alias("_text"))
    found = occurrences(hay, [text_id], "_text", clean, "_needle")
    return found.join(clean, "_needle").select(text_id, candidate_id).distinct()


# -- roster -----------------------------------------------------------------------------------

def roster_hits(areas: DataFrame, keys: list[str], area: str, roster: DataFrame) -> DataFrame:
    """(keys, pos, name): roster names and their first position in each text."""
    return occurrences(areas, keys, area, roster, "municipality").select(
        *keys, F.call_function("instr", F.col("_hay"), F.col("_needle")).alias("pos"), F.col("_needle").alias("name"))


def area_roster(
    areas: DataFrame, key: str, area: str, org_name: str, roster: DataFrame,
) -> DataFrame:
    """(key, municipalities): roster names found in a text, ';'-joined by first position."""
    per = roster_hits(areas, [key], area, roster).groupBy(key).agg(
        F.collect_set(F.struct("pos", "name")).alias("_hits"))
    none = F.array().cast("array<struct<pos:int,name:string>>")
    ordered = T.order_area_hits(F.coalesce("_hits", none), F.col(area), F.col(org_name))
    return areas.select(key, area, org_name).join(per, key, "left").select(
        key, F.array_join(ordered, ";").alias("municipalities"))


# -- token coverage ---------------------------------------------------------------------------

TOKEN_KINDS = ("heading", "identifier", "table_first_column", "code_line")
# fixed values: heading levels, and the lengths that quoted names and code lines must have
HEADING_LEVELS, NAME_CHARS, CODE_CHARS = (2, 4), (2, 80), 4

def _parts(c: Column) -> Column:
    """A Markdown text cut at its fence lines: every second part is code."""
    return F.split(c, r"(?m)^[ \t]*```[^\n]*$")


def _lines(parts: Column, inside: int) -> Column:
    """Lines outside (0) or inside (1) code of a text in parts; a fence that is never closed opens none."""
    closed = F.size(parts) - F.when(F.size(parts) % 2 == 0, 1).otherwise(0)
    own = F.filter(parts, lambda p, i: (i % 2 == inside) & (i < closed) | (
        (i >= closed) if inside == 0 else F.lit(False)))
    return F.flatten(F.transform(own, lambda p: F.split(p, "\n")))


def document_tokens(plain: Column, code: Column, ignore: tuple[str, ...] = ()) -> dict[str, Column]:
    """Tokens of a Markdown text that a revision must not lose, by kind, from its lines outside and inside code.

    A line outside is a heading by its leading marks, a table row by its first character, and may hold
    quoted names. First cells named in ``ignore`` do not count.
    """
    marks = lambda x: F.length(F.regexp_extract(x, "^(#+)[ \t]", 1))
    headings = F.filter(plain, lambda x: marks(x).between(*HEADING_LEVELS))
    rows = F.filter(plain, lambda x: F.startswith(x, F.lit("|")) & (F.size(F.split(x, r"\|")) > 2))
    cells = F.transform(rows, lambda x: T.strip(F.get(F.split(x, r"\|"), F.lit(1))))
    quoted = F.flatten(F.transform(plain, lambda x: F.filter(
        F.split(x, "`"), lambda q, i: (i % 2 == 1) & F.length(q).between(*NAME_CHARS))))
    dropped = F.array(*map(F.lit, ignore)) if ignore else F.array().cast("array<string>")
    return {
        "heading": F.transform(headings, lambda x: T.strip(F.substring(x, marks(x) + 1, F.length(x)))),
        "identifier": F.array_distinct(quoted),
        "table_first_column": F.array_except(
            F.filter(cells, lambda x: ~x.rlike("^[-:]*$")), dropped),
        "code_line": F.array_distinct(F.filter(F.transform(code, T.strip), lambda x: F.length(x) >= CODE_CHARS)),
    }


def token_coverage(
    pairs: DataFrame, old: str, new: str, notes_heading: str, ignore: tuple[str, ...] = (),
) -> DataFrame:
    """Per kind: tokens of the old text, present in the new one, explained in its notes, missing.

    All work on a pair stays in its row; only four counters per pair are aggregated.
    """
    notes = F.regexp_extract(F.col(new), rf"(?ms)^#{{1,3}}[^\n]*\Q{notes_heading}\E.*", 0)
    # a select each, so that no text is cut or normalised twice
    cut = pairs.select(_parts(F.col(old)).alias("_parts"), F.col(new).alias("_new"), notes.alias("_notes"))
    lined = cut.select(_lines(F.col("_parts"), 0).alias("_plain"), _lines(F.col("_parts"), 1).alias("_code"), "_new", "_notes")
    tokens = document_tokens(F.col("_plain"), F.col("_code"), ignore)
    found = lined.select("_new", "_notes", *[tokens[k].alias(k) for k in TOKEN_KINDS])
    sized = found.select(
        *[F.size(k).alias(f"_n_{k}") for k in TOKEN_KINDS],
        F.concat(F.array("_new", "_notes"), *TOKEN_KINDS).alias("_all"))
    # normalised once a row, and outside the JVM only where normalising may change anything
    settled = ~F.exists("_all", lambda x: ~is_compatible(x))
    clean = sized.select(*[f"_n_{k}" for k in TOKEN_KINDS], F.coalesce(
        nfkc_each(F.when(~settled, F.col("_all"))), F.col("_all")).alias("_all"))
    clean = clean.withColumn("_all", F.transform("_all", T.remove_blanks))
    start, slices = F.lit(3), []
    for k in TOKEN_KINDS:
        slices.append(F.slice("_all", start, F.col(f"_n_{k}")).alias(k))
        start = start + F.col(f"_n_{k}")
    keyed = clean.select(F.col("_all")[0].alias("_new"), F.col("_all")[1].alias("_notes"), *slices)

    lost = lambda k: F.filter(k, lambda x: (x != "") & ~F.contains(F.col("_new"), x))
    keyed = keyed.select("_notes", *TOKEN_KINDS, *[lost(k).alias(f"_lost_{k}") for k in TOKEN_KINDS])

    def counts(kind: str) -> Column:
        gone = F.col(f"_lost_{kind}")
        explained = F.size(F.filter(gone, lambda x: F.contains(F.col("_notes"), x)))
        return F.struct(
            F.lit(kind).alias("kind"), F.size(kind).alias("total"),
            (F.size(F.filter(kind, lambda x: x != "")) - F.size(gone)).alias("present"),
            explained.alias("explained"), (F.size(gone) - explained).alias("missing"))

    return (
        keyed.select(F.explode(F.array(*[counts(k) for k in TOKEN_KINDS])).alias("k"))
        .groupBy("k.kind")
        .agg(*[F.sum(f"k.{c}").alias(c) for c in ("total", "present", "explained", "missing")])
    )
