"""Language of texts by Bayesian evidence fusion.

Evidence: the text (likelihood of its byte trigrams under each language), the declared language, and the
place it comes from, as a prior for its host that is smoothed towards its domain, its address suffix and
finally all rows. The text models are counts over all rows with a declared language; declared languages
agree with texts mostly, and how often they mislead is counted as well: all tables come from grouped
aggregation of all rows. The languages are those whose rows hold EVIDENCE trigrams, whatever their share of the
table, and those that at least one row in 500 declares. They are scored in blocks of BLOCK.

A last class, `und`, takes every trigram as equally likely: texts that look like none of the languages fall
to it. It and posteriors under one half are rejected.

Defined results: null and empty texts and texts without a letter are `und`; texts of fewer than three bytes
go by the other evidence; a null declaration or host is no evidence; repeated rows count as often as they
stand there; rows without id are left out; extra columns are not read; with no declared language at all every
row is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeledger.llm import shared, words as W

_SLOTS = 1 << 16
#: trigrams in the rows of a declared language that are enough for a model
EVIDENCE = 100
BLOCK = 64
UNKNOWN = "und"
#: trigrams of a text overlap and repeat; their joint evidence is taken at this weight
WEIGHT = 0.3
#: pseudo-counts with which a host leans on its domain, a domain on its suffix, a suffix on all rows
LEAN = 20.0

_FOLD = W.LOWER.copy()
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def _trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A slot for each byte's trigram (_SLOTS where it would leave the row), the rows' offsets, letter bytes before each."""
    raw, at = W.column(column)
    data = _FOLD[raw].astype(np.uint32)
    slot = np.full(len(data), _SLOTS, np.int64)
    if len(data) > 2:
        code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
        slot[:-2] = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
        ends = at[1:][np.diff(at) > 0]
        slot[ends - 1] = _SLOTS
        slot[ends[ends > 1] - 2] = _SLOTS
    return slot, at, np.concatenate([[0], np.cumsum(data != 0x20)])


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.portions(batches):
        slot, at, _ = _trigrams(batch.column("text"))
        names = batch.column("declared").dictionary_encode()
        own = np.repeat(names.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(at))
        key = (own * _SLOTS + slot)[slot < _SLOTS]
        if len(names.dictionary) <= BLOCK:
            n = np.bincount(key, minlength=1)
            key = np.flatnonzero(n)
            n = n[key]
        else:
            key, n = np.unique(key, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [names.dictionary.take(pa.array(key // _SLOTS)), pa.array((key % _SLOTS).astype(np.int32)),
             pa.array(n.astype(np.int64))], ["declared", "slot", "n"])


class _Model:
    """Log probabilities by class and slot, the last class uniform and the last slot zero.

    Only slots that a language has reach the driver and the tasks, at most 65,536 a language.
    """

    def __init__(self, language: np.ndarray, slot: np.ndarray, n: np.ndarray, languages: int) -> None:
        order = np.argsort(language, kind="stable")
        self.slot = slot[order].astype(np.int32)
        self.first = np.searchsorted(language[order], np.arange(languages + 1))
        self.total = 0.5 * _SLOTS + np.bincount(language, n, languages)
        self.log = np.log((n[order] + 0.5) / np.repeat(self.total, np.diff(self.first)))
        self.size = languages + 1
        self._kept: tuple[int, np.ndarray] | None = None

    def block(self, at: int) -> np.ndarray:
        """The dense table of up to BLOCK classes from `at`; the last one made is kept."""
        if self._kept is None or self._kept[0] != at:
            stop = min(at + BLOCK, self.size)
            table = np.full((stop - at, _SLOTS + 1), -np.log(_SLOTS))
            for k in range(at, min(stop, self.size - 1)):
                table[k - at] = np.log(0.5 / self.total[k])
                own = slice(self.first[k], self.first[k + 1])
                table[k - at, self.slot[own]] = self.log[own]
            table[:, _SLOTS] = 0
            self._kept = at, table
        return self._kept[1]


def _score_rows(model: _Model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            slot, at, letters = _trigrams(batch.column("text"))
            some = np.flatnonzero(np.diff(at))
            score = np.zeros((len(batch), model.size))
            for first in range(0, model.size, BLOCK):
                for k, logs in enumerate(model.block(first), first):
                    if len(some):
                        score[some, k] = np.add.reduceat(logs[slot], at[:-1][some])
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(batch) + 1, dtype=np.int32) * model.size), pa.array(score.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "ver", "declared", "host", "domain", "suffix")),
                 pa.array(letters[at[1:]] - letters[at[:-1]]), lists],
                ["id", "ver", "declared", "host", "domain", "suffix", "n", "likelihood"])
    return rows


def _learned(rows: DataFrame) -> tuple[list[str], _Model]:
    """The languages with enough evidence, in order, and their model."""
    said = rows.where("declared is not null")
    counts = shared.landed(
        said.select("text", "declared").mapInArrow(_count_rows, "declared string, slot int, n long")
        .groupBy("declared", "slot").agg(F.sum("n").alias("n")), "language-trigrams")
    declared = said.groupBy("declared").agg(F.count(F.lit(1)).alias("n"))
    total = declared.agg(F.sum("n")).first()[0] or 0
    evidence = counts.groupBy("declared").agg(F.sum("n").alias("trigrams"))
    known = shared.landed(
        declared.join(evidence, "declared", "left")
        .where((500 * F.col("n") >= total) | (F.col("trigrams") >= EVIDENCE)).select("declared"), "languages")
    languages = [r.declared for r in known.orderBy("declared").collect()]
    own = counts.join(known, "declared").toPandas()
    place = {x: i for i, x in enumerate(languages)}
    language = np.array([place[x] for x in own["declared"]], np.int64)
    return languages, _Model(language, own["slot"].to_numpy(np.int64), own["n"].to_numpy(np.float64), len(languages))


def _totals(said: DataFrame, k: int) -> np.ndarray:
    """Rows by class among those with a declaration."""
    row = said.agg(*(F.sum(F.get("n_said", F.lit(i))).alias(f"c{i}") for i in range(k))).first()
    return np.array([row[f"c{i}"] or 0.0 for i in range(k)])


def identify(rows: DataFrame) -> DataFrame:
    """Of rows (id, ver, text, declared, host, domain, suffix): id, ver, language, posterior, accepted."""
    languages, model = _learned(rows)
    k = len(languages) + 1
    scored = shared.landed(
        rows.mapInArrow(_score_rows(model),
                        "id long, ver int, declared string, host string, domain string, suffix string, "
                        "n long, likelihood array<double>"), "language-scores")
    text_only = F.array_position("likelihood", F.array_max("likelihood")).cast("int")
    best = scored.where("n > 0").select("declared", "host", "domain", "suffix", text_only.alias("best"))

    def by(keys: list[str], name: str) -> DataFrame:
        return best.groupBy(*keys).agg(F.array(*(
            F.sum((F.col("best") == i).cast("double")) for i in range(1, k + 1))).alias(name))

    def lean(own: str, above: Column) -> Column:
        """Counts leaning on the shares of the level above; no counts: that level's shares."""
        n = F.coalesce(F.aggregate(own, F.lit(0.0), lambda s, x: s + x), F.lit(0.0))
        return F.transform(above, lambda p, i: (F.coalesce(F.get(F.col(own), i), F.lit(0.0)) + LEAN * p) / (n + LEAN))

    everywhere = (best.agg(*(F.sum((F.col("best") == i).cast("double")).alias(f"c{i}") for i in range(1, k + 1)))
                  .first())
    base = np.array([everywhere[f"c{i}"] or 0.0 for i in range(1, k + 1)]) + 1.0
    base = F.array(*(F.lit(float(x)) for x in base / base.sum()))
    prior = (
        by(["host", "domain", "suffix"], "n_host")
        .join(by(["domain", "suffix"], "n_domain"), ["domain", "suffix"])
        .join(by(["suffix"], "n_suffix"), "suffix")
        .withColumn("p", lean("n_suffix", base)).withColumn("p", lean("n_domain", F.col("p")))
        .select("host", "domain", "suffix", lean("n_host", F.col("p")).alias("prior"))
    )
    # how often a declaration is made of rows whose text is of each language
    said = by(["declared"], "n_said").where("declared is not null")
    made = F.array(*(F.lit(float(x)) for x in _totals(said, k)))
    claim = said.select("declared", F.transform(
        "n_said", lambda n, i: F.log((n + 0.5) / (F.get(made, i) + 1.0))).alias("claim"))
    none = F.array(*(F.lit(0.0) for _ in range(k)))
    joined = (
        scored.join(prior, ["host", "domain", "suffix"], "left").join(claim, "declared", "left")
        .withColumn("log", F.transform(
            "likelihood", lambda x, i: WEIGHT * x + F.log(F.get(F.coalesce("prior", base), i))
            + F.get(F.coalesce("claim", none), i)))
        .withColumn("weight", F.transform("log", lambda x: F.exp(x - F.array_max("log"))))
    )
    top = F.array_position("weight", F.array_max("weight")).cast("int")
    names = F.array(*(F.lit(x) for x in [*languages, UNKNOWN]))
    out = joined.select(
        "id", "ver", F.when(F.col("n") > 0, F.get(names, top - 1)).otherwise(F.lit(UNKNOWN)).alias("language"),
        F.when(F.col("n") > 0, 1.0 / F.aggregate("weight", F.lit(0.0), lambda s, x: s + x))
        .otherwise(F.lit(0.0)).alias("posterior"))
    return out.withColumn("accepted", (F.col("language") != UNKNOWN) & (F.col("posterior") >= 0.5))


def of_documents(docs: DataFrame) -> DataFrame:
    """identify() over documents: declared is lang, the host is source; id is doc_id."""
    source = F.lower(F.trim(F.col("source").cast("string")))
    return identify(_rows(docs, "doc_id", F.col("text"), F.col("lang"), source))


def of_pages(pages: DataFrame) -> DataFrame:
    """identify() over pages: declared is the html tag's lang, the host is the url's; id is page_id."""
    visible = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    declared = F.lower(F.regexp_extract("html", r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([a-z]+)", 1))
    host = F.lower(F.regexp_extract("url", r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return identify(_rows(pages, "page_id", visible, declared, host))


def _rows(table: DataFrame, key: str, text: Column, declared: Column, host: Column) -> DataFrame:
    """The columns of identify(); an empty declaration or host is none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    host = F.coalesce(host, F.lit(""))
    return table.select(
        F.col(key).cast("long").alias("id"), F.hash(F.coalesce(F.col(_TEXT[key]), F.lit(""))).alias("ver"),
        text.alias("text"), F.nullif(F.lower(F.trim(declared.cast("string"))), F.lit("")).alias("declared"),
        host.alias("host"), F.substring_index(host, ".", -2).alias("domain"),
        F.substring_index(host, ".", -1).alias("suffix"),
    ).where("id is not null")


_TEXT = {"doc_id": "text", "page_id": "html"}


def accepted(docs: DataFrame) -> DataFrame:
    """docs without the rejected ones; rows without an id stay."""
    bad = of_documents(docs).where("not accepted").select("id", "ver").distinct().alias("bad")
    own = docs.alias("own")
    same = (F.col("own.doc_id") == F.col("bad.id")) & (
        F.hash(F.coalesce(F.col("own.text"), F.lit(""))) == F.col("bad.ver"))
    return own.join(bad, same, "left_anti")
