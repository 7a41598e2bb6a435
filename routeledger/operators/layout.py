"""Word-box layout over a ``words`` table: doc page, text, x0, x1, top, bottom, word_idx."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from routeledger.operators import ordered
from routeledger.session import shared_folder

TILE = 50


def centre_x() -> Column:
    return (F.col("x0") + F.col("x1")) / 2


def centre_y() -> Column:
    return (F.col("top") + F.col("bottom")) / 2


def words_in_box(words: DataFrame, boxes: DataFrame, tile: int = TILE) -> DataFrame:
    """(box_id, word columns) for words whose centre lies in a box of their page, bounds included.

    A NULL side of a box is open. Words carry the horizontal band of their centre and boxes the
    bands they touch within the page's extent, so the join key is (page, band) and a crowded page
    spreads over its bands.
    """
    cy = centre_y()
    band = F.floor(F.col("_cy") / tile)
    w = words.withColumn("_cx", centre_x()).withColumn("_cy", cy).withColumn("_band", band)
    extent = w.groupBy("page").agg(F.min("_band").alias("_b0"), F.max("_band").alias("_b1"))
    lo = F.greatest(F.col("_b0"), F.floor(F.col("b_top") / tile))
    hi = F.least(F.col("_b1"), F.floor(F.col("b_bottom") / tile))
    b = boxes.select(
        "page", "box_id", F.col("x0").alias("b_x0"), F.col("x1").alias("b_x1"),
        F.col("top").alias("b_top"), F.col("bottom").alias("b_bottom"),
    ).join(extent, "page").withColumn("_lo", lo).withColumn("_hi", hi).where("_lo <= _hi")
    b = b.withColumn("_band", F.explode(F.sequence("_lo", "_hi"))).drop("_lo", "_hi", "_b0", "_b1")

    def inside(v: str, low: str, high: str) -> Column:
        return (F.col(low).isNull() | (F.col(v) >= F.col(low))) & (
            F.col(high).isNull() | (F.col(v) <= F.col(high)))

    hit = inside("_cx", "b_x0", "b_x1") & inside("_cy", "b_top", "b_bottom")
    return w.join(b, ["page", "_band"]).where(hit).select("box_id", *words.columns)


def find_label(
    words: DataFrame, text: str, x_max: float | None = None, top_max: float | None = None
) -> DataFrame:
    """Topmost word per page equal to ``text`` within the limits (exclusive)."""
    cond = F.col("text") == text
    if x_max is not None:
        cond = cond & (F.col("x0") < x_max)
    if top_max is not None:
        cond = cond & (F.col("top") < top_max)
    best = F.min(F.struct("top", "word_idx", "x0", "x1", "bottom"))
    return words.where(cond).groupBy("page").agg(best.alias("w")).select(
        "page", "w.word_idx", "w.x0", "w.x1", "w.top", "w.bottom")


def gap_join(words: DataFrame, by: list[str], threshold: float) -> DataFrame:
    """(by, text): words of one line from left to right, blank where the gap exceeds a threshold."""
    w = Window.partitionBy(*by).orderBy("x0", "word_idx")
    gap = F.col("x0") - F.lag("x1").over(w)
    piece = F.concat(F.when(gap > threshold, " ").otherwise(""), F.col("text"))
    return (
        words.withColumn("_piece", piece).withColumn("_rn", F.row_number().over(w))
        .groupBy(*by)
        .agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("_rn", "_piece"))), lambda x: x["_piece"]), ""
        ).alias("text")))


def label_value(
    words: DataFrame, label: str, x_from: float, slack: float = 3.0, threshold: float = 7.0,
    x_max: float | None = None, top_max: float | None = None,
) -> DataFrame:
    """(page, text): the words right of ``x_from`` on the line of a label."""
    lab = find_label(words, label, x_max, top_max).select(
        "page", (F.col("top") - slack).alias("_t"), (F.col("bottom") + slack).alias("_b"))
    row = words.where(centre_x() >= x_from).join(lab, "page").where(
        (centre_y() >= F.col("_t")) & (centre_y() <= F.col("_b")))
    return gap_join(row, ["page"], threshold)


#: width of a tile of leader_rows, in tolerances
TILES = 64


def _successors(tolerance: float, keys: list[str]):
    """Of values as seen from tiles: (keys, value, first, next) of leaders and of values in runs over several tiles."""
    def rows(batches):
        import numpy as np
        import pyarrow as pa

        def done(table):
            v, tile, seen = (table.column(c).to_numpy() for c in ("_v", "_tile", "_from"))
            new = np.ones(len(v), bool)
            new[1:] = seen[1:] != seen[:-1]
            for k in keys:
                code = table.column(k).dictionary_encode().combine_chunks().indices.to_numpy(zero_copy_only=False)
                new[1:] |= code[1:] != code[:-1]
            group = np.cumsum(new)
            # a value's next is the first of its group that is not closer than the tolerance
            place = np.arange(len(v))
            start = np.flatnonzero(new)
            end = np.append(start[1:], len(v))[group - 1]
            low, high = place.copy(), end.copy()
            while (low < high).any():
                mid = (low + high) // 2
                near = (low < high) & (v[np.minimum(mid, len(v) - 1)] - v < tolerance)
                low, high = np.where(near, mid + 1, low), np.where(near | (low >= high), high, mid)
            closed = (place > 0) & ~new
            closed[1:] &= v[1:] - v[:-1] < tolerance
            inner = np.minimum(low, len(v) - 1)
            has = (low < end) & closed[inner]
            # runs that lie in their tile from end to end are settled here, in at most TILES steps
            own = tile == seen
            run = np.cumsum(~closed) - 1
            whole = np.bincount(run, ~own)[run] == 0
            leader = whole & ~closed
            at = np.flatnonzero(leader & has)
            while len(at):
                at = low[at]
                leader[at] = True
                at = at[has[at]]
            at = np.flatnonzero(leader | own & ~whole)
            out = table.take(pa.array(at))
            has &= ~whole
            return pa.Table.from_arrays(
                [*[out.column(k) for k in keys], out.column("_v"), pa.array(leader[at] | ~closed[at]),
                 pa.array(v[inner[at]], mask=~has[at])],
                [*keys, "_v", "_first", "_next"]).combine_chunks().to_batches()

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            if not len(table):
                continue
            # the last group may go on in the next batch
            same = np.ones(len(table), bool)
            for c in [*keys, "_from"]:
                column = table.column(c)
                encoded = column.dictionary_encode().combine_chunks().indices.to_numpy(zero_copy_only=False)
                same &= encoded == encoded[-1]
            cut = len(table) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield from done(table.slice(0, cut).combine_chunks())
            held = table.slice(cut).combine_chunks().to_batches()[0]
        if held is not None:
            yield from done(pa.Table.from_batches([held]))
    return rows


def leader_rows(df: DataFrame, by: list[str], value: str, tolerance: float) -> DataFrame:
    """(by, leader): ascending values, a new cluster where a value is ``tolerance`` or more above the
    cluster's first value.

    Values meet their neighbours in tiles of ``TILES`` tolerances, so no page is gathered anywhere. A value with
    nothing close below it is a leader, and runs of close values that end in their tile are settled there. In
    longer runs an edge leads from each value to the next leader it would have; pointer doubling follows the
    edges from the leaders in as many steps as the logarithm of the longest chain.
    """
    spark = df.sparkSession
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
    width = TILES * tolerance
    inside = F.col("_v") - F.col("_tile") * width
    # a tile sees what is close before it and, rounding allowed for, three tolerances behind it
    views = F.array_compact(F.array(
        F.col("_tile"), F.when(inside < 3 * tolerance, F.col("_tile") - 1),
        F.when(inside >= width - 2 * tolerance, F.col("_tile") + 1)))
    seen = (
        df.select(*by, F.col(value).cast("double").alias("_v")).where("_v is not null").distinct()
        .withColumn("_tile", F.floor(F.col("_v") / width)).withColumn("_from", F.explode(views)))
    path = shared_folder(spark, "successors")
    seen.repartition(*by, "_from").sortWithinPartitions(*by, "_from", "_v").mapInArrow(
        _successors(tolerance, by), f"{kinds}, _v double, _first boolean, _next double").write.parquet(path)
    values = spark.read.parquet(path)
    alone = values.where("_first and _next is null").select(*by, "_v")
    marked = values.where("_first and _next is not null").select(*by, "_v")
    jump = values.where("_next is not null").select(*by, "_v", "_next")
    while not jump.isEmpty():
        step, far = shared_folder(spark, "leaders"), shared_folder(spark, "jumps")
        reached = marked.join(jump, [*by, "_v"]).select(*by, F.col("_next").alias("_v"))
        marked.unionByName(reached).write.parquet(step)
        jump.join(jump.select(*by, F.col("_v").alias("_next"), F.col("_next").alias("_far")), [*by, "_next"]).select(
            *by, "_v", F.col("_far").alias("_next")).write.parquet(far)
        marked, jump = spark.read.parquet(step), spark.read.parquet(far)
    marked = alone.unionByName(marked)
    return marked.withColumnRenamed("_v", "leader")


def leader_clusters(df: DataFrame, by: list[str], value: str, tolerance: float) -> DataFrame:
    """(by, leaders): the leaders of each group as one ascending array."""
    return leader_rows(df, by, value, tolerance).groupBy(*by).agg(
        F.array_sort(F.collect_set("leader")).alias("leaders"))


def grid_boxes(edges: DataFrame, columns: int = 7, tolerance: float = 2.0) -> DataFrame:
    """(page, row_no, col_no, x0, x1, top, bottom): cells between the right-most column rules and all row rules."""
    place = F.when(F.col("orientation") == "v", F.col("x0")).otherwise(F.col("top"))
    rules = leader_rows(
        edges.where(F.col("orientation").isin("v", "h")).select("page", "orientation", place.alias("p")),
        ["page", "orientation"], "p", tolerance)
    # column rules are counted from the right, so that none has to wait for the number of them
    at = F.when(F.col("orientation") == "v", 0 - F.col("leader")).otherwise(F.col("leader"))
    rules = ordered.numbered(rules.withColumn("_at_rule", at), ["page", "orientation"], "_at_rule", "no")
    # a rule opens a span and closes the one before: both meet by number, in one pass over the rules
    rule, none = F.col("leader"), F.lit(None).cast("double")
    sides = F.array(
        F.struct(F.col("no").alias("no"), rule.alias("opens"), none.alias("closes")),
        F.struct((F.col("no") - 1).alias("no"), none.alias("opens"), rule.alias("closes")))
    spans = rules.select("page", "orientation", F.explode(sides).alias("s")).groupBy("page", "orientation", "s.no").agg(
        F.max("s.opens").alias("opens"), F.max("s.closes").alias("closes")).where(
        "opens is not null and closes is not null")
    cols = spans.where("orientation = 'v'").where(F.col("no") <= columns).groupBy("page").agg(F.collect_list(F.struct(
        (columns + 1 - F.col("no")).cast("int").alias("col_no"), F.col("closes").alias("x0"),
        F.col("opens").alias("x1"))).alias("cols")).where(F.size("cols") == columns)
    rows = spans.where("orientation = 'h'").select(
        "page", F.col("no").cast("int").alias("row_no"), F.col("opens").alias("top"), F.col("closes").alias("bottom"))
    return rows.join(cols, "page").select("page", "row_no", "top", "bottom", F.explode("cols").alias("c")).select(
        "page", "row_no", "c.col_no", "c.x0", "c.x1", "top", "bottom")


def grid_cells(words: DataFrame, edges: DataFrame, columns: int = 7,
               tolerance: float = 2.0, threshold: float = 7.0) -> DataFrame:
    """(page, row_no, col_no, text): text of each non-empty grid cell.

    A word belongs to every cell its centre touches, bounds included; cells are boxes, so words and
    cells meet by page and band. A row without words gives nothing, so blank form rows vanish.
    """
    cells = grid_boxes(edges, columns, tolerance).select(
        "page", F.struct("row_no", "col_no").alias("box_id"), "x0", "x1", "top", "bottom")
    placed = words_in_box(words, cells).select("box_id.row_no", "box_id.col_no", *words.columns)
    return gap_join(placed, ["page", "row_no", "col_no"], threshold)


#: words of a page that boxes meet without tiles
CROWD = 500


def recovered_cells(words: DataFrame, cells: DataFrame, header_row: int = 1, tile: int = TILE) -> DataFrame:
    """(page, row_no, col_no, text): the text of cells that a table's found boxes lack.

    ``cells``: page, row_no, col_no, x0, x1, top, bottom of the boxes found. A row below the header with any
    box is expected to have one under each header box; what is missing spans the header box's width and the
    height of the row's boxes. Its words, by (top, x0), are joined by line ends; no words give an empty text.
    A row meets its header as a whole, so that only missing boxes are ever rows. They meet the words of their
    page; where these are more than ``CROWD``, in tiles of both axes, so that neither a tall row nor a wide
    column gathers a page. Crowded pages are landed first: where there are none, no box is put into tiles.
    """
    heads = cells.where(F.col("row_no") == header_row).groupBy("page").agg(
        F.collect_list(F.struct("col_no", "x0", "x1")).alias("heads"))
    rows = cells.where(F.col("row_no") > header_row).groupBy("page", "row_no").agg(
        F.min("top").alias("_top"), F.max("bottom").alias("_bottom"), F.collect_set("col_no").alias("_have"))
    lacks = F.filter("heads", lambda h: ~F.coalesce(F.array_contains("_have", h["col_no"]), F.lit(False)))
    placed = words.select("page", "text", "x0", "top", "word_idx", centre_x().alias("cx"), centre_y().alias("cy"))

    def missing(heads: DataFrame) -> DataFrame:
        return rows.join(heads, "page").select("page", "row_no", "_top", "_bottom", F.explode(lacks).alias("h")).select(
            "page", "row_no", "h.col_no", F.col("h.x0").alias("_x0"), F.col("h.x1").alias("_x1"), "_top", "_bottom")

    def texts(boxes: DataFrame, words: DataFrame, by: list[str]) -> DataFrame:
        inside = F.col("cx").between(F.col("_x0"), F.col("_x1")) & F.col("cy").between(F.col("_top"), F.col("_bottom"))
        order = F.array_sort(F.collect_list(F.when(inside, F.struct("top", "x0", "word_idx", "text"))))
        return boxes.join(words, by, "left").groupBy("page", "row_no", "col_no").agg(
            F.array_join(F.transform(order, lambda w: w["text"]), "\n").alias("text"))

    path = shared_folder(words.sparkSession, "crowded")
    words.groupBy("page").count().where(F.col("count") > CROWD).select("page").write.parquet(path)
    crowded = words.sparkSession.read.parquet(path)
    if crowded.isEmpty():
        return texts(missing(heads), placed, ["page"])
    at = lambda c: F.floor(F.col(c) / tile)
    tiles = (
        missing(heads.join(crowded, "page", "left_semi"))
        .withColumn("_tx", F.explode_outer(F.sequence(at("_x0"), at("_x1"))))
        .withColumn("_ty", F.explode_outer(F.sequence(at("_top"), at("_bottom")))))
    in_tiles = placed.join(crowded, "page", "left_semi").withColumn("_tx", at("cx")).withColumn("_ty", at("cy"))
    few = placed.join(crowded, "page", "left_anti")
    return texts(missing(heads.join(crowded, "page", "left_anti")), few, ["page"]).unionByName(
        texts(tiles, in_tiles, ["page", "_tx", "_ty"]))


def cell_split(cell: Column, top_name: Column | None = None, top_location: Column | None = None) -> Column:
    """Struct (name, location) of a wrapped office cell.

    The first boundary at which both halves equal the reference pair wins; otherwise the first
    line is the name, as it is without a reference pair.
    """
    from routeledger.functions import text as T

    lines = F.filter(F.transform(F.split(cell, "\n"), T.strip), lambda x: x != "")

    fallback = F.struct(
        F.coalesce(F.get(lines, F.lit(0)), F.lit("")).alias("name"),
        F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), "").alias("location"))
    if top_name is None:
        return fallback

    def halves(k: Column) -> Column:
        return F.struct(
            F.array_join(F.slice(lines, F.lit(1), k), "").alias("name"),
            F.array_join(F.slice(lines, k + 1, F.size(lines)), "").alias("location"))

    options = F.transform(
        F.when(F.size(lines) > 1, F.sequence(F.lit(1), F.size(lines) - 1))
        .otherwise(F.array().cast("array<int>")), halves)
    exact = F.filter(options, lambda o: (T.compare_key(o["name"]) == T.compare_key(top_name))
                     & (T.compare_key(o["location"]) == T.compare_key(top_location)))
    return F.coalesce(F.get(exact, F.lit(0)), fallback)
