"""HTML and Markdown tables to grids, cells, headers and records."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cell texts that stand for no value, and units that may follow a number (fixed values).
MISSING = ["", "-", "--", "—", "/", "n/a", "na", "nan", "nd", "n.d.", "null", "none"]
UNITS = r"(%|‰|ppm|ppb|mm|cm|km|m|mg/g|mg|kg|g|t|Ma|ka|℃|°C|MPa|kPa|md|mD|μm|nm)"
NUMBER = r"[-+]?\d+(?:\.\d+)?"
MOST_SPAN = 1000


class _Cells(HTMLParser):
    """Rows of (tag, rowspan, colspan, text) of the outermost table."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[list]] = []
        self.depth, self.cell = 0, None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
        elif self.depth == 1 and tag == "tr":
            self.rows.append([])
        elif self.depth == 1 and tag in ("td", "th"):
            a = dict(attrs)
            span = lambda n: max(1, min(MOST_SPAN, int(m[0]))) if (m := re.match(r"\d+", a.get(n) or "")) else 1
            if not self.rows:
                self.rows.append([])
            self.cell = [tag, span("rowspan"), span("colspan"), ""]
            self.rows[-1].append(self.cell)
        elif tag == "br" and self.cell is not None:
            self.cell[3] += " "

    def handle_endtag(self, tag):
        if tag == "table":
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th", "tr"):
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None and self.depth == 1:
            self.cell[3] += data


def parse_rows(html: str) -> list[list[list]]:
    parser = _Cells()
    parser.feed(html or "")
    parser.close()
    return [[[t, r, c, " ".join(x.split())] for t, r, c, x in row] for row in parser.rows]


def canonical_html(html: str) -> str:
    """The table with rows and cells alone, spans over 1 kept, texts escaped."""
    rows = []
    for row in parse_rows(html):
        cells = []
        for tag, r, c, text in row:
            spans = (f' rowspan="{r}"' if r > 1 else "") + (f' colspan="{c}"' if c > 1 else "")
            cells.append(f"<{tag}{spans}>{escape(text)}</{tag}>")
        rows.append(f"<tr>{''.join(cells)}</tr>")
    return f"<table>{''.join(rows)}</table>"


def expand(html: str) -> list[tuple[int, int, int, int, bool, str]]:
    """(first row, last row, first column, last column, header, text) of each cell; taken slots are passed over."""
    taken: set[tuple[int, int]] = set()
    rows = parse_rows(html)
    out = []
    for r, row in enumerate(rows):
        col = 0
        for tag, down, right, text in row:
            while (r, col) in taken:
                col += 1
            down = min(down, len(rows) - r)
            taken.update((a, b) for a in range(r, r + down) for b in range(col, col + right))
            out.append((r, r + down - 1, col, col + right - 1, tag == "th", text))
            col += right
    return out


def cells(tables: DataFrame, key: str, html: str) -> DataFrame:
    """key, cell_id, row_start, row_end, col_start, col_end, is_header, text; a table that cannot be read has no rows."""
    kind = tables.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [key, "cell_id", "row_start", "row_end", "col_start", "col_end", "is_header", "text"]
        for df in frames:
            rows = [(k, f"r{c[0]}c{c[2]}", *c) for k, h in zip(df[key], df[html]) for c in expand(h)]
            yield pd.DataFrame(rows, columns=names)

    return tables.select(key, html).mapInPandas(run, f"{key} {kind}, cell_id string, row_start int, row_end int, col_start int, col_end int, is_header boolean, text string")


def canonicalise(tables: DataFrame, key: str, html: str) -> DataFrame:
    kind = tables.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            yield pd.DataFrame({key: df[key], "canonical": [canonical_html(h) for h in df[html]]})

    return tables.select(key, html).mapInPandas(run, f"{key} {kind}, canonical string")


def slots(found: DataFrame, key: str) -> DataFrame:
    """A row for each (row, col) that a cell covers."""
    return found.withColumn("row", F.explode(F.sequence("row_start", "row_end"))).withColumn("col", F.explode(F.sequence("col_start", "col_end")))


def matrix(found: DataFrame, key: str) -> DataFrame:
    """key, matrix (array of rows of texts): rectangular, empty where no cell is."""
    s = slots(found, key)
    size = s.groupBy(key).agg(F.max("row").alias("_r"), F.max("col").alias("_c"))
    grid = size.select(key, F.explode(F.sequence(F.lit(0), "_r")).alias("row"), "_c").select(key, "row", F.explode(F.sequence(F.lit(0), "_c")).alias("col"))
    full = grid.join(s.groupBy(key, "row", "col").agg(F.min("text").alias("text")), [key, "row", "col"], "left")
    rows = full.groupBy(key, "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("col", F.coalesce("text", F.lit("")).alias("t")))), lambda x: x["t"]).alias("texts"))
    return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "texts"))), lambda x: x["texts"]).alias("matrix"))


def pipe_table_html(markdown: Column) -> Column:
    """A Markdown pipe table as HTML: the first row as headers, separator rows gone, short rows padded."""
    lines = F.filter(F.transform(F.split(markdown, "\n"), lambda x: F.trim(x)), lambda x: F.contains(x, F.lit("|")) & ~x.rlike(r"^\|?[\s:|-]+\|?$"))
    rows = F.transform(lines, lambda x: F.transform(F.split(F.regexp_replace(x, r"^\||\|$", ""), r"\|"), lambda c: F.trim(c)))
    wide = F.array_max(F.transform(rows, lambda r: F.size(r)))
    padded = F.transform(rows, lambda r: F.concat(r, F.array_repeat(F.lit(""), wide - F.size(r))))
    html = F.transform(padded, lambda r, i: F.concat(F.lit("<tr>"), F.array_join(F.transform(r, lambda c: F.when(i == 0, F.concat(F.lit("<th>"), c, F.lit("</th>"))).otherwise(F.concat(F.lit("<td>"), c, F.lit("</td>")))), ""), F.lit("</tr>")))
    return F.concat(F.lit("<table>"), F.array_join(html, ""), F.lit("</table>"))


def parse_value(text: Column) -> Column:
    """struct(value_type, num, min_value, max_value, comparator, unit): missing, number, range or text."""
    t = F.trim(F.replace(text, F.lit(","), F.lit("")))
    span = rf"^({NUMBER})\s*(?:~|～|–|—|-|to)\s*({NUMBER})\s*{UNITS}?$"
    number = rf"^(<=|>=|<|>|≤|≥|~|≈)?\s*({NUMBER})\s*{UNITS}?$"
    a, b = F.regexp_extract(t, span, 1).try_cast("double"), F.regexp_extract(t, span, 2).try_cast("double")
    n = F.regexp_extract(t, number, 2).try_cast("double")
    kind = F.when(text.isNull() | F.lower(t).isin(MISSING), "missing").when(n.isNotNull(), "number").when(a.isNotNull() & b.isNotNull(), "range").otherwise("text")
    none = F.lit(None).cast("double")
    unit = F.coalesce(F.nullif(F.regexp_extract(t, number, 3), F.lit("")), F.nullif(F.regexp_extract(t, span, 3), F.lit("")), F.lit(""))
    return F.struct(
        kind.alias("value_type"), F.when(kind == "number", n).otherwise(none).alias("num"),
        F.when(kind == "range", F.least(a, b)).otherwise(none).alias("min_value"), F.when(kind == "range", F.greatest(a, b)).otherwise(none).alias("max_value"),
        F.when(kind == "number", F.regexp_extract(t, number, 1)).otherwise(F.lit("")).alias("comparator"), F.when(kind.isin("number", "range"), unit).otherwise(F.lit("")).alias("unit"),
    )


def header_unit(text: Column) -> Column:
    """The unit in a header: in trailing brackets, else after a slash, else a known one at the end."""
    pick = lambda p: F.nullif(F.trim(F.regexp_extract(text, p, 1)), F.lit(""))
    return F.coalesce(pick(r"[(（]([^()（）]+)[)）]\s*$"), pick(r"/\s*([^/\s()]+)\s*$"), pick(rf"(?:^|\s){UNITS}$"), F.lit(""))


def structure(found: DataFrame, key: str) -> DataFrame:
    """key, caption_rows, header_rows, first_data_row: a caption row is one cell over the whole width at the top; header
    rows are those before the first row of which two fifths of the cells (at least one) are numbers, if any is a
    header cell or comes before data; a table whose first row is data has none."""
    s = slots(found.withColumn("v", parse_value(F.col("text"))["value_type"]), key)
    width = s.groupBy(key).agg((F.max("col") + 1).alias("width"), (F.max("row") + 1).alias("height"))
    rows = s.join(width, key).groupBy(key, "row", "width", "height").agg(
        F.count_if(F.col("v").isin("number", "range")).alias("numeric"), F.bool_or("is_header").alias("th"),
        F.count_distinct("cell_id").alias("n_cells"), F.bool_and((F.col("col_start") == 0) & (F.col("col_end") == F.col("width") - 1)).alias("full"),
    )
    w = Window.partitionBy(key).orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = rows.withColumn("caption", F.bool_and(F.col("full") & (F.col("width") > 1)).over(w))
    need = F.greatest(F.lit(1), F.floor((2 * F.col("width") + 4) / 5))
    data = F.min(F.when(~F.col("caption") & ~F.col("th") & (F.col("numeric") >= need), F.col("row")))
    got = marked.groupBy(key, "height").agg(
        data.alias("_data"), F.array_sort(F.collect_list(F.when(F.col("caption"), F.col("row")))).alias("caption_rows"),
        F.array_sort(F.collect_list(F.when(~F.col("caption"), F.col("row")))).alias("_rest"), F.max(F.when(F.col("th") & ~F.col("caption"), F.col("row"))).alias("_th"),
    )
    first = F.coalesce("_data", F.col("_th") + 1, F.element_at("_rest", 1) + 1, F.col("height"))
    return got.select(key, "caption_rows", F.filter("_rest", lambda r: r < first).alias("header_rows"), first.alias("first_data_row"))


def header_paths(found: DataFrame, layout: DataFrame, key: str) -> DataFrame:
    """key, col, path: a column's header texts from the top, without repeats that follow each other and cells over the
    whole width, joined by ' / '; a column without any is called column_n."""
    s = slots(found, key)
    width = s.groupBy(key).agg(F.max("col").alias("_w"))
    cols = width.select(key, F.explode(F.sequence(F.lit(0), "_w")).alias("col"))
    heads = s.join(layout.select(key, "header_rows"), key).join(width, key).where(F.array_contains("header_rows", F.col("row")) & ~((F.col("col_start") == 0) & (F.col("col_end") == F.col("_w"))) & (F.col("text") != ""))
    w = Window.partitionBy(key, "col").orderBy("row")
    kept = heads.withColumn("_p", F.lag("text").over(w)).where("_p IS NULL OR _p <> text")
    path = kept.groupBy(key, "col").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "text"))), lambda x: x["text"]), " / ").alias("path"))
    return cols.join(path, [key, "col"], "left").select(key, "col", F.coalesce("path", F.concat(F.lit("column_"), (F.col("col") + 1).cast("string"))).alias("path"))


def repeating_groups(headers: Column, least: int = 2, most: int = 6) -> Column:
    """The shortest length of a sub-header pattern that repeats over the whole row, or null."""
    n = F.size(headers)
    out = F.lit(None).cast("int")
    for k in range(most, least - 1, -1):
        first = F.slice(headers, 1, k)
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.floor(n / k).cast("int") - 1, F.lit(0))), lambda i: F.slice(headers, i * k + 1, F.lit(k)))
        out = F.when((n >= 2 * k) & (n % k == 0) & F.forall(blocks, lambda b: b == first), F.lit(k)).otherwise(out)
    return out


def table_sources(chunks: DataFrame) -> DataFrame:
    """chunk_id, part, kind, value: the image paths of a chunk, else its Markdown as lines of paths, HTML or a pipe table."""
    path = r"(?i)\S+\.(?:png|jpe?g|gif|bmp|webp|tiff?)"
    paths = F.when(F.size("table_path") > 0, F.col("table_path")).when(
        F.forall(F.filter(F.split("markdown", "\n"), lambda x: F.trim(x) != ""), lambda x: F.trim(x).rlike(rf"^{path}$")), F.filter(F.transform(F.split("markdown", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    )
    kind = F.when(F.size(F.coalesce(paths, F.array().cast("array<string>"))) > 0, "image").when(F.col("markdown").rlike("(?i)<table"), "html").when(F.contains("markdown", F.lit("|")), "markdown").otherwise("empty")
    rows = chunks.withColumn("_kind", kind).withColumn("_values", F.when(kind == "image", paths).otherwise(F.array("markdown")))
    return rows.select("chunk_id", F.posexplode("_values").alias("part", "value"), F.col("_kind").alias("kind")).where("kind <> 'empty'")


def attach_boxes(found: DataFrame, boxes: DataFrame, key: str) -> DataFrame:
    """The i-th cell (by row, then column) gets the i-th box if that is a proper one."""
    w = Window.partitionBy(key).orderBy("row_start", "col_start")
    b = boxes.select(key, F.posexplode("boxes").alias("_i", "_box"))
    good = (F.size("_box") == 4) & (F.col("_box")[2] > F.col("_box")[0]) & (F.col("_box")[3] > F.col("_box")[1])
    return found.withColumn("_i", F.row_number().over(w) - 1).join(b, [key, "_i"], "left").withColumn("bbox", F.when(good, F.col("_box"))).drop("_i", "_box")


def recover_rows(items: DataFrame, keys: DataFrame, centres: DataFrame, key: str, tolerance: float) -> DataFrame:
    """key, row_no, col, text: OCR items (x, y, text) in the band of a record key's y and at the nearest column centre."""
    i = items.select(key, F.col("x").alias("_x"), F.col("y").alias("_y"), "text")
    band = i.join(keys.select(key, "row_no", F.col("y").alias("_ky")), key).where(F.abs(F.col("_y") - F.col("_ky")) <= tolerance)
    near = band.groupBy(key, "_x", "_y", "text").agg(F.min_by("row_no", F.struct(F.abs(F.col("_y") - F.col("_ky")), "row_no")).alias("row_no"))
    placed = near.join(centres.select(key, "col", F.col("x").alias("_cx")), key).groupBy(key, "row_no", "_x", "_y", "text").agg(F.min_by("col", F.struct(F.abs(F.col("_x") - F.col("_cx")), "col")).alias("col"))
    return placed.groupBy(key, "row_no", "col").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_y", "_x", "text"))), lambda x: x["text"]), " ").alias("text"))


def table_quality(found: DataFrame, ocr: DataFrame, key: str, at_least: float = 0.55) -> DataFrame:
    """key, score, errors, passed: .35 of the filled share, .35 of the OCR text found in cells, .30 of cells with a box;
    a table whose last two rows are nearly empty has sparse_tail_rows and does not pass."""
    text = found.groupBy(key).agg(F.array_join(F.collect_list("text"), "").alias("_all"), F.avg((F.col("text") != "").cast("double")).alias("filled"), F.avg(F.col("bbox").isNotNull().cast("double")).alias("placed"))
    seen = ocr.join(text.select(key, "_all"), key).groupBy(key).agg((F.sum(F.when(F.contains("_all", F.col("text")), F.length("text")).otherwise(0)) / F.sum(F.length("text"))).alias("covered"))
    s = slots(found, key)
    top = s.groupBy(key).agg(F.max("row").alias("_last"))
    tail = s.join(top, key).where("row >= _last - 1 AND row > 0").groupBy(key).agg(F.avg((F.col("text") != "").cast("double")).alias("_tail"))
    score = 0.35 * F.col("filled") + 0.35 * F.coalesce("covered", F.lit(0.0)) + 0.30 * F.col("placed")
    errors = F.array_compact(F.array(F.when(F.col("_tail") < 0.34, F.lit("sparse_tail_rows"))))
    return text.join(seen, key, "left").join(tail, key, "left").select(key, score.alias("score"), errors.alias("errors"), ((score >= at_least) & (F.size(errors) == 0)).alias("passed"))
