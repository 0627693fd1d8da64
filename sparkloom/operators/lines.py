"""Line tables and what is read from them: islands, sections, captions, cross-references, spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headings that start the references (fixed values).
REFERENCE_WORDS = r"(?i)references|参考文献"
HEADING = r"^\s{0,3}(#{1,6})\s+(.*?)\s*#*\s*$"
NAMED_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def normalize_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def clean_inline(text: Column, strip_markup: bool = True) -> Column:
    """Named entities resolved, tags gone, ideographic and repeated spaces as one space, trimmed."""
    out = F.regexp_replace(text, r"<[^>]+>", "") if strip_markup else text
    for name, value in NAMED_ENTITIES.items():  # the ampersand comes last, else &amp;lt; would become <
        out = F.replace(out, F.lit(name), F.lit(value))
    out = F.regexp_replace(out, "[　 ]", " ")
    return F.trim(F.regexp_replace(out, r"[ \t]+", " "))


def explode_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, pos (from 0), line."""
    return docs.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))


def islands(rows: DataFrame, key: list[str], order: str, starts: Column) -> DataFrame:
    """island: how many rows at which one starts lie at or before a row."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("island", F.sum(F.when(starts, 1).otherwise(0)).over(w))


def titles(lines: DataFrame, key: str) -> DataFrame:
    """key, title, title_pos: the first level-1 heading, else the first line that is not blank."""
    heading = F.regexp_extract("line", r"^\s{0,3}#\s+(.+?)\s*$", 1)
    return lines.groupBy(key).agg(
        F.min_by(heading, F.when(heading != "", F.col("pos"))).alias("_h"),
        F.min(F.when(heading != "", F.col("pos"))).alias("_hp"),
        F.min_by(F.trim("line"), F.when(F.trim("line") != "", F.col("pos"))).alias("_l"),
        F.min(F.when(F.trim("line") != "", F.col("pos"))).alias("_lp"),
    ).select(key, F.when(F.col("_hp").isNotNull(), F.col("_h")).otherwise(F.col("_l")).alias("title"), F.coalesce("_hp", "_lp").alias("title_pos"))


def boundaries(lines: DataFrame, key: str) -> DataFrame:
    """key, reference_pos, first_section_pos, preamble_end: null where there is none.

    The references start at the first heading that names them; the first section is the first heading of level 2
    or more before them; the preamble ends at the last heading or metadata line before the first section.
    """
    is_heading = F.col("line").rlike(HEADING)
    deep = F.col("line").rlike(r"^\s{0,3}#{2,6}\s+")
    marker = is_heading | F.col("line").rlike(r"(?i)^\s*(abstract|keywords?|key words|摘要|关键词)\b?")
    at = lambda which: F.when(which, F.col("pos"))
    found = lines.select(key, at(is_heading & F.col("line").rlike(REFERENCE_WORDS)).alias("_r"), at(deep).alias("_d"), at(marker).alias("_m"))
    ends = found.groupBy(key).agg(F.min("_r").alias("reference_pos"), F.min("_d").alias("_d"), F.collect_set("_m").alias("_m"))
    cut = ends.withColumn("first_section_pos", F.when(F.col("reference_pos").isNull() | (F.col("_d") < F.col("reference_pos")), F.col("_d")))
    before = F.filter("_m", lambda m: F.col("first_section_pos").isNull() | (m < F.col("first_section_pos")))
    return cut.select(key, "reference_pos", "first_section_pos", F.array_max(before).alias("preamble_end"))


def labelled_block(text: Column, starts: list[str], stops: list[str]) -> Column:
    """The text after a start label up to the next stop label or the end."""
    start, stop = "|".join(starts), "|".join(stops)
    return F.regexp_replace(F.regexp_extract(text, rf"(?is)(?:{start})\s*[:：]?\s*(.*?)(?=(?:{stop})\s*[:：]|\z)", 1), r"\s+$", "")


def metadata(docs: DataFrame, key: str, text: str) -> DataFrame:
    """abstract, keywords (array) and authors (array) of labelled preambles."""
    t = F.col(text)
    stops = ["keywords", "key words", "关键词", "authors?", "作者", "abstract", "摘要", "\n#"]
    words = labelled_block(t, ["keywords", "key words", "关键词"], ["\n"] + stops)
    people = labelled_block(t, ["authors?", "作者"], stops)
    items = lambda c: F.filter(F.transform(F.split(F.split(c, "\n")[0], "[;；,，、]"), lambda x: F.trim(x)), lambda x: x != "")
    zh, en = labelled_block(t, ["摘要"], stops), labelled_block(t, ["abstract"], stops)
    return docs.select(key, F.coalesce(F.when(zh != "", zh), F.when(en != "", en), F.lit("")).alias("abstract"), items(words).alias("keywords"), items(people).alias("authors"))


def sections(lines: DataFrame, key: str) -> DataFrame:
    """key, section_no, level, heading, number, body: a row for each heading of level 2 or more before the references.

    A dotted number gives the level by its parts; else the level is that of the marks.
    """
    cut = boundaries(lines, key).select(key, "reference_pos", "first_section_pos")
    body = lines.join(cut, key).where("pos >= first_section_pos AND (reference_pos IS NULL OR pos < reference_pos)")
    deep = F.col("line").rlike(r"^\s{0,3}#{2,6}\s+")
    rows = islands(body, [key], "pos", deep)
    found = rows.groupBy(key, "island").agg(
        F.min_by("line", "pos").alias("_head"),
        F.array_sort(F.collect_list(F.when(~deep, F.struct("pos", "line")))).alias("_body"),
    )
    title = F.regexp_extract("_head", HEADING, 2)
    number = F.regexp_extract(title, r"^(\d+(?:\.\d+)*)[.、]?\s", 1)
    return found.select(
        key, F.col("island").alias("section_no"),
        F.when(number != "", F.size(F.split(number, r"\.")) + 1).otherwise(F.length(F.regexp_extract("_head", HEADING, 1))).cast("int").alias("level"),
        title.alias("heading"), number.alias("number"),
        F.trim(F.array_join(F.transform("_body", lambda x: x["line"]), "\n")).alias("body"),
    )


def section_parents(found: DataFrame, key: str) -> DataFrame:
    """parent_no: the last earlier section of a smaller level, null for a top one.

    The last section of each smaller level is a window value of its own; the deepest level is asked for first.
    """
    deepest = found.agg(F.max("level")).first()[0] or 1
    w = Window.partitionBy(key).orderBy("section_no").rowsBetween(Window.unboundedPreceding, -1)
    last = [F.last(F.when(F.col("level") == k, F.col("section_no")), ignorenulls=True).over(w) for k in range(1, max(3, deepest))]
    above = [F.when(F.lit(k) < F.col("level"), c) for k, c in enumerate(last, 1)]
    return found.withColumn("parent_no", F.greatest(*above))


def labelled_numbers(text: Column, labels: list[str]) -> Column:
    """The distinct numbers that follow one of the labels, in order."""
    names = "|".join(labels)
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?i)(?:{names})\.?\s*(\d+(?:[.-]\d+)*)"), F.lit(1)))


def cross_references(paragraphs: DataFrame, para_key: list[str], text: str, assets: DataFrame, asset_key: list[str], label: str, number: str) -> DataFrame:
    """Paragraphs whose parenthesised text cites an asset's label and number.

    The cited pairs are read from each paragraph once, so the join is on equal (label, number).
    """
    inside = F.array_join(F.regexp_extract_all(F.col(text), F.lit(r"[(（]([^()（）]*)[)）]"), F.lit(1)), " ; ")
    cited = paragraphs.select(*para_key, F.explode(F.array_distinct(F.regexp_extract_all(inside, F.lit(r"([A-Za-z图表]+\.?\s*\d+(?:\.\d+)*)"), F.lit(1)))).alias("_c"))
    pairs = cited.select(
        *para_key,
        F.lower(F.regexp_extract("_c", r"^([A-Za-z图表]+)", 1)).alias("_label"),
        F.regexp_extract("_c", r"(\d+(?:\.\d+)*)$", 1).alias("_number"),
    ).distinct()
    targets = assets.select(*asset_key, F.lower(F.col(label)).alias("_label"), F.col(number).cast("string").alias("_number"))
    return pairs.join(targets, ["_label", "_number"]).select(*para_key, *asset_key).distinct()


def nearby_caption(lines: DataFrame, key: str, is_asset: Column, caption: Column, before: int = 12, after: int = 8) -> DataFrame:
    """For each asset line, the nearest caption line among the `before` lines above, else the `after` lines below."""
    w = Window.partitionBy(key).orderBy("pos")
    above = F.last(F.when(caption, F.col("line")), ignorenulls=True).over(w.rowsBetween(-before, -1))
    below = F.first(F.when(caption, F.col("line")), ignorenulls=True).over(w.rowsBetween(1, after))
    return lines.withColumn("caption", F.coalesce(above, below)).withColumn("asset", is_asset).where("asset").drop("asset")


def merge_spans(spans: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Spans that overlap or touch as one."""
    w = Window.partitionBy(*key).orderBy(start, end)
    until = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = spans.withColumn("_new", until.isNull() | (F.col(start) > until))
    grouped = islands(rows.withColumn("_row", F.row_number().over(w)), key, "_row", F.col("_new"))
    return grouped.groupBy(*key, "island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("island")


def remove_spans(text: Column, spans: Column) -> Column:
    """The text without the merged, sorted spans (array of struct(start, end), from 0, end exclusive)."""
    n = F.char_length(text)
    begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(n))
    kept = F.zip_with(begins, ends, lambda b, e: F.substring(text, b + 1, F.greatest(e - b, F.lit(0))))
    return F.array_join(kept, "")


def formulas(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, formula_no (from 1, over the document), latex: the $$ ... $$ blocks."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"(?s)\$\$(.+?)\$\$"), F.lit(1))
    return docs.select(key, F.posexplode(found).alias("_i", "latex")).select(key, (F.col("_i") + 1).alias("formula_no"), F.trim("latex").alias("latex"))


def html_tables(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, table_no (from 1), html: each <table> element without nested ones."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"(?is)(<table\b.*?</table>)"), F.lit(1))
    return docs.select(key, F.posexplode(found).alias("_i", "html")).select(key, (F.col("_i") + 1).alias("table_no"), "html")


def image_groups(lines: DataFrame, key: str) -> DataFrame:
    """key, group_no, paths, caption: images on adjacent lines (blank ones between do not count) as one group, with
    the first line of the 8 after it that names a figure."""
    image = F.regexp_extract("line", r"^\s*!\[[^\]]*\]\(([^)]+)\)\s*$", 1)
    rows = lines.where(F.trim("line") != "").withColumn("path", image).withColumn("row", F.row_number().over(Window.partitionBy(key).orderBy("pos")))
    w = Window.partitionBy(key).orderBy("row")
    new = (F.col("path") != "") & F.coalesce(F.lag("path").over(w) == "", F.lit(True))
    named = F.first(F.when((F.col("path") == "") & F.col("line").rlike(r"(?i)图|fig"), F.col("line")), ignorenulls=True).over(w.rowsBetween(1, 8))
    marked = islands(rows.withColumn("_new", new).withColumn("_caption", named), [key], "row", F.col("_new"))
    return marked.where("path <> ''").groupBy(key, F.col("island").alias("group_no")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("row", "path"))), lambda x: x["path"]).alias("paths"),
        F.max_by("_caption", "row").alias("caption"),
    )


def strip_spans_from(docs: DataFrame, key: str, text: str, spans: DataFrame) -> DataFrame:
    """key and text with the (merged) spans of each document cut out; documents without spans stay as they are."""
    merged = merge_spans(spans, [key], "start", "end").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    return docs.join(merged, key, "left").select(key, F.when(F.col("_spans").isNull(), F.col(text)).otherwise(remove_spans(F.col(text), F.col("_spans"))).alias(text))


def latex_text(latex: Column, raw: Column, content: Column) -> Column:
    """The first of latex, raw (without $$) and content that is not blank, white space collapsed."""
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"\$\$?", ""), r"\s+", " "))
    pick = lambda c: F.when(plain(c) != "", plain(c))
    return F.coalesce(pick(latex), pick(raw), pick(content), F.lit(""))


def symbol_notes(notes: Column) -> Column:
    """A map of symbol to struct(meaning, unit) from `symbol — meaning, unit` notes divided by ; or line ends."""
    items = F.filter(F.transform(F.split(notes, "[;；\n]"), lambda x: F.trim(x)), lambda x: x.rlike(r"\S+\s*[—–-]+\s*\S"))
    entry = lambda x: F.struct(
        F.trim(F.regexp_extract(x, r"^(.*?)\s*[—–-]+", 1)).alias("key"),
        F.struct(
            F.trim(F.regexp_extract(x, r"[—–-]+\s*(.*?)(?:[,，]\s*[^,，]{1,30})?$", 1)).alias("meaning"),
            F.trim(F.regexp_extract(x, r"[—–-]+.*[,，]\s*([^,，]{1,30})$", 1)).alias("unit"),
        ).alias("value"),
    )
    return F.map_from_entries(F.transform(items, entry))


def symbols(latex: Column) -> Column:
    """Distinct symbols of a formula, shortest first: subscripted, Greek commands, capitals, operands in small letters."""
    take = lambda p: F.regexp_extract_all(latex, F.lit(p), F.lit(1))
    noise = ["\\frac", "\\left", "\\right", "\\times", "\\cdot", "\\sum", "\\int", "\\sqrt", "\\text", "\\mathrm", "\\quad", "\\begin", "\\end", "\\ln", "\\log", "\\exp"]
    found = F.concat(
        take(r"([A-Za-z]_\{?[A-Za-z0-9]+\}?)"), take(r"(\\[a-zA-Z]+)"), take(r"(?<![A-Za-z\\_{])([A-Z])(?![A-Za-z_])"),
        take(r"(?:^|[=+\-*/(\s])([a-hl-z])(?=$|[=+\-*/)\s^])"),
    )
    kept = F.filter(F.array_distinct(found), lambda x: ~x.isin(noise))
    return F.transform(F.array_sort(F.transform(kept, lambda x: F.struct(F.char_length(x).alias("n"), x.alias("s")))), lambda x: x["s"])
