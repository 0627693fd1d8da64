"""Scalar expressions: ids, clamps, scores, text normalising, intervals and boxes. Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings that stand for a missing name (fixed values).
NULL_NAMES = ["", "none", "null", "nan", "n/a", "unknown", "-", "--"]
FULL_WIDTH = "０１２３４５６７８９．－＋"
HALF_WIDTH = "0123456789.-+"


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def stable_id(prefix: str, *parts, length: int = 20) -> Column:
    """prefix_ and the first hex digits of the SHA-1 of the stripped, lower-case parts joined by |.

    A null part counts as the empty string; so does a numeric 0, as ids must stay equal to those already issued.
    """
    texts = []
    for p in parts:
        text = F.coalesce(_c(p).cast("string"), F.lit(""))
        texts.append(F.lower(F.regexp_replace(text, r"(?U)^\s+|\s+$", "")))
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha1(F.concat_ws("|", *texts).cast("binary")), 1, length))


def falsy_to_empty(number) -> Column:
    """A number as text, with 0 and null as the empty string."""
    n = _c(number)
    return F.when(n.isNull() | (n == 0), F.lit("")).otherwise(n.cast("string"))


def slug(text, most: int = 48) -> Column:
    cleaned = F.regexp_replace(F.lower(_c(text)), r"[^0-9a-z一-鿿]+", "_")
    return F.substring(F.regexp_replace(cleaned, "^_+|_+$", ""), 1, most)


def image_id(image, kind, local) -> Column:
    """A slug of the local name with ten digits of the SHA-1 of image|kind|local."""
    digest = F.sha1(F.concat_ws("|", _c(image), _c(kind), _c(local)).cast("binary"))
    return F.concat_ws("_", _c(kind), slug(local), F.substring(digest, 1, 10))


def short_token(*parts, length: int = 16) -> Column:
    return F.substring(F.sha1(F.concat_ws("\u001f", *[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts]).cast("binary")), 1, length)


def safe_name(text, most: int = 80) -> Column:
    """A file name: other characters become _, at most `most`, then a short hash of the whole text."""
    return F.concat_ws("_", F.substring(F.regexp_replace(_c(text), r"[^0-9A-Za-z._-]+", "_"), 1, most), short_token(text, length=8))


def clamp_confidence(value, default: float = 0.7, digits: int = 3) -> Column:
    """A number between 0 and 1, half-even to `digits`; what is no number is the default."""
    number = F.coalesce(_c(value).try_cast("double"), F.lit(default))
    return F.bround(F.least(F.lit(1.0), F.greatest(F.lit(0.0), number)), digits)


def collapse_space(text) -> Column:
    return F.trim(F.regexp_replace(_c(text), r"(?U)\s+", " "))


def strip_markup(text) -> Column:
    """Without Markdown marks, links as their labels, white space collapsed."""
    plain = F.regexp_replace(_c(text), r"!?\[([^\]]*)\]\([^)]*\)", "$1")
    return collapse_space(F.regexp_replace(plain, r"[*_`#>]+", " "))


def clean_name(text) -> Column:
    t = F.trim(_c(text))
    return F.when(F.lower(t).isin(NULL_NAMES) | t.isNull(), F.lit("")).otherwise(t)


def head(text, most: int, mark: str = "……") -> Column:
    t = _c(text)
    return F.when(F.char_length(t) > most, F.concat(F.substring(t, 1, most), F.lit(mark))).otherwise(t)


def tail(text, most: int) -> Column:
    return F.right(_c(text), F.lit(most))


def weighted_score(vector, lexical, schema_key, weights: tuple[float, float, float] = (0.5, 0.25, 0.25)) -> Column:
    """The weighted mean of the three scores; the third one's weight counts only where that score is over 0."""
    v, x, s = (F.coalesce(_c(c), F.lit(0.0)) for c in (vector, lexical, schema_key))
    active = F.when(s > 0, F.lit(sum(weights))).otherwise(F.lit(weights[0] + weights[1]))
    return (v * weights[0] + x * weights[1] + F.when(s > 0, s * weights[2]).otherwise(F.lit(0.0))) / active


def jaccard(a, b) -> Column:
    """Shared over all distinct elements; 0 if either array is empty."""
    x, y = _c(a), _c(b)
    union = F.size(F.array_union(x, y))
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / union).otherwise(F.lit(0.0))


def lexical_score(text, name, examples, aliases, overlap, term_hits) -> Column:
    """The largest of: name in the text 1.0, an example .9, an alias .9, token overlap of .34 or more, term hits."""
    t = _c(text)
    inside = lambda xs: F.exists(_c(xs), lambda x: (F.length(x) > 0) & F.contains(t, x))
    zero = F.lit(0.0)
    return F.greatest(
        F.when((F.length(_c(name)) > 0) & F.contains(t, _c(name)), F.lit(1.0)).otherwise(zero),
        F.when(inside(examples), F.lit(0.9)).otherwise(zero),
        F.when(inside(aliases), F.lit(0.9)).otherwise(zero),
        F.when(_c(overlap) >= 0.34, F.least(F.lit(0.85), 0.35 + 0.5 * _c(overlap))).otherwise(zero),
        F.when(_c(term_hits) > 0, F.least(F.lit(0.85), 0.45 + 0.1 * _c(term_hits))).otherwise(zero),
    )


def schema_key_score(keys, name) -> Column:
    """1.0 for the name among the keys, .9 for a part of it between slashes, .75 for containment either way."""
    ks, n = _c(keys), _c(name)
    parts = F.filter(F.transform(F.split(n, "/"), lambda x: F.trim(x)), lambda x: x != "")
    return (
        F.when(F.array_contains(ks, n), F.lit(1.0))
        .when(F.arrays_overlap(ks, parts), F.lit(0.9))
        .when(F.exists(ks, lambda k: (F.length(k) > 0) & (F.contains(n, k) | F.contains(k, n))), F.lit(0.75))
        .otherwise(F.lit(0.0))
    )


def keyword_type(text, rules: list[tuple[str, str]], default: str = "Unknown") -> Column:
    """The type of the first (keyword, type) rule whose keyword the text contains."""
    out = None
    for word, kind in rules:
        hit = F.contains(_c(text), F.lit(word))
        out = F.when(hit, F.lit(kind)) if out is None else out.when(hit, F.lit(kind))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def value_at(slope, intercept, y) -> Column:
    return _c(slope) * _c(y) + _c(intercept)


def overlap_ratio(top_a, bottom_a, top_b, bottom_b) -> Column:
    """Shared length over the shorter of two intervals, between 0 and 1; 0 for an empty interval."""
    shared = F.least(_c(bottom_a), _c(bottom_b)) - F.greatest(_c(top_a), _c(top_b))
    span = F.least(_c(bottom_a) - _c(top_a), _c(bottom_b) - _c(top_b))
    return F.when(span > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), shared / span))).otherwise(F.lit(0.0))


def box_area(box) -> Column:
    b = _c(box)
    return F.greatest(b[2] - b[0], F.lit(0)) * F.greatest(b[3] - b[1], F.lit(0))


def box_centre(box) -> Column:
    b = _c(box)
    return F.struct(((b[0] + b[2]) / 2.0).alias("x"), ((b[1] + b[3]) / 2.0).alias("y"))


def box_contained(inner, outer) -> Column:
    """The share of the inner box's area that lies in the outer one."""
    a, b = _c(inner), _c(outer)
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0))
    return F.when(box_area(box=inner) > 0, w * h / box_area(box=inner)).otherwise(F.lit(0.0))


def clip_box(box, width: float = 1000, height: float = 1000) -> Column:
    """Four numbers clipped to the frame; an empty array where the box is malformed, empty or inverted."""
    b = _c(box)
    clip = lambda v, most: F.least(F.lit(float(most)), F.greatest(F.lit(0.0), v.cast("double")))
    c = F.array(clip(b[0], width), clip(b[1], height), clip(b[2], width), clip(b[3], height))
    good = (F.size(b) == 4) & ~F.exists(b, lambda v: v.isNull())
    empty = F.array().cast("array<double>")
    return F.when(good, F.when((c[2] > c[0]) & (c[3] > c[1]), c).otherwise(empty)).otherwise(empty)


def full_width_number(text) -> Column:
    """A strict number, full-width digits allowed, with an optional trailing m."""
    t = F.trim(F.translate(_c(text), FULL_WIDTH, HALF_WIDTH))
    return F.regexp_extract(t, r"^([-+]?\d+(?:\.\d+)?)\s*(?:m|米)?$", 1).try_cast("double")


def query_text(parts: list[tuple[str, object]], most: int = 4000) -> Column:
    """Labelled lines of the parts that are not empty, cut at `most` characters."""
    lines = [F.when(F.length(F.trim(_c(c))) > 0, F.concat(F.lit(f"{label}: "), F.trim(_c(c)))) for label, c in parts]
    return F.substring(F.concat_ws("\n", *lines), 1, most)


def data_url(mime, content) -> Column:
    """A data URL of binary content."""
    return F.concat(F.lit("data:"), _c(mime), F.lit(";base64,"), F.base64(_c(content)))


def path_key(path) -> Column:
    return F.lower(F.replace(_c(path), F.lit("/"), F.lit("\\")))


def cosine(a, b) -> Column:
    """Cosine similarity of two arrays of numbers; 0.0 for empty ones, unequal lengths and zero norms."""
    x, y = _c(a), _c(b)
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda i, j: i.cast("double") * j.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    return F.when((F.size(x) > 0) & (F.size(x) == F.size(y)) & (norm > 0), dot(x, y) / norm).otherwise(F.lit(0.0))


def symbol_kind(symbol) -> Column:
    """constant, Greek parameter, subscripted variable, upper-case parameter or variable."""
    s = _c(symbol)
    return (
        F.when(s.isin("e", "\\pi", "pi"), F.lit("constant"))
        .when(s.rlike(r"^\\[a-zA-Z]+$"), F.lit("greek_parameter"))
        .when(F.contains(s, F.lit("_")), F.lit("subscript_variable"))
        .when(s.rlike("^[A-Z]$"), F.lit("parameter"))
        .otherwise(F.lit("variable"))
    )


def parse_flag(text) -> Column:
    t = F.lower(F.trim(_c(text)))
    return F.when(t.isin("1", "true", "yes", "y", "on"), F.lit(True)).when(t.isin("0", "false", "no", "n", "off"), F.lit(False))


def without_thinking(text) -> Column:
    return F.trim(F.regexp_replace(_c(text), r"(?is)<think>.*?</think>", ""))


def json_fragment(text) -> Column:
    """The text from its first { or [ to its last } or ], without code fences; null if there is none."""
    plain = F.regexp_replace(_c(text), r"```(?:json)?", "")
    cut = F.regexp_extract(plain, r"(?s)([\{\[].*[\}\]])", 1)
    return F.when(cut != "", cut)
