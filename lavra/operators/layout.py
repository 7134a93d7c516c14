"""Words with places on a page to lines, paragraphs and bands. One page is one group; no group grows with the corpus."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a page by the height of a line's middle, from the top; each begins at its number.
BANDS = {
    "coarse": (("header", 0.85), ("subheader", 0.70), ("body", 0.15), ("footer", -1.0)),
    "five": (("top", 0.85), ("upper", 0.78), ("middle", 0.55), ("lower", 0.30), ("bottom", -1.0)),
    "seven": (("b1", 0.88), ("b2", 0.80), ("b3", 0.65), ("b4", 0.50), ("b5", 0.35), ("b6", 0.20), ("footer", -1.0)),
}


def band(y: Column | str, scheme: str = "coarse") -> Column:
    y = F.col(y) if isinstance(y, str) else y
    out = F.lit(None).cast("string")
    for name, low in reversed(BANDS[scheme]):
        out = F.when(y >= low, F.lit(name)).otherwise(out)
    return out


def distinct_words(words: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Words printed twice at one place, to three decimals, kept once: the first in order.

    Words are brought together by page once; lines and paragraphs made of the result need no other shuffle.
    """
    at = [F.bround(c, 3) for c in ("x0", "y0", "x1", "y1")]
    w = Window.partitionBy(*keys, "text", *at).orderBy(order)
    return words.repartition(*keys).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def chained_lines(words: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """A word joins the line of the word above it if their middles are within ``tolerance``: ``line_no`` from the top."""
    middle = (F.col("y0") + F.col("y1")) / 2
    w = Window.partitionBy(*keys).orderBy(middle.desc(), "x0")
    new = F.when(F.lag(middle).over(w).isNull() | (F.lag(middle).over(w) - middle > tolerance), 1).otherwise(0)
    return words.withColumn("_new", new).withColumn("line_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def greedy_lines(words: DataFrame, keys: list[str], tolerance: float, against: str = "first") -> DataFrame:
    """As :func:`chained_lines`, but a word is held against the line's ``first`` word, its running ``mean`` or any ``bucket`` opened before."""

    def run(page: pd.DataFrame) -> pd.DataFrame:
        page = page.assign(_m=(page["y0"] + page["y1"]) / 2).sort_values(["_m", "x0"], ascending=[False, True], kind="stable")
        lines: list[list[float]] = []
        number = []
        for m in page["_m"]:
            hit = next((i for i in (range(len(lines)) if against == "bucket" else range(max(0, len(lines) - 1), len(lines))) if abs(lines[i][0] - m) <= tolerance), None)
            if hit is None:
                lines.append([m, 1])
                hit = len(lines) - 1
            elif against == "mean":
                mean, n = lines[hit]
                lines[hit] = [(mean * n + m) / (n + 1), n + 1]
            number.append(hit + 1)
        return page.drop(columns="_m").assign(line_no=number)

    return words.groupBy(*keys).applyInPandas(run, ", ".join(f"{n} {t}" for n, t in words.dtypes) + ", line_no int")


def line_text(words: DataFrame, keys: list[str], gap: float = 0.012) -> DataFrame:
    """Lines with their text: words closer than the gap are joined without a space.

    With four or more words and gaps the gap is .3 of the lower 90 % quantile of the line's positive gaps, within [.001, gap].
    """
    each = F.sort_array(F.collect_list(F.struct("x0", "x1", "text", "y0", "y1")))
    lines = words.groupBy(*keys, "line_no").agg(each.alias("w"))
    spaces = F.transform(F.sequence(F.lit(2), F.greatest(F.size("w"), F.lit(2))), lambda i: F.coalesce(F.get("w", i - 1)["x0"] - F.get("w", i - 2)["x1"], F.lit(0.0)))
    positive = F.sort_array(F.filter(spaces, lambda g: g > 0))
    p90 = F.get(positive, F.floor(0.9 * (F.size(positive) - 1)).cast("int"))
    limit = F.when((F.size("w") >= 4) & (F.size(positive) >= 4), F.least(F.greatest(p90 * 0.3, F.lit(0.001)), F.lit(gap))).otherwise(gap)
    lines = lines.withColumn("_limit", limit)
    text = F.aggregate("w", F.struct(F.lit("").alias("t"), F.lit(None).cast("double").alias("x")), lambda a, v: F.struct(F.concat(a["t"], F.when(a["x"].isNotNull() & (v["x0"] - a["x"] > F.col("_limit")), " ").otherwise(""), v["text"]).alias("t"), v["x1"].cast("double").alias("x")), lambda a: a["t"])
    box = {"x0": F.array_min(F.transform("w", lambda v: v["x0"])), "x1": F.array_max(F.transform("w", lambda v: v["x1"])), "y0": F.array_min(F.transform("w", lambda v: v["y0"])), "y1": F.array_max(F.transform("w", lambda v: v["y1"]))}
    return lines.select(*keys, "line_no", text.alias("text"), *(F.greatest(F.least(c, F.lit(1.0)), F.lit(0.0)).alias(n) for n, c in box.items()))


def paragraphs(lines: DataFrame, keys: list[str], gap: float = 0.03) -> DataFrame:
    """Lines to paragraphs: a new one begins where the space above a line exceeds ``gap``."""
    w = Window.partitionBy(*keys).orderBy(F.col("y1").desc(), "line_no")
    low = F.min("y0").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(low.isNull() | (low - F.col("y1") > gap), 1).otherwise(0)
    numbered = lines.withColumn("_new", new).withColumn("paragraph_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    texts = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("y1")).alias("y"), "line_no", "text"))), lambda s: s["text"]), "\n")
    return numbered.groupBy(*keys, "paragraph_no").agg(texts.alias("text"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))


def align_value(words: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """Where a value stands among the ordered words of a page: first position of its tokens in a row, by an equality join.

    ``words``: keys, ``pos``, ``text``; ``values``: keys, ``value``. Comparison ignores case and outer punctuation.
    """
    clean = lambda c: F.regexp_replace(F.lower(c), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    tokens = values.withColumn("_t", F.filter(F.split("value", r"\s+"), lambda t: t != "")).where(F.size("_t") > 0).select(*keys, "value", F.size("_t").alias("_n"), F.posexplode("_t").alias("_i", "_w"))
    met = tokens.withColumn("_w", clean(F.col("_w"))).join(words.withColumn("_w", clean(F.col("text"))), [*keys, "_w"]).withColumn("first_pos", F.col("pos") - F.col("_i"))
    whole = met.groupBy(*keys, "value", "_n", "first_pos").agg(F.count("*").alias("hit")).where("hit = _n")
    return whole.groupBy(*keys, "value").agg(F.min("first_pos").alias("first_pos"))


def _line_words(words: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """A row for each line with its words from left to right, ``_w``, and the medians of their width a character, ``_char``."""
    each = F.sort_array(F.collect_list(F.struct("x0", "x1", "text", *more)))
    lines = words.groupBy(*keys, "line_no").agg(each.alias("_w"))
    width = F.filter(F.transform("_w", lambda w: F.when(F.length(w["text"]) > 0, (w["x1"] - w["x0"]) / F.length(w["text"]))), lambda v: v > 0)
    sorted_width, n = F.sort_array(width), F.size(width)
    median = (F.get(sorted_width, ((n - 1) / 2).cast("int")) + F.get(sorted_width, (n / 2).cast("int"))) / 2
    mean = F.aggregate("_w", F.lit(0.0), lambda a, w: a + (w["x1"] - w["x0"])) / F.size("_w")
    singles = F.size(F.filter("_w", lambda w: F.length(F.trim(w["text"])) == 1)) / F.size("_w")
    gaps = F.transform(F.sequence(F.lit(1), F.greatest(F.size("_w") - 1, F.lit(1))), lambda i: F.coalesce(F.get("_w", i)["x0"] - F.get("_w", i - 1)["x1"], F.lit(0.0)))
    return lines.withColumns({"_char": F.when(n > 0, median).otherwise(mean), "_mean": mean, "_singles": singles, "_gaps": F.sort_array(F.filter(gaps, lambda g: g > 0))})


def _text_with(spaces) -> Column:
    """The words of a line one after another, with as many spaces before each as ``spaces(gap)`` says."""
    start = F.struct(F.lit("").alias("t"), F.lit(None).cast("double").alias("x"))
    step = lambda a, w: F.struct(F.concat(a["t"], F.when(a["x"].isNotNull(), F.repeat(F.lit(" "), spaces(w["x0"] - a["x"]).cast("int"))).otherwise(""), w["text"]).alias("t"), w["x1"].cast("double").alias("x"))
    return F.aggregate("_w", start, step, lambda a: a["t"])


def text_by_gap_ratio(words: DataFrame, keys: list[str]) -> DataFrame:
    """Lines whose words are parted where the gaps, in order of size, grow most (by 1.6 or more).

    Without such a leap the threshold is .8 of a character's median width, 2.2 where most words are single letters.
    """
    lines = _line_words(words, keys)
    g = F.col("_gaps")
    leaps = F.transform(F.sequence(F.lit(1), F.greatest(F.size(g) - 1, F.lit(1))), lambda i: F.struct((F.get(g, i) / F.get(g, i - 1)).alias("r"), (-i).alias("i"), ((F.get(g, i - 1) + F.get(g, i)) / 2).alias("m")))
    top = F.array_max(F.filter(leaps, lambda x: x["r"].isNotNull()))
    limit = F.when(top["r"] >= 1.6, top["m"]).otherwise(F.col("_char") * F.when(F.col("_singles") > 0.5, 2.2).otherwise(0.8))
    lines = lines.withColumn("_limit", limit)
    return lines.select(*keys, "line_no", F.trim(_text_with(lambda gap: F.when(gap > F.col("_limit"), 1).otherwise(0))).alias("text"))


#: Rows of a batch whose lines are worked on at once.
ROWS_AT_ONCE = 1000
_SPACES = pa.array([" " * n for n in range(41)])


def text_by_metrics(words: DataFrame, keys: list[str]) -> DataFrame:
    """Lines with as many spaces (1 to 40) as characters fit into a gap.

    Where 60 % or more of the words are single letters, only gaps of four times the median gap (.02 to 1.2 characters) are spaces.
    """
    lines = words.groupBy(*keys, "line_no").agg(F.sort_array(F.collect_list(F.struct("x0", "x1", "text"))).alias("_w"))
    lines = lines.select(*keys, "line_no", F.transform("_w", lambda w: F.struct(w["x0"].cast("double").alias("x0"), w["x1"].cast("double").alias("x1"), w["text"].cast("string").alias("text"))).alias("_w"))

    def read(batch: pa.RecordBatch) -> tuple:
        w = batch.column("_w")
        x0, x1, text = w.flatten().flatten()
        return np.arange(len(w)), batch.column("line_no"), w.value_lengths().to_numpy(), x0.to_numpy(zero_copy_only=False), x1.to_numpy(zero_copy_only=False), text

    return read_by_metrics(lines, keys, read, dict(lines.dtypes)["line_no"])


def read_by_metrics(rows: DataFrame, keys: list[str], read: Callable, number: str = "int") -> DataFrame:
    """As :func:`text_by_metrics` where each row has its lines whole: they are read where the row is, and no word is shuffled.

    ``read`` takes a batch of rows; it returns, for each line, its row in the batch, its number (of type ``number``) and its words, which aren't
    none; then, for the words of all lines from left to right, ``x0``, ``x1`` (NaN if null) and the texts.
    """
    from lavra.functions.text import unspaced

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(k, ROWS_AT_ONCE)
                at, line_no, counts, x0, x1, text = read(part)
                texts, singles = _metric_texts(counts, x0, x1, text)
                columns = [*(part.column(c).take(pa.array(at)) for c in keys), line_no, texts, pa.array(singles)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keys, "line_no", "text", "_singles"])

    types = dict(rows.dtypes)
    lines = rows.mapInArrow(run, ", ".join([*(f"`{k}` {types[k]}" for k in keys), f"line_no {number}", "text string", "_singles boolean"]))
    return lines.withColumn("text", F.when(F.col("_singles"), unspaced("text")).otherwise(F.col("text"))).where("text <> ''").select(*keys, "line_no", "text")


def _sorted_by_line(line: np.ndarray, values: np.ndarray, lines: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of each line in order; where each line's begin, and how many there are."""
    n = np.bincount(line, minlength=lines)
    return values[np.lexsort((values, line.astype("uint16") if lines <= 1 << 16 else line))], np.cumsum(n) - n, n


def _metric_texts(counts: np.ndarray, x0: np.ndarray, x1: np.ndarray, text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Text of each line, and whether 60 % or more of its words are single letters."""
    ends = np.cumsum(counts, dtype="int64")
    line = np.repeat(np.arange(len(counts)), counts)
    length = pc.fill_null(pc.utf8_length(text), 0).to_numpy(zero_copy_only=False)
    with np.errstate(all="ignore"):
        width = (x1 - x0) / length
    some = (length > 0) & (width > 0)
    v, at, n = _sorted_by_line(line[some], width[some], len(counts))
    has, char = n > 0, np.bincount(line, weights=x1 - x0, minlength=len(counts)) / counts
    char[has] = (v[(at + (n - 1) // 2)[has]] + v[(at + n // 2)[has]]) / 2
    char[~(char > 0)] = 1.0
    gap = np.zeros(len(line))
    gap[1:] = x0[1:] - x1[:-1]
    gap[ends - counts] = 0
    single = pc.fill_null(pc.equal(pc.utf8_length(pc.utf8_trim(text, characters=" ")), 1), False).to_numpy(zero_copy_only=False)
    singles = np.bincount(line[single], minlength=len(counts)) / counts >= 0.6
    least = np.zeros(len(counts))
    if (some := singles[line] & (gap > 0)).any():
        v, at, n = _sorted_by_line(line[some], gap[some], len(counts))
        spaced = singles & (counts > 2) & (n > 0)
        least[spaced] = np.clip(v[(at + n // 2)[spaced]] / char[spaced] * 4, 0.02, 1.2) * char[spaced]
    spaces = np.zeros(len(line), "int8")
    some = (gap > 0) & (gap >= least[line])
    spaces[some] = np.clip(np.rint(gap[some] / char[line[some]]), 1, 40)
    words = pc.binary_join_element_wise(_SPACES.take(pa.array(spaces)), text, "")
    lines = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), words)
    return pc.utf8_rtrim(pc.binary_join(lines, ""), characters=" "), singles


def text_by_width(words: DataFrame, keys: list[str], factor: float = 0.6) -> DataFrame:
    """Lines with a space for each ``factor`` of a word's mean width in a gap above a fifth of it, one at least."""
    lines = _line_words(words, keys)
    spaces = lambda gap: F.when(gap > F.col("_mean") * 0.2, F.greatest(F.lit(1), F.floor(gap / (F.col("_mean") * factor)))).otherwise(0)
    return lines.select(*keys, "line_no", _text_with(spaces).alias("text"))


#: Parts of a page that hold a template's fields: lower and upper edge.
REGIONS = {"top": (0.55, 1.0), "bottom": (0.0, 0.45)}


def regions(words: DataFrame, ranges: DataFrame, key: str, page: str = "page") -> DataFrame:
    """Words of the regions of each range of pages, with ``region``: top of the first page, bottom of the last, second and last but one.

    ``ranges``: key, ``doc_no, start_page, end_page``. A word belongs to a region it overlaps; a page can be in several.
    """
    s, e = F.col("start_page"), F.col("end_page")
    places = F.array_compact(F.array(
        F.struct(F.lit("first_top").alias("region"), s.alias("at"), F.lit("top").alias("part")), F.struct(F.lit("last_bottom").alias("region"), e.alias("at"), F.lit("bottom").alias("part")),
        F.when(e - s >= 2, F.struct(F.lit("second_bottom").alias("region"), (s + 1).alias("at"), F.lit("bottom").alias("part"))),
        F.when(e > s, F.struct(F.lit("last_bottom_prev").alias("region"), (e - 1).alias("at"), F.lit("bottom").alias("part"))),
    ))
    each = ranges.select(key, "doc_no", F.explode(places).alias("p")).select(key, "doc_no", "p.region", F.col("p.at").alias(page), "p.part")
    inside = F.lit(False)
    for part, (low, high) in REGIONS.items():
        inside = inside | ((F.col("part") == part) & (F.col("y1") >= low) & (F.col("y0") <= high))
    return words.join(each, [key, page]).where(inside).drop("part")


def fill_percentage(lines: DataFrame, keys: list[str], page: str = "page") -> DataFrame:
    """``keys, filled``: the letters and figures of a document as a percentage of what its lines, and the blank ones between them, could hold."""
    from lavra.functions.clean import solid_chars

    rows = lines.withColumn("_n", solid_chars("text")).where("_n > 0").withColumn("_h", F.greatest(F.col("y1") - F.col("y0"), F.lit(0.0))).withColumn("_wd", F.greatest(F.col("x1") - F.col("x0"), F.lit(0.0)))
    p = Window.partitionBy(*keys, page)
    rows = rows.withColumn("_below", F.lead("y1").over(p.orderBy(F.desc("y1"), "line_no")))
    heights = F.sort_array(F.filter(F.collect_list("_h"), lambda h: h > 0))
    a = rows.groupBy(*keys, page).agg(heights.alias("_hs"), F.collect_list(F.col("y0") - F.col("_below")).alias("_gaps"), F.sum("_n").alias("_chars"), F.count("*").alias("_lines"), F.max("_wd").alias("_widest"), F.avg(F.when(F.col("_wd") > 0, F.col("_wd") / F.col("_n"))).alias("_char"))
    h = F.get("_hs", F.floor(F.size("_hs") / 2).cast("int"))
    a = a.withColumn("_h", h)
    blank = F.aggregate("_gaps", F.lit(0.0), lambda s, g: s + F.when(g > F.col("_h"), F.greatest(F.bround(g / F.col("_h"), 0) - 1, F.lit(0.0))).otherwise(0.0))
    slots = F.col("_lines") + F.when(F.col("_h") > 0, blank).otherwise(0.0)
    room = F.when((F.col("_char") > 0) & (F.col("_widest") > 0), F.col("_widest") / F.col("_char")).otherwise(0.0) * slots
    return a.withColumn("_room", room).groupBy(*keys).agg(F.sum("_chars").alias("_c"), F.sum("_room").alias("_r")).select(*keys, F.when(F.col("_r") > 0, F.round(F.col("_c") * 100 / F.col("_r"), 4)).otherwise(0.0).alias("filled"))


def density(words: DataFrame, keys: list[str], area: float = 1.0) -> DataFrame:
    """``keys, density``: the area of a page's words over the page's."""
    w = F.greatest((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")), F.lit(0.0))
    return words.groupBy(*keys).agg((F.sum(w) / max(area, 1.0)).alias("density"))


def first_and_last(paragraphs: DataFrame, keys: list[str], page: str = "page") -> DataFrame:
    """``keys, first_paragraph, last_paragraph`` by page and then from the top."""
    at = F.struct(F.col(page), -F.col("y0"))
    return paragraphs.groupBy(*keys).agg(F.min_by("text", at).alias("first_paragraph"), F.max_by("text", at).alias("last_paragraph"))


def margin_text(lines: DataFrame, keys: list[str], share: float = 0.1) -> DataFrame:
    """``keys, header, footer``: the lines in the top and bottom share of a page from the top; without any below, the last three that aren't blank."""
    y, low = F.col("y0"), lambda cond: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(cond & (F.trim("text") != ""), F.struct((-F.col("y0")).alias("y"), "line_no", "text")))), lambda s: s["text"]), "\n")
    all_lines = F.transform(F.sort_array(F.collect_list(F.when(F.trim("text") != "", F.struct((-F.col("y0")).alias("y"), "line_no", "text")))), lambda s: s["text"])
    last = F.array_join(F.slice(all_lines, F.greatest(F.size(all_lines) - 2, F.lit(1)), 3), "\n")
    a = lines.groupBy(*keys).agg(low(y >= 1 - share).alias("header"), low(y <= share).alias("_f"), last.alias("_last"))
    return a.select(*keys, "header", F.when(F.col("_f") != "", F.col("_f")).otherwise(F.col("_last")).alias("footer"))
