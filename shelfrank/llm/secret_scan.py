"""Secret scan: fixed formats, and sliding-window Shannon entropy per character class over candidate strings.

Everything here is a DataFrame expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import numbered, pick, whole

# Formats of known kinds.  Letters of the names are listed in both cases, so that no Unicode case rule applies.
ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"
    r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
SCALE = 1_000_000
#: Character class -> its alphabet and the least entropy, in bits per character, of a window that counts as random.
CLASSES = {
    "hex": ("0123456789abcdefABCDEF", 3.0),
    "token": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 3.75),
}
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: Candidates that are never secrets: words and numbers with separators, UUIDs, filler and alphabet runs.
ALLOWED = (
    r"^[A-Za-z+/_-]+$",
    r"^[0-9+/_-]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?:[A-Za-z]{2,}[+/_-][0-9]{1,8}[+/_-]){2}",
    r"[Ee]xample|EXAMPLE|[Pp]laceholder|PLACEHOLDER|01234567|12345678|abcdefgh|ABCDEFGH|[xX]{6}",
)
PLACEHOLDER = "[SECRET]"
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their start and end in code points.

    The pieces between the matches, from ``split``, give the positions that ``regexp_extract_all`` leaves out.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda piece: F.length(piece))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(values)).alias("gap"), values.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("found"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + pair["gap"]
        end = begin + F.length(pair["value"])
        found = F.struct(begin.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(found)).alias("found"))

    return F.aggregate(pairs, start, step, lambda state: state["found"])


def _spans(found: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end")))


def _if(condition: Column, spans: Column) -> Column:
    """The spans where the text can have any: the cheap test spares all other texts the costly expressions."""
    return F.coalesce(F.when(condition, spans), F.array().cast(SPAN))


def _base_spans(text: Column) -> dict[str, Column]:
    assigned = F.filter(_located(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 2)) >= 8)
    long_access = F.filter(_located(text, ACCESS), lambda m: F.length(m["value"]) >= 16)
    may_assign = (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & text.rlike(ASSIGN)
    return {
        "assign": _if(may_assign, _spans(assigned, "assign")),
        "access": _if(F.contains(text, F.lit("AKIA")), _spans(long_access, "access")),
        "hex": _if(text.rlike(HEX), _spans(_located(text, HEX), "hex")),
    }


def _weight(count: Column) -> Column:
    """count * log2(count), scaled to an integer; looked up, as a count never exceeds the window."""
    table = F.array(*[F.lit(round(c * math.log2(c) * SCALE) if c else 0) for c in range(WINDOW + 1)])
    return F.get(table, count)


def smallest_weight(candidate: Column, alphabet: str) -> Column:
    """The least sum of count * log2(count) over all windows of the candidate; null if no window lies inside the alphabet.

    One pass: a window step takes one character out of the counts and one in, and the sum changes by these two only.
    Entropy is log2(window) minus the sum divided by the window, so the least sum is the largest entropy.
    """
    letters = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    runs = F.arrays_zip(
        letters.alias("come"),
        F.concat(F.array_repeat(F.lit(-2), WINDOW), letters).alias("go"),
    )
    zero = F.array_repeat(F.lit(0), len(alphabet))
    start = F.struct(zero.alias("counts"), F.lit(0).alias("sum"), F.lit(None).cast("int").alias("least"), F.lit(0).alias("inside"))

    def step(state: Column, pair: Column) -> Column:
        come, go = pair["come"], pair["go"]
        inside = F.when(come >= 0, F.least(state["inside"] + 1, F.lit(WINDOW))).otherwise(0)
        counts = state["counts"]
        gone = F.when(go >= 0, F.get(counts, go))
        after_go = state["sum"] - F.coalesce(_weight(gone) - _weight(gone - 1), F.lit(0))
        before = F.when(come >= 0, F.get(counts, come) - F.when(go == come, 1).otherwise(0))
        total = after_go + F.coalesce(_weight(before + 1) - _weight(before), F.lit(0))
        moved = F.transform(
            counts, lambda c, i: c + F.when(i == come, 1).otherwise(0) - F.when(i == go, 1).otherwise(0)
        )
        least = F.when(inside == WINDOW, F.least(state["least"], total)).otherwise(state["least"])
        return F.struct(moved.alias("counts"), total.alias("sum"), least.alias("least"), inside.alias("inside"))

    steps = F.slice(runs, F.lit(1), F.size(letters))
    return F.aggregate(steps, start, step, lambda state: state["least"])


def _looks_random(candidate: Column) -> Column:
    tests = []
    for alphabet, bits in CLASSES.values():
        limit = math.floor(WINDOW * (math.log2(WINDOW) - bits) * SCALE)
        tests.append(F.coalesce(smallest_weight(candidate, alphabet) <= limit, F.lit(False)))
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return out


def find_secrets(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: Sequence[str] = ALLOWED
) -> DataFrame:
    """One row per row of ``df``: id, text, and ``secrets``, the sorted array of (start, kind, end) in code points.

    ``kind`` indexes ``KINDS``.  The first three kinds are fixed formats and may overlap each other.  An entropy span is a
    run of at least 20 token characters of which some window of 20 reaches the entropy of its class, unless it matches an
    allow-list pattern or overlaps a span of a fixed format.  Whole texts are scanned; every row is independent, so nothing is
    shuffled.  A null text is taken as empty and has no spans.  Repeated rows, null ids and empty tables need no special
    care; other columns are ignored.
    """
    rows = pick(df, id=id_col, text=text_col).select(F.col("id").alias(id_col), F.col("text").cast("string").alias("text"))
    return with_secrets(rows, "text", "secrets", allowed)


def with_secrets(df: DataFrame, text_col: str, out_col: str, allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """``df`` with the spans of every text in a further column."""
    text = whole(F.col(text_col))
    rows = df.withColumn("_base_spans", F.concat(*_base_spans(text).values()))

    def random_token(m: Column) -> Column:
        harmless = m["value"].rlike(allowed[0]) if allowed else F.lit(False)
        for pattern in allowed[1:]:
            harmless = harmless | m["value"].rlike(pattern)
        free = ~F.exists("_base_spans", lambda b: (b["start"] < m["end"]) & (b["end"] > m["start"]))
        return F.when(~harmless & free, _looks_random(m["value"])).otherwise(False)

    entropy = _spans(F.filter(_located(text, CANDIDATE), random_token), "entropy")
    spans = F.array_sort(F.concat("_base_spans", _if(text.rlike(CANDIDATE), entropy)))
    return rows.withColumn(out_col, spans).drop("_base_spans")


def redact_secrets(df: DataFrame, text_col: str = "text", size_col: str | None = None, placeholder: str = PLACEHOLDER) -> DataFrame:
    """``df`` with every secret in the text replaced, and its length in ``size_col`` brought up to date where a text has changed.

    A null text stays null; see ``find_secrets``.  Every row is treated alone, so repeated rows stay repeated; an empty table stays
    empty, null ids need no care, and other columns may have any names.
    """
    rows = numbered(df)
    text_at = rows.name(text_col)
    found = with_secrets(rows.frame, text_at, "_secrets")
    cut = found.withColumn("_cut", redacted(F.col(text_at).cast("string"), F.col("_secrets"), placeholder))
    changed = F.size("_secrets") > 0
    if size_col:
        size_at = rows.name(size_col)
        size = F.when(changed, F.length("_cut").cast("long")).otherwise(F.col(size_at))
        cut = cut.withColumn(size_at, size.cast(rows.frame.schema[size_at].dataType))
    return rows.restored(cut.withColumn(text_at, F.col("_cut")))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, placeholder: str = PLACEHOLDER) -> Column:
    """The text with every span, or every stretch of overlapping spans, replaced; a null text stays null."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        kept = F.concat(state["out"], F.substring(text, state["at"] + 1, span["start"] - state["at"]), F.lit(placeholder))
        out = F.when(span["start"] >= state["at"], kept).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    cut = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
