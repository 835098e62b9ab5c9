"""Positions of pattern matches as column expressions, in code points, end exclusive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN_TYPE = "array<struct<start:int,end:int>>"


def match_spans(
    text: Column, pattern: str, passes: Callable[[Column], Column] | None = None,
    group: int = 0, offset: Column | None = None,
) -> Column:
    """Spans of the leftmost non-overlapping matches that pass a test, in page order.

    The texts between the matches come from split, the matches from
    regexp_extract_all; running sums of their lengths give the positions. The
    test sees the given group of a match. Only passing matches are appended, so
    a text with very many failing ones stays linear. The offset is added to
    every position. A pattern must not match the empty text.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    seen = matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    parts = F.zip_with(
        gaps, F.arrays_zip(matches.alias("m"), seen.alias("g")),
        lambda gap, match: F.struct(
            F.length(gap).alias("gap"), F.length(match["m"]).alias("n"),
            (F.lit(True) if passes is None else F.coalesce(passes(match["g"]), F.lit(False))).alias("ok"),
        ),
    )

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + part["n"]
        span = F.struct(start.alias("start"), end.alias("end"))
        kept = F.when(part["ok"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    first = F.coalesce(offset, F.lit(0)).cast("int") if offset is not None else F.lit(0)
    none = F.array().cast(SPAN_TYPE)
    return F.aggregate(
        parts, F.struct(first.alias("at"), none.alias("spans")), step, lambda state: state["spans"]
    )


def spans_where(condition: Column, spans: Column) -> Column:
    """The spans of texts that a cheap test lets through, none for the others."""
    return F.when(condition, spans).otherwise(F.array().cast(SPAN_TYPE))


def in_order(by_kind: dict[str, Column]) -> Column:
    """All spans of several kinds, by start, then by the order of the kinds."""
    def ranked(i: int, kind: str) -> Callable[[Column], Column]:
        return lambda s: F.struct(
            s["start"].alias("start"), F.lit(i).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"))

    return F.array_sort(F.concat(*[
        F.transform(spans, ranked(i, kind)) for i, (kind, spans) in enumerate(by_kind.items())
    ]))


def as_text(spans: Column) -> Column:
    """Spans with kinds as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def replaced(text: Column, spans: Column, mask: Callable[[Column], Column]) -> Column:
    """The text with each span, in order of starts, replaced by a mask of its kind.

    A span that begins inside an earlier one only hides what the earlier one
    left open.
    """
    def step(state: Column, span: Column) -> Column:
        open_from = F.greatest(state["at"], span["start"])
        before = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        shown = F.when(span["end"] > open_from, F.concat(before, mask(span["kind"]))).otherwise(F.lit(""))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.concat(state["out"], F.array(shown)).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(spans, start, step, lambda state: F.concat(
        F.array_join(state["out"], ""), F.substring(text, state["at"] + 1, F.length(text))
    ))
