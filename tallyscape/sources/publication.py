"""Reader for statistics published as a laid-out sheet and saved as CSV.

Such a file has a banner, a header over two lines with merged heads, section labels,
coded body rows, a total row and a source note.  Only the first lines, which hold the
header, are looked at on the driver.  Body and total rows are told apart by what is in
the row, never by its number, so the file may be split over any number of tasks.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyscape.functions.text import clean_name, parse_count, snake_name

BODY_CODE = r"^\s*\d+\s+"  # a number and a blank before the name
GAPS = ("", "-")


def merge_header(upper: list[str], lower: list[str]) -> list[str]:
    """Join two header lines; a merged head reaches over the empty cells on its right."""
    names, head = [], ""
    for top, sub in zip(upper, lower):
        top, sub = top.strip(), sub.strip()
        head = top or (head if sub else "")
        names.append(snake_name(f"{head} {sub}"))
    return names


def read_publication_csv(
    spark: SparkSession,
    path: str,
    *,
    entity: str = "entity",
    header_lines: tuple[int, int] = (2, 3),
    rename: dict[str, str] | None = None,
    code: str = BODY_CODE,
    gaps: Sequence[str] = GAPS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(body, totals, rejects)``: one row per coded entity, the published total row(s), and what fits nowhere.

    ``header_lines`` are the two zero-based header lines.  ``rename`` maps the derived
    column names to others.  ``code`` is the pattern that begins a body row, ``gaps`` are the
    cells that state no number.

    ``rejects`` (line, reason) holds the lines with more or fewer cells than the header, those with a cell
    that is neither number nor gap, and those with numbers but no label.  They are in neither other frame.
    Lines without numbers (banner, header, section labels, source note) are in none.
    """
    head = [r.value.lstrip("\ufeff") for r in spark.read.text(path).head(max(header_lines) + 1)]
    parsed = list(csv.reader(head))
    if len(parsed) <= max(header_lines):
        raise ValueError(f"the file ends before header line {max(header_lines)}")
    upper, lower = parsed[header_lines[0]], parsed[header_lines[1]]
    names = [(rename or {}).get(n, n) for n in merge_header(upper, lower)][1:]
    if len(set(names)) != len(names) or "" in names:
        raise ValueError(f"header does not give distinct column names: {names}")

    lines = spark.read.text(path).select(F.regexp_replace("value", "^\ufeff", "").alias("line"))
    lines = lines.filter(~F.col("line").isin([F.lit(head[i]) for i in header_lines]))
    wide = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(upper) + 1)])
    cells = lines.select("line", F.from_csv("line", wide.simpleString()[7:-1].replace(":", " ")).alias("cells")).select("line", "cells.*")
    first, beyond = F.trim(F.coalesce("c0", F.lit(""))), F.col(f"c{len(upper)}")
    raw = [F.trim(F.coalesce(f"c{i + 1}", F.lit(""))) for i in range(len(names))]
    values = [parse_count(F.col(f"c{i + 1}")) for i in range(len(names))]
    stated: Column = reduce(lambda a, b: a | b, [v.isNotNull() for v in values])
    odd: Column = reduce(lambda a, b: a | b, [v.isNull() & ~r.isin(list(gaps)) for v, r in zip(values, raw)])
    coded = F.col("c0").isNotNull() & F.coalesce("c0", F.lit("")).rlike(code)
    reason = (
        F.when((coded | stated) & F.col(f"c{len(names)}").isNull() & F.lit(len(names) > 0) & (F.size(F.split("line", ",")) < len(upper)), "too few cells")
        .when(F.coalesce(beyond, F.lit("")) != "", "too many cells")
        .when((coded | stated) & odd, "not a number")
        .when(stated & (first == ""), "no label")
    )
    sorted_ = cells.withColumn("reason", reason)
    measures = [v.alias(n) for v, n in zip(values, names)]
    body = sorted_.filter(F.col("reason").isNull() & coded).select(
        clean_name(F.regexp_replace("c0", code, ""), trim_again=True).alias(entity), *measures
    )
    totals = sorted_.filter(F.col("reason").isNull() & ~coded & stated).select(
        clean_name(F.col("c0"), trim_again=True).alias(entity), *measures
    )
    return body, totals, sorted_.filter(F.col("reason").isNotNull()).select("line", "reason")
