"""Rows that fail to parse, apart from the valid ones, with the reason.

Values: each distinct text of a column is checked once; the failing ones form a dictionary (kind, text, reason) that
is joined back to the rows. Lines: one left fold over the comma-separated pieces of a line finds fields, whatever the
quoting habit, in time linear in the line's length and without recursion.

Defined results: blanks (any Unicode white space) around a value do not matter; null and empty values are no failure;
a null line has no failure and loads nothing; an empty line fails with ``columns``; a line with ``quoting`` has no
other reason and neither has one with ``columns``; repeated rows fail as often as they come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = 12


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def is_amount(v: Column) -> Column:
    """A plain decimal number: optional minus, up to ten digits before and two after the point."""
    return v.rlike(r"^-?[0-9]{1,10}(\.[0-9]{1,2})?$")


def is_date(v: Column) -> Column:
    """An existing day as month/day/year."""
    m = F.try_element_at(F.split(v, "/"), F.lit(1)).try_cast("int")
    d = F.try_element_at(F.split(v, "/"), F.lit(2)).try_cast("int")
    y = F.try_element_at(F.split(v, "/"), F.lit(3)).try_cast("int")
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    days = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    shaped = v.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$")
    return shaped & F.coalesce(m.between(1, 12) & (d >= 1) & (d <= days), F.lit(False))


def bad_values(values: DataFrame) -> DataFrame:
    """(kind, value, reason): of the distinct (kind, value) those that do not parse; kind is ``amount`` or ``date``."""
    text = strip(F.col("value"))
    ok = F.when(F.col("kind") == "amount", is_amount(text)).otherwise(is_date(text))
    return (
        values.where("value IS NOT NULL")
        .select("kind", "value")
        .distinct()
        .where((text != "") & ~ok)
        .withColumn("reason", F.col("kind"))
    )


def _piece(open_: Column, piece: Column) -> tuple[Column, Column]:
    """Whether a piece stands in a quoted field, and what its quotes do: 0 none left, 1 closed at its end, 2 broken."""
    starts = ~open_ & piece.startswith('"')
    content = F.when(starts, F.substring(piece, 2, 2147483647)).otherwise(piece)
    left = F.replace(content, F.lit('""'), F.lit(""))
    at = F.instr(left, '"')
    return open_ | starts, F.when(at == 0, 0).when(at == F.length(left), 1).otherwise(2)


def line_fields(line: Column) -> Column:
    """struct(i, n, bad, open, ends) of a CSV line's pieces; ends: the last piece of each of the first ``FIELDS`` fields."""
    start = F.struct(
        F.lit(0).alias("i"),
        F.lit(0).alias("n"),
        F.lit(False).alias("bad"),
        F.lit(False).alias("open"),
        F.array().cast("array<int>").alias("ends"),
    )

    def step(acc: Column, piece: Column) -> Column:
        quoted, effect = _piece(acc["open"], piece)
        i = acc["i"] + 1
        still = quoted & (effect == 0)
        done = ~still
        number = acc["n"] + F.when(done, 1).otherwise(0)
        return F.struct(
            i.alias("i"),
            number.alias("n"),
            (acc["bad"] | (quoted & (effect == 2))).alias("bad"),
            still.alias("open"),
            F.when(done & (number <= FIELDS), F.array_append(acc["ends"], i)).otherwise(acc["ends"]).alias("ends"),
        )

    return F.aggregate(F.split(line, ",", -1), start, step)


def _field(pieces: Column, first: Column, last: Column) -> Column:
    raw = F.when(first > 0, F.array_join(F.slice(pieces, first, last - first + 1), ","))
    inner = F.replace(F.substring(raw, 2, 2147483647), F.lit('""'), F.lit('"'))
    return F.when(raw.startswith('"'), F.substring(inner, F.lit(1), F.length(inner) - 1)).otherwise(raw)


def parse_lines(lines: DataFrame, row_id: str, line: str, date_at: int = 3, amount_at: int = 8) -> DataFrame:
    """(row_id, structure, date_text, amount_text, fields, line): structure is ``quoting``, ``columns`` or null.

    ``date_at`` and ``amount_at`` are field numbers from one; ``fields`` holds the ``FIELDS`` texts of a whole line.
    """
    pieces = F.split(F.col("line"), ",", -1)
    last = F.element_at(pieces, -1)
    base = lines.select(F.col(row_id).alias("row_id"), F.col(line).alias("line")).where("line IS NOT NULL")
    folded = base.withColumn("f", line_fields(F.col("line")))
    spare = (F.col("f.n") == FIELDS + 1) & last.isin("", '""')
    structure = F.when(F.col("f.bad") | F.col("f.open"), "quoting").when(~((F.col("f.n") == FIELDS) | spare), "columns")
    out = folded.withColumn("structure", structure)
    good = F.col("structure").isNull()

    def field(at: int) -> Column:
        first = F.lit(1) if at == 1 else F.get("f.ends", F.lit(at - 2)) + 1
        return F.when(good, _field(pieces, first, F.get("f.ends", F.lit(at - 1))))

    return out.select(
        "row_id",
        "structure",
        field(date_at).alias("date_text"),
        field(amount_at).alias("amount_text"),
        F.when(good, F.array(*[field(k) for k in range(1, FIELDS + 1)])).alias("fields"),
        "line",
    )


def cells(rows: DataFrame, table: str, date: str, amount: str) -> DataFrame:
    """(table_name, row_id, kind, value) of the two checked columns, from one scan."""
    pairs = F.array(
        F.struct(F.lit("date").alias("kind"), F.col(date).alias("value")),
        F.struct(F.lit("amount").alias("kind"), F.col(amount).alias("value")),
    )
    return rows.select(F.lit(table).alias("table_name"), "row_id", F.inline(pairs)).where("value IS NOT NULL")


def failures(cell_rows: DataFrame, structural: DataFrame) -> DataFrame:
    """(table_name, row_id, reason) of cells that do not parse and of lines whose structure is broken."""
    broken = cell_rows.join(bad_values(cell_rows), ["kind", "value"]).select("table_name", "row_id", "reason")
    return broken.unionByName(structural)


def valid_rows(rows: DataFrame, failed: DataFrame, row_id: str) -> DataFrame:
    """The rows of which nothing failed, with their columns as they came."""
    return rows.join(failed.select(F.col("row_id").alias(row_id)).distinct(), row_id, "left_anti")
